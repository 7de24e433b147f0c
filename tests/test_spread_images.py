"""Images of many boxes, and turns run to their end, against plain versions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.operators import detect, tasks


def plain_nms(rows, most):
    """Greedy suppression of rows(idx, score, x1, y1, x2, y2), in NumPy."""
    order = sorted(range(len(rows)), key=lambda k: (-rows[k][1], *rows[k][:1], *rows[k][2:]))
    box = np.array([rows[k][2:] for k in order])
    area = (box[:, 2] - box[:, 0]) * (box[:, 3] - box[:, 1])
    alive, kept = np.ones(len(rows), bool), []
    for k in range(len(rows)):
        if not alive[k]:
            continue
        kept.append(rows[order[k]])
        rest = slice(k + 1, None)
        dx = np.minimum(box[k, 2], box[rest, 2]) - np.maximum(box[k, 0], box[rest, 0])
        dy = np.minimum(box[k, 3], box[rest, 3]) - np.maximum(box[k, 1], box[rest, 1])
        both = np.maximum(0, dx) * np.maximum(0, dy)
        alive[rest] &= ~(both / (area[k] + area[rest] - both) > most)
    return sorted(kept)


def boxes(n, seed, side=4000):
    r = random.Random(seed)
    rows = []
    for k in range(n):
        x, y = (rows[-1][2] + r.choice((0, 1, 3)), rows[-1][3]) if k % 3 == 1 else (r.uniform(-side, side), r.uniform(0, side))
        w, h = 2 ** r.uniform(0, 7), 2 ** r.uniform(2, 7)
        rows.append((k % 97, r.choice((0.1, 0.5, 0.7, 0.9)), float(round(x, 1)), float(round(y, 1)), round(x + w, 1) + 0.1, round(y + h, 1) + 0.1))
    return rows + rows[:20]


KIND = "image_id long, idx int, score double, x1 double, y1 double, x2 double, y2 double"


@pytest.mark.parametrize("most", [0.5, 0.3, 0.75])
def test_suppression_in_rounds_equals_the_fold(spark, most):
    large, small = boxes(1500, 1, 300), boxes(40, 2, 60)
    rows = [(7, *r) for r in large] + [(None, *r) for r in boxes(300, 3, 100)] + [(9, *r) for r in small]
    flat = [(7, 1, 0.9, 1.0, 1.0, 1.0, 5.0), (7, 1, 0.9, None, 1.0, 2.0, 5.0)]
    df = spark.createDataFrame(rows + flat, KIND).repartition(5)
    got = detect.suppress(df, most, fold_boxes=100)
    found = {i: sorted(tuple(r)[1:] for r in got.where(F.col("image_id").eqNullSafe(i) & (F.col("x2") > F.col("x1"))).collect()) for i in (7, None, 9)}
    assert found == {7: plain_nms(large, most), None: plain_nms(boxes(300, 3, 100), most), 9: plain_nms(small, most)}
    assert got.columns == df.columns and got.where("x1 IS NULL OR x1 = x2").count() == 2


def test_an_image_of_100_000_boxes_is_spread(spark):
    n = 100_000
    df = spark.range(n, numPartitions=4).select(
        F.lit(1).cast("long").alias("image_id"), (F.col("id") % 1000).cast("int").alias("idx"), (F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000.0).alias("score"),
        *[(F.pmod(F.xxhash64("id", F.lit(s)), F.lit(200_000)) / 10.0).alias(c) for c, s in (("x1", 1), ("y1", 2))],
    )
    df = df.withColumn("x2", F.col("x1") + 60.0 + F.col("idx") % 50).withColumn("y2", F.col("y1") + 80.0 + F.col("idx") % 30)
    rows = [tuple(r)[1:] for r in df.collect()]
    got = detect.suppress(df)
    assert sorted(tuple(r)[1:] for r in got.collect()) == plain_nms(rows, 0.5)
    assert len(rows) > got.count() > 1000


def test_usable_pairs_of_a_large_image_are_counted(spark):
    r = random.Random(4)
    rows = [(1, r.choice("abc"), *(lambda x, y: (x, y, x + r.choice((0.0, 5.0, 300.0)), y + r.uniform(1, 90)))(r.choice((0.0, 100.0, 256.0, r.uniform(-900, 3000))), r.uniform(0, 3000))) for _ in range(2500)]
    rows += [(None, "a", 0.0, 0.0, 1.0, 1.0), (None, "b", 101.0, 0.0, 102.0, 1.0), (None, "b", 101.5, 0.0, 102.0, 1.0), (2, "a", 0.0, 0.0, 1.0, 1.0), (2, None, 900.0, 0.0, 901.0, 1.0)]
    df = spark.createDataFrame(rows, "image_id long, class_name string, x1 double, y1 double, x2 double, y2 double")
    own = [x for x in rows if x[0] == 1]
    b, c = np.array([x[2:] for x in own]), np.array([x[1] for x in own])
    want = 0
    for k in range(len(own)):
        dx = np.maximum(0, np.maximum(b[k + 1 :, 0] - b[k, 2], b[k, 0] - b[k + 1 :, 2]))
        dy = np.maximum(0, np.maximum(b[k + 1 :, 1] - b[k, 3], b[k, 1] - b[k + 1 :, 3]))
        want += int(((np.sqrt(dx * dx + dy * dy) > 100) & (c[k + 1 :] != c[k])).sum())
    assert {x.image_id: x.n for x in detect.usable_pair_counts(df).collect()} == {1: want, None: 1, 2: 0}


TASKS = [
    ("c1", ["add", "remove"]), ("c2", ["adjust", "replace"]), ("c3", ["remove", "add"]), ("c4", ["replace", "adjust"]), ("c5", ["replace", "replace"]),
    ("o1", ["add", "adjust", "remove"]), ("o2", ["add", "adjust", "replace"]), ("v1", ["add", "replace", "adjust"]), (None, ["add", "remove"]), ("x", ["paint"]), ("y", []),
]
OMIT = ["add_omit", "adjust_omit", "remove_omit", "replace_omit"]
VERSION = ["add_omit", "replace_version", "adjust_version"]
COMPOSE = [f"compose_{o}" for o in ("add", "remove", "adjust", "replace")]


def test_all_drivers_run_to_the_end(spark, tmp_path):
    """All eleven drivers, in three passes at most; what was broken off goes on without making a turn twice."""
    made, known = [], spark.createDataFrame(TASKS, "task_id string, operations array<string>")

    def edit(df):
        made.append([(r.task_id, r.next.turn) for r in df.select("task_id", "next").collect()])
        return df.withColumn("image", F.concat("task_id", F.lit("-"), F.col("next.turn")))

    def failing(df):
        return edit(df).where("task_id NOT IN ('c2', 'o1')")

    seen = set()
    for name, ids, drivers in (("compose", "c", COMPOSE), ("omit", "o", OMIT), ("version", "v", VERSION)):
        own = known.where(F.col("task_id").isNull() | F.substring("task_id", 1, 1).isin(ids, "x", "y"))
        made.clear()
        tasks.run_turns(own, f"{tmp_path}/{name}", failing, drivers, passes=1)
        out = tasks.run_turns(own, f"{tmp_path}/{name}", edit, drivers)
        done = sorted((r.task_id, r.turn) for r in out.collect())
        assert done == sorted((i, k) for i, ops in TASKS if i and i[0] == ids for k in range(len(ops))) and out.where("last").count() == len({i for i, _ in done})
        tried = [x for part in made for x in part]
        assert len(tried) == len(done) + sum(i in ("c2", "o1") for i in {x[0] for x in tried})  # what failed was tried again, once
        seen |= {r.driver for r in out.select("driver").distinct().collect()}
        assert all(r.image == f"{r.task_id}-{r.turn}" and r.source == ("original" if not r.turn or ids != "c" else "result_0") for r in out.collect())
        made.clear()
        assert tasks.run_turns(own, f"{tmp_path}/{name}", edit, drivers).count() == len(done) and made == [[]]
    assert seen == {t.driver for t in tasks.TURNS}
