import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.functions import masks, parse, text
from quarry.operators import detect, geometry, models, partition, resume, sample, tasks
from quarry.sources import readers
from quarry.streaming.incremental import follow


def values(spark, rows, column):
    return [r[0] for r in spark.createDataFrame([(x,) for x in rows], "x string").select(column(F.col("x"))).collect()]


def test_judge_mean(spark):
    told = ["a: 1\nb: 5\nc: 5", "a: 1\r\nb: 4\nc: 4", "r: a: 3", "a: 3 (Fair)\nb: 2", "", None, "n: 99999999999"]
    assert values(spark, told, parse.judge_mean) == [3.67, 3.0, None, 2.0, None, None, 99999999999.0]


def test_responses(spark):
    found = values(spark, ["prompt: make it red, result: a red car.", "no"], lambda c: parse.response(c, "single"))
    assert tuple(found[0]) == ("make it red", "a red car") and found[1] is None
    found = values(spark, ["premise: p, round1: a, result1: b, round2: c, result2: d."], lambda c: parse.response(c, "content_memory"))
    assert tuple(found[0]) == ("p", "a", "b", "c", "d")


def test_recap(spark):
    json = '{"background": ["sky"], "object": ["car", "dog"], "summary": ["s"]}'
    found = values(spark, [json, json[:-1] + ",}", "junk"], parse.recap)
    assert tuple(found[0]) == tuple(found[1]) == (["sky"], ["car", "dog"], "s", True)
    assert tuple(found[2]) == ([], [], "", False)


def test_scalar_scores(spark):
    assert values(spark, ["[0.5]", "0.25", "x", None], parse.scalar_score) == [0.5, 0.25, None, None]


def test_texts(spark):
    assert values(spark, ["00/a.b.jpg"], text.record_key) == ["00a.b"]
    assert values(spark, ["base/00/a.b.jpg"], lambda c: text.task_id(c, "base")) == ["00_a"]
    assert values(spark, ["d"], lambda c: text.fill("x\n{{{}}}\t ", c)) == ["xd"]


@pytest.mark.parametrize("seed", range(5))
def test_mask_round_trip(seed):
    mask = (np.random.default_rng(seed).random((17, 23)) < 0.1 * seed).astype(np.uint8)
    assert (masks.decode(masks.encode(mask), 17, 23) == mask).all()


def test_mask_columns(spark):
    mask = np.zeros((4, 6), np.uint8)
    mask[1:3, 2:5] = 1
    df = spark.createDataFrame([(masks.encode(mask), 4, 6), (None, 4, 6)], "m string, h int, w int")
    area, region = df.select(masks.mask_area("m"), masks.edit_region("m", "h", "w")).first()
    assert area == 6 and bytes(region) == ((1 - mask) * 255).tobytes()


def test_limits_and_gaps(spark):
    areas = spark.createDataFrame([(1.0,), (60.0,), (61.0,), (8.0,)], "a double")
    seen = areas.select(geometry.is_target(F.col("a"), F.lit(100.0), F.lit(0.8), F.lit(0.0))).collect()
    assert [r[0] for r in seen] == [False, True, False, True]
    boxes = spark.createDataFrame([((0.0, 0.0, 1.0, 1.0), (x, 0.0, x + 1, 1.0)) for x in (1.0, 101.0, 102.0)], "a struct<x1:double,y1:double,x2:double,y2:double>, b struct<x1:double,y1:double,x2:double,y2:double>")
    assert [r[0] for r in boxes.select(geometry.far_apart(F.col("a"), F.col("b"))).collect()] == [False, False, True]


def test_suppression_keeps_half_overlaps(spark):
    rows = [(1, i, s, 0.0, 0.0, w, 1.0) for i, s, w in ((0, 0.9, 2.0), (1, 0.8, 1.0), (2, 0.7, 1.5))]
    boxes = spark.createDataFrame(rows, "image_id int, idx int, score double, x1 double, y1 double, x2 double, y2 double")
    assert sorted(r.idx for r in detect.suppress(boxes).collect()) == [0, 1]


def test_partitions(spark):
    rows = spark.range(10).withColumnRenamed("id", "k").repartition(3)
    sizes = {r.part: r["count"] for r in partition.contiguous(rows, "k", 4).groupBy("part").count().collect()}
    assert sizes == {0: 3, 1: 3, 2: 2, 3: 2}
    assert partition.contiguous(rows.limit(0), "k", 4).count() == 0


def test_draws_repeat(spark):
    rows = spark.createDataFrame([(g, i) for g in range(5) for i in range(4)], "g int, idx int")
    one = {tuple(r) for r in sample.pick_one(rows, "g", 3).collect()}
    assert one == {tuple(r) for r in sample.pick_one(rows.repartition(7), "g", 3).collect()} and len(one) == 5
    assert one <= {(r.g, r.idx) for r in sample.pick(rows, "g", 2, 3).collect()}


def test_turns(spark):
    todo = spark.createDataFrame([("a", ["add", "adjust", "remove"]), ("b", ["add", "adjust", "remove"])], "task_id string, operations array<string>")
    done = spark.createDataFrame([("b", 0), ("b", 1)], "task_id string, turn int")
    found = {r.task_id: r.next for r in tasks.next_turns(todo, done, ["add_omit", "adjust_omit", "remove_omit"]).collect()}
    assert found["a"].driver == "add_omit" and (found["b"].driver, found["b"].last) == ("remove_omit", True)


def test_model_calls_and_passes(spark, tmp_path):
    rows = spark.createDataFrame([("a", "x"), ("b", None)], "key string, prompt string")
    out = resume.in_passes(rows, "key", f"{tmp_path}/sink", lambda df: models.answered(df, models.EchoClient))
    found = {r.key: r.answer for r in out.collect()}
    assert found["a"].startswith("prompt: edit") and found["b"] is None


def test_readers_and_stream(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"1": {"id": "a.png", "prompt": "p"}}')
    assert [tuple(r) for r in readers.keyed_items(spark, f"{tmp_path}/m.json", "struct<id:string,prompt:string>").collect()] == [("1", "a.png", "p")]
    for name in ("original.png", "result.png", "result.json"):
        (tmp_path / "t" / "one").mkdir(parents=True, exist_ok=True)
        (tmp_path / "t" / "one" / name).write_bytes(b"x")
    assert readers.complete_folders(spark, f"{tmp_path}/t").count() == 1
    for k in range(2):
        spark.range(5).write.mode("append").parquet(f"{tmp_path}/in")
        follow(spark, f"{tmp_path}/in", "id long", lambda df: df, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
        assert spark.read.parquet(f"{tmp_path}/out").count() == 5 * (k + 1)


def test_vocabulary_and_item_images(spark, tmp_path):
    from quarry.sources import readers

    words = spark.createDataFrame([("Cat",), ("cat",), ("zzq",), (None,)], "word string")
    known = spark.createDataFrame([("cat",), ("cat",), (None,)], "word string")
    assert sorted(r.word for r in readers.in_vocabulary(words, known).collect()) == ["Cat", "cat"]
    for name in ("in/a/1.jpg", "out/k1.png"):
        (tmp_path / name).parent.mkdir(parents=True)
        (tmp_path / name).write_bytes(name.encode())
    items = spark.createDataFrame([("k1", "a/1.jpg"), ("k2", "a/2.jpg")], "key string, id string")
    files = readers.images(spark, str(tmp_path), "*.*")
    rows = readers.with_images(items, files, f"{tmp_path}/in/", f"file://{tmp_path}/out").collect()
    found = {r.key: (r.original and bytes(r.original), r.result and bytes(r.result)) for r in rows}
    assert found == {"k1": (b"in/a/1.jpg", b"out/k1.png"), "k2": (None, None)}


def test_results_name_objects(spark):
    named = {
        "a red wooden chair": True, "Chair": True, "Chair.": True, "none": False, "None.": False, "": False, "the chair is red": False, "Replace the chair": False,
        "a chair. A table": False, "one two three four five six seven eight nine": False, "дубовый стол": True, "...": False, None: False,
    }
    assert values(spark, list(named), lambda c: text.result_named(F.lit("adjust"), c)) == list(named.values())
    assert values(spark, ["None", "none.", "a chair", "", None], lambda c: text.result_named(F.lit("add"), c)) == [True, True, False, False, False]


def test_premises_are_unsaid_and_shown(spark):
    premise = "All objects are made of brushed copper"
    cases = [
        ("Swap the lamp for a vase", "a brushed copper vase", True, True),
        ("Swap the lamp for one MADE of brushed, copper", "copper vase", False, False),
        ("Swap the brushed lamp", "objects made of brushed copper", True, True),  # a word alone is no repetition
        ("unmade of brushed copperplate", None, True, False),
        (None, "", True, False),
    ]
    rows = spark.createDataFrame([(premise, a, b) for a, b, *_ in cases], "p string, a string, b string")
    got = rows.select(text.premise_kept(F.col("p"), [F.col("a")], [F.col("b")]).alias("k")).select("k.*").collect()
    assert [tuple(r) for r in got] == [(c[2], c[3]) for c in cases]
    short = spark.createDataFrame([("copper", "a copper lamp", "copper vase"), ("the", "no", "x"), (None, "a", "b"), ("", "a", "b")], "p string, a string, b string")
    got = short.select(text.premise_kept(F.col("p"), [F.col("a")], [F.col("b")]).alias("k")).select("k.*").collect()
    assert [tuple(r) for r in got] == [(False, True), (True, True), (True, False), (True, True)]
