"""Versions with an index of keys, and draws among all usable pairs, against plain versions."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quarry.operators import detect, resume
from quarry.sources import versions, writers


def plain(tasks, done):
    return sorted((r for r in tasks if r not in done), key=lambda x: (x is None, x))


def left(df):
    return sorted((r[0] for r in df.collect()), key=lambda x: (x is None, x))


@pytest.mark.parametrize("kind", ["int", "string"])
@pytest.mark.parametrize("null", ["never", "tasks", "both"])
def test_resuming_by_the_index_equals_the_anti_join(spark, tmp_path, kind, null):
    r, root = random.Random(5), f"{tmp_path}/out"
    make = (lambda k: k) if kind == "int" else (lambda k: ("é" if k % 5 else "\U0001f600") + str(k))
    some = lambda n: [make(r.randrange(-300, 900)) for _ in range(n)]
    tasks, done = some(700), [some(400), some(5), []]
    tasks += [None, None] if null != "never" else []
    done[1] += [None] * 3 if null == "both" else []
    asked = spark.createDataFrame([(k, "x") for k in tasks], f"key {kind}, _done string")
    assert left(versions.missing_in_versions(asked, root, "key").select("key")) == plain(tasks, set())  # no version yet
    wide = "long" if kind == "int" else kind
    for v, keys in enumerate(done):
        versions.add_version(spark.createDataFrame([(k, v) for k in keys], f"key {wide}, _chance int"), root, v, "key", 6)
    writers.new_version(spark.createDataFrame([(make(7),)], f"key {kind}"), root, 3)  # no index
    assert versions.versions(spark, root) == {0: True, 1: True, 2: True, 3: False}
    got = versions.missing_in_versions(asked, root, "key")
    every = {k for keys in done for k in keys} | {make(7)}
    assert left(got.select("key")) == plain(tasks, every) and got.columns == asked.columns
    assert left(got.select("key")) == left(resume.missing(asked, spark.read.parquet(*[f"{root}/version={v}" for v in range(4)]), "key").select("key"))
    assert spark.read.parquet(root).count() == sum(map(len, done)) + 1  # the index is no part of the rows
    assert left(versions.missing_in_versions(asked.limit(0), root, "key").select("key")) == []


def test_files_are_skipped(spark, tmp_path):
    root = f"{tmp_path}/out"
    for v in range(3):  # even keys only
        versions.add_version(spark.range(v * 20_000, (v + 1) * 20_000, 2).withColumnRenamed("id", "key"), root, v, "key", 10)
    read = lambda *keys: versions.files_to_read(spark.createDataFrame([(k,) for k in keys], "key long"), root, "key")
    assert read(60_000, 70_000, -1) == [] and len(read(20_000)) == 1 and len(read(0, 59_998)) == 2  # by ranges
    assert len(read(*range(1, 60_000, 6000))) <= 1  # by the filters, though each lies in a range
    assert len(read(*range(0, 60_000, 500))) == 30
    with pytest.raises(ValueError, match="neither"):
        versions.add_version(spark.range(3).select(F.col("id").cast("double").alias("key")), root, 9, "key")
    with pytest.raises(ValueError, match="in the tasks"):
        versions.files_to_read(spark.createDataFrame([("a",)], "key string"), root, "key")
    with pytest.raises(Exception, match="exists"):
        versions.add_version(spark.range(3).withColumnRenamed("id", "key"), root, 0, "key")


def test_one_key_of_very_many_rows_and_any_layout(spark, tmp_path, monkeypatch):
    root, n = f"{tmp_path}/out", 30_000
    rows = spark.range(n).select(F.when(F.col("id") % 3 > 0, 500).otherwise(F.col("id")).cast("long").alias("key"))
    versions.add_version(rows, root, 0, "key", 8)
    sizes = [r.n for r in spark.read.parquet(f"{root}/_keys/version=0/files").collect()]
    assert max(sizes) < 2 * n / 8 and sum(sizes) == n
    assert len(versions.files_to_read(spark.createDataFrame([(500,)], "key long"), root, "key")) >= 4
    writers.new_version(rows.repartition(5), root, 1)  # ranges that overlap
    versions.index_version(spark, root, 1, "key")
    monkeypatch.setattr(versions, "MOST_PAIRS", 7)
    asked = spark.range(-5, 2000).withColumnRenamed("id", "key")
    want = [k for k in range(-5, 2000) if k != 500 and (k < 0 or k % 3)]
    assert left(versions.missing_in_versions(asked, root, "key")) == want
    assert len(versions.files_to_read(spark.createDataFrame([(500,)], "key long"), root, "key")) >= 9
    monkeypatch.setattr(versions, "MOST_FILES", 3)
    assert left(versions.missing_in_versions(asked, root, "key")) == want


BOX = "image_id long, idx int, class_name string, x1 double, y1 double, x2 double, y2 double"


def far(a, b):
    dx, dy = (max(0, b[k] - a[k + 2], a[k] - b[k + 2]) for k in (3, 4))
    return a[2] != b[2] and math.hypot(dx, dy) > 100


def test_draws_are_even_among_usable_pairs(spark):
    spots = [("a", 0), ("a", 150), ("b", 30), ("b", 300), ("c", 320), ("a", 700), (None, 900)]
    one = [(0, k, c, float(x), 0.0, x + 10.0, 10.0) for k, (c, x) in enumerate(spots)]
    usable = {(a[1], b[1]) for a in one for b in one if a[2] and b[2] and far(a, b)}
    images = 1500
    df = spark.createDataFrame([(i, *r[1:]) for i in range(images) for r in one], BOX).repartition(6)
    got = detect.drawn_pairs(df, n=2, seed=3).cache()
    seen = Counter((r.first.idx, r.second.idx) for r in got.collect())
    assert set(seen) == usable and sum(seen.values()) == 2 * images
    due = 2 * images / len(usable)
    assert sum((seen[p] - due) ** 2 / due for p in usable) < len(usable) + 4 * math.sqrt(2 * len(usable))
    again = detect.drawn_pairs(df.repartition(3), n=2, seed=3)
    assert sorted(map(str, got.collect())) == sorted(map(str, again.collect()))


def test_draws_of_large_images_and_of_one_pair_only(spark):
    r = random.Random(9)
    many = [(1, k, r.choice("abc"), *(lambda x, y: (x, y, x + 20.0, y + 9.0))(r.uniform(0, 3000), r.uniform(0, 3000))) for k in range(5000)]
    crowd = [(None, k, "ab"[k % 2], 5.0, 5.0, 9.0, 9.0) for k in range(600)] + [(None, 600, "a", 5.0, 5.0, 9.0, 9.0), (None, 601, "c", 500.0, 5.0, 510.0, 9.0)]
    near = [(2, 0, "a", 0.0, 0.0, 9.0, 9.0), (2, 1, "b", 50.0, 0.0, 60.0, 9.0)]
    clear = [(3, 0, "a", 0.0, 0.0, 9.0, 9.0), (3, 1, "b", 500.0, 0.0, 600.0, 9.0)]
    rows = many + crowd + near + clear
    at = {(x[0], x[1]): x for x in rows}
    got = detect.drawn_pairs(spark.createDataFrame(rows, BOX), n=4).collect()
    assert Counter(x.image_id for x in got) == {1: 4, None: 4, 3: 4}
    assert all(far(at[x.image_id, x.first.idx], at[x.image_id, x.second.idx]) for x in got)
    assert all(601 in (x.first.idx, x.second.idx) for x in got if x.image_id is None)
    assert detect.drawn_pairs(spark.createDataFrame([], BOX)).count() == 0
