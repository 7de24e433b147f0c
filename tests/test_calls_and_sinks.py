import json
from collections import Counter
from glob import glob

import pytest
from pyspark.sql import functions as F

from quarry.operators import detect, models, partition, scores
from quarry.sources import writers
from quarry.streaming.incremental import windowed_counts


class Failing:
    """Fails for one prompt, always."""

    def __call__(self, prompt, *images):
        if prompt == "bad":
            raise ValueError("no answer")
        return f"{prompt}:{'+'.join(i.decode() for i in images)}"


def test_image_pairs(spark):
    rows = [("a", 1, b"x", b"y"), ("b", None, b"x", None), (None, 3, b"x", b"y"), ("bad", 4, b"x", b"y")]
    df = spark.createDataFrame(rows, "prompt string, n int, original binary, result binary")
    found = [(r.n, r.answer, r.error) for r in models.answered_with_images(df, Failing).orderBy("prompt").collect()]
    assert found == [(3, None, None), (1, "a:x+y", None), (None, None, "image missing"), (4, None, "no answer")]
    assert models.answered_with_images(df.limit(0), Failing).count() == 0


def test_retries():
    asked = Counter()

    def client(prompt):
        asked[prompt] += 1
        if asked[prompt] < 3:
            raise ConnectionError(prompt)
        return f"`prompt: {asked[prompt]}` "

    assert models.with_retries(client, 3, 0.0)("p") == "`prompt: 3` "
    with pytest.raises(ConnectionError):
        models.with_retries(client, 2, 0.0)("q")
    assert models.until_match(client, "prompt: 5", 5)("p") == "prompt: 5" and models.until_match(client, "never", 2)("p") == "prompt: 7"


def test_motion_captions(spark):
    records = [(1, "s1", "e1"), (2, "s1", None), (3, "s1", "gone"), (4, "", "e1")]
    records = spark.createDataFrame(records, "id int, start_frame string, end_frame string").withColumn("prompt", F.lit("old"))
    files = spark.createDataFrame([("s1", b"S"), ("e1", b"E")], "path string, content binary")
    out = models.motion_captions(records, files, Failing, "say")
    assert out.columns == ["end_frame", "start_frame", "id", "prompt", "error"] and [(r.id, r.prompt) for r in out.collect()] == [(1, "say:S+E")]


def test_detections(spark):
    def make():
        def detect(content, labels):
            return [{"class_name": c, "bbox": [0.0, 0.0, 1.0, 2.0], "score": 0.5, "mask": None} for c in [*labels, content.decode()]]

        return detect

    df = spark.createDataFrame([(1, b"odd", ["car", "sky"]), (2, None, ["car"]), (3, b"car", None)], "image_id int, content binary, labels array<string>")
    found = models.detected(df, make)
    assert {r.image_id: r.error for r in found.collect()} == {1: None, 2: "image missing", 3: None}
    boxes = models.detections(found, F.array(F.lit("car")), F.array(F.lit("sky"))).orderBy("image_id", "idx").collect()
    assert [(r.image_id, r.idx, r.class_name, r.kind, r.error) for r in boxes] == [
        (1, 0, "car", "object", None), (1, 1, "sky", "background", None), (1, 2, "odd", None, "unknown class odd"), (3, 0, "car", "object", None)
    ]


def test_maps_and_versions(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([("b", 2.0), ("a", 1.5), ("a", 1.0), (None, 3.0), ("c", None)], "key string, score double")
    writers.as_json_map(rows, f"{tmp_path}/map", "key", "score")
    (file,) = glob(f"{tmp_path}/map/part-*")
    assert json.load(open(file)) == {"a": 1.5, "b": 2.0, "c": None}
    monkeypatch.setattr(writers, "MOST_ENTRIES", 2)
    with pytest.raises(ValueError, match="entries"):
        writers.as_json_map(rows, f"{tmp_path}/map", "key", "score")
    folder = writers.new_version(rows, f"{tmp_path}/data", 2)
    assert spark.read.parquet(folder).count() == 5
    with pytest.raises(Exception, match="exists"):
        writers.new_version(rows, f"{tmp_path}/data", 2)


def test_a_few_rubrics_are_broadcast(spark, monkeypatch):
    items = spark.createDataFrame([("k", "add"), ("l", None)], "key string, edit_type string")
    rubrics = spark.createDataFrame([("add", "t")], "edit_type string, template string")
    plan = lambda: scores.with_rubric(items, rubrics)._jdf.queryExecution().optimizedPlan().toString()
    assert "broadcast" in plan()
    monkeypatch.setattr(scores, "FEW_RUBRICS", 0)
    assert "broadcast" not in plan()
    assert {(r.key, r.template, r.error) for r in scores.with_rubric(items, rubrics).collect()} == {("k", "t", None), ("l", None, "no rubric for null")}


def test_places_of_repeated_and_missing_keys(spark):
    rows = spark.createDataFrame([(k,) for k in [None, "b", "a", None, "b", "c"]], "k string").repartition(3)
    found = sorted((r["index"], r.n, r.k) for r in partition.indexed(rows, "k", total="n").collect())
    assert found == [(0, 6, None), (1, 6, None), (2, 6, "a"), (3, 6, "b"), (4, 6, "b"), (5, 6, "c")]
    assert sorted(r.part for r in partition.strided(rows, "k", 4).collect()) == [0, 0, 1, 1, 2, 3]


def test_windows_close_on_a_stream(spark, tmp_path):
    for k, hours in enumerate(((0, 1), (1, 9), (20,))):
        rows = [(f"2024-01-01 {h:02d}:30:00", "x", 1.0) for h in hours]
        spark.createDataFrame(rows, "ts string, event_type string, value double").withColumn("ts", F.to_timestamp("ts")).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    events = spark.readStream.schema("ts timestamp, event_type string, value double").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    writer = windowed_counts(events).writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{tmp_path}/cp")
    writer.trigger(availableNow=True).start(f"{tmp_path}/out").awaitTermination()
    found = {r.window_start.hour: r.n for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert found == {0: 1, 1: 2, 9: 1}  # the last window is still open


def test_suppression_equals_a_plain_fold_also_on_copies_and_flat_boxes(spark):
    import random

    draw = random.Random(1)
    rows = []
    for image in (1, 2, None):
        for i in range(60):
            x, y = draw.choice((0.0, 1.0, 4.0)), draw.choice((0.0, 2.0))
            rows.append((image, i % 50, draw.choice((0.2, 0.5, 0.9)), x, y, x + draw.choice((0.0, 3.0, 4.0)), y + draw.choice((2.0, 3.0))))
    rows += [(2, 7, 0.5, 1.0, 1.0, 1.0, 3.0)] * 3 + [(2, 8, 0.5, None, 0.0, 1.0, 1.0)] * 2

    def overlap(a, b):
        if None in a[3:] + b[3:]:
            return 0.0
        dx, dy = min(a[5], b[5]) - max(a[3], b[3]), min(a[6], b[6]) - max(a[4], b[4])
        both = max(0.0, dx) * max(0.0, dy)
        union = sum((r[5] - r[3]) * (r[6] - r[4]) for r in (a, b)) - both
        return both / union if union else 0.0

    for most in (0.5, 0.0, 1.0):
        expected = []
        for image in (1, 2, None):
            kept = []
            for r in sorted((r for r in rows if r[0] == image), key=lambda r: (-r[2], r[1], *((v is not None, v or 0.0) for v in r[3:]))):
                if all(overlap(r, k) <= most for k in kept):
                    kept.append(r)
            expected += kept
        df = spark.createDataFrame(rows, "image_id long, idx int, score double, x1 double, y1 double, x2 double, y2 double")
        assert sorted(map(str, map(tuple, detect.suppress(df, most).collect()))) == sorted(map(str, expected))
