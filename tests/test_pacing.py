import threading
import time
import uuid
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from quarry.operators import batches, models, pacing, scores, tasks
from quarry.streaming.turns import follow_turns
from tests.test_spread_images import TASKS


class Hanging:
    def __call__(self, prompt, *images):
        if prompt == "hang":
            time.sleep(60)
        if prompt == "bad":
            raise ValueError("no answer")
        return prompt


def test_hanging_call_is_an_error_in_time(spark):
    df = spark.createDataFrame([("hang", 1), ("a", 2), ("bad", 3)], "prompt string, n int").coalesce(1)
    began = time.monotonic()
    found = [(r.n, r.answer, r.error) for r in models.answered(df, lambda: pacing.with_deadline(Hanging(), 1.0)).orderBy("n").collect()]
    assert found == [(1, None, "no answer within 1 s"), (2, "a", None), (3, None, "no answer")] and time.monotonic() - began < 40


def test_rate_and_burst():
    pace, began = pacing.Pace(rate=50, burst=5), time.monotonic()
    with ThreadPoolExecutor(8) as pool:
        list(pool.map(pacing.paced(lambda x: x, pace), range(25)))
    assert 0.38 <= time.monotonic() - began < 3


def test_throttling_client_is_obeyed():
    """The service takes three calls at once; the calls in flight fall below that again and again, and all are answered."""
    lock, state = threading.Lock(), {"now": 0, "refused": 0}

    def client(x):
        with lock:
            if state["now"] >= 3:
                state["refused"] += 1
                raise pacing.Throttled
            state["now"] += 1
        time.sleep(0.01)
        with lock:
            state["now"] -= 1
        return x

    pace = pacing.Pace(rate=10_000, burst=100, most=16)
    with ThreadPoolExecutor(16) as pool:
        assert list(pool.map(pacing.paced(client, pace, 50, 0.001, 0.01), range(300))) == list(range(300))
    assert pace.limit <= 5 and 0 < state["refused"] < 150 and pace.running == 0
    with pytest.raises(ValueError):
        pacing.paced(lambda x: int("x"), pace)(1)


def test_dead_letters(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("bad", 2), (None, 3)], "prompt string, _failed int")
    answers, dead = pacing.settled(models.answered(df, Hanging), f"{tmp_path}/s")
    assert sorted((r.prompt or "", r._failed, r.answer) for r in answers.collect()) == [("", 3, None), ("a", 1, "a")]
    assert [(r.prompt, r._failed, r.error) for r in dead.collect()] == [("bad", 2, "no answer")]


class Counting:
    """Notes how many images each call has in the answer; fails where an image is broken."""

    def __call__(self, images, labels):
        if b"broken" in images:
            raise ValueError("unreadable")
        return [[{"class_name": f"{len(images)}", "bbox": [0.0], "score": 1.0, "mask": None}] * len(names) for names in labels]


def boxes(df, **options):
    found = batches.detected_in_batches(df, Counting, **options).collect()
    return {r.id: (r.error or [b.class_name for b in r[-2]]) for r in found}


def test_batches_by_shape(spark, tmp_path):
    rows = [(k, b"xx", ["car"], k % 2, 5) for k in range(8)] + [(8, b"broken", ["car"], 0, 5), (9, None, ["car"], 0, 5), (10, b"xx", None, None, 5)]
    df = spark.createDataFrame(rows, "id int, content binary, labels array<string>, height int, width int").coalesce(1)
    found = boxes(df)
    assert found[1] == found[3] == ["4"] and found[8] == "unreadable" and found[9] == models.NO_IMAGE and found[10] == []
    assert all(isinstance(found[k], list) for k in (0, 2, 4, 6))  # its batch is left alone
    small = df.where("id < 8")
    assert boxes(small, most_bytes=5)[1] == ["2"] and boxes(small, most_images=3)[1] == ["3"] and boxes(small, shape=())[1] == ["8"] and boxes(small.limit(0)) == {}
    clash = batches.detected_in_batches(small.withColumn("boxes", F.lit(1)), Counting)
    assert clash.columns[-3:] == ["boxes", "_boxes", "error"] and clash.where("boxes = 1").count() == 8
    (tmp_path / "a").write_bytes(b"xx")
    files = spark.createDataFrame([(str(tmp_path / "a"), ["car"], 1, 1), (str(tmp_path / "b"), ["car"], 1, 1)], "path string, labels array<string>, height int, width int")
    told = {r.path[-1]: r.error for r in batches.detected_in_files(files, Counting).collect()}
    assert told == {"a": None, "b": models.NO_IMAGE}


class Loaded(Counting):
    """Leaves a file for each time that it is made."""

    def __init__(self, folder):
        with open(f"{folder}/{uuid.uuid4().hex}", "w"):
            pass


def test_model_is_loaded_once_a_worker(spark, tmp_path):
    df = spark.range(40).selectExpr("id", "cast('x' as binary) AS content", "array('car') AS labels", "1 AS height", "1 AS width").repartition(20)
    folder = str(tmp_path)
    out = batches.detected_in_batches(df, pacing.once_a_worker(folder, lambda: Loaded(folder)))
    assert out.where("size(boxes) = 1").count() == 40 and 0 < len(list(tmp_path.iterdir())) < 20


def test_report_of_rows_as_they_are_written(spark, tmp_path):
    kept, watch = scores.counted_as_written(spark.createDataFrame([(1,), (5,), (None,)], "n int"), F.col("n") > 2)
    kept.write.parquet(f"{tmp_path}/kept")
    assert watch.get == {"total": 3, "kept": 1, "dropped": 2} and spark.read.parquet(f"{tmp_path}/kept").count() == 1
    assert kept._jdf.queryExecution().executedPlan().toString().count("Scan") == 1


def test_stream_of_turns_equals_the_loop(spark, tmp_path):
    """Tasks come in two lots, with a restart between them; a task that fails twice goes on, one that always fails stays."""
    drivers = [f"compose_{o}" for o in ("add", "remove", "adjust", "replace")]
    own = [t for t in TASKS if t[0] is None or t[0][0] in "cxy"]
    kind, calls = "task_id string, operations array<string>, path string", []

    def edit(df):
        calls.extend((r.task_id, r.next.turn) for r in df.collect())
        tried = calls.count(("c2", 0))
        lost = F.col("task_id").isin("c1") if tried > 2 else F.col("task_id").isin("c1", "c2")
        return df.where(~lost).withColumn("image", F.concat("path", F.lit("-"), F.col("next.turn")))

    for part in (own[: len(own) // 2], own[len(own) // 2 :]):
        spark.createDataFrame([(i, ops, f"p{i}") for i, ops in part], kind).write.mode("append").parquet(f"{tmp_path}/tasks")
        stream = follow_turns(spark, f"{tmp_path}/tasks", kind, f"{tmp_path}/out", edit, "image string", f"{tmp_path}/state", drivers)
        stream.processAllAvailable()
        stream.stop()
    rows = spark.read.parquet(f"{tmp_path}/out")
    found = sorted((r.task_id, r.turn, r.driver, r.source, r.last, r.image) for r in rows.where("NOT failed").collect())
    known = spark.createDataFrame([(i, ops, f"p{i}") for i, ops in own if i != "c1"], kind)
    plain = tasks.run_turns(known, f"{tmp_path}/loop", lambda df: df.withColumn("image", F.concat("path", F.lit("-"), F.col("next.turn"))), drivers)
    assert found == sorted((r.task_id, r.turn, r.driver, r.source, r.last, r.image) for r in plain.collect()) and found
    assert rows.where("failed AND task_id = 'c1'").count() == 3 and rows.where("failed AND task_id = 'c2'").count() == 2
    assert len(calls) == len(found) + 5  # no turn is made twice


def test_stream_of_turns_starts_no_python_and_keeps_first_rows(spark, tmp_path):
    """A task that comes again is neither run again nor changed; one without operations waits for those that come later."""
    kind, calls = "task_id string, operations array<string>, path string", []

    def edit(df):
        calls.extend((r.task_id, r.next.turn, r.path) for r in df.collect())
        return df.withColumn("image", F.concat("path", F.lit("-"), F.col("next.turn")))

    lots = [[("a", ["add", "add"], "a0"), ("b", None, "b0"), (None, ["add"], "n")], [("a", ["remove", "remove"], "a1"), ("b", ["adjust", "remove"], "b1")], [("a", ["add", "add"], "A"), ("b", ["add", "add"], "B")]]
    for lot in lots:
        spark.createDataFrame(lot, kind).write.mode("append").parquet(f"{tmp_path}/tasks")
        stream = follow_turns(spark, f"{tmp_path}/tasks", kind, f"{tmp_path}/out", edit, "image string", f"{tmp_path}/state", ["compose_add", "compose_remove", "compose_adjust"])
        stream.processAllAvailable()
        plan = stream._jsq.explainInternal(True)
        stream.stop()
        assert "StateStoreSave" in plan and "Pandas" not in plan
    assert sorted(calls) == [("a", 0, "a0"), ("a", 1, "a0"), ("b", 0, "b1"), ("b", 1, "b1")]
    found = spark.read.parquet(f"{tmp_path}/out")
    assert sorted((r.task_id, r.turn, r.image) for r in found.collect()) == [("a", 0, "a0-0"), ("a", 1, "a0-1"), ("b", 0, "b1-0"), ("b", 1, "b1-1")]
