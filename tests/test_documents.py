"""Large documents, array and map sinks, files by path, artifacts of tasks."""

import json
import os
import random
import struct
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.functions import masks
from quarry.operators import models, partition, resume
from quarry.sources import documents, files, readers, writers


def value(r, depth=0):
    k = r.random()
    if k < 0.5 or depth > 3:
        return "".join(r.choice('ab"\\{}[],: é\n中') for _ in range(r.randint(0, 9))) if k < 0.35 else r.choice([1, 2.5, True, None])
    if k < 0.75:
        return [value(r, depth + 1) for _ in range(r.randint(0, 3))]
    return {f"{i}\"{{": value(r, depth + 1) for i in range(r.randint(0, 3))}


@pytest.mark.parametrize("size", [1, 7, 64, 10_000])
def test_entries_equal_the_plain_reader_at_every_border(spark, tmp_path, size, monkeypatch):
    monkeypatch.setattr(documents, "STEP", 5)
    r = random.Random(size)
    want = Counter()
    for k in range(6):
        n = [0, 1, 5, 9, 3, 4][k]
        doc = [value(r) for _ in range(n)] if k % 2 else {f"k{i}": value(r) for i in range(n)}
        text = json.dumps(doc, ensure_ascii=k < 3, indent=1 if k == 4 else None)
        (tmp_path / f"{k}.json").write_text(text)
        pairs = [(None, v) for v in doc] if k % 2 else list(doc.items())
        want.update((f"{k}.json", key, json.dumps(v)) for key, v in pairs)
    (tmp_path / "empty.json").write_text("")
    found = documents.json_entries(spark, str(tmp_path), "*.json", range_bytes=size).collect()
    assert Counter((os.path.basename(x.source_file), x.key, json.dumps(json.loads(x.text))) for x in found if not x.error) == want
    assert not [x for x in found if x.error]


def test_broken_entries_are_kept_apart(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": 1}, {"id" 2}, , {"id": 3} x, {"id": 4}]')
    (tmp_path / "b.json").write_text('{"k": {"id": 5}, 7: {"id": 6}, "l": {"id": 7}, "m": {"id": ')
    found = documents.json_entries(spark, str(tmp_path), range_bytes=9).orderBy("source_file", "at").collect()
    assert [(x.at, x.text, x.error) for x in found if x.error] == [
        (11, '{"id" 2}', documents.NO_VALUE), (21, "", documents.NO_VALUE), (23, '{"id": 3} x', documents.NO_VALUE),
        (16, '7: {"id": 6}', documents.NO_KEY), (46, '"m": {"id":', documents.CUT_SHORT),
    ]
    rows = readers.json_array(spark, f"{tmp_path}/a.json", "id int, _corrupt_record string").collect()
    assert sorted(map(tuple, rows), key=str) == sorted([(1, None), (None, '{"id" 2}'), (None, ""), (None, '{"id": 3} x'), (4, None)], key=str)
    kept = readers.keyed_items(spark, f"{tmp_path}/b.json", "struct<id:int,_corrupt_record:string>").collect()
    assert {(r.key, r.id) for r in kept if r._corrupt_record is None} == {("k", 5), ("l", 7)} and len(kept) == 4
    typed = documents.parsed(documents.json_entries(spark, f"{tmp_path}/b.json"), "int")
    assert typed.where("error IS NULL").count() == 0 and typed.count() == 4


def test_results_with_errors_there_and_back(spark, tmp_path):
    rows = [("a", 'said "x"\n{', None), ("b", None, "boom"), ('c"}', "", None), ("d", None, None), (None, "lost key", None)]
    writers.as_result_map(spark.createDataFrame(rows, "key string, text string, error string").repartition(3), f"{tmp_path}/r.json")
    assert json.load(open(tmp_path / "r.json")) == {"a": 'said "x"\n{', "b": {"error": "boom"}, 'c"}': "", "d": None}
    assert {tuple(r) for r in readers.result_map(spark, f"{tmp_path}/r.json").collect()} == {r for r in map(tuple, rows) if r[0]}


@pytest.mark.parametrize("n", [0, 1, 500])
def test_one_array_of_any_size(spark, tmp_path, n):
    rows = spark.range(n).select("id", F.concat(F.lit('say "'), "id").alias("text"), F.when(F.col("id") % 3 == 0, F.lit(1.5)).alias("x"))
    for _ in range(2):  # the second takes the place of the first
        writers.json_document(rows.repartition(7), f"{tmp_path}/all.json")
    assert sorted(json.load(open(tmp_path / "all.json")), key=lambda r: r["id"]) == [r.asDict() for r in rows.orderBy("id").collect()]
    assert os.listdir(tmp_path) == ["all.json"] or set(os.listdir(tmp_path)) == {"all.json", ".all.json.crc"}
    ordered = rows.orderBy("id")
    writers.json_document(ordered, f"{tmp_path}/all.json")
    assert [r["id"] for r in json.load(open(tmp_path / "all.json"))] == list(range(n))
    assert readers.json_array(spark, f"{tmp_path}/all.json", "id long").count() == n


def test_edit_types_are_written_side_by_side(spark, tmp_path):
    rows = lambda *x: spark.createDataFrame([(t, k) for k, t in enumerate(x)], "edit_type string, k int")
    writers.by_edit_type(rows("add", "add"), f"{tmp_path}/t")
    writers.by_edit_type(rows("remove"), f"{tmp_path}/t")
    writers.by_edit_type(rows("add"), f"{tmp_path}/t")
    assert Counter(r.edit_type for r in spark.read.parquet(f"{tmp_path}/t").collect()) == {"add": 1, "remove": 1}


def test_passes_do_a_null_key_once(spark, tmp_path):
    tasks = spark.createDataFrame([("a",), (None,), ("b",)], "key string")
    tried = []

    def work(df):
        tried.append(df.count())
        return df.where("key IS NULL OR key <> 'b'")

    assert resume.in_passes(tasks, "key", f"{tmp_path}/sink", work).count() == 2 and tried == [0, 3, 1, 1]


def test_columns_with_clashing_names_stay(spark, tmp_path):
    rows = spark.createDataFrame([("p", "old", 1, 2)], "prompt string, answer string, error int, boxes int")
    found = models.answered(rows, models.EchoClient)
    assert found.columns == [*rows.columns, "_answer", "_error"] and found.first()._answer.startswith("prompt: edit")
    images = spark.createDataFrame([(b"x", ["a"], 3)], "content binary, labels array<string>, boxes int")
    assert models.detected(images, lambda: lambda content, labels: []).first()._boxes == []
    names = "k string, _range int, _inside int, _index int, _rows int, _before int, _total int, _n int"
    rows = spark.createDataFrame([("b", 1, 2, 3, 4, 5, 6, 7), ("a", 1, 2, 3, 4, 5, 6, 7)], names)
    for split in (partition.contiguous, partition.strided):
        assert split(rows, "k", 2).columns == [*rows.columns, "part"]
        assert {(r.k, r.part, r._range, r._total) for r in split(rows, "k", 2).collect()} == {("a", 0, 1, 6), ("b", 1, 1, 6)}


def test_a_cluster_on_this_machine_needs_a_shared_folder():
    from types import SimpleNamespace

    context = SimpleNamespace(getCheckpointDir=lambda: None, master="local-cluster[2,1,1024]")
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda *_: None))
    with pytest.raises(ValueError, match="checkpoint"):
        partition.written(SimpleNamespace(sparkSession=session))


def image_files(tmp_path, n=4, size=1000):
    for k in range(n):
        (tmp_path / f"{k} é.png").write_bytes(bytes([k]) * size)
    return [f"{k} é.png" for k in range(n)]


def test_pixels_by_path(spark, tmp_path):
    (tmp_path / "in").mkdir()
    names = image_files(tmp_path / "in")
    rows = [(f"{k} é", names[k], "p", k) for k in range(4)] + [("gone", "nowhere.png", "p", 9)]
    items = spark.createDataFrame(rows, "key string, id string, prompt string, _path int")
    listed = files.listing(spark, f"{tmp_path}/in")
    out = readers.with_images(items, listed, f"{tmp_path}/in", f"file://{tmp_path}/in/", most_bytes=1500)
    assert out.columns == [*items.columns, "original", "result"]
    assert {r._path: (r.original and len(r.original), r.result and r.result[0]) for r in out.collect()} == {k: (1000, k) for k in range(4)} | {9: (None, None)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("MapInArrow", 1)[-1]
    found = readers.with_paths(items, listed, readers.image_places(f"{tmp_path}/in", f"{tmp_path}/in"))

    def make():
        return lambda prompt, a, b: f"{len(a)}+{b[0]}"

    told = {r.key: (r.answer, r.error) for r in models.answered_with_files(found, make, most_bytes=1).collect()}
    assert told == {f"{k} é": (f"1000+{k}", None) for k in range(4)} | {"gone": (None, "image missing")}
    motion = spark.createDataFrame([(1, names[0], names[1]), (2, names[0], "gone"), (3, None, names[1])], "id int, start_frame string, end_frame string")
    captions = models.motion_captions_below(motion, listed, f"{tmp_path}/in", make, "say").collect()
    assert [(r.id, r.prompt) for r in captions] == [(1, "1000+1")] and captions[0].asDict().keys() == {"id", "start_frame", "end_frame", "prompt", "error"}


def test_a_task_holds_bounded_bytes():
    assert list(files.held_together([4, 4, 4, 20, 1, 1], 8)) == [(0, 2), (2, 3), (3, 4), (4, 6)] and list(files.held_together([], 8)) == []
    import threading

    budget, held, most = models.ByteBudget(10), [], []

    def work(n):
        with budget.holding(n):
            held.append(n)
            most.append(sum(held))
            held.remove(n)

    threads = [threading.Thread(target=work, args=(n,)) for n in (4, 4, 4, 30, 4) * 20]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(most) == 100 and all(m <= 10 or m == 30 for m in most)


def pixels_of(data):
    """Pixels of a PNG file without filters."""
    at, out = 8, b""
    while at < len(data):
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        if kind == b"IHDR":
            width, height, bits, colour = struct.unpack(">IIBB", data[at + 8 : at + 18])
        out += data[at + 8 : at + 8 + n] if kind == b"IDAT" else b""
        assert struct.unpack(">I", data[at + 8 + n : at + 12 + n])[0] == zlib.crc32(data[at + 4 : at + 8 + n])
        at += 12 + n
    lines = np.frombuffer(zlib.decompress(out), np.uint8).reshape(height, -1)
    return lines[:, 1:], colour


def test_artifacts_of_tasks(spark, tmp_path, monkeypatch):
    mask = np.zeros((5, 7), np.uint8)
    mask[1:3, 2:6] = 1
    picture = writers.png(bytes(range(30)), 2, 5, 3)
    rows = [("a/b", picture, picture, masks.encode(mask), 5, 7, "say"), ("c", picture, None, None, 1, 1, "no")]
    rows = spark.createDataFrame(rows, "task_id string, original binary, result binary, mask string, height int, width int, prompt string")
    (tmp_path / "a/b").mkdir(parents=True)
    (tmp_path / "a/b/original.png").write_bytes(b"left by an attempt that was killed")
    told = lambda: {r.folder: (r.written, r.error) for r in writers.task_artifacts(rows, str(tmp_path)).collect()}
    assert told() == {"a/b": (True, None), "c": (False, "an image is missing")}
    assert sorted(os.listdir(tmp_path / "a/b")) == ["mask.png", "original.png", "result.json", "result.png"] and not (tmp_path / "c").exists()
    region, colour = pixels_of((tmp_path / "a/b/mask.png").read_bytes())
    assert colour == 0 and (region == (1 - mask) * 255).all() and (tmp_path / "a/b/original.png").read_bytes() == picture
    assert pixels_of(picture)[0].tobytes() == bytes(range(30))
    assert json.load(open(tmp_path / "a/b/result.json")) == {"task_id": "a/b", "mask": "", "height": 5, "width": 7, "prompt": "say"}
    assert told()["a/b"] == (False, None)  # done: left alone


def test_lines_folders_and_paths(spark, tmp_path):
    (tmp_path / "styles.txt").write_text(" a/1.jpg \n\n\tb.jpg\n")
    assert [r.path for r in readers.lines(spark, f"{tmp_path}/styles.txt").collect()][0] == "a/1.jpg"
    (tmp_path / "deep/x").mkdir(parents=True)
    for k, place in enumerate(("add.json", "deep/add.json", "deep/x/add.json", "deep/remove.json")):
        (tmp_path / place).write_text(json.dumps({"path": f" p{k} "}, indent=1))
    read = lambda **x: {(r.path.strip(), os.path.basename(r.source_file)) for r in readers.json_folder(spark, str(tmp_path), "path string", **x).collect()}
    assert read() == {("p0", "add.json")}
    assert read(name="add.json", deep=True) == {(f"p{k}", "add.json") for k in range(3)} and len(read(deep=True)) == 4
    (tmp_path / "list.json").write_text('[{"path": "x.jpg", "n": 1}, {"n": 2}, {"path": " y.jpg"}]')
    assert sorted(r.path for r in readers.json_paths(spark, f"{tmp_path}/list.json").collect()) == ["x.jpg", "y.jpg"]
