"""Calls of models (O-22, O-81 to O-90): rows through a client that every task makes for itself.

A client is opaque: it gets the values of the asked columns and gives a text, or boxes. Each task keeps a bounded
number of requests in flight. Write the result before it is read twice, so that no call is repeated.
"""

from __future__ import annotations

import hashlib
import re
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from threading import Condition

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.names import unused
from quarry.operators.detect import class_kind
from quarry.sources.files import contents, size_of
from quarry.sources.readers import with_paths

Client = Callable[..., str]
#: Requests that a task keeps in flight.
THREADS = 8
BOX = "struct<class_name:string,bbox:array<double>,score:double,mask:string>"
NO_IMAGE = "image missing"
#: Bytes of images that a task holds while it asks.
MOST_BYTES = 256 << 20


class EchoClient:
    """A stand-in without a network: the same answer for the same prompt and images."""

    def __call__(self, prompt: str, *images: bytes) -> str:
        mark = hashlib.md5(b"|".join([prompt.encode(), *images])).hexdigest()[:8]
        return f"prompt: edit {mark}, result: object {mark}"


def with_retries(client: Client, attempts: int = 3, least_wait: float = 2.0, most_wait: float = 10.0) -> Client:
    """O-83: waits double between attempts; the last error is raised."""

    def call(*asked) -> str:
        for k in range(attempts):
            try:
                return client(*asked)
            except Exception:
                if k + 1 == attempts:
                    raise
                time.sleep(min(most_wait, least_wait * 2**k))

    return call


def until_match(client: Client, regex: str, attempts: int = 3) -> Client:
    """O-84: ask again until the answer has the form; the last answer is given otherwise."""

    def call(*asked) -> str:
        answer = ""
        for _ in range(attempts):
            answer = client(*asked).replace("\n", "").strip("` ")
            if re.match(regex, answer):
                break
        return answer

    return call


def _asked(rows: DataFrame, columns: tuple[str, ...], make_client: Callable, ask: Callable, name: str, kind: str, threads: int) -> DataFrame:
    """rows with columns name and error: ask(client, values) in threads, one batch at a time, in the rows' order.

    Where rows has a column of such a name, the new one takes it with an underscore before it.
    """
    name, error = unused(rows, name, "error")
    out = T.StructType([*rows.schema.fields, *T.StructType.fromDDL(f"{name} {kind}, {error} string").fields])
    where = [rows.columns.index(c) for c in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        client = make_client()

        def one(values):
            try:
                return ask(client, values)
            except Exception as e:  # one bad row must not end the job
                return None, str(e)

        with ThreadPoolExecutor(threads) as pool:
            for b in batches:
                found = list(pool.map(one, zip(*(b.column(i).to_pylist() for i in where))))
                kinds = _arrow(kind), pa.string()
                yield pa.RecordBatch.from_arrays([*b.columns, *(pa.array([x[k] for x in found], t) for k, t in enumerate(kinds))], out.fieldNames())

    return rows.mapInArrow(run, out)


def _arrow(kind: str) -> pa.DataType:
    if kind == "string":
        return pa.string()
    return pa.list_(pa.struct([("class_name", pa.string()), ("bbox", pa.list_(pa.float64())), ("score", pa.float64()), ("mask", pa.string())]))


def answered(rows: DataFrame, make_client: Callable[[], Client], prompt: str = "prompt", threads: int = THREADS) -> DataFrame:
    """O-81, O-90: rows with columns answer and error (O-50); a null prompt is not asked."""
    ask = lambda client, v: (None, None) if v[0] is None else (client(v[0]), None)
    return _asked(rows, (prompt,), make_client, ask, "answer", "string", threads)


def answered_with_images(
    rows: DataFrame, make_client: Callable[[], Client], prompt: str = "prompt", images: tuple[str, ...] = ("original", "result"), threads: int = THREADS
) -> DataFrame:
    """O-82: rows with columns answer and error. The client gets the prompt and the images' bytes; a row without its
    prompt is not asked, one that lacks an image has that as its error."""

    def ask(client, values):
        if values[0] is None:
            return None, None
        return (None, NO_IMAGE) if None in values[1:] else (client(*values), None)

    return _asked(rows, (prompt, *images), make_client, ask, "answer", "string", threads)


class ByteBudget:
    """Lets threads hold so many bytes at once, or one of them any number."""

    def __init__(self, most: int):
        self.most, self.held, self.free = most, 0, Condition()

    @contextmanager
    def holding(self, n: int):
        with self.free:
            self.free.wait_for(lambda: not self.held or self.held + n <= self.most)
            self.held += n
        try:
            yield
        finally:
            with self.free:
                self.held -= n
                self.free.notify_all()


def answered_with_files(
    rows: DataFrame, make_client: Callable[[], Client], prompt: str = "prompt", paths: tuple[str, ...] = ("original", "result"), threads: int = THREADS, most_bytes: int = MOST_BYTES
) -> DataFrame:
    """O-82 by paths, as of readers.with_paths(): images are read when their row is asked, so that they are in no shuffle
    and no batch; a task holds most_bytes of them, or one row's. A null path, or one without a file, is the row's error."""
    budget: list[ByteBudget] = []

    def ask(client, values):
        if values[0] is None:
            return None, None
        if not budget:
            budget.append(ByteBudget(most_bytes))
        sizes = [size_of(p) for p in values[1:]]
        if not all(sizes):
            return None, NO_IMAGE
        with budget[0].holding(sum(sizes)):
            return client(values[0], *map(contents, values[1:])), None

    return _asked(rows, (prompt, *paths), make_client, ask, "answer", "string", threads)


def motion_captions_below(records: DataFrame, files: DataFrame, folder: str, make_client: Callable[[], Client], instruction: str, threads: int = THREADS) -> DataFrame:
    """O-19, O-22: records(start_frame, end_frame, ...) with frames named below folder, as far as both are named and
    files(path), a listing, has both; with their caption in column prompt, and error. Frames are read in the tasks."""
    start, end, said = unused(records, "_start", "_end", "_instruction")
    named = records.drop("prompt").where("start_frame <> '' AND end_frame <> ''")
    at = {c: F.concat(F.lit(folder.rstrip("/") + "/"), F.col(name)) for c, name in ((start, "start_frame"), (end, "end_frame"))}
    both = with_paths(named, files, at).where(F.col(start).isNotNull() & F.col(end).isNotNull()).withColumn(said, F.lit(instruction))
    told = answered_with_files(both, make_client, said, (start, end), threads)
    return told.withColumnRenamed(told.columns[-2], "prompt").drop(start, end, said)


def motion_captions(records: DataFrame, files: DataFrame, make_client: Callable[[], Client], instruction: str, threads: int = THREADS) -> DataFrame:
    """O-19, O-22: records(start_frame, end_frame, ...), as far as both are named and both files(path, content) exist,
    with their caption in column prompt, and error."""
    known = lambda name: files.select(F.col("path").alias(name), F.col("content").alias(f"_{name}"))
    both = records.drop("prompt").where("start_frame <> '' AND end_frame <> ''").join(known("start_frame"), "start_frame").join(known("end_frame"), "end_frame")
    asked = both.withColumn("_instruction", F.lit(instruction))
    told = answered_with_images(asked, make_client, "_instruction", ("_start_frame", "_end_frame"), threads)
    return told.withColumnRenamed("answer", "prompt").drop("_instruction", "_start_frame", "_end_frame")


def detected(images: DataFrame, make_detector: Callable, labels: str = "labels", threads: int = 1) -> DataFrame:
    """O-86: images(content, labels, ...) with columns boxes, an array of class_name, bbox, score and mask, and error.

    The detector, one for each task, gets the image's bytes and the list of labels (O-73) and gives a list of dicts.
    """

    def ask(client, values):
        return (None, NO_IMAGE) if values[0] is None else (client(values[0], values[1] or []), None)

    return _asked(images, ("content", labels), make_detector, ask, "boxes", f"array<{BOX}>", threads)


def detections(found: DataFrame, objects: Column, backgrounds: Column) -> DataFrame:
    """O-87: detected rows as one row a box, with its place idx, class_name, bbox, score, mask, and kind (O-54).

    A class in neither list has an error in its own row, and leaves the other boxes of its image alone.
    """
    kept = [c for c in found.columns if c not in ("boxes", "error", "content")]
    lists = found.withColumn("_objects", objects).withColumn("_backgrounds", backgrounds)
    rows = lists.select(*kept, "_objects", "_backgrounds", F.posexplode("boxes").alias("idx", "_box")).select(*kept, "idx", "_objects", "_backgrounds", "_box.*")
    kind = class_kind(F.col("class_name"), F.col("_objects"), F.col("_backgrounds"))
    error = F.when(kind.isNull(), F.concat(F.lit("unknown class "), F.coalesce("class_name", F.lit("null"))))
    return rows.withColumn("kind", kind).withColumn("error", error).drop("_objects", "_backgrounds")
