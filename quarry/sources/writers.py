"""Sinks (O-74 to O-80). Parquet by edit type is the canonical form; ids are columns, never file names."""

from __future__ import annotations

import struct
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.masks import decode

from .files import located

#: Entries of a map that is written as one document.
MOST_ENTRIES = 100_000


def by_edit_type(rows: DataFrame, folder: str) -> None:
    """O-75: one folder for each edit type. Types that rows have are replaced, all others stay as they are."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("edit_type").parquet(folder)


def as_json(rows: DataFrame, folder: str) -> None:
    """O-74: a record a line, in as many files as the rows have partitions."""
    rows.write.mode("overwrite").json(folder)


def as_json_map(rows: DataFrame, folder: str, key: str, value: str) -> None:
    """O-74, O-78, O-79: small results, as scores, in one file with one document {key: value, ...}, ordered by key.

    A document is one row, so there may be MOST_ENTRIES at most; more are an error, and belong into as_json().
    Null keys are left out; of equal keys, the one with the greatest value is taken.
    """
    best = rows.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("string").alias("k")).agg(F.max(value).alias("v"))
    if best.limit(MOST_ENTRIES + 1).count() > MOST_ENTRIES:
        raise ValueError(f"more than {MOST_ENTRIES} entries for one document")
    entries = F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "v"))))
    best.agg(F.to_json(entries, {"ignoreNullFields": "false"}).alias("value")).coalesce(1).write.mode("overwrite").text(folder)


def json_document(rows: DataFrame, path: str, key: str | None = None, value: Column | None = None) -> None:
    """O-74, O-78, O-79: all rows as one file of any size with one JSON array of records, or one map {key: value, ...}.

    value is JSON text, all other columns as a record where it is not given. Every task writes a part with its own commas;
    empty parts go, and the commit puts brackets and commas between the parts and joins them, by the file system itself
    where it can, else as a stream of bytes, which holds nothing but a buffer. The file appears under its name only when it is
    whole. Rows keep their order. In a map, rows with a null key go; keys are not made unique.
    """
    if key is not None:
        rows = rows.where(F.col(key).isNotNull())
    record = F.to_json(F.struct(*[F.col(c) for c in rows.columns if c != key]), {"ignoreNullFields": "false"}) if value is None else value
    if key is not None:
        record = F.concat(_json_text(F.col(key).cast("string")), F.lit(": "), F.coalesce(record, F.lit("null")))
    first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0  # of its task
    parts = f"{path}._parts-{uuid.uuid4().hex}"
    rows.select(F.concat(F.when(first, "").otherwise(","), record).alias("value")).write.text(parts)
    _joined(rows.sparkSession, parts, path, "[]" if key is None else "{}")


def _json_text(text: Column) -> Column:
    """A text as JSON writes it."""
    listed = F.to_json(F.array(text))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def _joined(spark: SparkSession, folder: str, path: str, brackets: str) -> None:
    """The parts in folder as one file at path, between brackets and with commas; folder goes."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path
    store = place(path).getFileSystem(conf)
    files = sorted((f.getPath().toString() for f in store.listStatus(place(folder)) if f.getPath().getName().startswith("part-") and f.getLen()))

    def small(name: str, text: str) -> str:
        out = store.create(place(f"{folder}/{name}"), True)
        out.write(bytearray(text.encode()))
        out.close()
        return f"{folder}/{name}"

    pieces = [small("frame-open", f"{brackets[0]}\n")]
    for k, file in enumerate(files):
        pieces += [file] if not k else [small(f"frame-{k}", ","), file]
    pieces.append(small("frame-shut", brackets[1]))
    try:
        store.concat(place(pieces[0]), _paths(spark, pieces[1:]))
        whole = pieces[0]
    except Exception:  # most file systems cannot
        whole = f"{folder}/whole"
        out = store.create(place(whole), True)
        for piece in pieces:
            data = store.open(place(piece))
            jvm.org.apache.hadoop.io.IOUtils.copyBytes(data, out, conf, False)
            data.close()
        out.close()
    if store.exists(place(path)):
        store.delete(place(path), True)
    if not store.rename(place(whole), place(path)):
        raise OSError(f"{path} could not be written")
    store.delete(place(folder), True)


def _paths(spark: SparkSession, names: list[str]):
    out = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Path, len(names))
    for k, name in enumerate(names):
        out[k] = spark._jvm.org.apache.hadoop.fs.Path(name)
    return out


def as_result_map(rows: DataFrame, path: str) -> None:
    """O-78: rows(key, text, error) as one document {key: text, or {"error": error} where there is one}."""
    failed = F.to_json(F.struct("error"))
    json_document(rows, path, "key", F.when(F.col("error").isNotNull(), failed).otherwise(_json_text(F.col("text"))))


def new_version(rows: DataFrame, root: str, version: int) -> str:
    """O-76: rows as a version of their own below root; what is there is never changed, and writing it anew an error."""
    folder = f"{root}/version={version}"
    rows.write.mode("errorifexists").parquet(folder)
    return folder


def results(rows: DataFrame, folder: str) -> None:
    """O-77, O-78: results as rows, without their masks."""
    blank = rows.withColumn("mask", F.lit("")) if "mask" in rows.columns else rows
    blank.write.mode("overwrite").parquet(folder)


def png(pixels: bytes, height: int, width: int, channels: int = 1) -> bytes:
    """A PNG file of 8-bit pixels, row by row: grey (1 channel), RGB (3) or RGBA (4)."""
    piece = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    row = width * channels
    lines = b"".join(b"\0" + pixels[k * row : (k + 1) * row] for k in range(height))
    head = struct.pack(">IIBBBBB", width, height, 8, {1: 0, 3: 2, 4: 6}[channels], 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + piece(b"IHDR", head) + piece(b"IDAT", zlib.compress(lines)) + piece(b"IEND", b"")


MARKER = "result.json"


def task_artifacts(rows: DataFrame, root: str, folder: str = "task_id") -> DataFrame:
    """O-77: a folder for each row below root with original.png, mask.png, result.png and, last of all, result.json.

    rows: the folder's name, original and result as bytes of PNG files, mask as run-length text with height and width; all
    other columns are in result.json, the mask as an empty text. result.json marks a task as done: what has it is left alone,
    so an attempt that was killed is done again and a second run writes only what lacks. Every file is written under
    another name and moved, so none is ever seen in part. Gives (folder, written, error); nothing is written before it is read.
    """
    told = F.to_json(F.struct(*[F.lit("").alias(c) if c == "mask" else F.col(c) for c in rows.columns if c not in ("original", "result")]), {"ignoreNullFields": "false"})
    asked = rows.select(F.col(folder).cast("string").alias("folder"), "original", "result", "mask", F.col("height").cast("int"), F.col("width").cast("int"), told.alias("told"))
    kinds = pa.schema([("folder", pa.string()), ("written", pa.bool_()), ("error", pa.string())])

    def run(batches):
        store, base = located(root)
        for b in batches:
            for i in range(b.num_rows):  # one row's images at a time
                name, original, result, mask, height, width, text = (b.column(c)[i].as_py() for c in range(7))
                try:
                    written, error = _put(store, f"{base}/{name}", original, result, mask, height, width, text), None
                except Exception as e:  # one bad row must not end the job
                    written, error = False, str(e)
                yield pa.RecordBatch.from_pylist([{"folder": name, "written": written, "error": error}], kinds)

    return asked.mapInArrow(run, "folder string, written boolean, error string")


def _put(store, folder: str, original: bytes, result: bytes, mask: str | None, height: int, width: int, told: str) -> bool:
    if store.get_file_info(f"{folder}/{MARKER}").type == fs.FileType.File:
        return False
    if original is None or result is None:
        raise ValueError("an image is missing")
    pieces = {"original.png": original, "result.png": result, MARKER: told.encode()}
    if mask is not None:
        region = ((1 - decode(mask, height, width)) * 255).astype("uint8")
        pieces = {"mask.png": png(region.tobytes(), height, width), **pieces}
    store.create_dir(folder, recursive=True)
    for name, data in pieces.items():  # the marker is the last
        at = f"{folder}/._{name}-{uuid.uuid4().hex}"
        with store.open_output_stream(at) as out:
            out.write(data)
        store.move(at, f"{folder}/{name}")
    return True
