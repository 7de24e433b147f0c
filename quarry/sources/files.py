"""Files by their paths, as Spark lists them, inside tasks: any file system that pyarrow knows, local ones included."""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

#: Bytes of files that a task holds at once, if one alone is not larger, and files that it reads at once.
MOST_BYTES, THREADS = 64 << 20, 8


def listing(spark: SparkSession, path: str, name: str = "*", deep: bool = False) -> DataFrame:
    """(path, length) of files; their contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", name).option("recursiveFileLookup", deep).load(path)
    return files.select("path", "length")


def located(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, with or without a scheme, and the path in it."""
    if re.match("file:/", path):
        return fs.LocalFileSystem(), unquote(re.sub("^file:/+", "/", path))
    if re.match("[A-Za-z][A-Za-z0-9+.-]*://", path):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


def contents(path: str) -> bytes:
    store, place = located(path)
    with store.open_input_file(place) as f:
        return f.read()


def size_of(path: str | None) -> int:
    """Bytes of a file; 0 if there is none."""
    if path is None:
        return 0
    store, place = located(path)
    info = store.get_file_info(place)
    return info.size if info.type == fs.FileType.File else 0


def held_together(sizes: list[int], most: int):
    """Runs (first, last + 1) of rows whose sizes sum to most at most, or of one row."""
    first, held = 0, 0
    for k, n in enumerate(sizes):
        if k > first and held + n > most:
            yield first, k
            first, held = k, 0
        held += n
    if sizes:
        yield first, len(sizes)


def with_contents(rows: DataFrame, columns: dict[str, str], most_bytes: int = MOST_BYTES, threads: int = THREADS) -> DataFrame:
    """rows with the contents of the files that columns name: {column of paths: new column}; null where there is no file.

    Files are read inside the tasks, a few at once, and rows are handed on in batches of most_bytes, so that contents
    are in no shuffle and a task holds no more of them than that, or one row's.
    """
    kind = T.StructType([*rows.schema.fields, *[T.StructField(c, T.BinaryType()) for c in columns.values()]])
    where = [rows.columns.index(c) for c in columns]

    def read(path):
        return contents(path) if path is not None and size_of(path) else None

    def run(batches):
        with ThreadPoolExecutor(threads) as pool:
            for b in batches:
                paths = [b.column(i).to_pylist() for i in where]
                sizes = list(pool.map(lambda row: sum(map(size_of, row)), zip(*paths)))
                for first, end in held_together(sizes, most_bytes):
                    found = [pa.array(list(pool.map(read, p[first:end])), pa.binary()) for p in paths]
                    yield pa.RecordBatch.from_arrays([*b.slice(first, end - first).columns, *found], kind.fieldNames())

    return rows.mapInArrow(run, kind)
