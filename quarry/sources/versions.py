"""Outputs in versions with an index of their keys (O-20, O-76): resuming reads only the files that may hold a task's key.

Below a root, version=N has the rows and _keys/version=N what is known of its files: the least and the greatest key of each,
and a filter of bits in words of 64, of which a key sets up to four in one. Both are tables. A version without an index
counts too, and is read whole. Keys are integers or strings; null is a key like any other.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions.names import unused
from quarry.operators.partition import written
from quarry.operators.resume import missing

from .writers import new_version

#: Bits of the filter for a key; files whose ranges the tasks search, beyond which all are read; pairs in one batch.
BITS_A_KEY, MOST_FILES, MOST_PAIRS = 16, 1_000_000, 1 << 20


def _kind(rows: DataFrame, key: str) -> str:
    """The type in which keys are hashed and compared, so that one key has one hash in tables of other widths."""
    kind = rows.select(key).schema[0].dataType
    if isinstance(kind, T.IntegralType):
        return "bigint"
    if isinstance(kind, T.StringType):
        return "string"
    raise ValueError(f"key {key} is {kind.simpleString()}, and neither an integer nor a string")


def _place(key: Column, blocks: Column) -> tuple[Column, Column]:
    """(word, bits in it) of a key in a filter of so many words."""
    h = F.xxhash64(key)
    bit = lambda k: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(h, k).bitwiseAND(63).cast("int"))
    mask = bit(0).bitwiseOR(bit(6)).bitwiseOR(bit(12)).bitwiseOR(bit(18))
    return F.pmod(F.shiftright(h, 24), blocks), mask


def add_version(rows: DataFrame, root: str, version: int, key: str, files: int | None = None) -> str:
    """rows as a version of their own, in files that hold ranges of the key, and its index; a version is never changed.

    A key of very many rows is spread over files. The rows are read twice, once to find the ranges, so costly rows should
    have been written before.
    """
    _kind(rows, key)
    (chance,) = unused(rows, "_chance")
    ranges = [F.col(key).asc_nulls_first(), F.col(chance)]
    ranged = rows.withColumn(chance, F.rand(7))
    ranged = ranged.repartitionByRange(files, *ranges) if files else ranged.repartitionByRange(*ranges)
    folder = new_version(ranged.sortWithinPartitions(*ranges).drop(chance), root, version)
    index_version(rows.sparkSession, root, version, key)
    return folder


def index_version(spark: SparkSession, root: str, version: int, key: str) -> None:
    """The index of a version that is there, however its files were made; an index is replaced. The table of files is its last
    part, and without that part there is no index."""
    rows = spark.read.parquet(f"{root}/version={version}")
    rows = rows.select(F.col(key).cast(_kind(rows, key)).alias("key"), F.col("_metadata.file_name").alias("name"))
    files = written(rows.groupBy("name").agg(F.count("*").alias("n"), F.count_if(F.col("key").isNull()).alias("nulls"), F.min("key").alias("low"), F.max("key").alias("high")))
    most = files.agg(F.max("n")).first()[0] or 1
    blocks = F.lit(1 << max(0, math.ceil(math.log2(most * BITS_A_KEY / 64)))).cast("long")
    own = [F.lit(version).cast("long").alias("version"), F.xxhash64("name").alias("file")]
    word, mask = _place(F.col("key"), blocks)
    bits = rows.where("key IS NOT NULL").select(*own, word.alias("word"), mask.alias("mask"))
    at = f"{root}/_keys/version={version}"
    bits.groupBy("version", "file", "word").agg(F.bit_or("mask").alias("bits")).write.mode("overwrite").parquet(f"{at}/bits")
    files.select(*own, "name", "n", "nulls", "low", "high", blocks.alias("blocks")).write.mode("overwrite").parquet(f"{at}/files")


def versions(spark: SparkSession, root: str) -> dict[int, bool]:
    """The versions below root, and whether each has an index."""
    place = spark._jvm.org.apache.hadoop.fs.Path
    store = place(root).getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(place(root)):
        return {}
    names = [f.getPath().getName() for f in store.listStatus(place(root))]
    numbers = sorted(int(n.removeprefix("version=")) for n in names if n.startswith("version="))
    return {v: store.exists(place(f"{root}/_keys/version={v}/files/_SUCCESS")) for v in numbers}


def _in_ranges(keys: DataFrame, files: list, kind: str) -> DataFrame:
    """(key, version, file, blocks) for the files whose range a key lies in, found in each task by bisection."""
    of: dict[int, list] = {}
    for f in sorted((f for f in files if f.low is not None), key=lambda f: (f.low, f.high)):
        of.setdefault(f.version, []).append(f)
    number = np.int64 if kind == "bigint" else object
    searched = []
    for version, own in of.items():
        low, high = (np.array([f[c] for f in own], number) for c in ("low", "high"))
        reach = np.maximum.accumulate(high)  # files before the first that reaches a key end below it, whatever their layout
        searched.append((version, low, high, reach, np.array([f.file for f in own]), own[0].blocks))

    def find(batches):
        for b in batches:
            key = b.column(0).to_numpy(zero_copy_only=False)
            for version, low, high, reach, ids, blocks in searched:
                start = np.searchsorted(reach, key, "left")
                n = np.maximum(np.searchsorted(low, key, "right") - start, 0)
                ends, first = np.cumsum(n), 0
                while first < len(key):
                    before = ends[first - 1] if first else 0
                    last = max(first + 1, int(np.searchsorted(ends, before + MOST_PAIRS, "right")))
                    who = np.repeat(np.arange(first, last), n[first:last])
                    file = start[who] + np.arange(len(who)) - (ends[who] - n[who] - before)
                    meet = np.flatnonzero((high[file] >= key[who]).astype(bool))
                    who, file, first = who[meet], file[meet], last
                    same = [np.full(len(who), x, np.int64) for x in (version, blocks)]
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(who)), pa.array(same[0]), pa.array(ids[file]), pa.array(same[1])], ["key", "version", "file", "blocks"])

    return keys.mapInArrow(find, f"key {kind}, version bigint, file bigint, blocks bigint")


def files_to_read(tasks: DataFrame, root: str, key: str) -> list[str]:
    """Paths of all files below root that may hold a key of the tasks; versions without an index are given whole.

    A file is left out if no task's key lies in its range and its filter. The table of files is brought to the driver, as
    Spark does with listings; beyond MOST_FILES of them, nothing is left out.
    """
    spark, kind = tasks.sparkSession, _kind(tasks, key)
    known = versions(spark, root)
    whole = [f"{root}/version={v}" for v, told in known.items() if not told]
    told = [v for v, t in known.items() if t]
    if not told:
        return whole
    table = spark.read.parquet(*[f"{root}/_keys/version={v}/files" for v in told])
    if _kind(table, "low") != kind:
        raise ValueError(f"key {key} is {kind} in the tasks and {_kind(table, 'low')} in the versions")
    files = table.limit(MOST_FILES + 1).collect()
    if len(files) > MOST_FILES:
        return whole + [f"{root}/version={v}" for v in told]
    keys = tasks.select(F.col(key).cast(kind).alias("key"))
    word, mask = _place(F.col("key"), F.col("blocks"))
    near = _in_ranges(keys.where("key IS NOT NULL").distinct(), files, kind).withColumn("word", word).withColumn("mask", mask)
    bits = spark.read.parquet(*[f"{root}/_keys/version={v}/bits" for v in told])
    met = near.join(bits, ["version", "file", "word"]).where(F.col("bits").bitwiseAND(F.col("mask")) == F.col("mask"))
    wanted = {tuple(r) for r in met.select("version", "file").distinct().collect()}
    empty = min((f for f in files if f.nulls), key=lambda f: f.n, default=None)
    if empty is not None and not keys.where("key IS NULL").isEmpty():
        wanted.add((empty.version, empty.file))  # one file tells that the null key is done
    return whole + sorted(f"{root}/version={f.version}/{f.name}" for f in files if (f.version, f.file) in wanted)


def missing_in_versions(tasks: DataFrame, root: str, key: str) -> DataFrame:
    """O-20: tasks whose key is in no version below root, as operators.resume.missing tells it of all their rows."""
    paths = files_to_read(tasks, root, key)
    if not paths:
        return tasks
    kind = T.StructType().add(key, T.LongType() if _kind(tasks, key) == "bigint" else T.StringType())
    return missing(tasks, tasks.sparkSession.read.schema(kind).parquet(*paths).distinct(), key)
