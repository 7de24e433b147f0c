"""Splitting a list into parts (O-69, O-70) without bringing it into one task.

Rows are sorted into ranges of the key, as many as Spark makes of them, and numbered inside each; the running total
is over one row for each range. The ranges are sampled, so what they gave is written to the checkpoint folder before
it is counted: both steps then see the same rows, and a lost executor costs nothing.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.functions.names import unused


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which driver and executors share; only a local session, whose tasks run in this
    process, may go without and gets one of its own."""
    folder = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder or tempfile.mkdtemp(prefix="quarry-"))
    return spark.sparkContext.getCheckpointDir()


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(rows: DataFrame) -> DataFrame:
    """A checkpoint in the shared folder."""
    shared_folder(rows.sparkSession)
    return rows.checkpoint()


def indexed(rows: DataFrame, key: str, name: str = "index", total: str | None = None) -> DataFrame:
    """rows with the place of each by key, from 0 on, in column name, and the number of rows in column total if it is
    named; null keys come first. Equal keys share a range, so the key should be unique, or nearly."""
    ordered = rows.repartitionByRange(F.col(key).asc_nulls_first()).sortWithinPartitions(F.col(key).asc_nulls_first())
    inside = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)  # its low bits count the rows of a task
    part, place, n, start, whole = unused(rows, "_range", "_inside", "_n", "_before", "_total")
    dealt = written(ordered.withColumn(part, F.spark_partition_id()).withColumn(place, inside))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy(part).agg(F.count("*").alias(n))
    starts = starts.select(part, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(start), F.sum(n).over(Window.partitionBy()).alias(whole))
    out = dealt.join(F.broadcast(starts), part).withColumn(name, F.col(start) + F.col(place))  # a row a range
    out = out.withColumn(total, F.col(whole)) if total else out
    return out.drop(part, place, start, whole)


def contiguous(rows: DataFrame, key: str, parts: int) -> DataFrame:
    """O-69: slices of nearly one size, the larger ones first, in column part."""
    index, count = unused(rows, "_index", "_rows")
    i, n = F.col(index), F.col(count)
    small, larger = F.floor(n / parts), n % parts
    edge = larger * (small + 1)
    part = F.when(i < edge, F.floor(i / (small + 1))).otherwise(larger + F.floor((i - edge) / F.greatest(F.lit(1), small)))
    return indexed(rows, key, index, count).withColumn("part", part.cast("long")).drop(index, count)


def strided(rows: DataFrame, key: str, parts: int) -> DataFrame:
    """O-70: every parts-th row, in column part."""
    (index,) = unused(rows, "_index")
    return indexed(rows, key, name=index).withColumn("part", F.pmod(F.col(index), F.lit(parts)).cast("long")).drop(index)
