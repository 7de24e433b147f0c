"""Resuming work and joining its outputs (O-13, O-20, O-72, O-85, O-94)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.names import unused


def missing(tasks: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Tasks whose key has no output yet; a null key is done once there is an output with a null key."""
    (name,) = unused(tasks, "_done")
    made = done.select(F.col(key).alias(name))
    return tasks.join(made, tasks[key].eqNullSafe(made[name]), "left_anti")


def merged(*parts: DataFrame) -> DataFrame:
    """All rows of all parts, duplicates kept; columns that a part lacks are null."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def valid(tasks: DataFrame, required: list[str]) -> tuple[DataFrame, DataFrame]:
    """(rows with all required fields, the rest with the names of what they lack)."""
    lacking = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]), lambda x: x.isNotNull())
    marked = tasks.withColumn("missing_fields", lacking)
    return marked.where(F.size("missing_fields") == 0).drop("missing_fields"), marked.where(F.size("missing_fields") > 0)


def in_passes(tasks: DataFrame, key: str, sink: str, work: Callable[[DataFrame], DataFrame], passes: int = 3) -> DataFrame:
    """Work on what the sink lacks and append it, up to so many times; gives the sink's rows.

    work may drop rows that failed: they are tried again in the next pass.
    """
    spark = tasks.sparkSession
    work(tasks.limit(0)).write.mode("append").parquet(sink)
    for _ in range(passes):
        left = missing(tasks, spark.read.parquet(sink), key)
        if left.isEmpty():
            break
        work(left).write.mode("append").parquet(sink)
    return spark.read.parquet(sink)
