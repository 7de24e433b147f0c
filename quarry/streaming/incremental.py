"""Folders that fill up while they are worked on: the checkpoint remembers which files were done (O-20)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def follow(
    spark: SparkSession,
    source: str,
    schema: StructType | str,
    work: Callable[[DataFrame], DataFrame],
    sink: str,
    checkpoint: str,
    files_per_batch: int = 1000,
) -> StreamingQuery:
    """Apply work to Parquet files of source that are new since the last call, append to sink, and stop."""
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source)
    writer = work(rows).writeStream.format("parquet").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start(sink)


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events by type and window of time; works on a stream, where a window closes once late has passed, and on a table."""
    marked = events.withWatermark("ts", late) if events.isStreaming else events
    out = marked.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").alias("window_start"), "event_type", "n", "total")
