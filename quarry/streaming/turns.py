"""Turns of edit tasks as a stream (O-60): the twin of tasks.run_turns(), for folders of tasks that fill up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from quarry.operators.partition import written
from quarry.operators.tasks import TURNS, ready_turn

#: Columns of a result beyond those that edit adds.
RESULT = "task_id string, turn long, driver string, source string, last boolean, failed boolean"


def _tired(failed: Column, done: Column, attempts: int) -> Column:
    """Whether a turn without a result has failed attempts times; failed holds a turn once for each failure."""
    return F.exists(F.array_distinct(failed), lambda t: ~F.array_contains(done, t) & (F.size(F.filter(failed, lambda x: x == t)) >= attempts))


def follow_turns(
    spark: SparkSession,
    source: str,
    schema: StructType | str,
    sink: str,
    edit: Callable[[DataFrame], DataFrame],
    made: StructType | str,
    checkpoint: str,
    drivers: list[str] | None = None,
    attempts: int = 3,
) -> StreamingQuery:
    """Start the stream: Parquet files of tasks(task_id string, operations, ...) that come into source are run turn by turn.

    edit gets tasks with column next (driver, turn, source, last), as in run_turns(), and gives them back with its results, columns made;
    rows that it leaves out have failed, and are asked anew until they failed attempts times. Results are Parquet in sink,
    a folder for each batch that is overwritten when the batch is repeated, so that a lost driver makes no turn twice in the sink.
    The stream reads that folder too: a result is the event that lets its task go on. Its rows are (task_id, turn, driver, source,
    last, failed, columns of made, batch). Each task's state is its row, the turns that have a result, and those that failed: a streaming
    aggregate, so batches read no task again. Let large rows be kept on disk, by Spark's RocksDB state store. Of rows with the same
    id and operations that are not null the one of the earliest batch counts, the first as JSON if one batch brings several; tasks
    without an id are left out. A task whose turn failed for good stays where it is. processAllAvailable() waits until no task can go on.
    """
    drivers = drivers or sorted({t.driver for t in TURNS})
    made = StructType.fromDDL(made) if isinstance(made, str) else made
    kind = StructType([*StructType.fromDDL(RESULT).fields, *made.fields])
    spark.createDataFrame([], kind).write.mode("append").parquet(f"{sink}/batch=-1")
    tasks = spark.readStream.schema(schema).parquet(source).where("task_id IS NOT NULL")
    results = spark.readStream.schema(StructType([*kind.fields]).add("batch", "long")).parquet(sink)
    row = F.struct(*tasks.columns)
    came = tasks.select("task_id", row.alias("task"), F.when(F.col("operations").isNotNull(), F.struct(F.current_timestamp().alias("at"), F.to_json(row).alias("text"))).alias("order"))
    made_or_not = results.select("task_id", F.when(~F.col("failed"), F.col("turn")).alias("good"), F.when(F.col("failed"), F.col("turn")).alias("bad"), (F.col("last") & ~F.col("failed")).alias("ends"))
    states = (
        came.unionByName(made_or_not, allowMissingColumns=True)
        .groupBy("task_id")
        .agg(F.min_by("task", "order").alias("task"), F.collect_set("good").alias("done"), F.collect_list("bad").alias("failed"), F.bool_or("ends").alias("ended"))
    )

    def run(changed: DataFrame, batch: int) -> None:
        able = changed.where(F.col("task").isNotNull() & ~F.coalesce("ended", F.lit(False)) & ~_tired(F.col("failed"), F.col("done"), attempts))
        todo = written(able.select("task.*", ready_turn(F.col("task.operations"), F.col("done"), drivers, new=True).alias("next")).where("next IS NOT NULL"))
        if todo.isEmpty():
            return
        folder, step = f"{sink}/batch={batch}", [F.col(f"next.{c}").alias(c) for c in ("turn", "driver", "source", "last")]
        done = edit(todo).select("task_id", *step, F.lit(False).alias("failed"), *made.fieldNames())
        done.write.mode("overwrite").parquet(folder)  # read back, so that no edit is made twice
        lost = todo.join(changed.sparkSession.read.schema(kind).parquet(folder).select("task_id"), "task_id", "left_anti")
        lost.select("task_id", *step, F.lit(True).alias("failed")).write.mode("append").parquet(folder)

    return states.writeStream.outputMode("update").foreachBatch(run).option("checkpointLocation", checkpoint).start()
