"""Edit tasks: what each driver sends, and the turns of tasks with several edits (O-58 to O-60, O-89).

The state of a task is which results it has. A pass of a driver is one projection over tasks with their results.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.text import SINGLE_EMPTY_PROMPT, STYLE_PROMPT, TURN_EMPTY_PROMPT, extraction_prompt, without_apostrophes
from quarry.operators.partition import written

#: Workflow template by kind of single edit, and the kinds whose images change places, as their
#: drivers remove the object that the edit is to add.
TEMPLATES = {
    "add": "sdxl_inpaint",
    "remove": "sdxl_inpaint",
    "replace": "flux_inpaint",
    "adjust": "sdxl_adjust",
    "background": "flux_inpaint",
    "extract": "extract_ref",
    "style": "sdxl_style_transfer_ghibli",
}
SWAPPED = ("add",)
#: Names of prompts' edit types and of the folders that the drivers read.
FOLDERS = {"hybrid": "compose", "content_memory": "multi-premise", "content_understand": "omit-refer", "version_backtrack": "version_refer"}


@dataclass(frozen=True)
class Turn:
    """One driver's turn: it needs the result of turn needs (-1: none) and must not have its own where once is set."""

    driver: str
    operation: str
    turn: int
    needs: int
    from_result: bool
    once: bool
    last: bool


def _composed(operation: str, once: bool) -> list[Turn]:
    name = f"compose_{operation}"
    return [Turn(name, operation, 0, -1, False, True, False), Turn(name, operation, 1, 0, True, once, True)]


#: The turns of every driver.
TURNS = [
    *_composed("add", False),
    *_composed("remove", False),
    *_composed("adjust", True),
    *_composed("replace", True),
    Turn("add_omit", "add", 0, -1, False, True, False),
    Turn("adjust_omit", "adjust", 1, 0, False, True, False),
    Turn("remove_omit", "remove", 2, 1, False, True, True),
    Turn("replace_omit", "replace", 2, 1, False, True, True),
    Turn("replace_version", "replace", 1, 0, False, True, False),
    Turn("adjust_version", "adjust", 2, 1, False, True, True),
]


def edit_prompt(kind: Column, result: Column) -> Column:
    """The prompt of a single edit (O-38, O-58, O-59)."""
    clean = without_apostrophes(result)
    fixed = F.when(kind.isin("add", "remove"), SINGLE_EMPTY_PROMPT).when(kind == "style", STYLE_PROMPT)
    return fixed.when(kind == "extract", extraction_prompt(clean)).otherwise(clean)


def turn_prompt(operation: Column, result: Column) -> Column:
    """The prompt of one turn of a task with several edits (O-38, O-60)."""
    return F.when(operation.isin("add", "remove"), TURN_EMPTY_PROMPT).otherwise(without_apostrophes(result))


def single_edits(tasks: DataFrame) -> DataFrame:
    """tasks(kind, edit_result, ...) with template, prompt and swapped; unknown kinds get an error."""
    template = F.create_map(*[F.lit(x) for pair in TEMPLATES.items() for x in pair])[F.col("kind")]
    return (
        tasks.withColumn("template", template)
        .withColumn("prompt", edit_prompt(F.col("kind"), F.col("edit_result")))
        .withColumn("swapped", F.col("kind").isin(*SWAPPED))
        .withColumn("error", F.when(F.col("template").isNull(), "unknown kind"))
    )


def ready_turn(operations: Column, done: Column, drivers: list[str], new: bool = False) -> Column:
    """struct(driver, turn, source, last) of the first of the drivers' turns that can run now; null if none can.

    operations: array of names by turn; done: array of the turns that have a result. new: only turns that have none, also of
    drivers that would make theirs again.
    """
    out = None
    for t in (t for t in TURNS if t.driver in drivers):
        ready = F.get(operations, t.turn) == t.operation
        if t.needs >= 0:
            ready = ready & F.array_contains(done, t.needs)
        if t.once or new:
            ready = ready & ~F.array_contains(done, t.turn)
        source = F.lit(f"result_{t.turn - 1}" if t.from_result else "original")
        step = F.struct(F.lit(t.driver).alias("driver"), F.lit(t.turn).cast("long").alias("turn"), source.alias("source"), F.lit(t.last).alias("last"))
        out = F.when(ready, step) if out is None else out.when(ready, step)
    return out


def next_turns(tasks: DataFrame, results: DataFrame, drivers: list[str], new: bool = False) -> DataFrame:
    """tasks(task_id, operations, ...) with column next, from results(task_id, turn)."""
    done = results.groupBy("task_id").agg(F.collect_set("turn").alias("_done"))
    joined = tasks.join(done, "task_id", "left")
    state = F.coalesce("_done", F.array().cast(results.schema["turn"].dataType.simpleString().join(["array<", ">"])))
    return joined.withColumn("next", ready_turn(F.col("operations"), state, drivers, new)).drop("_done")


def run_turns(
    tasks: DataFrame, sink: str, edit: Callable[[DataFrame], DataFrame], drivers: list[str] | None = None, passes: int = 3
) -> DataFrame:
    """O-60: let the drivers make one turn after the other until no task can go on; gives the sink's rows.

    tasks(task_id, operations, ...). edit gets the tasks of a pass with column next (driver, turn, source, last) and gives them back with
    its results; rows that it leaves out have failed and are tried in the next pass. Each pass joins the tasks to the results that are
    there and appends its own to the Parquet folder sink as (task_id, turn, driver, source, last, and edit's own columns). A turn that has a result is not
    made again, nor is any of a task whose last turn has one, so a run that was broken off goes on where it was. Tasks without an
    id are left out, as their results could not be told apart.
    """
    spark, drivers = tasks.sparkSession, drivers or sorted({t.driver for t in TURNS})
    known = tasks.where("task_id IS NOT NULL")

    def made(todo: DataFrame) -> DataFrame:
        done = edit(todo)
        step = [F.col(f"next.{c}").alias(c) for c in ("turn", "driver", "source", "last")]
        return done.select("task_id", *step, *[c for c in done.columns if c not in {"next", *known.columns}])

    made(known.limit(0).withColumn("next", ready_turn(F.col("operations"), F.array().cast("array<long>"), drivers))).write.mode("append").parquet(sink)
    for _ in range(passes):
        results = spark.read.parquet(sink)
        ended = results.where("last").select("task_id").distinct()
        left = next_turns(known.join(ended, "task_id", "left_anti"), results, drivers, new=True).where("next IS NOT NULL")
        left = written(left)
        if left.isEmpty():
            break
        made(left).write.mode("append").parquet(sink)
    return spark.read.parquet(sink)


def dataset_rows(turns: DataFrame, key: str = "task_id") -> DataFrame:
    """O-80: turns(key, turn, input_images, output_images, prompt) as one row a task, in the order of turns."""
    entry = F.struct("turn", "input_images", "output_images", "prompt")
    rows = turns.groupBy(key).agg(F.array_sort(F.collect_list(entry)).alias("data"))
    return rows.withColumn("data", F.transform("data", lambda x: x.dropFields("turn")))
