"""Judge texts to scores: by item, by edit type and over all (O-39, O-51, O-52, O-55 to O-57)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from quarry.functions.parse import judge_mean

#: Rubrics up to so many are broadcast.
FEW_RUBRICS = 1000
#: Fixed values (O-41): the lines that a judge scores for each edit type; the second and third may not exceed the first.
RUBRIC_LINES = {
    "replace": ("Prompt Compliance", "Visual Naturalness", "Physical & Detail Integrity"),
    "add": ("Prompt Compliance", "Visual Naturalness", "Physical & Detail Coherence"),
    "adjust": ("Prompt Compliance", "Visual Seamlessness", "Physical & Detail Fidelity"),
    "remove": ("Prompt Compliance", "Visual Naturalness", "Physical & Detail Integrity"),
    "style": ("Style Fidelity", "Content Preservation", "Rendering Quality"),
    "action": ("Action Fidelity", "Identity Preservation", "Visual & Anatomical Coherence"),
    "extract": ("Object Identity", "Mask Precision", "Visual Quality"),
    "background": ("Instruction Compliance", "Visual Seamlessness", "Physical Consistency"),
    "compose": ("Instruction Compliance", "Visual Naturalness", "Physical Consistency & Fine Detail"),
}


def item_scores(judged: DataFrame) -> DataFrame:
    """judged(key, text) as (key, score), rounded; texts without a score go."""
    return judged.select("key", judge_mean(F.col("text")).alias("score")).where("score IS NOT NULL")


def type_scores(scores: DataFrame, items: DataFrame) -> DataFrame:
    """Mean of the items' rounded scores for each edit type, rounded again; items without a type go."""
    joined = scores.join(items.where("edit_type IS NOT NULL").select("key", "edit_type"), "key")
    return joined.groupBy("edit_type").agg(F.bround(F.avg("score"), 2).alias("score"), F.count("*").alias("n"))


def overall_score(scores: DataFrame) -> DataFrame:
    """One row; null without scores."""
    return scores.agg(F.bround(F.avg("score"), 2).alias("score"), F.count("*").alias("n"))


def with_rubric(items: DataFrame, rubrics: DataFrame) -> DataFrame:
    """Each item with the template of its edit type, or an error where there is none.

    A table of a few rubrics, which is counted, is broadcast: items are not shuffled on a handful of types.
    """
    known = rubrics.select("edit_type", "template")
    if known.limit(FEW_RUBRICS + 1).count() <= FEW_RUBRICS:
        known = F.broadcast(known)
    joined = items.join(known, "edit_type", "left")
    return joined.withColumn("error", F.when(F.col("template").isNull(), F.concat(F.lit("no rubric for "), F.coalesce("edit_type", F.lit("null")))))


def rubric_lines(edit_type: Column) -> Column:
    """O-41: array of the names of the lines to score; null for an unknown type."""
    pairs = [x for kind, names in RUBRIC_LINES.items() for x in (F.lit(kind), F.array(*map(F.lit, names)))]
    return F.try_element_at(F.create_map(*pairs), edit_type)


def report(rows: DataFrame, kept: Column) -> DataFrame:
    """O-57: one row (total, kept, dropped)."""
    n = F.count(F.when(kept, 1))
    return rows.agg(F.count("*").alias("total"), n.alias("kept"), (F.count("*") - n).alias("dropped"))


def counted_as_written(rows: DataFrame, kept: Column, name: str = "report") -> tuple[DataFrame, Observation]:
    """O-57 without a pass of its own: the kept rows, and their report, which is there once they have been written.

    The observation's get is then {total, kept, dropped}; it waits for the first action on the rows. A null condition drops.
    """
    watch = Observation(name)
    n = F.count(F.when(kept, 1))
    seen = rows.observe(watch, F.count(F.lit(1)).alias("total"), n.alias("kept"), (F.count(F.lit(1)) - n).alias("dropped"))
    return seen.where(kept), watch
