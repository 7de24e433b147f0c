"""Corpus pipeline: five stages, each written as Parquet and read again as the documents of the next.

toxicity       documents scored 0.5 or more by the span tagger go
near_dedup     of each near-duplicate component, one row stays: that with the smallest id
decontaminate  documents that meet a benchmark item go
mixing         documents are repeated as the temperature mixture asks; none is left out
token_output   token files are written; one row for each document that is read back

A row without doc_id is kept by near_dedup only where its component has no id at all, and then once for each such
component. Rows of one id with texts in different components are different documents. Ids are whole numbers, as
token files hold them. Null and empty texts are one component. Columns beyond those of documents, whatever their
names, pass through all stages but the last. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import decontaminate, mixing, simhash, token_files, toxicity
from quarry.llm.common import materialise, release, release_since, table, unused, written_so_far


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), F.lit(True))
    held = unused(docs, "_toxicity")
    rated = docs.withColumn(held, toxicity.toxicity_column(F.col("text"), spark, model))
    return rated.where(F.col(f"{held}.score") < 0.5).drop(held)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.first_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    held = unused(docs, "_mix")
    return mixing.mix(docs, name=held).drop(held)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_files.token_table(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_leaks),
    ("mixing", mix_sources),
    ("token_output", write_tokens),
]
#: Trained and iterated stages have no SQL; tests hold every stage against a plain version of what it decides.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. When a stage has been written, all that it made and the stage before are deleted."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        mark = written_so_far()
        docs = materialise(stage(spark, docs, sf_dir), name)
        release_since(spark, mark, docs)
        if before is not None:
            release(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
