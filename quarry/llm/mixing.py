"""Temperature mixing of sources.

Token shares p of the sources are raised to an exponent a; the weights are p**a, normalised. a is bisected
until the weights meet a target entropy (bits) or until no source is walked more often than a limit, whatever the
budget. The weights are realised as passes over block permutations: every source is walked in the order of a seeded
hash, anew in each epoch, until its part of the token budget is spent. Whole epochs take every document; of the last
one, a source takes the documents up to a cut in that order. Blocks, which are ranges of the hash, make the running
totals: first over blocks, then inside the one block in which the budget ends. A document's position in the mixture
is how far its source has been walked, as a share of the passes over it, so that every stretch of the mixture, not
just all of it, is at target weights.

Tokens are counted with a public vocabulary, in one pass over the texts. The default budget is the least that gives
every source one whole epoch, so nothing is left out.

Cases: a null source is a source of its own. Null and empty texts have no tokens; they come once in each whole
epoch and stay in order in the last. A document's place comes from its id and its text, so rows without an id, or under one,
are dealt like any others; rows equal in both share their place and are taken or left together.
An empty table gives an empty result. The exponent lies between 0 (equal weights) and 1 (shares as they are);
a target entropy out of reach gives the nearer end, and a limit that the budget breaks at any weights is an error.
Other columns are kept, whatever their names; a column that has the name of the result is replaced by it.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import log2

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import column, materialise, release, table, unused
from .words import word_encoder

MAX_REPETITION = 2.0
#: Documents of a block, about.
BLOCK_DOCS = 10_000
SEED = 20
#: Levels of the bisection that one pass over the sources evaluates together, and passes.
LEVELS, PASSES = 5, 8
TOP = 2.0**63


@dataclass
class Target:
    """Exactly one of the two: entropy of the weights in bits, or the most passes over any source."""

    entropy: float | None = None
    repetition: float | None = MAX_REPETITION


def token_count(text: Column, vocabulary: str | None = None) -> Column:
    """The number of the text's ids under a vocabulary whose tokens do not span words; 0 for a null text."""
    path = vocabulary or public_tokenizers.path("word_bpe_49k.json")

    @F.arrow_udf("long")
    def count(texts: pa.Array) -> pa.Array:
        encoder = word_encoder(path)
        return pa.array([encoder.count(t.as_py() or "") for t in texts], pa.int64())

    return count(text.cast("string"))


def _order(seed: int, epoch: Column, key: list[str]) -> Column:
    """Place of a document in an epoch's permutation: 63 bits. key: the columns that tell documents apart."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), epoch.cast("long"), *[column(c) for c in key]), 1)


def exponent(sources: DataFrame, target: Target, budget: float | None = None) -> float:
    """Bisect over sources(tokens). Every pass evaluates all midpoints of the next LEVELS halvings in one
    aggregation, so the sources stay distributed and the driver sees a row of numbers."""
    used = sources.where("tokens > 0")
    low, high, steps = 0.0, 1.0, 2**LEVELS
    top, total, least = used.agg(F.max("tokens"), F.sum("tokens"), F.min("tokens")).first()
    if not total:
        return 1.0
    if target.repetition is not None and (budget or total) > target.repetition * total:
        raise ValueError(f"{(budget or total) / total} passes over all tokens break the limit of {target.repetition}")
    if top == least:
        return 1.0

    def met(a: float, power: float, entropy: float) -> bool:
        if target.entropy is not None:  # it falls as the exponent grows
            return entropy <= target.entropy
        # the least source is walked most: its part of the budget over its tokens; this falls as the exponent grows
        spent = budget / power if budget else float(top)
        return spent / top * (least / top) ** (a - 1) <= target.repetition

    share = F.col("tokens") / F.lit(float(top))
    for _ in range(PASSES):
        points = [low + (high - low) * i / steps for i in range(1, steps)]
        sums = [F.sum(F.pow(share, F.lit(a))).alias(f"s{i}") for i, a in enumerate(points)]
        logs = [F.sum(F.pow(share, F.lit(a)) * F.log2(share) * a).alias(f"l{i}") for i, a in enumerate(points)]
        row = used.agg(*sums, *logs).first().asDict()
        found = [(row[f"s{i}"], log2(row[f"s{i}"]) - row[f"l{i}"] / row[f"s{i}"]) for i in range(len(points))]
        first = next((i for i, a in enumerate(points) if met(a, *found[i])), len(points))
        low, high = ([low] + points)[first], (points + [high])[first]
    return high


def plan(base: DataFrame, target: Target, budget: float | None, seed: int, block_docs: int, key: list[str]) -> DataFrame:
    """One row for each source of base(key, source, n_tokens): weight, passes, whole epochs and cut of the last one."""
    totals = base.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs"))
    sources = materialise(totals, "sources")
    a = exponent(sources, target, budget)
    power = F.when(F.col("tokens") > 0, F.pow(F.col("tokens").cast("double"), F.lit(a))).otherwise(0.0)
    powers = sources.withColumn("power", power)
    whole, largest = powers.agg(F.sum("power"), F.max(F.expr("try_divide(tokens, power)"))).first()
    weight = F.col("power") / F.lit(whole or 1.0)
    spent = F.lit(float(budget)) * weight if budget else F.col("power") * F.lit(largest or 1.0)
    # a hair is added so that a source that comes out even is not one document short
    passes = F.when(F.col("tokens") > 0, spent / F.col("tokens") + 1e-9).otherwise(1.0)
    sources = powers.select(
        "source",
        weight.alias("weight"),
        passes.alias("passes"),
        F.floor(passes).alias("epochs"),
        ((passes - F.floor(passes)) * F.col("tokens")).alias("rest"),
        F.ceil(F.col("docs") / block_docs).alias("blocks"),
    )
    sources = materialise(sources, "source-plan")
    placed = base.join(sources, "source").withColumn("place", _order(seed, F.col("epochs"), key))
    placed = placed.withColumn("block", F.floor(F.col("place") / F.lit(TOP) * F.col("blocks")))
    sums = placed.groupBy("source", "block").agg(F.sum("n_tokens").alias("tokens"), F.first("rest").alias("rest"))
    sums = materialise(sums, "blocks")
    before = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last = sums.withColumn("before", F.coalesce(F.sum("tokens").over(before), F.lit(0)))
    last = last.where("before <= rest AND before + tokens > rest").select("source", "block", (F.col("rest") - F.col("before")).alias("left"))
    last = materialise(last, "last-blocks")
    inside = placed.select("source", "block", "place", "n_tokens").join(last, ["source", "block"])
    inside = inside.groupBy("source", "place").agg(F.sum("n_tokens").alias("tokens"), F.first("left").alias("left"))
    upto = Window.partitionBy("source").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fitting = inside.withColumn("upto", F.sum("tokens").over(upto)).where("upto <= left")
    cuts = fitting.groupBy("source").agg(F.max("place").alias("cut_in"))
    starts = last.join(sources.select("source", "blocks"), "source").select(
        "source", (F.ceil(F.col("block") / F.col("blocks") * F.lit(TOP)).cast("long") - 1).alias("cut_before")
    )
    cut = F.coalesce("cut_in", "cut_before", F.lit(-1).cast("long"))
    out = sources.join(starts, "source", "left").join(cuts, "source", "left")
    out = materialise(out.select("source", "weight", "passes", "epochs", cut.alias("cut")), "mix-plan")
    for part in (sources, sums, last):
        release(part)
    return out


def mix(
    docs: DataFrame,
    target: Target | None = None,
    budget: float | None = None,
    tokens: Column | None = None,
    tie: Column | None = None,
    seed: int = SEED,
    block_docs: int = BLOCK_DOCS,
    name: str = "_mix",
) -> DataFrame:
    """docs, each row as often as the mixture takes it, with struct column _mix(epoch, place, n_tokens, weight, position).

    docs needs columns doc_id, source and text; tokens is the size of a document, and stands for text where it is
    given. tie tells apart documents without an id or under one, a hash of the text if there is one. The order of the mixture is by position, which ends near 1; any stretch of it is at target weights.
    """
    size, mark = unused(docs, "_size"), unused(docs, "_tie")
    if tie is None and "text" in docs.columns:
        tie = F.xxhash64(F.col("text").cast("string"))
    key = ["doc_id"] if tie is None else ["doc_id", mark]
    if tie is not None:
        docs = docs.withColumn(mark, tie)
    source = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("null"))
    if tokens is None:  # counted once: the sizes are written beside the rows
        docs = materialise(docs.withColumn(size, token_count(F.col("text"))), "sized")
    else:
        docs = docs.withColumn(size, tokens)
    base = docs.select(*[column(c) for c in key], source.alias("source"), F.col(size).cast("long").alias("n_tokens"))
    if tokens is not None:
        base = materialise(base, "sizes")
    chosen = plan(base, target or Target(), budget, seed, block_docs, key)
    held, turn = unused(docs, "_plan"), unused(docs, "_epoch")
    chosen = chosen.select(F.struct("source", "weight", "passes", "epochs", "cut").alias(held))
    joined = docs.join(chosen, source == F.col(f"{held}.source"))
    last = F.when(_order(seed, F.col(f"{held}.epochs"), key) <= F.col(f"{held}.cut"), 1).otherwise(0)
    times = F.col(f"{held}.epochs").cast("int") + last
    epochs = F.when(times > 0, F.sequence(F.lit(0), times - 1)).otherwise(F.array().cast("array<int>"))
    rows = joined.withColumn(turn, F.explode(epochs))
    place = _order(seed, F.col(turn), key)
    told = F.struct(
        F.col(turn).cast("long").alias("epoch"),
        place.alias("place"),
        F.col(size).cast("long").alias("n_tokens"),
        F.col(f"{held}.weight").alias("weight"),
        ((F.col(turn) + place / F.lit(TOP)) / F.col(f"{held}.passes")).alias("position"),
    )
    return rows.withColumn(name, told).drop(held, turn, size, mark)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", token_count(F.col("text")).alias("size"), F.xxhash64("text").alias("tie"))
    docs = materialise(docs, "sized")
    return mix(docs, tokens=F.col("size"), tie=F.col("tie")).select("doc_id", "source", "_mix.*")


QUERIES = {"op6_mixing": op6_mixing}
ORACLES: dict[str, str] = {}
