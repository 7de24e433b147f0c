"""Benchmark decontamination by pigeonhole edit matching.

A test item of m characters may be met with k = floor(RATE * m) edits. Cut into k + 1 pieces, at least one
piece is met exactly. An item is met by whole words of the text only: the stretch that is compared with it begins and
ends at borders of words, whatever the budget. All pieces of a block of items form one Aho-Corasick automaton, which finds exact piece
hits in one pass over a text; around a hit, Myers' bit-parallel algorithm gives the least edit distance of the
whole item to any stretch of the text. Texts and items are compared in lower case, letters and digits only,
with single spaces between words.

The items are the stated query set. They are broadcast in blocks of at most BLOCK_CHARS characters (but one
item at least), with one pass over the documents for each block.

Cases: null and empty texts and items match nothing; nor do items without a letter or digit. Repeated items are
found each by its own id; repeated documents each give their own rows. Document ids keep their type, item ids are whole
numbers. Empty tables give empty results. Other columns are ignored by find_leaks and kept by without_leaks, whatever their names.
"""

from __future__ import annotations

import re
from collections import defaultdict
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import materialise, table

RATE = 0.08
#: What stands behind the last character of a word: nothing, or a blank.
BORDER = ("", " ")
#: Characters of the items that one broadcast holds.
BLOCK_CHARS = 500_000
GAPS = re.compile(r"[\W_]+")
HITS = "array<struct<item_id:bigint,distance:int,budget:int,start:bigint,stop:bigint>>"


def normal(text: str | None) -> str:
    return GAPS.sub(" ", (text or "").lower()).strip()


def cut(text: str, pieces: int) -> list[tuple[int, str]]:
    """(start, piece) for so many pieces of nearly the same length."""
    edges = [len(text) * i // pieces for i in range(pieces + 1)]
    return [(a, text[a:b]) for a, b in zip(edges, edges[1:])]


def masks_of(item: str) -> dict[str, int]:
    out: dict[str, int] = defaultdict(int)
    for i, c in enumerate(item):
        out[c] |= 1 << i
    return dict(out)


def matches(masks: dict[str, int], m: int, text: str, after: str, budget: int, anchored: bool = False):
    """(distance, end) for each border of a word in text at which a stretch within the budget of an item of m
    characters ends. distance is that of the nearest such stretch, or of all of text up to there if anchored; after
    is what stands behind text."""
    full, high = (1 << m) - 1, 1 << (m - 1)
    up, down, score = full, 0, m
    for j, c in enumerate(text, 1):
        same = masks.get(c, 0)
        diagonal = same | down
        across = (((same & up) + up) ^ up) | same
        more, less = down | (full & ~(across | up)), up & across
        if more & high:
            score += 1
        elif less & high:
            score -= 1
        if score <= budget and (text[j : j + 1] or after) in BORDER:
            yield score, j
        more, less = (more << 1 | anchored) & full, (less << 1) & full
        up, down = less | (full & ~(diagonal | more)), more & diagonal


class Matcher:
    """items: (item_id, normalised text)."""

    def __init__(self, items: list[tuple[int, str]], rate: float = RATE):
        import ahocorasick

        self.items, pieces = [], defaultdict(list)
        for item_id, text in items:
            if not text:
                continue
            budget = int(rate * len(text))
            for at, piece in cut(text, budget + 1):
                pieces[piece].append((len(self.items), at))
            self.items.append((item_id, text, budget, masks_of(text), masks_of(text[::-1])))
        self.finder = ahocorasick.Automaton()
        for piece, places in pieces.items():
            self.finder.add_word(piece, (len(piece), places))
        if pieces:
            self.finder.make_automaton()
        self.any = bool(pieces)

    def hits(self, text: str) -> list[tuple[int, int, int, int, int]]:
        """(item_id, distance, budget, start, stop) of the best match of each item within its budget."""
        out = []
        places: dict[int, set[int]] = defaultdict(set)
        for end, (size, found) in self.finder.iter(text) if self.any else ():
            for n, at in found:
                places[n].add(end + 1 - size - at)
        for n, starts in places.items():
            item_id, item, budget, masks, back_masks = self.items[n]
            best = None
            for low, high in _joined(sorted(starts), 2 * budget):
                low, high = max(0, low - budget), high + len(item) + budget
                for distance, end in matches(masks, len(item), text[low:high], text[high : high + 1], budget):
                    if best is not None and distance >= best[0]:
                        continue  # from a border on it is no nearer
                    stop = low + end
                    first = max(0, stop - len(item) - budget)
                    for distance, size in matches(back_masks, len(item), text[first:stop][::-1], text[max(0, first - 1) : first], budget, True):
                        if best is None or distance < best[0]:
                            best = (distance, stop - size, stop)
            if best:
                distance, start, stop = best
                out.append((item_id, distance, budget, start, stop))
        return out


def _joined(starts: list[int], gap: int):
    """Runs of starts that lie within gap of each other: one stretch of text serves all of a run."""
    first = last = starts[0]
    for s in starts[1:]:
        if s - last > gap:
            yield first, last
            first = s
        last = s
    yield first, last


@lru_cache(maxsize=2)
def _matcher(items: tuple, rate: float) -> Matcher:
    return Matcher(list(items), rate)


def item_blocks(benchmark: DataFrame, block_chars: int = BLOCK_CHARS):
    """Blocks of (item_id, normalised text), each collected by itself.

    Items are dealt to buckets by hash, with a running total inside each bucket, so a block holds at most
    block_chars characters or one item.
    """
    items = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).where("text <> ''")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = items.withColumn("bucket", F.pmod(F.xxhash64("item_id", "text"), F.lit(1 + total // block_chars)))
    before = Window.partitionBy("bucket").orderBy("item_id", "text").rowsBetween(Window.unboundedPreceding, -1)
    chars = F.coalesce(F.sum(F.length("text")).over(before), F.lit(0))
    blocks = materialise(buckets.withColumn("part", F.floor(chars / block_chars)), "items")
    for bucket, part in [tuple(r) for r in blocks.select("bucket", "part").distinct().orderBy("bucket", "part").collect()]:
        rows = blocks.where((F.col("bucket") == bucket) & (F.col("part") == part)).select("item_id", "text").orderBy("item_id", "text")
        yield tuple((r.item_id, normal(r.text)) for r in rows.collect())


def leaks_column(text: Column, spark: SparkSession, items: tuple, rate: float) -> Column:
    """The hits of the items in each text, an array that is empty for clean texts."""
    held = spark.sparkContext.broadcast(items)
    kind = pa.list_(
        pa.struct([("item_id", pa.int64()), ("distance", pa.int32()), ("budget", pa.int32()), ("start", pa.int64()), ("stop", pa.int64())])
    )
    names = ("item_id", "distance", "budget", "start", "stop")

    @F.arrow_udf(HITS)
    def hits(texts: pa.Array) -> pa.Array:
        matcher = _matcher(held.value, rate)
        return pa.array([[dict(zip(names, h)) for h in matcher.hits(normal(t.as_py()))] for t in texts], kind)

    return hits(text)


def find_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """(doc_id, item_id, distance, budget, start, stop): each item that is met in a row of docs.

    start and stop are places in the normalised text.
    """
    out = None
    for items in item_blocks(benchmark):
        hits = leaks_column(F.col("text"), docs.sparkSession, items, rate)
        part = docs.select("doc_id", F.explode(hits).alias("hit")).select("doc_id", "hit.*")
        out = part if out is None else out.unionByName(part)
    kind = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, item_id long, distance int, budget int, start long, stop long"
    return docs.sparkSession.createDataFrame([], kind) if out is None else out


def without_leaks(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """The rows of docs that meet no item."""
    for items in item_blocks(benchmark):
        docs = docs.where(F.size(leaks_column(F.col("text"), docs.sparkSession, items, rate)) == 0)
    return docs


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return find_leaks(docs, table(spark, sf_dir, "benchmark"))


QUERIES = {"op1_decontaminate": op1_decontaminate}
ORACLES: dict[str, str] = {}
