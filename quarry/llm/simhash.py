"""SimHash near-duplicates through deletion-variant signatures.

Two 64-bit fingerprints that differ in at most three bits agree, but for one bit at most, on one of
their two 32-bit halves. Each half is therefore indexed under its 32 one-wildcard variants; equal
variants bring candidates together and the Hamming distance is checked. A variant that gathers more
than BUCKET fingerprints is cut once more in the same way on the other half, after which a bucket can
hold 2**18 fingerprints at most. Buckets give spanning links, never all their pairs.

Cases: a null text is an empty one; an empty text has fingerprint zero and is linked like any other.
Repeated rows share a fingerprint, so they share a component. A null id is never the name of a
component unless no row of the component has an id, so components without ids share that name; their
roots tell them apart. Ids keep their type and are compared as it orders them. Other columns of the input are
ignored, and kept by first_of_each(). An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column, materialise, release, table, unused
from .components import components

MAX_BITS = 3
#: Fingerprints of one variant that are compared at once (32 KB).
BUCKET = 4096


def fingerprint(text: bytes, width: int = 3) -> int:
    """The SimHash of the text's lower-cased word shingles, as a signed 64-bit integer."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    if len(words) < width:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(width))))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(g, 42) for g in grams), dtype=">u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, hashes.size, 65536):
        part = hashes[at : at + 65536]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > hashes.size).view(">i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, digest: Column | None = None) -> DataFrame:
    """(doc_id, fp), and digest if it is given: one row for each row of docs, whose ids keep their type."""
    more = [] if digest is None else [digest.alias("digest")]
    kind = docs.select(F.col(id_col).alias("doc_id")).schema["doc_id"].dataType.simpleString()

    def run(batches):
        for b in batches:
            fps = [fingerprint(t.as_py(), width) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps, pa.int64()), *b.columns[2:]], ["doc_id", "fp", "digest"][: b.num_columns])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"), *more)
    return rows.mapInArrow(run, f"doc_id {kind}, fp long" + ", digest binary" * len(more))


def _variants(fps: DataFrame) -> DataFrame:
    """64 rows for each fingerprint: both halves, each with one of its bits masked out."""
    half = F.expr("CASE WHEN k < 32 THEN shiftrightunsigned(fp, 32) ELSE fp & 4294967295L END")
    return (
        fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("k"))
        .withColumn("half", half)
        .select("fp", F.expr("shiftleft(CAST(k AS LONG), 32) | (half & ~shiftleft(1L, k & 31))").alias("key"))
    )


def _deeper(rows: DataFrame) -> DataFrame:
    """32 rows for each (key, fp) of a large bucket: the half that key leaves free, cut in two once more."""
    free = F.expr("CASE WHEN shiftright(key, 32) < 32 THEN fp & 4294967295L ELSE shiftrightunsigned(fp, 32) END")
    part = F.expr("CASE WHEN j < 16 THEN shiftrightunsigned(free, 16) ELSE free & 65535L END")
    return (
        rows.withColumn("free", free)
        .select("key", "fp", "free", F.explode(F.sequence(F.lit(0), F.lit(31))).alias("j"))
        .withColumn("part", part)
        .select("fp", "key", F.expr("shiftleft(CAST(j AS LONG), 16) | (part & ~shiftleft(1L, j & 15))").alias("key2"))
    )


def spanning_links(values: list[int], max_bits: int = MAX_BITS) -> list[tuple[int, int]]:
    """(member, least member) for each group of values that links of at most max_bits hold together."""
    rest, out = np.unique(np.array(values, np.int64)), []
    while rest.size:
        root, queue, rest = int(rest[0]), [rest[0]], rest[1:]
        while queue and rest.size:
            # as unsigned: of a negative number, the bits of its absolute value would be counted
            near = np.bitwise_count((rest ^ queue.pop()).view(np.uint64)) <= max_bits
            if near.any():
                found = rest[near]
                out += [(int(x), root) for x in found]
                queue += list(found)
                rest = rest[~near]
    return out


def _spanned(buckets: DataFrame) -> DataFrame:
    def run(batches):
        for b in batches:
            found = [p for fps in b.column(0).to_pylist() for p in spanning_links(fps)]
            u, v = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    return buckets.select("fps").mapInArrow(run, "u long, v long")


def links(fps: DataFrame) -> DataFrame:
    """(u, v) over distinct fingerprints whose components are those of all links of at most three bits."""
    rows = _variants(fps)
    counts = rows.groupBy("key").count().where("count > 1")
    # merged: Spark's estimate leaves out that each fingerprint has 64 variants, and either side may be broadcast whole
    rows = materialise(rows.join(counts.hint("merge"), "key"), "buckets")
    small = rows.where(F.col("count") <= BUCKET).groupBy("key").agg(F.collect_list("fp").alias("fps"))
    found = _spanned(small)
    large = rows.where(F.col("count") > BUCKET)
    if not large.isEmpty():
        cut = _deeper(large).groupBy("key", "key2").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
        found = found.unionByName(_spanned(cut))
    found = materialise(found.distinct(), "found-links")
    release(rows)
    return found


def roots_of(fps: DataFrame) -> DataFrame:
    """fps(fp, ...), one row for each distinct fingerprint, with root: the least fingerprint of its component."""
    found = links(fps.select("fp"))
    roots = components(found).select(F.col("node").alias("fp"), "root")
    rooted = materialise(fps.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")), "rooted")
    release(found)
    return rooted


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) for each row of docs; fingerprint is 16 hexadecimal digits."""
    rows = materialise(fingerprints(docs, id_col, text_col, width), "fingerprints")
    firsts = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    rooted = roots_of(firsts)
    release(firsts)
    named = materialise(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "named")
    classes = materialise(rooted.join(named, "root").select("fp", "component_id"), "classes")
    release(rooted)
    release(named)
    return rows.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def first_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """One row of docs for each component: the least by id (null last), fingerprint and digest of the text.

    Ids need not be unique or there at all: rows are found again by a digest of id and text, which settle the
    component. Of rows that are equal in both, one stays; they are folded in every task before docs are shuffled,
    once, by that digest, so that many of them are no hot key.
    """
    text, named = F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.col(id_col).cast("string")
    digest = F.unhex(F.md5(F.concat(F.coalesce(F.concat(F.lit("="), named), F.lit("-")), F.lit("\n"), text).cast("binary")))
    rows = fingerprints(docs, id_col, text_col, width, digest)
    least = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "fp", "digest")
    firsts = materialise(rows.groupBy("fp").agg(F.min(least).alias("first")), "distinct")
    rooted, key = roots_of(firsts), unused(docs, "_digest")
    release(firsts)
    stay = materialise(rooted.groupBy("root").agg(F.min("first").alias("first")).select(F.col("first.digest").alias(key)), "stay")
    release(rooted)
    return docs.withColumn(key, digest).dropDuplicates([key]).join(stay, key, "left_semi").select(*map(column, docs.columns))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {"op3_simhash": op3_simhash}
ORACLES: dict[str, str] = {}
