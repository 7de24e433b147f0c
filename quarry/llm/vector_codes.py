"""Product codes of vectors: each part of a vector is replaced by the number of its nearest codebook entry.

Components become whole numbers floor(SCALE * x), so that all sums are exact and the result depends on no order of
work. Kept vectors are written once as columnar blocks: one NumPy matrix of (dimensions, rows) a block. A round is one
RDD treeAggregate over the blocks: distances to the entries accumulate dimension by dimension, np.add.at puts each
vector into int64 tensors of sums and counts (entries by dimensions, and parts by entries), and the tensors, whose size
does not depend on the data, merge through the reduction tree. The codebooks are broadcast; they have ENTRIES rows.

Cases: vectors that are null, empty, or hold a null, an infinity or NaN are dropped. The first codebook is taken in
the order of ids, null ids last, equal ids by their vectors; repeated rows are coded each, and alike. With fewer vectors
than ENTRIES there are as many entries as vectors. All kept vectors must have one length that PARTS divides, and
components small enough for distances of 63 bits (below about 10**5 for 64 dimensions); else it is an error. An empty
table gives an empty result. Ids and labels keep their types, and other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column, materialise, table

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Rows of a block, rows whose distances are held at once, and depth of the reduction tree.
BLOCK_ROWS, CHUNK_ROWS, DEPTH = 8192, 1024, 2
#: Sums of errors by label are broadcast up to this many labels, and joined by a shuffle beyond it.
BROADCAST_LABELS = 100_000


def whole_numbers(x: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) as int64; the product is exact, as SCALE is a power of two."""
    scaled = np.floor(x.astype(np.float64) * SCALE)
    if scaled.size and np.abs(scaled).max() >= 2.0**31:
        raise ArithmeticError("a component is too large to be coded")
    return scaled.astype(np.int64)


def kind_for(dimensions: int, *largest: int) -> type:
    """The narrowest integers that hold squared distances between components of these sizes."""
    bound = dimensions * sum(largest) ** 2
    if bound >= 1 << 63:
        raise ArithmeticError("components are too large for distances of 63 bits")
    return np.int32 if bound < 1 << 31 else np.int64


def nearest(block: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For block(dimensions, rows) and books(parts, dimensions of a part, entries): the nearest entry of each part of
    each row, the lower one of equals, and its squared distance; both (parts, rows)."""
    parts, width, entries = books.shape
    rows = block.shape[1]
    largest = [int(np.abs(x).max(initial=0)) for x in (block, books)]
    kind = kind_for(width, *largest)
    codes, errors = np.empty((parts, rows), np.int64), np.empty((parts, rows), np.int64)
    books = books.astype(kind)
    for at in range(0, rows, CHUNK_ROWS):
        chunk = block[:, at : at + CHUNK_ROWS].astype(kind)
        total, gap = np.empty((chunk.shape[1], entries), kind), np.empty((chunk.shape[1], entries), kind)
        for p in range(parts):
            total[:] = 0
            for d in range(width):
                np.subtract(chunk[p * width + d][:, None], books[p, d][None, :], out=gap)
                np.multiply(gap, gap, out=gap)
                np.add(total, gap, out=total)
            best = total.argmin(axis=1)
            codes[p, at : at + CHUNK_ROWS] = best
            errors[p, at : at + CHUNK_ROWS] = total[np.arange(best.size), best]
    return codes, errors


def add_block(tensors: tuple[np.ndarray, np.ndarray], block: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """tensors: sums(parts, dimensions of a part, entries) and counts(parts, entries), with the block's rows added."""
    sums, counts = tensors
    codes, _ = nearest(block, books)
    for p, own in enumerate(codes):
        np.add.at(counts[p], own, 1)
        for d in range(books.shape[1]):
            np.add.at(sums[p, d], own, block[p * books.shape[1] + d])
    return sums, counts


def merged(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.add(a[0], b[0], out=a[0]), np.add(a[1], b[1], out=a[1])


def moved(books: np.ndarray, sums: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Entries replaced by the floor of the mean of their rows; unused ones stay."""
    return np.where(counts[:, None, :] > 0, sums // np.maximum(counts, 1)[:, None, :], books)


def finite(vector: str) -> F.Column:
    # exists() is null if it meets nulls and nothing else; they are told apart from numbers first
    odd = F.exists(column(vector), lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.coalesce((F.size(column(vector)) > 0) & ~odd, F.lit(False))


def blocks_of(vectors: DataFrame) -> DataFrame:
    """vectors(id, label, vector) as rows (ids, labels, n, numbers): numbers are int32, one dimension after the other."""
    id_kind, label_kind = (vectors.schema[k].dataType for k in ("id", "label"))
    kind = T.StructType().add("ids", T.ArrayType(id_kind)).add("labels", T.ArrayType(label_kind)).add("n", "integer").add("numbers", "binary")

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, BLOCK_ROWS):
                part = b.slice(at, BLOCK_ROWS)
                n, lists = part.num_rows, part.column(2)
                size = len(lists[0])
                if lists.value_lengths().unique().to_pylist() != [size] or size % PARTS:
                    raise ValueError(f"vectors must have one length that {PARTS} divides")
                numbers = whole_numbers(lists.flatten().to_numpy(zero_copy_only=False).reshape(n, size)).T.astype("<i4")
                one = lambda x: pa.ListArray.from_arrays([0, n], x)
                yield pa.RecordBatch.from_arrays(
                    [one(part.column(0)), one(part.column(1)), pa.array([n], pa.int32()), pa.array([numbers.tobytes()], pa.binary())],
                    ["ids", "labels", "n", "numbers"],
                )

    return vectors.select("id", "label", "vector").mapInArrow(run, kind)


def matrix(numbers: bytes, n: int) -> np.ndarray:
    return np.frombuffer(numbers, "<i4").reshape(-1, n)


def first_books(vectors: DataFrame, entries: int) -> np.ndarray | None:
    """The parts of the vectors of the least ids: (parts, dimensions of a part, entries). At most entries rows are read."""
    rows = vectors.orderBy(F.col("id").asc_nulls_last(), "vector").limit(entries).select("vector").collect()
    if not rows:
        return None
    if len({len(r.vector) for r in rows}) > 1 or len(rows[0].vector) % PARTS:
        raise ValueError(f"vectors must have one length that {PARTS} divides")
    return whole_numbers(np.array([r.vector for r in rows])).reshape(len(rows), PARTS, -1).transpose(1, 2, 0).copy()


def codebooks(blocks: DataFrame, books: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Rounds of assignment and replacement over all blocks."""
    context = blocks.sparkSession.sparkContext
    data = blocks.select("numbers", "n").rdd
    for _ in range(rounds):
        held = context.broadcast(books)
        nothing = np.zeros(books.shape, np.int64), np.zeros((books.shape[0], books.shape[2]), np.int64)
        sums, counts = data.treeAggregate(nothing, lambda t, r: add_block(t, matrix(r[0], r[1]), held.value), merged, DEPTH)
        books = moved(books, sums, counts)
        held.unpersist()
    return books


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and place in the part."""
    return hashlib.sha256(",".join(map(str, books.transpose(0, 2, 1).ravel().tolist())).encode()).hexdigest()


def coded(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """(id, label, code, error) of every row of the blocks."""
    held = blocks.sparkSession.sparkContext.broadcast(books)
    id_kind, label_kind = (blocks.schema[k].dataType.elementType for k in ("ids", "labels"))
    kind = T.StructType().add("id", id_kind).add("label", label_kind).add("code", "string").add("error", "long")

    def run(batches):
        for b in batches:
            for k in range(b.num_rows):
                codes, errors = nearest(matrix(b.column(3)[k].as_py(), b.column(2)[k].as_py()), held.value)
                text = np.ascontiguousarray(codes.T.astype(np.uint8)).tobytes().hex()
                width = 2 * codes.shape[0]
                texts = [text[i : i + width] for i in range(0, len(text), width)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0)[k].values, b.column(1)[k].values, pa.array(texts, pa.string()), pa.array(errors.sum(axis=0))],
                    ["id", "label", "code", "error"],
                )

    return blocks.select("ids", "labels", "n", "numbers").mapInArrow(run, kind)


def with_label_errors(rows: DataFrame, most: int = BROADCAST_LABELS) -> DataFrame:
    """rows(label, error, ...) with label_error, summed over equal labels, nulls together.

    Sums are made in every task before they are shuffled, and go to the rows by broadcast, so that a label of many rows
    stays spread; more than most labels are joined by a shuffle, in which Spark splits labels of many rows.
    """
    sums = materialise(rows.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")), "label-errors")
    if sums.limit(most + 1).count() <= most:
        sums = F.broadcast(sums)
    return rows.join(sums, rows["label"].eqNullSafe(sums["_label"])).drop("_label")


def vector_codes(vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: str = "label", rounds: int = ROUNDS) -> DataFrame:
    """One row (id, code, error, label_error, codebooks_sha256) for each vector that is kept; id has its own name."""
    kept = vectors.where(finite(vector)).select(column(id_column).alias("id"), column(label).alias("label"), column(vector).alias("vector"))
    books = first_books(kept, ENTRIES)
    if books is None:
        empty = kept.select("id", F.lit("").alias("code"), *[F.lit(0).cast("long").alias(c) for c in ("error", "label_error")])
        return empty.limit(0).withColumn("codebooks_sha256", F.lit(digest(np.zeros((0, 0, 0), np.int64)))).withColumnRenamed("id", id_column)
    blocks = materialise(blocks_of(kept), "vector-blocks")
    books = codebooks(blocks, books, rounds)
    rows = with_label_errors(materialise(coded(blocks, books), "codes"))
    out = rows.select("id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
    return out.withColumnRenamed("id", id_column)


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(table(spark, sf_dir, "embeddings"))


def _round_sql(k: int, last: bool) -> str:
    """The assignment to the codebooks b{k}, and the codebooks after it."""
    assigned = f"""a{k} AS MATERIALIZED (SELECT vec_id, label, p, min({{'d': d, 'e': e}}) AS best FROM (
SELECT v.vec_id, v.label, v.p, b.e, list_inner_product(v.x, v.x) - 2 * list_inner_product(v.x, b.x) + list_inner_product(b.x, b.x) AS d FROM v JOIN b{k} b USING (p)) GROUP BY ALL)"""
    if last:
        return assigned
    return f"""{assigned},
b{k + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.x, b.x) AS x FROM b{k} b LEFT JOIN (SELECT p, e, list(c ORDER BY i) AS x FROM (
SELECT v.p, a.best.e AS e, i, floor(sum(v.x[i]) / count(*)) AS c FROM v JOIN a{k} a USING (vec_id, p), range(1, {64 // PARTS + 1}) r(i) GROUP BY ALL) GROUP BY ALL) m USING (p, e))"""


def _sql() -> str:
    """For vectors of 64 dimensions and unique ids, as the given tables have them."""
    width = 64 // PARTS
    rounds = ",\n".join(_round_sql(k, k == ROUNDS) for k in range(ROUNDS + 1))
    return f"""WITH kept AS (SELECT vec_id, label, list_transform(embedding, lambda c: floor({SCALE} * c::DOUBLE)) AS x FROM embeddings
WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(embedding) > 0),
v AS MATERIALIZED (SELECT vec_id, label, p, x[p * {width} + 1 : (p + 1) * {width}] AS x FROM kept, range({PARTS}) r(p)),
b0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x FROM v QUALIFY e < {ENTRIES}),
{rounds},
books AS (SELECT sha256(string_agg(c::BIGINT::VARCHAR, ',' ORDER BY p, e, i)) AS h FROM (SELECT p, e, unnest(x) AS c, generate_subscripts(x, 1) AS i FROM b{ROUNDS})),
rows AS (SELECT vec_id, label, string_agg(printf('%02x', best.e::INTEGER), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM a{ROUNDS} GROUP BY ALL)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256 FROM rows, books"""


QUERIES = {"op11_vector_codes": op11_vector_codes}
ORACLES: dict[str, str] = {"op11_vector_codes": _sql()}
