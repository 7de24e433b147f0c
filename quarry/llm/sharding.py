"""Sharding through a permutation-filled lookup table.

Every shard has its own order of preference over the slots of a prime-sized table, given by an offset and a
step. In turns, each shard claims the next slot of its order that is still free, until the table is full. A
document goes to the shard that owns the slot of its hash. Shards get equal numbers of slots (but for one),
and when a shard comes or goes, few slots change hands. The table has a fixed number of rows (slots) and is
broadcast; placing needs no shuffle.

Cases: a null key goes to the slot of the empty string. Equal keys go to the same shard. An empty table gives
an empty result. Other columns, whatever their names, are kept; a column that has the name of place_rows' result is
replaced by it, and write_shards names its folders by a name that no column has.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import column, table, unused

#: Shards of the production layout, and slots of its table: a prime, about a hundred for each shard.
SHARDS, SLOTS = 64, 6553
SALTS = 8


def _number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def lookup_table(shards: list[str], slots: int = SLOTS) -> list[int]:
    """For each slot, the index of the shard that claimed it."""
    if not shards or slots < len(shards) or any(slots % d == 0 for d in range(2, int(slots**0.5) + 1)):
        raise ValueError("slots must be a prime not below the number of shards")
    at = [_number(f"{s}/offset") % slots for s in shards]
    step = [_number(f"{s}/step") % (slots - 1) + 1 for s in shards]
    owner = [-1] * slots
    for turn in range(slots):
        i = turn % len(shards)
        while owner[at[i]] >= 0:
            at[i] = (at[i] + step[i]) % slots
        owner[at[i]] = i
    return owner


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), F.lit(slots).cast("long"))


def place_rows(df: DataFrame, key: Column, shards: list[str], slots: int = SLOTS, name: str = "_place") -> DataFrame:
    """df with a struct column _place(slot, shard). Only the table, slots rows of two numbers, is broadcast."""
    held = unused(df, "_owner")
    owners = df.sparkSession.createDataFrame(
        [((s, o),) for s, o in enumerate(lookup_table(shards, slots))], f"{held} struct<slot: bigint, shard: bigint>"
    )
    joined = df.join(F.broadcast(owners), slot_of(key, slots) == F.col(f"{held}.slot"))
    return joined.withColumn(name, F.col(held)).drop(held)


def write_shards(df: DataFrame, key: Column, shards: list[str], folder: str, slots: int = SLOTS, salts: int = SALTS) -> str:
    """Write df as one folder for each shard, each from salts tasks, so that one hot key does not hold up a shard.

    Gives the name of the folders' column: shard, after underscores where df has that already.
    """
    place, name = unused(df, "_place"), unused(df, "shard")
    placed = place_rows(df, key, shards, slots, place).withColumn(name, F.col(f"{place}.shard")).drop(place)
    salt = F.pmod(F.xxhash64(*map(column, df.columns)), F.lit(salts))
    placed.repartition(len(shards) * salts, name, salt).write.partitionBy(name).parquet(folder)
    return name


def shard_names(n: int = SHARDS) -> list[str]:
    return [f"shard-{i:04d}" for i in range(n)]


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id")
    return place_rows(docs, F.col("doc_id"), shard_names()).select("doc_id", "_place.slot", "_place.shard")


QUERIES = {"op7_sharding": op7_sharding}
#: Claims slots turn by turn in a recursive query; `used` has a bit for each slot.
ORACLES = {
    "op7_sharding": f"""
WITH RECURSIVE names AS (
  SELECT i, ('0x' || substr(md5(printf('shard-%04d/offset', i)), 1, 15))::BIGINT % {SLOTS} AS off,
         ('0x' || substr(md5(printf('shard-%04d/step', i)), 1, 15))::BIGINT % {SLOTS - 1} + 1 AS step
  FROM range({SHARDS}) t(i)
), claims(turn, used, slot, shard) AS (
  SELECT -1::BIGINT, repeat('0', {SLOTS})::BIT, -1::BIGINT, -1::BIGINT
  UNION ALL
  SELECT turn + 1, set_bit(used, best::INTEGER, 1), best, i
  FROM (SELECT c.turn, c.used, n.i,
               list_filter(list_transform(range({SLOTS}), lambda j: (n.off + j * n.step) % {SLOTS}),
                           lambda s: get_bit(c.used, s::INTEGER) = 0)[1] AS best
        FROM claims c JOIN names n ON n.i = (c.turn + 1) % {SHARDS} WHERE c.turn + 1 < {SLOTS})
)
SELECT d.doc_id, c.slot, c.shard
FROM documents d
JOIN (SELECT slot, shard FROM claims WHERE turn >= 0) c
  ON ('0x' || substr(md5(coalesce(CAST(d.doc_id AS VARCHAR), '')), 1, 15))::BIGINT % {SLOTS} = c.slot
"""
}
