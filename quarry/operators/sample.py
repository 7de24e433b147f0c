"""Seeded choices (O-63 to O-68): the order of a hash stands for chance, so every run chooses the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPERATIONS = ("add", "remove", "replace", "adjust")
#: Orders of operations of content understanding; version backtracking has one only.
UNDERSTAND = (("add", "adjust", "remove"), ("add", "adjust", "replace"))
BACKTRACK = ("add", "replace", "adjust")


def lot(seed: int, *parts) -> Column:
    """The hash that stands for a draw; parts tell what is drawn."""
    return F.md5(F.concat_ws(":", *[p if isinstance(p, Column) else F.col(p) for p in parts], F.lit(str(seed))))


def pick_one(rows: DataFrame, group: str, seed: int, ties: tuple[str, ...] = ("idx",)) -> DataFrame:
    """O-63: one row of each group, by a minimum that is taken in every task before the shuffle."""
    rest = [c for c in rows.columns if c not in {group, *ties}]
    row = F.struct(lot(seed, group, ties[0]).alias("_lot"), *ties, *rest)
    best = rows.groupBy(group).agg(F.min(row).alias("_row"))
    return best.select(*[group if c == group else f"_row.{c}" for c in rows.columns])


def pick(rows: DataFrame, group: str, n: int, seed: int, ties: tuple[str, ...] = ("idx",)) -> DataFrame:
    """O-64: n different rows of each group, with their place in column pick; fewer where there are fewer.

    Every task hands on n rows of a group at most: Spark limits ranks before the shuffle.
    """
    order = Window.partitionBy(group).orderBy(lot(seed, group, ties[0]), *ties)
    return rows.withColumn("pick", F.row_number().over(order)).where(F.col("pick") <= n)


def shuffled(items: Column, seed: int, key: Column) -> Column:
    """O-65, O-68: the array in the order of its items' lots."""
    drawn = F.transform(items, lambda x, i: F.struct(lot(seed, key, x, i.cast("string")).alias("lot"), x.alias("x")))
    return F.transform(F.array_sort(drawn), lambda d: d["x"])


def some_of(items: Column, n: int, seed: int, key: Column) -> Column:
    """O-68: all items, in order, if there are fewer than n; n of them in the order of their lots otherwise."""
    return F.when(F.size(items) < n, items).otherwise(F.slice(shuffled(items, seed, key), 1, n))


def two_operations(key: Column, seed: int) -> Column:
    """O-65: two different operations, in order."""
    return F.slice(shuffled(F.array(*[F.lit(o) for o in OPERATIONS]), seed, key), 1, 2)


def _odd(key: Column, seed: int) -> Column:
    return F.conv(F.substring(lot(seed, key), 1, 1), 16, 10).cast("int") % 2 == 1


def two_draws(key: Column, seed: int) -> Column:
    """O-66: replace or adjust, twice, each by a lot of its own."""
    return F.array(*[F.when(_odd(key, seed + k), "replace").otherwise("adjust") for k in range(2)])


def understand_order(key: Column, seed: int) -> Column:
    """O-67."""
    first, second = (F.array(*[F.lit(x) for x in order]) for order in UNDERSTAND)
    return F.when(_odd(key, seed), first).otherwise(second)
