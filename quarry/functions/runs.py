"""Masks as runs (O-44 to O-47): union, difference, overlap, box and resizing on the ends of runs, without pixels.

All masks of a batch are worked on at once, as Masks: the rising places at which they begin and end, column by column, each
mask's after the one before. Work grows with the runs, for resizing also with the columns, never with the pixels. Null masks
give null, masks of different sizes are met place by place, and a text that is no mask is an error.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, LongType, StringType

from quarry.functions.names import unused

#: Groups that the masks of one key are first united in.
SALTS = 64


def _inside(counts: np.ndarray) -> np.ndarray:
    """0, 1, ... in each of the stretches of so many places."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def _sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Running totals, anew in each of the stretches of so many values."""
    total, first = np.cumsum(values), np.cumsum(counts) - counts
    before = np.concatenate([[0], total])[first]
    return total - np.repeat(before, counts)


@dataclass
class Masks:
    """ends: begin, end, begin, end, ... of every run; owner: the mask of each; size: pixels of every mask."""

    ends: np.ndarray
    owner: np.ndarray
    size: np.ndarray

    @property
    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(begin, end, owner) of each run."""
        return self.ends[0::2], self.ends[1::2], self.owner[0::2]

    def area(self) -> np.ndarray:
        begin, end, owner = self.runs
        out = np.zeros(self.size.size, np.int64)
        np.add.at(out, owner, end - begin)
        return out


def swept(ends: np.ndarray, owner: np.ndarray, step: np.ndarray, size: np.ndarray, least: int) -> Masks:
    """Where the steps of the runs that cover a place sum to least or more; ends in any order, with what each adds."""
    stride = int(size.max(initial=0)) + 1
    places, where = np.unique(owner * stride + ends, return_inverse=True)
    inside = np.cumsum(np.bincount(where, step, places.size)) >= least
    places = places[np.diff(inside, prepend=False)]
    return Masks(places % stride, places // stride, size)


def _of_runs(begin: np.ndarray, end: np.ndarray, owner: np.ndarray, size: np.ndarray) -> Masks:
    return swept(np.column_stack([begin, end]).ravel(), np.repeat(owner, 2), np.tile([1, -1], begin.size), size, 1)


def decoded(texts: list[str]) -> Masks:
    """Groups of five bits make the lengths of runs, zeros first; from a mask's fourth run on they are differences to two before."""
    bits = np.frombuffer("".join(texts).encode(), np.uint8).astype(np.int64) - 48
    long = np.array([len(t) for t in texts], np.int64)
    ended = (bits & 32) == 0
    stops = np.cumsum(long)[long > 0] - 1
    if long.sum() != bits.size or not ended[stops].all() or ((bits < 0) | (bits > 63)).any():
        raise ValueError("no run-length text")
    last = np.flatnonzero(ended)
    first = np.concatenate([[0], last[:-1] + 1]).astype(np.int64)[: last.size]
    groups = last - first + 1
    values = np.add.reduceat((bits & 31) << (5 * _inside(groups)), first) if last.size else last
    values = values - np.where(bits[last] & 16, 1 << (5 * groups), 0)
    owner = np.repeat(np.arange(len(texts)), long)[last]
    count = np.bincount(owner, minlength=len(texts)).astype(np.int64)
    place = _inside(count)
    chain = owner * 3 + np.where(place == 0, 0, 2 - place % 2)  # the first run, those of the mask, those between
    order = np.argsort(chain, kind="stable")
    lengths = np.empty_like(values)
    lengths[order] = _sums(values[order], np.unique(chain, return_counts=True)[1])
    if (lengths < 0).any():
        raise ValueError("a run of negative length")
    at = _sums(lengths, count)
    size = np.zeros(len(texts), np.int64)
    size[owner] = at  # the last one of each counts
    paired = place < np.repeat(count // 2 * 2, count)
    return swept(at[paired], owner[paired], np.where(place[paired] % 2, -1, 1), size, 1)


def encoded(masks: Masks) -> list[str]:
    n = masks.size.size
    count = np.bincount(masks.owner, minlength=n).astype(np.int64)
    final = np.full(n, -1, np.int64)
    final[masks.owner] = masks.ends
    open_ = np.flatnonzero(final != masks.size)
    owner = np.concatenate([masks.owner, open_])
    order = np.argsort(owner, kind="stable")
    at, owner = np.concatenate([masks.ends, masks.size[open_]])[order], owner[order]
    count[open_] += 1
    place = _inside(count)
    lengths = at - np.where(place, np.concatenate([[0], at[:-1]])[: at.size], 0)
    values = lengths - np.where(place > 2, np.concatenate([[0, 0], lengths[:-2]])[: at.size], 0)
    groups, half = np.ones(values.size, np.int64), 16
    while (more := (values >= half) | (values < -half)).any():
        groups, half = groups + more, half << 5
    k = _inside(groups)
    bits = (np.repeat(values, groups) >> (5 * k)) & 31
    bits = np.where(k < np.repeat(groups, groups) - 1, bits | 32, bits) + 48
    text = bits.astype(np.uint8).tobytes().decode()
    stops = np.cumsum(np.bincount(owner, groups, n).astype(np.int64)).tolist()
    return [text[a:b] for a, b in zip([0, *stops], stops)]


def met(a: Masks, b: Masks, sign: int, least: int) -> Masks:
    """Mask by mask: sign 1 and least 1 for the union, 1 and 2 for what both have, -1 and 1 for what a alone has."""
    step = np.concatenate([np.tile([1, -1], a.ends.size // 2), np.tile([sign, -sign], b.ends.size // 2)])
    return swept(np.concatenate([a.ends, b.ends]), np.concatenate([a.owner, b.owner]), step, np.maximum(a.size, b.size), least)


def boxes(masks: Masks, height: np.ndarray) -> list[list[int] | None]:
    """[x1, y1, x2, y2], ends exclusive; null for an empty mask."""
    begin, end, owner = masks.runs
    h = height[owner]
    across = begin // h != (end - 1) // h  # such a run meets the lowest row and the first one
    sides = begin // h, np.where(across, 0, begin % h), (end - 1) // h + 1, np.where(across, h, (end - 1) % h + 1)
    out: list[list[int] | None] = [None] * masks.size.size
    if owner.size:
        known, first = np.unique(owner, return_index=True)
        found = [how.reduceat(s, first).tolist() for how, s in zip((np.minimum, np.minimum, np.maximum, np.maximum), sides)]
        for k, b in zip(known.tolist(), zip(*found)):
            out[k] = list(b)
    return out


def resized(masks: Masks, height: np.ndarray, width: np.ndarray, new_height: np.ndarray, new_width: np.ndarray) -> Masks:
    """By nearest pixel: row y of the new mask is row y * height // new_height of the old one, columns likewise."""
    if (masks.size != height * width).any():
        raise ValueError("a mask and its image differ in pixels")
    begin, end, owner = masks.runs
    h = height[owner]
    first, last = begin // h, (end - 1) // h
    n = last - first + 1
    own, k, left_over = np.repeat(owner, n), _inside(n), np.repeat(n, n)
    column, h = np.repeat(first, n) + k, np.repeat(h, n)
    top = np.where(k == 0, np.repeat(begin, n) % h, 0)
    bottom = np.where(k == left_over - 1, (np.repeat(end, n) - 1) % h + 1, h)
    up = lambda x, old, new: -(-x * new // old)
    top, bottom = up(top, h, new_height[own]), up(bottom, h, new_height[own])
    left, right = up(column, width[own], new_width[own]), up(column + 1, width[own], new_width[own])
    copies = np.where(bottom > top, right - left, 0)
    own = np.repeat(own, copies)
    start = (np.repeat(left, copies) + _inside(copies)) * new_height[own]
    return _of_runs(start + np.repeat(top, copies), start + np.repeat(bottom, copies), own, new_height * new_width)


def drawn(x1: np.ndarray, y1: np.ndarray, x2: np.ndarray, y2: np.ndarray, height: np.ndarray, width: np.ndarray) -> Masks:
    """Boxes of whole pixels, ends exclusive, cut to their images."""
    x1, y1, x2, y2 = np.maximum(x1, 0), np.maximum(y1, 0), np.minimum(x2, width), np.minimum(y2, height)
    columns = np.where(y2 > y1, np.maximum(x2 - x1, 0), 0)
    own = np.repeat(np.arange(x1.size), columns)
    start = (x1[own] + _inside(columns)) * height[own]
    return _of_runs(start + y1[own], start + y2[own], own, height * width)


def _known(how, *columns: pd.Series) -> pd.Series:
    """how() of the rows that have no null, as a list; null for the others."""
    whole = ~pd.concat([c.isna() for c in columns], axis=1).any(axis=1).to_numpy()
    out = np.full(len(whole), None, object)
    kept = [c.to_numpy()[whole] for c in columns]
    found = how(*[c.astype(np.int64) if pd.api.types.is_numeric_dtype(c.dtype) else c.tolist() for c in kept]) if whole.any() else []
    for k, v in zip(np.flatnonzero(whole), found):
        out[k] = v
    return pd.Series(out)


@F.pandas_udf(StringType())
def mask_union(a: pd.Series, b: pd.Series) -> pd.Series:
    return _known(lambda x, y: encoded(met(decoded(x), decoded(y), 1, 1)), a, b)


@F.pandas_udf(StringType())
def mask_intersection(a: pd.Series, b: pd.Series) -> pd.Series:
    return _known(lambda x, y: encoded(met(decoded(x), decoded(y), 1, 2)), a, b)


@F.pandas_udf(StringType())
def mask_difference(a: pd.Series, b: pd.Series) -> pd.Series:
    """What is in a and not in b."""
    return _known(lambda x, y: encoded(met(decoded(x), decoded(y), -1, 1)), a, b)


@F.pandas_udf(DoubleType())
def mask_overlap(a: pd.Series, b: pd.Series) -> pd.Series:
    """Pixels in both by pixels in either; null where both are empty."""

    def share(x, y):
        x, y = decoded(x), decoded(y)
        both, either = met(x, y, 1, 2).area().tolist(), met(x, y, 1, 1).area().tolist()
        return [p / q if q else None for p, q in zip(both, either)]

    return _known(share, a, b)


@F.pandas_udf(BooleanType())
def mask_touches_border(text: pd.Series, height: pd.Series, width: pd.Series) -> pd.Series:
    """Whether the mask meets the border of its image."""

    def touches(t, h, w):
        return [b is not None and (0 in b[:2] or b[2] == x or b[3] == y) for b, y, x in zip(boxes(decoded(t), h), h, w)]

    return _known(touches, text, height, width)


@F.pandas_udf(ArrayType(LongType()))
def mask_box(text: pd.Series, height: pd.Series) -> pd.Series:
    return _known(lambda t, h: boxes(decoded(t), h), text, height)


@F.pandas_udf(StringType())
def mask_resized(text: pd.Series, height: pd.Series, width: pd.Series, new_height: pd.Series, new_width: pd.Series) -> pd.Series:
    """O-46; equal to masks.resize_mask, which goes over pixels."""
    return _known(lambda t, *sides: encoded(resized(decoded(t), *sides)), text, height, width, new_height, new_width)


@F.pandas_udf(StringType())
def box_mask(x1: pd.Series, y1: pd.Series, x2: pd.Series, y2: pd.Series, height: pd.Series, width: pd.Series) -> pd.Series:
    """The mask of a box of whole pixels, ends exclusive, cut to its image."""
    return _known(lambda *sides: encoded(drawn(*sides)), x1, y1, x2, y2, height, width)


def united(texts: list[str], group: np.ndarray, groups: int) -> list[str]:
    """The union of the masks of each group, which all have one; as large as the largest of them."""
    masks = decoded(texts)
    size = np.zeros(groups, np.int64)
    np.maximum.at(size, group, masks.size)
    begin, end, owner = masks.runs
    return encoded(_of_runs(begin, end, group[owner], size))


@F.pandas_udf(StringType())
def mask_of_all(texts: pd.Series) -> pd.Series:
    """The union of an array of masks, nulls left out; null for an empty array."""
    known = texts.map(lambda t: [x for x in t if x is not None], na_action="ignore")
    count = known.map(len, na_action="ignore").fillna(0).astype(np.int64).to_numpy()
    out = np.full(len(texts), None, object)
    some = np.flatnonzero(count)
    if some.size:
        out[some] = united([x for k in some for x in known.iloc[k]], np.repeat(np.arange(some.size), count[some]), some.size)
    return pd.Series(out)


def union_by(rows: DataFrame, keys: list[str], mask: str, salts: int = SALTS) -> DataFrame:
    """One row for each of keys, nulls together, with the union of its masks in column mask; null where it has none.

    Masks of a key are united inside each batch of a task, and again after a shuffle by salted keys, then what is left of a key: a hot
    key is spread over salts tasks, and the last step meets one of its masks for each salt and batch there, not one a row.
    """
    salt, row = unused(rows, "_salt", "_row")
    kept = rows.select(*keys, mask)

    def partial(batches):
        for b in batches:
            if not b.num_rows:
                continue
            table = pa.Table.from_batches([b]).append_column(row, pa.array(range(b.num_rows)))
            groups = table.group_by(keys).aggregate([(row, "list")]).combine_chunks()  # nulls are a group
            lists = groups[f"{row}_list"].chunk(0)
            texts = b.column(mask).take(lists.flatten())
            place = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())[pc.is_valid(texts).to_numpy(zero_copy_only=False)]
            known, group = np.unique(place, return_inverse=True)
            out = np.full(len(lists), None, object)
            if known.size:
                out[known] = united(texts.drop_null().to_pylist(), group, known.size)
            columns = [pa.array(out, pa.string()) if c == mask else groups[c].chunk(0) for c in b.schema.names]
            yield pa.RecordBatch.from_arrays(columns, b.schema.names)

    near = kept.mapInArrow(partial, kept.schema).withColumn(salt, F.spark_partition_id() % salts)
    near = near.repartition(*keys, salt).sortWithinPartitions(*keys).drop(salt).mapInArrow(partial, kept.schema)
    return near.groupBy(*keys).agg(mask_of_all(F.collect_list(mask)).alias(mask))
