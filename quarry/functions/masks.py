"""Run-length masks (O-44 to O-47): column-major runs that begin with zeros, in the compressed COCO text form."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StringType


def runs_of(text: str) -> list[int]:
    """Lengths of the runs: groups of five bits, low ones first; from the fourth run on, differences to two before."""
    out, value, shift = [], 0, 0
    for c in text.encode():
        bits = c - 48
        value |= (bits & 31) << shift
        shift += 5
        if bits & 32:
            continue
        if bits & 16:
            value -= 1 << shift
        out.append(value + (out[-2] if len(out) > 2 else 0))
        value = shift = 0
    return out


def text_of(runs: list[int]) -> str:
    out = []
    for i, n in enumerate(runs):
        value = n - runs[i - 2] if i > 2 else n
        while True:
            bits = value & 31
            value >>= 5
            last = value == (-1 if bits & 16 else 0)
            out.append(chr((bits if last else bits | 32) + 48))
            if last:
                break
    return "".join(out)


def decode(text: str, height: int, width: int) -> np.ndarray:
    """Array of height by width with ones inside the mask."""
    runs = runs_of(text)
    flat = np.repeat(np.arange(len(runs)) % 2, runs).astype(np.uint8)
    if flat.size != height * width:
        raise ValueError(f"{flat.size} pixels in the mask, {height * width} in the image")
    return flat.reshape(width, height).T


def encode(mask: np.ndarray) -> str:
    flat = np.asarray(mask, np.uint8).T.ravel()
    edges = np.flatnonzero(np.diff(flat)) + 1
    runs = np.diff(np.concatenate([[0], edges, [flat.size]])).tolist()
    return text_of([0, *runs] if flat.size and flat[0] else runs)


def nearest(mask: np.ndarray, height: int, width: int) -> np.ndarray:
    rows = (np.arange(height) * mask.shape[0] // height).clip(max=mask.shape[0] - 1)
    columns = (np.arange(width) * mask.shape[1] // width).clip(max=mask.shape[1] - 1)
    return mask[np.ix_(rows, columns)]


@F.pandas_udf(LongType())
def mask_area(text: pd.Series) -> pd.Series:
    """Pixels inside; null masks have none to count and stay null."""
    return text.map(lambda t: sum(runs_of(t)[1::2]), na_action="ignore").astype("Int64")


@F.pandas_udf(BinaryType())
def edit_region(text: pd.Series, height: pd.Series, width: pd.Series) -> pd.Series:
    """O-45: row by row, 0 inside the mask and 255 outside; null where any input is null."""
    def one(t, h, w):
        return None if t is None or pd.isna(h) or pd.isna(w) else ((1 - decode(t, int(h), int(w))) * 255).tobytes()

    return pd.Series([one(*x) for x in zip(text, height, width)], dtype=object)


@F.pandas_udf(StringType())
def encode_mask(pixels: pd.Series, height: pd.Series, width: pd.Series) -> pd.Series:
    """O-44: rows of zero and other bytes as run-length text."""
    def one(p, h, w):
        return None if p is None else encode(np.frombuffer(p, np.uint8).reshape(int(h), int(w)) != 0)

    return pd.Series([one(*x) for x in zip(pixels, height, width)], dtype=object)


@F.pandas_udf(StringType())
def resize_mask(text: pd.Series, height: pd.Series, width: pd.Series, new_height: pd.Series, new_width: pd.Series) -> pd.Series:
    """O-46: by nearest pixel."""
    def one(t, h, w, h2, w2):
        return None if t is None else encode(nearest(decode(t, int(h), int(w)), int(h2), int(w2)))

    return pd.Series([one(*x) for x in zip(text, height, width, new_height, new_width)], dtype=object)


@F.pandas_udf(BinaryType())
def with_alpha(rgb: pd.Series, region: pd.Series) -> pd.Series:
    """O-47: RGB bytes and one alpha byte a pixel as RGBA bytes."""
    def one(p, a):
        if p is None or a is None:
            return None
        return np.column_stack([np.frombuffer(p, np.uint8).reshape(-1, 3), np.frombuffer(a, np.uint8)]).tobytes()

    return pd.Series([one(*x) for x in zip(rgb, region)], dtype=object)
