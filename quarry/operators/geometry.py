"""Image and box predicates as column expressions. Boxes are columns x1, y1, x2, y2 of doubles."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Limits:
    """Shares of the image's area (low is out, high is in), then: a clip score that suffices, or area and score."""

    low: float
    high: float
    area: float
    score: float
    clip: float


#: Fixed values of the two kinds of edit target (O-14, O-15).
OBJECT = Limits(low=0.01, high=0.6, area=0.08, score=0.8, clip=0.8)
BACKGROUND = Limits(low=0.4, high=0.7, area=0.4, score=0.75, clip=0.7)
MIN_AESTHETIC, MIN_SIDE, MIN_GAP = 4.75, 512, 100.0
TARGET_SIDE, MULTIPLE = 512, 16


def good_images(images: DataFrame, aesthetic: float = MIN_AESTHETIC, side: int = MIN_SIDE) -> DataFrame:
    """O-12, O-13: all three strictly above; nulls go. The comparison is on bare columns, so it reaches the scan."""
    return images.where((F.col("aes") > F.lit(float(aesthetic))) & (F.col("height") > side) & (F.col("width") > side))


def box_area(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return (x2 - x1) * (y2 - y1)


def is_target(area: Column, image_area: Column, score: Column, clip: Column, limits: Limits = OBJECT) -> Column:
    inside = (area > limits.low * image_area) & (area <= limits.high * image_area)
    return inside & ((clip >= limits.clip) | ((area >= limits.area * image_area) & (score >= limits.score)))


def far_apart(a: dict[str, Column], b: dict[str, Column], gap: float = MIN_GAP) -> Column:
    """O-18: the boxes neither meet nor touch, and are more than gap apart."""
    none = F.lit(0.0)
    dx = F.greatest(none, b["x1"] - a["x2"], a["x1"] - b["x2"])
    dy = F.greatest(none, b["y1"] - a["y2"], a["y1"] - b["y2"])
    return ((dx > 0) | (dy > 0)) & (F.sqrt(dx * dx + dy * dy) > gap)


def usable_pair(a: Column, b: Column, gap: float = MIN_GAP) -> Column:
    """O-17, O-18: two structs of class_name and box that a two-object edit may take."""
    corners = lambda x: {c: x[c] for c in ("x1", "y1", "x2", "y2")}
    return (a["class_name"] != b["class_name"]) & far_apart(corners(a), corners(b), gap)


def fitted(height: Column, width: Column, side: int = TARGET_SIDE, multiple: int = MULTIPLE) -> Column:
    """O-48: struct(height, width, top, left): the shorter side becomes side, both are cut to a multiple, centred."""
    short = F.least(height, width)
    tall = F.floor(height * side / short).cast("long")
    wide = F.floor(width * side / short).cast("long")
    h, w = tall - tall % multiple, wide - wide % multiple
    half = lambda x: F.floor(x / 2).cast("long")
    return F.struct(h.alias("height"), w.alias("width"), half(tall - h).alias("top"), half(wide - w).alias("left"))
