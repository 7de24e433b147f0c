"""Pairs of images of few boxes are looked at in one row each; those of larger ones in cells, with the same results."""

import random

import pytest

from quarry.operators import detect

BOX = "image_id long, idx int, class_name string, x1 double, y1 double, x2 double, y2 double"


@pytest.fixture
def boxes(spark):
    """Images of 1 to 12 wide boxes, one of 60, and boxes without image, class or corner."""
    r, rows = random.Random(11), []
    for image, n in [*((i, 1 + i % 12) for i in range(80)), (None, 9), (80, 60)]:
        for k in range(n):
            x, y = r.uniform(-900, 900), r.uniform(0, 900)
            rows.append((image, k, r.choice(["a", "b", "c", None]), x, y, x + r.choice((10.0, 700.0)), y + r.choice((10.0, 600.0)) if k % 7 else None))
    return spark.createDataFrame(rows, BOX).repartition(3)


@pytest.fixture
def checkpoints(monkeypatch):
    """Numbers of rows that were written in between."""
    seen, real = [], detect.written
    monkeypatch.setattr(detect, "written", lambda rows: (out := real(rows), seen.append(out.count()))[0])
    return seen


def joins(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("Join")


def test_draws_of_few_boxes_are_not_spread(spark, boxes, checkpoints):
    drawn = detect.drawn_pairs(boxes, n=3, seed=5)
    assert sum(checkpoints) == 0 and joins(drawn) == 0
    got = sorted(map(str, drawn.collect()))
    assert len(got) > 100
    assert got == sorted(map(str, detect.drawn_pairs(boxes, n=3, seed=5, fold_boxes=0).collect()))
    assert got == sorted(map(str, detect.drawn_pairs(boxes, n=3, seed=5, fold_boxes=20).collect()))


def test_counts_of_few_boxes_are_not_spread(spark, boxes, checkpoints):
    counts = detect.usable_pair_counts(boxes)
    assert sum(checkpoints) == 0 and joins(counts) == 0
    got = sorted(map(str, counts.collect()))
    assert len(got) > 60
    assert got == sorted(map(str, detect.usable_pair_counts(boxes, fold_boxes=0).collect()))
    assert got == sorted(map(str, detect.usable_pair_counts(boxes, fold_boxes=20).collect()))
