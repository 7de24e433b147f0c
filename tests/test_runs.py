import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.functions import masks, runs


def drawn(seed, h, w, share):
    return (np.random.default_rng(seed).random((h, w)) < share).astype(np.uint8)


SIDES = st.tuples(st.integers(1, 20), st.integers(1, 20))


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 10**6), st.lists(st.tuples(SIDES, SIDES, st.sampled_from([0.0, 0.05, 0.5, 0.95, 1.0])), min_size=1, max_size=5))
def test_algebra_equals_pixels(seed, kinds):
    """Batches of masks of several sizes."""
    a = [drawn(seed + k, *sides, share) for k, (sides, _, share) in enumerate(kinds)]
    b = [drawn(seed - k, *sides, 0.4) for k, (sides, _, _) in enumerate(kinds)]
    x, y = (runs.decoded([masks.encode(m) for m in part]) for part in (a, b))
    old, new = (np.array([k[i] for k in kinds]).T for i in (0, 1))
    texts = lambda pixels: [masks.encode(m) for m in pixels]
    assert runs.encoded(x) == texts(a) and x.size.tolist() == [m.size for m in a] and x.area().tolist() == [m.sum() for m in a]
    assert runs.encoded(runs.met(x, y, 1, 1)) == texts(m | n for m, n in zip(a, b))
    assert runs.encoded(runs.met(x, y, 1, 2)) == texts(m & n for m, n in zip(a, b))
    assert runs.encoded(runs.met(x, y, -1, 1)) == texts(m & (1 - n) for m, n in zip(a, b))
    assert runs.encoded(runs.resized(x, *old, *new)) == texts(masks.nearest(m, *k[1]) for m, k in zip(a, kinds))
    for found, at in zip(runs.boxes(x, old[0]), map(np.argwhere, a)):
        assert found == ([at[:, 1].min(), at[:, 0].min(), at[:, 1].max() + 1, at[:, 0].max() + 1] if at.size else None)


def test_large_runs_and_broken_texts():
    lengths = [3, 10**9, 7, 5 * 10**9, 1, 2]
    text = masks.text_of(lengths)
    assert runs.encoded(runs.decoded([text, "", text])) == [text, masks.text_of([0]), text]
    assert runs.decoded([masks.text_of([2, 0, 3, 1])]).ends.tolist() == [5, 6] and runs.encoded(runs.decoded([])) == []
    for text in ("o", "0\x01", "O"):
        with pytest.raises(ValueError):
            runs.decoded(["5", text, "5"])


def test_columns_take_nulls(spark):
    a, b = drawn(1, 6, 5, 0.5), drawn(2, 6, 5, 0.5)
    rows = [(masks.encode(a), masks.encode(b)), (None, masks.encode(b)), (masks.encode(a * 0), masks.encode(b * 0))]
    df = spark.createDataFrame(rows, "a string, b string")
    six, five = F.lit(6), F.lit(5)
    out = df.select(
        runs.mask_union("a", "b"), runs.mask_overlap("a", "b"), runs.mask_box("a", six), runs.mask_touches_border("a", six, five),
        runs.mask_resized("a", six, five, five, six), masks.resize_mask("a", six, five, five, six),
    ).collect()
    assert out[0][0] == masks.encode(a | b) and out[0][1] == (a & b).sum() / (a | b).sum() and out[0][4] == out[0][5]
    assert all(v is None for v in out[1]) and out[2][1] is None and out[2][2] is None and out[2][3] is False


def test_union_by_key(spark):
    """A hot key, a null key, null masks, repeated rows, and a column that is called as the salt."""
    parts = [(k % 3 if k % 3 else None, masks.encode(drawn(k, 9, 7, 0.02))) for k in range(300)] + [(7, None), (8, None), (8, masks.encode(drawn(0, 9, 7, 0.3)))]
    df = spark.createDataFrame(parts * 2, "_salt long, m string").repartition(6)
    found = {r._salt: r.m for r in runs.union_by(df, ["_salt"], "m", salts=2).collect()}
    whole = {}
    for k, m in parts:
        whole[k] = whole.get(k, 0) | masks.decode(m, 9, 7) if m else whole.get(k, 0)
    assert found == {k: None if isinstance(m, int) else masks.encode(m) for k, m in whole.items()}
    lists = spark.createDataFrame([(1, [parts[0][1], None, parts[1][1]]), (2, [None]), (3, []), (4, None)], "k int, m array<string>")
    both = masks.decode(parts[0][1], 9, 7) | masks.decode(parts[1][1], 9, 7)
    assert [r[0] for r in lists.orderBy("k").select(runs.mask_of_all("m")).collect()] == [masks.encode(both), None, None, None]
    assert runs.union_by(df.limit(0), ["_salt"], "m").count() == 0
