"""The classifiers' formulas against plain versions."""

import itertools

import numpy as np
from pyspark.sql import functions as F

from quarry.llm import quality, toxicity


def sums(weights, moves):
    """Marginals of the toxic state and expected transitions, by all sequences of tags."""
    n, total, p, pairs = len(weights), 0.0, np.zeros(len(weights)), np.zeros((2, 2))
    for tags in itertools.product((0, 1), repeat=n):
        w = np.exp(sum(x for x, t in zip(weights, tags) if t) + sum(moves[a, b] for a, b in zip(tags, tags[1:])))
        total, p = total + w, p + w * np.array(tags)
        for a, b in zip(tags, tags[1:]):
            pairs[a, b] += w
    return p / total, pairs / total


def test_marginals_by_enumeration():
    rng = np.random.default_rng(1)
    model = toxicity.Model(rng.normal(size=toxicity.SIZE) * 0.5, rng.normal(size=(2, 2)))
    for n in range(1, 9):
        words = [f"w{i}" for i in rng.integers(0, 50, n)]
        weights = [model.weights[toxicity.features(w)].sum() for w in words]
        assert np.allclose(model.marginals(words), sums(weights, model.moves)[0])


def test_expected_transitions_by_enumeration():
    rng = np.random.default_rng(2)
    emission, moves, on = rng.normal(size=(5, 8)) * 2, rng.normal(size=(2, 2)), np.ones((5, 8), bool)
    for i in range(5):
        on[i, 8 - i :] = False
    gaps, pairs = toxicity.expected(emission, moves, np.ones((5, 8)), on)
    plain = [sums(emission[i, : 8 - i], moves) for i in range(5)]
    assert np.allclose(pairs, sum(p for _, p in plain))
    assert all(np.allclose(1 - gaps[i, : 8 - i], plain[i][0]) and not gaps[i, 8 - i :].any() for i in range(5))


def test_explained_documents_no_longer_count():
    """One word explains most toxic texts; the others hold a rarer one, which only then stands out."""
    rng = np.random.default_rng(4)
    said = lambda n: " ".join(f"w{i}" for i in rng.integers(0, 4000, n))
    rows = [(f"{said(30)} vile {said(30)}", 1) for _ in range(120)] + [(f"{said(30)} rotten {said(30)}", 1) for _ in range(4)]
    rows += [(said(60), 0) for _ in range(500)]
    assert {"vile", "rotten"} <= toxicity.toxic_units(rows)
    assert toxicity.surprise(4, 4, 125 / 626) < toxicity.LEAST_NATS < toxicity.surprise(4, 4, 5 / 506)


def test_shared_passages_count_once():
    rng = np.random.default_rng(5)
    said = lambda n: " ".join(f"w{i}" for i in rng.integers(0, 4000, n))
    rows = [(f"{said(30)} vile {said(30)} here stands one common passage {said(5)}", 1) for _ in range(60)] + [(said(60), 0) for _ in range(300)]
    found = toxicity.toxic_units(rows)
    assert "vile" in found and found.isdisjoint({"stands", "one", "common"})
    assert [sorted(w) for w in toxicity.in_new_places(["a b c", "a b d", "x"])] == [["a", "b", "c"], ["b", "d"], ["x"]]


def test_long_labelled_texts_teach(spark):
    rng = np.random.default_rng(6)
    said = lambda n: " ".join(f"w{i}" for i in rng.integers(0, 900, n))
    docs = [(k, f"{said(20_000)} {'vile' if k % 2 else 'calm'} {said(20)}") for k in range(60)]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    model = toxicity.fit(docs, docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic")), F.lit(True))
    assert model.score("w1 vile w2")[1] == [{"start": 3, "stop": 7, "p": model.marginals(["w1", "vile", "w2"])[1]}]
    assert model.score("w1 calm w2")[1] == []


def moments(x):
    return x.mean(axis=0), x.T @ x / len(x)


def test_risk_against_samples():
    """The risk is the mean of the losses, and its direction their derivative by finite differences."""
    rng = np.random.default_rng(8)
    p, u = rng.normal(1, 1, (40, 6)), rng.normal(0, 1, (90, 6))
    seen = set()
    for scale, prior in itertools.product((0.1, 0.5, 3.0), (0.1, 0.9)):
        w = rng.normal(size=6) * scale

        def parts(w):
            g, h = p @ w, u @ w
            return prior * ((1 - g) ** 2 / 4).mean(), ((1 + h) ** 2 / 4).mean() - prior * ((1 + g) ** 2 / 4).mean()

        total, rest, way = quality.objective(w, prior, *moments(p), *moments(u))
        first, second = parts(w)
        assert np.isclose(total, first + max(0.0, second) + quality.RIDGE * w @ w / 4) and np.isclose(rest, second)
        sign = rest >= 0
        seen.add(sign)
        down = [(sum(parts(w + d)) - sum(parts(w - d)) if sign else -(parts(w + d)[1] - parts(w - d)[1])) / 2e-5 for d in 1e-5 * np.eye(6)]
        assert np.allclose(way, down + quality.RIDGE * w / 2, atol=1e-5)
    assert seen == {True, False}  # both branches were met


def test_minimum_of_the_non_negative_risk():
    """With few positives in many dimensions, the unbiased minimum has a negative part; the result has less risk."""
    rng = np.random.default_rng(9)
    p, u = rng.normal(0.5, 1, (12, 30)), rng.normal(0, 1, (200, 30))
    found = (0.7, *moments(p), *moments(u))
    start = np.linalg.inv(found[4] + quality.RIDGE * np.eye(30)) @ (2 * 0.7 * found[1] - found[3])
    w = quality.minimise(*found)
    assert quality.objective(start, *found)[1] < 0 and quality.objective(w, *found)[0] < quality.objective(start, *found)[0]


def test_prior_of_a_known_mixture():
    rng = np.random.default_rng(10)
    for prior in (0.2, 0.5, 0.8):
        positive = rng.normal(1, 0.5, 20_000)
        mixed = np.concatenate([rng.normal(1, 0.5, int(prior * 40_000)), rng.normal(-1, 0.5, int((1 - prior) * 40_000))])
        counts = np.stack([np.histogram(x, quality.BINS, (-4, 4))[0] for x in (positive, mixed)])
        assert abs(quality.class_prior(counts.astype(float)) - prior) < 0.04
