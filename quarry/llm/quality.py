"""Quality classifier by positive-unlabelled learning.

Trusted positives are labelled rows of quality 1; every document outside the held-out fold is unlabelled web
text. A linear score g over piecewise-linear features of a text's shape minimises the non-negative unbiased
risk of the squared loss

    prior * E_P[(1 - g)^2 / 4] + max(0, E_U[(1 + g)^2 / 4] - prior * E_P[(1 + g)^2 / 4]).

Every term is a quadratic form in the weights, fixed by the first and second moments of the features among
positives and among unlabelled texts. The moments are summed over all documents in one distributed pass, and
only they (a few thousand numbers, whatever the input) reach the driver. The class prior is estimated from the
tails of the score: among unlabelled texts, the share above a threshold can't fall below prior times the share
among positives, and where scores are low that bound is close.

Cases: a null or empty text has its own feature values and a score like any other. Null labels are left out;
where a document has several labels, each counts. Without positives or without unlabelled texts every score
is 0.5. Repeated rows get equal scores. Ids keep their type; other columns are ignored. An empty table gives an
empty result.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, table

SPACES = " \t\n\x0b\x0c\r"
#: Feature: knots of its piecewise-linear hat functions.
KNOTS = {
    "log_words": (0.0, 2.0, 3.5, 5.0, 6.5, 8.0),
    "word_length": (0.0, 3.0, 4.5, 6.0, 8.0, 12.0),
    "length_spread": (0.0, 1.5, 2.5, 3.5, 5.0),
    "upper": (0.0, 0.03, 0.1, 0.3, 0.8),
    "digits": (0.0, 0.02, 0.1, 0.3),
    "symbols": (0.0, 0.02, 0.08, 0.2, 0.4),
    "marks": (0.0, 0.02, 0.05, 0.1, 0.25),
    "other": (0.0, 0.05, 0.2, 0.5),
    "capital_words": (0.0, 0.05, 0.2, 0.6),
    "odd_ends": (0.0, 0.05, 0.2, 0.6),
    "short_words": (0.0, 0.1, 0.25, 0.45, 0.7),
    "distinct": (0.0, 0.2, 0.45, 0.65, 0.85, 1.0),
    "top_word": (0.0, 0.05, 0.1, 0.2, 0.5),
    "neighbours": (0.0, 0.01, 0.05, 0.3),
    "repeated_pairs": (0.0, 0.05, 0.2, 0.5, 1.0),
    "repeated_lines": (0.0, 0.05, 0.2, 0.6),
    "line_words": (0.0, 1.0, 2.0, 3.5, 5.0),
    "stops": (0.0, 0.02, 0.06, 0.15, 0.4),
}
WIDTH = 1 + sum(map(len, KNOTS.values()))
BINS = 2000
RIDGE = 1e-4
ODD = re.compile(rb"[^A-Za-z0-9\x80-\xff.,;:?!'\")\]]$")


def shape(text: str) -> list[float]:
    """The values of the features, in the order of KNOTS."""
    data = text.encode()
    words, chars = data.split(), len(text) - sum(text.count(c) for c in SPACES)
    n = len(words)
    if not n:
        return [0.0] * len(KNOTS)
    sizes = np.fromiter(map(len, words), np.float64, n)
    kinds = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    size = len(data)
    counts = Counter(words)
    pairs = len(set(zip(words, words[1:])))
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    upper = int(kinds[65:91].sum())
    return [
        float(np.log1p(n)),
        chars / n,
        float(sizes.std()),
        upper / size,
        float(kinds[48:58].sum()) / size,
        float(sum(kinds[c] for c in b"#*$%&|<>{}~^=+_\\@")) / size,
        float(sum(kinds[c] for c in b"!?")) / size,
        float(kinds[128:].sum()) / size,
        sum(c for w, c in counts.items() if len(w) > 1 and w.isupper()) / n,
        sum(c for w, c in counts.items() if ODD.search(w)) / n,
        float((sizes <= 2).mean()),
        len(counts) / n,
        max(counts.values()) / n,
        sum(map(bytes.__eq__, words, words[1:])) / n,
        1 - pairs / max(1, n - 1) if n > 1 else 0.0,
        1 - len(set(lines)) / len(lines),
        float(np.log1p(n / len(lines))),
        float(sum(kinds[c] for c in b".,;:")) / n,
    ]


def design(shapes: np.ndarray) -> np.ndarray:
    """Hat functions of every feature, and a constant."""
    columns = [np.ones(len(shapes))]
    for k, knots in enumerate(KNOTS.values()):
        basis = np.eye(len(knots))
        columns += [np.interp(shapes[:, k], knots, basis[j]) for j in range(len(knots))]
    return np.stack(columns, axis=1)


def shapes_of(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) as (doc_id, shape)."""

    def run(batches):
        for b in batches:
            rows = [shape(t.as_py() or "") for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(rows, pa.list_(pa.float64()))], ["doc_id", "shape"])

    rows = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, shape array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return design(np.asarray(column.flatten()).reshape(len(column), len(KNOTS)))


def moments(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
    """Mean and mean outer product among positives and among unlabelled rows(shape, positives, unlabelled)."""
    upper = np.triu_indices(WIDTH)

    def run(batches):
        sums = np.zeros((2, upper[0].size))
        for b in batches:
            x = _matrix(b.column(0))
            for k in range(2):
                sums[k] += ((x * np.asarray(b.column(k + 1))[:, None]).T @ x)[upper]
        at = np.arange(sums.size)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(sums.ravel())], ["at", "value"])

    parts = rows.select("shape", F.col("positives").cast("double"), F.col("unlabelled").cast("double"))
    found = parts.mapInArrow(run, "at long, value double").groupBy("at").agg(F.sum("value").alias("value"))
    sums = np.zeros((2, upper[0].size))
    for r in found.collect():  # 2 * WIDTH * (WIDTH + 1) / 2 numbers
        sums.flat[r["at"]] = r["value"]
    out = []
    for s in sums:
        full = np.zeros((WIDTH, WIDTH))
        full[upper] = s
        full = full + full.T - np.diag(np.diag(full))
        if full[0, 0] <= 0:  # the constant feature counts the rows
            return None
        full /= full[0, 0]
        out += [full[0], full]
    return tuple(out)


def tails(rows: DataFrame, weights: np.ndarray) -> np.ndarray:
    """Counts of positives and unlabelled rows by bin of the score."""

    def run(batches):
        counts = np.zeros((2, BINS))
        for b in batches:
            g = np.clip((_matrix(b.column(0)) @ weights + 2) / 4, 0, 1 - 1e-9)
            for k in range(2):
                counts[k] += np.bincount((g * BINS).astype(int), np.asarray(b.column(k + 1)), minlength=BINS)
        at = np.flatnonzero(counts.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts.ravel()[at])], ["at", "value"])

    parts = rows.select("shape", F.col("positives").cast("double"), F.col("unlabelled").cast("double"))
    out = np.zeros((2, BINS))
    for r in parts.mapInArrow(run, "at long, value double").groupBy("at").agg(F.sum("value").alias("value")).collect():
        out.flat[r["at"]] = r["value"]
    return out


def class_prior(counts: np.ndarray) -> float:
    """Least ratio of the shares of unlabelled texts and positives above a threshold, with a margin for chance."""
    positives, unlabelled = (np.cumsum(c[::-1])[::-1] for c in counts)
    p, u = positives / positives[0], unlabelled / unlabelled[0]
    enough = p >= 0.1
    margin = np.sqrt(1 / np.maximum(positives, 1) + 1 / np.maximum(unlabelled, 1))
    return float(np.clip(((u / np.maximum(p, 1e-9)) * (1 + margin))[enough].min(), 0.02, 0.98))


def risk(w: np.ndarray, mean: np.ndarray, outer: np.ndarray, sign: int) -> tuple[float, np.ndarray]:
    """E[(1 + sign * g)^2 / 4] for g = x @ w, and its gradient, from the mean of x and of its outer product."""
    return (1 + 2 * sign * mean @ w + w @ outer @ w) / 4, (sign * mean + outer @ w) / 2


def objective(w: np.ndarray, prior: float, mean_p, outer_p, mean_u, outer_u) -> tuple[float, float, np.ndarray]:
    """(non-negative risk with its ridge, unlabelled part before it is held at zero, direction to descend against)."""
    r_p, d_p = risk(w, mean_p, outer_p, -1)
    n_p, e_p = risk(w, mean_p, outer_p, 1)
    n_u, e_u = risk(w, mean_u, outer_u, 1)
    rest, slope = n_u - prior * n_p, e_u - prior * e_p
    # a negative rest is below what a loss can be: climb back
    way = prior * d_p + slope if rest >= 0 else -slope
    return prior * r_p + max(0.0, rest) + RIDGE * w @ w / 4, rest, way + RIDGE * w / 2


def minimise(prior: float, mean_p, outer_p, mean_u, outer_u, rounds: int = 300) -> np.ndarray:
    """Non-negative risk by descent in the metric of the unlabelled moments, from the minimum of the unbiased risk."""
    metric = np.linalg.inv(outer_u + RIDGE * np.eye(len(mean_u)))
    w = metric @ (2 * prior * mean_p - mean_u)
    best, best_w = np.inf, w
    for _ in range(rounds):
        total, _, way = objective(w, prior, mean_p, outer_p, mean_u, outer_u)
        if total < best - 1e-12:
            best, best_w = total, w
        w = w - 0.2 * metric @ way
    return best_w


def fit(rows: DataFrame) -> np.ndarray:
    """Weights of the score from rows(shape, positives, unlabelled)."""
    found = moments(rows)
    if found is None:
        return np.zeros(WIDTH)
    # positives against unlabelled texts first; its tails give the prior
    mean_p, outer_p, mean_u, outer_u = found
    apart = np.linalg.solve((outer_p + outer_u) / 2 + RIDGE * np.eye(WIDTH), (mean_p - mean_u) / 2)
    rough = minimise(0.5, *found)
    prior = min(class_prior(tails(rows, w)) for w in (apart * 2 / max(1e-9, np.abs(apart).max()), rough))
    return minimise(prior, *found)


def scored(shapes: DataFrame, weights: np.ndarray) -> DataFrame:
    """shapes with score = (1 + g) / 2, within 0 and 1."""

    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        if not len(column):
            return pa.array([], pa.float64())
        rated = (_matrix(column) * weights).sum(axis=1)  # row by row, so that equal texts score alike wherever they lie
        return pa.array(np.clip((1 + rated) / 2, 0.0, 1.0), pa.float64())

    return shapes.withColumn("score", score("shape"))


def classify(docs: DataFrame, labels: DataFrame, held_out: Column) -> DataFrame:
    """(doc_id, held_out, score, predicted) for each row of docs(doc_id, text); held_out rows teach nothing."""
    shapes = materialise(shapes_of(docs).withColumn("held_out", held_out), "shapes")
    trusted = labels.where(F.col("quality") == 1).groupBy("doc_id").agg(F.count("*").alias("positives"))
    rows = shapes.where(~F.col("held_out")).join(trusted, "doc_id", "left")
    rows = materialise(rows.select("shape", F.coalesce("positives", F.lit(0)).alias("positives"), F.lit(1).alias("unlabelled")), "teaching")
    out = scored(shapes, fit(rows))
    return out.select("doc_id", "held_out", "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    return classify(docs, table(spark, sf_dir, "labels"), held_out)


QUERIES = {"op5_quality": op5_quality}
ORACLES: dict[str, str] = {}
