"""The mixture against a plain plan and cut, and its order."""

import random
import struct

import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quarry.llm import mixing


def place(doc_id, epoch):
    """doc_id: an id, or (id or None, text), as nulls leave a hash as it is."""
    doc_id, text = doc_id if isinstance(doc_id, tuple) else (doc_id, None)
    out = xxhash.xxh64_intdigest(struct.pack("<i", mixing.SEED), 42)
    parts = [struct.pack("<q", epoch)] + ([] if doc_id is None else [struct.pack("<q", doc_id)])
    for x in parts + ([] if text is None else [struct.pack("<Q", xxhash.xxh64_intdigest(text.encode(), 42))]):
        out = xxhash.xxh64_intdigest(x, out)
    return out >> 1


def plain(rows, limit, budget=None):
    """[(doc_id, epoch)] of the mixture of rows(doc_id, source, size), and the weights."""
    tokens = {}
    for _, s, n in rows:
        tokens[s] = tokens.get(s, 0) + n

    def passes(a):
        whole = sum(n**a for n in tokens.values())
        spent = budget or max(n / n**a for n in tokens.values()) * whole
        return {s: spent * n**a / whole / n for s, n in tokens.items()}

    low, high = 0.0, 1.0
    if max(passes(low).values()) <= limit:
        high = low
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (low, mid) if max(passes(mid).values()) <= limit else (mid, high)
    out, whole = [], sum(n**high for n in tokens.values())
    for s, times in passes(high).items():
        own = [(i, n) for i, t, n in rows if t == s]
        epochs = int(times + 1e-9)
        out += [(i, e) for e in range(epochs) for i, _ in own]
        left = (times + 1e-9 - epochs) * tokens[s]
        for i, n in sorted(own, key=lambda x: place(x[0], epochs)):
            left -= n
            if left < 0:
                break
            out.append((i, epochs))
    return out, {s: n**high / whole for s, n in tokens.items()}


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(3)
    rows = [(k, rng.choice("aaaaaaaabbbcd"), rng.randint(1, 60)) for k in range(600)]
    return rows, spark.createDataFrame(rows, "doc_id long, source string, size long")


@pytest.mark.parametrize(("limit", "budget"), [(2.0, None), (1.3, None), (3.0, 30_000), (2.0, 9_000)])
def test_against_plain_plan(docs, limit, budget):
    rows, df = docs
    mixed = mixing.mix(df, mixing.Target(repetition=limit), budget, F.col("size"), block_docs=50)
    expected, weights = plain(rows, limit, budget)
    found = mixed.select("doc_id", "source", "_mix.*").collect()
    assert sorted((r.doc_id, r.epoch) for r in found) == sorted(expected)
    assert all(r.place == place(r.doc_id, r.epoch) and abs(r.weight - weights[r.source]) < 1e-6 for r in found)
    assert max(r.epoch for r in found) < limit


def test_budget_that_breaks_the_limit(docs):
    rows, df = docs
    with pytest.raises(ValueError, match="limit"):
        mixing.mix(df, mixing.Target(repetition=2.0), 2.5 * sum(n for _, _, n in rows), F.col("size"))


def test_every_stretch_is_at_target_weights(docs):
    rows, df = docs
    found = sorted(mixing.mix(df, tokens=F.col("size")).select("source", "_mix.*").collect(), key=lambda r: r.position)
    total, spent, worst = sum(r.n_tokens for r in found), {}, 0
    for r in found:
        spent[r.source] = spent.get(r.source, 0) + r.n_tokens
        worst = max(worst, abs(spent[r.source] - r.weight * sum(spent.values())))
    assert worst < 0.03 * total  # by epoch first, the small sources would fall short by more than a tenth


@pytest.mark.parametrize("budget", [None, 6_000, 9_000, 14_000])
def test_budgets_hold_where_ids_are_null_or_shared(spark, budget):
    """A third of the rows have no id, and a tenth share one; the plan is keyed by id and text."""
    rng = random.Random(8)
    rows = [(None if k % 3 == 0 else 7 if k % 10 == 1 else k, f"text {k}", rng.choice("aaaaab"), rng.randint(1, 40)) for k in range(800)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, size long")
    found = mixing.mix(df, mixing.Target(), budget, F.col("size"), block_docs=50).select("doc_id", "text", "source", "_mix.*").collect()
    expected, weights = plain([((i, t), s, n) for i, t, s, n in rows], mixing.MAX_REPETITION, budget)
    assert sorted([((r.doc_id, r.text), r.epoch) for r in found], key=key_of) == sorted(expected, key=key_of)
    assert all(r.place == place((r.doc_id, r.text), r.epoch) for r in found)
    if budget:
        for s, w in weights.items():
            assert abs(sum(r.n_tokens for r in found if r.source == s) - w * budget) <= 40  # a document
    # and every stretch is at target weights
    spent = {}
    for r in sorted(found, key=lambda r: r.position):
        spent[r.source] = spent.get(r.source, 0) + r.n_tokens
        assert abs(spent[r.source] - r.weight * sum(spent.values())) < 0.05 * sum(r.n_tokens for r in found)


def key_of(x):
    return str(x[0][0]), x[0][1], x[1]


def test_tokens_are_those_of_the_vocabulary(spark, sf):
    encode = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = mixing.op6_mixing(spark, sf).select("doc_id", "n_tokens").distinct().collect()
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    assert {r.doc_id: r.n_tokens for r in found} == {i: len(encode(t, add_special_tokens=False).ids) for i, t in texts.items()}


def test_clashing_names(spark):
    rows = [(1, "a", "x", 1, 2, 3, 4), (None, None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, _Plan int, _epoch int, _size int, _mix int")
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and mixed.select("_Plan", "_epoch", "_size").collect()[0] == (1, 2, 3) and mixed.count() == 2
