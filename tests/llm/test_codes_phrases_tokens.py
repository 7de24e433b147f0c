"""Vector codes, collocations and tree-joined tokens against plain versions, on made-up and odd tables."""

import hashlib
import random
from collections import Counter
from itertools import groupby

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quarry.llm import bpe_tree, collocations, vector_codes
from quarry.llm.common import table


def plain_codes(rows, entries=256, rounds=4):
    """{row: (code, error)} and the digest of the codebooks, for rows of (id, label, vector)."""
    kept = [r for r in rows if r[2] and all(x is not None and np.isfinite(x) for x in r[2])]
    whole = [[int(np.floor(1024 * x)) for x in r[2]] for r in kept]
    parts = [[w[p * len(w) // 4 : (p + 1) * len(w) // 4] for p in range(4)] for w in whole]
    order = sorted(range(len(kept)), key=lambda i: (kept[i][0] is None, kept[i][0] or 0, kept[i][2]))[:entries]
    books = [[parts[i][p] for i in order] for p in range(4)]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    best = lambda v, p: min((apart(v, c), k) for k, c in enumerate(books[p]))
    for _ in range(rounds):
        for p in range(4):
            own = [best(v[p], p)[1] for v in parts]
            for k in set(own):
                mine = [v[p] for v, o in zip(parts, own) if o == k]
                books[p][k] = [sum(c) // len(mine) for c in zip(*mine)]
    found = [[best(v[p], p) for p in range(4)] for v in parts]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    errors = [sum(d for d, _ in f) for f in found]
    by_label = Counter()
    for r, e in zip(kept, errors):
        by_label[r[1]] += e
    return Counter((r[0], "".join(f"{k:02x}" for _, k in f), e, by_label[r[1]], digest) for r, f, e in zip(kept, found, errors))


def vectors(n, seed=1):
    r = random.Random(seed)
    rows = [(i, r.choice([1, 2, None]), [round(r.gauss(0, 0.3), 2) for _ in range(8)]) for i in range(n)]
    nan, inf = float("nan"), float("inf")
    rows += [(5, 2, rows[5][2]), (None, 1, rows[6][2]), (None, 1, rows[6][2]), (900, 1, None), (901, 2, []), (902, None, [nan] * 8)]
    return rows + [(-3, 1, [inf] + [0.0] * 7), (-2, 1, [None] + [0.0] * 7), (-1, None, [-1e-9] * 8), (903, 2, [-inf] * 8)]


KIND = "vec_id long, label int, embedding array<float>, id string, vector int"


@pytest.mark.parametrize("n", [0, 40, 400])
def test_vector_codes_equal_a_plain_version(spark, n, monkeypatch):
    monkeypatch.setattr(vector_codes, "BLOCK_ROWS", 64)
    rows = vectors(n) if n else []
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], KIND).repartition(3)
    got = vector_codes.vector_codes(df)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    rows = [(i, k, v and [None if x is None else float(np.float32(x)) for x in v]) for i, k, v in rows]
    assert Counter(tuple(r) for r in got.collect()) == plain_codes(rows)


def test_label_errors_by_broadcast_and_by_shuffle(spark):
    rows = spark.createDataFrame([(k if k < 5 else None, k) for k in range(9)], "label int, error long")
    told = [sorted(map(tuple, vector_codes.with_label_errors(rows, most).collect()), key=str) for most in (100, 1)]
    assert told[0] == told[1] and (None, 5, 26) in told[0]


def test_distances_beyond_32_bits(spark):
    rows = [(k, 0, [1000.0 * k] + [0.0] * 7) for k in range(300)]
    got = vector_codes.vector_codes(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>"))
    assert Counter(tuple(r) for r in got.collect()) == plain_codes(rows)


def plain_phrases(docs, least, top, longest=5):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang, text = "und" if lang is None else lang, (text or "").translate(lower)
        for c in ".,;:!?\n\x0b\x0c\r":
            text = text.replace(c, ".")
        for piece in text.split("."):
            words = [w for w in piece.replace("\t", " ").split(" ") if w]
            n[lang] += len(words)
            f.update((lang, *words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1))
    out = []
    frequent = {p: c for p, c in f.items() if c >= least and len(p) > 2}
    inside = {}
    for p, c in frequent.items():
        for size in range(2, len(p) - 1):
            for i in range(1, len(p) - size + 1):
                key = (p[0], *p[i : i + size])
                inside[key] = max(inside.get(key, 0), c)
    for (lang, *words), a in frequent.items():
        if inside.get((lang, *words), 0) >= a:
            continue
        cuts = [(1000 * a * n[lang] // (f[(lang, *words[:k])] * f[(lang, *words[k:])]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out.append((lang, " ".join(words), a, f[(lang, *words[:k])], f[(lang, *words[k:])], n[lang], score))
    out.sort(key=lambda r: (r[0], -r[6], -r[2], r[1].encode()))
    return [(lang, rank, *row[1:]) for lang, rows in groupby(out, lambda r: r[0]) for rank, row in enumerate(rows, 1) if rank <= top]


def phrase_docs():
    r = random.Random(3)
    words = ["new", "York", "city", "of", "the", "a", "État", "x\x1cy", "中文"]
    docs = []
    for _ in range(150):
        text = "".join(r.choice(words) + r.choice([" ", "  ", " ", "\t", ". ", ", ", "\n", "\x0b", " "]) for _ in range(r.randint(0, 60)))
        docs.append((r.choice(["en", "en", "fr", None, ""]), text))
    return [*docs, ("en", None), ("en", ""), (None, "a a a a a a a a a a " * 40), ("en", "a " * 3000), ("de", "Wort"), *[("en", "of the new york city")] * 30]


@pytest.mark.parametrize("most, block", [(500_000, 1_000_000), (500_000, 50), (0, 200), (10, 1_000_000)])
def test_collocations_equal_a_plain_version(spark, most, block):
    docs = phrase_docs()
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "lang string, text string, word string, id int").repartition(3)
    got = collocations.collocations(df, least=6, top=40, most_broadcast=most, block_words=block)
    assert sorted(tuple(r) for r in got.collect()) == sorted(plain_phrases(docs, 6, 40))


def test_collocations_of_nothing(spark):
    for rows in ([], [(None, None)], [("en", "alone")]):
        assert collocations.collocations(spark.createDataFrame(rows, "lang string, text string")).count() == 0


def test_scores_beyond_64_bits(spark):
    row = spark.createDataFrame([([3 * 10**12, 2 * 10**12], [4 * 10**12, 2 * 10**12], 2 * 10**12, 10**14)], "heads array<long>, tails array<long>, f long, n long")
    cut = row.select(collocations.lowest_cut(F.col("n"), 2).alias("c")).first().c
    assert cut.score == 1000 * 2 * 10**12 * 10**14 // (3 * 10**12 * 4 * 10**12)


PATH = public_tokenizers.path("word_bpe_49k.json")


def odd_texts(n, seed):
    r = random.Random(seed)
    pools = ["abcdefghijklmnopqrstuvwxyz", "ab", "'s'll're.,!?-<|>", "éàßİΣσς", "中文字かな한국어", "0123456789ab", "ȩ́̀a", "\U0001f600‍각", " \xa0　\x0bab", " \n\t\r"]
    for k in range(n):
        out, size = [], r.randint(0, 900)
        while sum(map(len, out)) < size:
            own = r.choice(pools[: 9 if k % 2 else 10])
            word = "".join(r.choice(own) for _ in range(r.randint(1, r.choice([3, 30, 300]))))
            out.append(r.choice(["<|endoftext|>", "<|startoftext|>", "'ll", "'s", "ing", "'''''", " "]) if r.random() < 0.15 else word)
        yield "".join(out).replace(" ", "" if k % 2 else " ")


@pytest.mark.parametrize("leaf", [37, 200])
def test_joined_halves_equal_the_whole_text(leaf):
    plain, tree = Tokenizer.from_file(PATH), bpe_tree.TreeEncoder(PATH)
    for text in odd_texts(150, leaf):
        want = plain.encode(text, add_special_tokens=False).ids
        got = tree.encode(text, leaf)
        assert np.frombuffer(got, "<u4").tolist() == want, text
        assert bpe_tree.decode(got, PATH) == plain.decode(want, skip_special_tokens=False)
    assert tree.windows > 100


def test_tokens_of_odd_and_long_rows(spark):
    plain = Tokenizer.from_file(PATH)
    texts = [None, "", " \n", "unsplit" * 9000, "a " * 20000, "a " * 20000, "中文" * 9000, *odd_texts(20, 9)]
    rows = [(k if k % 5 else None, t, "x") for k, t in enumerate(texts)]
    found = bpe_tree.token_ids(spark.createDataFrame(rows, "doc_id int, text string, row string").repartition(3), leaf=1000)
    assert found.schema["doc_id"].dataType.simpleString() == "int"
    got = Counter((r.doc_id, bytes(r.ids)) for r in found.collect())
    assert got == Counter((i, np.array(plain.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes()) for i, t, _ in rows)
    assert bpe_tree.token_ids(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_token_query_equals_the_library(spark, sf):
    plain = Tokenizer.from_file(PATH)
    want = []
    for r in table(spark, sf, "documents").collect():
        ids = plain.encode(r.text or "", add_special_tokens=False).ids
        told = [hashlib.sha256(x).hexdigest() for x in (np.array(ids, "<u4").tobytes(), plain.decode(ids, skip_special_tokens=False).encode())]
        want.append((r.doc_id, len(ids), *told))
    assert sorted(want) == sorted(tuple(r) for r in bpe_tree.op13_bpe_tree(spark, sf).collect())
