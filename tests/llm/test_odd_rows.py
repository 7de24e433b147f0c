"""Repeated and contradicting rows, ids of other types, clashing columns: what the operators' docstrings state for them."""

import hashlib
import struct
import zlib
from collections import Counter

import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quarry.llm import chat, decontaminate, quality, secrets, token_files, toxicity

from . import brute

TEXTS = [None, "", "token='abcdef99' é", "token='abcdef99' é", "word " * 40_000, "same", "same", "same"]


def test_secrets_of_repeated_rows(spark):
    rows = spark.createDataFrame([(str(k // 2), t, "x") for k, t in enumerate(TEXTS)], "doc_id string, text string, spans string").repartition(3)
    found = Counter((r.doc_id, tuple((s.kind, s.start, s.stop) for s in r.spans)) for r in secrets.find_secrets(rows).collect())
    assert found == Counter((str(k // 2), tuple(brute.secrets(t))) for k, t in enumerate(TEXTS)) and found["1", tuple(brute.secrets(TEXTS[2]))] == 2


def test_leaks_of_repeated_rows_and_text_ids(spark):
    item = "seven wizards quietly mix strange potions under the old bridge"
    rows = [("a", item), ("a", item), ("b", f"x {item} y"), (None, item), ("c", None), ("d", "w " * 30_000 + item), ("e", "clean")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id string, text string, hit int, start int")
    items = spark.createDataFrame([(3, item), (3, item), (4, "")], "item_id long, text string")
    found = Counter((r.doc_id, r.item_id, r.distance) for r in decontaminate.find_leaks(docs, items.limit(1)).collect())
    assert found == {("a", 3, 0): 2, ("b", 3, 0): 1, (None, 3, 0): 1, ("d", 3, 0): 1}
    left = decontaminate.without_leaks(docs, items)
    assert sorted(r.doc_id for r in left.collect()) == ["c", "e"] and left.columns == docs.columns


def test_tokens_of_repeated_rows(spark):
    rows = [(k % 3 if k % 4 else None, t) for k, t in enumerate(TEXTS)]
    encode = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode
    ids = {t: encode(t or "", add_special_tokens=False).ids + [1] for t in TEXTS}
    want = Counter((i, len(ids[t]), zlib.crc32(struct.pack(f"<{len(ids[t])}I", *ids[t]))) for i, t in rows)
    for bits in (True, False):
        got = token_files.token_table(spark.createDataFrame([(*r, 7) for r in rows], "doc_id long, text string, tie int"), bits=bits).orderBy("start").collect()
        assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
        assert [r.doc_id for r in got] == sorted((r.doc_id for r in got), key=lambda i: (i is not None, i or 0))
        assert [r.start for r in got] == [sum(r.n_tokens for r in got[:k]) for k in range(len(got))]


def test_equal_rows_are_spread_over_files(spark):
    docs = spark.range(2000, numPartitions=4).select(F.lit(None).cast("long").alias("doc_id"), F.lit("same words").alias("text"))
    folder = token_files.new_path(spark, "token-files")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", False)  # it would join what is so small
    try:
        files = token_files.write_token_files(docs, folder, public_tokenizers.path("word_bpe_49k.json")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(files) > 1 and sum(f.n_docs for f in files) == 2000 and max(f.n_docs for f in files) < 1500


def test_chats_of_repeated_rows_and_clashing_columns(spark):
    long = "said <|im_end|> " * 20_000
    rows = [(1, 0, "user", "hi"), (1, 0, "user", "hi"), (1, 1, "assistant", long), (1, 1, "assistant", "a"), (1, None, "assistant", None), (2, 5, None, "x"), (None, 0, "assistant", "é")]
    df = spark.createDataFrame([(*r, 1, "y") for r in rows], "conv_id long, turn long, role string, text string, ids int, formatted string").repartition(4)
    found = {r.conv_id: r for r in chat.digests(chat.format_chats(df)).collect()}
    first = lambda x: (x is not None, x if x is not None else 0)
    for conv in (1, 2, None):
        turns = sorted(((t, role, s) for c, t, role, s in rows if c == conv), key=lambda x: tuple(first(v) if k == 0 else (v is not None, v or "") for k, v in enumerate(x)))
        whole = "".join(f"{role or ''}\n{s or ''}\n" for _, role, s in turns)
        learnt = "".join(s or "" for _, role, s in turns if role == "assistant")
        r = found[conv]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(learnt), hashlib.sha256(learnt.encode()).hexdigest())


def test_classifiers_on_repeated_rows_contradicting_labels_and_text_ids(spark):
    good, bad = "the river runs past the old stone mill and the quiet town below", "vile scum trash filth"
    rows = [(f"d{k}", f"{good} number {k}" + (f" you {bad.split()[k % 4]} !" if k % 5 == 0 else "")) for k in range(120)]
    rows += [rows[0], rows[0], ("none", None), (None, "")]
    docs = spark.createDataFrame([(*r, 0.5) for r in rows], "doc_id string, text string, score double")
    told = [(f"d{k}", int(k % 5 > 0), int(k % 5 == 0)) for k in range(120)] + [("d5", 1, 0), ("d5", 1, 0), ("gone", 0, 1), (None, None, None)]
    labels = spark.createDataFrame(told, "doc_id string, quality int, toxic int")
    model = toxicity.fit(docs, labels, F.lit(True))
    rated = docs.select("doc_id", toxicity.toxicity_column(F.col("text"), spark, model).alias("r")).select("doc_id", "r.score").collect()
    assert len(rated) == len(rows) and all(0 <= r.score <= 1 for r in rated) and len({r.score for r in rated if r.doc_id == "d0"}) == 1
    out = quality.classify(docs, labels, F.lit(False)).collect()
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out) and len({r.score for r in out if r.doc_id == "d0"}) == 1
