import random
import struct
import zlib

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from quarry.llm import decontaminate, mixing

from . import brute
from .test_mixing_plan import plain


def _plant(folder, spark):
    """Documents of invented words, of which some are toxic, some copies of others, and some hold a benchmark item."""
    rng = random.Random(11)
    words = ["".join(rng.choice("aeiourstlnm") for _ in range(rng.randint(2, 7))) for _ in range(700)]
    said = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(k, said(9)) for k in range(4)]
    texts, toxic = [said(rng.randint(25, 60)) for _ in range(160)], set(range(0, 160, 5))
    for k in toxic:
        texts[k] += f" {rng.choice(('vile', 'rotten'))} {said(5)}"
    for k in range(1, 160, 16):
        texts[k] = texts[k + 1] = texts[k]  # copies
    for k in range(3, 160, 20):
        item = items[k % 4][1]
        texts[k] += f" {item[:10]}x{item[11:]}"  # one edit
    docs = [(k, t, None, "aaaaabbc"[k % 8], len(t)) for k, t in enumerate(texts)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(k, 1, int(k in toxic)) for k in range(160)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return dict(enumerate(texts)), dict(items)


def test_every_stage_against_a_plain_version(spark, tmp_path):
    folder = str(tmp_path)
    texts, items = _plant(folder, spark)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    stage = dict(corpus_pipeline.STAGES)

    left = stage["toxicity"](spark, docs, folder)
    expected = [i for i, t in texts.items() if not {"vile", "rotten"} & set(t.split())]
    assert left.columns == docs.columns and ids(left) == expected and len(expected) < len(texts)

    left = stage["near_dedup"](spark, left, folder)
    expected, before = sorted(set(brute.classes({i: brute.fingerprint(texts[i]) for i in expected}).values())), expected
    assert left.columns == docs.columns and ids(left) == expected and len(expected) < len(before)

    left = stage["decontaminate"](spark, left, folder)
    leaks = lambda i: any(brute.nearest(x, texts[i]) <= int(decontaminate.RATE * len(x)) for x in items.values())
    expected, before = [i for i in expected if not leaks(i)], expected
    assert left.columns == docs.columns and ids(left) == expected and len(expected) < len(before)

    mixed = stage["mixing"](spark, left, folder)
    encode = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")).encode
    tokens = {i: encode(t, add_special_tokens=False).ids for i, t in texts.items()}
    rows, _ = plain([((i, texts[i]), "aaaaabbc"[i % 8], len(tokens[i])) for i in expected], mixing.MAX_REPETITION)
    rows = sorted((i, e) for (i, _), e in rows)
    assert mixed.columns == docs.columns and ids(mixed) == [i for i, _ in rows] and len(rows) > len(expected)

    start, whole = 0, []
    for i, _ in rows:
        data = struct.pack(f"<{len(tokens[i]) + 1}I", *tokens[i], 1)
        whole.append((i, start, len(data) // 4, zlib.crc32(data)))
        start += len(data) // 4
    assert sorted(map(tuple, stage["token_output"](spark, mixed, folder).collect())) == whole
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).collect())) == whole


LEAK = "the quick brown fox jumps over the lazy dog while seven wizards quietly mix strange potions"
#: Columns of documents, and names that the stages use themselves.
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score double, count long, component_id long, tokens long, place long, block long, weight double, item_id long, start long, _toxicity double, _Digest string, _mix int, _plan int, _epoch int, _size int, _place int, shard int"


def _folder(spark, folder):
    """Labels with nulls and without toxic words, and a benchmark with a null, a repeated and an empty item."""
    labels = [(1, None, 0), (2, 1, None), (None, None, None), (1, 0, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    items = [(1, LEAK), (1, LEAK), (2, None), (None, ""), (None, None)]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def _docs(spark, rows):
    width = len(COLUMNS.split(","))
    return spark.createDataFrame([(i, t, None, s, *[None] * (width - 4)) for i, t, s in rows], COLUMNS)


def test_stages_on_odd_rows(spark, tmp_path):
    folder = _folder(spark, tmp_path)
    rows = [(7, None, None), (8, "", "a"), (3, "w " * 40_000, "a"), (4, "one two three four", "b"), (4, "one two three four", "b"), (5, "one two three four", "b"), (6, f"Read: {LEAK.upper()}!", None), (None, "a text without any id", "a")]
    docs = _docs(spark, rows)
    ids = lambda df: sorted((r.doc_id for r in df.select("doc_id").collect()), key=lambda i: (i is not None, i))
    kept = corpus_pipeline.drop_toxic(spark, docs, folder)
    assert kept.columns == docs.columns and ids(kept) == ids(docs)  # no word is known as toxic
    kept = corpus_pipeline.drop_near_duplicates(spark, kept, folder)
    # null and empty texts are one group, equal texts another; the row without an id is alone
    assert kept.columns == docs.columns and ids(kept) == [None, 3, 4, 6, 7]
    kept = corpus_pipeline.drop_leaks(spark, kept, folder)
    assert kept.columns == docs.columns and ids(kept) == [None, 3, 4, 7]
    mixed = corpus_pipeline.mix_sources(spark, kept, folder)
    assert mixed.columns == docs.columns and set(ids(mixed)) == {None, 3, 4, 7}
    written = corpus_pipeline.write_tokens(spark, mixed, folder)
    assert ids(written) == ids(mixed)


def test_near_dedup_keeps_a_row_of_each_component(spark, tmp_path):
    """Different texts without an id, or under one id, are different documents; copies of them are not."""
    said = ["first words of one letter home", "another report on grain and rain", "seven old maps of the northern coast", "how to mend a clock by candle light", "notes from a slow boat going south"]
    rows = [(None, said[0], "a"), (None, said[1], "a"), (None, said[1], "b"), (4, said[2], "a"), (4, said[3], "a"), (4, said[3], "a"), (9, said[4], "a"), (None, said[4], "a"), (12, said[2], "a"), (None, None, "a"), (None, "", "a")]
    kept = corpus_pipeline.drop_near_duplicates(spark, _docs(spark, rows), str(tmp_path))
    found = sorted((r.doc_id or 0, r.text or "") for r in kept.collect())
    assert found == sorted([(0, said[0]), (0, said[1]), (4, said[2]), (4, said[3]), (9, said[4]), (0, "")])


def test_stages_on_no_rows(spark, tmp_path):
    folder, docs = _folder(spark, tmp_path), _docs(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        assert out.count() == 0, name
        assert name == "token_output" or out.columns == docs.columns
