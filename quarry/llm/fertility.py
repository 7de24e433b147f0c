"""Quality rules by tokeniser fertility.

Every word, with a space before it, is encoded with a public byte-level vocabulary, and every word by itself with a
public vocabulary that has byte fallback. Per text: characters per token of the former; of the latter, the share of
byte tokens, which is how much of the text it can only spell, and the entropy of the token distribution in bits.

Each measure has a band of texts of the same main script and size (the whole part of the base-2 logarithm of the
number of tokens, as short texts vary more and have less entropy). A size with fewer than LEAST_TEXTS texts takes the band
of its script, and a script with fewer takes the constants in RARE, so that a text that is alone in its size is not its own
measure. Bands come from all texts that pass the rules of length and repetition: from FENCE interquartile ranges below the first quartile to as many above the third, with a
least range for each measure, so that a measure that hardly varies does not reject what is a hair away. Quartiles are
mergeable summaries that tasks build side by side; only one row a script and size is broadcast.

Words are maximal runs of characters other than space and U+0009 to U+000D.

Cases: a null text has no words and fails the length rule; an empty one likewise. Texts of any length are read
whole. Repeated rows get equal results and count each in the quartiles. Ids keep their type; other columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
from collections import defaultdict
from collections.abc import Callable
from functools import lru_cache
from itertools import chain, count, islice

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialise, table

MIN_WORDS, MAX_REPEATED_PERCENT = 20, 30
#: Width of the bands in interquartile ranges, and for each measure: the least range, and whether low and high values
#: are rejected. A text that the byte-fallback vocabulary can spell without bytes is never wrong for that.
FENCE = 3.0
MEASURES = {"chars_per_token": (0.05, True, True), "byte_share": (0.02, False, True), "token_entropy": (0.1, True, True)}
#: Quartiles are right to one part in so many of the rows.
ACCURACY = 10_000
SCRIPTS = ("latin", "cyrillic", "greek", "cjk", "kana", "hangul", "arabic", "hebrew", "devanagari", "thai", "other")
#: First code points of ranges, and the script of the letters from there on.
RANGES = (
    (0x00, None), (0x41, "latin"), (0x5B, None), (0x61, "latin"), (0x7B, None), (0xAA, "latin"), (0x250, "other"), (0x370, "greek"),
    (0x400, "cyrillic"), (0x530, "other"), (0x590, "hebrew"), (0x600, "arabic"), (0x700, "other"), (0x750, "arabic"), (0x780, "other"),
    (0x8A0, "arabic"), (0x900, "devanagari"), (0x980, "other"), (0xE00, "thai"), (0xE80, "other"), (0x1100, "hangul"), (0x1200, "other"),
    (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, None), (0x2E80, "cjk"), (0x3000, None), (0x3040, "kana"), (0x3100, "cjk"), (0x3130, "hangul"),
    (0x3190, "cjk"), (0x31F0, "kana"), (0x3200, "cjk"), (0xA4D0, "other"), (0xA8E0, "devanagari"), (0xA900, "other"), (0xAC00, "hangul"),
    (0xD800, "other"), (0xF900, "cjk"), (0xFB00, "other"), (0xFB1D, "hebrew"), (0xFB50, "arabic"), (0xFE00, None), (0xFE70, "arabic"),
    (0xFF00, None), (0xFF21, "latin"), (0xFF3B, None), (0xFF41, "latin"), (0xFF5B, None), (0xFF66, "kana"), (0xFFA0, "hangul"), (0xFFE0, None),
    (0x10000, "other"), (0x20000, "cjk"), (0x32000, "other"),
)
#: The place in SCRIPTS of every code point's script, behind the last one if it has none.
SCRIPT_OF = np.repeat(
    np.array([SCRIPTS.index(s) if s else len(SCRIPTS) for _, s in RANGES], np.uint8), np.diff([*(a for a, _ in RANGES), 0x110000])
)
#: Texts from which a size or a script has a band of its own.
LEAST_TEXTS = 30
#: Where a script has fewer: least characters per token, and greatest share of byte tokens, about three quarters and 0.3 above
#: of what a plain sentence of the script has under the two vocabularies; and the least entropy of a text of 20 words.
RARE = {
    "latin": (1.4, 0.35), "cyrillic": (2.0, 0.3), "greek": (1.25, 0.3), "cjk": (0.4, 0.35), "kana": (0.7, 0.4), "hangul": (0.9, 0.45),
    "arabic": (1.25, 0.3), "hebrew": (1.15, 0.3), "devanagari": (0.6, 0.35), "thai": (0.7, 0.3), "other": (0.2, 0.5),
}
RARE_ENTROPY = 2.5
SYMBOLS = "#*$%&|<>"
#: An odd number; sums of words by its powers tell most texts without a repeated window.
MIX = np.uint64(0x9E3779B97F4A7C15)
SPACES = " \t\n\x0b\x0c\r"
CACHED_WORDS = 400_000
BASE_KIND = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean"
KIND = f"{BASE_KIND}, script string, n_tokens long, chars_per_token double, byte_share double, token_entropy double"


def numbers() -> defaultdict[bytes, int]:
    """Gives words numbers from 0 on as they come."""
    return defaultdict(count().__next__)


class Vocabularies:
    """Tokens of words under a byte-level vocabulary of ranks and under one with byte fallback, with a bounded cache.

    Words have numbers; by number, sizes is how many byte-level tokens a word has, n_pieces and n_bytes how many pieces and
    how many byte tokens among them, and the ids of its pieces are in ids from starts on. The cache forgets first what
    a single text has had, as most words that are spelt once are never met again.
    """

    def __init__(self, ranks_path: str, pieces_path: str):
        import sentencepiece
        import tiktoken

        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.ranks = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=pieces_path)
        self.is_byte = np.array([self.pieces.is_byte(i) for i in range(self.pieces.get_piece_size())])
        self.names, self.n_ids = numbers(), 0
        self.sizes, self.n_pieces, self.n_bytes, self.starts, self.used = (np.zeros(1024, np.int64) for _ in range(5))
        self.ids = np.zeros(4096, np.int32)

    def _forget(self) -> None:
        """Keep the words that two texts or more have had since the last time; none if these are more than half."""
        kept = np.flatnonzero(self.used[: len(self.names)] > 1)
        kept = kept if kept.size <= CACHED_WORDS // 2 else kept[:0]
        words, self.names = list(self.names), numbers()
        for k in kept.tolist():
            self.names[words[k]]
        self.ids = self.ids_of(kept)
        self.n_ids, self.used = self.ids.size, np.zeros(kept.size, np.int64)
        self.sizes, self.n_pieces, self.n_bytes = self.sizes[kept], self.n_pieces[kept], self.n_bytes[kept]
        self.starts = np.cumsum(self.n_pieces) - self.n_pieces

    def of(self, words: list[bytes]) -> np.ndarray:
        """The number of each of the words, good until the next call."""
        if len(self.names) > CACHED_WORDS:
            self._forget()
        known = len(self.names)
        found = np.fromiter(map(self.names.__getitem__, words), np.int64, len(words))
        new = [w.decode() for w in islice(reversed(self.names), len(self.names) - known)][::-1]
        for at in range(0, len(new), 10_000):
            self._add(new[at : at + 10_000], known + at)
        self.used[found] += 1  # once for each word
        return found

    def _add(self, words: list[str], first: int) -> None:
        encode = self.ranks.encode_ordinary
        pieces = self.pieces.encode(words, num_threads=1)
        ids = np.fromiter(chain.from_iterable(pieces), np.int32)
        lengths = np.fromiter(map(len, pieces), np.int64, len(words))
        ends = np.cumsum(lengths)
        in_bytes = np.concatenate([[0], np.cumsum(self.is_byte[ids])])
        self.sizes = _put(self.sizes, first, np.fromiter([len(encode(f" {w}")) for w in words], np.int64, len(words)))
        self.n_pieces = _put(self.n_pieces, first, lengths)
        self.n_bytes = _put(self.n_bytes, first, in_bytes[ends] - in_bytes[ends - lengths])
        self.starts = _put(self.starts, first, self.n_ids + ends - lengths)
        self.used = _put(self.used, first, np.zeros(len(words), np.int64))
        self.ids = _put(self.ids, self.n_ids, ids)
        self.n_ids += ids.size

    def ids_of(self, found: np.ndarray) -> np.ndarray:
        """The ids of the pieces of the words with these numbers, one word after the other."""
        lengths = self.n_pieces[found]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if ends.size else 0
        return self.ids[np.arange(total) + np.repeat(self.starts[found] - ends + lengths, lengths)]


def _put(into: np.ndarray, at: int, values: np.ndarray) -> np.ndarray:
    """into with values from at on; room for more is made by doubling."""
    if at + values.size > into.size:
        into = np.concatenate([into, np.zeros(max(into.size, values.size), into.dtype)])
    into[at : at + values.size] = values
    return into


@lru_cache(maxsize=2)
def vocabularies(ranks_path: str, pieces_path: str) -> Vocabularies:
    return Vocabularies(ranks_path, pieces_path)


def main_script(text: str) -> str:
    """The script of most letters; the earlier in SCRIPTS where two have as many, "other" without letters."""
    if text.isascii():
        return "latin" if any(c.isalpha() for c in text) else "other"
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    counts = np.bincount(SCRIPT_OF[points], minlength=len(SCRIPTS))[: len(SCRIPTS)]
    return SCRIPTS[int(counts.argmax())] if counts.any() else "other"


def repeated_words(rank: np.ndarray, width: int = 8) -> int:
    """Words, given by equal numbers for equal ones, that lie in a window of width words found twice or more in the text."""
    words, n = rank.size, rank.size - width + 1
    if n < 2:
        return 0
    mixed = np.zeros(n, np.uint64)
    for k in range(width):
        mixed = mixed * MIX + rank[k : k + n].astype(np.uint64)
    mixed.sort()
    if not (mixed[1:] == mixed[:-1]).any():  # equal windows would have equal sums
        return 0
    span = 1
    while span < width:  # ranks of longer and longer windows, from the ranks of two that cover them
        step = min(span, width - span)
        left, right = rank[: words - span - step + 1], rank[step:]
        span += step
        values, rank = np.unique(left * (int(rank.max()) + 1) + right[: left.size], return_inverse=True)
        if values.size == rank.size:
            return 0
    twice = np.bincount(rank)[rank] > 1
    edge = np.zeros(words + 1, np.int64)
    edge[:n] += twice
    edge[width : width + n] -= twice
    return int(np.count_nonzero(np.cumsum(edge)[:-1]))


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return len(lines) - len(set(lines))


def base_measure(text: str, words: np.ndarray) -> dict:
    """What the rules before the bands need of a text whose words have these numbers; no vocabulary."""
    n, repeated = words.size, repeated_words(words)
    return {
        "n_words": n,
        "word_chars": len(text) - sum(text.count(c) for c in SPACES),
        "n_symbols": sum(text.count(c) for c in SYMBOLS),
        "n_dup_lines": duplicate_lines(text),
        "n_repeat_words": repeated,
        "base_failed": n < MIN_WORDS or 100 * repeated > MAX_REPEATED_PERCENT * n,
    }


def measure(text: str, known: Vocabularies) -> dict:
    words = known.of(text.encode().split())
    base = base_measure(text, words)
    ids, byte_level = known.ids_of(words), int(known.sizes[words].sum())
    times = np.bincount(ids)
    share = times[times > 0] / max(1, ids.size)
    return {
        **base,
        "script": main_script(text),
        "n_tokens": byte_level,
        "chars_per_token": base["word_chars"] / byte_level if byte_level else 0.0,
        "byte_share": int(known.n_bytes[words].sum()) / ids.size if ids.size else 0.0,
        "token_entropy": max(0.0, float(-(share * np.log2(share)).sum())),
    }


def measures(docs: DataFrame, ranks: str | None = None, pieces: str | None = None) -> DataFrame:
    """One row of measures for each row of docs(doc_id, text). ranks and pieces are files of the two vocabularies."""
    paths = ranks or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), pieces or public_tokenizers.path("piece_bpe_32k.model")

    def of_texts():
        known = vocabularies(*paths)
        return lambda text: measure(text, known)

    return _by_text(docs, of_texts, KIND)


def base_measures(docs: DataFrame) -> DataFrame:
    """The columns of measures() up to base_failed, for which no text is encoded."""

    def of_text(text: str) -> dict:
        words = text.encode().split()
        return base_measure(text, np.fromiter(map(numbers().__getitem__, words), np.int64, len(words)))

    return _by_text(docs, lambda: of_text, BASE_KIND)


def _by_text(docs: DataFrame, begin: Callable[[], Callable[[str], dict]], kind: str) -> DataFrame:
    """doc_id and what the function that begin gives in each task makes of the text."""

    def run(batches):
        of = begin()
        for b in batches:
            rows = [of(t.as_py() or "") for t in b.column(1)]
            columns = {k: [r[k] for r in rows] for k in rows[0]} if rows else {}
            yield pa.RecordBatch.from_pydict({"doc_id": b.column(0), **columns})

    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, {kind}")


def size_class() -> Column:
    return F.floor(F.log2(F.greatest(F.col("n_tokens"), F.lit(1)))).cast("int")


def bands(measured: DataFrame, fence: float = FENCE) -> DataFrame:
    """(script, size, and low and high of each measure) from all rows of measures() that pass the rules before.

    A null size stands for the whole script. Groups of fewer than LEAST_TEXTS texts are left out.
    """
    quartiles = [F.percentile_approx(m, [0.25, 0.75], ACCURACY).alias(m) for m in MEASURES]
    passed = measured.where("NOT base_failed").withColumn("size", size_class())
    sets = passed.groupingSets([["script", "size"], ["script"]], "script", "size")
    found = sets.agg(F.count("*").alias("n"), *quartiles).where(F.col("n") >= LEAST_TEXTS)
    edges = []
    for m, (least, rejects_low, rejects_high) in MEASURES.items():
        first, third = F.col(m)[0], F.col(m)[1]
        reach = F.lit(fence) * F.greatest(third - first, F.lit(least))
        edges += [(first - reach if rejects_low else F.lit(float("-inf"))).alias(f"low_{m}")]
        edges += [(third + reach if rejects_high else F.lit(float("inf"))).alias(f"high_{m}")]
    return found.select("script", "size", *edges)


def judged(measured: DataFrame, limits: DataFrame) -> DataFrame:
    """measured with kept, and with failed_bands: the measures that lie outside the text's band.

    limits has a row for each script and size, so it is bounded by the number of scripts and the bits of a number.
    """
    edges = [f"{side}_{m}" for m in MEASURES for side in ("low", "high")]
    own = limits.where("size IS NOT NULL").select("script", "size", F.struct(*edges).alias("own"))
    wide = limits.where("size IS NULL").select("script", F.struct(*edges).alias("wide"))
    joined = measured.withColumn("size", size_class()).join(F.broadcast(own), ["script", "size"], "left").join(F.broadcast(wide), "script", "left")
    rare = lambda k: F.create_map(*[F.lit(x) for s in SCRIPTS for x in (s, RARE[s][k])])[F.col("script")]
    least = {"low_chars_per_token": rare(0), "high_byte_share": rare(1), "low_token_entropy": F.lit(RARE_ENTROPY)}
    constants = F.struct(*[least.get(e, F.lit(float("-inf" if e.startswith("low") else "inf"))).alias(e) for e in edges])
    band = F.coalesce("own", "wide", constants)
    outside = [F.when((F.col(m) < band[f"low_{m}"]) | (F.col(m) > band[f"high_{m}"]), F.lit(m)) for m in MEASURES]
    failed = F.when(F.col("base_failed"), F.array().cast("array<string>")).otherwise(F.array_compact(F.array(*outside)))
    kept = ~F.col("base_failed") & (F.size("failed_bands") == 0)
    return joined.withColumn("failed_bands", failed).withColumn("kept", kept).select(*measured.columns, "kept", "failed_bands")


def quality_rules(docs: DataFrame, ranks: str | None = None, pieces: str | None = None) -> DataFrame:
    """One row of measures and verdicts for each row of docs(doc_id, text), by the bands of these very texts."""
    measured = materialise(measures(docs, ranks, pieces), "measures")
    return judged(measured, materialise(bands(measured), "bands"))


def op4_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_rules(table(spark, sf_dir, "documents"))
    return out.withColumn("failed_bands", F.array_join("failed_bands", ","))


QUERIES = {"op4_fertility": op4_fertility}
ORACLES: dict[str, str] = {}
