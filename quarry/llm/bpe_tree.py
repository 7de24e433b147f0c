"""BPE encoding and decoding of whole texts by tree concatenation.

A text longer than LEAF characters is cut into leaves wherever the count falls, inside words too. Leaves are rows of
their own, so that one long text is encoded by many tasks; then halves are joined to wholes, up to the whole text. At
a join, a window of text around the cut is encoded anew and grows until it agrees with both sides: with a token of the left
half and with one of the right half, the same id over the same characters. The result is the left half up to the one
token, the window between, and the right half from the other.

Why this is exact: byte-pair merges go by rank, so a sequence of tokens is the encoding of its text if every two
neighbours are the encoding of theirs, as the first merge across a border would otherwise have been made
between the two alone. Every two neighbours of the result are neighbours in one of the three encodings. What an end of a window
or half alters (the mark of a word's end, a contraction or a special token that is cut) lies within a few
characters of it, or has other ids, so tokens near an end are not taken to agree. A window that reaches the ends of
what surrounds it without white space is that stretch, encoded whole; white space never lies within a token.

Decoding gives the tokens of the ids with a space between each, as the vocabulary file has no decoder.

Cases: a null or empty text has no ids and an empty decoded text. Texts of any length are encoded whole, with or without white
space; strings of special tokens in a text are these tokens. Repeated rows are encoded each. Ids of documents keep their type
and may be null or shared; other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .words import word_encoder

#: Characters of a leaf, about; of each side of the first window; and from the end of a half or window within which tokens are not compared.
LEAF, WINDOW, EDGE = 16_384, 64, 8
SPACES = " \n\t\r"
CHUNK = "struct<start:bigint,stop:bigint,ids:binary,starts:binary,stops:binary>"
NODE = f"struct<solid:boolean,head:{CHUNK},mid:binary,tail:{CHUNK}>"


@dataclass
class Chunk:
    """A stretch of the text without white space: ids, and the characters of each token in the whole text."""

    start: int
    stop: int
    ids: np.ndarray
    starts: np.ndarray
    stops: np.ndarray

    def part(self, a: int | None, b: int | None) -> list[np.ndarray]:
        return [self.ids[a:b], self.starts[a:b], self.stops[a:b]]

    def clean(self) -> np.ndarray:
        """Whether each token begins and ends between characters, so that its place tells its bytes."""
        out = np.ones(self.ids.size, bool)
        if out.size > 1:
            apart = self.stops[:-1] <= self.starts[1:]
            out[1:] &= apart
            out[:-1] &= apart
        return out


@dataclass
class Node:
    """An encoded stretch: its first and last chunks, which may go on beyond it, and the ids between them.

    A solid node has no white space; its one chunk is the head.
    """

    solid: bool
    head: Chunk
    mid: list[bytes] = field(default_factory=list)
    tail: Chunk | None = None


def safe(text: str, at: int) -> int:
    """The next place, from at on, before a character that does not combine with what stands before it."""
    while at < len(text) and text[at] >= "\u0300" and (unicodedata.category(text[at])[0] == "M" or "\u1160" <= text[at] <= "\u11ff"):
        at += 1
    return at


def leaves_of(text: str, leaf: int = LEAF) -> list[int]:
    """Places of the cuts of a text, 0 first."""
    out = [0]
    while len(text) - out[-1] > leaf and (at := safe(text, out[-1] + leaf)) < len(text):
        out.append(at)
    return out


class TreeEncoder:
    def __init__(self, path: str):
        self.words = word_encoder(path)
        self.tokenizer = self.words.tokenizer
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.windows = 0  # encoded anew, for tests

    def chunk(self, text: str, start: int) -> Chunk:
        """text, which stands at start in the whole text, by itself."""
        found = self.tokenizer.encode(text, add_special_tokens=False)
        spans = np.array(found.offsets, np.int64).reshape(-1, 2) + start
        return Chunk(start, start + len(text), np.array(found.ids, np.uint32), spans[:, 0].copy(), spans[:, 1].copy())

    def leaf(self, text: str, start: int) -> Node:
        first = min((at for c in SPACES if (at := text.find(c)) >= 0), default=-1)
        if first < 0:
            return Node(True, self.chunk(text, start))
        last = max(text.rfind(c) for c in SPACES) + 1
        return Node(False, self.chunk(text[:first], start), [self.words.encode(text[first:last])], self.chunk(text[last:], start + last))

    def glued(self, text: str, x: Chunk, y: Chunk) -> Chunk:
        """The chunk of text that x and y are the halves of."""
        if x.start == x.stop or y.start == y.stop:
            return y if x.start == x.stop else x
        cut, wide = y.start, WINDOW
        while True:
            a = x.start if cut - wide <= x.start else min(cut, safe(text, cut - wide))
            b = y.stop if cut + wide >= y.stop else min(y.stop, safe(text, cut + wide))
            self.windows += 1
            w = self.chunk(text[a:b], a)
            left = (0, 0) if a == x.start else _agreed(x, w, a + EDGE, cut - EDGE, first=True)
            right = (y.ids.size, w.ids.size) if b == y.stop else _agreed(y, w, cut, b - EDGE, first=False)
            if left and right and left[1] <= right[1]:
                parts = zip(x.part(0, left[0]), w.part(left[1], right[1]), y.part(right[0], None))
                return Chunk(x.start, y.stop, *map(np.concatenate, parts))
            if a == x.start and b == y.stop:
                return w
            wide *= 2

    def joined(self, text: str, x: Node, y: Node) -> Node:
        if x.solid:
            head = self.glued(text, x.head, y.head)
            return Node(y.solid, head, y.mid, y.tail)
        tail = self.glued(text, x.tail, y.head)
        if y.solid:
            return Node(False, x.head, x.mid, tail)
        return Node(False, x.head, [*x.mid, tail.ids.astype("<u4").tobytes(), *y.mid], y.tail)

    def whole(self, text: str, nodes: list[Node]) -> bytes:
        """The ids of text from its encoded leaves, joined by halves."""
        while len(nodes) > 1:
            pairs = [self.joined(text, *nodes[i : i + 2]) for i in range(0, len(nodes) - 1, 2)]
            nodes = pairs + nodes[2 * len(pairs) :]
        (top,) = nodes
        ends = [b"" if c is None else c.ids.astype("<u4").tobytes() for c in (top.head, top.tail)]
        return b"".join([ends[0], *top.mid, ends[1]])

    def encode(self, text: str, leaf: int = LEAF) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        cuts = leaves_of(text, leaf)
        if len(cuts) == 1:
            return self.words.encode(text)
        return self.whole(text, [self.leaf(text[a:b], a) for a, b in zip(cuts, [*cuts[1:], len(text)])])


def _agreed(half: Chunk, w: Chunk, low: int, high: int, first: bool) -> tuple[int, int] | None:
    """Numbers of a token of half and of the same token of w between two places of the text: the first or last one."""
    i = np.flatnonzero(half.clean() & (half.starts >= low) & (half.stops <= high))
    k = np.flatnonzero(w.clean() & (w.starts >= low) & (w.stops <= high))
    # places are unique among clean tokens that have characters
    i, k = i[half.stops[i] > half.starts[i]], k[w.stops[k] > w.starts[k]]
    _, own, other = np.intersect1d(half.starts[i], w.starts[k], return_indices=True)
    i, k = i[own], k[other]
    same = (half.ids[i] == w.ids[k]) & (half.stops[i] == w.stops[k])
    if not same.any():
        return None
    at = np.flatnonzero(same)[0 if first else -1]
    return int(i[at]), int(k[at])


@lru_cache(maxsize=2)
def tree_encoder(path: str) -> TreeEncoder:
    return TreeEncoder(path)


@lru_cache(maxsize=2)
def token_texts(path: str) -> list[str]:
    tokenizer = word_encoder(path).tokenizer
    return [tokenizer.id_to_token(i) for i in range(tokenizer.get_vocab_size(with_added_tokens=True))]


def decode(ids: bytes, path: str) -> str:
    texts = token_texts(path)
    return " ".join([texts[i] for i in np.frombuffer(ids, "<u4").tolist()])


def _packed(c: Chunk | None) -> dict | None:
    return c and {"start": c.start, "stop": c.stop, "ids": c.ids.tobytes(), "starts": c.starts.tobytes(), "stops": c.stops.tobytes()}


def _unpacked(c: dict | None) -> Chunk | None:
    return c and Chunk(c["start"], c["stop"], np.frombuffer(c["ids"], np.uint32), np.frombuffer(c["starts"], np.int64), np.frombuffer(c["stops"], np.int64))


def token_ids(docs: DataFrame, vocabulary: str | None = None, leaf: int = LEAF) -> DataFrame:
    """(doc_id, ids) for each row of docs(doc_id, text); ids are little-endian unsigned 32-bit integers."""
    path = vocabulary or public_tokenizers.path("word_bpe_49k.json")
    chunk = pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("ids", pa.binary()), ("starts", pa.binary()), ("stops", pa.binary())])
    node = pa.struct([("solid", pa.bool_()), ("head", chunk), ("mid", pa.binary()), ("tail", chunk)])

    @F.arrow_udf("binary")
    def whole(texts: pa.Array) -> pa.Array:
        encoder = tree_encoder(path)
        return pa.array([encoder.encode(t.as_py(), leaf) for t in texts], pa.binary())

    @F.arrow_udf("array<struct<start:bigint,text:string>>")
    def cut(texts: pa.Array) -> pa.Array:
        out = []
        for text in texts.to_pylist():
            cuts = leaves_of(text, leaf)
            out.append([{"start": a, "text": text[a:b]} for a, b in zip(cuts, [*cuts[1:], len(text)])])
        return pa.array(out, pa.list_(pa.struct([("start", pa.int64()), ("text", pa.string())])))

    @F.arrow_udf(NODE)
    def encode_leaf(texts: pa.Array, starts: pa.Array) -> pa.Array:
        encoder, out = tree_encoder(path), []
        for t, a in zip(texts, starts):
            n = encoder.leaf(t.as_py(), a.as_py())
            out.append({"solid": n.solid, "head": _packed(n.head), "mid": b"".join(n.mid), "tail": _packed(n.tail)})
        return pa.array(out, node)

    @F.arrow_udf("binary")
    def join_leaves(leaves: pa.Array) -> pa.Array:
        encoder, out = tree_encoder(path), []
        for row in leaves:
            row = row.as_py()
            nodes = [Node(n["solid"], _unpacked(n["head"]), [n["mid"]], _unpacked(n["tail"])) for n in (x["node"] for x in row)]
            out.append(encoder.whole("".join(x["text"] for x in row), nodes))
        return pa.array(out, pa.binary())

    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    short = rows.where(F.length("text") <= leaf).select("doc_id", whole("text").alias("ids"))
    long = rows.where(F.length("text") > leaf).withColumn("row", F.monotonically_increasing_id())
    parts = long.select("row", "doc_id", F.explode(cut("text")).alias("leaf")).select("row", "doc_id", "leaf.start", "leaf.text")
    # leaves of one text go to tasks of their own
    nodes = parts.repartition("row", "start").withColumn("node", encode_leaf("text", "start"))
    texts = nodes.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_list(F.struct("start", "text", "node"))).alias("leaves"))
    return short.unionByName(texts.select("doc_id", join_leaves("leaves").alias("ids")))


def decoded(ids: Column, vocabulary: str | None = None) -> Column:
    """The text of ids as token_ids() gives them."""
    path = vocabulary or public_tokenizers.path("word_bpe_49k.json")

    @F.arrow_udf("string")
    def texts(ids: pa.Array) -> pa.Array:
        return pa.array([decode(x.as_py(), path) for x in ids], pa.string())

    return texts(ids)


def op13_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = token_ids(table(spark, sf_dir, "documents"))
    return ids.select(
        "doc_id", F.expr("CAST(octet_length(ids) / 4 AS LONG)").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(decoded(F.col("ids")).cast("binary"), 256).alias("decoded_sha256"),
    )


QUERIES = {"op13_bpe_tree": op13_bpe_tree}
ORACLES: dict[str, str] = {}
