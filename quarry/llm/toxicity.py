"""Toxic spans by a linear-chain conditional random field.

A text is a chain of words with two states, clean and toxic. The field has weights for hashed features of each
word (the word, its beginnings and ends, its shape) and for the transitions between states. Labels mark whole
documents: a clean one has clean words only, a toxic one has a toxic word at least. Which words those are is found in
two steps. First, units (words and beginnings of words) that stand in toxic documents far more than in clean ones
mark words; toxic documents that are explained so no longer count, and the rest are searched for units again, until
none is found. What stands between the same two words in several texts, as in passages that they share, counts once.
Then the field is fitted to these tags, and tags are taken anew from its own marginals under the
constraint that a toxic document has a toxic word, and it is fitted again to all words of the sample, until the tags
settle or ROUNDS times. Copies of one document count once, or every
rare word of a toxic text that was copied would look toxic; a copy is a text whose runs of five words have a Jaccard
similarity of half or more with those of a text of its label that counts.
Forward-backward gives every word's marginal, from which come the offending offsets and, through a logistic
function fitted on the documents of the sample, the document's score.

The fit takes a bounded sample: at most SAMPLE toxic and 2 * SAMPLE clean labelled documents, whole and of any
length, those whose ids hash lowest. Scoring reads every whole text. Labels, language, source and id are never inputs
of a score.

Cases: a null or empty text has no words and gets the score of a text without any toxic word. Labels that are
null are left out; a document with contradicting labels counts as toxic. With no toxic or no clean document in
the sample, or no word to tell them apart, every score is the same and below 0.5. Repeated rows get equal scores.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from .common import table

SAMPLE = 1500
#: Hashed features; words of a training chain; clean chains for each with a toxic word in the first fit, from which
#: the fits to all chains start.
SIZE, CHAIN, CLEAN_FIRST = 1 << 17, 24, 2
#: Chains that the fit holds in floating point at once.
FIT_CHAINS = 2048
#: A unit marks toxic words if it stands in this many toxic documents, this many times as often as in clean ones,
#: and its counts are less likely by chance than exp(-LEAST_NATS).
LEAST_DOCS, LEAST_RATIO, LEAST_NATS = 3, 12.0, 8.0
#: A toxic document in which the field gives a toxic word less chance than this is taken for wrongly labelled.
LEAST_CHANCE = 1e-3
#: Lengths of the beginnings of words that are units and features; times at most that tags are taken anew from the
#: field until they settle, and steps of the fit to them.
BEGINNINGS, ENDS, ROUNDS, ANEW = range(3, 9), range(3, 5), 6, 20
#: Copies in the sample share this part of their runs of so many words; candidates share one of so many least hashes.
COPY, RUN, HASHES = 0.5, 5, 8
WORD = re.compile(r"\w+")
CACHED_WORDS = 400_000
SPANS = "array<struct<start:bigint,stop:bigint,p:double>>"


def units(word: str) -> list[str]:
    w = word.lower()
    return [w, *(w[:n] + "~" for n in BEGINNINGS if len(w) > n)]


def features(word: str) -> list[int]:
    w = word.lower()
    shape = "A" if word.isupper() and len(word) > 1 else "a" if word.isalpha() else "0"
    names = ["bias", f"w={w}", f"s={shape}"]
    names += [f"b{n}={w[:n]}" for n in BEGINNINGS if len(w) >= n] + [f"e{n}={w[-n:]}" for n in ENDS if len(w) >= n]
    return [zlib.crc32(x.encode()) % SIZE for x in names]


@dataclass
class Model:
    """weights: of the features, for the toxic state; moves: 2 by 2 transition scores; line: logistic of a document."""

    weights: np.ndarray
    moves: np.ndarray
    line: tuple[float, float] = (0.0, -3.0)
    cache: dict = field(default_factory=dict, repr=False)

    def emissions(self, words: list[str]) -> list[float]:
        cache = self.cache
        missing = set(words).difference(cache)
        if len(cache) + len(missing) > CACHED_WORDS:
            cache.clear()
            missing = set(words)
        for w in missing:
            cache[w] = math.exp(min(30.0, max(-30.0, float(self.weights[features(w)].sum()))))
        return [cache[w] for w in words]

    def marginals(self, words: list[str]) -> list[float]:
        """Odds recursions of forward-backward: the chance of the toxic state for each word."""
        e = self.emissions(words)
        (m00, m01), (m10, m11) = np.exp(self.moves).tolist()
        odds, r = [], 0.0
        for i, x in enumerate(e):
            r = x * (m01 + m11 * r) / (m00 + m10 * r) if i else x
            odds.append(r)
        b = 1.0
        for i in range(len(e) - 1, -1, -1):
            o = odds[i] * b
            odds[i] = o / (1.0 + o)
            y = e[i] * b
            b = (m10 + m11 * y) / (m00 + m01 * y)
        return odds

    def evidence(self, marginals: list[float]) -> float:
        """Log odds that any word is toxic."""
        clean = sum(math.log1p(-min(p, 1 - 1e-9)) for p in marginals if p > 1e-4)
        return min(20.0, math.log(max(-math.expm1(clean), 1e-6)) - clean)

    def score(self, text: str) -> tuple[float, list[dict]]:
        p = self.marginals(WORD.findall(text))
        a, b = self.line
        score = 1.0 / (1.0 + math.exp(-(a * self.evidence(p) + b)))
        if max(p, default=0.0) < 0.5:
            return score, []
        return score, [{"start": m.start(), "stop": m.end(), "p": x} for m, x in zip(WORD.finditer(text), p) if x >= 0.5]


def sample(docs: DataFrame, labels: DataFrame, keep: Column, size: int) -> list[tuple[str, int]]:
    """Bounded sample of (text, toxic): the documents with the lowest hashes of each label."""
    one = labels.where(F.col("toxic").isNotNull() & keep).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    texts = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = []
    for toxic, most in ((1, size), (0, 2 * size)):
        # the ids are bounded before the texts are read
        ids = one.where(F.col("toxic") == toxic).orderBy(F.xxhash64("doc_id"), "doc_id").limit(most).select("doc_id")
        found = texts.join(F.broadcast(ids), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(most)
        rows += [(r.text, toxic) for r in found.select("text").collect()]
    return rows


def without_copies(rows: list[tuple[str, int]]) -> list[tuple[str, int]]:
    """The texts in their order, without those that are copies of one with the same label that stays.

    A copy shares COPY of the runs of words of both texts, counted exactly; texts that share a least hash are compared.
    """
    factors = np.random.default_rng(0).integers(1, 1 << 62, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    least = np.zeros((len(rows), HASHES), np.uint64)
    stay: list[tuple[str, int]] = []
    kept: dict[int, list[tuple[int, np.ndarray]]] = {0: [], 1: []}
    for i, (text, label) in enumerate(rows):
        words = WORD.findall(text.lower())
        runs = {" ".join(words[k : k + RUN]) for k in range(max(1, len(words) - RUN + 1))}
        # sorted and distinct, so that two sets merge
        hashes = np.unique(np.fromiter((zlib.crc32(r.encode()) for r in runs), np.uint32, len(runs)))
        least[i] = ((hashes.astype(np.uint64) + np.uint64(1))[:, None] * factors).min(axis=0)
        before = kept[label]
        near = np.flatnonzero((least[[j for j, _ in before]] == least[i]).any(axis=1)) if before else ()
        if not any(shared(hashes, before[k][1]) >= COPY for k in near):
            before.append((i, hashes))
            stay.append((text, label))
    return stay


def shared(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets."""
    if min(a.size, b.size) < COPY * max(a.size, b.size):
        return 0.0
    both = np.intersect1d(a, b, assume_unique=True).size
    return both / (a.size + b.size - both)


def surprise(n: int, total: int, rate: float) -> float:
    """Nats by which n hits of total are beyond what the rate gives, by the large-deviation bound."""
    p = n / total
    rest = (1 - p) * math.log((1 - p) / (1 - rate)) if p < 1 else 0.0
    return total * (p * math.log(p / rate) + rest) if p > rate else 0.0


def in_new_places(texts: list[str]):
    """For each text, its words that stand between a pair of words between which no text before has them.

    Passages that texts share hold the same words at the same places, so they count once; what is put into texts
    of their own counts for each. A place is a 64-bit hash of the word and its two neighbours; which text has it first is
    found by sorting the places of all texts, so none is forgotten, however many there are.
    """

    def words_of(text: str) -> list[str]:
        return WORD.findall(text.lower())

    places = []
    for text in texts:
        words = ["", *words_of(text), ""]
        places.append(np.fromiter((xxh3_64_intdigest(f"{a} {w} {b}") for a, w, b in zip(words, words[1:], words[2:])), np.uint64, len(words) - 2))
    ends = np.cumsum([p.size for p in places])
    every = np.concatenate(places) if places else np.zeros(0, np.uint64)
    places.clear()
    every, first, own = np.unique(every, return_index=True, return_inverse=True)
    first = np.searchsorted(ends, first, side="right").astype(np.int32)[own]  # the first text of each word's place
    del every, own
    for k, text in enumerate(texts):
        new = first[ends[k - 1] if k else 0 : ends[k]] == k
        yield {w for w, fresh in zip(words_of(text), new.tolist()) if fresh}


def toxic_units(rows: list[tuple[str, int]]) -> set[str]:
    """Units that explain toxic documents: of all of them first, then of those that have none of the units found."""

    def units_of(words) -> set[str]:
        return {u for w in words for u in units(w)}

    def counted(words, among: set[str]) -> Counter:
        out = Counter()
        for own in words:
            out.update(units_of(own) & among)
        return out

    def repeated(texts: list[str]) -> set[str]:
        """Units of LEAST_DOCS texts or more, and few others: sums over hashes leave most of the rest out unseen."""
        sums, out = np.zeros(1 << 22, np.int32), set()
        slots = lambda found: np.fromiter((zlib.crc32(u.encode()) % sums.size for u in found), np.int64, len(found))
        for own in in_new_places(texts):
            np.add.at(sums, slots(units_of(own)), 1)
        for own in in_new_places(texts):
            found = list(units_of(own))
            out.update(found[i] for i in np.flatnonzero(sums[slots(found)] >= LEAST_DOCS))
        return out

    left, n_clean = [t for t, toxic in rows if toxic], sum(not toxic for _, toxic in rows)
    marked, clean = set(), None
    while left:
        bad = {u: n for u, n in counted(in_new_places(left), repeated(left)).items() if n >= LEAST_DOCS}
        if clean is None:  # only these: the driver need not hold the words of clean texts
            clean = counted((set(WORD.findall(t)) for t, toxic in rows if not toxic), set(bad))
            rate = (n_clean + 1) / (len(left) + 1)
            frequent = {u for u, n in bad.items() if n * rate >= LEAST_RATIO * clean[u]}  # of all toxic documents
        share = (len(left) + 1) / (len(left) + n_clean + 2)
        new = {u for u, n in bad.items() if u in frequent and surprise(n, n + clean[u], share) >= LEAST_NATS}
        if not new:
            break
        marked |= new
        left = [t for t in left if not any(not marked.isdisjoint(units(w)) for w in set(WORD.findall(t)))]
    return marked


def chains(docs: list[tuple[list[str], bytes]], clean_part: int | None = None) -> list[tuple[list[str], bytes]]:
    """docs(words, tags) cut into chains: all, or those that hold a toxic word and clean_part times as many others, evenly."""
    toxic, clean = [], []
    for words, tags in docs:
        for at in range(0, len(words), CHAIN):
            part = (words[at : at + CHAIN], tags[at : at + CHAIN])
            (toxic if any(part[1]) else clean).append(part)
    step = max(1, len(clean) // max(1, clean_part * len(toxic))) if clean_part else 1
    return toxic + clean[::step]


def constrained(marginals: list[float]) -> bytes:
    """Tags of a toxic document: words that are toxic with a chance of half or more, given that one at least is."""
    none = math.exp(sum(math.log1p(-min(p, 1 - 1e-9)) for p in marginals))
    return bytes(none < 1 - LEAST_CHANCE and p >= 0.5 * (1 - none) for p in marginals)


def expected(emission: np.ndarray, moves: np.ndarray, tags: np.ndarray, on: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward over chains side by side, in odds of the toxic state: tag less marginal of each word, and
    expected transitions. All of shape (chains, words); on marks words, which come before what fills a chain up."""
    n, longest = emission.shape
    e, on = np.exp(np.clip(emission.T, -30.0, 30.0)), on.T
    (m00, m01), (m10, m11) = np.exp(moves)
    ahead, onward = np.empty((longest, n)), np.empty((longest, n))
    ahead[0] = e[0]
    for k in range(1, longest):
        ahead[k] = e[k] * (m01 + m11 * ahead[k - 1]) / (m00 + m10 * ahead[k - 1])
    back = np.ones(n)
    for k in range(longest - 1, -1, -1):
        onward[k] = e[k] * back  # odds of the word and all after it
        back = np.where(on[k], (m10 + m11 * onward[k]) / (m00 + m01 * onward[k]), 1.0)
        ahead[k] *= onward[k] / e[k]
    before, y = ahead[:-1] * e[:-1] / np.maximum(onward[:-1], 1e-300), onward[1:]
    pairs = np.stack([np.broadcast_to(m00, y.shape), m01 * y, m10 * before, m11 * before * y])
    pairs = (pairs / pairs.sum(axis=0) * on[1:]).sum(axis=(1, 2)).reshape(2, 2)
    return np.where(on, tags.T - ahead / (1 + ahead), 0.0).T, pairs


def fit_field(data: list[tuple[list[str], bytes]], rounds: int = 60, rate: float = 0.15, decay: float = 1e-6, start: Model | None = None) -> Model:
    """Full-batch Adam on the likelihood of the tags, from zero or from another field; FIT_CHAINS chains advance
    together, one word at a time."""
    n, longest, wide = len(data), CHAIN, 3 + len(BEGINNINGS) + len(ENDS)
    # place of each word of a chain in the vocabulary, whose last entry has no features
    place = np.full((n, longest), -1, np.int32)
    tags, on = np.zeros((n, longest), np.int8), np.zeros((n, longest), bool)
    known: dict[str, int] = {}
    for i, (words, marks) in enumerate(data):
        tags[i, : len(words)], on[i, : len(words)] = list(marks), True
        place[i, : len(words)] = [known.setdefault(w, len(known)) for w in words]
    index = np.full((len(known) + 1, wide), SIZE, np.int32)
    for w, i in known.items():
        f = features(w)
        index[i, : len(f)] = f
    place[~on] = len(known)
    known.clear()
    used, index = np.unique(index, return_inverse=True)
    index, pad = index.reshape(-1, wide), used.size - 1
    theta = np.zeros(used.size + 1 + 4)
    if start is not None:
        theta[: used.size][used < SIZE] = start.weights[used[used < SIZE]]
        theta[-4:] = start.moves.ravel()
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    true_moves = np.zeros((2, 2))
    both = on[:, 1:]
    np.add.at(true_moves, (tags[:, :-1][both], tags[:, 1:][both]), 1)
    for step in range(1, rounds + 1):
        w, moves = theta[:-4], theta[-4:].reshape(2, 2)
        w[pad] = 0.0
        emission = w[index].sum(axis=1)
        gaps, found_moves = np.zeros(len(index)), np.zeros((2, 2))
        for at in range(0, n, FIT_CHAINS):
            part = slice(at, at + FIT_CHAINS)
            gap, moved = expected(emission[place[part]], moves, tags[part], on[part])
            gaps += np.bincount(place[part].ravel(), gap.ravel(), minlength=len(index))
            found_moves += moved
        grad = np.zeros_like(theta)
        grad[:-4] = np.bincount(index.ravel(), np.repeat(gaps, wide), minlength=used.size + 1)
        grad[-4:] = (true_moves - found_moves).ravel()
        grad = grad / n - decay * theta
        grad[pad] = 0.0
        mean, square = 0.9 * mean + 0.1 * grad, 0.999 * square + 0.001 * grad**2
        theta += rate * (mean / (1 - 0.9**step)) / (np.sqrt(square / (1 - 0.999**step)) + 1e-8)
    weights = np.zeros(SIZE)
    real = used < SIZE
    weights[used[real]] = theta[:-4][: used.size][real]
    return Model(weights, theta[-4:].reshape(2, 2).copy())


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Newton's method for one input and a constant."""
    design, beta = np.stack([x, np.ones_like(x)], axis=1), np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        grad = design.T @ (y - p) - ridge * beta
        beta += np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + ridge * np.eye(2), grad)
    return float(beta[0]), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, keep: Column, size: int = SAMPLE) -> Model:
    rows = without_copies(sample(docs, labels, keep, size))
    if len({t for _, t in rows}) < 2 or not (marked := toxic_units(rows)):
        return Model(np.zeros(SIZE), np.zeros((2, 2)), (0.0, -3.0))
    pool: dict[str, str] = {}  # a word is held once, however often it stands in the sample
    words = [[pool.setdefault(w, w) for w in WORD.findall(text)] for text, _ in rows]
    toxic = {w for w in pool if not marked.isdisjoint(units(w))}
    pool.clear()
    tags = [bytes(bool(y) and w in toxic for w in ws) for ws, (_, y) in zip(words, rows)]
    model = fit_field(chains(list(zip(words, tags)), CLEAN_FIRST))
    for _ in range(ROUNDS):
        anew = [constrained(model.marginals(ws)) if y else bytes(len(ws)) for ws, (_, y) in zip(words, rows)]
        settled = anew == tags
        tags = anew if any(map(any, anew)) else tags
        model = fit_field(chains(list(zip(words, tags))), ANEW, start=model)
        if settled:
            break
    evidence = np.array([model.evidence(model.marginals(ws)) for ws in words])
    model.line = logistic(evidence, np.array([y for _, y in rows], float))
    model.cache.clear()
    return model


def toxicity_column(text: Column, spark: SparkSession, model: Model) -> Column:
    """struct(score, spans) of each text; the model has a fixed size and is broadcast."""
    held = spark.sparkContext.broadcast(model)
    kind = pa.struct([("score", pa.float64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("p", pa.float64())])))])

    @F.arrow_udf(f"struct<score:double,spans:{SPANS}>")
    def rate(texts: pa.Array) -> pa.Array:
        model = held.value
        return pa.array([dict(zip(("score", "spans"), model.score(t.as_py() or ""))) for t in texts], kind)

    return rate(text)


def fold(doc_id: str, parts: int) -> Column:
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(fold("doc_id", 5) == 0, F.lit(False))
    model = fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    rated = docs.select("doc_id", held_out.alias("held_out"), toxicity_column(F.col("text"), spark, model).alias("r"))
    return rated.select("doc_id", "held_out", "r.score", F.when(F.col("r.score") >= 0.5, 1).otherwise(0).alias("predicted"), "r.spans")


QUERIES = {"op9_toxicity": op9_toxicity}
ORACLES: dict[str, str] = {}
