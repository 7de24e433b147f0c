"""Encode texts word by word with a bounded cache; the ids equal those of the whole text."""

from __future__ import annotations

import os
import sys
from array import array
from collections import Counter
from functools import lru_cache

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Words kept by each Python worker; a full cache is emptied. Longer words are never kept.
CACHED_WORDS, CACHED_CHARS = 400_000, 48
#: Letters before this code point are composed, and have one lower-case letter each but for one, which is tested for.
LATIN_END = "\u0250"


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable Latin-1 as it is, the rest from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + k) for k, b in enumerate(rest)}


class WordEncoder:
    """Ids of a text under a tokenizers file whose pre-tokenizer drops white space, so that no token spans words.

    Words of Latin letters are lower-cased here and go straight to the file's model; all others take the whole
    path (special tokens, normaliser, pre-tokenizer, model). Full stops and commas at a word's end are
    tokens of their own after a letter, so such a word is looked up without them.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.cache: dict[str, bytes] = {"": b""}
        # each short cut is taken only where this file is seen to behave as it assumes
        self.letters = byte_letters()
        self.plain = self._ids("Plain") == self._ids("plain") == [t.id for t in self.model.tokenize("plain")]
        probes = ("Éàñß", "ŒŁų", "þÅéé")
        self.latin = self.plain and all(self._ids(w) == self._ids(w.lower()) == self._modelled(w.lower()) for w in probes)
        self.tails = {t: self._bytes(self._ids(t)) for t in (".", ",", ".,", ",.")}
        self.cuts = self._ids("plain.") == self._ids("plain") + self._ids(".")

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _modelled(self, word: str) -> list[int]:
        if not word.isascii():
            word = "".join([self.letters[b] for b in word.encode()])
        return [t.id for t in self.model.tokenize(word)]

    @staticmethod
    def _bytes(ids) -> bytes:
        out = array("I", ids)
        if sys.byteorder == "big":
            out.byteswap()
        return out.tobytes()

    def _word(self, word: str) -> bytes:
        tail = b""
        if self.cuts and word[-1] in ".," and (core := word.rstrip(".,")) and core[-1].lower().isalpha() and word[len(core) :] in self.tails:
            word, tail = core, self.tails[word[len(core) :]]
        if self.plain and word.isalpha() and (word.isascii() or self.latin and max(word) < LATIN_END and len(word) == len(word.lower())):
            word = word.lower()
            out = self.cache.get(word)
            if out is None:
                out = self._bytes(self._modelled(word))
        else:
            out = self._bytes(self._ids(word))
        return out + tail

    def _known(self, words) -> dict[str, bytes]:
        """The ids of the words: the cache, or the cache and the words too long for it."""
        cache = self.cache
        missing = set(words).difference(cache)
        if len(cache) + len(missing) > CACHED_WORDS:
            cache.clear()
            cache[""] = b""
            missing = set(words) - {""}
        long = {}
        for w in missing:
            (cache if len(w) <= CACHED_CHARS else long)[w] = self._word(w)
        return {**{w: cache[w] for w in words if w in cache}, **long} if long else cache

    def encode(self, text: str) -> bytes:
        """The text's ids as little-endian unsigned 32-bit integers."""
        words = text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")
        known = self._known(words)
        return b"".join([known[w] for w in words])

    def count(self, text: str) -> int:
        """The number of the text's ids."""
        counts = Counter(text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" "))
        known = self._known(counts)
        return sum([n * len(known[w]) for w, n in counts.items()]) // 4


@lru_cache(maxsize=2)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)
