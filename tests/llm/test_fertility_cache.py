"""Words that texts share are encoded once, though words of a single text fill the cache again and again."""

import public_tokenizers
from quarry.llm import fertility

PATHS = ("byte_bpe_multi_50k.tiktoken", "piece_bpe_32k.model")


def test_shared_words_outlive_words_of_one_text(monkeypatch):
    shared = [f"common{k}" for k in range(50)]
    texts = [" ".join([*shared, *(f"once{k}x{i}" for i in range(100)), "​", "naïve"]) for k in range(20)]
    plain = [fertility.measure(t, fertility.Vocabularies(*map(public_tokenizers.path, PATHS))) for t in texts]
    monkeypatch.setattr(fertility, "CACHED_WORDS", 300)
    known, asked = fertility.Vocabularies(*map(public_tokenizers.path, PATHS)), []

    class Pieces:
        def __init__(self, whole):
            self.whole = whole

        def encode(self, words, **rest):
            asked.extend(words)
            return self.whole.encode(words, **rest)

    known.pieces = Pieces(known.pieces)
    assert [fertility.measure(t, known) for t in texts] == plain
    assert all(asked.count(w) == 1 for w in shared)
