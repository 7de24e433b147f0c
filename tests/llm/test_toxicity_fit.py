import numpy as np

from quarry.llm import toxicity


def test_fit_in_parts(monkeypatch):
    """The field does not depend on how many chains are held at once, and tags what the chains mark."""
    rng = np.random.default_rng(5)
    words = ["calm", "river", "stone", "walks", "green", "vile", "rotten"]
    data = []
    for _ in range(50):
        chain = [words[i] for i in rng.integers(0, len(words), rng.integers(1, toxicity.CHAIN + 1))]
        data.append((chain, [int(w in ("vile", "rotten")) for w in chain]))
    whole = toxicity.fit_field(data)
    monkeypatch.setattr(toxicity, "FIT_CHAINS", 7)
    parts = toxicity.fit_field(data)
    assert np.allclose(whole.weights, parts.weights, atol=1e-6)
    assert np.allclose(whole.moves, parts.moves, atol=1e-6)
    marginals = parts.marginals(["calm", "vile", "stone"])
    assert marginals[1] > 0.5 > max(marginals[0], marginals[2])


def test_only_copies_are_left_out():
    """Texts that share a passage, but less than half of their runs of words, all count; copies and near copies do not."""
    rng = np.random.default_rng(3)
    said = lambda n: " ".join(f"w{i}" for i in rng.integers(0, 5000, n))
    passage = said(40)
    apart = [(f"{said(40)} {passage} {said(40)}", k % 2) for k in range(80)]
    copies = [(text.upper() if k % 2 else f"{text} and a few words more", label) for k, (text, label) in enumerate(apart)]
    assert toxicity.without_copies(apart + copies) == apart
    assert toxicity.without_copies([("", 0), ("", 0), ("", 1), ("one", 1), ("One", 1)]) == [("", 0), ("", 1), ("one", 1)]
    assert toxicity.without_copies([]) == []
