"""Items are met by stretches between borders of words only, whatever their budget; against all such stretches."""

import random

import pytest

from quarry.llm import decontaminate

from . import brute


def plain(item, text):
    """Least distance of the item to any run of whole words."""
    words = text.split(" ")
    near = [w for n in range(1, len(words) + 1) for w in (" ".join(words[i : i + n]) for i in range(len(words) - n + 1)) if abs(len(w) - len(item)) <= len(item)]
    return min((distance(item, w) for w in near), default=len(item))


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a, 1):
        new = [i]
        for j, d in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return row[-1]


@pytest.mark.parametrize("item", ["abcdef ghijk", "abcdef ghijklm"])
def test_short_and_longer_items_alike(item):
    found = lambda text: [h[:2] for h in decontaminate.Matcher([(1, item)]).hits(text)]
    assert found(f"x {item} y") == [(1, 0)] == found(item)
    assert found(f"x {item}yy z") == [] == found(f"x zz{item} y")


def test_against_all_runs_of_words():
    r = random.Random(4)
    met = 0
    for _ in range(400):
        words = ["".join(r.choice("ab") for _ in range(r.randint(1, 4))) for _ in range(r.randint(4, 9))]
        item = " ".join(words)
        own = list(item)
        for _ in range(r.randint(0, 3)):
            k = r.randrange(len(own))
            own[k : k + 1] = r.choice([[], ["c"], [own[k], "a"], [" "]])
        pad = [" ".join(r.choice(["ab", "b", "aab"]) for _ in range(r.randint(0, 4))) for _ in range(2)]
        text = decontaminate.normal(pad[0] + r.choice([" ", "", "a"]) + "".join(own) + r.choice([" ", "", "b"]) + pad[1])
        best, budget = plain(item, text), int(decontaminate.RATE * len(item))
        hits = decontaminate.Matcher([(1, item)]).hits(text)
        assert [h[1] for h in hits] == ([best] if best <= budget else []), (item, text)
        for _, d, _, a, b in hits:
            assert distance(item, text[a:b]) == d and (f" {text} "[a], f" {text} "[b + 1]) == (" ", " ")
        met += bool(hits)
        assert best >= brute.nearest(item, text)
    assert 50 < met < 350
