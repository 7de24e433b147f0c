"""Plain versions of the operators' contracts, written from their statements and not from the operators."""

import hashlib
import re
from collections import Counter

import xxhash

WORD = re.compile("[^\x20\x09-\x0d]+")
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ACCESS, HEX = re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def secrets(text):
    """Base spans (kind, start, end), by start and then kind."""
    text = text or ""
    out = [(0, m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(1, m.start(), m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 20]
    out += [(2, m.start(), m.end()) for m in HEX.finditer(text) if len(m[0]) >= 24]
    return [(("assign", "access", "hex")[k], a, b) for k, a, b in sorted(out, key=lambda x: (x[1], x[0]))]


def base_sha256(text):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in secrets(text)).encode()).hexdigest()


def fingerprint(text, width=3):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    grams = [" ".join(words)] if len(words) < width else [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)]
    counts = Counter(xxhash.xxh64_intdigest(g.encode(), 42) for g in grams)
    return sum(1 << b for b in range(64) if 2 * sum(n for h, n in counts.items() if h >> b & 1) > len(grams))


def classes(fingerprints, bits=3):
    """{id: least id reachable} for {id: fingerprint}, over all pairs of distinct fingerprints."""
    at = {}
    for i, f in fingerprints.items():
        at.setdefault(f, []).append(i)
    distinct, root = list(at), {f: f for f in at}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for n, f in enumerate(distinct):
        for g in distinct[n + 1 :]:
            if (f ^ g).bit_count() <= bits:
                root[find(f)] = find(g)
    least = {}
    for f, ids in at.items():
        least[find(f)] = min([least.get(find(f), ids[0]), *ids])
    return {i: least[find(f)] for f, ids in at.items() for i in ids}


def rules(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    words, seen, dup = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    inside = {i + k for i in range(len(words) - 7) if grams[tuple(words[i : i + 8])] > 1 for k in range(8)}
    n = len(words)
    return (n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside), n < 20 or 100 * len(inside) > 30 * n)


def nearest(item, text):
    """Least edit distance of item to any stretch of text, by the plain table."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
        row = new
    return min(row)
