"""Secret scan: all rules compiled into one minimal automaton, one pass over the bytes of each text.

The rules' regular expressions become one nondeterministic automaton, which subset construction and
partition refinement turn into a minimal deterministic one: a flat array of transitions over byte
classes. The pass over a text notes where a rule first accepts; for these few places the rule's own
reversed and forward automata, compiled in the same way, give the leftmost start and the longest end.
Matches of a rule never overlap. A match below its rule's lengths is dropped but stays consumed.

Cases: a null or empty text has no spans. Offsets are code points, ends exclusive. Rows are independent of each other,
so repeated rows get equal spans. Ids keep their type; other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache
from re import _parser

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: kind, pattern, fewest bytes of the match, fewest bytes from where the rule first accepts on.
BASE_RULES = (
    (
        "assign",
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""",
        0,
        6,
    ),
    ("access", r"AKIA[A-Z0-9]+", 20, 0),
    ("hex", r"[0-9a-f]{24,}", 24, 0),
)
MORE_RULES = (
    ("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
    ("prefixed", r"(gh[oprsu]_|glpat-|xox[abprs]-|sk_live_)[A-Za-z0-9_-]+", 24, 0),
    ("web_token", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 30, 0),
)
RULES = BASE_RULES + MORE_RULES


class _Nfa:
    def __init__(self):
        self.free: list[list[int]] = []
        self.on: list[list[tuple[frozenset, int]]] = []

    def state(self) -> int:
        self.free.append([])
        self.on.append([])
        return len(self.free) - 1

    def add(self, items, at: int, back: bool) -> int:
        """Append the parsed pattern after state at; gives its last state. back: the pattern reversed."""
        for op, arg in reversed(list(items)) if back else items:
            op = str(op)
            if op in ("LITERAL", "IN"):
                end = self.state()
                self.on[at].append((frozenset([arg]) if op == "LITERAL" else _bytes_of(arg), end))
                at = end
            elif op == "SUBPATTERN":
                at = self.add(arg[3], at, back)
            elif op == "BRANCH":
                end = self.state()
                for way in arg[1]:
                    self.free[self.add(way, at, back)].append(end)
                at = end
            elif op == "MAX_REPEAT":
                low, high, body = arg
                for _ in range(low):
                    at = self.add(body, at, back)
                if high == _parser.MAXREPEAT:
                    loop = self.state()
                    self.free[at].append(loop)
                    self.free[self.add(body, loop, back)].append(loop)
                    at = loop
                else:
                    ends = [at]
                    for _ in range(high - low):
                        at = self.add(body, at, back)
                        ends.append(at)
                    at = self.state()
                    for x in ends:
                        self.free[x].append(at)
            else:
                raise ValueError(f"unsupported in a rule: {op}")
        return at

    def closed(self, states) -> frozenset:
        out, todo = set(states), list(states)
        while todo:
            for y in self.free[todo.pop()]:
                if y not in out:
                    out.add(y)
                    todo.append(y)
        return frozenset(out)


def _bytes_of(items) -> frozenset:
    out = set()
    for op, arg in items:
        out |= {arg} if str(op) == "LITERAL" else set(range(arg[0], arg[1] + 1))
    return frozenset(out)


class Automaton:
    """Minimal automaton of some patterns; anywhere: of their shortest matches, from any place on. steps[state + class of byte] is the next state; states are
    multiples of width; those from accept on accept, and rules[state] says which patterns."""

    def __init__(self, patterns: list[str], anywhere: bool, back: bool = False):
        nfa = _Nfa()
        first = nfa.state()
        ends = {}
        for i, p in enumerate(patterns):
            at = nfa.state()
            nfa.free[first].append(at)
            items = list(_parser.parse(p))
            if anywhere and str(items[-1][0]) == "MAX_REPEAT":  # where it first accepts is all that is asked for
                low, _, body = items[-1][1]
                items[-1] = (items[-1][0], (low, low, body))
            ends[nfa.add(items, at, back)] = i
        sets = list({s for on in nfa.on for s, _ in on})
        kinds: dict[tuple, int] = {}
        self.classes = bytes(kinds.setdefault(tuple(b in s for s in sets), len(kinds)) for b in range(256))
        sample = {c: b for b, c in enumerate(self.classes)}
        begin = nfa.closed([first])
        known, moves, todo = {begin: 0}, [], [begin]
        for now in todo:
            row = []
            for c in range(len(kinds)):
                to = {y for x in now for s, y in nfa.on[x] if sample[c] in s}
                to = nfa.closed(to | {first} if anywhere else to)
                if to not in known:
                    known[to] = len(known)
                    todo.append(to)
                row.append(known[to])
            moves.append(row)
        hits = [tuple(sorted(ends[x] for x in s if x in ends)) for s in known]
        dead = [not s for s in known]
        group = self._refined(moves, [(h, d) for h, d in zip(hits, dead)])
        self._numbered(moves, hits, dead, group, len(kinds))

    @staticmethod
    def _refined(moves, marks):
        """Blocks of states that no continuation tells apart."""
        names: dict = {}
        group = [names.setdefault(m, len(names)) for m in marks]
        while True:
            names = {}
            new = [names.setdefault((group[i], *(group[j] for j in row)), len(names)) for i, row in enumerate(moves)]
            if len(names) == len(set(group)):
                return group
            group = new

    def _numbered(self, moves, hits, dead, group, width):
        first_of: dict[int, int] = {}
        for i, g in enumerate(group):
            first_of.setdefault(g, i)
        order = sorted(first_of, key=lambda g: (bool(hits[first_of[g]]), g))
        number = {g: n * width for n, g in enumerate(order)}
        self.steps = [number[group[j]] for g in order for j in moves[first_of[g]]]
        self.start = number[group[0]]
        self.accept = min((number[g] for g in order if hits[first_of[g]]), default=len(self.steps))
        self.rules = {number[g]: hits[first_of[g]] for g in order if hits[first_of[g]]}
        self.dead = {number[g] for g in order if dead[first_of[g]]}

    def accepted(self, data: bytes):
        """(end, state) wherever a prefix of the data is accepted: the one pass over all bytes."""
        s, steps, accept = self.start, self.steps, self.accept
        for i, c in enumerate(data.translate(self.classes), 1):
            s = steps[s + c]
            if s >= accept:
                yield i, s

    def longest(self, data, at: int, stop: int, step: int) -> int | None:
        """Furthest place, from at towards stop, to which an anchored match goes."""
        s, steps, best = self.start, self.steps, None
        while at != stop:
            s = steps[s + self.classes[data[at if step > 0 else at - 1]]]
            if s in self.dead:
                break
            at += step
            if s >= self.accept:
                best = at
        return best


@lru_cache(maxsize=8)
def compiled(rules: tuple) -> tuple:
    patterns = [p for _, p, _, _ in rules]
    return (
        Automaton(patterns, anywhere=True),
        [Automaton([p], anywhere=False) for p in patterns],
        [Automaton([p], anywhere=False, back=True) for p in patterns],
    )


def scan(data: bytes, rules: tuple = RULES) -> list[tuple[int, int, int]]:
    """(rule number, start, end) in bytes, by start and then by rule."""
    finder, forward, backward = compiled(rules)
    ends, out = [0] * len(rules), []
    for end, state in finder.accepted(data):
        for r in finder.rules[state]:
            if end <= ends[r]:
                continue
            start = backward[r].longest(data, end, ends[r], -1)
            if start is None:
                continue
            ends[r] = stop = forward[r].longest(data, start, len(data), 1)
            if stop - start >= rules[r][2] and stop - (end - 1) >= rules[r][3]:
                out.append((r, start, stop))
    return sorted(out, key=lambda x: (x[1], x[0]))


def spans(data: bytes, rules: tuple = RULES) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points."""
    found = scan(data, rules)
    if found and not data.isascii():
        places = sorted({x for _, a, b in found for x in (a, b)})
        points, at, n = {}, 0, 0
        for x in places:
            n += len(data[at:x].decode("utf-8", "replace"))
            points[x], at = n, x
        found = [(r, points[a], points[b]) for r, a, b in found]
    return [(rules[r][0], a, b) for r, a, b in found]


def find_secrets(docs: DataFrame, rules: tuple = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spans array of (kind, start, stop)) for each row of docs."""
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches):
        for b in batches:
            found = [
                [{"kind": k, "start": a, "stop": e} for k, a, e in spans(t.as_py() or b"", rules)] for t in b.column(1)
            ]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, kind)], ["doc_id", "spans"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    schema = f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, spans array<struct<kind:string,start:bigint,stop:bigint>>"
    return rows.mapInArrow(run, schema)


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    base = [k for k, *_ in BASE_RULES]

    def joined(col):
        return F.array_join(F.transform(col, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")

    def counted(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    of_base = F.filter("spans", lambda s: s["kind"].isin(base))
    counts = [counted(k) for k in base]
    return found.select(
        "doc_id", *counts, F.sha2(joined(of_base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans")
    )


QUERIES = {"op2_secrets": op2_secrets}
ORACLES: dict[str, str] = {}
