"""Large JSON documents (O-1, O-5, O-6): one array or one map of any size, read by many tasks.

A file is cut into byte ranges. Whether a byte is inside a string or after a backslash, and how deep it lies in brackets,
depends on all bytes before it. So a first pass gives for each range what it makes of every state it may begin in; these
results are composed in the order of the ranges, one row each, which gives the state that each range begins in. A
second pass finds the commas of the outermost array or map, and each range gives the entries that begin in it, reading
on for the last one. No task holds more than a range and an entry.

Cases: a file may hold several documents one after the other, all arrays or all maps. An empty array or map has no entries, nor has
an empty file. What is no value (a missing key, text after a string, two commas) is one row with its place, its text and
an error, and leaves the other entries alone, as long as its quotes and brackets are paired; if they are not, all that
follows them in the file is part of the broken entry. A file that is cut short has an error in its last entry.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import listing, located

RANGE_BYTES = 32 << 20
#: Bytes that are looked at in one step.
STEP = 1 << 20
QUOTE, SLASH, COMMA = ord('"'), ord("\\"), ord(",")
SIGNS = np.zeros(256, np.int8)
SIGNS[[ord("["), ord("{")]] = 1
SIGNS[[ord("]"), ord("}")]] = -1
CUT_SHORT, NO_KEY, NO_VALUE = "the file ends inside the entry", "no key before the value", "not a JSON value"
ENTRIES = "source_file string, at long, key string, text string, error string"


def quoted(data: np.ndarray, escaped: bool) -> tuple[np.ndarray, bool]:
    """Places of quotes that begin or end a string, and whether the byte behind data is escaped. escaped: its first is."""
    slashes = np.flatnonzero(data == SLASH)
    quotes = np.flatnonzero(data == QUOTE)
    if escaped and (not slashes.size or slashes[0]) and quotes.size and quotes[0] == 0:
        quotes = quotes[1:]
    if not slashes.size:
        return quotes, False
    if escaped and slashes[0] == 0:
        slashes = slashes[1:]  # it is itself escaped
        if not slashes.size:
            return quotes, False
    first = np.flatnonzero(np.append(True, np.diff(slashes) > 1))
    lengths = np.diff(np.append(first, slashes.size))
    odd = (slashes[first] + lengths)[lengths % 2 == 1]  # the bytes behind an odd run of backslashes
    return np.setdiff1d(quotes, odd, assume_unique=True), bool(odd.size and odd[-1] == data.size)


class Scan:
    """State at a place of a file: inside a string, behind a backslash, depth of brackets."""

    def __init__(self, inside: bool = False, escaped: bool = False, depth: int = 0):
        self.inside, self.escaped, self.depth = inside, escaped, depth

    def step(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of brackets outside strings and of commas there at depth 1, and the depth behind each."""
        quotes, self.escaped = quoted(data, self.escaped)
        marks = np.flatnonzero((SIGNS[data] != 0) | (data == COMMA))
        outside = (np.searchsorted(quotes, marks) + self.inside) % 2 == 0
        marks = marks[outside]
        depths = self.depth + np.cumsum(SIGNS[data[marks]], dtype=np.int64)
        if marks.size:
            self.depth = int(depths[-1])
        self.inside = bool((quotes.size + self.inside) % 2)
        keep = (data[marks] != COMMA) | (depths == 1)
        return marks[keep], depths[keep]


def _steps(f, start: int, stop: int):
    """(place, bytes) of a file from start to stop."""
    f.seek(start)
    while start < stop and (data := f.read(min(STEP, stop - start))):
        yield start, data
        start += len(data)


def _states(ranges: DataFrame) -> DataFrame:
    """ranges(path, k, start, stop) with what each makes of the four states it may begin in: ends[2 * inside + escaped]
    of (inside, escaped, depth)."""

    def run(batches):
        for b in batches:
            for row in b.to_pylist():
                store, place = located(row["path"])
                scans = [Scan(bool(s & 2), bool(s & 1)) for s in range(4)]
                with store.open_input_file(place) as f:
                    for _, data in _steps(f, row["start"], row["stop"]):
                        for s in scans:
                            s.step(np.frombuffer(data, np.uint8))
                ends = [{"inside": s.inside, "escaped": s.escaped, "depth": s.depth} for s in scans]
                yield pa.RecordBatch.from_pylist([row | {"ends": ends}], kinds)

    state = pa.struct([("inside", pa.bool_()), ("escaped", pa.bool_()), ("depth", pa.int64())])
    kinds = pa.schema([("path", pa.string()), ("k", pa.int64()), ("start", pa.int64()), ("stop", pa.int64()), ("ends", pa.list_(state))])
    return ranges.mapInArrow(run, "path string, k long, start long, stop long, ends array<struct<inside:boolean,escaped:boolean,depth:long>>")


def _with_begins(states: DataFrame) -> DataFrame:
    """Ranges with the state that each begins in: the ends of those before it, composed. A file has one row a range here."""
    begin = F.struct(F.lit(False).alias("inside"), F.lit(False).alias("escaped"), F.lit(0).cast("long").alias("depth"))
    listed = states.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("k", "start", "stop", "ends"))).alias("all"))

    def after(state: Column, r: Column) -> Column:
        end = F.get(r["ends"], state["inside"].cast("int") * 2 + state["escaped"].cast("int"))
        return F.struct(end["inside"].alias("inside"), end["escaped"].alias("escaped"), (state["depth"] + end["depth"]).alias("depth"))

    begins = F.aggregate("all", F.array(begin), lambda acc, r: F.concat(acc, F.array(after(F.element_at(acc, -1), r))))
    out = listed.select("path", F.explode(F.arrays_zip(F.col("all"), F.slice(begins, F.lit(1), F.size("all")).alias("begin"))).alias("r"))
    return out.select("path", "r.all.k", "r.all.start", "r.all.stop", "r.begin.*")


def _entry(text: bytes, keyed: bool, whole: bool) -> tuple[str | None, str, str | None]:
    """(key, text of the value, error) of the bytes between two commas or brackets."""
    said = text.decode("utf-8", "replace").strip(" \t\r\n")
    if not whole:
        return None, said, CUT_SHORT
    key = None
    if keyed:
        try:
            key, at = json.JSONDecoder().raw_decode(said)
        except ValueError:
            key = None
        rest = said[at:].lstrip(" \t\r\n") if isinstance(key, str) else ""
        if not rest.startswith(":"):
            return None, said, NO_KEY
        said = rest[1:].strip(" \t\r\n")
    try:
        json.loads(said, parse_float=str, parse_int=str)
    except (ValueError, RecursionError):
        return key, said, NO_VALUE
    return key, said, None


def _found(f, size: int, start: int, stop: int, scan: Scan):
    """(place, bytes, keyed, whole) of the entries whose comma or bracket before them lies in the range."""
    # the kind of the document that the range begins in is that of the file's first bracket
    head = next((c for _, data in _steps(f, 0, size) if (c := data.lstrip(b" \t\r\n\xef\xbb\xbf")[:1])), b"")
    keyed, open_at, held, kept_from = head == b"{", None, bytearray(), start
    for at, data in _steps(f, start, size):
        marks, depths = scan.step(np.frombuffer(data, np.uint8))
        edge = at
        for m, depth in zip((marks + at).tolist(), depths.tolist()):
            c = data[m - at]
            if not (c == COMMA or depth == 1 and SIGNS[c] > 0 or depth == 0 and SIGNS[c] < 0):
                continue
            if open_at is not None:
                text = bytes(held) + data[max(edge, open_at) - at : m - at]
                if text.strip(b" \t\r\n") or c == COMMA or comma:
                    yield open_at, text, keyed, True
                held.clear()
            open_at = None
            if m >= stop:
                return
            if c == COMMA or SIGNS[c] > 0:
                keyed = keyed if c == COMMA else c == ord("{")
                open_at, comma, edge = m + 1, c == COMMA, m + 1
        if open_at is not None:
            held += data[max(edge, open_at) - at :]
        elif at + len(data) >= stop:
            return
    if open_at is not None and (held.strip(b" \t\r\n") or comma):
        yield open_at, bytes(held), keyed, False


def json_entries(spark: SparkSession, path: str, name: str = "*", deep: bool = False, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """ENTRIES: a row for each entry of the arrays or maps in the files; at is the place of its first byte, key is null in arrays."""
    files = listing(spark, path, name, deep).where("length > 0")
    k = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("length") - 1) / range_bytes)))
    ranges = files.select("path", "length", k.alias("k"))
    ranges = ranges.select("path", "k", (F.col("k") * range_bytes).alias("start"), F.least("length", (F.col("k") + 1) * range_bytes).alias("stop"))
    begun = _with_begins(_states(ranges.repartition("path", "k"))).repartition("path", "k")

    def run(batches):
        kinds = pa.schema([("source_file", pa.string()), ("at", pa.int64()), ("key", pa.string()), ("text", pa.string()), ("error", pa.string())])
        for b in batches:
            for r in b.to_pylist():
                store, place = located(r["path"])
                rows, held = [], 0
                with store.open_input_file(place) as f:
                    for at, text, keyed, whole in _found(f, f.size(), r["start"], r["stop"], Scan(r["inside"], r["escaped"], r["depth"])):
                        rows.append(dict(zip(kinds.names, (r["path"], at, *_entry(text, keyed, whole)))))
                        held += len(text)
                        if held > STEP:
                            yield pa.RecordBatch.from_pylist(rows, kinds)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, kinds)

    return begun.mapInArrow(run, ENTRIES)


def parsed(entries: DataFrame, item: str) -> DataFrame:
    """json_entries() with column item of the DDL type item; error also where the value is of another type."""
    if item.startswith(("struct", "array", "map")):
        value = F.from_json("text", item, {"mode": "PERMISSIVE"})
        # a value of another type is a null, or a struct that has nothing but nulls
        opening = "[" if item.startswith("array") else "{"
        value = F.when(F.substring("text", 1, 1) == opening, value)
    else:
        value = F.try_variant_get(F.try_parse_json("text"), "$", item)
    fits = value.isNotNull() | (F.col("text") == "null")
    error = F.coalesce("error", F.when(~F.coalesce(fits, F.lit(False)), F.lit(f"not of type {item}")))
    return entries.withColumn("item", F.when(F.col("error").isNull(), value)).withColumn("error", error)
