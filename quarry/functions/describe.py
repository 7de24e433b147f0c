"""O-34: descriptions of an edit target for a prompt. Sizes are printed height x width, boxes as whole numbers.

The wording is part of what the prompts expect, so it is kept as it is, spelling included.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _joined(*parts) -> Column:
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def box_text(bbox: Column) -> Column:
    """Corners of an array of four numbers, each to the nearest whole number, halves to the even one."""
    return _joined("[", F.array_join(F.transform(bbox, lambda x: F.bround(x, 0).cast("long").cast("string")), ","), "]")


def size_text(height: Column, width: Column) -> Column:
    return _joined(height.cast("long"), "x", width.cast("long"))


def listed(items: Column) -> Column:
    """Strings in brackets and single quotes."""
    return _joined("['", F.array_join(items, "', '"), "']")


def target(summary: Column, name: Column, size: Column, box: Column) -> Column:
    """Replace and adjust."""
    return _joined("summary: ", summary, ", object: '", name, "', resolution: ", size, ", object bbox: ", box, ".")


def background(summary: Column, name: Column, objects: Column) -> Column:
    return _joined("summary: ", summary, ", background: '", name, "'object in background: '", F.array_join(objects, ", "), "'.")


def multi_turn(caption: Column, name: Column, size: Column, box: Column, operations: Column) -> Column:
    """Content understanding and version backtracking."""
    return _joined("caption: ", caption, ", resolution: ", size, ", object: '", name, "', object bbox: ", box, ", instructions: ", listed(operations))


def addition(caption: Column, name: Column, size: Column, box: Column) -> Column:
    return _joined("caption: ", caption, " object: '", name, "', resolution: ", size, ", object bbox: ", box, ".")


def removal(caption: Column, name: Column, size: Column, box: Column) -> Column:
    """A null box gives the short form."""
    start = _joined("caption: ", caption, " object to remove: '", name, "'")
    return F.coalesce(_joined(start, ", resolution: ", size, ", object bbox: ", box), _joined(start, "."))


def two_objects(caption: Column, names: list[Column], boxes: list[Column] | None, operations: list[Column], size: Column | None = None) -> Column:
    """Hybrid edits; content memory without boxes and size."""
    out = ["sence: ", caption] + (["", ", resolution: ", size] if boxes else [])
    for k in range(2):
        out += [f", object{k + 1}: '", names[k], "'"]
        out += [f", bbox{k + 1}: ", boxes[k]] if boxes else []
        out += [f", instruction{k + 1}: '", operations[k], "'"]
    return _joined(*out, ".")
