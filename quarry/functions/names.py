"""Names of columns that no column has."""

from __future__ import annotations

from pyspark.sql import DataFrame


def unused(df: DataFrame, *names: str) -> list[str]:
    """Each name, or the name after as many underscores as it takes to be none of df's columns and none of the others."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out
