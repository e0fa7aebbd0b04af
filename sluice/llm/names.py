"""Helper columns beside a caller's columns."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spare(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores behind it as it takes to differ from all columns, whatever their case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
