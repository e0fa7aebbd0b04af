"""Small shared types."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Split(NamedTuple):
    """Accepted and rejected rows of one frame."""

    good: DataFrame
    bad: DataFrame


class EmptyInput(Exception):
    """A source has no rows: stop the job early without calling it a failure."""


class RuleViolation(Exception):
    """An assertion about the data does not hold."""


class Quarantined(RuleViolation):
    """Rows with errors were written aside; ``path`` says where."""

    def __init__(self, path: str):
        super().__init__(f"input has errors, rows written to {path}")
        self.path = path


def split_on(df: DataFrame, is_bad: Column) -> Split:
    """Split by a flag; an unknown (null) flag counts as good.

    Both sides are filters over the same plan, so nothing is shuffled and every
    input row lands on exactly one side.
    """
    flag = F.coalesce(is_bad, F.lit(False))
    return Split(df.where(~flag), df.where(flag))


def is_blank(name: str) -> Column:
    """Null, or text that is empty once trimmed."""
    c = F.col(name)
    return c.isNull() | (F.trim(c.cast("string")) == "")
