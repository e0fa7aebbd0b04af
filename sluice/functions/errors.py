"""The error column: an array of messages while working, joined text on output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ERRORS = "errors"


def with_errors(df: DataFrame, errors: str = ERRORS) -> DataFrame:
    """Make sure the error array exists and is not null."""
    empty = F.array().cast("array<string>")
    if errors not in df.columns:
        return df.withColumn(errors, empty)
    return df.withColumn(errors, F.coalesce(F.col(errors), empty))


def add_error(df: DataFrame, failed: Column, message: Column | str, errors: str = ERRORS) -> DataFrame:
    """Append a message where the condition holds; an unknown condition does not fail."""
    text = F.lit(message) if isinstance(message, str) else message
    df = with_errors(df, errors)
    return df.withColumn(errors, F.when(failed, F.array_append(errors, text)).otherwise(F.col(errors)))


def errors_text(df: DataFrame, errors: str = ERRORS, name: str | None = None, sep: str = ", ") -> DataFrame:
    """Replace the array by one text, empty when there are no errors."""
    out = with_errors(df, errors).withColumn("_text", F.array_join(errors, sep)).drop(errors)
    return out.withColumnRenamed("_text", name or errors)
