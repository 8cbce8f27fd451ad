"""High-water marks and the rows beyond them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.functions.columns import named


def high_mark(df: DataFrame, column: str) -> DataFrame:
    """One row holding the highest value of the column."""
    return df.agg(F.max(named(column)).alias("value"))


def beyond(df: DataFrame, column: str, mark: Any | None) -> DataFrame:
    """Rows above the mark, a pushed-down filter; all rows when there is no mark yet."""
    return df if mark is None else df.where(named(column) > F.lit(mark))


def marks_per_key(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Highest version of every key."""
    return df.groupBy(*[named(key) for key in keys]).agg(F.max(named(version)).alias("mark"))


def beyond_marks(
    df: DataFrame, marks: DataFrame, keys: Sequence[str], version: str | Column, include_equal: bool = False
) -> DataFrame:
    """Rows of new keys, and rows above their key's mark.

    ``marks`` is unique per key, so the join keeps the row count.  Read it from
    the table it was stored in: a hot key in ``df`` is then a skewed left side
    that adaptive execution splits, which it does not do beside an aggregate.
    """
    value = named(version) if isinstance(version, str) else version
    joined = df.withColumn("__version", value).join(marks, list(keys), "left")
    above = F.col("__version") > F.col("mark")
    if include_equal:
        above = F.col("__version") >= F.col("mark")
    return joined.where(F.col("mark").isNull() | above).drop("mark", "__version")


def advance_marks(marks: DataFrame, newer: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Marks after a successful run; a mark never moves back."""
    both = marks.unionByName(newer)
    return both.groupBy(*[named(key) for key in keys]).agg(F.max("mark").alias("mark"))


def lookback_start(last_success: datetime | date, days: int) -> date:
    """First arrival date to read again."""
    day = last_success.date() if isinstance(last_success, datetime) else last_success
    return day - timedelta(days=days)


def since(df: DataFrame, column: str, start: date) -> DataFrame:
    return df.where(named(column) >= F.lit(start))
