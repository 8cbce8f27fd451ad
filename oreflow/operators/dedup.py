"""Keeping one row per key.

Every order below must be total over the rows of a key, otherwise the winner
depends on how Spark happened to place the rows.

``row_number() = 1`` is pruned before the shuffle (each task keeps its own best
row per key), and ``max_by`` aggregates partially, so a key that holds a third
of all rows sends one row per task to its reducer in both forms.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreflow.functions.columns import lookup, named, row_struct, without


def first_per_key(df: DataFrame, keys: Sequence[Column], order: Sequence[Column]) -> DataFrame:
    """First row of each key in the given order; NULL keys equal each other."""
    window = Window.partitionBy(*keys).orderBy(*order)
    ranked = df.withColumn("__rank", F.row_number().over(window))
    return ranked.where(F.col("__rank") == 1).drop("__rank")


def text_key(df: DataFrame, name: str) -> Column:
    """Dedup key cell of a raw row: a missing cell counts as empty text."""
    column = lookup(df, name)
    return F.lit("") if column is None else F.coalesce(column.cast("string"), F.lit(""))


def first_wins(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Earliest raw row per key, compared on the raw text before any cast or check."""
    return first_per_key(df, [text_key(df, name) for name in by], [named(name) for name in order])


def unseen_keys(df: DataFrame, history: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``history`` (read for its keys only)."""
    marks = [f"__key{i}" for i in range(len(by))]
    seen = history.select(*[text_key(history, n).alias(m) for n, m in zip(by, marks)]).distinct()
    marked = df.withColumns({m: text_key(df, n) for n, m in zip(by, marks)})
    return marked.join(seen, marks, "left_anti").drop(*marks)


def ranked_dedup(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Best row per key under an explicit ranking, such as newest file first."""
    return first_per_key(df, [named(name) for name in keys], order)


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    first_of: Sequence[str] = (),
    extra: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Last row per key in the given order.

    Columns in ``first_of`` come from the first row instead (the time a key was
    first inserted); ``extra`` adds further aggregates.
    """
    rank = F.struct(*[named(name) for name in order])
    kept = without(df.columns, [*keys, *first_of])
    aggregates = [F.max_by(row_struct(kept), rank).alias("__last")]
    if first_of:
        aggregates.append(F.min_by(row_struct(list(first_of)), rank).alias("__first"))
    for name, column in (extra or {}).items():
        aggregates.append(column.alias(name))
    grouped = df.groupBy(*[named(key) for key in keys]).agg(*aggregates)
    taken = {name: "__last" for name in kept} | {name: "__first" for name in first_of}
    key_names = {key.lower() for key in keys}
    return grouped.select(
        *[
            named(name) if name.lower() in key_names else named(name, taken[name]).alias(name)
            for name in df.columns
        ],
        *[named(name) for name in (extra or {})],
    )
