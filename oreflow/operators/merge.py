"""Merges: (current table, incoming rows) -> new full state.

Incoming rows are reduced to one per key before the join, and the table holds
one row per key, so the join is one to one and no key can grow hot in it.
Sides are told apart by a presence flag, never by NULL values: a NULL in a
newer row overwrites.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.functions.columns import named
from oreflow.functions.hashing import record_hash
from oreflow.operators.dedup import latest_per_key

INSERTED_AT = "latest_insert_datetime"

KEY_PARTS = 16

CONFLICT = "__conflict"


def key_part() -> Column:
    """Part of the input a row lies in, to reduce a key per part and not to one row.

    Copies of a hot key are then merged before the shuffle, yet the join that
    follows shuffles both of its sides itself.  Adaptive execution splits a hot
    key only then; behind a full aggregation of the keys it would not.
    """
    return F.spark_partition_id() % KEY_PARTS


def _choose(
    target: DataFrame, incoming: DataFrame, keys: Sequence[str], take_incoming: Column, kept: Sequence[str]
) -> DataFrame:
    """Full outer join on the keys, one side per row; ``kept`` columns stay the target's."""
    current = target.withColumn("__held", F.lit(True)).alias("t")
    arriving = incoming.withColumn("__new", F.lit(True)).alias("s")
    matched = F.lit(True)
    for key in keys:
        matched = matched & (named(key, "t") == named(key, "s"))
    joined = current.join(arriving, matched, "full_outer")
    columns = []
    for name in target.columns:
        old, new = named(name, "t"), named(name, "s")
        if name in keys:
            column = F.coalesce(old, new)
        elif name in kept:
            column = F.when(F.col("t.__held"), old).otherwise(new)
        else:
            column = F.when(take_incoming, new).otherwise(old)
        columns.append(column.alias(name))
    return joined.select(*columns)


def upsert(
    target: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    kept: Sequence[str] = (INSERTED_AT,),
) -> DataFrame:
    """Insert new keys, overwrite known ones; the last incoming row per key wins.

    ``kept`` columns (the first insert time) survive updates.
    """
    kept = [name for name in kept if name in target.columns]
    latest = latest_per_key(incoming, keys, order, first_of=kept)
    return _choose(target, latest.select(target.columns), keys, F.col("s.__new"), kept)


def scd1_merge(
    target: DataFrame,
    incoming: DataFrame,
    keys: Sequence[str],
    version: str,
    tie_order: Sequence[str] = (),
    kept: Sequence[str] = (INSERTED_AT,),
) -> DataFrame:
    """Insert new keys; update a known key only by a strictly higher version.

    Among incoming rows of one version the last in ``tie_order`` counts.
    """
    kept = [name for name in kept if name in target.columns]
    latest = latest_per_key(incoming, keys, [version, *tie_order])
    newer = F.col("s.__new") & (
        F.col("t.__held").isNull() | (named(version, "s") > named(version, "t"))
    )
    return _choose(target, latest.select(target.columns), keys, newer, kept)


def append(target: DataFrame, incoming: DataFrame) -> DataFrame:
    """Keyless tables only grow."""
    return target.unionByName(incoming, allowMissingColumns=True)


def mark_conflicts(
    incoming: DataFrame,
    keys: Sequence[str],
    version: str,
    compared: Sequence[str],
    current: DataFrame | None = None,
    written: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """``incoming`` with a mark on the rows whose version exists with other content too.

    Each (keys, version) is reduced to its lowest and highest record hash; a row is
    in conflict when one of them is not its own.  One join gives every row its
    mark.  ``written`` writes the reduced table and reads it again: then both
    sides of the join are shuffled for it, and adaptive execution splits a hot key.
    """
    by = [*keys, version]
    hashed = incoming.withColumn("__hash", record_hash(compared))
    seen = hashed.select(*[named(n) for n in by], "__hash")
    if current is not None:
        held = current.select(*[named(n) for n in by], record_hash(compared).alias("__hash"))
        seen = seen.unionByName(held)
    ends = seen.groupBy(*[named(n) for n in by]).agg(
        F.min("__hash").alias("__low"), F.max("__hash").alias("__high")
    )
    # As many rows as there are keys: never one to copy to every executor.
    rows, ends = hashed.alias("r"), written(ends).hint("merge").alias("e")
    same = F.lit(True)
    for name in by:
        same = same & (named(name, "r") == named(name, "e"))
    clash = (F.col("e.__low") != F.col("r.__hash")) | (F.col("e.__high") != F.col("r.__hash"))
    marked = rows.join(ends, same, "left").withColumn(CONFLICT, F.coalesce(clash, F.lit(False)))
    return marked.select(*[named(n, "r") for n in incoming.columns], CONFLICT)


def absent_keys(incoming: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Incoming rows whose key is not in ``existing`` yet (read for its keys only)."""
    held = existing.select(*[named(key) for key in keys], key_part().alias("__part")).distinct()
    return incoming.join(held.drop("__part"), list(keys), "left_anti")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; empty for a sound keyed table."""
    return df.groupBy(*[named(key) for key in keys]).count().where(F.col("count") > 1)
