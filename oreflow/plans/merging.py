"""Merging rows into a keyed table of the lake, partition by partition."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.functions.columns import lookup
from oreflow.plans.lake import PARTITION, Commit, Lake, partition_of


class Target:
    """A keyed table as it is now, less the partitions that ``incoming`` does not touch.

    Rows lie in hash partitions of their key.  Where the table has them already, in
    the same number and with the same columns, only those in which a key of
    ``incoming`` falls are read and written; a table of another make is read and
    written whole, once.  The partition numbers, at most ``partitions``, are all
    that reaches the driver.
    """

    def __init__(
        self,
        lake: Lake,
        table: str,
        held: Sequence[Commit],
        schema: T.StructType,
        keys: Sequence[str],
        partitions: int,
        incoming: DataFrame,
    ):
        self.lake, self.table, self.keys, self.partitions = lake, table, tuple(keys), partitions
        self.basis = {("persistent", table): frozenset(commit.path for commit in held)}
        self.base = self._base(held, schema)
        self.touched: set[int] = set()
        if self.base is not None:
            number = partition_of(keys, partitions).alias(PARTITION)
            self.touched = {row[0] for row in incoming.select(number).distinct().collect()}
            rows = lake.read_partitions(self.base, self.touched)
        else:
            rows = lake.read_commits(held)
        self.state = lake.spark.createDataFrame([], schema) if rows is None else align(rows, schema)

    def _base(self, held: Sequence[Commit], schema: T.StructType) -> Commit | None:
        if len(held) != 1 or held[0].partitions != self.partitions or held[0].keys != self.keys:
            return None
        columns = [(f.name, f.dataType) for f in held[0].schema.fields]
        return held[0] if columns == [(f.name, f.dataType) for f in schema.fields] else None

    def write(self, run_id: str, merged: DataFrame, consumed: Sequence[str]) -> Commit:
        """The new rows of the touched partitions, and the others where they were."""
        return self.lake.write_partitions(
            "persistent",
            self.table,
            run_id,
            merged,
            self.keys,
            self.partitions,
            consumed,
            self.base,
            self.touched,
        )


def merge_into(
    lake: Lake,
    table: str,
    run_id: str,
    incoming: DataFrame,
    keys: Sequence[str],
    partitions: int,
    merged: Callable[[DataFrame, DataFrame], DataFrame],
    consumed: Sequence[str] = (),
) -> Commit:
    """Merge ``incoming`` by ``merged(state, incoming)`` and commit; refused if the table changed meanwhile."""
    held = lake.visible("persistent", table)
    target = Target(lake, table, held, incoming.schema, keys, partitions, incoming)
    commit = target.write(run_id, merged(target.state, incoming), consumed)
    lake.record([commit], target.basis)
    return commit


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """A table's rows in the contract's current columns and types."""
    columns = []
    for item in schema.fields:
        column = lookup(df, item.name)
        column = F.lit(None) if column is None else column
        columns.append(column.cast(item.dataType).alias(item.name))
    return df.select(*columns)
