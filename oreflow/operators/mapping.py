"""Raw text rows -> typed contract rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.contracts import ColumnSpec
from oreflow.functions.casts import empty_to_null, parse, parse_failed
from oreflow.functions.columns import lookup, named


def source_text(df: DataFrame, spec: ColumnSpec) -> Column:
    """Text a contract column is read from; NULL text when df lacks the column."""
    column = lookup(df, spec.source)
    return F.lit(None).cast("string") if column is None else column.cast("string")


def with_default(text: Column, spec: ColumnSpec) -> Column:
    """Empty cells take the declared default before any check."""
    if spec.default is None:
        return text
    value = str(spec.default).lower() if isinstance(spec.default, bool) else str(spec.default)
    return F.coalesce(empty_to_null(text), F.lit(value))


def mapped_value(df: DataFrame, spec: ColumnSpec) -> Column:
    return parse(with_default(source_text(df, spec), spec), spec.data_type)


def cast_failures(df: DataFrame, specs: Sequence[ColumnSpec]) -> list[tuple[str, Column]]:
    """(column name, predicate) for every column whose cast can fail."""
    return [
        (spec.name, parse_failed(with_default(source_text(df, spec), spec), spec.data_type))
        for spec in specs
    ]


def map_columns(df: DataFrame, specs: Sequence[ColumnSpec], all_or_nothing: bool = True) -> DataFrame:
    """Select, rename and cast the contract columns.

    With ``all_or_nothing`` one cell that does not parse makes every column of
    its row NULL.
    """
    values = [mapped_value(df, spec) for spec in specs]
    if all_or_nothing:
        failed = F.lit(False)
        for _, predicate in cast_failures(df, specs):
            failed = failed | predicate
        values = [F.when(~failed, value) for value in values]
    return df.select(*[value.alias(spec.name) for value, spec in zip(values, specs)])


def trim_text(df: DataFrame, excluded: Sequence[str] = ()) -> DataFrame:
    """Trim blanks around every text column."""
    kept = {name.lower() for name in excluded}
    return df.select(
        *[
            F.trim(named(field.name)).alias(field.name)
            if field.dataType.typeName() == "string" and field.name.lower() not in kept
            else named(field.name)
            for field in df.schema.fields
        ]
    )


def instant(moment: datetime) -> Column:
    """A timestamp literal; times without a zone are taken as UTC."""
    moment = moment if moment.tzinfo else moment.replace(tzinfo=timezone.utc)
    text = moment.astimezone(timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(text + "Z").cast("timestamp")


def stamp(df: DataFrame, run_id: str, environment: str, moment: datetime) -> DataFrame:
    """Audit columns: one run, one time (a first insert is also the last update)."""
    return df.withColumns(
        {
            "run_id": F.lit(run_id),
            "environment": F.lit(environment),
            "latest_update_datetime": instant(moment),
            "latest_insert_datetime": instant(moment),
        }
    )
