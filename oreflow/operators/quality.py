"""Contract checks and the split into valid and rejected rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.contracts import Check, ColumnSpec, TableSpec
from oreflow.functions.casts import empty_to_null, parse, parse_failed
from oreflow.functions.columns import named, row_struct, without
from oreflow.functions.rules import Cell, violates
from oreflow.operators.mapping import source_text, with_default

# What a quarantined row says happened to it.
CAST_FAILED = "cast_failed"
CHECK_FAILED = "data_quality_failed"

REJECTED = "__rejected"
REASON = "reject_reason"
REASONS = "reject_reasons"
RECORD = "source_record"

LABEL_SEPARATOR = "\u001f"


def reason_text(pairs: Sequence[tuple[str, Column]]) -> Column:
    """Labels of the predicates that hold, joined; empty text when none does.

    Plain text instead of a filtered array, because higher-order functions
    would take the row out of generated code.
    """
    if not pairs:
        return F.lit("")
    return F.concat_ws(LABEL_SEPARATOR, *[F.when(p, F.lit(label)) for label, p in pairs])


def reason_list(text: Column) -> Column:
    return F.when(text == F.lit(""), F.array().cast("array<string>")).otherwise(
        F.split(text, LABEL_SEPARATOR)
    )


def _label(rule: str, column: str) -> str:
    rule = "not_null" if rule == "col_is_not_null" else rule
    return f"{rule}({column})"


def _rules(spec: TableSpec) -> list[tuple[str, str]]:
    """(rule, column) pairs of a contract, each once: declared NOT NULL first."""
    pairs = [("not_null", name) for name in spec.required()]
    pairs += [(check.rule, name) for check in spec.checks for name in check.columns]
    once: dict[str, tuple[str, str]] = {}
    for rule, name in pairs:
        once.setdefault(_label(rule, name), (rule, name))
    return list(once.values())


def text_reasons(df: DataFrame, checks: Sequence[Check]) -> Column:
    """Rules on rows that are still text (Raw level), as joined labels."""
    pairs = []
    for check in checks:
        for name in check.columns:
            text = source_text(df, ColumnSpec(name=name, source=name))
            cell = Cell(text, empty_to_null(text))
            pairs.append((_label(check.rule, name), violates(check.rule, cell)))
    return reason_text(pairs)


def check_rows(df: DataFrame, spec: TableSpec, carried: Sequence[str] = ()) -> DataFrame:
    """One row per raw row: mapped columns, ``carried`` columns, verdict and reasons.

    ``source_record`` holds the complete raw row, for rejected rows only.  A row
    with a failed cast has NULL in every mapped column.  ``carried`` columns are
    the caller's own and not part of the raw row.
    """
    raw_row = row_struct(without(df.columns, carried))
    texts = {c.name: with_default(source_text(df, c), c) for c in spec.columns}
    # Every cell is parsed once, in a projection of its own; all that follows
    # works on the parsed values.
    parsed = {c.name: f"__value_{i}" for i, c in enumerate(spec.columns)}
    rows = df.withColumns({parsed[c.name]: parse(texts[c.name], c.data_type) for c in spec.columns})

    failures, pairs = [], []
    for c in spec.columns:
        if not isinstance(c.data_type, T.StringType):
            failed = parse_failed(texts[c.name], c.data_type, F.col(parsed[c.name]))
            failures.append(failed)
            pairs.append((f"{CAST_FAILED}({c.name})", failed))
    types = {c.name: c.data_type for c in spec.columns}
    violations = []
    for rule, name in _rules(spec):
        numeric = isinstance(types[name], T.NumericType)
        violated = violates(rule, Cell(texts[name], F.col(parsed[name]), numeric))
        violations.append(violated)
        pairs.append((_label(rule, name), violated))
    uncast = _any(failures)
    rows = rows.withColumns(
        {"__uncast": uncast, REJECTED: uncast | _any(violations), "__labels": reason_text(pairs)}
    )
    own = {c.name.lower() for c in spec.columns}
    reason = F.when(F.col("__uncast"), F.lit(CAST_FAILED)).otherwise(F.lit(CHECK_FAILED))
    return rows.select(
        *[F.when(~F.col("__uncast"), F.col(parsed[c.name])).alias(c.name) for c in spec.columns],
        *[named(name) for name in carried if name.lower() not in own],
        F.col(REJECTED),
        F.when(F.col(REJECTED), reason).alias(REASON),
        reason_list(F.col("__labels")).alias(REASONS),
        F.when(F.col(REJECTED), raw_row).alias(RECORD),
    )


def _any(predicates: Sequence[Column]) -> Column:
    result = F.lit(False)
    for predicate in predicates:
        result = result | predicate
    return result


def split(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with their reasons and source record)."""
    rejected = checked.where(F.col(REJECTED)).drop(REJECTED)
    valid = checked.where(~F.col(REJECTED)).drop(REJECTED, REASON, REASONS, RECORD)
    return valid, rejected
