"""Data quality rules: each name stands for one predicate that is true for a bad row."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from oreflow.functions.casts import INTEGER_TEXT


@dataclass(frozen=True)
class Cell:
    """One mapped column as a rule sees it: the text before and the value after the cast."""

    text: Column
    value: Column
    numeric: bool = False


def _missing(cell: Cell) -> Column:
    return cell.value.isNull()


def _not_integer(cell: Cell) -> Column:
    held = F.coalesce(cell.text != F.lit(""), F.lit(False))
    return held & ~cell.text.rlike(INTEGER_TEXT)


def _negative(cell: Cell) -> Column:
    number = cell.value if cell.numeric else cell.value.cast("string").try_cast("double")
    return F.coalesce(number < 0, F.lit(False))


# Rule names as contracts write them.
RULES: dict[str, Callable[[Cell], Column]] = {
    "col_is_not_null": _missing,
    "not_null": _missing,
    "is_integer": _not_integer,
    "non_negative": _negative,
}


def violates(rule: str, cell: Cell) -> Column:
    try:
        return RULES[rule.lower()](cell)
    except KeyError:
        raise ValueError(f"unknown data quality rule {rule!r}; known: {sorted(RULES)}") from None
