"""Text to typed values.

Contract types are matched by prefix.  A cell either parses completely or its
value is NULL; ``parse_failed`` tells a NULL that was empty text from a NULL that
did not parse.  ``try_cast`` alone is strict for integers, decimals and
booleans; the patterns guard the types for which it is more generous (``1d`` as a
number, ``2024`` as a date).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Accepted text forms.
INTEGER_TEXT = r"^\s*[+-]?[0-9]+\s*$"
FLOAT_TEXT = r"^\s*[+-]?(([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf|infinity))\s*$"
NAN_TEXT = r"^\s*[+-]?(?i:nan)\s*$"
DATE_TEXT = r"^\s*[0-9]{4}-[0-9]{2}-[0-9]{2}\s*$"
TIMESTAMP_TEXT = (
    r"^\s*[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?"
    r"(Z|[+-][0-9]{2}:[0-9]{2})?)?\s*$"
)

# Precision of a DECIMAL written without one.
DEFAULT_DECIMAL = T.DecimalType(38, 18)


def contract_type(declared: str) -> T.DataType:
    """Spark type for a contract type string."""
    text = declared.strip().upper()
    if text.startswith("INT") or text.startswith(("BIGINT", "SMALLINT", "TINYINT", "LONG")):
        return T.LongType()
    if text.startswith(("REAL", "FLOAT", "DOUBLE")):
        return T.DoubleType()
    if text.startswith(("DECIMAL", "NUMERIC")):
        size = re.search(r"\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\)", text)
        return T.DecimalType(int(size[1]), int(size[2] or 0)) if size else DEFAULT_DECIMAL
    if text.startswith(("TIMESTAMP", "DATETIME")):
        return T.TimestampType()
    if text.startswith("DATE"):
        return T.DateType()
    if text.startswith("BOOL"):
        return T.BooleanType()
    return T.StringType()


def empty_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


GUARDS = {
    T.DoubleType: FLOAT_TEXT,
    T.DateType: DATE_TEXT,
    T.TimestampType: TIMESTAMP_TEXT,
}


def parse(text: Column, target: T.DataType) -> Column:
    """Typed value of a text cell, NULL when empty or not parseable."""
    if isinstance(target, T.StringType):
        return empty_to_null(text)
    guard = GUARDS.get(type(target))
    value = text.try_cast(target)
    return value if guard is None else F.when(text.rlike(guard), value)


def parse_failed(text: Column, target: T.DataType, value: Column | None = None) -> Column:
    """True when the cell holds text that is no value of the type (never NULL).

    ``value`` is the parsed cell, where the caller has it already.
    """
    if isinstance(target, T.StringType):
        return F.lit(False)
    value = parse(text, target) if value is None else value
    failed = value.isNull() & F.coalesce(text != F.lit(""), F.lit(False))
    if isinstance(target, T.DoubleType):
        # 'nan' is a number without a value: stored as NULL, not a failure.
        failed = failed & ~text.rlike(NAN_TEXT)
    return failed
