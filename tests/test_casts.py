import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.functions.casts import contract_type, parse, parse_failed

OVERFLOW = "1" * 20

# (type, text, value, failed)
CASES = [
    ("INTEGER", "12", 12, False),
    ("INTEGER", " 12 ", 12, False),
    ("INTEGER", "+7", 7, False),
    ("INTEGER", "-7", -7, False),
    ("INTEGER", "1.5", None, True),
    ("INTEGER", "1e3", None, True),
    ("INTEGER", "1_000", None, True),
    ("INTEGER", "12abc", None, True),
    ("INTEGER", "12L", None, True),
    ("INTEGER", "0x1F", None, True),
    ("INTEGER", "1,000", None, True),
    ("INTEGER", "", None, False),
    ("INTEGER", None, None, False),
    ("INTEGER", "   ", None, True),
    ("INTEGER", OVERFLOW, None, True),
    ("INT", "9223372036854775807", 2**63 - 1, False),
    ("BIGINT", "00123", 123, False),
    ("REAL", "1e3", 1000.0, False),
    ("REAL", ".5", 0.5, False),
    ("REAL", "5.", 5.0, False),
    ("REAL", "-2.5E-1", -0.25, False),
    ("REAL", "inf", math.inf, False),
    ("REAL", "-Infinity", -math.inf, False),
    ("REAL", "nan", None, False),
    ("REAL", "1d", None, True),
    ("REAL", "1f", None, True),
    ("REAL", "0x1p3", None, True),
    ("REAL", "1_0", None, True),
    ("FLOAT", " 2.5 ", 2.5, False),
    ("DOUBLE", "", None, False),
    ("DECIMAL(18,2)", "10.50", Decimal("10.50"), False),
    ("DECIMAL(18,2)", "12.345", Decimal("12.35"), False),
    ("DECIMAL(18,2)", "12345678901234567.89", None, True),
    ("DECIMAL(20,2)", "12345678901234567.89", Decimal("12345678901234567.89"), False),
    ("DECIMAL(18,2)", "abc", None, True),
    ("DECIMAL(18,2)", "nan", None, True),
    ("DECIMAL(18,2)", "1d", None, True),
    ("DECIMAL", "0.1", Decimal("0.1"), False),
    ("TEXT", "", None, False),
    ("TEXT", " a ", " a ", False),
    ("VARCHAR(10)", "00123", "00123", False),
    ("BOOLEAN", "Yes", True, False),
    ("BOOLEAN", "0", False, False),
    ("BOOLEAN", "maybe", None, True),
    ("DATE", "2024-02-29", "2024-02-29", False),
    ("DATE", "2024-02-30", None, True),
    ("DATE", "2024", None, True),
    ("DATE", "2024-1-5", None, True),
    ("TIMESTAMP", "2024-01-05T10:20:30.5Z", "2024-01-05 10:20:30.5", False),
    ("TIMESTAMP", "2024-01-05 10:20:30+02:00", "2024-01-05 08:20:30", False),
    ("TIMESTAMP", "10:20", None, True),
]


@pytest.fixture(scope="module")
def results(spark):
    """All cases of a type in one query."""
    found = {}
    for declared in {case[0] for case in CASES}:
        target = contract_type(declared)
        texts = [(case[1],) for case in CASES if case[0] == declared]
        value = parse(F.col("t"), target)
        if isinstance(target, (T.DateType, T.TimestampType)):
            value = value.cast("string")
        rows = spark.createDataFrame(texts, "t string").select(
            "t", value.alias("v"), parse_failed(F.col("t"), target).alias("f")
        )
        found.update({(declared, r["t"]): (r["v"], r["f"]) for r in rows.collect()})
    return found


@pytest.mark.parametrize("declared,text,value,failed", CASES)
def test_cast(results, declared, text, value, failed):
    assert results[(declared, text)] == (value, failed)


def test_types():
    assert contract_type("integer") == T.LongType()
    assert contract_type("Float64") == T.DoubleType()
    assert contract_type("decimal(12, 3)") == T.DecimalType(12, 3)
    assert contract_type("numeric(5)") == T.DecimalType(5, 0)
    assert contract_type("datetime") == T.TimestampType()
    assert contract_type("anything") == T.StringType()
