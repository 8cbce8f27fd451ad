"""Content hashes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from oreflow.functions.columns import named

# ASCII unit separator between cells, record separator for a NULL cell.
CELL_SEPARATOR = "\u001f"
NULL_CELL = "\u001e"


def record_hash(names: Sequence[str], row: Column | None = None) -> Column:
    """SHA-256 over the named columns, or fields of a struct; a NULL differs from empty text."""
    values = [named(name) if row is None else row[name] for name in names]
    cells = [F.coalesce(value.cast("string"), F.lit(NULL_CELL)) for value in values]
    return F.sha2(F.concat_ws(CELL_SEPARATOR, *cells), 256)
