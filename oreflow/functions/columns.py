"""Small column helpers shared by all operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Audit column names every layer carries, and the file columns Raw adds.
AUDIT_COLUMNS = ("run_id", "environment", "latest_update_datetime", "latest_insert_datetime")
FILE_COLUMNS = (
    "arrival_date",
    "source_file_name",
    "source_file_path",
    "source_file_checksum",
    "source_row_number",
)
# Size and modification time of the source file, kept next to the columns above.
FILE_DETAIL_COLUMNS = ("source_file_size", "source_file_modified_ts")
RAW_AUDIT_COLUMNS = FILE_COLUMNS + FILE_DETAIL_COLUMNS + AUDIT_COLUMNS

# Raw rows arrive run by run, within a run by file path, within a file by row.
ARRIVAL_ORDER = ("latest_insert_datetime", "source_file_path", "source_row_number")


def named(name: str, frame: str | None = None) -> Column:
    """Column by its literal name, also when the name holds dots or spaces."""
    quoted = "`" + name.replace("`", "``") + "`"
    return F.col(f"{frame}.{quoted}" if frame else quoted)


def lookup(df: DataFrame, name: str) -> Column | None:
    """The column called ``name`` (ignoring case), or None when df lacks it."""
    for column in df.columns:
        if column.lower() == name.lower():
            return named(column)
    return None


def without(names: Iterable[str], excluded: Iterable[str]) -> list[str]:
    dropped = {name.lower() for name in excluded}
    return [name for name in names if name.lower() not in dropped]


def row_struct(names: Sequence[str], frame: str | None = None) -> Column:
    return F.struct(*[named(name, frame).alias(name) for name in names])
