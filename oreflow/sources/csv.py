"""CSV files bound by header name, with row numbers per file.

Spark applies one schema by position to all files of a read, so files are read
in groups of equal header and united by name.  A file without any quote cannot
hold a line break inside a cell and is read line by line, in splits; other files
are parsed as a whole, unless the contract declares ``multi_line: false``.

Row numbers need the count of records before each split.  They are counted on
the *written* landing rows: ``scan`` marks every record with its split and a
running id, and ``number_rows`` turns those into 1-based numbers.  That costs one
narrow columnar pass and no sort, and no file (however large) meets in one task.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.contracts import LandingSpec
from oreflow.functions.columns import RAW_AUDIT_COLUMNS, named

MALFORMED = "__malformed"
REJECT = "__reject"
URI = "__uri"
BLOCK = "__block"
RECORD = "__record"
FILE = "__file"
FILE_FACTS = ("name", "path", "checksum", "size", "modified")
SCAN_COLUMNS = (MALFORMED, REJECT, URI, BLOCK, RECORD)

# Above this many file splits the split table is joined by a shuffle instead of
# being copied to all executors (about 300 bytes each: 60 MB).
COPIED_SPLITS = 200_000


def header_names(header: str, delimiter: str = ",") -> list[str]:
    """Column names of a header line."""
    text = header.lstrip("﻿").rstrip("\r\n")
    return next(csv.reader(io.StringIO(text), delimiter=delimiter), [])


def field_names(names: Sequence[str]) -> list[str]:
    """Positional field names; of repeated names (ignoring case) the last keeps the name."""
    last = {name.lower(): position for position, name in enumerate(names)}
    return [
        name if name and last[name.lower()] == position else f"__unnamed_{position}"
        for position, name in enumerate(names)
    ]


def header_problem(
    names: Sequence[str], spec: LandingSpec, known: Sequence[str] = ()
) -> str | None:
    """Why a file's header breaks the landing contract."""
    held = {name.lower() for name in names}
    if spec.exact_column_count and len(names) != spec.exact_column_count:
        return "column_count"
    if any(name.lower() not in held for name in spec.required_columns):
        return "required_column_missing"
    allowed = {name.lower() for name in known}
    if spec.reject_unknown_columns and allowed and held - allowed:
        return "unknown_column"
    return None


def read_group(
    spark: SparkSession, paths: Sequence[str], names: Sequence[str], spec: LandingSpec, whole_files: bool
) -> DataFrame:
    """Files of one header as text columns plus the scan marks."""
    fields = field_names(names)
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*fields, MALFORMED]])
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", spec.delimiter)
        .option("encoding", spec.encoding)
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", "")
        .option("multiLine", whole_files)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", MALFORMED)
        .csv(list(paths))
    )
    # Audit columns are the engine's own: a source column of that name gives way.
    reserved = {name.lower() for name in RAW_AUDIT_COLUMNS}
    kept = [n for n in fields if not n.startswith("__unnamed_") and n.lower() not in reserved]
    complete = named(MALFORMED).isNull()
    return rows.select(
        # Spark reads an empty cell as NULL; only a cell a short record lacks is one.
        *[
            F.when(complete, F.coalesce(named(n), F.lit(""))).otherwise(named(n)).alias(n)
            for n in kept
        ],
        named(MALFORMED).alias(MALFORMED),
        F.col("_metadata.file_path").alias(URI),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(RECORD),
    )


def scan(
    spark: SparkSession, files: DataFrame, spec: LandingSpec, known: Sequence[str] = ()
) -> DataFrame | None:
    """All records of the files, united by column name; None without files.

    Only paths and header lines pass through the driver: the reader is
    configured with them.  The result is to be written once before it is used.
    """
    if spec.multi_line is None:
        whole = ~F.col("splittable")
    else:
        whole = F.lit(bool(spec.multi_line))
    groups = (
        files.withColumn("whole", whole)
        .groupBy("header", "whole")
        .agg(F.sort_array(F.collect_list("path")).alias("paths"))
        .orderBy("header", "whole")
        .collect()
    )
    parts = []
    for group in groups:
        names = header_names(group["header"], spec.delimiter)
        if not names:
            continue
        problem = header_problem(names, spec, known)
        part = read_group(spark, group["paths"], names, spec, group["whole"])
        parts.append(part.withColumn(REJECT, _reject_reason(problem, spec, len(names))))
    if not parts:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _reject_reason(problem: str | None, spec: LandingSpec, cells: int) -> Column:
    """Without record checks a short record is filled up; one with surplus cells would lose them."""
    if problem:
        return F.lit(problem)
    if spec.checks_records:
        return F.when(named(MALFORMED).isNotNull(), F.lit("malformed_record"))
    plain = F.regexp_replace(named(MALFORMED), '"(?:[^"]++|"")*+"', "")
    held = F.size(F.split(plain, re.escape(spec.delimiter)))
    return F.when(named(MALFORMED).isNotNull() & (held > cells), F.lit("surplus_cells"))


def split_table(landed: DataFrame) -> DataFrame:
    """Per file split: its first running id and the records of the file before it."""
    splits = landed.groupBy(URI, BLOCK).agg(
        F.min(RECORD).alias("__first"), F.count(F.lit(1)).alias("__count")
    )
    before = Window.partitionBy(URI).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    return splits.withColumn("__before", F.coalesce(F.sum("__count").over(before), F.lit(0)))


def number_rows(landed: DataFrame, files: DataFrame, folder: str) -> DataFrame:
    """Add ``source_row_number`` and the file's facts to written landing rows.

    ``landed`` must be read back from a written table, so that the running ids
    seen by the count and by the join are the same.  The split table goes to
    ``folder``; it is copied to the executors only up to a checked size.
    """
    facts = files.select(F.col("uri").alias(URI), F.struct(*FILE_FACTS).alias(FILE))
    table = split_table(landed).drop("__count").join(facts, URI)
    table.write.parquet(folder)
    splits = landed.sparkSession.read.schema(table.schema).parquet(folder)
    if splits.count() <= COPIED_SPLITS:
        splits = F.broadcast(splits)
    position = F.col("__before") + (F.col(RECORD) - F.col("__first")) + 1
    numbered = landed.join(splits, [URI, BLOCK])
    return numbered.withColumn("source_row_number", position).drop("__before", "__first")
