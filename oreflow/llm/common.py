"""What the operators of this subpackage share: staged tables, task-side files, batches."""

from __future__ import annotations

import atexit
from collections.abc import Iterator
from contextlib import suppress

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from oreflow.session import drop_folder, scratch_folder

#: Texts go to Python in batches of so many rows, so that a worker holds few of them at once.
BATCH_SETTINGS = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "512",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}

#: Whether shuffle files are deleted when the query that wrote them ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def prepare(spark: SparkSession) -> None:
    for key, value in BATCH_SETTINGS.items():
        spark.conf.set(key, value)


def new_folder(spark: SparkSession, label: str) -> str:
    """A folder in the cluster's shared scratch that goes when the session's process ends."""
    folder = scratch_folder(spark, label)

    def drop() -> None:
        with suppress(Exception):  # the session may have ended before
            drop_folder(spark, folder)

    atexit.register(drop)
    return folder


def staged(df: DataFrame, label: str) -> DataFrame:
    """The rows of df, written to the shared scratch and read again: lineage ends here.

    Shuffle files of the write go with it, so that a chain of stages holds those of one at a time.
    """
    spark, folder = df.sparkSession, new_folder(df.sparkSession, label)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(folder)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(folder)


def with_fields(df: DataFrame, ddl: str) -> StructType:
    """The schema of df and the fields behind it."""
    return StructType([*df.schema.fields, *StructType.fromDDL(ddl).fields])


def slices(batch: pa.RecordBatch, column: str, chars: int) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of runs of rows of about ``chars`` characters; null is empty."""
    first, run, size = 0, [], 0
    for at, text in enumerate(batch.column(column).to_pylist()):
        text = text or ""
        if run and size + len(text) > chars:
            yield first, run
            first, run, size = at, [], 0
        run.append(text)
        size += len(text)
    if run:
        yield first, run


def bucket_of(key: Column, buckets: int) -> Column:
    """crc32 of the key as text, modulo: a split that any engine can repeat."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % buckets
