"""New files as a stream: each run takes only what arrived since the last one."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from oreflow.contracts import DEFAULT_PARTITIONS
from oreflow.operators.merge import INSERTED_AT, upsert
from oreflow.plans.lake import Lake
from oreflow.plans.merging import merge_into


def csv_stream(
    spark: SparkSession,
    folder: str,
    names: Sequence[str],
    pattern: str = "*.csv",
    delimiter: str = ",",
    multi_line: bool = True,
    files_per_batch: int | None = None,
) -> DataFrame:
    """CSV files of one header as a stream of text columns plus their file path."""
    schema = T.StructType([T.StructField(name, T.StringType()) for name in names])
    reader = (
        spark.readStream.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)  # another header order must fail, not swap values
        .option("sep", delimiter)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("multiLine", multi_line)
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
    )
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.csv(folder).withColumn("source_file_path", F.col("_metadata.file_path"))


def upsert_stream(
    stream: DataFrame,
    lake: Lake,
    table: str,
    keys: Sequence[str],
    order: Sequence[str],
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    kept: Sequence[str] = (INSERTED_AT,),
    partitions: int = DEFAULT_PARTITIONS,
) -> StreamingQuery:
    """Merge everything available into a Persistent table, then stop.

    Within a batch the last row per key in ``order`` wins, and a later batch
    wins over an earlier one: the stream takes files oldest first, all that are
    there in one batch unless the source limits it.

    The checkpoint remembers the files taken.  A batch that is replayed after a
    failure finds its own id among the committed ones and is skipped, so every
    batch is merged exactly once.  A batch reads and writes the partitions its keys
    fall in, and fails if a run changed the table while it did.
    """

    def merge(batch: DataFrame, number: int) -> None:
        stream_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        batch_id = f"{stream_id}-{number}"
        if batch_id in lake.consumed_runs("persistent", table):
            return
        incoming = prepare(batch) if prepare else batch
        merge_into(
            lake,
            table,
            batch_id,
            incoming,
            keys,
            partitions,
            lambda state, rows: upsert(state, rows, keys, order, kept),
            [batch_id],
        )

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
