"""Control tables: append-only events; the current state is a query over them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone
from typing import Any

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The control tables and their columns.
SCHEMAS = {
    "runs": "run_id string, environment string, started_at timestamp, ended_at timestamp, "
    "status string, error string, recorded_at timestamp",
    "processors": "run_id string, processor string, status string, started_at timestamp, "
    "ended_at timestamp, error string",
    "row_counts": "run_id string, processor string, layer string, table_name string, "
    "inserted long, rejected long",
    "watermarks": "source_table string, value string, set_at timestamp",
}

ARROW_TYPES = {
    "string": pa.string(),
    "long": pa.int64(),
    "timestamp": pa.timestamp("us", tz="UTC"),
}


def utc_now() -> datetime:
    return datetime.now(timezone.utc)


def current_runs(events: DataFrame, recorded_at: str = "recorded_at") -> DataFrame:
    """Latest state of every run."""
    rest = [c for c in events.columns if c != "run_id"]
    last = events.groupBy("run_id").agg(F.max_by(F.struct(*rest), F.col(recorded_at)).alias("e"))
    return last.select("run_id", "e.*")


def last_success(runs: DataFrame) -> DataFrame:
    """End of the latest successful run, one row."""
    done = runs.where((F.col("status") == "SUCCEEDED") & F.col("ended_at").isNotNull())
    return done.agg(F.max("ended_at").alias("ended_at"))


def processor_durations(events: DataFrame) -> DataFrame:
    """Seconds per finished processor of a run."""
    done = events.where(F.col("ended_at").isNotNull())
    seconds = F.col("ended_at").cast("double") - F.col("started_at").cast("double")
    return done.select("run_id", "processor", "status", seconds.alias("seconds"))


def row_counts(df: DataFrame, table: str, rejected: str) -> DataFrame:
    """Inserted and rejected rows per table, in one pass with map-side counts."""
    bad = F.col(rejected)
    return df.groupBy(F.col(table).alias("table_name")).agg(
        F.count_if(~bad).alias("inserted"), F.count_if(bad).alias("rejected")
    )


class ControlTables:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str) -> DataFrame:
        try:
            return self.spark.read.schema(SCHEMAS[name]).parquet(self._path(name))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], SCHEMAS[name])

    def append(self, name: str, rows: Sequence[dict[str, Any]] | DataFrame) -> None:
        if not isinstance(rows, DataFrame):
            columns = [part.split() for part in SCHEMAS[name].split(", ")]
            schema = pa.schema([(column, ARROW_TYPES[kind]) for column, kind in columns])
            # An Arrow table becomes a local relation: one small write task.
            rows = self.spark.createDataFrame(pa.Table.from_pylist(list(rows), schema))
        rows.write.mode("append").parquet(self._path(name))

    # Runs and processors

    def run(
        self,
        run_id: str,
        environment: str,
        status: str,
        started_at: datetime,
        ended_at: datetime | None = None,
        error: str | None = None,
    ) -> None:
        self.append(
            "runs",
            [
                {
                    "run_id": run_id,
                    "environment": environment,
                    "started_at": started_at,
                    "ended_at": ended_at,
                    "status": status,
                    "error": error,
                    "recorded_at": utc_now(),
                }
            ],
        )

    def runs(self) -> DataFrame:
        return current_runs(self.read("runs"))

    def previous_success(self) -> datetime | None:
        return last_success(self.runs()).first()["ended_at"]

    def processor(
        self,
        run_id: str,
        name: str,
        status: str,
        started_at: datetime,
        ended_at: datetime | None = None,
        error: str | None = None,
    ) -> None:
        self.append(
            "processors",
            [
                {
                    "run_id": run_id,
                    "processor": name,
                    "status": status,
                    "started_at": started_at,
                    "ended_at": ended_at,
                    "error": error,
                }
            ],
        )

    def rows(
        self, run_id: str, processor: str, layer: str, table: str, inserted: int, rejected: int = 0
    ) -> None:
        self.append(
            "row_counts",
            [
                {
                    "run_id": run_id,
                    "processor": processor,
                    "layer": layer,
                    "table_name": table,
                    "inserted": inserted,
                    "rejected": rejected,
                }
            ],
        )

    # Watermarks

    def watermark(self, source_table: str) -> str | None:
        marks = self.read("watermarks").where(F.col("source_table") == source_table)
        return marks.agg(F.max_by("value", "set_at").alias("value")).first()["value"]

    def set_watermark(self, source_table: str, value: str) -> None:
        self.append(
            "watermarks", [{"source_table": source_table, "value": value, "set_at": utc_now()}]
        )
