"""Session settings the engine relies on, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that change results or plans.  Sizes (executors, memory, shuffle
# partitions) stay with whoever submits the job.
ENGINE_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # any encoding that a contract names, not only those of Spark's short list
    "spark.sql.legacy.javaCharsets": "true",
    # a byte that is no text becomes a replacement mark, in files of any size
    "spark.sql.legacy.codingErrorAction": "true",
}

SCRATCH = "oreflow"


def build_session(app_name: str, master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**ENGINE_SETTINGS, "spark.ui.enabled": "false", **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A new folder that every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``.  Only a local session may
    fall back to a folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="oreflow-")
    return f"{base.rstrip('/')}/{SCRATCH}/{label}-{uuid.uuid4().hex}"


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder this engine wrote, on whatever file system it is."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
