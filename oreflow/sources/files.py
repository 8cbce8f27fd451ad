"""Finding landed files, hashing them, and skipping content already loaded."""

from __future__ import annotations

import hashlib
import os
import re
import sys
from collections.abc import Iterator, Sequence
from urllib.parse import urlparse

import pandas as pd
from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Send this module's functions along with the task: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Up to this size a file is hashed inside the JVM in one piece (one row of the
# binary file source); larger files are read in chunks by a Python task.
WHOLE_FILE_BYTES = 128 * 1024 * 1024
CHUNK_BYTES = 8 * 1024 * 1024

# A file that holds none of these has one record on every line that is not blank:
# no cell can hold a line break, and no line consists of blanks only.
WHOLE_FILE_MARKS = ('"', "\n ", "\n\t", "\r ", "\r\t")

# The first record that is not blank: line ends inside quotes belong to it.
HEADER = (
    r"^(?:\uFEFF?[ \t]*(?:\r\n|\r|\n))*+"
    r"((?:\"(?:[^\"]++|\"\")*+\"|[^\"\r\n]++)*+)"
)

# What a file is known by where equal files may belong to several tables.
PER_TABLE = ("checksum", "source_table")

SCHEME = "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?"

FILES_SCHEMA = (
    "path string, uri string, name string, size long, modified timestamp, "
    "checksum string, header string, splittable boolean"
)


def list_files(spark: SparkSession, folder: str, pattern: str) -> DataFrame | None:
    """Files directly in the folder whose name matches; None when the folder is missing."""
    try:
        listed = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", pattern)
            .option("recursiveFileLookup", "true")  # else a `k=v` folder reads as a partition
            .load(folder)
        )
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    if not re.search(r"[*?\[{]", folder):
        plain = re.sub(SCHEME, "", folder).rstrip("/")
        plain = plain if plain.startswith("/") else os.path.abspath(plain)
        parent = F.regexp_replace(F.regexp_replace("path", SCHEME, ""), "/[^/]*$", "")
        listed = listed.where(parent == F.lit(plain))
    return _facts(listed)


def read_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The same columns for files of known paths."""
    return _facts(spark.read.format("binaryFile").load(list(paths)))


def _facts(listed: DataFrame) -> DataFrame:
    return listed.select(
        "path",
        F.col("_metadata.file_path").alias("uri"),
        F.substring_index("path", "/", -1).alias("name"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
        "content",
    )


def unread(listed: DataFrame, manifest: DataFrame) -> DataFrame:
    """Listed files that were not read before: new by path, size or time for their table.

    Only the listing is needed.  A file that was read is either loaded or a copy of
    what is loaded, so it need not be opened again.
    """
    known = ["path", "source_table", "size", "modified"]
    return listed.join(manifest.select(*known).distinct(), known, "left_anti")


def content_checksum(content: Column) -> Column:
    """SHA-256 of the bytes, as lower-case hex."""
    return F.sha2(content, 256)


def fingerprint(
    files: DataFrame, whole_file_bytes: int = WHOLE_FILE_BYTES, encoding: str = "UTF-8"
) -> DataFrame:
    """Add checksum, header line and whether lines can be read on their own; drop the content."""
    text = F.col("content").cast("string")
    held = F.lit(False)
    for mark in WHOLE_FILE_MARKS:
        held = held | text.contains(mark)
    header = text if encoding == "UTF-8" else F.decode("content", encoding)
    small = files.where(F.col("size") <= whole_file_bytes).select(
        "path",
        "uri",
        "name",
        "size",
        "modified",
        content_checksum(F.col("content")).alias("checksum"),
        F.regexp_extract(header, HEADER, 1).alias("header"),
        (~held).alias("splittable"),
    )
    large = files.where(F.col("size") > whole_file_bytes).drop("content")
    count = large.count()  # listing only: the content column is pruned
    if count == 0:
        return small

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [_read_through(path, encoding) for path in batch["path"]]
            columns = pd.DataFrame(
                found, columns=["checksum", "header", "splittable"], index=batch.index
            )
            yield pd.concat([batch, columns], axis=1)

    streamed = large.repartition(count, "path").mapInPandas(stream, FILES_SCHEMA)
    return small.unionByName(streamed)


def _read_through(path: str, encoding: str) -> tuple[str, str, bool]:
    """Checksum, header and split flag of one file of any size; the header is in its first chunk."""
    digest = hashlib.sha256()
    marks = [mark.encode() for mark in WHOLE_FILE_MARKS]
    head, splittable, last = b"", True, b""
    with _open(path) as stream:
        while chunk := stream.read(CHUNK_BYTES):
            digest.update(chunk)
            seen = last + chunk  # a mark may straddle two chunks
            splittable = splittable and not any(mark in seen for mark in marks)
            last = chunk[-1:]
            head = head or chunk
    header = re.match(HEADER, head.decode(encoding, "replace"))
    return digest.hexdigest(), header.group(1), splittable


def _open(path: str):
    from pyarrow import fs

    parts = urlparse(path)
    if parts.scheme in ("", "file"):
        return fs.LocalFileSystem().open_input_stream(path[5:] if parts.scheme else path)
    if parts.scheme in ("s3a", "s3n"):
        path = "s3" + path[len(parts.scheme) :]
    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_stream(inner)


def first_of_copies(files: DataFrame, keys: Sequence[str] = ("checksum",)) -> DataFrame:
    """One file per key, the first by path; copies are merged before the shuffle."""
    facts = [c for c in files.columns if c not in keys]
    first = files.groupBy(*keys).agg(F.min_by(F.struct(*facts), F.col("path")).alias("__file"))
    return first.select(*[f"__file.{c}" if c not in keys else c for c in files.columns])


def new_files(files: DataFrame, ledger: DataFrame, keys: Sequence[str] = ("checksum",)) -> DataFrame:
    """Files whose content was never loaded; of identical files the first by path."""
    return first_of_copies(files, keys).join(ledger.select(*keys).distinct(), list(keys), "left_anti")


def already_loaded(files: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files whose content is in the ledger."""
    return files.join(ledger.select("checksum").distinct(), "checksum", "left_semi")


def ledger_rows(files: DataFrame, ledger: DataFrame, keys: Sequence[str] = ("checksum",)) -> DataFrame:
    """Rows to add to the ledger: one per key that is not in it yet."""
    return new_files(files, ledger, keys)


def ledger_of(ledger: DataFrame, source_table: str) -> DataFrame:
    """Checksums loaded for one table."""
    return ledger.where(F.col("source_table") == source_table).select("checksum")


def current_manifest(manifest: DataFrame) -> DataFrame:
    """Last entry of every path."""
    rest = [c for c in manifest.columns if c != "path"]
    last = manifest.groupBy("path").agg(
        F.max_by(F.struct(*rest), F.col("processed_at")).alias("entry")
    )
    return last.select("path", "entry.*")


def changed_files(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files that are new by path, or whose size, time or checksum changed."""
    compared = ("size", "modified", "checksum")
    held = manifest.select("path", *[F.col(c).alias(f"__{c}") for c in compared], F.lit(True).alias("__held"))
    same = F.coalesce(F.col("__held"), F.lit(False))
    for column in compared:
        same = same & F.col(column).eqNullSafe(F.col(f"__{column}"))
    return files.join(held, "path", "left").where(~same).select(*files.columns)
