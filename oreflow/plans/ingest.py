"""Landing files -> Raw table."""

from __future__ import annotations

from collections.abc import Sequence
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.contracts import Contract, RawSpec
from oreflow.functions.casts import INTEGER_TEXT
from oreflow.functions.columns import RAW_AUDIT_COLUMNS, lookup, named, without
from oreflow.functions.hashing import record_hash
from oreflow.operators.dedup import latest_per_key, ranked_dedup
from oreflow.operators.mapping import instant, stamp, trim_text
from oreflow.operators.merge import absent_keys
from oreflow.operators.quality import (
    CHECK_FAILED,
    REASON,
    REASONS,
    reason_list,
    text_reasons,
)
from oreflow.plans.lake import CONTROL_SCHEMAS, LEDGER, MANIFEST, Commit, Lake
from oreflow.session import drop_folder, scratch_folder
from oreflow.sources import csv, files

if TYPE_CHECKING:
    from oreflow.plans.pipeline import Context

CONTENT = "__content"


def read_raw(lake: Lake, table: str) -> DataFrame | None:
    return lake.read("raw", table)


def stamp_files(numbered: DataFrame, context: Context) -> DataFrame:
    """File lineage and run audit columns on landed rows."""
    lineage = numbered.withColumns(
        {
            "arrival_date": F.to_date(F.lit(context.arrival_date)),
            "source_file_name": F.col(f"{csv.FILE}.name"),
            "source_file_path": F.col(f"{csv.FILE}.path"),
            "source_file_checksum": F.col(f"{csv.FILE}.checksum"),
            "source_file_size": F.col(f"{csv.FILE}.size"),
            "source_file_modified_ts": F.col(f"{csv.FILE}.modified"),
        }
    )
    return stamp(lineage, context.run_id, context.environment, context.moment)


def land(lake: Lake, contract: Contract, context: Context) -> dict[str, tuple[int, int]]:
    """Load new files; per table (rows in Raw, rows in the landing and Raw quarantines).

    First the folder is only listed, and what the manifest knows by path, size and
    time is left closed.  What remains is read, hashed and held against the ledger.
    Rows of all layers, ledger and manifest become visible by one commit: a run
    that breaks off before it leaves nothing, wherever it breaks off.
    """
    spark, landing = lake.spark, contract.landing
    listed = files.list_files(spark, context.landing, landing.pattern)
    if listed is None:
        return {}
    basis = lake.basis(("control", LEDGER))
    target = F.lit(landing.raw_table) if landing.raw_table else file_stem()
    listed = listed.drop("content").withColumn("source_table", target)
    if not landing.reread:
        listed = files.unread(listed, lake.manifest())
    paths = [row["path"] for row in listed.select("path").collect()]
    if not paths:
        return {}
    ledger = lake.ledger()
    scratch = scratch_folder(spark, f"landing-{context.run_id}")
    # Written once: hashing reads every byte and must not be repeated.
    found = files.fingerprint(files.read_files(spark, paths), encoding=landing.encoding)
    found = _kept(found.withColumn("source_table", target), f"{scratch}/found")
    # equal files for two tables are loaded into both
    fresh = _kept(files.new_files(found, ledger, files.PER_TABLE), f"{scratch}/fresh")
    tables = [row[0] for row in fresh.select("source_table").distinct().collect()]
    counts, commits = {}, []
    for number, table in enumerate(sorted(tables)):
        own = fresh.where(F.col("source_table") == table)
        counts[table] = _land_table(
            lake, contract, context, table, own, f"{scratch}/{number}", commits
        )
    for name, rows in ((MANIFEST, found), (LEDGER, fresh)):
        commits.append(lake.write_part("control", name, context.run_id, _entries(rows, name, context)))
    lake.record(commits, basis)
    lake.tidy(LEDGER, MANIFEST)
    drop_folder(spark, scratch)
    return counts


def _kept(rows: DataFrame, folder: str) -> DataFrame:
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def _entries(rows: DataFrame, name: str, context: Context) -> DataFrame:
    """Files as the ledger or the manifest keeps them."""
    stamped = rows.withColumns(
        {"processed_at": instant(context.moment), "run_id": F.lit(context.run_id)}
    )
    return stamped.select(*T.StructType.fromDDL(CONTROL_SCHEMAS[name]).names)


def file_stem() -> Column:
    """File name without its last suffix: the Raw table when the contract names none."""
    return F.regexp_replace("name", r"(?<=.)\.[^.]*$", "")


def _land_table(
    lake: Lake,
    contract: Contract,
    context: Context,
    table: str,
    fresh: DataFrame,
    scratch: str,
    commits: list[Commit],
) -> tuple[int, int]:
    """Write one table's new files; ``commits`` takes what is to become visible."""
    landing = contract.landing
    raw = contract.raw if landing.raw_table or contract.raw.table == table else RawSpec()
    scanned = csv.scan(lake.spark, fresh, landing, raw.columns)
    if scanned is None:
        return 0, 0
    landed = _write_landed(lake, contract, context, table, scanned, commits, f"{scratch}/rows")
    numbered = csv.number_rows(landed, fresh, f"{scratch}/splits")
    stamped = stamp_files(numbered, context)
    rows = stamped.where(named(csv.REJECT).isNull()).select(_raw_names(landed))
    rows, raw_rejects = refine_raw(rows, raw, raw_history(lake, table, raw))
    part = lake.write_part("raw", table, context.run_id, rows, context.arrival_date)
    commits.append(part)
    inserted, rejected = part.rows, 0
    if raw_rejects is not None:
        part = lake.write_part("raw", raw.quarantine_table, context.run_id, raw_rejects)
        commits.append(part)
        rejected += part.rows
    bad = stamped.where(named(csv.REJECT).isNotNull()).select(
        *_raw_names(landed),
        named(csv.MALFORMED).alias("malformed_record"),
        named(csv.REJECT).alias(REASON),
    )
    name = landing.quarantine_table or f"{table}__landing_quarantine"
    part = lake.write_part("landing", name, context.run_id, bad)
    if landing.checks_records or part.rows:
        commits.append(part)
    rejected += part.rows
    return inserted, rejected


def _write_landed(
    lake: Lake,
    contract: Contract,
    context: Context,
    table: str,
    scanned: DataFrame,
    commits: list[Commit],
    folder: str,
) -> DataFrame:
    """Parse the files exactly once, into the landing table or a scratch table."""
    landing = contract.landing
    if landing.preserve_source:
        name = landing.landing_table or f"{table}__landing"
        part = lake.write_part("landing", name, context.run_id, scanned)
        commits.append(part)
        return lake.read_commits([part])
    scanned.write.parquet(folder)
    return lake.spark.read.schema(scanned.schema).parquet(folder)


def _raw_names(landed: DataFrame) -> list[str]:
    return [*without(landed.columns, csv.SCAN_COLUMNS), *RAW_AUDIT_COLUMNS]


def raw_history(lake: Lake, table: str, spec: RawSpec) -> DataFrame | None:
    """Earlier Raw rows, only when the contract merges into Raw by key."""
    return read_raw(lake, table) if spec.incremental_key else None


def refine_raw(
    rows: DataFrame, spec: RawSpec, history: DataFrame | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """What a Raw contract asks for beyond appending: (rows for Raw, rows for its quarantine).

    Standardise, hash, check, keep the best ranked row per (key, version), the
    latest version per key, and add only what Raw does not hold yet.  Where a table
    looks for conflicts, rows of one version with other content are no repeats:
    they are told by their content too and reach the table that judges them.  Rows that
    fail the checks go to the Raw quarantine if the contract names one;
    otherwise they stay in Raw untouched and are rejected on the way to
    Persistent.
    """
    if "trim_whitespace" in spec.standardize:
        rows = trim_text(rows, excluded=RAW_AUDIT_COLUMNS)
    if "cast_version_integer" in spec.standardize and spec.version_column:
        rows = _plain_integer(rows, spec.version_column)
    if spec.record_hash_columns:
        business = without(rows.columns, RAW_AUDIT_COLUMNS)
        hashed = business if spec.record_hash_columns == ("all",) else spec.record_hash_columns
        rows = rows.withColumn("record_hash", record_hash(hashed))
    shaped = bool(spec.deduplicate_by or spec.select_latest_per_key or spec.incremental_key)
    if not spec.quarantine_table and not shaped:
        return rows, None

    labelled = rows.withColumn("__labels", text_reasons(rows, spec.checks))
    sound = labelled.where(F.col("__labels") == "").drop("__labels")
    failed = labelled.where(F.col("__labels") != "")
    content = [CONTENT] if spec.keep_conflicts else []
    business = without(rows.columns, [*RAW_AUDIT_COLUMNS, "record_hash"])
    if content:
        sound = sound.withColumn(CONTENT, record_hash(business))
    if spec.deduplicate_by and _has_all(rows, spec.deduplicate_by):
        newest_file = [
            F.col("source_file_modified_ts").desc(),
            F.col("source_file_name").desc(),
            F.col("latest_insert_datetime").desc(),
            F.col("source_file_path").desc(),
            F.col("source_row_number").desc(),
        ]
        sound = ranked_dedup(sound, [*spec.deduplicate_by, *content], newest_file)
    if spec.select_latest_per_key and spec.version_column and _has_all(rows, spec.keys):
        keep = latest_contents if content else latest_version
        sound = keep(sound, spec.keys, spec.version_column)
    if history is not None and _has_all(rows, spec.incremental_key):
        if _has_all(history, spec.incremental_key):
            if content:
                history = history.withColumn(CONTENT, _content(history, business))
            sound = absent_keys(sound, history, [*spec.incremental_key, *content])
    sound = sound.drop(*content)
    if spec.quarantine_table:
        why = {REASON: F.lit(CHECK_FAILED), REASONS: reason_list(F.col("__labels"))}
        return sound, failed.withColumns(why).drop("__labels")
    return sound.unionByName(failed.drop("__labels")), None


def latest_version(rows: DataFrame, keys: tuple[str, ...], version: str) -> DataFrame:
    """Highest version per key, compared as a number; newest file among equals."""
    numbered = rows.withColumn("__version", version_number(rows, version))
    order = ["__version", "source_file_modified_ts", "source_file_path", "source_row_number"]
    return latest_per_key(numbered, keys, order).drop("__version")


def latest_contents(rows: DataFrame, keys: tuple[str, ...], version: str) -> DataFrame:
    """All rows of the highest version per key; each task keeps only its own highest before the shuffle."""
    numbered = rows.withColumn("__version", version_number(rows, version))
    by_version = Window.partitionBy(*[named(key) for key in keys]).orderBy(F.col("__version").desc())
    ranked = numbered.withColumn("__rank", F.rank().over(by_version))
    return ranked.where(F.col("__rank") == 1).drop("__rank", "__version")


def _content(rows: DataFrame, names: Sequence[str]) -> Column:
    """Hash of the named columns; one that the rows lack counts as empty."""
    held = [lookup(rows, name) for name in names]
    cells = [F.lit(None).cast("string") if c is None else c for c in held]
    texts = F.struct(*[c.alias(f"c{i}") for i, c in enumerate(cells)])
    return record_hash([f"c{i}" for i in range(len(cells))], texts)


def version_number(df: DataFrame, version: str) -> Column:
    text = lookup(df, version)
    return F.when(text.rlike(INTEGER_TEXT), text.try_cast("bigint"))


def _plain_integer(rows: DataFrame, name: str) -> DataFrame:
    """Version text in plain form (' +07 ' -> '7'); text that is no integer stays."""
    column = lookup(rows, name)
    if column is None:
        return rows
    plain = version_number(rows, name).cast("string")
    return rows.withColumn(name, F.coalesce(plain, column))


def _has_all(df: DataFrame, names: tuple[str, ...]) -> bool:
    return bool(names) and all(lookup(df, name) is not None for name in names)
