"""Raw rows -> typed, checked, merged Persistent table."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.contracts import Contract, TableSpec
from oreflow.functions.casts import contract_type
from oreflow.functions.columns import ARRIVAL_ORDER, AUDIT_COLUMNS, lookup, named, row_struct
from oreflow.operators.dedup import first_per_key, latest_per_key, text_key
from oreflow.operators.mapping import instant, stamp
from oreflow.operators.merge import CONFLICT, INSERTED_AT, mark_conflicts, scd1_merge, upsert
from oreflow.operators.quality import REASON, REASONS, RECORD, REJECTED, check_rows
from oreflow.operators.watermark import beyond_marks, lookback_start
from oreflow.plans.lake import Commit, Lake, visible_part
from oreflow.plans.merging import Target, align
from oreflow.session import drop_folder, scratch_folder

if TYPE_CHECKING:
    from oreflow.plans.pipeline import Context

# Lineage columns of a Persistent dimension.
LINEAGE_COLUMNS = (
    "record_source",
    "source_file_name",
    "source_batch_id",
    "source_update_ts",
    "persistent_insert_ts",
    "persistent_update_ts",
)
ARRIVAL = "__arrival"
RAW_RUN = "__raw_run"


def load_table(
    lake: Lake,
    contract: Contract,
    spec: TableSpec,
    context: Context,
    transform: Callable[[DataFrame, Context], DataFrame] | None = None,
) -> tuple[int, int]:
    """Take the Raw runs this table has not seen; returns (valid rows, rejected rows).

    ``transform`` sees the valid rows before the merge and must keep the columns
    it does not change.
    """
    tag = f"{spec.name}:{spec.source_table}@"
    commits = lake.visible("raw", spec.source_table)
    history = lake.commits("persistent", spec.target_table)
    taken = {run for commit in history for run in commit.consumed_runs}
    new = [c for c in commits if tag + c.run_id not in taken]
    if not any(c.rows for c in new):
        return 0, 0
    again = _lookback(commits, new, contract, spec, context)
    older = lake.read_commits([c for c in commits if c not in new and c not in again])
    held = visible_part(history)
    state = lake.read_commits(held)
    checked = _check(lake.read_commits([*again, *new]), spec)
    if spec.deduplicate_by:
        checked = _deduplicate(checked, older if spec.dedup_scope == "history" else None, spec)
    checked = _beyond_watermark(checked, state, contract, spec)

    folder = scratch_folder(lake.spark, f"checked-{spec.target_table}-{context.run_id}")
    valid, rejected = _stage(lake, checked, folder)
    new_runs = [c.run_id for c in new]
    rejected = rejected.where(F.col(RAW_RUN).isin(new_runs))
    # rows that a lookback reads again were counted by the run that brought them
    valid_count = valid.where(F.col(RAW_RUN).isin(new_runs)).count()
    rejected_count = rejected.count()

    incoming = _persistent_rows(valid, spec, context)
    if transform is not None:
        incoming = transform(incoming, context)
    schema = incoming.drop(ARRIVAL, RAW_RUN).schema
    target = None
    if spec.merges and not spec.buckets:
        target = Target(
            lake, spec.target_table, held, schema, spec.keys, spec.partitions, incoming
        )
        state = target.state
    quarantined = _mapped_only(rejected, spec, context)
    conflicts = spec.finds_conflicts
    if conflicts:
        compared = [c.name for c in spec.columns]
        marked = mark_conflicts(
            incoming,
            spec.keys,
            spec.version_column,
            compared,
            state,
            lambda ends: _written(ends, f"{folder}-versions"),
        )
        marked = _written(marked, f"{folder}-marked")
        incoming = marked.where(~F.col(CONFLICT)).drop(CONFLICT)
        clashes = marked.where(F.col(CONFLICT) & F.col(RAW_RUN).isin(new_runs))
        clashes = _mapped_only(clashes, spec, context, reason="version_conflict")
        quarantined = quarantined.unionByName(clashes)

    consumed = [tag + run for run in new_runs]
    done = [_write_target(lake, spec, context, incoming, state, held, schema, consumed, target)]
    bad_count = 0
    if rejected_count or conflicts:
        bad = lake.write_part("persistent", spec.rejects_table, context.run_id, quarantined)
        bad_count = bad.rows
        done += [bad] if bad.rows else []
    if rejected_count:
        write_quarantine_json(rejected, spec, context)
    lake.record(done, {("persistent", spec.target_table): frozenset(c.path for c in held)})
    if spec.watermark_column:  # after the rows are visible: a mark is never ahead of them
        _advance_watermark(lake, spec, valid)
    for scratch in (folder, f"{folder}-versions", f"{folder}-marked"):
        drop_folder(lake.spark, scratch)
    if context.keep_snapshots:
        lake.expire_snapshots("persistent", spec.target_table, context.keep_snapshots)
    return valid_count - (bad_count - rejected_count), bad_count


def _lookback(
    commits: Sequence[Commit],
    new: Sequence[Commit],
    contract: Contract,
    spec: TableSpec,
    context: Context,
) -> list[Commit]:
    """Runs to read again; only keyed tables can take a row twice."""
    days, last = contract.raw.lookback_days, context.previous_success
    if days is None or last is None or not spec.keys or spec.update_mode == "append":
        return []
    start = lookback_start(last, days).isoformat()
    return [c for c in commits if c not in new and (c.arrival_date or "") >= start]


def _check(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Map and check every Raw row, keeping what later steps need beside it.

    Checks look at one row only, so they come before the dedup: its shuffle then
    moves the mapped columns, and complete raw rows only for rejects.
    """
    extra = {
        ARRIVAL: F.struct(*[named(name) for name in ARRIVAL_ORDER]),
        RAW_RUN: F.col("run_id"),
        "__file": F.col("source_file_name"),
        "__modified": F.col("source_file_modified_ts"),
    }
    extra |= {mark: text_key(rows, name) for mark, name in _key_marks(spec).items()}
    return check_rows(rows.withColumns(extra), spec, list(extra))


def _key_marks(spec: TableSpec) -> dict[str, str]:
    """Cells that tell rows apart.

    A row that repeats a version is a duplicate only if it repeats its content too,
    where the contract wants other content of a version to be found.
    """
    by = list(spec.deduplicate_by)
    sources = {c.name.lower(): c.source for c in spec.columns}
    versioned = {sources[n.lower()].lower() for n in [*spec.keys, spec.version_column] if n}
    if by and spec.finds_conflicts and versioned <= {name.lower() for name in by}:
        by += [c.source for c in spec.columns if c.source.lower() not in {n.lower() for n in by}]
    return {f"__key_{i}": name for i, name in enumerate(by)}


def _deduplicate(checked: DataFrame, older: DataFrame | None, spec: TableSpec) -> DataFrame:
    """First row per raw key, of this load and of the earlier ones."""
    marks = _key_marks(spec)
    first = first_per_key(checked, [F.col(mark) for mark in marks], [F.col(ARRIVAL)])
    if older is not None:
        seen = older.select(*[text_key(older, name).alias(mark) for mark, name in marks.items()])
        first = first.join(seen.distinct(), list(marks), "left_anti")
    return first


def _beyond_watermark(
    checked: DataFrame, state: DataFrame | None, contract: Contract, spec: TableSpec
) -> DataFrame:
    """Rows of new accounts and newer versions, where the contract keeps marks per account.

    The committed Persistent table holds the highest version of every account
    that passed all layers, so it is the watermark.  Rejected rows stay, and
    rows of an equal version while conflicts are to be found.
    """
    key, version = contract.raw.watermark_key, contract.raw.watermark_version
    if not key or not version or state is None or spec.update_mode != "scd1":
        return checked
    by_source = {c.source.lower(): c.name for c in spec.columns}
    key, version = by_source.get(key.lower()), by_source.get(version.lower())
    if spec.keys != (key,) or spec.version_column != version:
        return checked
    marks = state.select(named(key).alias("__account"), named(version).alias("mark"))
    judged = F.when(~F.col(REJECTED), named(version)).otherwise(F.lit(2**63 - 1))
    rows = checked.withColumn("__account", named(key))
    return beyond_marks(rows, marks, ["__account"], judged, spec.quarantine_conflicts).drop(
        "__account"
    )


def _stage(lake: Lake, checked: DataFrame, folder: str) -> tuple[DataFrame, DataFrame]:
    """Write checked rows once, split by outcome, so that neither side is recomputed."""
    checked.write.partitionBy(REJECTED).parquet(folder)
    staged = lake.spark.read.schema(checked.schema).parquet(folder)
    return staged.where(~F.col(REJECTED)), staged.where(F.col(REJECTED))


def _written(rows: DataFrame, folder: str) -> DataFrame:
    rows.write.parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def _persistent_rows(valid: DataFrame, spec: TableSpec, context: Context) -> DataFrame:
    names = [c.name for c in spec.columns]
    if spec.lineage:
        valid = valid.withColumns(
            {
                "record_source": F.lit(spec.source_table),
                "source_file_name": F.col("__file"),
                "source_batch_id": F.col(RAW_RUN),
                "source_update_ts": F.col("__modified"),
                "persistent_insert_ts": instant(context.moment),
                "persistent_update_ts": instant(context.moment),
            }
        )
    stamped = stamp(valid, context.run_id, context.environment, context.moment)
    extra = [c for c in LINEAGE_COLUMNS if spec.lineage and c not in names]
    return stamped.select(*[named(n) for n in [*names, *extra, *AUDIT_COLUMNS, ARRIVAL, RAW_RUN]])


def _mapped_only(
    rows: DataFrame, spec: TableSpec, context: Context, reason: str | None = None
) -> DataFrame:
    """Rejected rows as the quarantine table keeps them."""
    labelled = rows
    if reason is not None:
        labelled = rows.withColumns({REASON: F.lit(reason), REASONS: F.array(F.lit(reason))})
    stamped = stamp(labelled, context.run_id, context.environment, context.moment)
    columns = [c.name for c in spec.columns]
    return stamped.select(*[named(n) for n in [*columns, *AUDIT_COLUMNS, REASON, REASONS]])


def _write_target(
    lake: Lake,
    spec: TableSpec,
    context: Context,
    incoming: DataFrame,
    state: DataFrame | None,
    held: Sequence[Commit],
    schema: T.StructType,
    consumed: Sequence[str],
    target: Target | None,
) -> Commit:
    table, run_id = spec.target_table, context.run_id
    if spec.update_mode == "overwrite":
        kept = incoming
        if spec.keys:
            kept = latest_per_key(incoming, spec.keys, [ARRIVAL])
        rows = kept.select(schema.names)
        return lake.write_snapshot("persistent", table, run_id, rows, consumed)
    if spec.update_mode == "append" or not spec.keys:
        rows = incoming.select(schema.names)
        return lake.write_part("persistent", table, run_id, rows, consumed_runs=consumed)
    current = align(state, schema) if state is not None else _empty(lake, schema)
    kept = [n for n in (INSERTED_AT, "persistent_insert_ts") if n in schema.names]
    if spec.update_mode == "scd1":
        merged = scd1_merge(current, incoming, spec.keys, spec.version_column, [ARRIVAL], kept)
    else:
        merged = upsert(current, incoming, spec.keys, [ARRIVAL], kept)
    if target is not None:
        return target.write(run_id, merged, consumed)
    clustered = len(held) == 1 and held[0].buckets == spec.buckets and held[0].keys == spec.keys
    return lake.write_snapshot(
        "persistent", table, run_id, merged, consumed, spec.keys, spec.buckets, clustered
    )


def _empty(lake: Lake, schema: T.StructType) -> DataFrame:
    return lake.spark.createDataFrame([], schema)


def quarantine_records(rejected: DataFrame, spec: TableSpec) -> DataFrame:
    """One ``{source, mapped, reason}`` record per rejected row."""
    return rejected.select(
        F.col(RECORD).alias("source"),
        row_struct([c.name for c in spec.columns]).alias("mapped"),
        F.col(REASON).alias("reason"),
    )


def write_quarantine_json(rejected: DataFrame, spec: TableSpec, context: Context) -> str:
    folder = (
        f"{context.quarantine_folder}/{spec.source_table}/{spec.target_table}"
        f"/{context.run_id}-{uuid.uuid4().hex[:12]}"
    )
    quarantine_records(rejected, spec).write.option("ignoreNullFields", "false").json(folder)
    return folder


def _advance_watermark(lake: Lake, spec: TableSpec, valid: DataFrame) -> None:
    """The highest value so far, compared in the mark's type; a mark never moves back."""
    column = lookup(valid, spec.watermark_column)
    if column is None:
        return
    kind = valid.select(column).schema[0].dataType
    if isinstance(kind, T.StringType):
        kind = contract_type(spec.watermark_type)
    held = lake.control.watermark(spec.source_table)
    highest = F.greatest(F.max(column.try_cast(kind)), F.lit(held).try_cast(kind))
    value = valid.agg(highest.cast("string").alias("value")).first()["value"]
    if value is not None and value != held:
        lake.control.set_watermark(spec.source_table, value)
