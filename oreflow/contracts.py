"""Table contracts: what a feed looks like and how its rows become tables.

A contract is a small YAML document (or the equivalent dict).  Everything here
runs on the driver and touches no data.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace
from pathlib import Path
from typing import Any

from pyspark.sql import types as T

from oreflow.functions.casts import contract_type
from oreflow.functions.rules import RULES

# Hash partitions of a keyed table where the contract names no number.
DEFAULT_PARTITIONS = 16

UPDATE_MODES = ("incremental_upsert", "scd1", "append", "overwrite")


@dataclass(frozen=True)
class ColumnSpec:
    name: str
    source: str
    type: str = "TEXT"
    nullable: bool = True
    default: Any = None

    @property
    def data_type(self) -> T.DataType:
        return contract_type(self.type)


@dataclass(frozen=True)
class Check:
    """One rule on one or more columns."""

    rule: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class LandingSpec:
    pattern: str = "*.csv"
    raw_table: str | None = None
    landing_table: str | None = None
    preserve_source: bool = False
    delimiter: str = ","
    encoding: str = "UTF-8"
    multi_line: bool | None = None
    exact_column_count: int | None = None
    required_columns: tuple[str, ...] = ()
    reject_unknown_columns: bool = False
    quarantine_table: str | None = None
    #: Open every file again instead of trusting path, size and time of the listing.
    reread: bool = False

    @property
    def checks_records(self) -> bool:
        return bool(
            self.exact_column_count or self.required_columns or self.reject_unknown_columns
        )


@dataclass(frozen=True)
class RawSpec:
    table: str | None = None
    columns: tuple[str, ...] = ()
    checks: tuple[Check, ...] = ()
    quarantine_table: str | None = None
    standardize: tuple[str, ...] = ()
    incremental_key: tuple[str, ...] = ()
    deduplicate_by: tuple[str, ...] = ()
    keys: tuple[str, ...] = ()
    version_column: str | None = None
    select_latest_per_key: bool = False
    record_hash_columns: tuple[str, ...] = ()
    watermark_key: str | None = None
    watermark_version: str | None = None
    lookback_days: int | None = None
    #: A table of this contract looks for versions with several contents: Raw must keep them.
    keep_conflicts: bool = False


@dataclass(frozen=True)
class TableSpec:
    name: str
    source_table: str
    target_table: str
    columns: tuple[ColumnSpec, ...]
    keys: tuple[str, ...] = ()
    deduplicate_by: tuple[str, ...] = ()
    dedup_scope: str = "history"
    checks: tuple[Check, ...] = ()
    quarantine_table: str | None = None
    update_mode: str = "incremental_upsert"
    version_column: str | None = None
    quarantine_conflicts: bool = False
    watermark_column: str | None = None
    watermark_type: str = "TEXT"
    lineage: bool = False
    buckets: int | None = None
    partitions: int = DEFAULT_PARTITIONS

    @property
    def rejects_table(self) -> str:
        return self.quarantine_table or f"{self.target_table}__quarantine"

    @property
    def merges(self) -> bool:
        """Whether incoming rows meet the table's by key."""
        return bool(self.keys) and self.update_mode in ("incremental_upsert", "scd1")

    @property
    def finds_conflicts(self) -> bool:
        return self.update_mode == "scd1" and self.quarantine_conflicts

    @property
    def schema(self) -> T.StructType:
        """Typed business columns; NOT NULL as the contract declares it."""
        fields = [
            T.StructField(c.name, c.data_type, c.nullable and c.name not in self.keys)
            for c in self.columns
        ]
        return T.StructType(fields)

    def required(self) -> list[str]:
        """Columns that must hold a value: declared not null, or part of the key."""
        return [c.name for c in self.columns if not c.nullable or c.name in self.keys]


@dataclass(frozen=True)
class ConsumptionSpec:
    name: str
    table: str | None
    sql: str | None = None
    mapping: str | None = None
    query_file: str | None = None


@dataclass(frozen=True)
class Contract:
    landing: LandingSpec
    raw: RawSpec
    persistent: tuple[TableSpec, ...]
    consumption: tuple[ConsumptionSpec, ...] = ()
    quality: tuple[Check, ...] = field(default=())


def load_contract(path: str | Path) -> Contract:
    """Read a YAML contract; table files it refers to are found next to it."""
    path = Path(path)
    document = _read_yaml(path)
    references = document.get("table_metadata") or {}
    if references.get("raw"):
        document["raw"] = _read_yaml(path.parent / references["raw"])
    if references.get("persistent"):
        names = references["persistent"]
        names = [names] if isinstance(names, str) else names
        document["persistent"] = [_read_yaml(path.parent / name) for name in names]
    return parse_contract(document)


def _read_yaml(path: Path) -> dict[str, Any]:
    try:
        import yaml
    except ImportError as error:
        raise ImportError("reading YAML contracts needs PyYAML; use parse_contract(dict)") from error
    return yaml.safe_load(path.read_text(encoding="utf-8")) or {}


def parse_contract(document: Mapping[str, Any]) -> Contract:
    raw_section = document.get("raw") or {}
    raw = _raw(raw_section)
    quality = _checks((document.get("quality") or {}).get("rules"))
    sections = _as_list(document.get("persistent"))
    shared_columns = document.get("columns") or []
    tables = tuple(_table(section, raw, shared_columns, quality) for section in sections)
    if any(t.finds_conflicts and t.source_table == raw.table for t in tables):
        raw = replace(raw, keep_conflicts=True)
    return Contract(
        landing=_landing(document.get("landing") or {}, document.get("source") or {}),
        raw=raw,
        persistent=tables,
        consumption=tuple(_consumption(item) for item in _as_list(document.get("consumption"))),
        quality=quality,
    )


def strip_layer(table: str) -> str:
    """``persistent.customers`` -> ``customers``."""
    return table.split(".", 1)[-1]


def selected(items: Sequence[Any], names: Sequence[str] | None, name_of) -> list[Any]:
    """Items whose target is listed; all of them when no list is given."""
    if not names:
        return list(items)
    wanted = {strip_layer(name) for name in names}
    chosen = [item for item in items if name_of(item) in wanted]
    if not chosen:
        raise ValueError(f"no table of the contract matches {sorted(wanted)}")
    return chosen


def _as_list(section: Any) -> list[Any]:
    if not section:
        return []
    return [section] if isinstance(section, Mapping) else list(section)


def _names(value: Any) -> tuple[str, ...]:
    if not value:
        return ()
    return (value,) if isinstance(value, str) else tuple(value)


def _checks(section: Any) -> tuple[Check, ...]:
    checks = []
    for item in section or []:
        rule = str(item.get("rule") or item.get("check") or "").lower()
        if rule not in RULES:
            raise ValueError(f"unknown data quality rule {rule!r}; known: {sorted(RULES)}")
        columns = _names(item.get("columns") or item.get("column"))
        if not columns:
            raise ValueError(f"data quality rule {rule!r} names no column")
        checks.append(Check(rule, columns))
    return tuple(checks)


def _landing(section: Mapping[str, Any], source: Mapping[str, Any]) -> LandingSpec:
    validation = section.get("validation") or {}
    checksum = source.get("checksum", "sha256")
    if checksum != "sha256":
        raise ValueError(f"file checksum {checksum!r} is not supported, only sha256")
    encoding = str(source.get("encoding", "UTF-8")).upper().replace("_", "-")
    if encoding.startswith(("UTF-16", "UTF-32")):
        raise ValueError(f"encoding {encoding!r} is not supported: line breaks must be one byte")
    return LandingSpec(
        pattern=section.get("pattern")
        or section.get("file_pattern")
        or source.get("file_pattern")
        or "*.csv",
        raw_table=section.get("raw_table"),
        landing_table=section.get("table"),
        preserve_source=bool(section.get("preserve_source", False)),
        delimiter=source.get("delimiter", ","),
        encoding="UTF-8" if encoding in ("UTF-8-SIG", "UTF8", "UTF-8") else encoding,
        multi_line=section.get("multi_line"),
        exact_column_count=validation.get("exact_column_count"),
        required_columns=_names(
            validation.get("required_columns") or section.get("required_columns")
        ),
        reject_unknown_columns=bool(validation.get("reject_unknown_columns", False)),
        quarantine_table=validation.get("quarantine"),
        reread=bool(section.get("reread", False)),
    )


def _raw(section: Mapping[str, Any]) -> RawSpec:
    watermark = section.get("watermark") or {}
    if watermark and watermark.get("strategy") != "per_account":
        raise ValueError(f"unknown watermark strategy {watermark.get('strategy')!r}")
    known = {"trim_whitespace", "cast_version_integer"}
    standardize = _names(section.get("standardize"))
    if set(standardize) - known:
        raise ValueError(f"unknown standardize steps {sorted(set(standardize) - known)}")
    return RawSpec(
        table=section.get("table_name") or section.get("table"),
        columns=tuple(column["name"] for column in section.get("columns") or []),
        checks=_checks(section.get("data_quality_checks")),
        quarantine_table=section.get("quarantine_table") or section.get("dq_quarantine_table"),
        standardize=standardize,
        incremental_key=_names(section.get("incremental_key")),
        deduplicate_by=_names(section.get("deduplicate_by")),
        keys=_names(section.get("primary_keys")),
        version_column=section.get("version_column"),
        select_latest_per_key=bool(section.get("select_latest_per_key", False)),
        record_hash_columns=_names(section.get("record_hash_columns")),
        watermark_key=watermark.get("account_column"),
        watermark_version=watermark.get("version_column"),
        lookback_days=section.get("lookback_days"),
    )


def _table(
    section: Mapping[str, Any],
    raw: RawSpec,
    shared_columns: Sequence[Mapping[str, Any]],
    quality: tuple[Check, ...],
) -> TableSpec:
    table = section.get("table_name") or section.get("table")
    name = section.get("name") or section.get("target_table") or table
    target = section.get("target_table") or table or name
    source = section.get("source_table") or raw.table
    if not target or not source:
        raise ValueError(f"mapping {name!r} needs a target table and a source table")
    columns = tuple(
        ColumnSpec(
            name=column["name"],
            source=column.get("source") or column["name"],
            type=column.get("type", "TEXT"),
            nullable=bool(column.get("nullable", True)),
            default=column.get("default"),
        )
        for column in section.get("columns") or shared_columns
    )
    if not columns:
        raise ValueError(f"mapping {name!r} has no columns")
    names = {column.name for column in columns}
    keys = _names(section.get("keys") or section.get("primary_keys"))
    _expect(names, keys, f"key of {name!r}")
    if "data_quality_checks" in section:
        checks = _checks(section["data_quality_checks"])
    else:
        checks = raw.checks
    for check in checks:
        _expect(names, check.columns, f"rule {check.rule!r} of {name!r}")
    for rule in quality:
        held = tuple(column for column in rule.columns if column in names)
        if held:
            checks += (Check(rule.rule, held),)
    mode, version = _update_mode(section, name, raw)
    if mode == "scd1":
        _expect(names, _names(version), f"version column of {name!r}")
        if not version or not keys:
            raise ValueError(f"mapping {name!r}: SCD1 needs keys and a version column")
    scope = section.get("dedup_scope", "history")
    if scope not in ("history", "batch"):
        raise ValueError(f"mapping {name!r}: dedup_scope is 'history' or 'batch'")
    return TableSpec(
        name=name,
        source_table=source,
        target_table=target,
        columns=columns,
        keys=keys,
        deduplicate_by=_names(section.get("deduplicate_by")),
        dedup_scope=scope,
        checks=checks,
        quarantine_table=section.get("dq_quarantine_table"),
        update_mode=mode,
        version_column=version,
        quarantine_conflicts=section.get("conflict_policy") == "quarantine",
        watermark_column=section.get("watermark_column"),
        watermark_type=section.get("watermark_type", "TEXT"),
        lineage=bool(section.get("lineage_columns", mode == "scd1")),
        buckets=section.get("buckets"),
        partitions=int(section.get("partitions") or DEFAULT_PARTITIONS),
    )


def _update_mode(
    section: Mapping[str, Any], name: str, raw: RawSpec
) -> tuple[str, str | None]:
    mode = str(section.get("table_update_mode", "incremental_upsert")).lower()
    version = section.get("version_column")
    if str(section.get("strategy", "")).upper() == "SCD1":
        mode = "scd1"
        rule = str(section.get("update_when", ""))
        gate = re.fullmatch(r"\s*incoming\.(\w+)\s*>\s*current\.(\w+)\s*", rule)
        if rule and (not gate or gate[1] != gate[2]):
            raise ValueError(f"mapping {name!r}: update_when must read incoming.v > current.v")
        version = gate[1] if gate else version or raw.version_column
    if mode not in UPDATE_MODES:
        raise ValueError(f"mapping {name!r}: update mode {mode!r} is none of {UPDATE_MODES}")
    return mode, version


def _expect(known: set[str], asked: Sequence[str], where: str) -> None:
    missing = [name for name in asked if name not in known]
    if missing:
        raise ValueError(f"{where}: unmapped columns {missing}")


def _consumption(item: Mapping[str, Any]) -> ConsumptionSpec:
    name = item.get("name") or item.get("table")
    given = [key for key in ("sql", "mapping", "query_file") if item.get(key)]
    if len(given) != 1:
        raise ValueError(f"consumption item {name!r} needs exactly one of sql, mapping, query_file")
    if given[0] == "mapping" and not (item.get("table") or name):
        raise ValueError("a consumption mapping needs a table or a name")
    return ConsumptionSpec(
        name=name or "consumption",
        table=item.get("table") or name,
        sql=item.get("sql"),
        mapping=item.get("mapping"),
        query_file=item.get("query_file"),
    )
