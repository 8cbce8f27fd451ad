"""Layer tables as parquet folders, made visible by one commit.

Every write goes to a folder of its own and nothing is ever overwritten, so a
lost executor, a crashed run or a retry leaves at most an unreferenced folder.
A table's content is what the commits point at: the last snapshot and the parts
appended after it.  All folders that a step wrote, also those of several tables
and of the file ledger, become visible by one file of the log, or none does.

A keyed table lies in hash partitions of its key.  Its snapshot names the folder
of each partition, so a merge writes the partitions that got rows and points at
the old folders of the others.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Collection, Iterable, Mapping, Sequence
from contextlib import suppress
from dataclasses import dataclass, field
from datetime import datetime, timezone
from functools import lru_cache, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oreflow.functions.columns import named
from oreflow.plans.control import ControlTables
from oreflow.plans.log import CommitLog
from oreflow.session import drop_folder


# Catalog databases, one a lake, for the entries that let Spark use the bucketing of a snapshot.
BUCKET_DATABASE = "oreflow_snapshots"


# Tables of the control layer that lie in the lake, so that one commit holds them and the data.
LEDGER = "processed_file_ledger"
MANIFEST = "file_manifests"
CONTROL_SCHEMAS = {
    LEDGER: "checksum string, source_table string, path string, processed_at timestamp, run_id string",
    MANIFEST: "path string, source_table string, size long, modified timestamp, checksum string, "
    "processed_at timestamp, run_id string",
}
# Parts of such a table that may pile up before they are put together.
LOOSE_PARTS = 32

# Column and folder name of the hash partition of a key.
PARTITION = "__partition"


class ConcurrentChange(RuntimeError):
    """Another run changed a table between reading its state and committing the next one."""


@dataclass(frozen=True)
class Commit:
    """One written folder of a table."""

    layer: str
    table: str
    run_id: str
    kind: str
    path: str
    schema: T.StructType
    arrival_date: str | None = None
    consumed_runs: tuple[str, ...] = field(default=())
    rows: int = 0
    keys: tuple[str, ...] = field(default=())
    buckets: int | None = None
    #: Hash partitions of the key, and the rows of each in the folder that holds it.
    partitions: int | None = None
    layout: Mapping[str, Mapping[int, int]] = field(default_factory=dict)

    @property
    def folders(self) -> list[str]:
        """The folders that hold rows."""
        if self.partitions is None:
            return [self.path]
        return [folder for _, folder in self.leaves]

    @property
    def leaves(self) -> list[tuple[int, str]]:
        """(partition, its folder), in order."""
        found = [(p, f"{folder}/{PARTITION}={p}") for folder, held in self.layout.items() for p in held]
        return sorted(found)


def partition_of(keys: Sequence[str], partitions: int) -> Column:
    return F.pmod(F.xxhash64(*[named(key) for key in keys]), partitions).cast("int")


class Lake:
    def __init__(self, spark: SparkSession, root: str, control: ControlTables | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.control = control or ControlTables(spark, f"{self.root}/control")
        self.log = CommitLog(spark, f"{self.root}/control/log")
        self.bucket_database = f"{BUCKET_DATABASE}_{hashlib.sha256(self.root.encode()).hexdigest()[:12]}"

    def write_part(
        self,
        layer: str,
        table: str,
        run_id: str,
        df: DataFrame,
        arrival_date: str | None = None,
        consumed_runs: Iterable[str] = (),
    ) -> Commit:
        """Write rows to add to a table; visible once recorded."""
        day = f"arrival_date={arrival_date}/" if arrival_date else ""
        folder = f"{self.root}/{layer}/{table}/{day}run_id={run_id}/{_unique()}"
        df.write.mode("errorifexists").parquet(folder)
        return Commit(
            layer,
            table,
            run_id,
            "part",
            folder,
            df.schema,
            arrival_date,
            tuple(consumed_runs),
            self._rows(folder, df.schema),
        )

    def write_snapshot(
        self,
        layer: str,
        table: str,
        run_id: str,
        df: DataFrame,
        consumed_runs: Iterable[str] = (),
        keys: Sequence[str] = (),
        buckets: int | None = None,
        clustered: bool = False,
    ) -> Commit:
        """Write a table's complete new state; visible once recorded.

        With ``buckets`` the rows are clustered by key, and the next merge reads
        the table without shuffling it.  ``clustered`` says that the rows come
        out of such a merge, bucket by bucket, and need no shuffle here either.
        """
        folder = f"{self.root}/{layer}/{table}/snapshot={run_id}/{_unique()}"
        if buckets and keys:
            name = self._bucket_table(folder)
            if not clustered:
                df = df.repartition(buckets, *[F.col(_quoted(key)) for key in keys])
            (
                df.write.format("parquet")
                .bucketBy(buckets, *keys)
                .sortBy(*keys)
                .option("path", folder)
                .saveAsTable(name)
            )
        else:
            buckets = None
            df.write.mode("errorifexists").parquet(folder)
        return Commit(
            layer,
            table,
            run_id,
            "snapshot",
            folder,
            df.schema,
            None,
            tuple(consumed_runs),
            self._rows(folder, df.schema),
            tuple(keys),
            buckets,
        )

    def write_partitions(
        self,
        layer: str,
        table: str,
        run_id: str,
        df: DataFrame,
        keys: Sequence[str],
        partitions: int,
        consumed_runs: Iterable[str] = (),
        base: Commit | None = None,
        touched: Collection[int] = (),
    ) -> Commit:
        """Write hash partitions of a keyed table; visible once recorded.

        With ``base``, the table as it was, ``df`` holds the new rows of the
        ``touched`` partitions; the others stay where they are.
        """
        folder = f"{self.root}/{layer}/{table}/snapshot={run_id}/{_unique()}"
        dealt = df.withColumn(PARTITION, partition_of(keys, partitions))
        # adaptive execution sizes the files: large partitions get several, small ones share a task
        dealt = dealt.hint("rebalance", PARTITION)
        dealt.write.mode("errorifexists").partitionBy(PARTITION).parquet(folder)
        whole = T.StructType([*df.schema.fields, T.StructField(PARTITION, T.IntegerType())])
        written = self.spark.read.schema(whole).parquet(folder).groupBy(PARTITION).count()
        counts = {row[PARTITION]: row["count"] for row in written.collect()}
        layout: dict[str, dict[int, int]] = {folder: counts} if counts else {}
        if base is not None:
            if stray := set(counts) - set(touched):
                raise ValueError(f"{layer}.{table}: rows moved to partitions {sorted(stray)}; keys must be the same each time")
            for old, held in base.layout.items():
                if left := {p: n for p, n in held.items() if p not in touched}:
                    layout[old] = left
        total = sum(n for held in layout.values() for n in held.values())
        return Commit(
            layer,
            table,
            run_id,
            "snapshot",
            folder,
            df.schema,
            None,
            tuple(consumed_runs),
            total,
            tuple(keys),
            None,
            partitions,
            layout,
        )

    def read_partitions(self, commit: Commit, wanted: Collection[int]) -> DataFrame:
        """The rows of some partitions; no file of another is read."""
        folders = [folder for p, folder in commit.leaves if p in wanted]
        if not folders:
            return self.spark.createDataFrame([], commit.schema)
        return self.spark.read.schema(commit.schema).parquet(*folders)

    def _rows(self, folder: str, schema: T.StructType) -> int:
        """Counted from the parquet footers: exact whatever tasks were retried."""
        return self.spark.read.schema(schema).parquet(folder).count()

    def _bucket_table(self, folder: str) -> str:
        """Catalog name of a bucketed folder (a pointer; the folder is the table)."""
        self.create_database(self.bucket_database)
        return f"{self.bucket_database}.t_{folder.rsplit('/', 1)[-1]}"

    def _read_bucketed(self, commit: Commit) -> DataFrame:
        name = self._bucket_table(commit.path)
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in commit.schema)
            keys = ", ".join(_quoted(key) for key in commit.keys)
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) "
                f"SORTED BY ({keys}) INTO {commit.buckets} BUCKETS LOCATION '{commit.path}'"
            )
        return self.spark.table(name)

    def attach(self, layer: str, folders: Mapping[str, str]) -> None:
        """Make existing parquet folders the content of tables, without a copy."""
        self.record(
            [
                Commit(layer, table, "attached", "snapshot", path, self.spark.read.parquet(path).schema)
                for table, path in folders.items()
            ]
        )

    def basis(self, *tables: tuple[str, str]) -> dict[tuple[str, str], frozenset[str]]:
        """What (layer, table) are made of now: the ground that a later ``record`` stands on."""
        return {key: self._made_of(*key) for key in tables}

    def _made_of(self, layer: str, table: str) -> frozenset[str]:
        return frozenset(commit.path for commit in self.visible(layer, table))

    def record(
        self, commits: Sequence[Commit], basis: Mapping[tuple[str, str], frozenset[str]] | None = None
    ) -> None:
        """Make written folders visible, all or none.

        Refused if a table of ``basis`` is no longer what it was: whoever commits
        second has read a state that is gone.  The number of the commit is put only
        where there is none, so nothing can slip between this check and the commit.
        """
        now = datetime.now(timezone.utc).isoformat()
        rows = [
            {
                "layer": c.layer,
                "table_name": c.table,
                "run_id": c.run_id,
                "kind": c.kind,
                "path": c.path,
                "schema": json.dumps(c.schema.jsonValue()),
                "arrival_date": c.arrival_date,
                "consumed_runs": list(c.consumed_runs),
                "rows": c.rows,
                "keys": list(c.keys),
                "buckets": c.buckets,
                "partitions": c.partitions,
                "layout": {folder: {str(p): n for p, n in held.items()} for folder, held in c.layout.items()},
                "committed_at": now,
            }
            for c in commits
        ]
        while True:
            self.log.rows()
            for (layer, table), held in (basis or {}).items():
                if self._made_of(layer, table) != held:
                    raise ConcurrentChange(f"{layer}.{table} was changed by another run; repeat this one")
            if self.log.put(self.log.version + 1, rows):
                return

    def commits(self, layer: str, *tables: str) -> list[Commit]:
        """Written folders of the tables, oldest first (driver metadata, one row a folder)."""
        return [
            Commit(
                row["layer"],
                row["table_name"],
                row["run_id"],
                row["kind"],
                row["path"],
                _schema(row["schema"]),
                row["arrival_date"],
                tuple(row["consumed_runs"]),
                row["rows"],
                tuple(row["keys"]),
                row["buckets"],
                row["partitions"],
                {folder: {int(p): n for p, n in held.items()} for folder, held in row["layout"].items()},
            )
            for row in self.log.rows()
            if row["layer"] == layer and row["table_name"] in tables
        ]

    def ledger(self) -> DataFrame:
        """Content that was loaded, by table."""
        return self._control(LEDGER)

    def manifest(self) -> DataFrame:
        """Files that were read, as they were listed."""
        return self._control(MANIFEST)

    def _control(self, table: str) -> DataFrame:
        rows = self.read("control", table)
        return self.spark.createDataFrame([], CONTROL_SCHEMAS[table]) if rows is None else rows

    def tidy(self, *tables: str) -> None:
        """Put the parts of control tables together when there are many."""
        for table in tables:
            held = self.visible("control", table)
            if len(held) <= LOOSE_PARTS:
                continue
            basis = self.basis(("control", table))
            whole = self.write_snapshot("control", table, "tidy", self.read_commits(held))
            with suppress(ConcurrentChange):  # another run wrote to it: next time
                self.record([whole], basis)

    def visible(self, layer: str, table: str) -> list[Commit]:
        """Folders that make up the table now."""
        return visible_part(self.commits(layer, table))

    def read_commits(self, commits: Sequence[Commit]) -> DataFrame | None:
        """Rows of the given folders, united by column name; None without folders."""
        if not commits:
            return None
        if len(commits) == 1 and commits[0].buckets:
            return self._read_bucketed(commits[0])
        united = _united([commit.schema for commit in commits])
        parts = []
        for group in _by_schema(commits):
            folders = [folder for commit in group for folder in commit.folders]
            if folders:
                rows = self.spark.read.schema(group[0].schema).parquet(*folders)
            else:
                rows = self.spark.createDataFrame([], group[0].schema)
            parts.append(rows.selectExpr(*_cells(united, group[0].schema)))
        return reduce(DataFrame.unionAll, parts)

    def read(self, layer: str, table: str) -> DataFrame | None:
        return self.read_commits(self.visible(layer, table))

    def consumed_runs(self, layer: str, table: str) -> set[str]:
        """Raw runs already taken into a table."""
        return {run for commit in self.commits(layer, table) for run in commit.consumed_runs}

    def create_database(self, name: str) -> None:
        """A catalog database whose own tables, if any, lie in the lake."""
        folder = f"{self.root}/catalog/{name}"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(name)} LOCATION '{folder}'")

    def _glob(self, paths: Sequence[str]) -> str:
        """One path expression for many folders."""
        if len(paths) == 1:
            return paths[0]
        return f"{self.root}/{{{','.join(path.removeprefix(self.root + '/') for path in paths)}}}"

    def expire_snapshots(self, layer: str, table: str, keep: int) -> list[str]:
        """Delete the folders of superseded snapshots, all but the ``keep`` latest ones.

        Their commit rows stay, so what the table has consumed is not forgotten.
        """
        snapshots = [c for c in self.commits(layer, table) if c.kind == "snapshot"]
        old, kept = snapshots[: -max(keep, 1)], snapshots[-max(keep, 1) :]
        needed = {folder for commit in kept for folder in commit.folders}
        gone = []
        for commit in old:
            if commit.buckets:
                self.spark.sql(f"DROP TABLE IF EXISTS {self._bucket_table(commit.path)}")
            shared = any(folder.startswith(f"{commit.path}/") for folder in needed)
            # a later snapshot may still point at some of its partitions
            gone += [f for f in commit.folders if f not in needed] if shared else [commit.path]
        gone = [folder for folder in dict.fromkeys(gone) if folder.startswith(self.root + "/")]
        for folder in gone:
            drop_folder(self.spark, folder)
        return gone

    def publish(self, database: str, layer: str, *tables: str) -> None:
        """Expose the current content of tables as ``database.table`` in the catalog."""
        self.create_database(database)
        commits = self.commits(layer, *tables)
        for table in tables:
            held = visible_part([c for c in commits if c.table == table])
            if held:
                self._publish(database, table, held)

    def _publish(self, database: str, table: str, commits: Sequence[Commit]) -> None:
        united = _united([commit.schema for commit in commits])
        selects = []
        for group in _by_schema(commits):
            cells = _cells(united, group[0].schema)
            folders = [folder for commit in group for folder in commit.folders]
            if folders:
                selects.append(f"SELECT {', '.join(cells)} FROM parquet.{_quoted(self._glob(folders))}")
            else:
                empty = _cells(united, T.StructType([]))
                selects.append(f"SELECT {', '.join(empty)} WHERE false")
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {_quoted(database)}.{_quoted(table)} AS "
            + " UNION ALL ".join(selects)
        )


def visible_part(commits: Sequence[Commit]) -> list[Commit]:
    """Of a table's commits the last snapshot and the parts appended after it."""
    starts = [i for i, commit in enumerate(commits) if commit.kind == "snapshot"]
    return list(commits[starts[-1] :] if starts else commits)


@lru_cache(maxsize=1024)
def _schema(text: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(text))


def _unique() -> str:
    return uuid.uuid4().hex[:12]


def _united(schemas: Sequence[T.StructType]) -> T.StructType:
    """All columns, each in the name and type of the latest folder that has it."""
    fields: dict[str, T.StructField] = {}
    for schema in schemas:
        for item in schema.fields:
            fields[item.name.lower()] = T.StructField(item.name, item.dataType, True)
    return T.StructType(list(fields.values()))


def _by_schema(commits: Sequence[Commit]) -> list[list[Commit]]:
    """Folders that were written with the same columns and types together."""
    groups: dict[tuple, list[Commit]] = {}
    for commit in commits:
        columns = tuple((item.name, item.dataType.json()) for item in commit.schema.fields)
        groups.setdefault(columns, []).append(commit)
    return list(groups.values())


def _cells(united: T.StructType, own: T.StructType) -> list[str]:
    """The united columns out of a folder's own; a value that its new type cannot hold fails."""
    held = {item.name.lower(): item for item in own.fields}
    cells = []
    for item in united.fields:
        name, kind = _quoted(item.name), item.dataType.simpleString()
        old = held.get(item.name.lower())
        if old is None:
            cells.append(f"CAST(NULL AS {kind}) AS {name}")
            continue
        value, was = _quoted(old.name), old.dataType.simpleString()
        if old.dataType != item.dataType:
            cast = f"TRY_CAST({value} AS {kind})"
            text = isinstance(old.dataType, T.StringType)
            sound = f"{cast} IS NOT NULL" if text else f"CAST({cast} AS {was}) <=> {value}"
            lost = f"raise_error(concat('{was} to {kind} loses ', string({value})))"
            value = f"IF({value} IS NULL OR {sound}, {cast}, {lost})"
        cells.append(f"{value} AS {name}")
    return cells


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
