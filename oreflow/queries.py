"""One query per operator over the driver's tables, each with its SQL equivalent.

The tables play the part of a feed: their rows are turned to text where an
operator starts from text, and are split by date, status or label where it needs
an earlier and a later delivery.  Every query runs over its whole tables.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oreflow.contracts import (
    Check,
    ColumnSpec,
    ConsumptionSpec,
    LandingSpec,
    RawSpec,
    TableSpec,
    parse_contract,
)
from oreflow.functions.casts import contract_type, parse, parse_failed
from oreflow.functions.columns import without
from oreflow.functions.hashing import record_hash
from oreflow.operators import dedup, mapping, merge, quality, watermark
from oreflow.plans import consumption, control, merging, refine
from oreflow.plans.ingest import refine_raw
from oreflow.plans.lake import Lake
from oreflow.plans.pipeline import Context, Pipeline, run_pipeline
from oreflow.session import scratch_folder
from oreflow.sources import csv, files
from oreflow.streaming.incremental import csv_stream, upsert_stream

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

MOMENT = datetime(2024, 6, 1, 4, 0, tzinfo=timezone.utc)


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def money(name: str) -> Column:
    """A double column as exact text with two decimals."""
    return F.col(name).cast("decimal(18,2)").cast("string")


# --- Files, manifest and ledger -------------------------------------------------


def document_files(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(
        "doc_id",
        F.concat(F.lit("feed/"), "source", F.lit("/"), F.col("doc_id").cast("string")).alias("path"),
        files.content_checksum(F.col("text").cast("binary")).alias("checksum"),
        F.octet_length("text").cast("long").alias("size"),
        F.col("source").alias("source_table"),
    )


def labelled_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that were reviewed count as loaded before."""
    labels = table(spark, folder, "labels").select("doc_id")
    return document_files(spark, folder).join(labels, "doc_id", "left_semi").select("checksum")


FILES_SQL = """
WITH files AS (
  SELECT doc_id, 'feed/' || source || '/' || CAST(doc_id AS VARCHAR) AS path,
         sha256(text) AS checksum, octet_length(encode(text)) AS size, source AS source_table
  FROM documents),
ledger AS (SELECT checksum FROM files WHERE doc_id IN (SELECT doc_id FROM labels))
"""


@query(
    FILES_SQL
    + """
SELECT checksum, min(path) AS path FROM files
WHERE checksum NOT IN (SELECT checksum FROM ledger) GROUP BY checksum
"""
)
def file_ledger_antijoin(spark: SparkSession, folder: str) -> DataFrame:
    found = document_files(spark, folder).select("checksum", "path")
    return files.new_files(found, labelled_ledger(spark, folder)).select("checksum", "path")


@query(
    FILES_SQL
    + "SELECT path, checksum FROM files WHERE checksum IN (SELECT checksum FROM ledger)"
)
def file_ledger_membership(spark: SparkSession, folder: str) -> DataFrame:
    found = document_files(spark, folder).select("path", "checksum")
    return files.already_loaded(found, labelled_ledger(spark, folder)).select("path", "checksum")


@query(
    FILES_SQL
    + """
SELECT checksum, path, source_table FROM (
  SELECT *, row_number() OVER (PARTITION BY checksum ORDER BY path) AS n FROM files
  WHERE checksum NOT IN (SELECT checksum FROM ledger)) WHERE n = 1
"""
)
def file_ledger_insert(spark: SparkSession, folder: str) -> DataFrame:
    found = document_files(spark, folder).select("checksum", "path", "source_table")
    return files.ledger_rows(found, labelled_ledger(spark, folder))


@query(
    FILES_SQL
    + """
SELECT checksum FROM (
  SELECT *, row_number() OVER (PARTITION BY checksum ORDER BY path) AS n FROM files)
WHERE n = 1 AND source_table = 'src7'
"""
)
def ledger_by_table(spark: SparkSession, folder: str) -> DataFrame:
    found = document_files(spark, folder).select("checksum", "path", "source_table")
    empty = found.select("checksum").where(F.lit(False))
    return files.ledger_of(files.ledger_rows(found, empty), "src7")


@query(
    """
WITH earlier AS (
  SELECT 'doc/' || CAST(doc_id AS VARCHAR) AS path, octet_length(encode(text)) AS size,
         TIMESTAMP '2024-01-01' + n_chars * INTERVAL 1 SECOND AS modified, sha256(text) AS checksum
  FROM documents WHERE lang <> 'de'),
later AS (
  SELECT 'doc/' || CAST(doc_id AS VARCHAR) AS path,
         octet_length(encode(replace(text, chr(10) || chr(10), chr(10)))) AS size,
         TIMESTAMP '2024-01-01' + n_chars * INTERVAL 1 SECOND AS modified,
         sha256(replace(text, chr(10) || chr(10), chr(10))) AS checksum
  FROM documents)
SELECT l.path, l.size, l.checksum FROM later l LEFT JOIN earlier e ON l.path = e.path
WHERE e.path IS NULL OR l.size IS DISTINCT FROM e.size
   OR l.modified IS DISTINCT FROM e.modified OR l.checksum IS DISTINCT FROM e.checksum
"""
)
def manifest_changes(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")

    def entries(rows: DataFrame, text: Column) -> DataFrame:
        start = F.lit("2024-01-01").cast("timestamp_ntz")
        return rows.select(
            F.concat(F.lit("doc/"), F.col("doc_id").cast("string")).alias("path"),
            F.octet_length(text).cast("long").alias("size"),
            (start + F.make_dt_interval(secs=F.col("n_chars"))).alias("modified"),
            files.content_checksum(text.cast("binary")).alias("checksum"),
            F.col("doc_id").alias("processed_at"),
        )

    earlier = entries(documents.where("lang <> 'de'"), F.col("text"))
    later = entries(documents, F.replace("text", F.lit("\n\n"), F.lit("\n")))
    changed = files.changed_files(later.drop("processed_at"), files.current_manifest(earlier))
    return changed.select("path", "size", "checksum")


# --- CSV -------------------------------------------------------------------------


def deliver_csv(rows: DataFrame, folder: str, **options: str) -> None:
    writer = rows.write.mode("append").option("header", True).option("escape", '"')
    writer = writer.option("ignoreLeadingWhiteSpace", False)
    writer.option("ignoreTrailingWhiteSpace", False).options(**options).csv(folder)


def landed_rows(spark: SparkSession, folder: str, spec: LandingSpec, known=()) -> DataFrame:
    """All records of a landing folder, parsed once and numbered per file."""
    found = files.fingerprint(files.list_files(spark, folder, spec.pattern))
    listed = scratch_folder(spark, "files")
    found.write.parquet(listed)
    found = spark.read.schema(files.FILES_SCHEMA).parquet(listed)
    scanned = csv.scan(spark, found, spec, known)
    landed = scratch_folder(spark, "landed")
    scanned.write.parquet(landed)
    rows = spark.read.schema(scanned.schema).parquet(landed)
    return csv.number_rows(rows, found, scratch_folder(spark, "splits"))


@query(
    """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS o_totalprice,
       CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_orderpriority END AS o_orderpriority,
       strftime(o_orderdate, '%Y-%m') AS month,
       row_number() OVER (PARTITION BY strftime(o_orderdate, '%Y-%m') ORDER BY o_orderkey)
         AS source_row_number
FROM orders
"""
)
def csv_by_header_name(spark: SparkSession, folder: str) -> DataFrame:
    """One file a month; the later ones have another column order and one column more."""
    rows = table(spark, folder, "orders").withColumns(
        {"o_totalprice": money("o_totalprice"), "month": F.date_format("o_orderdate", "yyyy-MM")}
    )
    landing = scratch_folder(spark, "csv")
    late = F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")
    layouts = [
        (~late, ["o_orderkey", "o_custkey", "o_totalprice"]),
        (late, ["o_orderpriority", "o_totalprice", "o_custkey", "o_orderkey"]),
    ]
    for chosen, columns in layouts:
        monthly = rows.where(chosen).repartition("month").sortWithinPartitions("month", "o_orderkey")
        monthly = monthly.select(*columns, "month")
        writer = monthly.write.mode("append").option("header", True).partitionBy("month")
        writer.csv(landing)
    numbered = landed_rows(spark, f"{landing}/*", LandingSpec())
    return numbered.select(
        "o_orderkey",
        "o_custkey",
        "o_totalprice",
        "o_orderpriority",
        F.regexp_extract(f"{csv.FILE}.path", "month=([0-9-]+)", 1).alias("month"),
        "source_row_number",
    )


@query(
    """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, sha256(text) AS text_hash, lang, source FROM documents
"""
)
def csv_multiline_text(spark: SparkSession, folder: str) -> DataFrame:
    """Whole texts with line breaks, quotes and commas through CSV files."""
    landing = scratch_folder(spark, "csv")
    rows = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    deliver_csv(rows, landing)
    numbered = landed_rows(spark, landing, LandingSpec())
    return numbered.select("doc_id", F.sha2("text", 256).alias("text_hash"), "lang", "source")


@query(
    """
SELECT CAST(conv_id AS VARCHAR) AS conv_id,
       CASE WHEN role = 'assistant' OR turn > 0 THEN CAST(turn AS VARCHAR) END AS turn,
       CASE WHEN role = 'assistant' OR turn = 0 THEN 'malformed_record' END AS reason
FROM conversations
"""
)
def schema_contract(spark: SparkSession, folder: str) -> DataFrame:
    """Records with a cell too many or too few, marked by the landing contract."""
    rows = table(spark, folder, "conversations")
    cells = F.concat_ws(",", F.col("conv_id").cast("string"), F.col("turn").cast("string"), "role")
    line = (
        F.when(F.col("role") == "assistant", F.concat(cells, F.lit(",surplus")))
        .when(F.col("turn") == 0, F.col("conv_id").cast("string"))
        .otherwise(cells)
    )
    landing = scratch_folder(spark, "csv")
    deliver_csv(rows.select(line.alias("conv_id,turn,role")), landing, sep="\u0001")
    spec = LandingSpec(exact_column_count=3, required_columns=("conv_id", "turn"))
    numbered = landed_rows(spark, landing, spec)
    return numbered.select("conv_id", "turn", F.col(csv.REJECT).alias("reason"))


@query(
    """
SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS month, 1 AS deliveries FROM orders
WHERE o_orderdate >= TIMESTAMP '1998-01-01'
"""
)
def landing_discovery(spark: SparkSession, folder: str) -> DataFrame:
    """Files of a second delivery, after the first was loaded; its copies are skipped."""
    month = F.date_format("o_orderdate", "yyyy-MM")
    rows = table(spark, folder, "orders").select("o_orderkey", "o_custkey", month.alias("month"))
    landing = scratch_folder(spark, "csv")

    def deliver(delivery: DataFrame, name: str) -> DataFrame:
        monthly = delivery.repartition("month").sortWithinPartitions("month", "o_orderkey")
        writer = monthly.write.partitionBy("month").option("header", True)
        writer.csv(f"{landing}/{name}")
        return files.fingerprint(files.list_files(spark, f"{landing}/*/*", "*.csv"))

    earlier = rows.where(F.col("month") < "1998-01")
    ledger = scratch_folder(spark, "ledger")
    deliver(earlier, "first").select("checksum").write.parquet(ledger)
    found = files.new_files(deliver(rows, "second"), spark.read.parquet(ledger))
    delivered = F.regexp_extract("path", "month=([0-9-]+)", 1).alias("month")
    return found.groupBy(delivered).agg(F.count(F.lit(1)).cast("int").alias("deliveries"))


@query(
    """
WITH months AS (
  SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders GROUP BY 1)
SELECT run_id, count(*) AS files, CAST(sum(rows_in_raw) AS BIGINT) AS rows_in_raw FROM (
  SELECT CASE WHEN month < '1998-01' THEN 'run-1' ELSE 'run-2' END AS run_id, n AS rows_in_raw FROM months)
GROUP BY run_id
"""
)
def landing_second_run(spark: SparkSession, folder: str) -> DataFrame:
    """Three runs over a growing landing folder: files opened by each, and their rows in Raw.

    The second run opens the files that came since the first; the third opens none.
    """
    month = F.date_format("o_orderdate", "yyyy-MM")
    rows = table(spark, folder, "orders").select("o_orderkey", "o_custkey", month.alias("month"))
    landing, root = scratch_folder(spark, "csv"), scratch_folder(spark, "lake")
    contract = parse_contract({"landing": {"raw_table": "raw_orders"}})
    late = F.col("month") >= "1998-01"
    for run, delivery in (("run-1", rows.where(~late)), ("run-2", rows.where(late)), ("run-3", None)):
        if delivery is not None:
            monthly = delivery.repartition("month").sortWithinPartitions("month", "o_orderkey")
            monthly.write.mode("append").partitionBy("month").option("header", True).csv(landing)
        lake = landing_to_raw_of(spark, contract, run, f"{landing}/*", root)
    opened = lake.manifest().groupBy("run_id").agg(F.count(F.lit(1)).alias("files"))
    loaded = lake.read("raw", "raw_orders").groupBy("run_id").agg(F.count(F.lit(1)).alias("rows_in_raw"))
    return opened.join(loaded, "run_id")


def landing_to_raw_of(spark: SparkSession, contract, run_id: str, landing: str, root: str) -> Lake:
    pipeline = Pipeline(spark, contract, Context(run_id, landing, root, quarantine=f"{root}/quarantine"))
    pipeline.landing_to_raw()
    return pipeline.lake


# --- Raw -------------------------------------------------------------------------


@query(
    """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus,
       CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN 'run-1' ELSE 'run-2' END AS run_id,
       'local' AS environment, DATE '2024-06-01' AS arrival_date,
       TIMESTAMP '2024-06-01 04:00:00' AS latest_insert_datetime
FROM orders
"""
)
def raw_append_audit(spark: SparkSession, folder: str) -> DataFrame:
    """Two deliveries appended to a Raw table and read back together."""
    rows = table(spark, folder, "orders")
    lake = Lake(spark, scratch_folder(spark, "lake"))
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    deliveries = {"run-1": F.col("o_orderdate") < cut, "run-2": F.col("o_orderdate") >= cut}
    for run_id, chosen in deliveries.items():
        text = rows.where(chosen).select(
            F.col("o_orderkey").cast("string").alias("o_orderkey"), "o_orderstatus"
        )
        stamped = mapping.stamp(text, run_id, "local", MOMENT)
        stamped = stamped.withColumn("arrival_date", F.to_date(F.lit(MOMENT.date().isoformat())))
        lake.record([lake.write_part("raw", "orders", run_id, stamped, MOMENT.date().isoformat())])
    return lake.read("raw", "orders").select(
        "o_orderkey",
        "o_orderstatus",
        "run_id",
        "environment",
        "arrival_date",
        F.col("latest_insert_datetime").cast("timestamp_ntz").alias("latest_insert_datetime"),
    )


@query(
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag,
       sha256(concat_ws(chr(31), l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag,
                        l_linestatus)) AS record_hash
FROM lineitem
"""
)
def record_hashes(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem")
    hashed = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus"]
    return rows.select(*hashed[:5], record_hash(hashed).alias("record_hash"))


@query(
    """
WITH old AS (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem
             WHERE l_shipdate < TIMESTAMP '1998-01-01')
SELECT n.l_orderkey, n.l_linenumber, n.l_partkey, n.l_suppkey FROM lineitem n
WHERE n.l_shipdate >= TIMESTAMP '1998-01-01'
  AND NOT EXISTS (SELECT 1 FROM old o WHERE o.l_orderkey = n.l_orderkey
                  AND o.l_linenumber = n.l_linenumber)
"""
)
def raw_incremental_merge(spark: SparkSession, folder: str) -> DataFrame:
    earlier, later = shipped_halves(spark, folder)
    added = merge.absent_keys(later, earlier, ["l_orderkey", "l_linenumber"])
    return added.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


def shipped_halves(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, folder, "lineitem")
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    return rows.where(F.col("l_shipdate") < cut), rows.where(F.col("l_shipdate") >= cut)


@query(
    """
WITH feed AS (
  SELECT CAST(o_custkey AS VARCHAR) AS acct_id,
         CAST(year(o_orderdate) * 12 + month(o_orderdate) AS BIGINT) AS version, o_orderkey,
         o_orderdate, 'day-' || strftime(o_orderdate, '%d') AS file_name
  FROM orders),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY acct_id, version
             ORDER BY o_orderdate DESC, file_name DESC, o_orderkey DESC) AS n FROM feed),
latest AS (
  SELECT *, row_number() OVER (PARTITION BY acct_id ORDER BY version DESC) AS v
  FROM ranked WHERE n = 1)
SELECT acct_id, CAST(version AS VARCHAR) AS version, CAST(o_orderkey AS VARCHAR) AS o_orderkey,
       sha256(concat_ws(chr(31), acct_id, version, o_orderkey)) AS record_hash
FROM latest WHERE v = 1
"""
)
def raw_refinement(spark: SparkSession, folder: str) -> DataFrame:
    """Trim, plain version, hash, ranked dedup and latest version, as one Raw contract."""
    order = F.col("o_orderkey")
    moment = F.col("o_orderdate")
    version = (F.year(moment) * 12 + F.month(moment)).cast("string")
    feed = table(spark, folder, "orders").select(
        F.concat(F.lit("  "), F.col("o_custkey").cast("string")).alias("acct_id"),
        F.concat(F.lit("+0"), version, F.lit(" ")).alias("version"),
        order.cast("string").alias("o_orderkey"),
        moment.cast("timestamp").alias("source_file_modified_ts"),
        F.concat(F.lit("day-"), F.date_format(moment, "dd")).alias("source_file_name"),
        mapping.instant(MOMENT).alias("latest_insert_datetime"),
        F.lit("feed").alias("source_file_path"),
        order.alias("source_row_number"),
    )
    spec = RawSpec(
        standardize=("trim_whitespace", "cast_version_integer"),
        record_hash_columns=("all",),
        deduplicate_by=("acct_id", "version"),
        select_latest_per_key=True,
        keys=("acct_id",),
        version_column="version",
        checks=(Check("col_is_not_null", ("acct_id", "version")), Check("is_integer", ("version",))),
    )
    refined, _ = refine_raw(feed, spec)
    return refined.select("acct_id", "version", "o_orderkey", "record_hash")


# --- Mapping and casts -----------------------------------------------------------


@query(
    """
SELECT c_custkey AS customer_id, c_name AS name, CAST(c_acctbal AS DECIMAL(18,2)) AS balance,
       CAST(NULL AS VARCHAR) AS email, 'run-1' AS run_id, 'local' AS environment
FROM customer
"""
)
def map_columns(spark: SparkSession, folder: str) -> DataFrame:
    raw = table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("c_custkey"),
        "c_name",
        money("c_acctbal").alias("c_acctbal"),
        "c_mktsegment",
    )
    specs = [
        ColumnSpec("customer_id", "c_custkey", "INTEGER"),
        ColumnSpec("name", "c_name"),
        ColumnSpec("balance", "c_acctbal", "DECIMAL(18,2)"),
        ColumnSpec("email", "c_email"),
    ]
    mapped = mapping.map_columns(raw, specs)
    stamped = mapping.stamp(mapped, "run-1", "local", MOMENT)
    return stamped.select("customer_id", "name", "balance", "email", "run_id", "environment")


def dirty_text(spark: SparkSession, folder: str) -> DataFrame:
    """Every event with its numbers written the way feeds write them."""
    number, step = F.col("user_id").cast("string"), F.col("event_id") % 12
    forms = [
        number,
        F.concat(F.lit(" "), number, F.lit(" ")),
        F.concat(F.lit("+"), number),
        F.concat(F.lit("-"), number),
        F.concat(number, F.lit(".5")),
        F.concat(number, F.lit("e2")),
        F.concat(number, F.lit("_000")),
        F.concat(number, F.lit("abc")),
        F.lit(""),
        F.concat(number, F.lit("12345678901234567890")),
        F.concat(number, F.lit("d")),
        F.lit(None).cast("string"),
    ]
    text = forms[-1]
    for position, form in enumerate(forms[:-1]):
        text = F.when(step == position, form).otherwise(text)
    return table(spark, folder, "events").select("event_id", text.alias("text"))


DIRTY_SQL = """
WITH dirty AS (
  SELECT event_id, CASE event_id % 12
    WHEN 0 THEN n WHEN 1 THEN ' ' || n || ' ' WHEN 2 THEN '+' || n WHEN 3 THEN '-' || n
    WHEN 4 THEN n || '.5' WHEN 5 THEN n || 'e2' WHEN 6 THEN n || '_000' WHEN 7 THEN n || 'abc'
    WHEN 8 THEN '' WHEN 9 THEN n || '12345678901234567890' WHEN 10 THEN n || 'd' END AS text
  FROM (SELECT event_id, CAST(user_id AS VARCHAR) AS n FROM events)),
typed AS (
  SELECT event_id, text, nullif(text, '') AS as_text,
    CASE WHEN regexp_full_match(trim(text), '[+-]?[0-9]+')
         THEN TRY_CAST(replace(trim(text), '+', '') AS BIGINT) END AS as_integer,
    CASE WHEN regexp_full_match(trim(text), '[+-]?[0-9]+(\\.[0-9]*)?(e[0-9]+)?')
         THEN TRY_CAST(replace(trim(text), '+', '') AS DOUBLE) END AS as_real,
    CASE WHEN regexp_full_match(trim(text), '[+-]?[0-9]+(\\.[0-9]*)?')
         THEN TRY_CAST(replace(trim(text), '+', '') AS DECIMAL(18,2))
         WHEN regexp_full_match(text, '[0-9]+e2')
         THEN CAST(replace(text, 'e2', '00') AS DECIMAL(18,2)) END AS as_decimal
  FROM dirty)
"""


@query(DIRTY_SQL + "SELECT event_id, as_text, as_integer, as_real, as_decimal FROM typed")
def typed_cast(spark: SparkSession, folder: str) -> DataFrame:
    types = {
        "as_text": "TEXT",
        "as_integer": "INTEGER",
        "as_real": "REAL",
        "as_decimal": "DECIMAL(18,2)",
    }
    columns = [parse(F.col("text"), contract_type(t)).alias(n) for n, t in types.items()]
    return dirty_text(spark, folder).select("event_id", *columns)


@query(
    """
SELECT event_id, CAST(ts AS DATE) AS as_date, ts AS as_timestamp,
       event_type IN ('click', 'view') AS as_boolean,
       event_type = 'error' AS date_failed, event_type = 'error' AS boolean_failed
FROM (SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE ts END AS ts,
             CASE WHEN event_type = 'error' THEN NULL ELSE event_type END AS shown, event_type
      FROM events)
WHERE shown IS NOT NULL
UNION ALL
SELECT event_id, NULL, ts, NULL, TRUE, TRUE FROM events WHERE event_type = 'error'
"""
)
def typed_cast_dates(spark: SparkSession, folder: str) -> DataFrame:
    """Dates, timestamps and booleans; errors carry text that is neither."""
    bad = F.col("event_type") == "error"
    raw = table(spark, folder, "events").select(
        "event_id",
        F.when(bad, F.date_format("ts", "dd.MM.yyyy"))
        .otherwise(F.date_format("ts", "yyyy-MM-dd"))
        .alias("d"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("t"),
        F.when(bad, F.lit("maybe"))
        .otherwise(F.col("event_type").isin("click", "view").cast("string"))
        .alias("b"),
    )
    day, moment, flag = (contract_type(t) for t in ("DATE", "TIMESTAMP", "BOOLEAN"))
    return raw.select(
        "event_id",
        parse(F.col("d"), day).alias("as_date"),
        parse(F.col("t"), moment).cast("timestamp_ntz").alias("as_timestamp"),
        parse(F.col("b"), flag).alias("as_boolean"),
        parse_failed(F.col("d"), day).alias("date_failed"),
        parse_failed(F.col("b"), flag).alias("boolean_failed"),
    )


@query(
    DIRTY_SQL
    + """
SELECT CASE WHEN bad THEN NULL ELSE event_id END AS event_id,
       CASE WHEN bad THEN NULL ELSE as_integer END AS number, bad AS failed
FROM (SELECT *, coalesce(text <> '', FALSE) AND as_integer IS NULL AS bad FROM typed)
"""
)
def row_cast_failure(spark: SparkSession, folder: str) -> DataFrame:
    """One cell that does not parse empties its whole row."""
    raw = dirty_text(spark, folder).withColumn("event_id", F.col("event_id").cast("string"))
    specs = [ColumnSpec("event_id", "event_id", "INTEGER"), ColumnSpec("number", "text", "INTEGER")]
    mapped = mapping.map_columns(raw, specs)
    return mapped.withColumn("failed", F.col("event_id").isNull())


def labelled_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as raw text with their labels; most have none."""
    labels = table(spark, folder, "labels")
    return table(spark, folder, "documents").join(labels, "doc_id", "left").select(
        F.col("doc_id").cast("string").alias("doc_id"),
        "lang",
        F.col("quality").cast("string").alias("quality"),
        F.coalesce(F.col("toxic").cast("string"), F.lit("")).alias("toxic"),
    )


@query(
    """
SELECT d.doc_id, coalesce(l.quality, 0) AS quality, coalesce(l.toxic, -1) AS toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""
)
def column_default(spark: SparkSession, folder: str) -> DataFrame:
    specs = [
        ColumnSpec("doc_id", "doc_id", "INTEGER", nullable=False),
        ColumnSpec("quality", "quality", "INTEGER", default=0),
        ColumnSpec("toxic", "toxic", "INTEGER", default=-1),
    ]
    return mapping.map_columns(labelled_documents(spark, folder), specs)


# --- Quality ---------------------------------------------------------------------


@query(
    """
SELECT d.doc_id, concat_ws(',', CASE WHEN l.quality IS NULL THEN 'not_null(quality)' END,
                          CASE WHEN l.toxic IS NULL THEN 'not_null(toxic)' END) AS reasons
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""
)
def dq_not_null(spark: SparkSession, folder: str) -> DataFrame:
    """A declared NOT NULL and an inherited rule, as reasons per row."""
    spec = TableSpec(
        name="labels",
        source_table="raw_labels",
        target_table="labels",
        columns=(
            ColumnSpec("doc_id", "doc_id", "INTEGER"),
            ColumnSpec("quality", "quality", "INTEGER", nullable=False),
            ColumnSpec("toxic", "toxic", "INTEGER"),
        ),
        checks=(Check("col_is_not_null", ("quality", "toxic")),),
    )
    checked = quality.check_rows(labelled_documents(spark, folder), spec)
    return checked.select("doc_id", F.concat_ws(",", quality.REASONS).alias("reasons"))


@query(
    """
WITH raw AS (SELECT event_id, trim(replace(replace(props, '{"k":', ''), '}', '')) AS k,
                    CAST(CAST(value AS DECIMAL(18,2)) - 5 AS VARCHAR) AS v FROM events)
SELECT event_id, concat_ws(',',
    CASE WHEN k <> '' AND NOT regexp_full_match(k, '[+-]?[0-9]+') THEN 'is_integer(k)' END,
    CASE WHEN v <> '' AND NOT regexp_full_match(v, '[+-]?[0-9]+') THEN 'is_integer(v)' END,
    CASE WHEN CAST(v AS DECIMAL(18,2)) < 0 THEN 'non_negative(v)' END) AS reasons
FROM raw
"""
)
def dq_integer_non_negative(spark: SparkSession, folder: str) -> DataFrame:
    k = F.replace(F.replace("props", F.lit('{"k":'), F.lit("")), F.lit("}"), F.lit(""))
    v = (F.col("value").cast("decimal(18,2)") - 5).cast("decimal(18,2)").cast("string")
    raw = table(spark, folder, "events").select("event_id", k.alias("k"), v.alias("v"))
    raw = mapping.trim_text(raw)
    checks = [Check("is_integer", ("k", "v")), Check("non_negative", ("v",))]
    reasons = quality.reason_list(quality.text_reasons(raw, checks))
    return raw.select("event_id", F.concat_ws(",", reasons).alias("reasons"))


LINES = TableSpec(
    name="lines",
    source_table="raw_lines",
    target_table="lines",
    columns=(
        ColumnSpec("order_id", "l_orderkey", "INTEGER", nullable=False),
        ColumnSpec("line", "l_linenumber", "INTEGER", nullable=False),
        ColumnSpec("part_id", "l_partkey", "INTEGER"),
        ColumnSpec("quantity", "quantity", "DECIMAL(18,2)"),
        ColumnSpec("price", "price", "DECIMAL(18,2)"),
        ColumnSpec("tax", "tax", "DECIMAL(18,2)", nullable=False),
    ),
    checks=(Check("non_negative", ("price",)),),
)


def raw_lines(spark: SparkSession, folder: str, *extra: Column) -> DataFrame:
    """Line items as text: some quantities carry a unit, taxes are blank, prices negative."""
    unit = (F.col("l_linestatus") == "F") & (F.col("l_discount") == 0)
    refund = (F.col("l_returnflag") == "R") & (F.col("l_tax") == 0.08)
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    return table(spark, folder, "lineitem").select(
        *[F.col(k).cast("string").alias(k) for k in keys],
        F.when(unit, F.concat(money("l_quantity"), F.lit(" pcs")))
        .otherwise(money("l_quantity"))
        .alias("quantity"),
        F.when(refund, F.concat(F.lit("-"), money("l_extendedprice")))
        .otherwise(money("l_extendedprice"))
        .alias("price"),
        F.when(F.col("l_tax") == 0, F.lit("")).otherwise(money("l_tax")).alias("tax"),
        *extra,
    )


LINES_SQL = """
WITH flags AS (
  SELECT *, l_linestatus = 'F' AND l_discount = 0 AS unit, l_tax = 0 AS blank,
         l_returnflag = 'R' AND l_tax = 0.08 AND l_extendedprice > 0 AS refund
  FROM lineitem),
checked AS (
  SELECT *, concat_ws(',', CASE WHEN unit THEN 'cast_failed(quantity)' END,
                      CASE WHEN blank THEN 'not_null(tax)' END,
                      CASE WHEN refund THEN 'non_negative(price)' END) AS reasons
  FROM flags)
"""


@query(
    LINES_SQL
    + """
SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber,
       CASE WHEN unit THEN NULL ELSE l_orderkey END AS order_id,
       CASE WHEN unit THEN 'cast_failed' ELSE 'data_quality_failed' END AS reason, reasons
FROM checked WHERE reasons <> ''
"""
)
def valid_reject_split(spark: SparkSession, folder: str) -> DataFrame:
    _, rejected = quality.split(quality.check_rows(raw_lines(spark, folder), LINES))
    return rejected.select(
        f"{quality.RECORD}.l_orderkey",
        f"{quality.RECORD}.l_linenumber",
        "order_id",
        F.col(quality.REASON).alias("reason"),
        F.concat_ws(",", quality.REASONS).alias("reasons"),
    )


@query(
    LINES_SQL
    + """
SELECT l_orderkey AS order_id, l_linenumber AS line, l_partkey AS part_id,
       CAST(l_quantity AS DECIMAL(18,2)) AS quantity, CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
       CAST(l_tax AS DECIMAL(18,2)) AS tax
FROM checked WHERE reasons = ''
"""
)
def valid_rows(spark: SparkSession, folder: str) -> DataFrame:
    valid, _ = quality.split(quality.check_rows(raw_lines(spark, folder), LINES))
    return valid


@query(
    LINES_SQL
    + """
SELECT CAST(l_orderkey AS VARCHAR) AS source_order, CAST(l_suppkey AS VARCHAR) AS source_supplier,
       CASE WHEN unit THEN NULL ELSE l_linenumber END AS mapped_line,
       CASE WHEN unit THEN 'cast_failed' ELSE 'data_quality_failed' END AS reason,
       6 AS mapped_fields
FROM checked WHERE reasons <> ''
"""
)
def quarantine_json(spark: SparkSession, folder: str) -> DataFrame:
    """Rejected rows written as JSON lines and read back; nulls are kept in the text."""
    _, rejected = quality.split(quality.check_rows(raw_lines(spark, folder), LINES))
    context = Context("run-1", scratch_folder(spark, "landing"), "unused")
    path = refine.write_quarantine_json(rejected, LINES, context)
    line = F.col("value")
    return spark.read.text(path).select(
        F.get_json_object(line, "$.source.l_orderkey").alias("source_order"),
        F.get_json_object(line, "$.source.l_suppkey").alias("source_supplier"),
        F.get_json_object(line, "$.mapped.line").cast("int").alias("mapped_line"),
        F.get_json_object(line, "$.reason").alias("reason"),
        F.size(F.json_object_keys(F.get_json_object(line, "$.mapped"))).alias("mapped_fields"),
    )


@query(
    LINES_SQL
    + """
SELECT 'returns_' || l_returnflag AS table_name, count(*) FILTER (WHERE reasons = '') AS inserted,
       count(*) FILTER (WHERE reasons <> '') AS rejected
FROM checked GROUP BY ALL
"""
)
def row_count_audit(spark: SparkSession, folder: str) -> DataFrame:
    target = F.concat(F.lit("returns_"), F.col("l_returnflag")).alias("target")
    checked = quality.check_rows(raw_lines(spark, folder, target), LINES, carried=["target"])
    return control.row_counts(checked, "target", quality.REJECTED)


# --- Dedup -----------------------------------------------------------------------

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = [
    "l_shipdate",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
]
LINE_ORDER_SQL = ", ".join(LINE_ORDER)


@query(
    f"""
SELECT * EXCLUDE (n) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY {LINE_ORDER_SQL}) AS n FROM lineitem)
WHERE n = 1
"""
)
def dedup_first_wins(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.first_wins(table(spark, folder, "lineitem"), LINE_KEY, LINE_ORDER)


@query(
    f"""
WITH later AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY {LINE_ORDER_SQL}) AS n
  FROM lineitem WHERE l_shipdate >= TIMESTAMP '1998-01-01')
SELECT * EXCLUDE (n) FROM later WHERE n = 1 AND NOT EXISTS (
  SELECT 1 FROM lineitem o WHERE o.l_shipdate < TIMESTAMP '1998-01-01'
  AND o.l_orderkey = later.l_orderkey AND o.l_linenumber = later.l_linenumber)
"""
)
def dedup_history(spark: SparkSession, folder: str) -> DataFrame:
    """First wins over all deliveries, computed for the later delivery only."""
    earlier, later = shipped_halves(spark, folder)
    first = dedup.first_wins(later, LINE_KEY, LINE_ORDER)
    return dedup.unseen_keys(first, earlier, LINE_KEY)


def versioned_orders(spark: SparkSession, folder: str) -> DataFrame:
    month = F.year("o_orderdate") * 12 + F.month("o_orderdate")
    return table(spark, folder, "orders").withColumn("version", month.cast("long"))


VERSIONED_SQL = """
WITH versioned AS (
  SELECT *, CAST(year(o_orderdate) * 12 + month(o_orderdate) AS BIGINT) AS version FROM orders)
"""


@query(
    VERSIONED_SQL
    + """
SELECT * EXCLUDE (n) FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey, version
             ORDER BY o_orderdate DESC, o_orderpriority DESC, o_orderkey DESC) AS n FROM versioned)
WHERE n = 1
"""
)
def dedup_ranked(spark: SparkSession, folder: str) -> DataFrame:
    ranking = [F.col(c).desc() for c in ("o_orderdate", "o_orderpriority", "o_orderkey")]
    return dedup.ranked_dedup(versioned_orders(spark, folder), ["o_custkey", "version"], ranking)


@query(
    VERSIONED_SQL
    + """
SELECT * EXCLUDE (n) FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY version DESC, o_orderkey DESC) AS n
  FROM versioned)
WHERE n = 1
"""
)
def latest_per_key(spark: SparkSession, folder: str) -> DataFrame:
    return dedup.latest_per_key(
        versioned_orders(spark, folder), ["o_custkey"], ["version", "o_orderkey"]
    )


# --- Merges ----------------------------------------------------------------------

EVENT_CUT = "2024-01-16"


def event_halves(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, folder, "events").withColumn("inserted_at", F.col("ts"))
    cut = F.lit(EVENT_CUT).cast("timestamp_ntz")
    return rows.where(F.col("ts") < cut), rows.where(F.col("ts") >= cut)


UPSERT_SQL = """
SELECT user_id, event_id, ts, event_type, value, inserted_at FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n,
         min(ts) OVER (PARTITION BY user_id) AS inserted_at FROM events)
WHERE n = 1
"""
UPSERT_COLUMNS = ["user_id", "event_id", "ts", "event_type", "value", "inserted_at"]


@query(UPSERT_SQL)
def upsert_last_wins(spark: SparkSession, folder: str) -> DataFrame:
    """Two deliveries merged in turn; the first insert time of a key is kept."""
    earlier, later = event_halves(spark, folder)
    order, kept = ["ts", "event_id"], ["inserted_at"]
    state = dedup.latest_per_key(earlier, ["user_id"], order, first_of=kept)
    return merge.upsert(state, later, ["user_id"], order, kept).select(*UPSERT_COLUMNS)


@query(
    """
WITH lines AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                      ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) AS n FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM lines WHERE n = 1
"""
)
def upsert_composite_key(spark: SparkSession, folder: str) -> DataFrame:
    earlier, later = shipped_halves(spark, folder)
    columns = [*LINE_KEY, "l_partkey", "l_suppkey", "l_shipdate"]
    order = ["l_shipdate", "l_partkey", "l_suppkey"]
    state = dedup.latest_per_key(earlier.select(*columns), LINE_KEY, order)
    return merge.upsert(state, later.select(*columns), LINE_KEY, order)


@query(
    """
SELECT l_orderkey, l_linenumber, count(*) AS count FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
"""
)
def key_uniqueness(spark: SparkSession, folder: str) -> DataFrame:
    return merge.duplicate_keys(table(spark, folder, "lineitem"), LINE_KEY)


@query("SELECT event_id, ts, user_id, event_type, value, props, ts AS inserted_at FROM events")
def append_keyless(spark: SparkSession, folder: str) -> DataFrame:
    return merge.append(*event_halves(spark, folder))


@query(UPSERT_SQL)
def partition_upsert(spark: SparkSession, folder: str) -> DataFrame:
    """The two deliveries through a table in hash partitions, each a commit of its own."""
    lake = Lake(spark, scratch_folder(spark, "lake"))
    order, kept = ["ts", "event_id"], ["inserted_at"]
    for number, delivery in enumerate(event_halves(spark, folder)):
        merging.merge_into(
            lake,
            "last_events",
            f"run-{number}",
            delivery,
            ["user_id"],
            8,
            lambda state, rows: merge.upsert(state, rows, ["user_id"], order, kept),
        )
    return lake.read("persistent", "last_events").select(*UPSERT_COLUMNS)


@query(
    VERSIONED_SQL
    + """
, ranked AS (
  SELECT *, o_orderstatus = 'F' AS held, row_number() OVER (
    PARTITION BY o_custkey, o_orderstatus = 'F' ORDER BY version DESC, o_orderkey DESC) AS n
  FROM versioned),
chosen AS (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY version DESC, held DESC) AS c
  FROM ranked WHERE n = 1)
SELECT o_custkey, version, o_orderkey, o_orderstatus, o_totalprice,
       CASE WHEN held THEN 'table' ELSE 'delivery' END AS record_source
FROM chosen WHERE c = 1
"""
)
def scd1_version_merge(spark: SparkSession, folder: str) -> DataFrame:
    """Finished orders are the table, the others arrive; only a higher version replaces."""
    rows = versioned_orders(spark, folder)
    columns = ["o_custkey", "version", "o_orderkey", "o_orderstatus", "o_totalprice"]
    held = F.col("o_orderstatus") == "F"
    target = rows.where(held).select(*columns, F.lit("table").alias("record_source"))
    target = dedup.latest_per_key(target, ["o_custkey"], ["version", "o_orderkey"])
    arriving = rows.where(~held).select(*columns, F.lit("delivery").alias("record_source"))
    return merge.scd1_merge(target, arriving, ["o_custkey"], "version", ["o_orderkey"])


CONFLICT_SQL = """
WITH hashed AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         sha256(concat_ws(chr(31), l_partkey, l_suppkey, l_returnflag, l_linestatus)) AS h
  FROM lineitem),
clash AS (SELECT l_orderkey, l_linenumber FROM hashed GROUP BY ALL HAVING count(DISTINCT h) > 1)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
"""
CONFLICT_COMPARED = ["l_partkey", "l_suppkey", "l_returnflag", "l_linestatus"]


@query(CONFLICT_SQL + "SEMI JOIN clash USING (l_orderkey, l_linenumber)")
def conflict_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem")
    marked = merge.mark_conflicts(rows, ["l_orderkey"], "l_linenumber", CONFLICT_COMPARED)
    return marked.where(merge.CONFLICT).select(*LINE_KEY, "l_partkey", "l_suppkey")


@query(CONFLICT_SQL + "ANTI JOIN clash USING (l_orderkey, l_linenumber)")
def conflict_free_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "lineitem")
    marked = merge.mark_conflicts(rows, ["l_orderkey"], "l_linenumber", CONFLICT_COMPARED)
    return marked.where(f"NOT {merge.CONFLICT}").select(*LINE_KEY, "l_partkey", "l_suppkey")


# --- Watermarks ------------------------------------------------------------------


@query(
    """
SELECT event_id, user_id, ts FROM events
WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-16')
"""
)
def watermark_table(spark: SparkSession, folder: str) -> DataFrame:
    """Set after the earlier delivery, stored, read back, and used as a filter."""
    earlier, _ = event_halves(spark, folder)
    tables = control.ControlTables(spark, scratch_folder(spark, "control"))
    mark = watermark.high_mark(earlier, "ts").select(F.col("value").cast("string")).first()[0]
    tables.set_watermark("events", mark)
    rows = table(spark, folder, "events").select("event_id", "user_id", "ts")
    return watermark.beyond(rows, "ts", datetime.fromisoformat(tables.watermark("events")))


@query(
    """
WITH marks AS (SELECT user_id, max(ts) AS mark FROM events WHERE event_type = 'purchase' GROUP BY ALL)
SELECT e.event_id, e.user_id, e.ts FROM events e LEFT JOIN marks m ON e.user_id = m.user_id
WHERE m.mark IS NULL OR e.ts > m.mark
"""
)
def watermark_per_key(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").select("event_id", "user_id", "ts", "event_type")
    marks = scratch_folder(spark, "marks")
    bought = rows.where("event_type = 'purchase'")
    watermark.marks_per_key(bought, ["user_id"], "ts").write.parquet(marks)
    stored = spark.read.parquet(marks)
    return watermark.beyond_marks(rows.drop("event_type"), stored, ["user_id"], "ts")


@query("SELECT user_id, max(ts) AS mark FROM events GROUP BY user_id")
def watermark_advance(spark: SparkSession, folder: str) -> DataFrame:
    earlier, later = event_halves(spark, folder)
    marks = watermark.marks_per_key(earlier, ["user_id"], "ts")
    return watermark.advance_marks(
        marks, watermark.marks_per_key(later, ["user_id"], "ts"), ["user_id"]
    )


@query(
    """
SELECT event_id, CAST(ts AS DATE) AS arrival_date FROM events
WHERE CAST(ts AS DATE) >= DATE '2024-01-15'
"""
)
def watermark_lookback(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "events").select(
        "event_id", F.col("ts").cast("date").alias("arrival_date")
    )
    return watermark.since(rows, "arrival_date", watermark.lookback_start(date(2024, 1, 16), 1))


# --- Audit -----------------------------------------------------------------------


def run_events(spark: SparkSession, folder: str) -> DataFrame:
    """Events as run states: errors failed, purchases succeeded, the rest is running."""
    status = (
        F.when(F.col("event_type") == "error", "FAILED")
        .when(F.col("event_type") == "purchase", "SUCCEEDED")
        .otherwise("RUNNING")
    )
    rows = table(spark, folder, "events").withColumn("status", status)
    ended = F.when(F.col("status") != "RUNNING", F.col("ts"))
    return rows.select(
        F.col("user_id").alias("run_id"), "status", ended.alias("ended_at"), "event_id",
        F.struct("ts", "event_id").alias("recorded_at"),
    )


RUNS_SQL = """
WITH runs AS (
  SELECT user_id AS run_id, CASE event_type WHEN 'error' THEN 'FAILED'
           WHEN 'purchase' THEN 'SUCCEEDED' ELSE 'RUNNING' END AS status,
         CASE WHEN event_type IN ('error', 'purchase') THEN ts END AS ended_at, event_id,
         row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n
  FROM events)
"""


@query(RUNS_SQL + "SELECT run_id, status, ended_at, event_id FROM runs WHERE n = 1")
def run_audit_current(spark: SparkSession, folder: str) -> DataFrame:
    return control.current_runs(run_events(spark, folder)).drop("recorded_at")


@query(RUNS_SQL + "SELECT max(ended_at) AS ended_at FROM runs WHERE n = 1 AND status = 'SUCCEEDED'")
def run_audit_last_success(spark: SparkSession, folder: str) -> DataFrame:
    return control.last_success(control.current_runs(run_events(spark, folder)))


@query(
    """
SELECT user_id AS run_id, event_type AS processor, 'SUCCEEDED' AS status,
       CAST(epoch(max(ts)) - epoch(min(ts)) AS BIGINT) AS seconds
FROM (SELECT user_id, event_type, date_trunc('second', ts) AS ts FROM events) GROUP BY ALL
"""
)
def processor_audit(spark: SparkSession, folder: str) -> DataFrame:
    """First and last event of a user and type as start and end of a processor."""
    moment = F.date_trunc("second", F.col("ts").cast("timestamp"))
    spans = table(spark, folder, "events").groupBy("user_id", "event_type").agg(
        F.min(moment).alias("started_at"), F.max(moment).alias("ended_at")
    )
    events = spans.select(
        F.col("user_id").alias("run_id"),
        F.col("event_type").alias("processor"),
        F.lit("SUCCEEDED").alias("status"),
        "started_at",
        "ended_at",
    )
    durations = control.processor_durations(events)
    return durations.withColumn("seconds", F.col("seconds").cast("long"))


# --- Consumption -----------------------------------------------------------------

def attached(spark: SparkSession, folder: str, text: str) -> tuple[Lake, Context]:
    """The tables a statement reads, as Persistent tables visible as ``source.<table>``."""
    root = scratch_folder(spark, "lake")
    lake = Lake(spark, root)
    names = sorted(set(re.findall(r"source\.(\w+)", text)))
    lake.attach("persistent", {name: f"{folder}/{name}.parquet" for name in names})
    lake.publish("source", "persistent", *names)
    return lake, Context("run-1", f"{root}/landing", root)


REFRESH_SQL = """
SELECT c.c_mktsegment, n.n_name, count(*) AS customers,
       sum(CAST(c.c_acctbal AS DECIMAL(18,2))) AS balance
FROM {s}customer c JOIN {s}nation n ON c.c_nationkey = n.n_nationkey
GROUP BY c.c_mktsegment, n.n_name
"""


@query(REFRESH_SQL.format(s=""))
def consumption_refresh(spark: SparkSession, folder: str) -> DataFrame:
    text = REFRESH_SQL.format(s="source.")
    lake, context = attached(spark, folder, text)
    item = ConsumptionSpec("balances", "balances", mapping=text + ";")
    nothing = parse_contract({})
    consumption.refresh(lake, item, nothing, context)
    consumption.refresh(lake, item, nothing, context)  # a full refresh replaces
    return lake.read("consumption", "balances")


# Consumption SQL is plain SQL: the same text runs on both sides.
CONSUMPTION_SQL = {
    "consumption_sql_join_group": """
SELECT n.n_name, year(o.o_orderdate) AS order_year, count(DISTINCT c.c_custkey) AS buyers,
       count(*) AS lines,
       sum(CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l.l_discount AS DECIMAL(18,2))))
         AS revenue
FROM {s}lineitem l JOIN {s}orders o ON l.l_orderkey = o.o_orderkey
JOIN {s}customer c ON o.o_custkey = c.c_custkey
JOIN {s}nation n ON c.c_nationkey = n.n_nationkey
GROUP BY n.n_name, year(o.o_orderdate) HAVING count(*) > 10
""",
    "consumption_sql_window": """
WITH yearly AS (
  SELECT c.c_nationkey, year(o.o_orderdate) AS order_year, count(*) AS orders,
         sum(CAST(o.o_totalprice AS DECIMAL(18,2))) AS total
  FROM {s}orders o JOIN {s}customer c ON o.o_custkey = c.c_custkey
  GROUP BY c.c_nationkey, year(o.o_orderdate))
SELECT c_nationkey, order_year, orders,
       rank() OVER (PARTITION BY order_year ORDER BY total DESC) AS place,
       lag(orders) OVER (PARTITION BY c_nationkey ORDER BY order_year) AS year_before,
       sum(total) OVER (PARTITION BY c_nationkey ORDER BY order_year
                        ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS moving
FROM yearly
""",
    "consumption_sql_set_operations": """
(SELECT o_custkey AS id FROM {s}orders WHERE o_orderstatus = 'F'
 EXCEPT SELECT o_custkey FROM {s}orders WHERE o_orderstatus = 'P')
UNION ALL
(SELECT c_custkey FROM {s}customer WHERE c_acctbal < 0
 INTERSECT SELECT o_custkey FROM {s}orders)
""",
    "consumption_sql_semi_anti": """
SELECT c.c_custkey, c.c_name, CASE WHEN EXISTS (
         SELECT 1 FROM {s}orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'P')
       THEN 'open' ELSE 'closed' END AS state
FROM {s}customer c
WHERE c.c_nationkey IN (SELECT s_nationkey FROM {s}supplier)
  AND NOT EXISTS (SELECT 1 FROM {s}orders o WHERE o.o_custkey = c.c_custkey
                  AND o.o_totalprice > 450000)
""",
    "consumption_sql_rollup": """
SELECT l_returnflag, l_linestatus, grouping(l_linestatus) AS all_states, count(*) AS lines,
       sum(CAST(l_quantity AS DECIMAL(18,2))) AS quantity
FROM {s}lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)
""",
    "consumption_sql_top_k": """
SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(18,2)) AS price FROM {s}orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 100
""",
    "consumption_sql_time_buckets": """
SELECT user_id, date_trunc('day', ts) AS day, count(*) AS events,
       count(*) FILTER (WHERE event_type = 'purchase') AS purchases, max(ts) AS last_seen,
       sum(CAST(value AS DECIMAL(18,2))) AS total
FROM {s}events GROUP BY user_id, date_trunc('day', ts)
""",
}


def consumption_sql(text: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        statement = text.format(s="source.")
        attached(spark, folder, statement)
        return spark.sql(statement)

    return run


for _name, _text in CONSUMPTION_SQL.items():
    QUERIES[_name] = consumption_sql(_text)
    ORACLES[_name] = _text.format(s="")


@query("SELECT c_mktsegment, count(*) AS customers FROM customer WHERE c_acctbal > 0 GROUP BY ALL")
def consumption_statements(spark: SparkSession, folder: str) -> DataFrame:
    """A script of several statements against the Consumption database."""
    lake, context = attached(spark, folder, "source.customer")
    name = "rich_" + context.lake_root[-8:]
    script = (
        f"DROP TABLE IF EXISTS {name}; CREATE TABLE {name} USING parquet "
        f"LOCATION '{context.lake_root}/consumption/{name}' AS "
        "SELECT * FROM source.customer WHERE c_acctbal > 0;"
    )
    consumption.refresh(lake, ConsumptionSpec("rich", None, sql=script), parse_contract({}), context)
    return spark.table(f"consumption.{name}").groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("customers")
    )


# --- Whole pipelines -------------------------------------------------------------

CUSTOMER_CONTRACT = {
    "landing": {"raw_table": "raw_customers", "pattern": "*.csv"},
    "raw": {
        "table_name": "raw_customers",
        "data_quality_checks": [{"rule": "col_is_not_null", "columns": ["customer_id"]}],
    },
    "persistent": {
        "table": "customers",
        "primary_keys": ["customer_id"],
        "deduplicate_by": ["c_custkey"],
        "data_quality_checks": [{"rule": "non_negative", "columns": ["balance"]}],
        "columns": [
            {"name": "customer_id", "source": "c_custkey", "type": "INTEGER", "nullable": False},
            {"name": "nation_id", "source": "c_nationkey", "type": "INTEGER"},
            {"name": "balance", "source": "c_acctbal", "type": "DECIMAL(18,2)"},
            {"name": "segment", "source": "c_mktsegment"},
        ],
    },
    "consumption": {
        "table": "segment_balances",
        "mapping": "SELECT segment, nation_id, count(*) AS customers, sum(balance) AS balance "
        "FROM source.customers GROUP BY segment, nation_id",
    },
}


def customer_feed(spark: SparkSession, folder: str) -> str:
    """The customers as CSV files, every record delivered twice."""
    landing = scratch_folder(spark, "landing")
    rows = table(spark, folder, "customer").withColumn("c_acctbal", money("c_acctbal"))
    deliver_csv(rows, landing)
    deliver_csv(rows.select(*reversed(rows.columns)), landing)
    return landing


@query(
    """
SELECT lower(c_mktsegment) AS segment, CAST(c_nationkey AS BIGINT) AS nation_id,
       count(*) AS customers, sum(CAST(c_acctbal AS DECIMAL(18,2))) AS balance
FROM customer WHERE c_acctbal >= 0 GROUP BY ALL
"""
)
def layers_custom_step(spark: SparkSession, folder: str) -> DataFrame:
    """Landing to Consumption over CSV files, with one step of the user's own."""
    context = Context("run-1", customer_feed(spark, folder), scratch_folder(spark, "lake"))
    steps = {"customers": lambda df, _: df.withColumn("segment", F.lower("segment"))}
    done = run_pipeline(spark, parse_contract(CUSTOMER_CONTRACT), context, transforms=steps)
    return done.lake.read("consumption", "segment_balances")


@query(
    """
SELECT c_custkey AS customer_id, CAST(c_acctbal AS DECIMAL(18,2)) AS balance,
       'data_quality_failed' AS reason
FROM customer WHERE c_acctbal < 0
"""
)
def layers_quarantine(spark: SparkSession, folder: str) -> DataFrame:
    context = Context("run-1", customer_feed(spark, folder), scratch_folder(spark, "lake"))
    done = run_pipeline(spark, parse_contract(CUSTOMER_CONTRACT), context)
    rejected = done.lake.read("persistent", "customers__quarantine")
    return rejected.select("customer_id", "balance", F.col(quality.REASON).alias("reason"))


@query(UPSERT_SQL)
def incremental_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Two deliveries of CSV files through a stream that stops when all is taken."""
    landing, checkpoint = scratch_folder(spark, "landing"), scratch_folder(spark, "stream")
    lake = Lake(spark, scratch_folder(spark, "lake"))
    names = ["event_id", "ts", "user_id", "event_type", "value"]

    def typed(batch: DataFrame) -> DataFrame:
        specs = [
            ColumnSpec("event_id", "event_id", "INTEGER"),
            ColumnSpec("ts", "ts", "TIMESTAMP"),
            ColumnSpec("user_id", "user_id", "INTEGER"),
            ColumnSpec("event_type", "event_type"),
            ColumnSpec("value", "value", "REAL"),
        ]
        mapped = mapping.map_columns(batch, specs)
        mapped = mapped.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
        return mapped.withColumn("inserted_at", F.col("ts"))

    for delivery in event_halves(spark, folder):
        text = delivery.withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        deliver_csv(text.select(*names), landing)
        upsert_stream(
            csv_stream(spark, landing, names),
            lake,
            "last_events",
            ["user_id"],
            ["ts", "event_id"],
            checkpoint,
            typed,
            ["inserted_at"],
        ).awaitTermination()
    return lake.read("persistent", "last_events").select(*UPSERT_COLUMNS)
