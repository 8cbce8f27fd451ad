"""Cases in which rows or values were once lost."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from oreflow import parse_contract, run_pipeline
from oreflow.plans.lake import ConcurrentChange, Lake

RAW = {"landing": {"raw_table": "raw_rain"}, "raw": {"table_name": "raw_rain"}}


def put(landing, name, content):
    (landing / name).write_bytes(content if isinstance(content, bytes) else content.encode())


def land(spark, make_context, contract, run="run-1"):
    return run_pipeline(spark, parse_contract(contract), make_context(run)).lake


def test_odd_headers(spark, make_context):
    put(make_context.landing, "a.csv", "\n\nday,mm\n1,5\n")
    put(make_context.landing, "b.csv", "day,mm\r2,6\r")
    put(make_context.landing, "c.csv", 'day,"at\nnoon",mm\n3,x,7\n')
    rows = land(spark, make_context, RAW).read("raw", "raw_rain")
    assert sorted((r.day, r.mm, r["at\nnoon"]) for r in rows.collect()) == [
        ("1", "5", None), ("2", "6", None), ("3", "7", "x")
    ]


def test_any_encoding(spark, make_context):
    contract = {**RAW, "source": {"encoding": "windows-1252"}}
    put(make_context.landing, "a.csv", "day,café\n1,naïve\n".encode("windows-1252"))
    assert land(spark, make_context, contract).read("raw", "raw_rain").first()["café"] == "naïve"


def test_surplus_cells_are_kept_in_quarantine(spark, make_context):
    put(make_context.landing, "a.csv", 'day,mm\n1,5\n2,6,7\n3\n"4,4",8\n')
    lake = land(spark, make_context, RAW)
    assert sorted(r.day for r in lake.read("raw", "raw_rain").collect()) == ["1", "3", "4,4"]
    (bad,) = lake.read("landing", "raw_rain__landing_quarantine").collect()
    assert (bad.malformed_record, bad.reject_reason) == ("2,6,7", "surplus_cells")


def test_equal_files_for_two_tables(spark, make_context):
    for name in ("jan.csv", "feb.csv"):
        put(make_context.landing, name, "day,mm\n1,5\n")
    lake = land(spark, make_context, {"landing": {}})
    assert lake.read("raw", "jan").count() == lake.read("raw", "feb").count() == 1
    lake = land(spark, make_context, {"landing": {}}, "run-2")
    assert lake.read("raw", "jan").count() == lake.read("raw", "feb").count() == 1


def test_parts_of_other_types_and_case(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    for run, rows in enumerate(("SELECT 7L AS mm, 'x' AS Site", "SELECT CAST(1.50 AS DECIMAL(18,2)) AS mm, 'y' AS site")):
        lake.record([lake.write_part("persistent", "rain", f"run-{run}", spark.sql(rows))])
    expected = [("1.50", "y"), ("7.00", "x")]
    lake.publish("losses", "persistent", "rain")
    for rows in (lake.read("persistent", "rain"), spark.table("losses.rain")):
        assert sorted((str(r.mm), r.site) for r in rows.collect()) == expected
    lake.record([lake.write_part("persistent", "rain", "run-2", spark.sql("SELECT 3L AS mm, 'z' AS site"))])
    with pytest.raises(Exception, match="loses"):
        lake.read("persistent", "rain").collect()


def test_watermark_is_typed_and_never_moves_back(spark, make_context):
    table = {
        "table_name": "rain", "source_table": "raw_rain", "primary_keys": ["day"],
        "watermark_column": "seq", "watermark_type": "INTEGER",
        "columns": [{"name": "day", "type": "INTEGER", "nullable": False}, {"name": "seq", "type": "TEXT"}],
    }
    contract = parse_contract({**RAW, "persistent": [table]})
    put(make_context.landing, "a.csv", "day,seq\n1,9\n2,10\n")
    done = run_pipeline(spark, contract, make_context("run-1"))
    assert done.control.watermark("raw_rain") == "10"
    put(make_context.landing, "b.csv", "day,seq\n3,3\n")
    done = run_pipeline(spark, contract, make_context("run-2"))
    assert done.control.watermark("raw_rain") == "10"


def test_lookback_counts_new_rows_only(spark, make_context):
    table = {
        "table_name": "rain", "source_table": "raw_rain", "primary_keys": ["day"],
        "columns": [{"name": "day", "type": "INTEGER", "nullable": False}],
    }
    contract = parse_contract({**RAW, "raw": {"table_name": "raw_rain", "lookback_days": 3}, "persistent": [table]})
    moment = datetime(2024, 1, 1, tzinfo=timezone.utc)
    put(make_context.landing, "a.csv", "day\n1\n2\n3\n")
    run_pipeline(spark, contract, make_context("run-1", moment=moment))
    put(make_context.landing, "b.csv", "day\n4\n")
    done = run_pipeline(spark, contract, make_context("run-2", moment=moment))
    counts = done.control.read("row_counts").where("layer = 'persistent' AND run_id = 'run-2'")
    assert [r.inserted for r in counts.select(F.col("inserted")).collect()] == [1]


def test_a_merge_refuses_a_table_that_changed_meanwhile(spark, make_context):
    table = {
        "table_name": "rain", "source_table": "raw_rain", "primary_keys": ["day"],
        "columns": [{"name": "day", "type": "INTEGER", "nullable": False}],
    }
    contract = parse_contract({**RAW, "persistent": [table]})
    put(make_context.landing, "a.csv", "day\n1\n")
    lake = run_pipeline(spark, contract, make_context("run-1")).lake

    def meddle(df, context):
        other = lake.read("persistent", "rain").withColumn("day", F.lit(99))
        lake.record([lake.write_snapshot("persistent", "rain", "other", other)])
        return df

    put(make_context.landing, "b.csv", "day\n2\n")
    with pytest.raises(ConcurrentChange):
        run_pipeline(spark, contract, make_context("run-2"), transforms={"rain": meddle})
    assert [r.day for r in lake.read("persistent", "rain").collect()] == [99]
    run_pipeline(spark, contract, make_context("run-3"))
    assert sorted(r.day for r in lake.read("persistent", "rain").collect()) == [2, 99]
