"""Files and CSV: discovery, hashing, headers, dialect, row numbers."""

import hashlib

import pytest
from pyspark.sql import functions as F

from oreflow.contracts import LandingSpec
from oreflow.session import scratch_folder
from oreflow.sources import csv, files


def landed(spark, folder, spec=LandingSpec(), known=(), **hashing):
    listed = files.list_files(spark, str(folder), spec.pattern)
    found = scratch_folder(spark, "files")
    files.fingerprint(listed, **hashing).write.parquet(found)
    found = spark.read.schema(files.FILES_SCHEMA).parquet(found)
    scanned = csv.scan(spark, found, spec, known)
    path = scratch_folder(spark, "landed")
    scanned.write.parquet(path)
    rows = spark.read.schema(scanned.schema).parquet(path)
    return csv.number_rows(rows, found, scratch_folder(spark, "splits"))


def values(df, *columns):
    rows = df.orderBy(f"{csv.FILE}.name", "source_row_number").select(*columns).collect()
    return [tuple(row) for row in rows]


def test_discovery_lists_only_the_folder_itself(spark, tmp_path):
    (tmp_path / "b.csv").write_text("x\n1\n")
    (tmp_path / "a b.csv").write_text("x\n1\n")
    (tmp_path / "c.txt").write_text("x\n1\n")
    for inner in ("quarantine", "k=v"):
        (tmp_path / inner).mkdir()
        (tmp_path / inner / "d.csv").write_text("x\n")
    listed = files.list_files(spark, str(tmp_path), "*.csv")
    assert sorted(r["name"] for r in listed.collect()) == ["a b.csv", "b.csv"]
    assert files.list_files(spark, str(tmp_path / "nowhere"), "*.csv") is None
    assert files.list_files(spark, str(tmp_path), "*.tsv").count() == 0


@pytest.mark.parametrize("whole_file_bytes", [10**9, 0])
def test_fingerprint_in_one_piece_and_streamed(spark, tmp_path, whole_file_bytes):
    texts = {"a b.csv": 'x,"y"\n1,2\n', "b.csv": "p,q\r\n3,4", "long.csv": "a" * 10_000, "c.csv": "p\n \n"}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text.encode())
    listed = files.list_files(spark, str(tmp_path), "*.csv")
    found = {r["name"]: r for r in files.fingerprint(listed, whole_file_bytes).collect()}
    assert len(found) == 4
    for name, text in texts.items():
        assert found[name]["checksum"] == hashlib.sha256(text.encode()).hexdigest()
        assert found[name]["size"] == len(text)
        assert found[name]["header"].rstrip("\r") == text.split("\n")[0].rstrip("\r")
        assert found[name]["splittable"] == ('"' not in text and "\n " not in text)


def test_dialect(spark, tmp_path):
    text = '﻿a,b\r\n1,2\r\n\r\n"x\ny","q""r"\r\n" s ", t \r\n,\r\n'
    (tmp_path / "f.csv").write_bytes(text.encode("utf-8"))
    assert values(landed(spark, tmp_path), "a", "b", "source_row_number") == [
        ("1", "2", 1), ("x\ny", 'q"r', 2), (" s ", " t ", 3), ("", "", 4),
    ]


def test_columns_bind_by_name_and_missing_ones_are_null(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "2.csv").write_text("b,a\n2,1\n")
    (tmp_path / "3.csv").write_text("a,b,c\n1,2,3\n")
    (tmp_path / "4.csv").write_text("b\n2\n")
    assert values(landed(spark, tmp_path), "a", "b", "c") == [
        ("1", "2", None), ("1", "2", None), ("1", "2", "3"), (None, "2", None),
    ]


def test_short_and_long_records(spark, tmp_path):
    (tmp_path / "f.csv").write_text("a,b\n3\n4,5,6\n7,8\n")
    assert values(landed(spark, tmp_path), "a", "b", csv.REJECT) == [
        ("3", None, None), ("4", "5", "surplus_cells"), ("7", "8", None),
    ]
    strict = LandingSpec(exact_column_count=2)
    assert values(landed(spark, tmp_path, strict), csv.REJECT, csv.MALFORMED) == [
        ("malformed_record", "3"), ("malformed_record", "4,5,6"), (None, None),
    ]


def test_header_contract(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a,b\n1,2\n")
    (tmp_path / "2.csv").write_text("a,c\n1,2\n")
    (tmp_path / "3.csv").write_text("a\n1\n")
    spec = LandingSpec(exact_column_count=2, required_columns=("a",), reject_unknown_columns=True)
    assert values(landed(spark, tmp_path, spec, ["a", "b"]), csv.REJECT) == [
        (None,), ("unknown_column",), ("column_count",),
    ]
    assert csv.header_problem(["b"], LandingSpec(required_columns=("a",))) == (
        "required_column_missing"
    )


def test_empty_file_and_reserved_and_repeated_names(spark, tmp_path):
    (tmp_path / "1.csv").write_text("a,b\n")
    (tmp_path / "2.csv").write_text("a,run_id,a\n1,mine,2\n")
    rows = landed(spark, tmp_path)
    assert values(rows, "a") == [("2",)]  # of repeated names the last counts
    assert "run_id" not in rows.columns
    assert csv.header_names('﻿"a,1";b\r', ";") == ["a,1", "b"]


@pytest.mark.parametrize("multi_line", [None, True, False])
def test_row_numbers_over_many_splits(spark, tmp_path, multi_line):
    """Files cut into many splits, and many files packed into one task."""
    counts = {"big": 20_000, **{f"small{i}": i for i in range(1, 12)}}
    for name, count in counts.items():
        lines = "".join(f"{i},{'v' * (i % 40)}\n" for i in range(1, count + 1))
        (tmp_path / f"{name}.csv").write_text("n,v\n" + lines)
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "32768")
    try:
        rows = landed(spark, tmp_path, LandingSpec(multi_line=multi_line))
        blocks = rows.select(csv.URI, csv.BLOCK).distinct().count()
        wrong = rows.where(F.col("n").cast("long") != F.col("source_row_number")).count()
        found = {
            r["name"]: r["count"]
            for r in rows.groupBy(F.col(f"{csv.FILE}.name").alias("name")).count().collect()
        }
    finally:
        spark.conf.set(key, before)
    assert wrong == 0
    assert found == {f"{name}.csv": count for name, count in counts.items()}
    assert (blocks > len(counts)) == (multi_line is not True)


def test_row_numbers_by_shuffle_instead_of_copy(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(csv, "COPIED_SPLITS", 0)
    (tmp_path / "a.csv").write_text("n\n1\n2\n3\n")
    (tmp_path / "b.csv").write_text("n\n1\n2\n")
    assert values(landed(spark, tmp_path), "n", "source_row_number") == [
        ("1", 1), ("2", 2), ("3", 3), ("1", 1), ("2", 2),
    ]


def test_other_delimiter_and_declared_line_mode(spark, tmp_path):
    (tmp_path / "f.csv").write_text('a;b\n1;"2;3"\n')
    spec = LandingSpec(delimiter=";", multi_line=False)
    assert values(landed(spark, tmp_path, spec), "a", "b") == [("1", "2;3")]


def test_lines_of_blanks_are_records(spark, tmp_path):
    (tmp_path / "f.csv").write_text("a,b\n1,2\n  \n\n3,4\n")
    (tmp_path / "g.csv").write_text("a\n \nx\n")
    assert values(landed(spark, tmp_path), "a", "b", "source_row_number") == [
        ("1", "2", 1), ("  ", None, 2), ("3", "4", 3), (" ", None, 1), ("x", None, 2),
    ]


def test_latin1(spark, tmp_path):
    (tmp_path / "f.csv").write_bytes("größe,b\né,2\n".encode("latin-1"))
    spec = LandingSpec(encoding="ISO-8859-1")
    for limit in (10**9, 0):
        rows = landed(spark, tmp_path, spec, whole_file_bytes=limit, encoding="ISO-8859-1")
        assert values(rows, "größe", "b") == [("é", "2")]


def test_ledger_and_manifest(spark):
    schema = "path string, size long, modified long, checksum string"
    now = spark.createDataFrame(
        [("a", 1, 1, "x"), ("b", 1, 1, "x"), ("c", 2, 1, "y"), ("d", 3, 1, "z")], schema
    )
    ledger = spark.createDataFrame([("y", "t_1"), ("w", "tx1")], "checksum string, source_table string")
    assert sorted(r["path"] for r in files.new_files(now, ledger).collect()) == ["a", "d"]
    assert sorted(r["path"] for r in files.already_loaded(now, ledger).collect()) == ["c"]
    assert [r[0] for r in files.ledger_of(ledger, "t_1").collect()] == ["y"]
    entries = "path string, size long, modified long, checksum string, processed_at long"
    manifest = spark.createDataFrame(
        [("a", 1, 0, "x", 1), ("a", 1, 1, "x", 2), ("b", 1, 0, "x", 1), ("c", 2, 1, None, 1)], entries
    )
    changed = files.changed_files(now, files.current_manifest(manifest))
    assert sorted(r["path"] for r in changed.collect()) == ["b", "c", "d"]


def test_same_content_is_loaded_once_and_empty_files_are_ledgered(spark, make_context):
    from oreflow import landing_to_raw, parse_contract
    from oreflow.plans.lake import Lake

    landing = make_context.landing
    (landing / "a.csv").write_text("n\n1\n")
    (landing / "b.csv").write_text("n\n1\n")
    (landing / "e.csv").write_text("n\n")
    contract = parse_contract({"landing": {"raw_table": "raw"}})
    assert landing_to_raw(spark, contract, make_context("r1")) == 1
    (landing / "c.csv").write_text("n\n1\n")
    assert landing_to_raw(spark, contract, make_context("r2")) == 0
    (landing / "d.csv").write_text("n,m\n2,x\n")
    assert landing_to_raw(spark, contract, make_context("r3", process_date="2024-05-06T01:02")) == 1
    lake = Lake(spark, make_context("r4").lake_root)
    raw = lake.read("raw", "raw")
    found = {r["n"]: r for r in raw.collect()}
    assert found["1"]["m"] is None and found["2"]["m"] == "x"
    assert str(found["2"]["arrival_date"]) == "2024-05-06"
    assert found["1"]["source_file_name"] == "a.csv" and found["1"]["source_file_size"] == 4
    assert lake.ledger().count() == 3
