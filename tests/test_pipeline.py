"""Whole runs over small feeds: meter readings (last or first wins) and tariffs (revisions)."""

from datetime import datetime, timezone
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from oreflow import Pipeline, Step, load_contract, parse_contract, read_steps, run_pipeline, run_steps
from oreflow.plans.lake import ConcurrentChange, Lake

METERS = {
    "landing": {"raw_table": "raw_meters", "pattern": "meters-*.csv"},
    "raw": {"table_name": "raw_meters"},
    "persistent": {
        "name": "readings",
        "target_table": "meters",
        "source_table": "raw_meters",
        "keys": ["site", "meter"],
        "data_quality_checks": [
            {"check": "NON_NEGATIVE", "column": "litres"},
            {"rule": "not_null", "columns": ["noted"]},
        ],
        "columns": [
            {"name": "site", "nullable": False},
            {"name": "meter", "type": "BIGINT"},
            {"name": "litres", "source": "reading", "type": "DECIMAL(12,3)"},
            {"name": "unit", "default": "l"},
            {"name": "noted", "type": "DATE"},
        ],
    },
    "quality": {"rules": [{"rule": "non_negative", "columns": ["meter", "elsewhere"]}]},
    "consumption": {"table": "by_site", "mapping": "SELECT site, sum(litres) AS litres FROM source.meters GROUP BY site"},
}
HEADER = "site,meter,reading,unit,noted\n"
MORNING = HEADER + (
    "N,1,10.5,l,2024-03-01\n"
    "N,2,11.25,,2024-03-01\n"
    "S,1,-4,l,2024-03-02\n"
    "S,x,9,l,2024-03-02\n"
    ",7,9,l,2024-03-02\n"
    "S,2,lots,l,2024-03-02\n"
    "S,3,8,l,\n"
    "N,1,12.5,m3,2024-03-05\n"
    "S,-9,1,l,2024-03-02\n"
)


def meters(**changes):
    return parse_contract({**METERS, "persistent": {**METERS["persistent"], **changes}})


def put(landing, name, text):
    (landing / name).write_text(text, encoding="utf-8")


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def state(done, *columns):
    return rows(done.lake.read("persistent", "meters"), *(columns or ("site", "meter", "litres")))


def n(text):
    return Decimal(text)


def test_layers_checks_and_audit(spark, make_context):
    put(make_context.landing, "meters-1.csv", MORNING)
    put(make_context.landing, "notes.csv", "a\n1\n")  # not of the pattern
    done = run_pipeline(spark, meters(), make_context("r1", quarantine=str(make_context.landing / "q")))
    assert state(done, "site", "meter", "litres", "unit") == [
        ("N", 1, n("12.500"), "m3"), ("N", 2, n("11.250"), "l")
    ]
    rejected = done.lake.read("persistent", "meters__quarantine")
    assert rows(rejected, "reject_reason", "reject_reasons") == sorted([
        ("data_quality_failed", ["non_negative(litres)"]),
        ("cast_failed", ["cast_failed(meter)", "not_null(meter)"]),
        ("data_quality_failed", ["not_null(site)"]),
        ("cast_failed", ["cast_failed(litres)"]),
        ("data_quality_failed", ["not_null(noted)"]),
        ("data_quality_failed", ["non_negative(meter)"]),
    ], key=repr)
    assert spark.table("consumption.by_site").collect() == [("N", n("23.750"))]
    records = spark.read.json(f"{done.context.quarantine_folder}/raw_meters/meters/*")
    assert rows(records.where("source.site = 'S' AND source.meter = '3'"), "mapped.litres", "reason") == [
        (8.0, "data_quality_failed")
    ]
    assert rows(done.control.runs(), "run_id", "status") == [("r1", "SUCCEEDED")]
    counts = done.control.read("row_counts")
    assert rows(counts, "layer", "inserted", "rejected") == [("persistent", 3, 6), ("raw", 9, 0)]
    assert done.control.read("processors").count() == 6
    assert rows(done.lake.manifest(), "source_table", "run_id") == [("raw_meters", "r1")]
    assert done.lake.ledger().count() == 1


def test_a_run_without_new_files_changes_nothing(spark, make_context):
    put(make_context.landing, "meters-1.csv", MORNING)
    first = run_pipeline(spark, meters(), make_context("r1"))
    before = sorted(first.lake.read("persistent", "meters").collect())
    again = run_pipeline(spark, meters(), make_context("r2"))
    assert sorted(again.lake.read("persistent", "meters").collect()) == before
    assert again.lake.read("raw", "raw_meters").count() == 9
    assert again.lake.read("persistent", "meters__quarantine").count() == 6
    assert again.context.previous_success is not None


def test_updates_keep_the_insert_time_and_nulls_overwrite(spark, make_context):
    days = [datetime(2024, 3, d, tzinfo=timezone.utc) for d in (1, 2)]
    contract = meters(data_quality_checks=[])
    put(make_context.landing, "meters-1.csv", HEADER + "N,1,5,l,2024-03-01\nN,2,6,l,2024-03-01\nS,1,7,l,2024-03-01\n")
    run_pipeline(spark, contract, make_context("r1", moment=days[0]))
    put(make_context.landing, "meters-2.csv", HEADER + "S,1,,l,\nS,2,1,l,2024-03-02\n")
    done = run_pipeline(spark, contract, make_context("r2", moment=days[1]))
    early, late = (day.replace(tzinfo=None) for day in days)
    assert state(done, "site", "meter", "litres", "run_id", "latest_insert_datetime", "latest_update_datetime") == [
        ("N", 1, n("5.000"), "r1", early, early),
        ("N", 2, n("6.000"), "r1", early, early),
        ("S", 1, None, "r2", early, late),
        ("S", 2, n("1.000"), "r2", late, late),
    ]


@pytest.mark.parametrize(("scope", "litres"), [("history", "5.000"), ("batch", "8.000")])
def test_first_of_a_raw_key_wins(spark, make_context, scope, litres):
    """Rows of one site and meter: the first of all runs counts, or the first of each."""
    contract = meters(deduplicate_by=["site", "meter"], dedup_scope=scope)
    put(make_context.landing, "meters-1.csv", HEADER + "N,1,5,l,2024-03-01\nN,1,6,l,2024-03-01\nS,4,-1,l,2024-03-01\nS,4,1,l,2024-03-01\n")
    done = run_pipeline(spark, contract, make_context("r1"))
    assert state(done) == [("N", 1, n("5.000"))]  # the invalid first row of S 4 hides the valid one
    put(make_context.landing, "meters-2.csv", HEADER + "N,1,8,l,2024-03-02\nN,1,9,l,2024-03-02\nN,3,2,l,2024-03-02\n")
    done = run_pipeline(spark, contract, make_context("r2"))
    assert state(done) == [("N", 1, n(litres)), ("N", 3, n("2.000"))]


def test_tables_without_keys_grow(spark, make_context):
    contract = meters(keys=[])
    for run in (1, 2):
        put(make_context.landing, f"meters-{run}.csv", HEADER + f"N,1,{run},l,2024-03-01\nN,1,{run},l,2024-03-01\n")
        done = run_pipeline(spark, contract, make_context(f"r{run}"))
    assert [litres for *_, litres in state(done)] == [n("1.000")] * 2 + [n("2.000")] * 2
    assert spark.table("source.meters").count() == 4


def test_overwrite_mode_keeps_the_last_delivery(spark, make_context):
    contract = meters(table_update_mode="overwrite")
    put(make_context.landing, "meters-1.csv", HEADER + "N,1,5,l,2024-03-01\n")
    run_pipeline(spark, contract, make_context("r1"))
    put(make_context.landing, "meters-2.csv", HEADER + "S,1,7,l,2024-03-02\nS,1,8,l,2024-03-02\n")
    assert state(run_pipeline(spark, contract, make_context("r2"))) == [("S", 1, n("8.000"))]


@pytest.mark.parametrize("layout", [{"buckets": 4}, {"partitions": 1}, {"partitions": 64}])
def test_layouts_merge_the_same_and_old_snapshots_go(spark, make_context, layout):
    put(make_context.landing, "meters-1.csv", HEADER + "".join(f"N,{i},1,l,2024-03-01\n" for i in range(20)))
    run_pipeline(spark, meters(**layout), make_context("r1"))
    put(make_context.landing, "meters-2.csv", HEADER + "N,3,2,l,2024-03-02\nS,1,2,l,2024-03-02\n")
    done = run_pipeline(spark, meters(**layout), make_context("r2", keep_snapshots=1))
    expected = [("N", i, n("2.000" if i == 3 else "1.000")) for i in range(20)] + [("S", 1, n("2.000"))]
    assert state(done) == sorted(expected, key=repr)
    assert rows(spark.table("source.meters"), "site", "meter", "litres") == sorted(expected, key=repr)
    _, current = done.lake.commits("persistent", "meters")
    assert current.rows == 21 and all(Path(folder).exists() for folder in current.folders)


def test_only_touched_partitions_are_written(spark, make_context):
    """Files of untouched partitions stay, and outlive the snapshot that wrote them."""
    contract = meters(partitions=32)
    put(make_context.landing, "meters-1.csv", HEADER + "".join(f"N,{i},1,l,2024-03-01\n" for i in range(200)))
    first = run_pipeline(spark, contract, make_context("r1")).lake.visible("persistent", "meters")[0]
    files = {f: f.stat().st_mtime_ns for folder in first.folders for f in Path(folder).glob("*.parquet")}
    assert len(first.leaves) == 32
    put(make_context.landing, "meters-2.csv", HEADER + "N,7,2,l,2024-03-02\n")
    done = run_pipeline(spark, contract, make_context("r2", keep_snapshots=1))
    second = done.lake.visible("persistent", "meters")[0]
    changed = {p for p, folder in second.leaves if folder not in dict(first.leaves).values()}
    assert len(changed) == 1 and len(second.leaves) == 32
    stay = [folder for p, folder in first.leaves if p not in changed]
    assert all(f.stat().st_mtime_ns == at for f, at in files.items() if str(f.parent) in stay)
    (gone,) = (folder for p, folder in first.leaves if p in changed)
    assert not Path(gone).exists()
    for run in (3, 4):  # the first snapshot is long superseded; its files are still the table's
        put(make_context.landing, f"meters-{run}.csv", HEADER + f"N,{run * 11},2,l,2024-03-02\n")
        done = run_pipeline(spark, contract, make_context(f"r{run}", keep_snapshots=1))
    assert len(state(done)) == 200
    assert [r for r in state(done) if r[2] == 2] == [("N", i, n("2.000")) for i in (33, 44, 7)]


def test_a_new_column_rewrites_the_table_once(spark, make_context):
    put(make_context.landing, "meters-1.csv", HEADER + "N,1,5,l,2024-03-01\nN,2,5,l,2024-03-01\n")
    run_pipeline(spark, meters(), make_context("r1"))
    wider = [*METERS["persistent"]["columns"], {"name": "reader"}]
    put(make_context.landing, "meters-2.csv", HEADER.strip() + ",reader\nN,2,6,l,2024-03-02,Ola\n")
    done = run_pipeline(spark, meters(columns=wider), make_context("r2"))
    assert state(done, "meter", "litres", "reader") == [(1, n("5.000"), None), (2, n("6.000"), "Ola")]


# --- Landing -------------------------------------------------------------------------


def test_known_files_are_not_opened_again(spark, make_context, monkeypatch):
    from oreflow.sources import files

    opened = []
    read = files.read_files
    monkeypatch.setattr(files, "read_files", lambda s, paths: opened.append(sorted(paths)) or read(s, paths))
    names = lambda: [[p.rsplit("/", 1)[-1] for p in paths] for paths in opened]
    put(make_context.landing, "meters-1.csv", MORNING)
    put(make_context.landing, "meters-2.csv", MORNING)  # a copy: read once, loaded never
    put(make_context.landing, "meters-3.csv", HEADER)
    run_pipeline(spark, meters(), make_context("r1"))
    run_pipeline(spark, meters(), make_context("r2"))
    assert names() == [["meters-1.csv", "meters-2.csv", "meters-3.csv"]]
    put(make_context.landing, "meters-2.csv", HEADER + "S,8,1,l,2024-03-02\n")  # changed in place
    put(make_context.landing, "meters-4.csv", MORNING)
    done = run_pipeline(spark, meters(), make_context("r3"))
    assert names()[1:] == [["meters-2.csv", "meters-4.csv"]]
    assert done.lake.read("raw", "raw_meters").count() == 10
    again = parse_contract({**METERS, "landing": {**METERS["landing"], "reread": True}})
    done = run_pipeline(spark, again, make_context("r4"))
    assert len(names()[-1]) == 4 and done.lake.read("raw", "raw_meters").count() == 10
    # the files of one table are new to another
    other = parse_contract({"landing": {"raw_table": "copies", "pattern": "meters-*.csv"}})
    assert run_pipeline(spark, other, make_context("r5")).lake.read("raw", "copies").count() == 10


def test_bad_bytes_do_not_stop_a_run(spark, make_context):
    (make_context.landing / "meters-1.csv").write_bytes(b"site,me\xffter\nN,1\xfe\n")
    contract = parse_contract({**METERS, "source": {"encoding": "US-ASCII"}, "persistent": [], "consumption": []})
    raw = run_pipeline(spark, contract, make_context("r1")).lake.read("raw", "raw_meters")
    assert [c for c in raw.columns if c.startswith("me")] == ["me�ter"] and raw.first()["site"] == "N"


@pytest.mark.parametrize("broken", range(5))
def test_a_run_that_breaks_off_anywhere_leaves_nothing_twice(spark, make_context, monkeypatch, broken):
    """Writes in their order: Raw, its quarantine, the landing quarantine, manifest, ledger; then the commit."""
    document = {
        **METERS,
        "raw": {
            "table_name": "raw_meters", "quarantine_table": "raw_meters__bad",
            "data_quality_checks": [{"rule": "is_integer", "columns": ["meter"]}],
        },
        "persistent": [],
        "consumption": [],
    }
    put(make_context.landing, "meters-1.csv", MORNING + "a,b,c,d,e,f\n")
    write, done = Lake.write_part, []

    def failing(self, *arguments, **options):
        if len(done) == broken:
            raise OSError("disk gone")
        done.append(write(self, *arguments, **options))
        return done[-1]

    monkeypatch.setattr(Lake, "write_part", failing)
    with pytest.raises(OSError):
        run_pipeline(spark, parse_contract(document), make_context("r1"))
    monkeypatch.undo()
    lake = run_pipeline(spark, parse_contract(document), make_context("r2")).lake
    assert lake.read("raw", "raw_meters").count() == 8
    assert lake.read("raw", "raw_meters__bad").count() == 1
    assert lake.read("landing", "raw_meters__landing_quarantine").count() == 1
    assert lake.ledger().count() == lake.manifest().count() == 1


def test_of_two_landings_of_the_same_files_one_is_refused(spark, make_context, monkeypatch):
    put(make_context.landing, "meters-1.csv", MORNING)
    contract = parse_contract({**METERS, "persistent": [], "consumption": []})
    record, other = Lake.record, []

    def second_run_first(self, *arguments):
        if not other:
            other.append(True)
            Pipeline(spark, contract, make_context("r2")).landing_to_raw()
        record(self, *arguments)

    monkeypatch.setattr(Lake, "record", second_run_first)
    with pytest.raises(ConcurrentChange):
        Pipeline(spark, contract, make_context("r1")).landing_to_raw()
    lake = Pipeline(spark, contract, make_context("r3")).lake
    assert rows(lake.read("raw", "raw_meters"), "run_id") == [("r2",)] * 9


def test_headers_that_lack_a_required_column(spark, make_context):
    """``required_columns`` is heard in the landing section itself too."""
    document = {**METERS, "landing": {**METERS["landing"], "required_columns": ["unit"]}, "persistent": [], "consumption": []}
    put(make_context.landing, "meters-1.csv", "site,meter\nN,1\n")
    put(make_context.landing, "meters-2.csv", "site,unit\nN,l\n")
    lake = run_pipeline(spark, parse_contract(document), make_context("r1")).lake
    assert lake.read("raw", "raw_meters").count() == 1
    bad = lake.read("landing", "raw_meters__landing_quarantine")
    assert rows(bad, "source_file_name", "reject_reason") == [("meters-1.csv", "required_column_missing")]


def test_files_without_a_named_raw_table(spark, make_context):
    table = lambda name: {"name": name, "target_table": name, "source_table": f"day.{name}", "columns": [{"name": "v"}]}
    put(make_context.landing, "day.mon.csv", "v,w\n1,x\n2,y\n")
    put(make_context.landing, "day.tue.csv", "w,v\nz,3\n")
    done = run_pipeline(spark, parse_contract({"persistent": [table("mon"), table("tue")]}), make_context("r1"))
    assert rows(done.lake.read("persistent", "mon"), "v") == [("1",), ("2",)]
    assert rows(done.lake.read("persistent", "tue"), "v") == [("3",)]
    counts = done.control.read("row_counts").where("layer = 'raw'")
    assert rows(counts, "table_name", "inserted") == [("day.mon", 2), ("day.tue", 1)]


# --- Revisions -----------------------------------------------------------------------


def tariffs(tmp_path, raw=None, **table):
    """A versioned feed with a key of two columns, as a tree of YAML files."""
    import yaml

    documents = {
        "raw": {
            "table": "raw_tariffs",
            "primary_keys": ["region", "code"],
            "version_column": "revision",
            "standardize": ["trim_whitespace", "cast_version_integer"],
            "incremental_key": ["region", "code", "revision"],
            "deduplicate_by": ["region", "code", "revision"],
            "select_latest_per_key": True,
            "record_hash_columns": "all",
            "data_quality_checks": [
                {"rule": "not_null", "columns": ["region", "code"]},
                {"rule": "is_integer", "column": "revision"},
            ],
            **(raw or {}),
        },
        "tariffs": {
            "table_name": "tariffs",
            "primary_keys": ["region", "code"],
            "deduplicate_by": ["region", "code", "revision"],
            "strategy": "scd1",
            "update_when": "incoming.revision > current.revision",
            "conflict_policy": "quarantine",
            "columns": [
                {"name": "region", "nullable": False},
                {"name": "code", "nullable": False},
                {"name": "revision", "type": "INTEGER", "nullable": False},
                {"name": "price", "type": "DECIMAL(8,2)"},
                {"name": "since", "source": "valid_from", "type": "DATE"},
            ],
            **table,
        },
        "feed": {
            "source": {"delimiter": ";", "file_pattern": "tariff_*.txt"},
            "landing": {
                "raw_table": "raw_tariffs",
                "preserve_source": True,
                "validation": {"exact_column_count": 6, "quarantine": "tariff_leftovers"},
            },
            "table_metadata": {"raw": "raw.yml", "persistent": "tariffs.yml"},
            "consumption": [{"name": "prices", "mapping": "SELECT code, max(price) AS top FROM source.tariffs GROUP BY code"}],
            "steps": [
                {"name": "in", "path": "layers.landing_to_raw"},
                {"name": "own", "path": "note", "depends_on": ["in"], "parameters": {"level": 3}},
                {"name": "merge", "path": "layers:raw_to_persistent", "depends_on": ["in", "own"]},
                {"name": "out", "path": "layers/persistent_to_consumption", "depends_on": ["merge"]},
            ],
        },
    }
    for name, document in documents.items():
        (tmp_path / f"{name}.yml").write_text(yaml.safe_dump(document), encoding="utf-8")
    return tmp_path / "feed.yml"


def tariff_file(*lines):
    return "region;code;revision;price;valid_from;note\n" + "".join(
        f"{region};{code};{revision};{price};2024-0{month}-01;{note}\n" for region, code, revision, price, month, note in lines
    )


def prices(done):
    return rows(done.lake.read("persistent", "tariffs"), "region", "code", "revision", "price")


def test_revisions_through_a_workflow_file(spark, make_context, tmp_path):
    path = tariffs(tmp_path)
    put(make_context.landing, "tariff_a.txt", tariff_file(
        ("w", "day", 3, 7, 1, "x"), ("w", "day", 2, 6, 1, "x"), (" e ", "day", "+04", 5, 1, "x"),
        ("e", "night", "old", 1, 1, "x"), ("", "night", 1, 1, 1, "x"),
    ) + "e;night;1\n")
    noted = []
    steps = read_steps(path, {"note": lambda p: noted.append(dict(p.context.parameters))})
    done = run_steps(spark, load_contract(path), make_context("r1"), steps)
    assert noted == [{"processor_name": "own", "level": 3}]
    assert prices(done) == [("e", "day", 4, n("5.00")), ("w", "day", 3, n("7.00"))]
    assert rows(done.lake.read("persistent", "tariffs"), "record_source", "source_file_name", "source_batch_id") == [
        ("raw_tariffs", "tariff_a.txt", "r1")
    ] * 2
    assert done.lake.read("landing", "raw_tariffs__landing").count() == 6
    assert rows(done.lake.read("landing", "tariff_leftovers"), "malformed_record", "source_row_number") == [("e;night;1", 6)]
    assert rows(spark.table("consumption.prices"), "code", "top") == [("day", n("7.00"))]
    assert {len(r.record_hash) for r in done.lake.read("raw", "raw_tariffs").collect()} == {64}
    put(make_context.landing, "tariff_b.txt", tariff_file(("w", "day", 1, 1, 2, "x"), ("e", "day", 9, 8, 2, "x"), ("n", "day", 1, 2, 2, "x")))
    done = run_steps(spark, load_contract(path), make_context("r2"), steps)
    assert prices(done) == [("e", "day", 9, n("8.00")), ("n", "day", 1, n("2.00")), ("w", "day", 3, n("7.00"))]
    moved = done.lake.read("persistent", "tariffs").where("region = 'e'").first()
    assert moved.persistent_insert_ts < moved.persistent_update_ts
    with pytest.raises(ValueError, match="comes before"):
        run_steps(spark, load_contract(path), make_context("r3"), steps[1:])


def test_other_content_of_a_revision_is_set_aside(spark, make_context, tmp_path):
    """The contract as it stands: Raw dedups and merges by (key, revision), and still no conflict is lost."""
    contract = load_contract(tariffs(tmp_path))
    put(make_context.landing, "tariff_a.txt", tariff_file(("w", "day", 2, 6, 1, "x"), ("e", "day", 1, 5, 1, "x")))
    run_pipeline(spark, contract, make_context("r1"))
    put(make_context.landing, "tariff_b.txt", tariff_file(
        ("w", "day", 2, 66, 1, "x"), ("e", "day", 2, 9, 1, "x"), ("n", "day", 1, 3, 1, "x"), ("n", "day", 1, 4, 1, "x"),
        ("s", "day", 1, 2, 1, "x"), ("s", "day", 1, 2, 1, "x"),
    ))
    done = run_pipeline(spark, contract, make_context("r2"))
    assert prices(done) == [("e", "day", 2, n("9.00")), ("s", "day", 1, n("2.00")), ("w", "day", 2, n("6.00"))]
    bad = done.lake.read("persistent", "tariffs__quarantine")
    assert rows(bad, "region", "price", "reject_reason") == [
        ("n", n("3.00"), "version_conflict"), ("n", n("4.00"), "version_conflict"), ("w", n("66.00"), "version_conflict"),
    ]
    counts = done.control.read("row_counts").where("run_id = 'r2'")
    assert rows(counts, "layer", "inserted", "rejected") == [("persistent", 2, 3), ("raw", 5, 0)]
    # what was set aside once, or says the same in what the table keeps, is no news
    put(make_context.landing, "tariff_c.txt", tariff_file(("w", "day", 2, 66, 1, "x"), ("w", "day", 2, 6, 1, "other note")))
    done = run_pipeline(spark, contract, make_context("r3"))
    assert done.lake.read("persistent", "tariffs__quarantine").count() == 3
    assert ("w", "day", 2, n("6.00")) in prices(done)


def test_without_the_policy_repeats_of_a_revision_are_dropped(spark, make_context, tmp_path):
    contract = load_contract(tariffs(tmp_path, conflict_policy=None))
    put(make_context.landing, "tariff_a.txt", tariff_file(("w", "day", 2, 6, 1, "x")))
    run_pipeline(spark, contract, make_context("r1"))
    put(make_context.landing, "tariff_b.txt", tariff_file(("w", "day", 2, 66, 1, "x"), ("e", "day", 1, 3, 1, "x")))
    done = run_pipeline(spark, contract, make_context("r2"))
    assert prices(done) == [("e", "day", 1, n("3.00")), ("w", "day", 2, n("6.00"))]
    assert done.lake.read("raw", "raw_tariffs").count() == 2


def test_marks_per_account(spark, make_context, tmp_path):
    """One key column: rows up to the committed revision are not counted as valid again."""
    raw = {
        "primary_keys": ["code"], "incremental_key": [], "deduplicate_by": [], "select_latest_per_key": False,
        "watermark": {"strategy": "per_account", "account_column": "code", "version_column": "revision"},
    }
    contract = load_contract(tariffs(tmp_path, raw, primary_keys=["code"], deduplicate_by=[], conflict_policy=None))
    put(make_context.landing, "tariff_a.txt", tariff_file(("w", "day", 5, 6, 1, "x"), ("w", "dusk", 5, 6, 1, "x")))
    run_pipeline(spark, contract, make_context("r1"))
    put(make_context.landing, "tariff_b.txt", tariff_file(("w", "day", 4, 1, 1, "x"), ("w", "dusk", 6, 7, 1, "x"), ("w", "noon", 1, 2, 1, "x")))
    done = run_pipeline(spark, contract, make_context("r2"))
    assert [r[1:] for r in prices(done)] == [("day", 5, n("6.00")), ("dusk", 6, n("7.00")), ("noon", 1, n("2.00"))]
    counts = done.control.read("row_counts").where("run_id = 'r2' AND layer = 'persistent'")
    assert rows(counts, "inserted") == [(2,)]


def test_rejects_of_raw(spark, make_context, tmp_path):
    contract = load_contract(tariffs(tmp_path, {"quarantine_table": "raw_tariffs__held"}))
    put(make_context.landing, "tariff_a.txt", tariff_file(("w", "day", "two", 6, 1, "x"), ("w", "day", 1, 6, 1, "x"), ("w", "", "", 6, 1, "x")))
    done = run_pipeline(spark, contract, make_context("r1"))
    assert rows(done.lake.read("raw", "raw_tariffs"), "code", "revision") == [("day", "1")]
    held = done.lake.read("raw", "raw_tariffs__held")
    assert rows(held, "reject_reasons") == [(["is_integer(revision)"],), (["not_null(code)"],)]


# --- Runs, steps, Consumption --------------------------------------------------------


def test_a_failed_run_is_recorded_and_repeated(spark, make_context):
    put(make_context.landing, "meters-1.csv", MORNING)
    broken = {**METERS, "consumption": {"name": "x", "mapping": "SELECT nowhere FROM source.meters"}}
    with pytest.raises(Exception, match="nowhere"):
        run_pipeline(spark, parse_contract(broken), make_context("r1"))
    done = run_pipeline(spark, meters(), make_context("r2"))
    states = {r["run_id"]: r for r in done.control.runs().collect()}
    assert states["r1"]["status"] == "FAILED" and "nowhere" in states["r1"]["error"]
    assert states["r2"]["status"] == "SUCCEEDED"
    assert done.lake.read("raw", "raw_meters").count() == 9


def test_steps_of_the_users_own(spark, make_context):
    put(make_context.landing, "meters-1.csv", HEADER + "N,1,5,l,2024-03-01\nS,1,6,l,2024-03-01\n")
    double = {"meters": lambda df, context: df.withColumn("litres", (F.col("litres") * context.parameters["by"]).cast("decimal(12,3)"))}
    steps = [
        Step("in", lambda p: p.landing_to_raw()),
        Step("merge", lambda p: p.raw_to_persistent(transforms=double), {"by": 2}, depends_on=["in"]),
    ]
    assert state(run_steps(spark, meters(), make_context("r1"), steps)) == [("N", 1, n("10.000")), ("S", 1, n("12.000"))]


def test_selected_tables(spark, make_context):
    pipeline = Pipeline(spark, meters(), make_context("r1"))
    with pytest.raises(ValueError, match="no table"):
        pipeline.raw_to_persistent(["persistent.elsewhere"])
    assert pipeline.raw_to_persistent(["persistent.meters"]) == {"meters": (0, 0)}


def test_consumption_scripts(spark, make_context, tmp_path):
    put(make_context.landing, "meters-1.csv", HEADER + "N,1,5,a;b,2024-03-01\nS,1,6,l,2024-03-01\n")
    script = "DROP TABLE IF EXISTS odd; CREATE TABLE odd AS SELECT site FROM source.meters WHERE unit = 'a;b' -- end"
    (tmp_path / "own.sql").write_text(script.replace("odd", "odder"), encoding="utf-8")
    items = [{"name": "one", "sql": script}, {"name": "two", "query_file": str(tmp_path / "own.sql")}]
    run_pipeline(spark, parse_contract({**METERS, "consumption": items}), make_context("r1", consumption_database="shown"))
    assert rows(spark.table("shown.odd"), "site") == rows(spark.table("shown.odder"), "site") == [("N",)]
    assert spark.catalog.currentDatabase() == "default"


def test_high_mark(spark, make_context):
    put(make_context.landing, "meters-1.csv", HEADER + "N,5,5,l,2024-03-01\nN,12,5,l,2024-03-01\n")
    done = run_pipeline(spark, meters(watermark_column="meter", watermark_type="INTEGER"), make_context("r1"))
    assert done.control.watermark("raw_meters") == "12"
    done.control.set_watermark("raw_meters", "13")
    assert done.control.watermark("raw_meters") == "13" and done.control.watermark("none") is None
