"""Operators on small inputs, against plain Python where that says more."""

import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from oreflow.contracts import Check, ColumnSpec, TableSpec
from oreflow.functions.hashing import record_hash
from oreflow.operators import dedup, mapping, merge, quality, watermark
from oreflow.plans import control


def rows(df, *columns):
    columns = columns or df.columns
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def make(spark, data, schema):
    return spark.createDataFrame(data, schema)


def feed(seed, count=400, hot=0.35):
    """(key, version, order, value): one key holds a third of all rows."""
    rng = random.Random(seed)
    found = []
    for order in range(count):
        key = 0 if rng.random() < hot else rng.randint(1, 60)
        found.append((key, rng.randint(1, 5), order, rng.choice(["a", "b", None])))
    return found


FEED = "key long, version long, ord long, value string"


@pytest.mark.parametrize("parts", [1, 7])
def test_first_wins_is_independent_of_placement(spark, parts):
    data = feed(1)
    expected = {}
    for key, version, order, value in data:
        expected.setdefault(key, (key, version, order, value))
    random.Random(2).shuffle(data)
    df = make(spark, data, FEED).repartition(parts)
    assert rows(dedup.first_wins(df, ["key"], ["ord"])) == sorted(expected.values(), key=repr)


def test_dedup_keys_treat_missing_as_empty(spark):
    df = make(spark, [(None, 1), ("", 2), ("x", 3), (None, 4)], "k string, ord long")
    assert rows(dedup.first_wins(df, ["k"], ["ord"]), "ord") == [(1,), (3,)]
    history = make(spark, [("",)], "k string")
    assert rows(dedup.unseen_keys(df, history, ["k"]), "ord") == [(3,)]
    # A key column a file never had counts as empty too.
    assert rows(dedup.first_wins(df, ["k", "absent"], ["ord"]), "ord") == [(1,), (3,)]


def upserted(state, data, keep_first):
    """Row by row, as a keyed table would take it."""
    table = {row[0]: row for row in state}
    for row in data:
        first = table.get(row[0], row)[keep_first]
        changed = list(row)
        changed[keep_first] = first
        table[row[0]] = tuple(changed)
    return sorted(table.values(), key=repr)


@pytest.mark.parametrize("seed", [3, 4])
def test_upsert_equals_row_by_row(spark, seed):
    early, late = feed(seed)[:150], feed(seed)[150:]
    schema = FEED + ", latest_insert_datetime long"
    stamp = lambda data, run: [(*row, run * 1000 + row[2]) for row in data]
    early, late = stamp(early, 1), stamp(late, 2)
    start = upserted([], early, 4)
    expected = upserted(start, late, 4)
    shuffled = random.Random(seed).sample(late, len(late))
    found = merge.upsert(
        make(spark, start, schema), make(spark, shuffled, schema).repartition(5), ["key"], ["ord"]
    )
    assert rows(found) == expected
    empty = make(spark, [], schema)
    assert rows(merge.upsert(empty, make(spark, early, schema), ["key"], ["ord"])) == start


def test_null_overwrites_and_null_never_matches_a_side(spark):
    target = make(spark, [(1, "a"), (2, None)], "key long, value string")
    incoming = make(spark, [(1, None, 1), (3, None, 1)], "key long, value string, ord long")
    assert rows(merge.upsert(target, incoming, ["key"], ["ord"])) == [(1, None), (2, None), (3, None)]


@pytest.mark.parametrize("seed", [5, 6])
def test_scd1_equals_row_by_row(spark, seed):
    early, late = feed(seed)[:60], feed(seed)[60:]

    def merged(table, data):
        # The last of the equal versions of one delivery counts.
        best = {}
        for row in data:
            if row[0] not in best or row[1] >= best[row[0]][1]:
                best[row[0]] = row
        for key, row in best.items():
            if key not in table or row[1] > table[key][1]:
                table[key] = row
        return table

    start = merged({}, early)
    expected = sorted(merged(dict(start), late).values(), key=repr)
    found = merge.scd1_merge(
        make(spark, list(start.values()), FEED),
        make(spark, late, FEED).repartition(3),
        ["key"],
        "version",
        ["ord"],
    )
    assert rows(found) == expected


def test_conflicts(spark):
    schema = "key long, version long, value string"
    incoming = make(
        spark, [(1, 1, "a"), (1, 1, "a"), (2, 1, "a"), (2, 1, "b"), (3, 1, "z"), (4, 1, None)], schema
    )
    current = make(spark, [(3, 1, "a"), (4, 1, None), (1, 2, "q")], schema)
    compared = ["key", "version", "value"]
    marked = merge.mark_conflicts(incoming, ["key"], "version", compared, current)
    sound = marked.where(f"NOT {merge.CONFLICT}").drop(merge.CONFLICT)
    clashes = marked.where(merge.CONFLICT).drop(merge.CONFLICT)
    assert rows(clashes) == [(2, 1, "a"), (2, 1, "b"), (3, 1, "z")]
    assert rows(sound) == [(1, 1, "a"), (1, 1, "a"), (4, 1, None)]


def test_record_hash_tells_null_from_empty(spark):
    df = make(spark, [("a", None), ("a", ""), ("", "a"), ("a", None)], "x string, y string")
    hashes = [r[0] for r in df.select(record_hash(["x", "y"])).collect()]
    assert len(set(hashes)) == 3 and hashes[0] == hashes[3]


def test_absent_and_duplicate_keys(spark):
    incoming = make(spark, [(1, 1), (1, 2), (2, 1), (2, 1)], "a long, v long")
    existing = make(spark, [(1, 1), (1, 1)], "a long, v long")
    assert rows(merge.absent_keys(incoming, existing, ["a", "v"])) == [(1, 2), (2, 1), (2, 1)]
    assert rows(merge.duplicate_keys(incoming, ["a", "v"])) == [(2, 1, 2)]


def test_ranked_dedup_and_latest(spark):
    df = make(spark, feed(7), FEED)
    best = dedup.ranked_dedup(df, ["key", "version"], [F.col("ord").desc()])
    last = {}
    for row in feed(7):
        last[row[:2]] = row
    assert rows(best) == sorted(last.values(), key=repr)
    latest = {}
    for row in feed(7):
        if row[0] not in latest or row[1] >= latest[row[0]][1]:
            latest[row[0]] = row
    assert rows(dedup.latest_per_key(df, ["key"], ["version", "ord"])) == sorted(
        latest.values(), key=repr
    )


SPEC = TableSpec(
    name="t",
    source_table="r",
    target_table="t",
    columns=(
        ColumnSpec("id", "ID", "INTEGER", nullable=False),
        ColumnSpec("price", "price", "REAL", default="1.5"),
        ColumnSpec("note", "note"),
        ColumnSpec("gone", "gone"),
        ColumnSpec("reject_count", "n", "INTEGER"),
    ),
    keys=("id", "note"),
    checks=(
        Check("col_is_not_null", ("id",)),
        Check("is_integer", ("note",)),
        Check("non_negative", ("price", "reject_count")),
    ),
)


def test_check_rows(spark):
    df = make(
        spark,
        [
            ("1", "2.5", "7", "1"),
            ("x", "", "7", "1"),
            ("", "", "", "1"),
            ("4", "-1", "a", "-2"),
            ("5", "nan", "8", ""),
        ],
        "id string, price string, note string, n string",
    )
    valid, rejected = quality.split(quality.check_rows(df, SPEC))
    assert rows(valid) == [(1, 2.5, "7", None, 1), (5, None, "8", None, None)]
    found = {tuple(r["source_record"]): r for r in rejected.collect()}
    bad_cast = found[("x", "", "7", "1")]
    assert bad_cast["reject_reason"] == "cast_failed"
    assert bad_cast["reject_reasons"] == ["cast_failed(id)", "not_null(id)"]
    assert (bad_cast["id"], bad_cast["price"], bad_cast["note"]) == (None, None, None)
    empty = found[("", "", "", "1")]
    assert empty["reject_reason"] == "data_quality_failed" and empty["price"] == 1.5
    assert empty["reject_reasons"] == ["not_null(id)", "not_null(note)"]
    assert found[("4", "-1", "a", "-2")]["reject_reasons"] == [
        "is_integer(note)", "non_negative(price)", "non_negative(reject_count)",
    ]


def test_map_columns_all_or_nothing(spark):
    df = make(spark, [("1", "a"), ("x", "b")], "id string, v string")
    specs = [ColumnSpec("id", "id", "INTEGER"), ColumnSpec("v", "v")]
    assert rows(mapping.map_columns(df, specs)) == [(1, "a"), (None, None)]
    assert rows(mapping.map_columns(df, specs, all_or_nothing=False)) == [(1, "a"), (None, "b")]


def test_column_names_with_dots_and_spaces(spark):
    df = make(spark, [("1", " a ")], ["a.b", "c d"])
    specs = [ColumnSpec("x.y", "a.b", "INTEGER"), ColumnSpec("c d", "c d")]
    mapped = mapping.map_columns(mapping.trim_text(df), specs)
    assert mapped.columns == ["x.y", "c d"] and rows(mapped, "`x.y`", "`c d`") == [(1, "a")]


def test_watermarks(spark):
    df = make(spark, feed(8), FEED)
    assert watermark.high_mark(df, "version").first()[0] == 5
    assert watermark.beyond(df, "version", None).count() == 400
    assert {r[0] for r in watermark.beyond(df, "version", 3).select("version").collect()} == {4, 5}
    marks = make(spark, [(0, 3), (1, 5)], "key long, mark long")
    for equal in (False, True):
        kept = watermark.beyond_marks(df, marks, ["key"], "version", include_equal=equal)
        held = {0: 3, 1: 5}
        expected = [r for r in feed(8) if r[1] > held.get(r[0], 0) - equal]
        assert rows(kept) == sorted(expected, key=repr)
    newer = make(spark, [(0, 2), (1, 9), (2, 1)], "key long, mark long")
    assert rows(watermark.advance_marks(marks, newer, ["key"])) == [(0, 3), (1, 9), (2, 1)]
    assert watermark.lookback_start(datetime(2024, 3, 1, 5), 1) == date(2024, 2, 29)


def test_runs_and_counts(spark):
    events = make(
        spark,
        [
            ("a", "RUNNING", None, 1), ("a", "SUCCEEDED", 5, 2),
            ("b", "RUNNING", None, 3), ("b", "FAILED", 9, 4), ("c", "RUNNING", None, 5),
        ],
        "run_id string, status string, ended_at long, recorded_at long",
    )
    runs = control.current_runs(events)
    assert rows(runs, "run_id", "status") == [("a", "SUCCEEDED"), ("b", "FAILED"), ("c", "RUNNING")]
    assert control.last_success(runs).first()[0] == 5
    df = make(spark, [("t", True), ("t", False), ("u", False)], "name string, bad boolean")
    assert rows(control.row_counts(df, "name", "bad")) == [("t", 1, 1), ("u", 1, 0)]
