"""The commit log: one winner for each number, and few files to read."""

import threading

import pytest

from oreflow.plans import log
from oreflow.plans.lake import ConcurrentChange, Lake
from oreflow.plans.log import CHECKPOINT_EVERY, CommitLog, HadoopFiles, LocalFiles


def row(number, schema="{}"):
    return {"layer": "raw", "table_name": "t", "path": f"p{number}", "schema": schema}


def paths(rows):
    return [r["path"] for r in rows]


def test_numbers_are_given_once(tmp_path):
    one, other = (CommitLog(None, str(tmp_path / "log")) for _ in range(2))
    assert one.rows() == other.rows() == []
    assert one.put(1, [row(1)])
    assert not other.put(1, [row(99)])
    assert paths(other.rows()) == ["p1"] and other.version == 1
    assert other.put(2, [row(2), row(3)])
    assert paths(one.rows()) == ["p1", "p2", "p3"]


def test_many_writers_lose_nothing(tmp_path):
    def work(writer):
        own = CommitLog(None, str(tmp_path / "log"))
        for i in range(15):
            while True:
                own.rows()
                if own.put(own.version + 1, [row(f"{writer}-{i}")]):
                    break

    threads = [threading.Thread(target=work, args=(w,)) for w in range(6)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    found = CommitLog(None, str(tmp_path / "log"))
    assert sorted(paths(found.rows())) == sorted(f"p{w}-{i}" for w in range(6) for i in range(15))
    assert found.version == 90


@pytest.mark.parametrize("commits", [1, CHECKPOINT_EVERY, 1000, 1013])
def test_a_reader_opens_one_checkpoint_and_what_came_after(tmp_path, monkeypatch, commits):
    writer = CommitLog(None, str(tmp_path / "log"))
    for i in range(1, commits + 1):
        writer.rows()
        assert writer.put(i, [row(i, schema=f"schema {i % 3}")])
    opened = []
    read = LocalFiles.read
    monkeypatch.setattr(log.LocalFiles, "read", lambda self, name: opened.append(name) or read(self, name))
    reader = CommitLog(None, str(tmp_path / "log"))
    assert paths(reader.rows()) == [f"p{i}" for i in range(1, commits + 1)]
    assert reader.rows()[-1]["schema"] == f"schema {commits % 3}"
    found = [name for name in opened if (tmp_path / "log" / name).exists()]
    assert len(found) == (commits >= CHECKPOINT_EVERY) + commits % CHECKPOINT_EVERY


def test_a_lost_checkpoint_costs_reading_only(tmp_path):
    writer = CommitLog(None, str(tmp_path / "log"))
    for i in range(1, 3 * CHECKPOINT_EVERY + 1):
        writer.rows()
        writer.put(i, [row(i)])
    for name in (tmp_path / "log").glob(f"checkpoint-*{3 * CHECKPOINT_EVERY}.json"):
        name.unlink()
    assert len(CommitLog(None, str(tmp_path / "log")).rows()) == 3 * CHECKPOINT_EVERY


def test_files_of_any_file_system(spark, tmp_path):
    (tmp_path / "log").mkdir()
    files = HadoopFiles(spark, f"file://{tmp_path}/log")
    assert files.read("1.json") is None and not files.there("1.json")
    assert files.put("1.json", "[é]")
    assert not files.put("1.json", "other")
    assert files.there("1.json") and files.read("1.json") == "[é]"
    assert [f.name for f in (tmp_path / "log").iterdir() if not f.name.startswith(".")] == ["1.json"]


def test_of_two_merges_on_one_state_the_second_is_refused(spark, tmp_path):
    """Both read the same table; between check and commit of one the other commits."""
    one, other = (Lake(spark, str(tmp_path / "lake")) for _ in range(2))
    rows = spark.range(3)
    one.record([one.write_snapshot("persistent", "t", "r0", rows)])
    basis = one.basis(("persistent", "t"))
    assert basis == other.basis(("persistent", "t"))
    mine = one.write_snapshot("persistent", "t", "r1", rows.limit(1))
    theirs = other.write_snapshot("persistent", "t", "r2", rows.limit(2))
    put = one.log.put

    def late(version, entries):
        if theirs:
            other.record([theirs], basis)
        one.log.put = put
        return put(version, entries)

    one.log.put = late
    with pytest.raises(ConcurrentChange):
        one.record([mine], basis)
    assert one.read("persistent", "t").count() == 2
    # a commit to another table in between is no conflict
    basis = one.basis(("persistent", "t"))
    other.record([other.write_part("raw", "u", "r3", rows)])
    one.record([mine], basis)
    assert one.read("persistent", "t").count() == 1 and one.read("raw", "u").count() == 3


def test_parts_of_the_ledger_are_put_together(spark, tmp_path, monkeypatch):
    from oreflow.plans import lake as lakes

    monkeypatch.setattr(lakes, "LOOSE_PARTS", 2)
    lake = Lake(spark, str(tmp_path / "lake"))
    for i in range(3):
        entries = spark.createDataFrame([(f"c{i}",)], "checksum string")
        lake.record([lake.write_part("control", lakes.LEDGER, f"r{i}", entries)])
    lake.tidy(lakes.LEDGER)
    assert len(lake.visible("control", lakes.LEDGER)) == 1
    assert sorted(r.checksum for r in lake.ledger().collect()) == ["c0", "c1", "c2"]
