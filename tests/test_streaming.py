import os

from pyspark.sql import functions as F

from oreflow.plans.lake import Lake
from oreflow.streaming.incremental import csv_stream, upsert_stream


def test_stream_takes_each_file_once_and_survives_a_replay(spark, tmp_path):
    landing, checkpoint = tmp_path / "landing", tmp_path / "checkpoint"
    landing.mkdir()
    lake = Lake(spark, str(tmp_path / "lake"))

    def run():
        stream = csv_stream(spark, str(landing), ["id", "v", "ord"], files_per_batch=1)
        typed = lambda df: df.select(
            F.col("id").cast("long"), "v", F.col("ord").cast("long"), "source_file_path"
        )
        upsert_stream(stream, lake, "t", ["id"], ["ord"], str(checkpoint), typed).awaitTermination()
        rows = lake.read("persistent", "t").select("id", "v").collect()
        return sorted(map(tuple, rows)), len(lake.commits("persistent", "t"))

    (landing / "1.csv").write_text('id,v,ord\n1,a,1\n2,"b\nb",2\n1,c,3\n')
    (landing / "2.csv").write_text("id,v,ord\n2,d,4\n")
    os.utime(landing / "1.csv", (1_700_000_000, 1_700_000_000))  # files come oldest first
    assert run() == ([(1, "c"), (2, "d")], 2)
    assert run() == ([(1, "c"), (2, "d")], 2)
    (landing / "3.csv").write_text("id,v,ord\n3,e,5\n")
    assert run() == ([(1, "c"), (2, "d"), (3, "e")], 3)
    # As after a crash between the merge and the stream's own commit.
    for name in ("2", ".2.crc"):
        (checkpoint / "commits" / name).unlink(missing_ok=True)
    assert run() == ([(1, "c"), (2, "d"), (3, "e")], 3)


def test_another_header_order_fails_instead_of_swapping(spark, tmp_path):
    import pytest

    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "1.csv").write_text("v,id\na,1\n")
    lake = Lake(spark, str(tmp_path / "lake"))
    with pytest.raises(Exception, match="(?i)header"):
        upsert_stream(
            csv_stream(spark, str(landing), ["id", "v"]),
            lake, "t", ["id"], ["v"], str(tmp_path / "checkpoint"),
        ).awaitTermination()
