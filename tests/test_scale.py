"""What the plans do with hot keys, and that nothing moves which need not."""

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from oreflow.operators import dedup, merge, watermark
from oreflow.plans.lake import Lake


@contextmanager
def settings(spark, **changes):
    names = {name.replace("_", "."): str(value) for name, value in changes.items()}
    before = {name: spark.conf.get(name, None) for name in names}
    for name, value in names.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def hot(spark, count=120_000):
    """A third of the rows on one key."""
    rows = spark.range(count, numPartitions=8)
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 5000)
    return rows.select(
        key.alias("key"),
        (F.col("id") % 7).alias("version"),
        F.col("id").alias("ord"),
        F.sha2(F.col("id").cast("string"), 256).alias("value"),
    )


def test_first_wins_is_pruned_before_the_shuffle(spark):
    plan = plan_of(dedup.first_wins(hot(spark), ["key"], ["ord"]))
    assert re.search(r"Exchange hashpartitioning[\s\S]*WindowGroupLimit[\s\S]*Partial", plan)
    assert plan.count("Exchange") == 1


def test_latest_aggregates_before_the_shuffle(spark):
    plan = plan_of(dedup.latest_per_key(hot(spark), ["key"], ["version", "ord"]))
    assert "partial_max_by" in plan and plan.count("Exchange") == 1


@pytest.mark.parametrize("operator", ["absent_keys", "mark_conflicts", "beyond_marks"])
def test_hot_left_sides_are_split(spark, tmp_path, operator):
    """With broadcasts off, adaptive execution splits the hot key; no row is lost."""
    rows = hot(spark)
    keys = rows.where("key <> 0 AND key % 2 = 0").select("key")
    changes = {
        "spark_sql_autoBroadcastJoinThreshold": -1,
        "spark_sql_adaptive_autoBroadcastJoinThreshold": -1,
        "spark_sql_adaptive_skewJoin_skewedPartitionThresholdInBytes": "64KB",
        "spark_sql_adaptive_skewJoin_skewedPartitionFactor": 1.2,
        "spark_sql_adaptive_advisoryPartitionSizeInBytes": "256KB",
        "spark_sql_shuffle_partitions": 16,
    }
    with settings(spark, **changes):
        if operator == "absent_keys":
            result = merge.absent_keys(rows, keys, ["key"])
            expected = rows.where("NOT (key <> 0 AND key % 2 = 0)").count()
        elif operator == "mark_conflicts":

            def written(ends):
                ends.write.parquet(str(tmp_path / "ends"))
                return spark.read.parquet(str(tmp_path / "ends"))

            result = merge.mark_conflicts(rows, ["key"], "version", ["value"], written=written)
            result = result.where(merge.CONFLICT)
            several = rows.groupBy("key", "version").count().where("count > 1")
            expected = several.agg(F.sum("count")).first()[0]
        else:
            marks = watermark.marks_per_key(rows.where("key % 2 = 1"), ["key"], "version")
            marks.write.parquet(str(tmp_path / "marks"))
            stored = spark.read.parquet(str(tmp_path / "marks"))
            result = watermark.beyond_marks(rows, stored, ["key"], "version")
            expected = rows.where("key % 2 = 0").count()
        found = result.collect()
        assert len(found) == expected
        assert "skew=true" in plan_of(result)


def test_bucketed_table_is_not_shuffled_by_a_merge(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    first = hot(spark).select("key", "ord").dropDuplicates(["key"])
    lake.record([lake.write_snapshot("persistent", "t", "r1", first, (), ["key"], 8)])
    state = lake.read("persistent", "t")
    incoming = hot(spark).where("key % 10 = 0").select("key", (F.col("ord") * -1).alias("ord"))
    with settings(spark, spark_sql_autoBroadcastJoinThreshold=-1):
        merged = merge.upsert(state, incoming, ["key"], ["ord"], [])
        plan = plan_of(merged)
        side = plan[plan.index("FullOuter") : plan.index("Bucketed: true")]
        assert "Exchange" not in side
        commit = lake.write_snapshot("persistent", "t", "r2", merged, (), ["key"], 8, clustered=True)
    files = [f for f in (tmp_path / commit.path[len(str(tmp_path)) + 1 :]).iterdir()]
    assert len([f for f in files if f.suffix == ".parquet"]) <= 8
    lake.record([commit])
    assert lake.read("persistent", "t").count() == first.count()
