"""Connected components of a table of links, by alternating large and small stars.

Kiveris, Lattanzi, Mirrokni, Rastogi, Vassilvitskii: Connected Components in
MapReduce and Beyond (2014).  Each round is two aggregates and joins over the
links; a node's links are never gathered in one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import staged


def _to_least(links: DataFrame) -> DataFrame:
    """(u, v, m): the links with the least of u's neighbours and u itself."""
    least = links.groupBy(F.col("u").alias("of")).agg(F.min("v").alias("m"))
    least = least.withColumn("m", F.least("of", "m"))
    return links.join(least, F.col("u") == F.col("of")).drop("of")


def _round(links: DataFrame) -> DataFrame:
    """One large and one small star; links point from the greater to the lesser node."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = _to_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    large = large.where("u > v").distinct()
    small = _to_least(large)
    return (
        small.where("v <> m")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(small.select("u", F.col("m").alias("v")))
        .distinct()
    )


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of a link (u, v) but the roots themselves.

    The root is the least node of its component.  Nulls link nothing; repeated
    links, loops and either direction are welcome.  No links: no rows.  Each round is
    written to the shared scratch; it ends when links no longer change, after about
    the logarithm of the longest chain.
    """
    links = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"), "u", "v")
    links = links.toDF("u", "v", "a", "b").where("a <> b").select("u", "v").distinct()
    now, before = staged(links, "links"), None
    while True:
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if not state[0] or state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
        now = staged(_round(now), "links")
