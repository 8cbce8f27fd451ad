"""Exact top-k by inner product: a ball tree per shard, searched by branch and bound.

Vectors are dealt to shards of bounded size.  A shard's tree halves the vectors
along their widest dimension; a node knows a centre and a radius, so no vector below
it has an inner product with q above q.centre + |q| * radius.  Nodes are opened in
the order of that bound until it falls below the k-th score at hand.

The k-th score is shared: each query is answered in its own shard first, and goes to
all other shards with the k-th score found there as its floor.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from oreflow.llm.common import staged

K = 5
SCALE = 256.0
#: Vectors of a shard, queries of a block, vectors of a leaf: about so many.
SHARD = 8192
BLOCK = 4096
LEAF = 64
#: Up to here whole numbers, and so scores, are exact in double precision.
EXACT = 2**53
#: The largest score that a column of longs can show.
MOST = 2**63 - 1


@dataclass
class _Node:
    centre: np.ndarray
    radius: float
    rows: slice
    halves: tuple[_Node, _Node] | None


class BallTree:
    """``vectors``: whole numbers; ``ids``: what ties are decided by."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF):
        self._order = np.argsort(ids, kind="stable")
        self._vectors, self._leaf = vectors, leaf
        self._root = self._node(0, len(ids))
        self.ids, self.vectors = ids[self._order], vectors[self._order]
        self._longest = float(np.sqrt((self.vectors**2).sum(1)).max()) if len(ids) else 0.0
        self._whole: np.ndarray | None = None

    def _scores(self, rows: slice, query: np.ndarray, length: float) -> np.ndarray:
        """Inner products: in double precision where that is exact, else in whole numbers of any size."""
        if length * self._longest < EXACT:
            return self.vectors[rows] @ query
        if self._whole is None:
            self._whole = _whole(self.vectors)
        return self._whole[rows] @ _whole(query)

    def _node(self, start: int, end: int) -> _Node:
        own = self._vectors[self._order[start:end]]
        centre = own.mean(0) if len(own) else np.zeros(own.shape[1])
        radius = float(np.sqrt(((own - centre) ** 2).sum(1)).max()) if len(own) else 0.0
        halves = None
        if end - start > self._leaf and radius > 0:
            widest = int((own.max(0) - own.min(0)).argmax())
            inner = np.argsort(own[:, widest], kind="stable")
            self._order[start:end] = self._order[start:end][inner]
            middle = (start + end) // 2
            halves = (self._node(start, middle), self._node(middle, end))
        return _Node(centre, radius, slice(start, end), halves)

    def search(
        self, query_id: int, query: np.ndarray, k: int = K, floor: float = -np.inf
    ) -> list[tuple[int, int]]:
        """(score, id) of the k best, scores below the floor left out; ties to the lesser id.

        Vectors with the query's own id are passed over.
        """
        length = float(np.sqrt(query @ query))

        def bound(node: _Node) -> float:
            top = float(query @ node.centre) + length * node.radius
            return top + 1e-9 * (abs(top) + length * (1 + node.radius))

        best: list[tuple[int, int]] = []  # the worst first: (score, -id)
        waiting = [(-bound(self._root), 0, self._root)]
        number = 0
        while waiting:
            top, _, node = heapq.heappop(waiting)
            if -top < (max(floor, best[0][0]) if len(best) == k else floor):
                break
            if node.halves:
                for half in node.halves:
                    number += 1
                    heapq.heappush(waiting, (-bound(half), number, half))
                continue
            scores, ids = self._scores(node.rows, query, length), self.ids[node.rows]
            least = max(floor, best[0][0]) if len(best) == k else floor
            for at in np.flatnonzero((scores >= least) & (ids != query_id)).tolist():
                entry = (int(scores[at]), -int(ids[at]))
                if len(best) < k:
                    heapq.heappush(best, entry)
                elif entry > best[0]:
                    heapq.heapreplace(best, entry)
        return [(s, -i) for s, i in sorted(best, reverse=True)]


def _whole(values: np.ndarray) -> np.ndarray:
    out = np.empty(values.shape, object)
    out.ravel()[:] = [int(x) for x in values.ravel().tolist()]
    return out


def scaled(embedding: Column, scale: float = SCALE) -> Column:
    """floor(scale * x) of each component, x in double precision."""
    return F.transform(embedding, lambda x: F.floor(x.cast("double") * scale).cast("double"))


def sound(embedding: Column) -> Column:
    """No nulls, no components that are not finite."""
    bad = F.exists(
        embedding,
        lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")),
    )
    return embedding.isNotNull() & ~bad


_FOUND = "query_id long, query_key long, vec_id long, score long"


def _answers(tree: BallTree, queries: pd.DataFrame, k: int) -> list[tuple[int, int, int, int]]:
    rows = []
    for query_id, key, vector, floor in zip(
        queries["vec_id"], queries["key"], queries["vector"], queries["floor"], strict=True
    ):
        least = -np.inf if pd.isna(floor) else float(floor)
        for score, vec_id in tree.search(query_id, np.asarray(vector, float), k, least):
            rows.append((query_id, key, vec_id, min(max(score, -MOST - 1), MOST)))
    return rows


def _tree(rows: pd.DataFrame) -> BallTree:
    vectors = np.array(rows["vector"].tolist(), float).reshape(len(rows), -1)
    return BallTree(rows["vec_id"].to_numpy(np.int64), vectors)


def _below(score: str) -> Column:
    """The score as a double that is not above it."""
    value = F.col(score).cast("double")
    return F.when(F.abs(value) < EXACT, value).otherwise(value - F.abs(value) * 1e-15)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["query_id", "query_key", "vec_id", "score"], dtype="int64")


def top_k(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: for each query its k best of all other vectors.

    ``vectors`` (vec_id, vector: whole numbers as doubles).  Rows with a null vec_id
    or vector take no part; rows equal in both count once.  A vec_id that has several
    vectors is searched with each, and never found by itself.  Vectors of different
    lengths do not meet.  Fewer than k others: all of them.  Scores are exact at any size;
    one that no long can show is shown as the nearest long, in the order of the true
    scores among those of its shard.
    """
    rows = vectors.where("vec_id is not null and vector is not null").select("vec_id", "vector")
    rows = rows.withColumns({"key": F.xxhash64("vector"), "size": F.size("vector"), "asks": is_query})
    rows = staged(rows.dropDuplicates(["vec_id", "key"]), "vectors")
    count, asking = rows.agg(F.count("*"), F.count_if("asks")).first()
    shards, blocks = -(-count // SHARD) or 1, -(-asking // BLOCK) or 1
    shard = F.pmod(F.xxhash64("vec_id", "key"), F.lit(shards)).cast("int")
    rows = rows.withColumn("shard", shard).withColumn("floor", F.lit(None).cast("double"))

    def at_home(group: pd.DataFrame) -> pd.DataFrame:
        return _frame(_answers(_tree(group), group[group["asks"]], k))

    home = staged(rows.groupBy("size", "shard").applyInPandas(at_home, _FOUND), "home")
    if shards == 1:
        found = home
    else:
        floors = home.groupBy("query_id", "query_key").agg(F.count("*").alias("n"), F.min("score").alias("least"))
        floors = floors.where(F.col("n") >= k).select("query_id", "query_key", "least")
        asked = rows.where("asks").join(
            floors, (F.col("vec_id") == F.col("query_id")) & (F.col("key") == F.col("query_key")), "left"
        )
        block = F.pmod(F.xxhash64("key", "vec_id"), F.lit(blocks)).cast("int").alias("block")
        others = F.explode(F.array_remove(F.sequence(F.lit(0), F.lit(shards - 1)), F.col("shard")))
        asked = asked.select(
            "size", others.alias("shard"), block, "vec_id", "key", "vector", _below("least").alias("floor")
        )
        asked = asked.toDF(*asked.columns)  # columns of its own, not those of the vectors it meets
        every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
        held = rows.select("size", "shard", every_block, "vec_id", "vector")

        def away(held: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
            return _frame(_answers(_tree(held), asked, k) if len(held) and len(asked) else [])

        keys = ("size", "shard", "block")
        met = held.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInPandas(away, _FOUND)
        found = home.unionByName(met)
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def nearest(embeddings: DataFrame, every: int, k: int = K, scale: float = SCALE) -> DataFrame:
    """top_k of embeddings (vec_id, embedding) scaled to whole numbers; queries: vec_id % every = 0."""
    ints = embeddings.where(sound(F.col("embedding"))).select(
        "vec_id", scaled(F.col("embedding"), scale).alias("vector")
    )
    return top_k(ints, F.col("vec_id") % every == 0, k)
