"""Near-duplicate embeddings: hierarchical navigable small-world graphs per shard.

Malkov, Yashunin: Efficient and Robust Approximate Nearest Neighbor Search Using
Hierarchical Navigable Small World Graphs (2016).

Vectors with one label are dealt to shards of bounded size; a task builds a shard's
graph and writes it to the shared scratch.  Then each pair of shards of a label is a
task: every vector of either is searched in the other's graph.  A search goes down
the layers, keeps a beam on the lowest, and floods on from what it found within the
threshold.  Some searches are audited against a full scan: for their true nearest
neighbours, however far these are, and for all within the threshold.  As long as the
recall of either is short of the target the beam is doubled, in the end up to a full
scan.  Cosines of what was found are taken again in double precision.

A task returns, for each vector, how many it is linked with and the least vector
it hangs together with; lists of links never leave the task.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreflow.llm.balltree import sound
from oreflow.llm.common import new_folder, staged
from oreflow.llm.components import components
from oreflow.llm.seekable import file_system

LEAST_COSINE = 0.98
SHARD = 8192
DEGREE = 12  # links of a node above the lowest layer; there twice as many
BUILD_BEAM = 32
FIRST_BEAM = 24
AUDITED = 48
NEAREST = 4  # true neighbours of an audited query that its beam has to find
MOST_TASKS = 100_000  # tasks of one search; each takes as many pairs of shards as there are then
RECALL = 0.99
BATCH = 256
#: A beam opens one in so many of its nodes at once, the nearest of those that wait.
AT_ONCE = 8
SEED = 11
_SLACK = 1e-5  # single precision, before the exact test


class Graph:
    """Layers of links over unit vectors; the top one first."""

    def __init__(self, units: np.ndarray, layers: list[tuple[np.ndarray, np.ndarray]]):
        #: A layer: its nodes, and for each node of the shard its neighbours (-1: none).
        self.units, self.layers = units, layers

    @staticmethod
    def build(units: np.ndarray) -> Graph:
        number = len(units)
        height = -np.log(1 - np.random.default_rng(SEED).random(number)) / np.log(DEGREE)
        height = np.minimum(height.astype(int), 8)
        graph = Graph(units, [])
        before = np.zeros(0, np.int64)
        for level in range(int(height.max()) if number else 0, -1, -1):
            nodes = np.flatnonzero(height >= level)
            most = DEGREE if level else 2 * DEGREE
            links = np.full((number, most), -1, np.int32)
            graph.layers.append((nodes, links))
            # those of the layer above come first: the entries are then in place
            order = np.concatenate([before, np.setdiff1d(nodes, before)])
            for at in range(0, len(order), BATCH):
                graph._insert(order[at : at + BATCH], order[:at], links, most)
            before = nodes
        return graph

    def _insert(self, fresh: np.ndarray, there: np.ndarray, links: np.ndarray, most: int) -> None:
        near = self.units[fresh] @ self.units[fresh].T
        np.fill_diagonal(near, -np.inf)
        take = min(BUILD_BEAM, len(fresh))
        inner = np.argpartition(-near, take - 1, axis=1)[:, :take]
        ids, sims = fresh[inner], np.take_along_axis(near, inner, 1)
        if len(there):
            entries = self._descend(self.units[fresh], len(self.layers) - 1)
            entries = np.where(np.isin(entries, there), entries, there[0])
            found, own = self._beam(self.units[fresh], entries, links, BUILD_BEAM)
            ids, sims = np.concatenate([ids, found], 1), np.concatenate([sims, own], 1)
        links[fresh] = self._spread(ids, sims, most)
        # and back: each new link from the other end, thinned where there are too many
        source = np.repeat(fresh, most)
        target = links[fresh].ravel()
        source, target = source[target >= 0], target[target >= 0]
        by_target = np.argsort(target, kind="stable")
        names, first, counts = np.unique(target[by_target], return_index=True, return_counts=True)
        widest = int(counts.max()) if len(counts) else 0
        extra = np.full((len(names), widest), -1, np.int64)
        column = np.arange(len(target)) - np.repeat(first, counts)
        extra[np.repeat(np.arange(len(names)), counts), column] = source[by_target]
        for at in range(0, len(names), BATCH):
            own = names[at : at + BATCH]
            ids = np.concatenate([links[own], extra[at : at + BATCH]], 1)
            sims = self._sims(self.units[own], ids)
            links[own] = self._spread(ids, sims, most)

    def _sims(self, queries: np.ndarray, ids: np.ndarray) -> np.ndarray:
        sims = np.einsum("bmd,bd->bm", self.units[ids], queries, optimize=False)
        return np.where(ids >= 0, sims, -np.inf)

    def _spread(self, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
        """Of candidates, the nearest that are no nearer to one already taken than to the node."""
        order = np.argsort(-sims, axis=1, kind="stable")[:, : 2 * BUILD_BEAM]
        ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
        ids = np.where(np.isfinite(sims), ids, -1)
        vectors = self.units[ids]
        between = np.matmul(vectors, vectors.transpose(0, 2, 1))
        taken = np.zeros(ids.shape, bool)
        room = np.full(len(ids), most)
        for at in range(ids.shape[1]):
            same = (taken & (ids == ids[:, at : at + 1])).any(1)
            hidden = (taken & (between[:, at, :] > sims[:, at : at + 1])).any(1)
            taken[:, at] = (ids[:, at] >= 0) & ~same & ~hidden & (room > 0)
            room -= taken[:, at]
        # fill up with the nearest that were hidden
        for at in range(ids.shape[1]):
            same = (taken & (ids == ids[:, at : at + 1])).any(1)
            more = (ids[:, at] >= 0) & ~taken[:, at] & ~same & (room > 0)
            taken[:, at] |= more
            room -= more
        out = np.full((len(ids), most), -1, np.int32)
        rank = np.cumsum(taken, 1) - 1
        row, column = np.nonzero(taken)
        out[row, rank[row, column]] = ids[row, column]
        return out

    def _descend(self, queries: np.ndarray, until: int) -> np.ndarray:
        """The nearest node that a walk down the layers above ``until`` ends at."""
        at = np.full(len(queries), self.layers[0][0][0])
        for _, links in self.layers[:until]:
            at = self._beam(queries, at, links, 1)[0][:, 0]
        return at

    def _beam(
        self, queries: np.ndarray, entries: np.ndarray, links: np.ndarray, width: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """(nodes, similarities) of the best found for each query, -1 where there are fewer."""
        number = len(queries)
        ids = np.full((number, width), -1, np.int64)
        sims = np.full((number, width), -np.inf, np.float32)
        opened = np.zeros((number, width), bool)
        ids[:, 0] = entries
        sims[:, 0] = np.einsum("bd,bd->b", self.units[entries], queries)
        seen = np.zeros((number, len(self.units) + 1), bool)  # the last for "none"
        seen[:, -1] = True
        seen[np.arange(number), entries] = True
        several = max(1, width // AT_ONCE)
        came_at = np.zeros(seen.shape if several > 1 else 0, np.int32)
        active = np.arange(number)
        while len(active):
            waiting = np.where(opened[active] | (ids[active] < 0), -np.inf, sims[active])
            if several > 1:
                best = np.argpartition(-waiting, several - 1, axis=1)[:, :several]
            else:
                best = waiting.argmax(1)[:, None]
            good = np.isfinite(np.take_along_axis(waiting, best, 1))
            go = good.any(1)
            active, best, good = active[go], best[go], good[go]
            if not len(active):
                break
            rows = active[:, None]
            opened[rows, best] |= good
            near = np.where(good[:, :, None], links[ids[rows, best]], -1).reshape(len(active), -1)
            fresh = ~seen[rows, near]
            if several > 1:  # a node that several bring counts once
                columns = np.arange(near.shape[1], dtype=np.int32)[None]
                came_at[rows, near] = columns
                fresh &= came_at[rows, near] == columns
            seen[rows, near] = True
            near = np.where(fresh, near, -1)
            at, column = np.nonzero(fresh)
            own = np.full(near.shape, -np.inf, np.float32)
            own[at, column] = np.einsum("nd,nd->n", self.units[near[at, column]], queries[active[at]])
            all_ids = np.concatenate([ids[active], near], 1)
            all_sims = np.concatenate([sims[active], own], 1)
            all_opened = np.concatenate([opened[active], np.zeros(near.shape, bool)], 1)
            keep = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
            ids[active] = np.take_along_axis(all_ids, keep, 1)
            sims[active] = np.take_along_axis(all_sims, keep, 1)
            opened[active] = np.take_along_axis(all_opened, keep, 1)
        ids[~np.isfinite(sims)] = -1
        return ids, sims

    def nearest(self, queries: np.ndarray, width: int) -> np.ndarray:
        """Similarities of the ``width`` best nodes that a beam finds for each query."""
        return self._beam(queries, self._descend(queries, len(self.layers) - 1), self.layers[-1][1], width)[1]

    def within(self, queries: np.ndarray, least: float, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, node) at a similarity of at least ``least``, as far as found."""
        lowest = self.layers[-1][1]
        of_query, of_node = [], []
        for at in range(0, len(queries), BATCH):
            part = queries[at : at + BATCH]
            entries = self._descend(part, len(self.layers) - 1)
            ids, sims = self._beam(part, entries, lowest, width)
            for row in np.flatnonzero((sims >= least).any(1)).tolist():
                have = ids[row][sims[row] >= least]
                seen = np.zeros(len(self.units) + 1, bool)
                seen[-1] = True
                seen[have] = True
                front = have
                while len(front):
                    near = np.unique(lowest[front])
                    near = near[~seen[near]]
                    seen[near] = True
                    front = near[self.units[near] @ part[row] >= least]
                    have = np.concatenate([have, front])
                of_query.append(np.full(len(have), at + row))
                of_node.append(have)
        if not of_node:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(of_query), np.concatenate(of_node).astype(np.int64)


def _scan(units: np.ndarray, queries: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    found = [
        (np.nonzero(queries[at : at + BATCH] @ units.T >= least), at)
        for at in range(0, len(queries), BATCH)
    ]
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([q + at for (q, _), at in found]), np.concatenate([n for (_, n), _ in found])


def audited(graph: Graph, queries: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """``within``, with the beam widened until the recall of audited queries is enough.

    Links are rare, between most shards there is none in a sample; the nearest nodes
    always exist, so their recall tells whether a link would have been found.
    """
    number = len(graph.units)
    sample = np.unique(np.linspace(0, len(queries) - 1, min(AUDITED, len(queries))).astype(int))
    truth = np.unique(np.stack(_scan(graph.units, queries[sample], least), 1), axis=0)
    most = min(NEAREST, number)
    # the similarity that the nearest reach; equal ones serve as well
    reached = np.sort(queries[sample] @ graph.units.T, axis=1)[:, number - most :][:, :1] - _SLACK
    width = FIRST_BEAM
    # a wider beam would look at as many nodes as the scan does
    while width < number and (width == FIRST_BEAM or 2 * DEGREE * width < number):
        near = (graph.nearest(queries[sample], width) >= reached).sum(1)
        if np.minimum(near, most).sum() >= RECALL * most * len(sample):
            own = set(zip(*(x.tolist() for x in graph.within(queries[sample], least, width)), strict=True))
            hits = sum(pair in own for pair in map(tuple, truth.tolist()))
            if hits >= RECALL * len(truth):
                return graph.within(queries, least, width)
        width *= 2
    return _scan(graph.units, queries, least)


def _save(folder: str, name: str, **arrays: np.ndarray) -> None:
    held = io.BytesIO()
    np.savez(held, **arrays)
    system, root = file_system(folder)
    system.create_dir(root, recursive=True)
    with system.open_output_stream(f"{root}/{name}", compression=None) as stream:
        stream.write(held.getvalue())


def _load(path: str) -> tuple[Graph, np.ndarray, np.ndarray, np.ndarray]:
    """Graph, vectors in double precision, identifiers, copies."""
    system, where = file_system(path)
    with system.open_input_stream(where, compression=None) as stream:
        held = np.load(io.BytesIO(stream.read()))
    vectors = held["vectors"]
    units = vectors / np.sqrt((vectors**2).sum(1, keepdims=True))
    layers = [(held[f"nodes{i}"], held[f"links{i}"]) for i in range(int(held["layers"]))]
    return Graph(units.astype(np.float32), layers), units, held["ids"], held["copies"]


def _links(left: tuple, right: tuple, same: bool, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of left, row of right), each once, tested in double precision."""
    a, b = audited(right[0], left[0].units, least - _SLACK)
    if not same:
        d, c = audited(left[0], right[0].units, least - _SLACK)
        a, b = np.concatenate([a, c]), np.concatenate([b, d])
    else:
        a, b = np.concatenate([a, b]), np.concatenate([b, a])
    key = np.unique(a * len(right[2]) + b)
    a, b = key // len(right[2]), key % len(right[2])
    if same:
        a, b = a[a != b], b[a != b]
    cosine = np.concatenate(
        [
            np.einsum("nd,nd->n", left[1][a[i : i + 65536]], right[1][b[i : i + 65536]])
            for i in range(0, max(1, len(a)), 65536)
        ]
    )
    return a[cosine >= least], b[cosine >= least]


def _roots(a: np.ndarray, b: np.ndarray, number: int) -> np.ndarray:
    """For each node the least node of its component: minima spread along the links."""
    root = np.arange(number)
    while True:
        new = root.copy()
        np.minimum.at(new, a, root[b])
        np.minimum.at(new, b, root[a])
        new = new[new]
        if (new == root).all():
            return root
        root = new


def near_duplicates(embeddings: DataFrame, least: float = LEAST_COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of (vec_id, embedding, label).

    Links: equal labels, not null, cosine of at least ``least``.  Null vectors, zero
    vectors, vectors with null or non-finite components, and rows with a null vec_id
    link with nothing (component_id is the own vec_id).  Rows that agree in label and
    embedding are one node of the graph with so many copies, each linked with the
    others; a vec_id that has several vectors is as many nodes, each with links of its
    own.  Vectors of different lengths do not meet.
    """
    spark = embeddings.sparkSession
    rows = embeddings.select("vec_id", "embedding", "label")
    nonzero = F.exists("embedding", lambda x: x != 0)
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & sound(F.col("embedding"))
    key = [F.xxhash64("label", "embedding"), F.xxhash64(F.lit(1), "label", "embedding")]
    linked = rows.where(usable & nonzero).select("*", key[0].alias("a"), key[1].alias("b"))
    classes = linked.groupBy("a", "b").agg(
        F.min("vec_id").alias("id"),
        F.count("*").alias("copies"),
        F.any_value("label").alias("label"),
        F.any_value("embedding").alias("embedding"),
    )
    # one vec_id may have several vectors: a node is known by a number of its own
    classes = classes.withColumns({"size": F.size("embedding"), "node": F.monotonically_increasing_id()})
    classes = staged(classes, "classes")
    sizes = classes.groupBy("label", "size").agg(F.ceil(F.count("*") / SHARD).cast("int").alias("shards"))
    sizes = staged(sizes, "sizes")
    folder = new_folder(spark, "graphs")

    def build(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["id", "a", "b"])
        vectors = np.array(group["embedding"].tolist(), np.float64)
        # the length of a vector of huge components is not representable; its direction is
        vectors /= np.abs(vectors).max(1, keepdims=True)
        units = vectors / np.sqrt((vectors**2).sum(1, keepdims=True))
        graph = Graph.build(units.astype(np.float32))
        name = f"{uuid.uuid4().hex}.npz"
        layers = {f"nodes{i}": nodes for i, (nodes, _) in enumerate(graph.layers)}
        layers |= {f"links{i}": links for i, (_, links) in enumerate(graph.layers)}
        ids, copies = group["node"].to_numpy(np.int64), group["copies"].to_numpy(np.int64)
        _save(folder, name, vectors=vectors, ids=ids, copies=copies, layers=np.array(len(graph.layers)), **layers)
        first = group.iloc[0]
        return pd.DataFrame({"label": [first["label"]], "size": [first["size"]], "shard": [first["shard"]], "name": [name]})

    dealt = classes.join(sizes, ["label", "size"])
    dealt = dealt.withColumn("shard", F.pmod(F.xxhash64("a", "b"), F.col("shards")).cast("int")).drop("shards")
    label = embeddings.schema["label"].dataType.simpleString()
    graphs = dealt.groupBy("label", "size", "shard").applyInPandas(
        build, f"label {label}, size int, shard int, name string"
    )
    graphs = staged(graphs, "graph-list")
    left = graphs.select("label", "size", F.col("shard").alias("i"), F.col("name").alias("left"))
    right = graphs.select("label", "size", F.col("shard").alias("j"), F.col("name").alias("right"))
    pairs = left.join(right, ["label", "size"]).where("i <= j").select("left", "right")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, one = None, None
        for batch in batches:
            for pair in batch.to_pylist():
                same = pair["left"] == pair["right"]
                if held != pair["left"]:
                    held, one = pair["left"], _load(f"{folder}/{pair['left']}")
                two = one if same else _load(f"{folder}/{pair['right']}")
                a, b = _links(one, two, same, least)
                shift = 0 if same else len(one[2])
                ids = one[2] if same else np.concatenate([one[2], two[2]])
                degree = np.bincount(a, two[3][b], minlength=len(ids)).astype(np.int64)
                if not same:
                    degree += np.bincount(b + shift, one[3][a], minlength=len(ids)).astype(np.int64)
                order = np.argsort(ids, kind="stable")
                place = np.empty(len(ids), np.int64)
                place[order] = np.arange(len(ids))
                root = ids[order][_roots(place[a], place[b + shift], len(ids))][place]
                hit = degree > 0
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[hit]), pa.array(degree[hit]), pa.array(root[hit])],
                    names=["id", "n", "root"],
                )

    # pairs of one left graph lie together, so a task reads it once
    number = min(max(1, pairs.count()), MOST_TASKS)
    tasks = pairs.repartitionByRange(number, "left", "right").sortWithinPartitions("left", "right")
    found = staged(tasks.mapInArrow(search, "id long, n long, root long"), "found")
    degrees = found.groupBy(F.col("id").alias("of_id")).agg(F.sum("n").alias("n"))
    joined = components(found.select(F.col("id").alias("u"), F.col("root").alias("v")))
    node = classes.select("a", "b", "id", "copies", F.col("node").alias("number"))
    node = node.join(degrees, F.col("number") == F.col("of_id"), "left")
    node = node.join(joined, F.col("number") == F.col("node"), "left")
    node = staged(node.withColumn("root", F.coalesce("root", "number")).drop("of_id", "node", "number"), "nodes")
    least_id = node.groupBy(F.col("root").alias("of_root")).agg(F.min("id").alias("component_id"))
    node = node.join(least_id, F.col("root") == F.col("of_root")).select(
        F.col("a").alias("of_a"),
        F.col("b").alias("of_b"),
        (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        "component_id",
    )
    own = rows.select("vec_id", F.when(usable & nonzero, key[0]).alias("a"), F.when(usable & nonzero, key[1]).alias("b"))
    out = own.join(node, (F.col("a") == F.col("of_a")) & (F.col("b") == F.col("of_b")), "left")
    out = out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")
    )
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
