"""A Merkle manifest of a table: a digest a row, a tree a group, one root, and a proof for every row.

Runs of ``FAN`` consecutive nodes become the node above them.  Checkpoint and
recompute: of the levels only every ``STRIDE``-th is written.  The nodes between
two written levels lie in aligned subtrees of ``FAN ** STRIDE`` nodes of the lower
one; whoever needs them makes them again from the subtree's stored nodes, uses
them and lets them go.  Proofs are drawn from the root down, so that the part
above a subtree is made once and joined to the subtree, not to its rows.

The leaves are numbered by a sort over ranges, never by a window over a group: a
group that holds most rows is spread like any other.
"""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from oreflow.llm.common import staged

#: Fixed by the format: nodes that become one.
FAN = 8
#: Levels from one written level to the next.
STRIDE = 3
SPAN = FAN**STRIDE
PATH = "array<struct<place:int,siblings:array<string>>>"


@dataclass(frozen=True)
class Manifest:
    """The written levels of a forest, lowest first; the last has the root of each group."""

    levels: tuple[DataFrame, ...]
    carried: tuple[str, ...]


def digest(*values: Column) -> Column:
    """SHA-256 of values in a row: ``-`` for null, else UTF-8 byte count, ``:``, value."""
    texts = [value.cast("string") for value in values]
    items = [
        F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t))
        for t in texts
    ]
    return F.sha2(F.concat(*items), 256)


def _numbered(leaves: DataFrame, order: list[str]) -> DataFrame:
    """Leaves with their place ``at`` in their group (from 0) and the group's size ``n``."""
    by = [F.col(name).asc_nulls_first() for name in ("grp", *order, "digest")]
    # written first: finding the bounds of the ranges would hash every text once more
    dealt = staged(leaves, "digests").repartitionByRange(*by).sortWithinPartitions(*by)
    # the running id holds the partition in its upper bits
    rows = staged(dealt.withColumn("__id", F.monotonically_increasing_id()), "leaves")
    rows = rows.withColumn("__part", F.shiftright("__id", 33))
    parts = rows.groupBy("grp", "__part").agg(F.min("__id").alias("__first"), F.count("*").alias("__rows"))
    group = Window.partitionBy("grp")
    before = group.orderBy("__part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = parts.select(
        "grp",
        "__part",
        (F.sum("__rows").over(before) - F.col("__rows") - F.col("__first")).alias("__shift"),
        F.sum("__rows").over(group).alias("n"),
    )
    placed = rows.join(starts, ["grp", "__part"]).withColumn("at", F.col("__id") + F.col("__shift"))
    return placed.drop("__id", "__part", "__shift")


def _above(nodes: Column) -> Column:
    """The digests one level up."""
    runs = F.sequence(F.lit(0), F.ceil(F.size(nodes) / FAN).cast("int") - 1)
    return F.transform(
        runs, lambda i: F.sha2(F.array_join(F.slice(nodes, i * FAN + 1, F.lit(FAN)), ""), 256)
    )


def _levels() -> Column:
    """Levels from here to the next written one: fewer where the group's root comes first."""
    steps = F.when(F.col("n") <= 1, 0)
    for level in range(1, STRIDE):
        steps = steps.when(F.col("n") <= FAN**level, level)
    return steps.otherwise(STRIDE)


def _subtrees(nodes: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """One row a subtree: its stored nodes ``kids`` in order and the levels ``l0``.. made from them."""
    kid = F.struct("at", "digest", *carried)
    up = F.floor(F.col("at") / SPAN).alias("up")
    trees = nodes.groupBy("grp", "n", up).agg(F.sort_array(F.collect_list(kid)).alias("kids"))
    trees = trees.withColumn("levels", _levels()).withColumn("l0", F.transform("kids", lambda k: k["digest"]))
    for level in range(1, STRIDE + 1):
        made = F.when(F.col("levels") >= level, _above(F.col(f"l{level - 1}")))
        trees = trees.withColumn(f"l{level}", made)
    return trees


def _climbed(nodes: DataFrame) -> DataFrame:
    """The next written level."""
    top = F.coalesce(*[F.col(f"l{level}")[0] for level in range(STRIDE, -1, -1)])
    size = F.ceil(F.col("n") / SPAN).cast("long")
    return _subtrees(nodes).select("grp", F.col("up").alias("at"), size.alias("n"), top.alias("digest"))


def _forest(leaves: DataFrame, order: list[str], carried: tuple[str, ...]) -> Manifest:
    levels = [_numbered(leaves, order)]
    size = levels[0].agg(F.max("n")).first()[0] or 0
    while True:  # a group with one leaf has its root there already
        levels.append(staged(_climbed(levels[-1]), "nodes"))
        size = -(-size // SPAN)
        if size <= 1:
            return Manifest(tuple(levels), carried)


def _entry(run: Column, place: Column) -> Column:
    """A run's other nodes, and the place of the one that is left out."""
    others = F.concat(F.slice(run, F.lit(1), place), F.slice(run, place + 2, F.lit(FAN)))
    return F.struct(place.cast("int").alias("place"), others.alias("siblings"))


def _descended(nodes: DataFrame, tails: DataFrame, carried: tuple[str, ...] = ()) -> DataFrame:
    """The nodes of a written level with their path up: tails are the paths of the level above it."""
    tails = tails.select("grp", F.col("at").alias("up"), F.col("path").alias("tail"), "subroot")
    trees = _subtrees(nodes, carried).join(tails, ["grp", "up"])
    none = F.array().cast(PATH)
    runs = F.transform(
        F.sequence(F.lit(0), F.ceil(F.size("kids") / FAN).cast("int") - 1),
        lambda r: F.struct(r.alias("r"), F.slice("kids", r * FAN + 1, F.lit(FAN)).alias("kids")),
    )
    rows = trees.select("grp", "levels", *[f"l{i}" for i in range(1, STRIDE)], "tail", "subroot", F.explode(runs).alias("run"))
    above, at = [], F.col("run.r")
    for level in range(1, STRIDE):
        start = F.floor(at / FAN).cast("int")
        entry = _entry(F.slice(F.col(f"l{level}"), start * FAN + 1, F.lit(FAN)), at % FAN)
        above.append(F.when(F.col("levels") > level, F.array(entry)).otherwise(none))
        at = start
    rows = rows.select(
        "grp", "levels", "subroot", F.concat(*above, "tail").alias("tail"), F.col("run.kids").alias("kids")
    )
    rows = rows.withColumn("run", F.transform("kids", lambda k: k["digest"]))
    rows = rows.select("grp", "levels", "subroot", "tail", "run", F.posexplode("kids").alias("place", "kid"))
    own = F.when(F.col("levels") > 0, F.array(_entry(F.col("run"), F.col("place")))).otherwise(none)
    return rows.select(
        "grp",
        F.col("kid.at").alias("at"),
        F.col("kid.digest").alias("digest"),
        F.concat(own, "tail").alias("path"),
        "subroot",
        *[F.col("kid")[name].alias(name) for name in carried],
    )


def _paths(forest: Manifest, tails: DataFrame) -> DataFrame:
    """From the roots, whose own paths ``tails`` are, to the leaves."""
    for level, nodes in reversed(list(enumerate(forest.levels[:-1]))):
        tails = _descended(nodes, tails, forest.carried if level == 0 else ())
    return tails


def proofs(
    rows: DataFrame, group: str, order: list[str], leaf: Column, carried: tuple[str, ...] = ()
) -> DataFrame:
    """(carried columns, leaf, subroot, root, path) of every row.

    Per value of ``group`` the leaves ascend by ``order`` (null first, then by the
    leaf itself); the subroots of the groups, null first and then bytewise, are the
    leaves of one more tree.  A path lists, from the leaf up to the root, the other
    nodes of each run and the place to put one's own digest; ``folded`` recomputes
    a root from it.  A run of one node has an entry without siblings.

    A row with nulls is a leaf like any other, repeated rows are a leaf each, texts
    are hashed whole and do not travel.  An empty table gives no rows.  Columns
    that are not named are not read.  Only sizes and the root reach the driver.
    """
    spare = [f"__order_{i}" for i in range(len(order))]
    kept = [f"__carried_{i}" for i in range(len(carried))]
    leaves = rows.select(
        F.when(F.col(group).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(group))).alias("grp"),
        leaf.alias("digest"),
        *[F.col(name).alias(own) for name, own in zip(order, spare, strict=True)],
        *[F.col(name).alias(own) for name, own in zip(carried, kept, strict=True)],
    )
    trees = _forest(leaves, spare, tuple(kept))
    roots = trees.levels[-1].select(F.lit("").alias("grp"), F.col("grp").alias("of"), "digest")
    crown = _forest(roots, ["of"], ("of",))
    root = crown.levels[-1]
    start = root.select("grp", "at", F.array().cast(PATH).alias("path"), F.col("digest").alias("subroot"))
    crowned = _paths(crown, start).select(
        F.col("of").alias("grp"), F.lit(0).cast("long").alias("at"), "path", F.col("digest").alias("subroot")
    )
    found = _paths(trees, crowned)
    top = root.first()
    return found.select(
        *[F.col(own).alias(name) for name, own in zip(carried, kept, strict=True)],
        F.col("digest").alias("leaf"),
        "subroot",
        F.lit(top["digest"] if top else None).cast("string").alias("root"),
        "path",
    )


@F.arrow_udf(StringType())
def ascii_lower(texts: pa.Array) -> pa.Array:
    """A-Z lower-cased and nothing else; Spark's own translate takes ten times as long."""
    return pc.ascii_lower(texts)


def proof_digest(path: Column) -> Column:
    """SHA-256 of all siblings of a path, level by level, left to right."""
    return F.sha2(F.array_join(F.flatten(F.transform(path, lambda run: run["siblings"])), ""), 256)


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings of a path give."""

    def step(below: Column, run: Column) -> Column:
        left = F.slice(run["siblings"], F.lit(1), run["place"])
        right = F.slice(run["siblings"], run["place"] + 1, F.lit(FAN))
        return F.sha2(F.array_join(F.concat(left, F.array(below), right), ""), 256)

    return F.aggregate(path, leaf, step)


def audit(documents: DataFrame, every: int = 3) -> DataFrame:
    """Proofs of documents against tampering: (doc_id, leaf, subroot, root, proof_sha256, folded_root, verified).

    Where ``every`` divides the crc32 of the decimal doc_id, the text's A-Z are
    lower-cased before the leaf is made again; a null doc_id has no decimal form
    and is left alone.  ``verified`` says that the leaf so made, folded with the
    original siblings, gives the root.
    """
    named = [F.col(name) for name in ("doc_id", "source", "lang", "n_chars")]
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0
    plain = documents.select(*named, "text")
    changed = ascii_lower(F.when(hit, F.col("text")))
    marked = plain.withColumn("tampered", F.when(hit, digest(*named, changed)))
    found = proofs(marked, "lang", ["doc_id"], digest(*named, F.col("text")), ("doc_id", "tampered"))
    found = found.withColumn("folded_root", folded(F.coalesce("tampered", "leaf"), F.col("path")))
    return found.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("path")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
