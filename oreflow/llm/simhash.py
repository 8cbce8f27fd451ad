"""SimHash near-duplicates: fingerprints, segment-popcount embedding, grid range join.

A fingerprint is mapped to the bit counts of its 32 two-bit segments.  One differing
bit changes one count by one, so the Manhattan distance of two embeddings is never
above the number of differing bits.  The counts are kept in unary (01 for one, 11
for two), which makes that distance the bit count of an exclusive or.

Grid: the 32 coordinates are dealt into groups.  Vectors at Manhattan distance d
differ in at most d groups; so they lie in one cell of a grid over the other groups,
for some choice of d groups to leave out.  Fingerprints meet by these cells, then
the Manhattan distance is tested, then the exact number of differing bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.llm.common import slices, staged, with_fields
from oreflow.llm.components import components

SHINGLE = 3
SEED = 42
MAX_BITS = 2
#: Groups of coordinates.  More make cells finer and their number per fingerprint greater.
GROUPS = 6
#: Texts are taken in runs of about so many characters.
RUN_CHARS = 1 << 20

_COORDINATES = 32
_LOW = 0x5555555555555555


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def fingerprint(text: str, shingle: int = SHINGLE) -> bytes:
    """The eight bytes of a text's fingerprint; bit by bit the majority of its shingles."""
    import xxhash

    digest = xxhash.xxh64_intdigest
    votes, total, carry = np.zeros(64, np.int64), 0, []
    data = text.encode().lower()  # of bytes, only A-Z change
    start = 0
    while start < len(data) or not start:
        end = start + RUN_CHARS
        while end < len(data) and data[end] not in b" \t\n\r\v\f":
            end += 1
        words = [*carry, *data[start:end].split()]
        start = end + 1
        last = start >= len(data)
        if last and not total and len(words) < shingle:
            shingles = [b" ".join(words)] if words else []
        else:
            shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
        hashes = np.array([digest(s, SEED) for s in shingles], ">u8")
        if len(hashes):
            votes += np.unpackbits(hashes.view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
            total += len(hashes)
        carry = words[len(words) - min(len(words), shingle - 1) :]
    return np.packbits(2 * votes > total).tobytes()


def fingerprints(documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """All columns but the text, and fingerprint (long) of each whole text; null is empty, without words zero."""
    carried = [c for c in documents.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in slices(batch, "text", RUN_CHARS):
                found = np.frombuffer(b"".join(fingerprint(t, shingle) for t in texts), ">i8")
                own = [batch.column(c).slice(first, len(texts)) for c in carried]
                yield pa.RecordBatch.from_arrays(
                    [*own, pa.array(found.astype(np.int64))], names=[*carried, "fingerprint"]
                )

    return documents.mapInArrow(run, with_fields(documents.select(*carried), "fingerprint long"))


def embedding(fingerprint: Column) -> Column:
    """The counts of the two-bit segments, each in unary in its segment."""
    next_bit = F.shiftrightunsigned(fingerprint, 1)
    any_set = fingerprint.bitwiseOR(next_bit).bitwiseAND(F.lit(_LOW))
    all_set = fingerprint.bitwiseAND(next_bit).bitwiseAND(F.lit(_LOW))
    return any_set.bitwiseOR(F.shiftleft(all_set, 1))


def manhattan(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def grid_masks(max_bits: int, groups: int) -> list[int]:
    """For each choice of groups to leave out, the bits of the coordinates that stay."""
    of_group = [sum(0b11 << 2 * c for c in range(g, _COORDINATES, groups)) for g in range(groups)]
    everything = (1 << 64) - 1
    return [everything & ~sum(left) for left in combinations(of_group, max_bits)]


def links(distinct: DataFrame, max_bits: int = MAX_BITS, groups: int = GROUPS) -> DataFrame:
    """(u, v): pairs of distinct fingerprints that differ in at most max_bits bits, u < v.

    A pair may come more than once, from several cells.
    """
    masks = grid_masks(max_bits, groups)
    code = embedding(F.col("fingerprint"))
    cells = F.array(*(code.bitwiseAND(F.lit(_signed(mask))) for mask in masks))
    dealt = distinct.select("fingerprint", F.posexplode(cells).alias("grid", "cell"))
    left = dealt.select(F.col("fingerprint").alias("u"), "grid", "cell")
    right = dealt.select(F.col("fingerprint").alias("v"), "grid", "cell")
    near = manhattan(embedding(F.col("u")), embedding(F.col("v"))) <= max_bits
    exact = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits
    return left.join(right, ["grid", "cell"]).where((F.col("u") < F.col("v")) & near & exact).select("u", "v")


def _rooted(nodes: DataFrame, max_bits: int, groups: int) -> DataFrame:
    """fingerprint, least, root: distinct fingerprints with the root of their component."""
    found = components(links(nodes.select("fingerprint"), max_bits, groups))
    return nodes.join(found, F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
    )


def near_duplicates(
    documents: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, groups: int = GROUPS
) -> DataFrame:
    """doc_id, fingerprint (hex), component_id: the smallest doc_id reachable over links.

    Rows with equal fingerprints are one node, whose least doc_id stands for it, so
    a group of copies costs one row in the join whatever its size.  Null doc_ids
    count as largest: a component of them alone has a null component_id.
    """
    docs = staged(fingerprints(documents.select("doc_id", "text"), shingle), "fingerprints")
    nodes = docs.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    roots = _rooted(nodes, max_bits, groups)
    named = roots.groupBy(F.col("root").alias("of_root")).agg(F.min("least").alias("component_id"))
    named = roots.join(named, F.col("root") == F.col("of_root")).select(
        F.col("fingerprint").alias("of"), "component_id"
    )
    hexed = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return docs.join(named, F.col("fingerprint") == F.col("of")).select(
        "doc_id", hexed.alias("fingerprint"), "component_id"
    )


def text_hashes(doc_id: str = "doc_id", text: str = "text") -> tuple[Column, Column]:
    """Two hashes that with each other tell a row by its doc_id and text."""
    return F.xxhash64(doc_id, text), F.xxhash64(F.lit(1), doc_id, text)


def survivors(
    documents: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, groups: int = GROUPS
) -> DataFrame:
    """(a, b): the text_hashes of one row of each component, the least by (doc_id, hashes); null doc_ids last."""
    a, b = text_hashes()
    hashed = documents.select("doc_id", "text", a.alias("a"), b.alias("b"))
    docs = staged(fingerprints(hashed, shingle), "fingerprints")
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "a", "b")
    nodes = docs.groupBy("fingerprint").agg(F.min(row).alias("least"))
    first = _rooted(nodes, max_bits, groups).groupBy("root").agg(F.min("least").alias("first"))
    return first.select("first.a", "first.b")
