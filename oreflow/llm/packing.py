"""Best-fit packing of pieces into sequences, by exact-complement hashing.

Only the lengths decide where pieces go, and there are at most ``capacity``
lengths.  The counts of the lengths are one small aggregate; from it the driver
draws up *patterns* (so many sequences of lengths a + b + c), never seeing a
piece.  A pattern is used as often as its rarest length allows, so there are a
few thousand patterns for any number of pieces.  Each piece then finds its place
from its rank among the pieces of its length.

Drawing up: lengths from the longest; the gap that one leaves is looked up among
single lengths, then sums of pairs, then sums of triples that are still in
stock.  What no combination fills exactly goes best fit, longest first.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oreflow.llm.common import slices, staged
from oreflow.llm.tokens import RUN_CHARS, blank_chunks, encoder

CAPACITY = 2048
END_ID = 0
#: Pieces of one length are numbered in shares of about so many.
SHARE = 20_000

#: (length, copies in one sequence) of each part, and the number of such sequences.
Pattern = tuple[tuple[tuple[int, int], ...], int]


class _Stock:
    """Counts of lengths, and which sums of one, two or three of them are in stock."""

    def __init__(self, counts: dict[int, int], capacity: int):
        self.counts = np.zeros(capacity + 1, np.int64)
        for length, count in counts.items():
            self.counts[length] = count

    def times(self, parts: tuple[int, ...]) -> int:
        """So many sequences of these parts at most."""
        return min(int(self.counts[p]) // parts.count(p) for p in parts)

    def pair(self, total: int) -> tuple[int, int] | None:
        """The pair of that sum of which most are in stock."""
        if total < 2:
            return None
        low = np.arange(1, total // 2 + 1)
        most = np.minimum(self.counts[low], self.counts[total - low])
        if total % 2 == 0:
            most[-1] //= 2
        at = int(most.argmax())
        return (total - int(low[at]), int(low[at])) if most[at] else None

    def sums_of_pairs(self) -> int:
        """Bit s is set if lengths a + b = s are in stock."""
        have = np.flatnonzero(self.counts).tolist()
        single = sum(1 << a for a in have)
        return self._shifted(single, have)

    @staticmethod
    def _shifted(bits: int, by: list[int]) -> int:
        out = 0
        for a in by:
            out |= bits << a
        return out

    def triple(self, total: int) -> tuple[int, ...] | None:
        pairs = self.sums_of_pairs()
        for first in np.flatnonzero(self.counts[: max(total - 1, 1)])[::-1].tolist():
            if pairs >> (total - first) & 1:
                self.counts[first] -= 1
                rest = self.pair(total - first)
                self.counts[first] += 1
                if rest:
                    return first, *rest
        return None

    def filling(self, length: int, capacity: int) -> tuple[int, ...] | None:
        """Parts with ``length`` that add up to the capacity, if there are such."""
        gap = capacity - length
        if gap == 0:
            return (length,)
        self.counts[length] -= 1
        rest = (gap,) if self.counts[gap] else self.pair(gap) or self.triple(gap)
        self.counts[length] += 1
        return (length, *rest) if rest else None


def patterns(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns that use up all lengths, each from 1 to the capacity."""
    stock, out, left = _Stock(counts, capacity), [], {}
    for length in range(capacity, 0, -1):
        while stock.counts[length]:
            parts = stock.filling(length, capacity)
            if parts is None:
                left[length] = int(stock.counts[length])
                stock.counts[length] = 0
                break
            times = stock.times(parts)
            for part in parts:
                stock.counts[part] -= times
            out.append((_grouped(parts), times))
    return out + _best_fit(left, capacity)


def _grouped(parts: tuple[int, ...]) -> tuple[tuple[int, int], ...]:
    return tuple((p, parts.count(p)) for p in sorted(set(parts), reverse=True))


def _best_fit(left: dict[int, int], capacity: int) -> list[Pattern]:
    """Longest first, each into the smallest gap that holds it; equal ones in one go."""
    open_: dict[int, list[list]] = {capacity: []}  # gap -> [[parts, sequences], ...]
    for length in sorted(left, reverse=True):
        count = left[length]
        while count:
            gap = min((g for g, runs in open_.items() if g >= length and runs), default=capacity)
            copies = gap // length
            if gap == capacity:  # new sequences: all full, then one with what is left
                parts, have = (), -(-count // copies)
            else:
                parts, have = open_[gap].pop()
            full = min(have, count // copies)
            for times, each in ((full, copies), (full < have, count - full * copies)):
                if times and each:
                    open_.setdefault(gap - each * length, []).append(
                        [(*parts, (length, each)), int(times)]
                    )
                    count -= times * each
                    have -= times
            if have and gap < capacity:
                open_[gap].append([parts, have])
    return [(tuple(parts), times) for runs in open_.values() for parts, times in runs]


def _places(plan: list[Pattern]) -> dict[str, np.ndarray]:
    """For each part of each pattern: from which rank of its length on it holds, and where."""
    rows, used, sequence = [], {}, 0
    for parts, times in plan:
        offset = 0
        for length, copies in parts:
            rank = used.get(length, 0)
            rows.append((length, rank, sequence, copies, offset))
            used[length] = rank + times * copies
            offset += length * copies
        sequence += times
    rows.sort()
    names = ("length", "rank", "sequence", "copies", "offset")
    columns = np.array(rows, np.int64).reshape(-1, len(names)).T
    return dict(zip(names, columns, strict=True))


def pack(pieces: DataFrame, keys: list[str], capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``.

    ``length`` is an integer from 1 to the capacity; ``keys`` tell pieces apart
    (rows that agree in them and in length may change places).  Offsets of a
    sequence have no gaps.  An empty table gives an empty table.

    One hot length is numbered in shares, each a window of its own; the driver
    sees one row for each length.  ``pieces`` is read more than once: pass a
    written table, whose rows are the same each time.
    """
    spark = pieces.sparkSession
    columns = pieces.columns
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = spark.sparkContext.broadcast(_places(patterns(counts, capacity)))
    shares = spark.createDataFrame(
        [(length, -(-count // SHARE)) for length, count in sorted(counts.items())],
        "length int, __shares int",
    )
    dealt = pieces.withColumn("length", F.col("length").cast("int")).join(F.broadcast(shares), "length")
    dealt = dealt.withColumn("__share", F.pmod(F.xxhash64(*keys), F.col("__shares")).cast("int"))
    sizes = dealt.groupBy("length", "__share").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("length").orderBy("__share").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "length", "__share", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before")
    )
    inside = Window.partitionBy("length", "__share").orderBy(*keys)
    ranked = (
        dealt.withColumn("__rank", F.row_number().over(inside) - 1)
        .join(starts, ["length", "__share"])
        .withColumn("__rank", F.col("__rank") + F.col("__before"))
        .select(*columns, "__rank")
    )
    schema = pieces.withColumn("length", F.col("length").cast("int")).schema
    schema = schema.add("sequence_id", "long").add("offset", "long")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = places.value
        start = at["length"] << 40 | at["rank"]
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column("__rank").to_numpy(zero_copy_only=False).astype(np.int64)
            part = np.searchsorted(start, length << 40 | rank, side="right") - 1
            nth = rank - at["rank"][part]
            copies = at["copies"][part]
            sequence = at["sequence"][part] + nth // copies
            offset = at["offset"][part] + nth % copies * length
            kept = [batch.column(name) for name in columns]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sequence), pa.array(offset)], names=[*columns, "sequence_id", "offset"]
            )

    return ranked.mapInArrow(place, schema)


def token_pieces(
    documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """Pieces of at most ``capacity`` ids of each text, with the end id behind each text.

    ``tokenizer`` is the path of a tokenizer that drops white space.  Columns:
    doc_id, piece, start, length, ids_crc32.  Null text is empty: one piece, the
    end id.  Each row of ``documents`` gives its own pieces, repeated rows too;
    further columns are not read.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer, blank_chunks)
        end = np.array([end_id], np.uint32)
        for batch in batches:
            doc_ids = batch.column("doc_id")
            for first, texts in slices(batch, "text", RUN_CHARS):
                rows = []
                for at, ids in enumerate(own.encode(texts), first):
                    ids = np.concatenate([ids, end])
                    for piece, start in enumerate(range(0, len(ids), capacity)):
                        part = ids[start : start + capacity]
                        rows.append((at, piece, start, len(part), zlib.crc32(part.astype("<u4").tobytes())))
                at, *rest = (np.array(x) for x in zip(*rows, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_ids.take(pa.array(at)),
                        *(
                            pa.array(x, kind)
                            for x, kind in zip(
                                rest, (pa.int32(), pa.int64(), pa.int32(), pa.int64()), strict=True
                            )
                        ),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        cut, f"doc_id {kind}, piece int, start long, length int, ids_crc32 long"
    )


def pack_documents(
    documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """token_pieces, packed; the pieces are written once to the shared scratch."""
    pieces = staged(token_pieces(documents, tokenizer, capacity, end_id), "pieces")
    return pack(pieces, ["doc_id", "piece", "ids_crc32"], capacity)
