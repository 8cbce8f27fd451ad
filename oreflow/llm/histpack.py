"""Packing by non-negative least squares over the histogram of lengths.

Only the lengths decide where documents go.  Their histogram, at most ``capacity``
numbers, is all the driver sees.  It enumerates shallow combinations of lengths
that fill a window exactly, finds by non-negative least squares how often to use
each so that together they give the histogram, rounds, and packs what is left
greedily.  Greedy windows that are not full are taken apart again: their documents
are strung together and the string is cut where a window is full.  So only its
last window is short; that one is cut at powers of two, which need no padding.

Each document finds its place by its rank among those of its length, numbered by
the tasks that read the texts: no sort and no window over a length.  Ids travel only
with documents of lengths that may be cut.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oreflow.llm.common import slices, staged
from oreflow.llm.tokens import RUN_CHARS, encoder, word_chunks

CAPACITY = 2048
END_ID = 1
#: Coordinates that one round of the solver looks at again, and the rounds at most.
ROUND = 1024
ROUNDS = 40
#: The solver stops when a round lowers the squared error by less than this share.
GAIN = 1e-3


@dataclass(frozen=True)
class Plan:
    """Windows of whole documents, and how many documents of a length are strung together."""

    #: ((length, copies), ...) and how many such windows
    patterns: list[tuple[tuple[tuple[int, int], ...], int]]
    #: length -> documents, longest first
    strung: dict[int, int]


def combinations(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Lengths and copies of each combination that adds up to the capacity, three kinds at most.

    One or two kinds in any number of copies (short documents fill a window only in
    many), or three kinds, one of each.  Unused kinds have length 0 and no copies.
    """
    have = np.zeros(capacity + 1, bool)
    have[lengths] = True
    kinds, copies = [], []

    def add(*parts: tuple[np.ndarray | int, np.ndarray | int]) -> None:
        size = max(np.size(kind) for kind, _ in parts)
        padded = [*parts, *[(0, 0)] * (3 - len(parts))]
        kinds.append(np.stack([np.broadcast_to(kind, size) for kind, _ in padded], 1))
        copies.append(np.stack([np.broadcast_to(count, size) for _, count in padded], 1))

    for a in lengths[::-1].tolist():
        if capacity % a == 0:
            add((a, capacity // a))
        for count in range(1, (capacity - 1) // a + 1):
            gap = capacity - a * count
            shorter = lengths[(lengths < a) & (lengths <= gap)]
            shorter = shorter[gap % shorter == 0]
            if len(shorter):
                add((a, count), (shorter, gap // shorter))
        middle = np.arange((capacity - a) // 2 + 1, min(a, capacity - a))
        middle = middle[have[middle]]
        middle = middle[have[capacity - a - middle]]
        if len(middle):
            add((a, 1), (middle, 1), (capacity - a - middle, 1))
    if not kinds:
        return np.zeros((0, 3), np.int64), np.zeros((0, 3), np.int64)
    return np.concatenate(kinds), np.concatenate(copies)


def solve(kinds: np.ndarray, copies: np.ndarray, histogram: np.ndarray) -> np.ndarray:
    """x >= 0 with the least squared error of A x against the histogram, by coordinate descent.

    Each round takes the coordinates that lower the error most and sets each to its
    best value in turn.  A good start for rounding is all that is wanted: it ends when a round
    gains little.
    """
    x = np.zeros(len(kinds))
    left = histogram.astype(float)
    square = (copies * copies).sum(1)
    error = float(left @ left)
    for _ in range(ROUNDS if len(kinds) else 0):
        step = np.maximum((copies * left[kinds]).sum(1) / square, -x)
        gain = step * step * square
        take = np.argsort(-gain, kind="stable")[:ROUND]
        for i in take[gain[take] > 0].tolist():
            at, times = kinds[i], copies[i]
            move = max(float(times @ left[at]) / square[i], -x[i])
            x[i] += move
            left[at] -= move * times
            left[0] = 0
        before, error = error, float(left @ left)
        if before - error < GAIN * before:
            break
    return x


def _rounded(x: np.ndarray, kinds: np.ndarray, copies: np.ndarray, stock: np.ndarray) -> list:
    """The repeat counts as whole numbers, as far as the stock goes; the stock shrinks.

    First each to its nearest, then, where the stock still allows, one more of those rounded down.
    """
    out, nearest = [], np.floor(x + 0.5).astype(np.int64)
    order = np.argsort(-x, kind="stable")[: np.count_nonzero(x)]
    for wanted in (nearest, (x > nearest).astype(np.int64)):
        for i in order[wanted[order] > 0].tolist():
            parts = [(int(k), int(c)) for k, c in zip(kinds[i], copies[i], strict=True) if c]
            times = min(int(wanted[i]), *(int(stock[k]) // c for k, c in parts))
            if times:
                for kind, count in parts:
                    stock[kind] -= count * times
                out.append((tuple(parts), times))
    return out


def _greedy(stock: np.ndarray, capacity: int) -> tuple[list, dict[int, int]]:
    """Longest first, each gap taking the longest that fits; what fills no window is strung together."""
    full, strung = [], {}
    while len(held := np.flatnonzero(stock)):
        parts: dict[int, int] = {}
        gap = capacity
        while len(fits := held[held <= gap]):
            kind = int(fits[-1])
            count = min(gap // kind, int(stock[kind]))
            parts[kind] = count
            gap -= kind * count
            held = fits[:-1]
        times = min(int(stock[kind]) // count for kind, count in parts.items())
        for kind, count in parts.items():
            stock[kind] -= count * times
            if gap:
                strung[kind] = strung.get(kind, 0) + count * times
        if not gap:
            full.append((tuple(parts.items()), times))
    return full, dict(sorted(strung.items(), reverse=True))


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Where documents of lengths 1 to the capacity go, from their number alone."""
    stock = np.zeros(capacity + 1, np.int64)
    for length, count in counts.items():
        stock[length] = count
    kinds, copies = combinations(np.flatnonzero(stock), capacity)
    patterns = _rounded(solve(kinds, copies, stock), kinds, copies, stock)
    full, strung = _greedy(stock, capacity)
    return Plan(patterns + full, strung)


def _ends(total: int, capacity: int) -> np.ndarray:
    """Where the windows behind the last full one end: the rest in powers of two, largest first."""
    at, rest, out = total - total % capacity, total % capacity, []
    for bit in range(rest.bit_length() - 1, -1, -1):
        if rest >> bit & 1:
            at += 1 << bit
            out.append(at)
    return np.array(out, np.int64)


class _Places:
    """Finds the place of the document of a rank among those of its length."""

    def __init__(self, drawn: Plan, capacity: int):
        rows, used, sequence = [], {}, 0
        for parts, times in drawn.patterns:
            offset = 0
            for length, copies in parts:
                rank = used.get(length, 0)
                rows.append((length << 40 | rank, rank, sequence, copies, offset))
                used[length] = rank + times * copies
                offset += length * copies
            sequence += times
        self.parts = np.array(sorted(rows), np.int64).reshape(-1, 5)
        self.capacity, self.first = capacity, sequence
        self.used = np.zeros(capacity + 1, np.int64)
        for length, count in used.items():
            self.used[length] = count
        self.base = np.zeros(capacity + 1, np.int64)
        total = 0
        for length, count in drawn.strung.items():
            self.base[length] = total
            total += length * count
        self.whole = total // capacity
        self.ends = _ends(total, capacity)

    def in_pattern(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of documents that stay whole."""
        start = np.searchsorted(self.parts[:, 0], length << 40 | rank, side="right") - 1
        _, first, sequence, copies, offset = self.parts[start].T
        nth = rank - first
        return sequence + nth // copies, offset + nth % copies * length

    def on_string(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """(start in the document, length, sequence, offset) of the pieces of a strung document."""
        at = int(self.base[length]) + (rank - int(self.used[length])) * length
        stop, out, begun = at + length, [], at
        while begun < stop:
            window = begun // self.capacity
            low, high, sequence = window * self.capacity, (window + 1) * self.capacity, self.first + window
            if window == self.whole:  # the short rest
                nth = int(np.searchsorted(self.ends, begun, side="right"))
                low = int(self.ends[nth - 1]) if nth else low
                high, sequence = int(self.ends[nth]), sequence + nth
            until = min(stop, high)
            out.append((begun - at, until - begun, sequence, begun - low))
            begun = until
        return out


def token_windows(
    documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """The ids of each text with the end id behind it, in full windows and a rest.

    Columns: doc_id, start, length, ids_crc32, doc_tokens, part and nth (which count the
    pieces of a length in a task) and ids, the bytes of the rest's ids (null for
    full windows, which are never cut).
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer, word_chunks)
        kind = _kind(max(own.largest_id, end_id))
        end, part = np.array([end_id], np.uint32), TaskContext.get().partitionId()
        met = np.zeros(capacity + 1, np.int64)
        for batch in batches:
            doc_ids = batch.column("doc_id")
            for first, texts in slices(batch, "text", RUN_CHARS):
                rows = []
                for at, ids in enumerate(own.encode(texts), first):
                    ids = np.concatenate([ids, end])
                    for start in range(0, len(ids), capacity):
                        piece = ids[start : start + capacity]
                        size = len(piece)
                        code = zlib.crc32(piece.astype("<u4").tobytes())
                        held = piece.astype(kind).tobytes() if size < capacity else None
                        rows.append((at, start, size, code, len(ids), part, int(met[size]), held))
                        met[size] += 1
                at, *rest = zip(*rows, strict=True)
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_ids.take(pa.array(at, pa.int64())),
                        *(pa.array(values, kind) for values, kind in zip(rest, kinds, strict=True)),
                    ],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "part", "nth", "ids"],
                )

    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(
        cut,
        f"doc_id {kind}, start long, length int, ids_crc32 long, doc_tokens long, part int, nth long, ids binary",
    )


def _kind(largest: int) -> str:
    """Ids are kept in two bytes where they fit."""
    return "<u2" if largest < 1 << 16 else "<u4"


def pack(windows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of written ``token_windows`` with sequence_id and offset; strung ones may be cut again.

    A length that most documents share is numbered like any other: its documents
    are counted by task, and the counts of tasks, not the documents, are summed up.
    """
    spark = windows.sparkSession
    sizes = staged(windows.groupBy("length", "part").agg(F.count("*").alias("n")), "sizes")
    counts = sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()
    drawn = plan({row["length"]: row["n"] for row in counts}, capacity)
    places = spark.sparkContext.broadcast(_Places(drawn, capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = sizes.select("length", "part", (F.sum("n").over(before) - F.col("n")).alias("before"))
    cuttable = F.col("length").isin(*drawn.strung) if drawn.strung else F.lit(False)
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    ranked = windows.withColumn("ids", F.when(cuttable, F.col("ids"))).join(starts, ["length", "part"])
    ranked = ranked.select(*columns, (F.col("nth") + F.col("before")).alias("rank"), "ids")
    schema = windows.select(*columns).schema.add("sequence_id", "long").add("offset", "long")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = places.value
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column("rank").to_numpy(zero_copy_only=False)
            whole = rank < at.used[length]
            stays = batch.filter(pa.array(whole))
            sequence, offset = at.in_pattern(length[whole], rank[whole])
            yield pa.RecordBatch.from_arrays(
                [*map(stays.column, columns), pa.array(sequence), pa.array(offset)], schema=stays_schema(stays)
            )
            strung = batch.filter(pa.array(~whole))
            if strung.num_rows:
                yield cut(at, strung)

    def stays_schema(batch: pa.RecordBatch) -> pa.Schema:
        kept = [batch.schema.field(name) for name in columns]
        return pa.schema([*kept, ("sequence_id", pa.int64()), ("offset", pa.int64())])

    def cut(at: _Places, strung: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for i, row in enumerate(strung.select(["start", "length", "ids_crc32", "rank", "ids"]).to_pylist()):
            pieces = at.on_string(row["length"], row["rank"])
            width = len(row["ids"]) // row["length"]
            for begun, size, sequence, offset in pieces:
                code = row["ids_crc32"]
                if len(pieces) > 1:
                    part = np.frombuffer(row["ids"], f"<u{width}", size, begun * width)
                    code = zlib.crc32(part.astype("<u4").tobytes())
                rows.append((i, row["start"] + begun, size, code, sequence, offset))
        i, start, size, code, sequence, offset = (np.array(x) for x in zip(*rows, strict=True))
        taken = strung.take(pa.array(i))
        return pa.RecordBatch.from_arrays(
            [
                taken.column("doc_id"),
                pa.array(start, pa.int64()),
                pa.array(size, pa.int32()),
                pa.array(code, pa.int64()),
                taken.column("doc_tokens"),
                pa.array(sequence, pa.int64()),
                pa.array(offset, pa.int64()),
            ],
            schema=stays_schema(taken),
        )

    return ranked.mapInArrow(place, schema)


def pack_documents(
    documents: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of the packed pieces.

    Every id of every text lies in one piece.  Sequences hold ``capacity`` ids, but
    for a few at powers of two at the end: none is padded.  Null and empty texts
    are the end id alone; texts of any length are tokenized whole; repeated rows
    are packed each; further columns are not read.  An empty table gives no rows.
    """
    return pack(staged(token_windows(documents, tokenizer, capacity, end_id), "windows"), capacity)
