"""Token ids in files of independent zstandard frames, with a seek table at the end.

A file is a row of zstandard frames, as any zstandard reader can read it:

* data frames: whole documents in ascending order, each frame compressed alone;
* a skippable frame with the first and last document id of each data frame;
* a skippable frame with the seek table: for each frame its compressed and plain
  size and the low half of the XXH64 of its plain bytes; then the number of frames,
  a byte that says there are checksums, and the closing magic number.

A reader takes the seek table from the end, picks the frames that hold the
documents it wants, and decompresses and checks only these.

Plain bytes of a data frame: number of documents and bytes an id (uint32 each); for
each document its id (int64), whether the id is null (uint8), ids of the file before
it (uint64) and its number of ids (uint32); then the ids.  All little-endian.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from oreflow.llm.common import new_folder, slices
from oreflow.llm.tokens import RUN_CHARS, encoder, spaced_chunks

END_ID = 2
#: A frame is closed when it holds so many ids.  A longer document has a frame of its own.
FRAME_IDS = 1 << 18
LEVEL = 3

# Fixed values of the seekable form of zstandard.
SKIPPABLE = 0x184D2A50
SEEK_TABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
WITH_CHECKSUMS = 0x80


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a Spark path, and the path there; works inside tasks."""
    scheme, colon, rest = uri.partition(":")
    if colon and scheme in ("s3a", "s3n"):
        uri = f"s3:{rest}"
    if colon and scheme == "file":
        uri = f"/{rest.lstrip('/')}"
    return pafs.FileSystem.from_uri(uri)


def _checksum(plain: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(plain, 0) & 0xFFFFFFFF


@dataclass(frozen=True)
class Document:
    doc_id: int | None
    start: int  # ids of the file before it
    ids: np.ndarray


class Writer:
    """Writes documents, given in ascending order, to a stream."""

    def __init__(self, stream: pa.NativeFile, width: int = 4, frame_ids: int = FRAME_IDS):
        import zstandard

        self._compress = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True).compress
        self._stream, self._width, self._most = stream, width, frame_ids
        self._held: list[Document] = []
        self._held_ids = 0
        self._table: list[tuple[int, int, int]] = []
        self._range: list[tuple[int, int, int, int]] = []
        self.documents = self.ids = 0

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        if self._held and self._held_ids + len(ids) > self._most:
            self._close_frame()
        self._held.append(Document(doc_id, self.ids, ids))
        self._held_ids += len(ids)
        self.documents += 1
        self.ids += len(ids)

    def _close_frame(self) -> None:
        held, self._held, self._held_ids = self._held, [], 0
        named = [d.doc_id for d in held]
        plain = b"".join(
            [
                struct.pack("<II", len(held), self._width),
                np.array([n or 0 for n in named], "<i8").tobytes(),
                np.array([n is None for n in named], "u1").tobytes(),
                np.array([d.start for d in held], "<u8").tobytes(),
                np.array([len(d.ids) for d in held], "<u4").tobytes(),
                *(d.ids.astype(f"<u{self._width}").tobytes() for d in held),
            ]
        )
        packed = self._compress(plain)
        self._stream.write(packed)
        self._table.append((len(packed), len(plain), _checksum(plain)))
        have = [n for n in named if n is not None]
        self._range.append((min(have, default=1), max(have, default=0), None in named, len(held)))

    def close(self) -> None:
        if self._held:
            self._close_frame()
        ranges = b"".join(struct.pack("<qqII", *r) for r in self._range)
        self._stream.write(struct.pack("<II", SKIPPABLE, len(ranges)) + ranges)
        self._table.append((8 + len(ranges), 0, _checksum(b"")))
        entries = b"".join(struct.pack("<III", *e) for e in self._table)
        footer = struct.pack("<IBI", len(self._table), WITH_CHECKSUMS, SEEKABLE)
        size = len(entries) + len(footer)
        self._stream.write(struct.pack("<II", SEEK_TABLE, size) + entries + footer)


class Reader:
    """Documents of one file; frames are decompressed as they are asked for."""

    def __init__(self, stream: pa.NativeFile):
        import zstandard

        self._decompress = zstandard.ZstdDecompressor().decompress
        self._stream = stream
        size = stream.size()
        footer = self._at(size - 9, 9)
        number, flags, magic = struct.unpack("<IBI", footer)
        if magic != SEEKABLE or flags != WITH_CHECKSUMS:
            raise ValueError("no seek table at the end of the file")
        entries = self._at(size - 9 - 12 * number, 12 * number)
        self._table = np.frombuffer(entries, "<u4").reshape(-1, 3).astype(np.int64)
        self._starts = np.cumsum(self._table[:, 0]) - self._table[:, 0]
        at, length = int(self._starts[-1]), int(self._table[-1, 0])
        kind = np.dtype([("first", "<i8"), ("last", "<i8"), ("null", "<u4"), ("n", "<u4")])
        self.ranges = np.frombuffer(self._at(at + 8, length - 8), kind)
        self.decompressed = 0

    def _at(self, start: int, length: int) -> bytes:
        self._stream.seek(start)
        return self._stream.read(length)

    def frame(self, number: int) -> list[Document]:
        packed, size, checksum = self._table[number].tolist()
        plain = self._decompress(self._at(int(self._starts[number]), packed), max_output_size=size)
        if len(plain) != size or _checksum(plain) != checksum:
            raise ValueError(f"frame {number} is damaged")
        self.decompressed += 1
        n, width = struct.unpack_from("<II", plain)
        at = 8
        parts = []
        for kind in ("<i8", "u1", "<u8", "<u4"):
            parts.append(np.frombuffer(plain, kind, n, at))
            at += n * np.dtype(kind).itemsize
        doc_ids, null, starts, counts = (part.tolist() for part in parts)
        ids = np.frombuffer(plain, f"<u{width}", -1, at)
        ends = np.cumsum(counts).tolist()
        return [
            Document(None if null[i] else doc_ids[i], starts[i], ids[ends[i] - counts[i] : ends[i]])
            for i in range(n)
        ]

    def documents(self) -> Iterator[Document]:
        for number in range(len(self.ranges)):
            yield from self.frame(number)

    def find(self, wanted: Iterable[int | None]) -> list[Document]:
        """The documents of these ids; only frames that may hold one are decompressed."""
        wanted = set(wanted)
        named = np.array(sorted(w for w in wanted if w is not None), np.int64)
        low = np.searchsorted(named, self.ranges["first"])
        high = np.searchsorted(named, self.ranges["last"], side="right")
        hit = (low < high) | (np.bool_(None in wanted) & (self.ranges["null"] > 0))
        return [d for k in np.flatnonzero(hit) for d in self.frame(int(k)) if d.doc_id in wanted]


def write_documents(
    documents: DataFrame, tokenizer: str, folder: str, end_id: int = END_ID
) -> DataFrame:
    """Write the ids of each whole text with the end id behind it; returns the files.

    Documents go by ascending doc_id (null first; rows that repeat a doc_id by the
    hash of their texts).  One file a task, named anew at each attempt: what a lost
    attempt wrote is in no list.  The list (shard, path, documents, ids, before: ids
    of all files before) is a table of its own, one row a file.  Null text is empty.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    if kind not in ("bigint", "int", "smallint", "tinyint"):
        raise TypeError(f"doc_id must be an integer, not {kind}")
    files = f"{folder}/files"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, shard = encoder(tokenizer, spaced_chunks), TaskContext.get().partitionId()
        width = 2 if own.largest_id < 1 << 16 and end_id < 1 << 16 else 4
        end = np.array([end_id], np.uint32)
        system, root = file_system(files)
        writer = stream = path = None
        for batch in batches:
            for first, texts in slices(batch, "text", RUN_CHARS):
                if writer is None:
                    system.create_dir(root, recursive=True)
                    path = f"{shard:06d}-{uuid.uuid4().hex}.zst"
                    stream = system.open_output_stream(f"{root}/{path}", compression=None)
                    writer = Writer(stream, width)
                doc_ids = batch.column("doc_id").slice(first, len(texts)).to_pylist()
                for doc_id, ids in zip(doc_ids, own.encode(texts), strict=True):
                    writer.add(doc_id, np.concatenate([ids, end]))
        if writer is not None:
            writer.close()
            stream.close()
            yield pa.RecordBatch.from_pylist(
                [{"shard": shard, "path": path, "documents": writer.documents, "ids": writer.ids}],
                pa.schema(
                    [("shard", pa.int32()), ("path", pa.string()), ("documents", pa.int64()), ("ids", pa.int64())]
                ),
            )

    by = [F.col("doc_id"), F.xxhash64("text")]
    ordered = (
        documents.select("doc_id", "text")
        .repartitionByRange(*by)
        .sortWithinPartitions(*by)
        .mapInArrow(write, "shard int, path string, documents long, ids long")
    )
    ordered.write.parquet(f"{folder}/list")
    listed = documents.sparkSession.read.schema(ordered.schema).parquet(f"{folder}/list")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return listed.select(
        "shard",
        F.concat(F.lit(f"{files}/"), "path").alias("path"),
        "documents",
        "ids",
        F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("before"),
    )


def _one_a_task(listed: DataFrame) -> DataFrame:
    return listed.repartition(max(1, listed.count()))


def read_documents(listed: DataFrame, with_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32, ids of every document, from the files; a task a file.

    ``with_ids=False`` reads and checks the ids all the same and leaves them there.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                system, path = file_system(row["path"])
                with system.open_input_file(path) as stream:
                    reader = Reader(stream)
                    for number in range(len(reader.ranges)):
                        held = reader.frame(number)
                        crc = [zlib.crc32(d.ids.astype("<u4").tobytes()) for d in held]
                        columns = [
                            pa.array([d.doc_id for d in held], pa.int64()),
                            pa.array([row["before"] + d.start for d in held], pa.int64()),
                            pa.array([len(d.ids) for d in held], pa.int64()),
                            pa.array(crc, pa.int64()),
                        ]
                        if with_ids:
                            ids = np.concatenate([d.ids for d in held]).astype(np.int32)
                            ends = np.cumsum([0, *(len(d.ids) for d in held)])
                            columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids)))
                        yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids]
    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids
    return _one_a_task(listed).mapInArrow(read, schema)


def find_documents(listed: DataFrame, wanted: list[int | None]) -> DataFrame:
    """doc_id, ids of a few documents: each file decompresses the frames that hold them."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("path").to_pylist():
                system, path = file_system(path)
                with system.open_input_file(path) as stream:
                    found = Reader(stream).find(wanted)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([d.doc_id for d in found], pa.int64()),
                        pa.array([d.ids.tolist() for d in found], pa.list_(pa.int32())),
                    ],
                    names=["doc_id", "ids"],
                )

    return _one_a_task(listed).mapInArrow(read, "doc_id long, ids array<int>")


def round_trip(documents: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """Write to the shared scratch and read back: all but the ids themselves."""
    folder = new_folder(documents.sparkSession, "token-files")
    return read_documents(write_documents(documents, tokenizer, folder, end_id), with_ids=False)
