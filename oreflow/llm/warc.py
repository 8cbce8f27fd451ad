"""Captures to WARC archives and back: transaction assembly.

Each capture is written as three records, each a gzip member of its own: the
response (or a revisit that refers to the response with the same payload), the
request, and metadata; the last two name the first in WARC-Concurrent-To.  Reading
parses records block by block and joins them through these identifiers into one
nested row a capture.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from oreflow.llm.common import new_folder, staged
from oreflow.llm.seekable import file_system

#: An archive is listed in blocks of about so many bytes; a task reads one.
BLOCK_BYTES = 8 << 20
LEVEL = 1
#: Rows that are all alike are made again in shares of so many.
COPIES = 1000
#: Payloads shorter than this are always written in full.
LEAST_PAYLOAD = 0
DATE = "2000-01-01T00:00:00Z"

# Fixed values of the format.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_LINE_BREAKING = re.compile(r"[\x00-\x20\x7f]")


def _safe(value: str) -> str:
    """A header value cannot break its line."""
    return _LINE_BREAKING.sub(lambda m: f"%{ord(m.group()):02X}", value)


def _record(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = [f"{name}: {value}\r\n" for name, value in headers if value is not None]
    head = "".join(["WARC/1.1\r\n", *lines, f"Content-Length: {len(block)}\r\n\r\n"]).encode()
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(head) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


def capture_id(page_id: int | None, digest: str, more: str = "") -> str:
    return f"<urn:x-capture:{'' if page_id is None else page_id}:{digest}{more and f':{more}'}>"


def _path_and_host(url: str | None) -> tuple[str, str]:
    """Of a request; ``/`` and no host where the URL has none that can be told."""
    try:
        parts = urlsplit(url or "")
    except ValueError:  # brackets that hold no address, a host that Unicode forbids
        return "/", ""
    return parts.path or "/", parts.netloc


def _transaction(row: dict, name: str, revisit_of: str | None) -> bytes:
    """The three records of a capture; ``name`` is the identifier of the first."""
    digest = f"sha1:{row['digest']}"
    url = row["url"] and _safe(row["url"])
    path, host = _path_and_host(url)
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {row['size']}\r\n\r\n"
    ).encode()
    shared = [("WARC-Date", DATE), ("WARC-Target-URI", url)]
    first = [
        ("WARC-Type", "revisit" if revisit_of else "response"),
        ("WARC-Record-ID", name),
        *shared,
        ("WARC-Payload-Digest", digest),
        ("WARC-Profile", REVISIT_PROFILE if revisit_of else None),
        ("WARC-Refers-To", revisit_of),
        ("Content-Type", "application/http;msgtype=response"),
    ]
    request = f"GET {path} HTTP/1.1\r\nHost: {host}\r\n\r\n".encode()
    fields = f"page-id: {row['page_id']}\r\n".encode() if row["page_id"] is not None else b""
    out = _record(first, http if revisit_of else http + row["payload"])
    for kind, block, content in (
        ("request", request, "application/http;msgtype=request"),
        ("metadata", fields, "application/warc-fields"),
    ):
        own = f"{name[:-1]}:{kind}>"
        headers = [("WARC-Type", kind), ("WARC-Record-ID", own), *shared]
        out += _record([*headers, ("WARC-Concurrent-To", name), ("Content-Type", content)], block)
    return out


def write_archives(pages: DataFrame, folder: str, least_payload: int = LEAST_PAYLOAD) -> DataFrame:
    """Archives of ``pages`` (page_id, url, html) in folder; returns their blocks.

    Of pages with equal payloads of at least ``least_payload`` bytes that with the
    smallest page_id is the response and the others revisit it; null page_ids come
    last.  A row that repeats both page_id and payload revisits the first of them.
    Null html is an empty payload, null urls leave their header out.

    Digests, page_ids and URLs are counted, without payloads; what is known of them then
    meets each row in one join.  No key repeats in it but that of rows which repeat
    all three: those are one row with a count until they are written.  ``pages`` is
    read more than once: pass a written table.  Blocks: path, start, length, one row
    each.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload).alias("sha1"))
    key = ["sha1", "page_id", "url"]
    counted = rows.where(F.octet_length("payload") >= least_payload).groupBy(*key).agg(F.count("*").alias("n"))
    counted = staged(counted, "payloads")
    order = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "url")
    first = counted.groupBy("sha1").agg(F.min(order).alias("first"), F.sum("n").alias("rows"))
    leads = F.col("page_id").eqNullSafe(F.col("first.page_id")) & F.col("url").eqNullSafe(F.col("first.url"))
    equal = counted.join(first.where("rows > 1"), "sha1").select(
        *[F.col(name).alias(f"own_{name}") for name in key],
        F.col("first.page_id").alias("first"),
        leads.alias("leads"),
        "n",
    )
    equal = staged(equal, "equal")
    same = F.lit(True)
    for name in key:
        same = same & F.col(name).eqNullSafe(F.col(f"own_{name}"))
    met = rows.join(equal, same, "left").select(
        *key,
        F.octet_length("payload").alias("size"),
        F.when(F.col("n").isNull() | F.col("leads"), F.col("payload")).alias("payload"),  # others refer to it
        "first",
        "leads",
        F.col("n").isNotNull().alias("equal"),
        "n",
    )
    dealt = met.where("n IS NULL OR n = 1").drop("n")
    if equal.where("n > 1").limit(1).count():
        dealt = dealt.unionByName(_copies(met.where("n > 1"), key))
    files = f"{folder}/archives"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        system, root = file_system(files)
        stream = path = None
        size = start = number = 0
        for batch in batches:
            for row in batch.to_pylist():
                if stream is None:
                    system.create_dir(root, recursive=True)
                    path = f"{task:06d}-{uuid.uuid4().hex}.warc.gz"
                    stream = system.open_output_stream(f"{root}/{path}", compression=None)
                number += 1
                digest = base64.b32encode(bytes.fromhex(row["sha1"])).decode()
                name, refers_to = capture_id(row["page_id"], digest, f"{task}-{number}"), None
                if row["equal"]:
                    leader = capture_id(row["first"], digest)
                    if row["leads"]:
                        name = leader
                    else:
                        refers_to = leader
                records = _transaction(row | {"digest": digest}, name, refers_to)
                stream.write(records)
                size += len(records)
                if size - start >= BLOCK_BYTES:
                    yield _block(path, start, size)
                    start = size
        if stream is not None:
            stream.close()
            if size > start:
                yield _block(path, start, size)

    columns = ["page_id", "url", "payload", "size", "sha1", "first", "leads", "equal"]
    blocks = dealt.select(*columns).mapInArrow(write, "path string, start long, length long")
    blocks.write.parquet(f"{folder}/blocks")
    listed = pages.sparkSession.read.schema(blocks.schema).parquet(f"{folder}/blocks")
    return listed.withColumn("path", F.concat(F.lit(f"{files}/"), "path"))


def _copies(met: DataFrame, key: list[str]) -> DataFrame:
    """Rows that repeat all of ``key``: one for each again, of which the first alone may lead.

    Copies are counted before the shuffle, and dealt out again in shares.
    """
    one = met.groupBy(*key).agg(
        *[F.any_value(name, True).alias(name) for name in ("size", "payload", "first", "leads", "equal")],
        F.count("*").alias("n"),
    )
    shares = F.sequence(F.lit(0).cast("long"), F.expr(f"(n - 1) div {COPIES}"))
    dealt = one.withColumn("share", F.explode(shares)).withColumn(
        "payload", F.when(F.col("leads") & (F.col("share") == 0), F.col("payload"))
    )
    last = F.least(F.col("n"), (F.col("share") + 1) * COPIES) - 1
    nth = F.explode(F.sequence(F.col("share") * COPIES, last))
    return dealt.repartition("share", *key).withColumn("nth", nth).select(
        *key,
        "size",
        F.when(F.col("nth") == 0, F.col("payload")).alias("payload"),
        "first",
        (F.col("leads") & (F.col("nth") == 0)).alias("leads"),
        "equal",
    )


def _block(path: str, start: int, end: int) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([{"path": path, "start": start, "length": end - start}])


_KINDS = {
    **dict.fromkeys("record_id type concurrent_to refers_to uri date digest".split(), pa.string()),
    "http_length": pa.int64(),
    "payload": pa.binary(),
    "payload_bytes": pa.int64(),
    "payload_sha1": pa.string(),
    "fields": pa.map_(pa.string(), pa.string()),
}
#: Parsed records go on in portions of about so many payload bytes.
PORTION_BYTES = 4 << 20


def _headers(lines: bytes) -> dict[str, str]:
    pairs = (line.partition(":") for line in lines.decode("utf-8", "replace").split("\r\n"))
    return {name.strip().lower(): value.strip() for name, colon, value in pairs if colon}


#: A member's compressed bytes are handed over in pieces of so many: what is left over
#: after a member is copied, so the pieces are near the size of a record.
PIECE_BYTES = 1 << 14


def members(data: bytes) -> Iterator[bytes]:
    """The plain bytes of each gzip member."""
    view, at = memoryview(data), 0
    while at < len(view):
        opener, out = zlib.decompressobj(31), []
        while not opener.eof and at < len(view):
            piece = view[at : at + PIECE_BYTES]
            out.append(opener.decompress(piece))
            at += len(piece) - len(opener.unused_data)
        yield b"".join(out)


def parse(record: bytes) -> dict:
    """One record: its headers, and of HTTP responses the payload."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, _, lines = head.partition(b"\r\n")
    if not version.startswith(b"WARC/"):
        raise ValueError(f"no WARC record: {version[:40]!r}")
    headers = _headers(lines)
    block = rest[: int(headers["content-length"])]
    kind = headers.get("warc-type")
    row = {
        "record_id": headers.get("warc-record-id"),
        "type": kind,
        "concurrent_to": headers.get("warc-concurrent-to"),
        "refers_to": headers.get("warc-refers-to"),
        "uri": headers.get("warc-target-uri"),
        "date": headers.get("warc-date"),
        "digest": headers.get("warc-payload-digest"),
    }
    if kind in ("response", "revisit"):
        http, _, payload = block.partition(b"\r\n\r\n")
        length = _headers(http.partition(b"\r\n")[2]).get("content-length", "")
        row["http_length"] = int(length) if length.isdecimal() else None
        if kind == "response":
            sha1 = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            row |= {"payload": payload, "payload_bytes": len(payload), "payload_sha1": sha1}
    elif kind == "metadata":
        row["fields"] = list(_headers(block).items())
    return row


def read_records(blocks: DataFrame, payloads: bool = True) -> DataFrame:
    """The records of listed blocks, one row each; a task a block.

    Sizes and digests of payloads are always taken; ``payloads`` brings them along.
    """
    kinds = {name: kind for name, kind in _KINDS.items() if payloads or name != "payload"}

    def table(rows: list[dict]) -> pa.RecordBatch:
        columns = [pa.array([row.get(n) for row in rows], kind) for n, kind in kinds.items()]
        return pa.RecordBatch.from_arrays(columns, names=list(kinds))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.to_pylist():
                system, path = file_system(block["path"])
                with system.open_input_file(path) as stream:
                    stream.seek(block["start"])
                    data = stream.read(block["length"])
                rows, size = [], 0
                for record in members(data):
                    rows.append(parse(record))
                    size += len(record)
                    if size > PORTION_BYTES:
                        yield table(rows)
                        rows, size = [], 0
                yield table(rows)

    schema = from_arrow_schema(pa.schema(list(kinds.items())))
    return blocks.repartition(max(1, blocks.count())).mapInArrow(read, schema)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row a capture: its response or revisit, requests and metadata.

    Requests and metadata belong to the capture that they name in concurrent_to;
    all records meet in one shuffle by the identifier of their capture.  A capture
    without them has empty arrays; those that name no capture that is there are
    left out.  Without a payload column in ``records`` the response has none.
    """
    kind = F.col("type")
    wanted = ("type", "uri", "date", "digest", "refers_to", "http_length")
    wanted += ("payload", "payload_bytes", "payload_sha1")
    answer = F.struct(*(c for c in wanted if c in records.columns))

    def of(name: str, *parts: str | Column) -> Column:
        return F.array_sort(F.collect_list(F.when(kind == name, F.struct(*parts))))

    # a map has no order; its entries have
    fields = F.array_sort(F.map_entries("fields")).alias("fields")
    grouped = records.groupBy(F.coalesce("concurrent_to", "record_id").alias("record_id")).agg(
        F.any_value(F.when(kind.isin("response", "revisit"), answer), F.lit(True)).alias("response"),
        of("request", "record_id", "uri", "date").alias("requests"),
        of("metadata", "record_id", fields).alias("metadata"),
    )
    return grouped.where(F.col("response").isNotNull())


def page_rows(captures: DataFrame) -> DataFrame:
    """page_id and what the archives say of its payload, from assembled captures.

    A response's figures are those of the payload read; a damaged one raises.
    """
    answer = F.col("response")
    entries = F.flatten(F.transform("metadata", lambda m: m["fields"]))
    page_id = F.get(F.filter(entries, lambda e: e["key"] == "page-id"), F.lit(0))["value"].cast("long")
    sound = answer["payload_sha1"].isNull() | (
        F.concat(F.lit("sha1:"), answer["payload_sha1"]) == answer["digest"]
    )
    digest = F.when(sound, F.regexp_replace(answer["digest"], "^sha1:", "")).otherwise(
        F.raise_error(F.concat(F.lit("damaged payload in "), F.col("record_id")))
    )
    return captures.select(
        page_id.alias("page_id"),
        F.coalesce(answer["payload_bytes"], answer["http_length"]).alias("payload_bytes"),
        digest.alias("payload_digest"),
        answer["type"].alias("record_type"),
        F.when(
            answer["type"] == "revisit",
            F.try_to_number(F.regexp_extract(answer["refers_to"], "^<urn:x-capture:(-?[0-9]+):", 1), F.lit("S9999999999999999999")).cast("long"),
        ).alias("refers_to"),
    )


def round_trip(pages: DataFrame, least_payload: int = LEAST_PAYLOAD) -> DataFrame:
    """Write archives to the shared scratch and read them back: one row a page."""
    folder = new_folder(pages.sparkSession, "archives")
    blocks = write_archives(pages, folder, least_payload)
    return page_rows(assemble(read_records(blocks, payloads=False)))
