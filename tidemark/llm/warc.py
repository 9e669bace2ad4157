"""WARC archives of web pages: writing with revisit records, and a reader that salvages damaged files.

One archive per task, one gzip member per record. Of pages with equal payloads one is stored, the others
refer to it. The reader verifies every member and record; where a check fails it searches on for the
next gzip member or version line that starts a valid record, and reports the bytes between as a gap.
Because any place can be resumed from, a large archive is read in ranges by several tasks: a range
has the records that begin in it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.tables import open_store

_MAGIC = b"\x1f\x8b\x08"
_VERSION = b"WARC/1."
_HEADER = re.compile(rb"WARC/1\.\d\r\n(?:[!#-'*+.^-z|~0-9A-Z-]++:[^\x00-\x08\x0a-\x1f]*+\r\n)*+")
_BLOCK = 1 << 16
_HEAD = 1 << 20  # longest header block that is believed
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RANGE_BYTES = 64 << 20


def sha1_text(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _line(value: str) -> str:
    """A header value on one line: control characters percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record(page_id: int | None, url: str | None, payload: bytes, keeper: int | None, date: str) -> bytes:
    """A response record, or a revisit record where another page, ``keeper``, holds the payload."""
    digest = sha1_text(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if keeper is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if keeper is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>",
        f"WARC-Date: {date}",
        f"WARC-Target-URI: {_line(url or '')}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Block-Digest: sha1:{sha1_text(block)}",
    ]
    if page_id is not None:
        lines.append(f"WARC-Page-ID: {page_id}")
    if keeper is not None:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:page:{keeper}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(
    pages: DataFrame, folder: str, revisit_from: int = 0, date: str = "2024-01-01T00:00:00Z", level: int = 6
) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) below ``folder``; returns the manifest
    (name, size, records).

    Of equal payloads of at least ``revisit_from`` bytes, the rows with the largest page_id are
    responses and the others revisits; a null page_id is smaller than any, and payloads that only rows
    without page_id have are responses. Null html is empty, a null url an empty one; other columns are
    ignored. Retried tasks write under other names, the manifest lists what counts.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    keyed = pages.select(F.col("page_id").cast("long"), "url", payload.alias("payload"), F.sha1(payload).alias("digest"))
    copies = (
        keyed.filter(F.octet_length("payload") >= revisit_from).groupBy("digest")
        .agg(F.max("page_id").alias("keeper"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest", "keeper")
    )
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("keeper")), F.col("keeper")).alias("refers_to")
    rows = keyed.join(copies, "digest", "left").select("page_id", "url", "payload", refers)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        name = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex[:12]}.warc.gz"
        out, size, n = None, 0, 0
        for batch in batches:
            for page_id, url, data, keeper in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    out = store.open_output_stream(f"{root}/{name}", compression=None)
                pack = zlib.compressobj(level, zlib.DEFLATED, 31)
                member = pack.compress(record(page_id, url, data, keeper, date)) + pack.flush()
                out.write(member)
                size += len(member)
                n += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"name": [name], "size": [size], "records": [n]})

    store, root = open_store(folder)
    store.create_dir(root, recursive=True)
    rows.mapInArrow(write, "name string, size long, records long").write.parquet(f"{folder}/manifest")
    return pages.sparkSession.read.parquet(f"{folder}/manifest")


class _Bytes:
    """Random access to a stored file with a small window."""

    def __init__(self, source, size: int):
        self.source, self.size = source, size
        self._at, self._held = 0, b""

    def read(self, at: int, n: int) -> bytes:
        if not self._at <= at <= at + n <= self._at + len(self._held):
            self.source.seek(at)
            self._at, self._held = at, self.source.read(max(n, _BLOCK))
        return self._held[at - self._at : at - self._at + n]

    def find(self, patterns: list[bytes], at: int) -> int | None:
        """Smallest place of any of the patterns from ``at`` on."""
        while at < self.size:
            data = self.read(at, min(_BLOCK, self.size - at))
            places = [p for p in (data.find(x) for x in patterns) if p >= 0]
            if places:
                return at + min(places)
            if at + len(data) >= self.size:
                return None
            at += len(data) - max(map(len, patterns)) + 1
        return None


def _parse(data: bytes) -> tuple[dict[str, str], bytes, int] | str:
    """Headers, block and length of the record that ``data`` begins with, or what is wrong with it."""
    end = data.find(b"\r\n\r\n", 0, _HEAD)
    if end < 0 or not _HEADER.fullmatch(data, 0, end + 2):
        return "no version line and header"
    lines = data[:end].decode("utf-8", "replace").split("\r\n")[1:]
    headers = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    length = headers.get("content-length", "")
    if not length.isdigit():
        return "no content length"
    begin, stop = end + 4, end + 4 + int(length)
    if data[stop : stop + 4] != b"\r\n\r\n":
        return "record end is not where the content length says"
    block = data[begin:stop]
    digest = headers.get("warc-block-digest")
    if digest and digest != f"sha1:{sha1_text(block)}":
        return "block digest differs"
    return headers, block, stop + 4


def _member(file: _Bytes, at: int) -> tuple[bytes, int] | str:
    """Content and stored length of the gzip member at ``at``, or what is wrong with it."""
    unpack, parts, read = zlib.decompressobj(31), [], 0
    try:
        while not unpack.eof:
            data = file.read(at + read, min(_BLOCK, file.size - at - read))
            if not data:
                return "gzip member is cut off"
            parts.append(unpack.decompress(data))
            read += len(data)
    except zlib.error as error:
        return f"gzip: {error}"
    return b"".join(parts), read - len(unpack.unused_data)


def _plain_record(file: _Bytes, at: int) -> tuple[dict[str, str], bytes, int] | str:
    """The uncompressed record at ``at``."""
    head = file.read(at, min(_HEAD, file.size - at))
    end = head.find(b"\r\n\r\n")
    if end >= 0 and not _HEADER.fullmatch(head, 0, end + 2):
        return "no version line and header"
    found = re.search(rb"\r\ncontent-length:\s*(\d{1,18})\s*\r\n", head[: end + 4], re.I) if end >= 0 else None
    size = end + 8 + int(found[1]) if found else 0
    if not found or at + size > file.size:
        return "no header with a believable content length"
    return _parse(file.read(at, size))


def _records_at(file: _Bytes, at: int) -> tuple[list[tuple[dict[str, str], bytes]], int] | str:
    """All records of the member, or the plain record, at ``at`` and the stored length they take."""
    start = file.read(at, min(len(_VERSION), file.size - at))
    if start.startswith(_MAGIC):
        member = _member(file, at)
        if isinstance(member, str):
            return member
        data, stored = member
        records = []
        while data:
            parsed = _parse(data)
            if isinstance(parsed, str):
                return parsed
            records.append(parsed[:2])
            data = data[parsed[2] :]
        return (records, stored) if records else "empty gzip member"
    if start == _VERSION:
        parsed = _plain_record(file, at)
        return parsed if isinstance(parsed, str) else ([parsed[:2]], parsed[2])
    return "neither gzip member nor version line"


def salvage(file: _Bytes, begin: int, end: int) -> Iterator[tuple]:
    """Records ("record", place, headers, block) that begin in [begin, end), and the byte gaps ("gap",
    place, length, reason) that follow them or begin the file. What comes before the first valid
    record of a later range belongs to a range before it."""
    at, bad, reason = begin, None, ""
    if begin:
        place = file.find([_MAGIC, _VERSION], at)
        while place is not None and place < end and isinstance(_records_at(file, place), str):
            place = file.find([_MAGIC, _VERSION], place + 1)
        if place is None or place >= end:
            return
        at = place
    while at < file.size:
        found = _records_at(file, at)
        if isinstance(found, str):
            if bad is None:
                bad, reason = at, found
            place = file.find([_MAGIC, _VERSION], at + 1)
            at = file.size if place is None else place
            continue
        if bad is not None:
            yield "gap", bad, at - bad, reason
            bad = None
        if at >= end:
            return
        for headers, block in found[0]:
            yield "record", at, headers, block
        at += found[1]
    if bad is not None:
        yield "gap", bad, file.size - bad, reason


READ = (
    "name string, place long, gap_bytes long, reason string, record_type string, page_id long, url string,"
    " payload_bytes long, payload_digest string, refers_to long, payload binary"
)


def read_archives(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """Records and quarantined gaps of the archives below ``folder``.

    A record has record_type, page_id, url, payload_bytes and payload_digest of the full payload (of a
    revisit, from its headers), refers_to, and the payload where asked for. A record whose payload
    does not have its digest is a gap of no bytes with a reason. A gap has its place, gap_bytes
    and reason and no record_type. ``quarantine`` picks the gaps.
    """
    manifest = spark.read.parquet(f"{folder}/manifest")
    begins = F.sequence(F.lit(0).cast("long"), F.greatest(F.col("size") - 1, F.lit(0)), F.lit(RANGE_BYTES).cast("long"))
    ranges = manifest.select("name", "size", F.explode(begins).alias("begin"))
    kinds = {"name": pa.string(), "place": pa.int64(), "gap_bytes": pa.int64(), "reason": pa.string(),
             "record_type": pa.string(), "page_id": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64(),
             "payload_digest": pa.string(), "refers_to": pa.int64(), "payload": pa.binary()}

    def row(name: str, found: tuple) -> tuple:
        if found[0] == "gap":
            return (name, *found[1:], *[None] * 7)
        _, place, headers, block = found
        http, _, payload = block.partition(b"\r\n\r\n")
        kind, page = headers.get("warc-type"), headers.get("warc-page-id")
        digest = headers.get("warc-payload-digest", "").removeprefix("sha1:")
        refers = headers.get("warc-refers-to", "")[len("<urn:page:") : -1]
        size = len(payload)
        if kind == "revisit":
            size = int((re.search(rb"(?mi)^content-length:\s*(\d+)", http) or [0, 0])[1])
        elif digest != sha1_text(payload):
            return (name, place, 0, "payload digest differs", *[None] * 7)
        return (name, place, None, None, kind, int(page) if page else None, headers.get("warc-target-uri"), size, digest,
                int(refers) if refers else None, payload if with_payload and kind != "revisit" else None)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = open_store(folder)
        for part in (r for b in batches for r in b.to_pylist()):
            with store.open_input_file(f"{root}/{part['name']}") as source:
                file = _Bytes(source, source.size())
                rows, held = [], 0
                for found in salvage(file, part["begin"], part["begin"] + RANGE_BYTES):
                    rows.append(row(part["name"], found))
                    held += len(rows[-1][-1] or b"")
                    if len(rows) >= 2_000 or held > 16 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds.values())], names=list(kinds))
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds.values())], names=list(kinds))

    return ranges.repartition(max(1, ranges.count())).mapInArrow(read, READ)


def quarantine(read: DataFrame) -> DataFrame:
    return read.filter("record_type IS NULL").select("name", "place", "gap_bytes", "reason")
