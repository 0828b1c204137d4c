"""WARC archives: a writer with revisits, and a reader that salvages.

Archives are gzip files of one member per record, written by the tasks into a
shared folder. A task writes its rows in order of id into files named after its
partition and moves each into place when it is complete, so a task that runs
again after a lost executor replaces its files by the same ones.

The reader checks every record: the member's checksum, the version line, the
length, the line ends after the block and the digests. After a failed check it
searches for the next member (or, in plain archives, the next version line) that
starts a record, goes on from there, and logs the bytes in between as a gap.
Only Spark reads the archives, as binary files.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from base64 import b32encode
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.llm.common import arrow_schema, file_system, stored
from lakeops.session import work_dir

VERSION = b"WARC/1.1"
FILE_BYTES = 4 << 20  # an archive is closed beyond this size
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_GZIP = b"\x1f\x8b\x08"
_VERSION_LINE = re.compile(rb"WARC/\d+\.\d+\r?\n")
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the public one for URLs
_CHUNK = 1 << 14


def sha1_base32(data: bytes) -> str:
    return b32encode(hashlib.sha1(data).digest()).decode()


def record_id(key: object, payload_digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{key}/{payload_digest}')}>"


def _escaped(key: str) -> str:
    """A row id as one header value: control characters, spaces and the escape itself as %XX."""
    return re.sub(r"[\x00-\x20\x7f%]", lambda m: f"%{ord(m[0]):02X}", key)


def _plain_id(value: str | None) -> str | None:
    return value if value is None else re.sub("%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), value)


def write_record(key, url: str | None, payload: bytes, original=None, is_revisit: bool = False) -> bytes:
    """A record as a gzip member: a response, or a revisit of the record of row ``original``.

    The block is an HTTP response; that of a revisit ends after its headers,
    which keep the length of the payload.
    """
    digest = sha1_base32(payload)
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode()
    if not is_revisit:
        block += payload
    head = [("WARC-Type", "revisit" if is_revisit else "response"), ("WARC-Record-ID", record_id(key, digest)),
            ("WARC-Date", DATE), ("Content-Type", "application/http; msgtype=response"),
            ("Content-Length", str(len(block))), ("WARC-Block-Digest", f"sha1:{sha1_base32(block)}"),
            ("WARC-Payload-Digest", f"sha1:{digest}")]
    if url is not None:
        head.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if key is not None:
        head.append(("WARC-Row-ID", _escaped(str(key))))
    if is_revisit:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(original, digest))]
        if original is not None:
            head.append(("WARC-Refers-To-Row-ID", _escaped(str(original))))
    lines = "".join(f"{name}: {value}\r\n" for name, value in head).encode()
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(VERSION + b"\r\n" + lines + b"\r\n" + block + b"\r\n\r\n") + pack.flush()


@dataclass
class Found:
    """A record, or a gap (``headers`` empty) with the reason."""

    offset: int
    length: int
    headers: dict[str, str] = field(default_factory=dict)
    block: bytes = b""
    reason: str | None = None


def parse_record(data: bytes, at: int = 0) -> tuple[Found | None, int, str]:
    """The record at a place: itself and its end, or the reason why there is none."""
    line = _VERSION_LINE.match(data, at)
    if not line:
        return None, at, "no version line"
    end = data.find(b"\r\n\r\n", line.end() - 2)
    if end < 0:
        return None, at, "headers not ended"
    headers: dict[str, str] = {}
    name = ""
    for row in data[line.end():end].decode("utf-8", "replace").split("\r\n"):
        if row[:1] in (" ", "\t") and name:  # a folded line
            headers[name] += " " + row.strip()
            continue
        name, colon, value = row.partition(":")
        if row and not colon:
            return None, at, "bad header line"
        name = name.strip().lower()
        headers[name] = value.strip()
    length = headers.get("content-length", "")
    if not length.isascii() or not length.isdigit():
        return None, at, "no length"
    start = end + 4
    stop = start + int(length)
    if data[stop:stop + 4] != b"\r\n\r\n":
        return None, at, "block cut off" if stop + 4 > len(data) else "block not followed by line ends"
    block = data[start:stop]
    wanted = headers.get("warc-block-digest", "")
    if wanted.startswith("sha1:") and sha1_base32(block) != wanted[5:].upper():
        return None, at, "block digest"
    payload = payload_of(headers, block)
    wanted = headers.get("warc-payload-digest", "")
    if payload is not None and wanted.startswith("sha1:") and sha1_base32(payload) != wanted[5:].upper():
        return None, at, "payload digest"
    return Found(at, stop + 4 - at, headers, block), stop + 4, ""


def payload_of(headers: dict[str, str], block: bytes) -> bytes | None:
    """Payload of a record; null for a revisit."""
    if headers.get("warc-type") == "revisit":
        return None
    if headers.get("content-type", "").startswith("application/http"):
        return block[block.find(b"\r\n\r\n") + 4:] if b"\r\n\r\n" in block else b""
    return block


def payload_length(headers: dict[str, str], block: bytes) -> int | None:
    """Bytes of the full payload; a revisit's HTTP headers tell it."""
    payload = payload_of(headers, block)
    if payload is not None:
        return len(payload)
    told = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", block)
    return int(told[1]) if told else None


def _member(data: memoryview, at: int) -> tuple[bytes, int, str]:
    """The gzip member at a place: its content, its end and what is wrong with it.

    Of a damaged member the content goes as far as it can be unpacked."""
    unpack, out, here = zlib.decompressobj(31), [], at
    try:
        while not unpack.eof:
            chunk = data[here:here + _CHUNK]
            if not chunk:
                return b"".join(out), at, "member cut off"
            out.append(unpack.decompress(chunk))
            here += len(chunk)
    except zlib.error:
        return b"".join(out), at, "member damaged"
    return b"".join(out), here - len(unpack.unused_data), ""


def _starts_record(data: memoryview, at: int) -> bool:
    try:
        return zlib.decompressobj(31).decompress(data[at:at + 512], 16).startswith(b"WARC/")
    except zlib.error:
        return False


def read_records(data: bytes) -> Iterator[Found]:
    """All records of an archive, gzipped or plain, and the gaps between them.

    Offsets and lengths are those of the member for gzipped records. A member
    may hold many records; those that pass their own checks are given out even
    if the member is damaged further on.
    """
    at, view, gap = 0, memoryview(data), None
    while at < len(data):
        if data.startswith(_GZIP, at):
            content, end, reason = _member(view, at)
            inside = list(_plain(content)) if content else []
            records = [f for f in inside if f.reason is None]
            reason = reason or ("" if records else inside[0].reason if inside else "empty member")
            if records and gap:
                yield Found(gap[0], at - gap[0], reason=gap[1])
                gap = None
            for f in records if reason else inside:
                yield Found(at, (end if end > at else len(data)) - at, f.headers, f.block, f.reason)
            if not reason:
                at = end
                continue
        else:
            record, end, reason = parse_record(data, at)
            if record is not None:
                if gap:
                    yield Found(gap[0], at - gap[0], reason=gap[1])
                    gap = None
                yield record
                at = end
                continue
        gap = gap or (at, reason)
        at = _next_start(data, view, at + 1)
    if gap:
        yield Found(gap[0], len(data) - gap[0], reason=gap[1])


def _plain(data: bytes) -> Iterator[Found]:
    """Records and gaps of plain bytes."""
    at, gap = 0, None
    while at < len(data):
        record, end, reason = parse_record(data, at)
        if record is None:
            gap = gap or (at, reason)
            line = _VERSION_LINE.search(data, at + 1)
            end = line.start() if line else len(data)
        else:
            if gap:
                yield Found(gap[0], at - gap[0], reason=gap[1])
                gap = None
            yield record
        at = end
    if gap:
        yield Found(gap[0], len(data) - gap[0], reason=gap[1])


def _next_start(data: bytes, view: memoryview, at: int) -> int:
    """Place of the next member or version line that may start a record; the end if there is none."""
    member = data.find(_GZIP, at)
    while member >= 0 and not _starts_record(view, member):
        member = data.find(_GZIP, member + 1)
    line = _VERSION_LINE.search(data, at)
    places = [p for p in (member, line.start() if line else -1) if p >= 0]
    return min(places, default=len(data))


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url",
                   html_col: str = "html", least_revisit_bytes: int = 0, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write one record per row into gzip archives below ``folder``, which all executors share.

    Of rows with equal payloads of at least ``least_revisit_bytes`` bytes, those
    with the smallest id are responses, the others revisit it; smaller payloads
    are all responses. A null html is an empty payload; a null url has no target
    line; a null id comes after all others. Rows that repeat the smallest id are
    responses too. Returns the files with their number of records.
    """
    rows = pages.select(F.col(id_col).alias("key"), F.col(url_col).cast("string").alias("url"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    large = F.octet_length("html") >= least_revisit_bytes
    facts = stored(rows.filter(large).select("key", F.sha1("html").alias("digest")), "warc-digests")
    groups = facts.groupBy("digest").agg(F.min("key").alias("original"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    # Only rows of repeated payloads are looked up again; texts take no part in this.
    again = facts.join(groups, "digest").filter(~F.col("key").eqNullSafe(F.col("original")))
    revisits = again.select(F.col("key").alias("of"), "digest", "original").distinct()
    on = F.col("key").eqNullSafe(F.col("of")) & (F.sha1("html") == F.col("digest")) & large
    marked = rows.join(revisits, on, "left").select("key", "url", "html", "original",
                                                    F.col("digest").isNotNull().alias("is_revisit"))
    ordered = marked.sortWithinPartitions("key", "url", "html")
    schema = "path string, records bigint"
    arrow = arrow_schema(schema)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        task = TaskContext.get()
        files, base = file_system(folder)
        members, size, number, written = [], 0, 0, []

        def close():
            nonlocal members, size, number
            if members:
                name = f"{base}/part-{task.partitionId():06d}-{number:05d}.warc.gz"
                draft = f"{base}/.draft-{task.partitionId()}-{number}-{uuid.uuid4().hex}"
                with files.open_output_stream(draft, compression=None) as out:
                    out.write(b"".join(members))
                files.move(draft, name)
                written.append((name, len(members)))
                members, size, number = [], 0, number + 1

        for batch in batches:
            for key, url, html, original, is_revisit in zip(*[c.to_pylist() for c in batch.columns]):
                members.append(write_record(key, url, html.encode(), original, is_revisit))
                size += len(members[-1])
                if size >= file_bytes:
                    close()
        close()
        yield pa.RecordBatch.from_arrays([pa.array([w[i] for w in written], arrow.types[i]) for i in (0, 1)], schema=arrow)

    files, base = file_system(folder)
    files.create_dir(base, recursive=True)
    return stored(ordered.mapInArrow(write, schema), "warc-files")


def read_archives(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """Records and gaps of all archives (``*.warc.gz``, ``*.warc``) below a folder.

    ``kind`` is ``record`` or ``gap``; ``path``, ``offset`` and ``length`` are its
    place. A record has ``row_id``, ``record_type``, ``record_id``, ``target_uri``,
    ``refers_to`` (record id), ``refers_to_row``, ``payload_bytes`` and
    ``payload_digest`` of the full payload, and ``payload`` if asked for (null for
    a revisit); a gap has the ``reason`` of its first failed check. A task holds
    one whole archive, which must be below 2 GB and takes a few times its size in
    memory: write archives of some 100 MB, as ``write_archives`` does.
    """
    names = ("row_id", "record_type", "record_id", "target_uri", "refers_to", "refers_to_row", "payload_digest")
    schema = ("kind string, path string, offset bigint, length bigint, reason string, payload_bytes bigint, "
              + ", ".join(f"{n} string" for n in names) + (", payload binary" if with_payload else ""))
    arrow = arrow_schema(schema)
    archives = (spark.read.format("binaryFile").option("pathGlobFilter", "*.warc*").option("recursiveFileLookup", "true")
                .load(folder).select("path", "content"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                path, data = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                rows = []
                for found in read_records(data):
                    h = found.headers
                    place = (path, found.offset, found.length)
                    if found.reason is not None:
                        rows.append(("gap", *place, found.reason, *[None] * (len(arrow) - 5)))
                        continue
                    payload = payload_of(h, found.block)
                    digest = h.get("warc-payload-digest", "")
                    digest = digest[5:].upper() if digest.startswith("sha1:") else None
                    if digest is None and payload is not None:
                        digest = sha1_base32(payload)
                    rows.append(("record", *place, None, payload_length(h, found.block), _plain_id(h.get("warc-row-id")),
                                 h.get("warc-type"), h.get("warc-record-id"), h.get("warc-target-uri"),
                                 h.get("warc-refers-to"), _plain_id(h.get("warc-refers-to-row-id")), digest,
                                 *([payload] if with_payload else [])))
                columns = list(zip(*rows)) or [[]] * len(arrow)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    return archives.mapInArrow(read, schema)


def round_trip(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               least_revisit_bytes: int = 0) -> DataFrame:
    """Write the pages to archives in the shared folder, and return what is read back.

    One row per page: the id, ``payload_bytes``, ``payload_digest``,
    ``record_type`` and ``refers_to`` (id of the response, null for responses).
    Null cases as in :func:`write_archives`.
    """
    spark = pages.sparkSession
    folder = work_dir(spark, "warc")
    write_archives(pages, folder, id_col, url_col, html_col, least_revisit_bytes)
    key_type = pages.schema[id_col].dataType.simpleString()
    found = read_archives(spark, folder).filter("kind = 'record'")
    return found.select(F.col("row_id").cast(key_type).alias(id_col), "payload_bytes", "payload_digest", "record_type",
                        F.col("refers_to_row").cast(key_type).alias("refers_to"))
