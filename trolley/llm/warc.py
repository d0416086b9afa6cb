"""Web archives: whole-file gzip streams, their normal form, and reading them back.

``write_archives`` writes records as one gzip stream per file, as crawlers that compress whole
files do. ``normalise`` inflates each stream once, front to back, rewrites every record as a gzip
member of its own and writes a sidecar with each member's offset and length. ``read_records`` goes
through the sidecars and inflates members one by one, as a random reader would.

Archives may come from elsewhere: header names are read whatever their case, with or without a blank
after the colon and over folded lines; records of any type, without digests, and blank lines between
records are carried over. A record that is no HTTP message is its own payload.

All three hold one record and one chunk of a stream at a time, however far a chunk inflates. Files go to a folder all executors
share, through Arrow's file systems (local or network file systems, HDFS, object stores). Every
attempt of a task writes under a name of its own and only files of finished tasks are listed, so a
lost executor or a second attempt leaves no half-written archive behind in the lists.

Defined results: a null payload is empty. A record of another archive has no page id; a digest it declares
is checked if it is a base32 SHA-1, and one that is missing is made. Of records with equal payloads (empty ones included) the
one with the largest id is the response and others revisit it; rows that share the largest id are
all responses. A row without an id is a response under an empty id unless another row with its
payload has an id: it then revisits that. Control characters in URLs are percent-encoded. An empty
table gives an empty result.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import new_folder
from trolley.session import stored

#: Uncompressed bytes after which a new archive begins.
ARCHIVE_BYTES = 32 << 20
CHUNK = 1 << 20
DATE = "2024-01-01T00:00:00Z"
_END = b"\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_ARCHIVES = "archive string, records long, bytes long"


def base32_sha1(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _place(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def make_record(
    page_id: int | None, url: str | None, payload: bytes | None, size: int, digest: str, refers_to: int | None
) -> bytes:
    """A response with its payload, or a revisit with the headers alone."""
    target = "".join(c if " " < c != "\x7f" else f"%{ord(c):02X}" for c in url or "urn:none")
    revisit = refers_to is not None
    block = (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        + f"Content-Length: {size}\r\n\r\n".encode()
        + (b"" if revisit else payload or b"")
    )
    name = "" if page_id is None else page_id
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{name}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http;msgtype=response",
    ]
    if revisit:
        head += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + _END + block + _END


def headers(record: bytes) -> tuple[dict[str, str], int]:
    """A record's headers by lower-case name (the first of a name), and where its block begins."""
    end = record.find(_END)
    if end < 0:
        raise ValueError("a record has no end of its headers")
    lines: list[str] = []
    for line in record[:end].decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and lines:
            lines[-1] += " " + line.strip()
        else:
            lines.append(line)
    found: dict[str, str] = {}
    for line in lines:
        name, _, value = line.partition(":")
        found.setdefault(name.strip().lower(), value.strip())
    return found, end + len(_END)


def _inflated(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """A gzip stream, of one member or of many, in pieces of at most ``CHUNK`` bytes."""
    stream = zlib.decompressobj(31)
    for data in chunks:
        while True:
            piece = stream.decompress(data, CHUNK)
            if piece:
                yield piece
            if stream.eof:
                # Some writers pad members with zeros.
                data, stream = stream.unused_data.lstrip(b"\0"), zlib.decompressobj(31)
                if not data:
                    break
            else:
                data = stream.unconsumed_tail
                if not data and len(piece) < CHUNK:
                    break


def inflated_records(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The records of a gzip stream; each ends with its two line breaks."""
    held, needed = bytearray(), 0
    for piece in _inflated(chunks):
        held += piece
        done = 0
        while True:
            if not needed:
                while held.startswith(b"\r\n", done):
                    done += 2
                end = held.find(_END, done)
                if end < 0:
                    break
                size = headers(bytes(held[done : end + 4]))[0]["content-length"]
                needed = end + 4 + int(size) + 4 - done
            if len(held) - done < needed:
                break
            yield bytes(held[done : done + needed])
            done, needed = done + needed, 0
        del held[:done]
    if held.strip():
        raise ValueError(f"the archive ends inside a record, after {len(held)} bytes of it")


def _chunks(uri: str) -> Iterator[bytes]:
    system, path = _place(uri)
    with system.open_input_stream(path, compression=None) as source:
        while chunk := source.read(CHUNK):
            yield chunk


class _Out:
    """A file under a name no other attempt uses."""

    def __init__(self, folder: str, ending: str) -> None:
        self.uri = f"{folder}/{uuid.uuid4().hex}{ending}"
        system, path = _place(self.uri)
        system.create_dir(path.rsplit("/", 1)[0], recursive=True)
        self.stream = system.open_output_stream(path, compression=None)


def with_revisits(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, sha1, winner``: per payload that several rows have, the largest id.

    Only ids and digests are aggregated. The join back carries the payloads; it is an ordinary
    outer join, whose partitions of one frequent payload adaptive execution splits.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumn("sha1", F.sha1("html"))
    winners = (
        rows.select("sha1", "page_id").groupBy(F.col("sha1").alias("_sha1"))
        .agg(F.max("page_id").alias("winner"), F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    )
    return rows.join(winners, F.col("sha1") == F.col("_sha1"), "left").drop("_sha1")


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``with_revisits`` rows as whole-file gzip archives; the list of archives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, made = None, []
        for batch in batches:
            for row in batch.to_pylist():
                payload = row["html"].encode()
                winner = row["winner"]
                refers = winner if winner is not None and winner != row["page_id"] else None
                record = make_record(
                    row["page_id"], row["url"], payload, len(payload),
                    base32_sha1(bytes.fromhex(row["sha1"])), refers,
                )
                if out is None:
                    out, stream = _Out(folder, ".warc.gz"), zlib.compressobj(6, zlib.DEFLATED, 31)
                    made.append([out.uri, 0, 0])
                out.stream.write(stream.compress(record))
                made[-1][1] += 1
                made[-1][2] += len(record)
                if made[-1][2] >= archive_bytes:
                    out.stream.write(stream.flush())
                    out.stream.close()
                    out = None
        if out is not None:
            out.stream.write(stream.flush())
            out.stream.close()
        yield _listed(made)

    return stored(pages.select("page_id", "url", "html", "sha1", "winner").mapInArrow(run, _ARCHIVES), "archives")


def _listed(rows: list[list]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[], [], []]
    kinds = (pa.string(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["archive", "records", "bytes"]
    )


def _spread(archives: DataFrame) -> DataFrame:
    """An archive a partition."""
    return archives.repartitionByRange(max(1, archives.count()), "archive")


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrite each listed archive with a member per record and a sidecar ``.idx`` of lines
    ``offset, length, record id, type, digest`` between tabs; the list of new archives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("archive").to_pylist():
                out, offset, count = _Out(folder, ".warc.gz"), 0, 0
                system, path = _place(out.uri + ".idx")
                with out.stream, system.open_output_stream(path, compression=None) as index:
                    for record in inflated_records(_chunks(uri)):
                        member = zlib.compressobj(6, zlib.DEFLATED, 31)
                        data = member.compress(record) + member.flush()
                        out.stream.write(data)
                        named, _ = headers(record)
                        line = (
                            offset, len(data), named.get("warc-record-id", ""), named.get("warc-type", ""),
                            named.get("warc-payload-digest", ""),
                        )
                        index.write(("\t".join(map(str, line)) + "\n").encode())
                        offset, count = offset + len(data), count + 1
                yield _listed([[out.uri, count, offset]])

    return stored(_spread(archives).mapInArrow(run, _ARCHIVES), "normalised")


def _page(name: str | None) -> int | None:
    """The page of a record this module has named."""
    number = (name or "").strip("<>").removeprefix("urn:page:")
    return int(number) if number.removeprefix("-").isdecimal() else None


def read_records(archives: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to, url, record_id, archive,
    offset`` of every record, member by member; the digest is that of the payload read, of a revisit
    the declared one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("archive").to_pylist():
                system, path = _place(uri)
                with system.open_input_file(path) as members:
                    rows, held = [], b""
                    for chunk in _chunks(uri + ".idx"):
                        lines = (held + chunk).split(b"\n")
                        held = lines.pop()
                        for line in lines:
                            offset, length = map(int, line.split(b"\t")[:2])
                            rows.append((*_parsed(members.read_at(length, offset)), uri, offset))
                            if len(rows) >= 1_000:
                                yield _read(rows)
                                rows = []
                    yield _read(rows)

    return _spread(archives).mapInArrow(
        run,
        "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long,"
        " url string, record_id string, archive string, offset long",
    )


def _declared(named: dict[str, str]) -> str | None:
    """The payload's digest by its headers, if it is a SHA-1 in base32."""
    kind, _, digest = named.get("warc-payload-digest", "").partition(":")
    digest = digest.strip().upper()
    return digest if kind.strip().lower() == "sha1" and re.fullmatch("[A-Z2-7]{32}", digest) else None


def _parsed(member: bytes) -> tuple:
    record = zlib.decompress(member, 31)
    named, begin = headers(record)
    block = record[begin : begin + int(named["content-length"])]
    kind, inner, payload = named.get("warc-type", "").lower(), {}, 0
    if named.get("content-type", "").lower().startswith("application/http") and _END in block:
        inner, payload = headers(block)
    declared, size = _declared(named), len(block) - payload
    if kind == "revisit":
        told = inner.get("content-length", "")
        digest, size = declared, int(told) if told.isdecimal() else None
    else:
        digest = base32_sha1(hashlib.sha1(block[payload:]).digest())
        if declared not in (None, digest):
            raise ValueError(f"the payload of {named.get('warc-record-id')} is not what its headers say")
    return (
        _page(named.get("warc-record-id")), size, digest, kind, _page(named.get("warc-refers-to")),
        named.get("warc-target-uri"), named.get("warc-record-id"),
    )


_NAMES = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "record_id", "archive", "offset"]
_KINDS = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), *[pa.string()] * 3, pa.int64()]


def _read(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in _NAMES]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, _KINDS, strict=True)], _NAMES
    )


def round_trip(pages: DataFrame, folder: str | None = None, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write ``pages`` (``page_id, url, html``), normalise the archives and read all records."""
    folder = folder or new_folder(pages.sparkSession, "warc")
    streams = write_archives(with_revisits(pages), f"{folder}/streams", archive_bytes)
    return read_records(normalise(streams, f"{folder}/members"))
