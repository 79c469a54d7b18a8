"""Web archives: monolithic gzip files rewritten record by record, with an offset index."""

from __future__ import annotations

import base64
import functools
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, functions as F

from quillon.session import fresh_path, materialize

#: An archive is closed at this many bytes before compression.
ARCHIVE_BYTES = 64 << 20
CHUNK = 1 << 20
_HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, page_id, uri: str | None, digest: str, size: int, block: bytes, refers_to=None) -> bytes:
    """One WARC record. ``X-Payload-Length`` keeps the payload's size where it isn't there."""
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{page_id}>", f"WARC-Date: {DATE}"]
    if uri is not None:
        lines.append(f"WARC-Target-URI: {uri}")
    lines += [f"WARC-Payload-Digest: sha1:{digest}", f"X-Payload-Length: {size}"]
    if kind == "revisit":
        lines += [f"WARC-Profile: {_REVISIT}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes] | None:
    """(headers, block) of the record ``data`` starts with, or None if it isn't whole."""
    end = data.find(b"\r\n\r\n")
    if end < 0:
        return None
    first, *lines = data[:end].decode().split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"no WARC record: {first[:60]!r}")
    headers = dict(line.split(": ", 1) for line in lines)
    stop = end + 4 + int(headers["Content-Length"])
    if len(data) < stop + 4:
        return None
    if data[stop : stop + 4] != b"\r\n\r\n":
        raise ValueError("a record's length doesn't fit")
    return headers, data[end + 4 : stop]



def records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Records of an uncompressed stream; at most one record and one chunk are held."""
    held = bytearray()
    for chunk in chunks:
        held += chunk
        at = 0
        while True:
            end = held.find(b"\r\n\r\n", at)
            if end < 0:
                break
            mark = held.find(b"Content-Length: ", at, end)
            size = int(bytes(held[mark + 16 : end]).split(b"\r\n", 1)[0])
            stop = end + 4 + size + 4
            if len(held) < stop:
                break
            yield parse(bytes(held[at:stop]))
            at = stop
        del held[:at]
    if held:
        raise ValueError("the archive ends inside a record")


def inflate(stream) -> Iterator[bytes]:
    """A gzip file of one or more members, in chunks."""
    engine = zlib.decompressobj(31)
    while data := stream.read(CHUNK):
        while data:
            yield engine.decompress(data)
            data = engine.unused_data
            if engine.eof:
                engine = zlib.decompressobj(31)


def _filesystem(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def _clean(url: str | None) -> str | None:
    return None if url is None else quote(url, safe="%/:=&?~#+!$,;'@()*[]._-")


_WRITTEN = pa.schema([("archive", pa.string()), ("place", pa.int64()), ("page_id", pa.int64()), ("digest", pa.string()), ("size", pa.int64())])


def _write(batches: Iterator[pa.RecordBatch], folder: str, level: int) -> Iterator[pa.RecordBatch]:
    """Responses into whole-file gzip streams; a repeated task writes files of its own, and
    only those in the returned rows count."""
    files, base = _filesystem(folder)
    out = engine = name = None
    place = size = 0
    for batch in batches:
        rows = []
        for page_id, url, payload in zip(*(c.to_pylist() for c in batch.columns)):
            if out is None:
                name, place, size = f"crawl-{uuid.uuid4().hex}.warc.gz", 0, 0
                out, engine = files.open_output_stream(f"{base}/{name}", compression=None), zlib.compressobj(level, wbits=31)
            digest = payload_digest(payload)
            data = record("response", page_id, _clean(url), digest, len(payload), _HTTP + payload)
            out.write(engine.compress(data))
            rows.append((name, place, page_id, digest, len(payload)))
            place, size = place + 1, size + len(data)
            if size >= ARCHIVE_BYTES:
                out.write(engine.flush())
                out.close()
                out = None
        columns = list(zip(*rows)) or [[]] * len(_WRITTEN)
        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, _WRITTEN)], schema=_WRITTEN)
    if out is not None:
        out.write(engine.flush())
        out.close()


def write_archives(pages: DataFrame, folder: str, level: int = 1) -> DataFrame:
    """A response per page, in gzip files of one member each below ``folder``; the records
    written: archive, place, page_id, digest, size."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary")).alias("payload"))
    files, path = _filesystem(folder)
    files.create_dir(path, recursive=True)
    return materialize(rows.mapInArrow(functools.partial(_write, folder=folder, level=level),
                                       "archive string, place long, page_id long, digest string, size long"), "written")


def _normalise(roles: pa.Table, folder: str, level: int) -> pa.Table:
    """One archive, inflated once: each record becomes its own member; the index tells where."""
    files, base = _filesystem(folder)
    role = {r["place"]: r for r in roles.to_pylist()}
    name = roles["archive"][0].as_py()
    new = name.replace("crawl-", f"records-{uuid.uuid4().hex[:8]}-")
    offset, rows = 0, []
    with files.open_input_stream(f"{base}/{name}", compression=None) as source, files.open_output_stream(f"{base}/{new}", compression=None) as out, \
            files.open_output_stream(f"{base}/{new}.index") as index:
        for place, (headers, block) in enumerate(records(inflate(source))):
            known = role[place]
            kind, target = ("revisit", known["refers_to"]) if known["again"] else ("response", None)
            data = record(kind, headers["WARC-Record-ID"][10:-1], headers.get("WARC-Target-URI"), known["digest"], known["size"],
                          block if kind == "response" else block[: len(_HTTP)], target)
            engine = zlib.compressobj(level, wbits=31)
            member = engine.compress(data) + engine.flush()
            out.write(member)
            index.write(f"{headers['WARC-Record-ID'][10:-1]} {kind} {offset} {len(member)}\n".encode())
            rows.append((new, offset, len(member)))
            offset += len(member)
    columns = list(zip(*rows)) or [[], [], []]
    return pa.table([pa.array(list(columns[0]), pa.string()), pa.array(list(columns[1]), pa.int64()), pa.array(list(columns[2]), pa.int64())],
                    names=["archive", "start", "length"])


def normalise(written: DataFrame, folder: str, smallest: int = 0, level: int = 6) -> DataFrame:
    """Rewrites the archives in ``written`` and returns the index: archive, start, length.

    Of pages with equal payloads of at least ``smallest`` bytes that with the largest id
    stays a response, others become revisits of it (rows repeating that id stay responses;
    if no id is known, all do). The index also stands beside each new archive.
    """
    best = materialize(written.where(F.col("size") >= smallest).groupBy("digest", "size").agg(
        F.max("page_id").alias("refers_to")), "best")
    roles = written.join(best, ["digest", "size"], "left").select(
        "archive", "place", "digest", "size", "refers_to",
        (F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))).alias("again"))
    # A group is one archive, whose size is bounded.
    return materialize(roles.groupBy("archive").applyInArrow(
        lambda table: _normalise(table, folder, level), "archive string, start long, length long"), "index")


_READ = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                   ("record_type", pa.string()), ("refers_to", pa.int64())])


def _read(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[pa.RecordBatch]:
    files, base = _filesystem(folder)
    name = source = None
    for batch in batches:
        rows = []
        for archive, start, length in zip(*(c.to_pylist() for c in batch.columns)):
            if archive != name:
                name, source = archive, files.open_input_file(f"{base}/{archive}")
            source.seek(start)
            headers, block = parse(zlib.decompress(source.read(length), 31))
            kind, page = headers["WARC-Type"], headers["WARC-Record-ID"][10:-1]
            size, digest = int(headers["X-Payload-Length"]), headers["WARC-Payload-Digest"].removeprefix("sha1:")
            if kind == "response":
                payload = block[block.index(b"\r\n\r\n") + 4 :]
                if (len(payload), payload_digest(payload)) != (size, digest):
                    raise ValueError(f"{archive} at {start}: payload and digest differ")
            target = headers.get("WARC-Refers-To")
            rows.append((None if page == "None" else int(page), size, digest, kind, int(target[10:-1]) if target else None))
        columns = list(zip(*rows)) or [[]] * len(_READ)
        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, _READ)], schema=_READ)


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """Every record the index names, read at its offset: page_id, payload_bytes,
    payload_digest, record_type, refers_to. Payloads are checked against their digests."""
    rows = index.select("archive", "start", "length").sortWithinPartitions("archive", "start")
    return rows.mapInArrow(functools.partial(_read, folder=folder),
                           "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archived(pages: DataFrame, folder: str | None = None) -> DataFrame:
    """Pages (page_id, url, html) written as archives, normalised and read back.

    A null html is an empty payload, a null url has no target header, a null id is kept.
    Repeated rows are records of their own; other columns are ignored; no rows, no files.
    """
    folder = folder or fresh_path(pages.sparkSession, "warc")
    return read_records(normalise(write_archives(pages, folder), folder), folder)
