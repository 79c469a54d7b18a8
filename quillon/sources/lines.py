"""Lines of growing text files, in byte ranges, as a batch and a streaming source.

A file is cut into ranges of bytes; a line belongs to the range its first byte lies in. A
stream holds back a last line without its newline until the rest is there, and goes on
inside files it has read before. Files are plain text, read through pyarrow's file systems.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from quillon.sources.packs import filesystem
from quillon.sources.results import batch_file

FORMAT = "quillon_lines"
SCHEMA = "file_path string, file_block bigint, line_no bigint, offset bigint, value string"
ARROW_SCHEMA = pa.schema([("file_path", pa.string()), ("file_block", pa.int64()), ("line_no", pa.int64()), ("offset", pa.int64()), ("value", pa.string())])
RANGE_BYTES = 128 << 20
#: Bytes of ranges, however short each is, that a task reads one after the other.
TASK_BYTES = 16 << 20
#: Bytes read, and rows handed on, at a time.
READ_BYTES = 4 << 20
BATCH_ROWS = 8192
#: Bytes looked at at a time for the last newline of a file, and for the end of a range's last line.
TAIL_BYTES = 64 << 10


@dataclass
class Range(InputPartition):
    """Bytes ``start`` to ``stop`` of a file; ``end`` is where the readable lines of it end."""

    path: str
    start: int
    stop: int
    end: int


def _sizes(files: fs.FileSystem, base: str) -> dict[str, int]:
    """Size of every file below a folder; hidden ones and those of unfinished writes are skipped."""
    found = files.get_file_info(fs.FileSelector(base, allow_not_found=True, recursive=True))
    shown = (f for f in found if f.type == fs.FileType.File and not any(p[:1] in ("_", ".") for p in f.path[len(base):].split("/")))
    return {f.path: f.size for f in shown}


@dataclass
class Bundle(InputPartition):
    """Ranges of one task."""

    ranges: list[Range]


def bundled(ranges: Iterable[Range]) -> list[Bundle]:
    """Ranges in their order, as many to a task as make up ``TASK_BYTES``, at least one."""
    bundles, held = [], TASK_BYTES
    for part in ranges:
        if held >= TASK_BYTES:
            bundles.append(Bundle([]))
            held = 0
        bundles[-1].ranges.append(part)
        held += part.stop - part.start
    return bundles


def cut(path: str, start: int, end: int, size: int) -> list[Range]:
    return [Range(path, at, min(at + size, end), end) for at in range(start, end, size)]


def _first_line(source: pa.NativeFile, part: Range) -> int:
    """Where the first line of a range begins; its end if none does."""
    if not part.start:
        return 0
    at = part.start - 1  # a range that begins with a line has a newline before it
    while at < part.stop - 1:
        chunk = source.read_at(min(READ_BYTES, part.stop - 1 - at), at)
        if not chunk:
            break
        if (found := chunk.find(b"\n")) >= 0:
            return at + found + 1
        at += len(chunk)
    return part.stop


def _whole_lines(source: pa.NativeFile, part: Range) -> Iterator[tuple[int, bytes]]:
    """(offset, line with its newline) of the lines that begin in a range; the file's last may lack it."""
    at = begins = _first_line(source, part)
    rest: list[bytes] = []
    while begins < part.stop and at < part.end:
        # No more than the range and the end of its last line: ranges can be far shorter than a read.
        chunk = source.read_at(min(READ_BYTES, part.end - at, max(part.stop - at, TAIL_BYTES)), at)
        if not chunk:
            break
        done = 0
        while begins < part.stop and (stop := chunk.find(b"\n", done)) >= 0:
            yield begins, b"".join([*rest, chunk[done:stop + 1]])
            rest, done = [], stop + 1
            begins = at + done
        rest.append(chunk[done:])
        at += len(chunk)
    if begins < part.stop and (left := b"".join(rest)):
        yield begins, left


def range_lines(files: fs.FileSystem, part: Range) -> Iterator[pa.RecordBatch]:
    """The lines that begin in a range, blank ones too, without their ends."""
    path, rows = quote(part.path, safe="/:="), []
    with files.open_input_file(part.path) as source:
        for n, (offset, line) in enumerate(_whole_lines(source, part)):
            value = line.removesuffix(b"\n").removesuffix(b"\r").decode("utf-8", "replace")
            rows.append((path, part.start, n, offset, value))
            if len(rows) == BATCH_ROWS:
                yield _batch(rows)
                rows = []
    if rows:
        yield _batch(rows)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), ARROW_SCHEMA)], schema=ARROW_SCHEMA)


class _Ranges:
    def __init__(self, options: dict):
        self.folder, self.size = options["path"], int(options.get("range_bytes", RANGE_BYTES))

    def read(self, part: Bundle) -> Iterator[pa.RecordBatch]:
        files = filesystem(self.folder)[0]
        for one in part.ranges:
            yield from range_lines(files, one)


class LineReader(_Ranges, DataSourceReader):
    """All lines there are, also a last one without its newline."""

    def partitions(self) -> list[Bundle]:
        files, base = filesystem(self.folder)
        found = bundled(r for path, size in sorted(_sizes(files, base).items()) for r in cut(path, 0, size, self.size))
        return found or [Bundle([])]


class LineStreamReader(_Ranges, DataSourceStreamReader):
    """Whole lines as they come. An offset holds, for each file, where its last whole line ends."""

    def __init__(self, options: dict):
        super().__init__(options)
        self._seen: dict[str, tuple[int, int]] = {}

    def initialOffset(self) -> dict:
        return {"ends": "{}"}

    def latestOffset(self) -> dict:
        files, base = filesystem(self.folder)
        for path, size in _sizes(files, base).items():
            known, end = self._seen.get(path, (0, 0))
            if size > known:  # a file that shrank keeps its end: what was read isn't read again
                self._seen[path] = size, self._last_end(files, path, end, size)
        return {"ends": json.dumps({p: end for p, (_, end) in sorted(self._seen.items()) if end})}

    @staticmethod
    def _last_end(files: fs.FileSystem, path: str, low: int, size: int) -> int:
        """Where the last newline between ``low`` and ``size`` ends, else ``low``."""
        with files.open_input_file(path) as source:
            at = size
            while at > low:
                begin = max(low, at - TAIL_BYTES)
                found = source.read_at(at - begin, begin).rfind(b"\n")
                if found >= 0:
                    return begin + found + 1
                at = begin
        return low

    def partitions(self, start: dict, end: dict) -> list[Bundle]:
        begun, ends = json.loads(start["ends"]), json.loads(end["ends"])
        return bundled(r for path, stop in ends.items() for r in cut(path, begun.get(path, 0), stop, self.size))

    def commit(self, end: dict) -> None:
        """Nothing is kept for epochs that are done."""


class LineSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> LineReader:
        return LineReader(dict(self.options))

    def streamReader(self, schema) -> LineStreamReader:
        return LineStreamReader(dict(self.options))


def _named(lines: DataFrame) -> DataFrame:
    return lines.withColumn("file_name", batch_file(F.col("file_path")))


def read_lines(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """(file_path, file_block, line_no, offset, value, file_name) of all lines below a folder.

    ``line_no`` counts from the start of the range ``file_block``; an absent or empty folder
    has no lines.
    """
    spark.dataSource.register(LineSource)
    return _named(spark.read.format(FORMAT).option("range_bytes", str(range_bytes)).load(path))


def stream_lines(spark: SparkSession, path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """The same as a stream, whole lines alone. ``offset`` orders the lines of a file over all epochs.

    A checkpoint holds one number per file, so finished files should leave the folder now and then.
    """
    spark.dataSource.register(LineSource)
    return _named(spark.readStream.format(FORMAT).option("range_bytes", str(range_bytes)).load(path))


def with_line_numbers(lines: DataFrame) -> DataFrame:
    """Add ``number``, the place of a line in its file from 0, blank lines counted.

    Needs all lines of the files. Ranges are counted, and the counts, one row per range, are
    summed along each file; no line is sorted.
    """
    counts = lines.groupBy("file_path", "file_block").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("file_path").orderBy("file_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("file_path", "file_block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_before"))
    return lines.join(starts, ["file_path", "file_block"]).withColumn("number", F.col("_before") + F.col("line_no")).drop("_before")
