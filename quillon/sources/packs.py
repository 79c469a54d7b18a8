"""Many small byte strings in few files, found by key through an index of byte ranges.

A folder holds ``data`` (pack files), ``index`` (Parquet rows pack, key, offset, length) and
``commits`` (the packs of each finished write). Tasks write packs of their own; a pack counts
once the driver has committed it, so lost executors, repeated tasks and failed writes
leave nothing that is read.
"""

from __future__ import annotations

import functools
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from quillon.sources.epochs import read_or_empty

FORMAT = "quillon_packs"
INDEX_SCHEMA = "pack string, key string, offset bigint, length bigint"
ARROW_INDEX = pa.schema([("pack", pa.string()), ("key", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])
#: A pack is closed at the first key after so many bytes; a read task takes about as many.
PACK_BYTES = 128 << 20
#: Bytes a reader hands on at a time.
BATCH_BYTES = 8 << 20
#: Packs a reading task keeps open.
OPEN_PACKS = 32


def filesystem(path: str) -> tuple[fs.FileSystem, str]:
    """pyarrow's file system of an absolute path or URI, and the path in it."""
    return fs.FileSystem.from_uri(path)


@dataclass
class Packed(WriterCommitMessage):
    packs: list[str]


class _Pack:
    """An open pack file and the ranges of its keys."""

    def __init__(self, files: fs.FileSystem, base: str):
        self.name, self.files, self.base = f"pack-{uuid.uuid4().hex}", files, base
        self.out = files.open_output_stream(f"{base}/data/{self.name}", compression=None)
        self.keys: list[str] = []
        self.offsets: list[int] = []
        self.size = 0

    def add(self, key: str, content: pa.Buffer) -> None:
        if not self.keys or self.keys[-1] != key:
            self.keys.append(key)
            self.offsets.append(self.size)
        self.out.write(content)
        self.size += len(content)

    def close(self) -> str:
        self.out.close()
        ends = [*self.offsets[1:], self.size]
        lengths = [end - start for start, end in zip(self.offsets, ends)]
        rows = pa.table([[self.name] * len(self.keys), self.keys, self.offsets, lengths], schema=ARROW_INDEX)
        with self.files.open_output_stream(f"{self.base}/index/{self.name}.parquet", compression=None) as out:
            pq.write_table(rows, out)
        return self.name


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.Buffer, int]]:
    """Neighbouring rows of one key: the key, their contents as one, and how much of it the first row has."""
    keys, contents = batch.column("key").to_pylist(), batch.column("content").cast(pa.binary())
    _, places, data = contents.buffers()
    ends = np.frombuffer(places, np.int32)[contents.offset : contents.offset + len(keys) + 1].tolist()
    data, start = data or pa.py_buffer(b""), 0
    for i in range(1, len(keys) + 1):
        if i == len(keys) or keys[i] != keys[start]:
            yield keys[start], data.slice(ends[start], ends[i] - ends[start]), ends[start + 1] - ends[start]
            start = i


class PackWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.folder = options["folder"]
        self.once = options.get("once", "false") == "true"
        self.pack_bytes = int(options.get("pack_bytes", PACK_BYTES))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Packed:
        files, base = filesystem(self.folder)
        for part in ("data", "index"):
            files.create_dir(f"{base}/{part}", recursive=True)
        done: list[str] = []
        seen: set[str] = set()
        pack, last = None, None
        for batch in iterator:
            for key, content, first in _runs(batch):
                if self.once:
                    if key in seen:
                        continue
                    seen.add(key)
                    content = content.slice(0, first)
                if pack is not None and key != last and pack.size >= self.pack_bytes:
                    done.append(pack.close())
                    pack = None
                pack = pack or _Pack(files, base)
                pack.add(key, content)
                last = key
        if pack is not None:
            done.append(pack.close())
        return Packed(done)

    def commit(self, messages: list[Packed | None]) -> None:
        files, base = filesystem(self.folder)
        files.create_dir(f"{base}/commits", recursive=True)
        names = [name for m in messages if m for name in m.packs]
        with files.open_output_stream(f"{base}/commits/{uuid.uuid4().hex}.json", compression=None) as out:
            out.write("".join(json.dumps({"pack": n}) + "\n" for n in names).encode())

    def abort(self, messages: list[Packed | None]) -> None:
        """Remove the packs of tasks that had ended; those of failed tasks are never read."""
        files, base = filesystem(self.folder)
        for name in (name for m in messages if m for name in m.packs):
            files.delete_file(f"{base}/data/{name}")
            files.delete_file(f"{base}/index/{name}.parquet")


class PackSource(DataSource):
    """Write only: packs are read through their index (``read_packed``)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema: T.StructType, overwrite: bool) -> PackWriter:
        return PackWriter(dict(self.options))


def write_packed(entries: DataFrame, path: str, once: bool = False, pack_bytes: int = PACK_BYTES) -> None:
    """Append (key, content) rows to a pack folder, where they lie: nothing is shuffled.

    Neighbouring rows of one key are one entry. With ``once`` a task stores a key's first row only.
    Rows without a key or content are left out.
    """
    entries.sparkSession.dataSource.register(PackSource)
    rows = entries.select(F.col("key").cast("string"), F.col("content").cast("binary")).dropna()
    options = {"folder": path, "once": str(once).lower(), "pack_bytes": str(pack_bytes)}
    rows.write.format(FORMAT).options(**options).mode("append").save()


def pack_index(spark: SparkSession, path: str) -> DataFrame:
    """(pack, key, offset, length) of all committed packs; empty before the first write."""
    rows = read_or_empty(spark, f"{path}/index", T.StructType.fromDDL(INDEX_SCHEMA))
    return rows.join(_committed(spark, f"{path}/commits"), "pack", "left_semi")


def _committed(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType.fromDDL("pack string")
    files, base = filesystem(path)
    if files.get_file_info(base).type == fs.FileType.NotFound:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path)


def one_place(index: DataFrame) -> DataFrame:
    """One entry per key, of several equal ones always the same."""
    places = F.min(F.struct("pack", "offset", "length")).alias("place")
    return index.groupBy("key").agg(places).select("place.pack", "key", "place.offset", "place.length")


def _contents(batches: Iterator[pa.RecordBatch], path: str, lines: bool) -> Iterator[pa.RecordBatch]:
    """The rows with their bytes, or with one line of them each, in batches of bounded size."""
    files, base = filesystem(path)
    opened: dict[str, pa.NativeFile] = {}

    def read(pack: str, offset: int, length: int) -> bytes:
        if pack not in opened:
            if len(opened) >= OPEN_PACKS:
                opened.pop(next(iter(opened))).close()
            opened[pack] = files.open_input_file(f"{base}/data/{pack}")
        return opened[pack].read_at(length, offset)

    def packed(batch: pa.RecordBatch, rows: list[int], found: list[bytes | None]) -> pa.RecordBatch:
        kept = batch.take(pa.array(rows, pa.int64()))
        return pa.RecordBatch.from_arrays(
            [*kept.columns, pa.array(found, pa.binary())], names=[*batch.schema.names, "content"])

    for batch in batches:
        rows, found, size = [], [], 0
        places = zip(*(batch.column(c).to_pylist() for c in ("pack", "offset", "length")))
        for i, (pack, offset, length) in enumerate(places):
            if pack is None:
                rows.append(i)
                found.append(None)
                continue
            data = read(pack, offset, length)
            pieces = data.removesuffix(b"\n").split(b"\n") if lines else [data]
            for piece in pieces:
                rows.append(i)
                found.append(piece)
                size += len(piece)
                if size >= BATCH_BYTES:
                    yield packed(batch, rows, found)
                    rows, found, size = [], [], 0
        if rows:
            yield packed(batch, rows, found)
    for source in opened.values():
        source.close()


def with_content(placed: DataFrame, path: str, lines: bool = False) -> DataFrame:
    """Rows that hold pack, offset and length, with the bytes there as ``content``.

    Each task reads the ranges of its own rows; rows without a place have no content. With
    ``lines`` there is one row per line of an entry.
    """
    schema = T.StructType([*placed.schema.fields, T.StructField("content", T.BinaryType())])
    return placed.mapInArrow(functools.partial(_contents, path=path, lines=lines), schema)


def read_packed(entries: DataFrame, path: str, lines: bool = False) -> DataFrame:
    """Index rows with their content; tasks take neighbouring ranges of about ``PACK_BYTES``."""
    spark = entries.sparkSession
    total = entries.agg(F.sum("length")).first()[0] or 0
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // PACK_BYTES))
    # Little is dealt out in small pieces, or one task would read it all.
    chunk = F.floor(F.col("offset") / F.lit(max(1, min(PACK_BYTES // 8, total // (16 * tasks)))))
    near = entries.repartition(tasks, "pack", chunk).sortWithinPartitions("pack", "offset")
    return with_content(near, path, lines)
