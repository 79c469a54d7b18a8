"""Content-addressed images and shrinking."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from quillon.functions.keys import content_hash
from quillon.operators.state import as_events
from quillon.session import materialize
from quillon.sources.packs import one_place, pack_index, read_packed, write_packed

# PNG's colour types by number of channels.
PNG_COLOURS = {1: 0, 3: 2, 4: 6}
PIXEL_SCHEMA = "height int, width int, n_channels int, pixels binary"
LANCZOS_SUPPORT = 3.0


#: So many hashes of new pictures travel to every task: 64 bytes each.
MAX_HASHES = 1_000_000


def store_blobs(blobs: DataFrame, path: str) -> None:
    """Append the pictures of a table (content) to a pack folder, found by hash.

    Copies are settled on hashes: a task packs its first copy, and the index tells which
    of several packed copies is read. The bytes stay where they are scanned. Pictures the
    store has already are left out as long as the hashes of the new ones are few enough
    to travel (checked); beyond that they may be packed once more, which costs space only.
    """
    hashed = blobs.where("content IS NOT NULL").select(content_hash(F.col("content")).alias("key"), "content")
    known = blob_index(blobs.sparkSession, path)
    if not known.isEmpty():
        new = hashed.select("key").distinct().join(known.select(F.col("sha").alias("key")), "key", "left_anti")
        new = materialize(new, "hashes")
        if new.count() <= MAX_HASHES:
            hashed = hashed.join(F.broadcast(new), "key", "left_semi")
    write_packed(hashed, path, once=True)


def blob_index(spark: SparkSession, path: str) -> DataFrame:
    """(sha, pack, offset, length) of every stored picture; empty before the first write."""
    return one_place(pack_index(spark, path)).withColumnRenamed("key", "sha")


def stored_blobs(spark: SparkSession, path: str) -> DataFrame:
    """(sha, content) of every stored picture."""
    return read_packed(blob_index(spark, path), path).select("sha", "content")


def target_size(width: int, height: int, max_side: int) -> tuple[int, int]:
    """Size after shrinking the longer side to ``max_side``; small images keep theirs."""
    longest = max(width, height)
    if longest <= max_side:
        return width, height
    ratio = max_side / longest
    return max(1, int(width * ratio)), max(1, int(height * ratio))


def lanczos_weights(old: int, new: int) -> np.ndarray:
    """(new, old) matrix of a Lanczos-3 reduction of one axis; rows sum to one."""
    scale = old / new
    reach = LANCZOS_SUPPORT * max(scale, 1.0)
    centers = (np.arange(new) + 0.5) * scale
    x = (np.arange(old)[None, :] + 0.5 - centers[:, None]) / max(scale, 1.0)
    weights = np.where(np.abs(x) * max(scale, 1.0) < reach, np.sinc(x) * np.sinc(x / LANCZOS_SUPPORT), 0.0)
    return weights / weights.sum(axis=1, keepdims=True)


def shrink_pixels(pixels: np.ndarray, max_side: int) -> np.ndarray:
    """Height x width x channels bytes, reduced to fit ``max_side``."""
    height, width = pixels.shape[:2]
    new_width, new_height = target_size(width, height, max_side)
    if (new_width, new_height) == (width, height):
        return pixels
    rows, columns = lanczos_weights(height, new_height), lanczos_weights(width, new_width)
    reduced = np.einsum("yh,hwc,xw->yxc", rows, pixels.astype(np.float64), columns, optimize=True)
    return np.clip(np.floor(reduced + 0.5), 0, 255).astype(np.uint8)


def png(pixels: np.ndarray) -> bytes:
    """An encoded picture of height x width x channels bytes (channels as Spark decodes
    them: blue, green, red, opacity)."""
    height, width, channels = pixels.shape
    if channels > 2:
        pixels = pixels[:, :, [2, 1, 0, 3][:channels]]
    rows = np.concatenate([np.zeros((height, 1), np.uint8), pixels.reshape(height, -1)], axis=1)

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    head = struct.pack(">IIBBBBB", width, height, 8, PNG_COLOURS[channels], 0, 0, 0)
    body = chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(rows.tobytes())) + chunk(b"IEND", b"")
    return b"\x89PNG\r\n\x1a\n" + body


def shrink_images(images: DataFrame, max_side: int, keep: Sequence[str], encode: bool = False) -> DataFrame:
    """``keep`` columns, then height, width, n_channels, pixels and sha of shrunk images.

    With ``encode``, pixels hold a PNG instead.

    ``images`` has the columns of Spark's image source (height, width, nChannels, data).
    Images that could not be decoded (no data) get null pixels.
    """
    kept = [images.schema[c] for c in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            carried = batch.columns[: len(kept)]
            shapes, contents = [], []
            for h, w, c, d in zip(*(col.to_pylist() for col in batch.columns[len(kept) :])):
                if not d or h < 1 or w < 1:
                    shapes.append((None, None, None))
                    contents.append(None)
                    continue
                small = shrink_pixels(np.frombuffer(d, np.uint8).reshape(h, w, c), max_side)
                shapes.append(small.shape)
                contents.append(png(small) if encode else small.tobytes())
            sizes = [pa.array([s[i] for s in shapes], pa.int32()) for i in range(3)]
            yield pa.RecordBatch.from_arrays(
                [*carried, *sizes, pa.array(contents, pa.binary())],
                names=[*keep, "height", "width", "n_channels", "pixels"],
            )

    schema = T.StructType([*kept, *T.StructType.fromDDL(PIXEL_SCHEMA).fields])
    shrunk = images.select(*keep, "height", "width", "nChannels", "data").mapInArrow(run, schema)
    return shrunk.withColumn("sha", content_hash(F.col("pixels")))


def shrink_column(df: DataFrame, column: str, max_side: int) -> DataFrame:
    """Replace a column of decoded pictures by shrunk ones (PNG), in place.

    Pictures that could not be decoded become empty; absent ones stay null.
    """
    others = [c for c in df.columns if c != column]
    flat = df.select(*others, F.col(column).isNotNull().alias("_had"), f"`{column}`.*")
    shrunk = shrink_images(flat, max_side, [*others, "_had"], encode=True)
    pixels = F.when(F.col("_had"), F.coalesce("pixels", F.lit(b""))).alias(column)
    return shrunk.select(*[pixels if c == column else F.col(f"`{c}`") for c in df.columns])


def stored_content(column: str) -> Column:
    """Bytes worth storing: null for absent and for undecodable (empty) pictures."""
    return F.when(F.octet_length(column) > 0, F.col(column))


def embedded_image_events(pictures: DataFrame, seq: int) -> DataFrame:
    """Image events of pictures that came with the dataset (record_id, sha): ok or failed."""
    ok = F.col("sha").isNotNull()
    return as_events(pictures.select(
        "record_id",
        F.lit(seq).alias("seq"),
        F.lit("image").alias("event"),
        F.when(ok, "ok").otherwise("failed").alias("image_status"),
        F.col("sha").alias("image_sha"),
    ))
