"""Near-equal lines across documents by a deletion-neighbourhood join."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from quillon.llm.text import mix
from quillon.session import materialize

#: Shorter lines are compared for equality alone; every line that isn't empty has neighbours.
LEAST = 1
#: Parts of a line for the first sieve, over all lines, and for the second, over the rest.
FIRST, SECOND = 2, 8
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _content(data: bytes) -> tuple[int, int]:
    a = np.frombuffer(xxhash.xxh3_128_digest(data), np.int64)
    return int(a[0]), int(a[1])


def around(line: str, parts: int) -> list[int]:
    """Keys of which two lines within one edit share at least one: the edit lies in one of
    ``parts`` equal parts of the shorter line, and what stands around that part is equal.
    A line is taken as the shorter one, or as one that has a character more."""
    n, keys = len(line), []
    for m in (n, n - 1):
        for j in range(parts):
            head, tail = j * m // parts, m - (j + 1) * m // parts
            keys.append(f"{m}:{j}:{line[:head]}|{line[n - tail:]}")
    return sorted({xxhash.xxh3_64_intdigest(k.encode()) - (1 << 63) for k in keys})


def variants(line: str) -> tuple[np.ndarray, np.ndarray]:
    """(whole, holes): keys of the line and of each line one deletion away, and keys of the
    deletions together with their place. Lines that share a hole differ in one character
    there; a deletion that is another line's whole is one insertion away from it."""
    codes = mix(np.frombuffer(line.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(7))
    n = len(codes)
    factors = np.full(n + 1, _BASE)
    factors[0] = 1
    powers = np.cumprod(factors, dtype=np.uint64)
    ahead = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * powers[:n], dtype=np.uint64)])
    behind = np.concatenate([np.cumsum((codes[1:] * powers[: n - 1])[::-1], dtype=np.uint64)[::-1], np.zeros(1, np.uint64)])
    sizes = np.array([n - 1, n], np.uint64) * np.uint64(0x165667B19E3779F9)
    gone, own = mix(ahead[:n] + behind + sizes[:1]), mix(ahead[n:] + sizes[1:])
    holes = mix(gone + np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))
    return np.concatenate([own, np.unique(gone)]), holes


def within_one(a: str, b: str) -> bool:
    """Whether one edit (of a character) at most makes ``a`` out of ``b``."""
    if abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    return a[i + (len(a) >= len(b)):] == b[i + (len(b) >= len(a)):]


def _lines(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("line", pa.int32()), ("h1", pa.int64()), ("h2", pa.int64()), ("halves", pa.list_(pa.int64()))])
    for batch in batches:
        rows = []
        for doc_id, key, text in zip(*(c.to_pylist() for c in batch.columns)):
            for i, line in enumerate(text.split("\n")):
                if line:
                    rows.append((doc_id, key, i, *_content(line.encode()), around(line, FIRST) if len(line) >= least else []))
        columns = list(zip(*rows)) or [[]] * len(schema)
        yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [around(t, SECOND) for t in batch.column("content").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("h1"), batch.column("h2"), pa.array(keys, pa.list_(pa.int64()))], names=["h1", "h2", "halves"])


def _sharing(keyed: DataFrame) -> DataFrame:
    """(h1, h2) of the lines that share one of their keys with another line."""
    each = keyed.select("h1", "h2", F.explode("halves").alias("half"))
    shared = materialize(each.groupBy("half").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("half"), "shared")
    return materialize(each.join(shared, "half", "left_semi").select("h1", "h2").distinct(), "sharing")


def _varied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["variant", "kind", "h1", "h2", "doc_id", "line"]
    for batch in batches:
        for i, text in enumerate(batch.column("content")):
            whole, holes = variants(text.as_py())
            keys = np.concatenate([whole, holes]).view(np.int64)
            kind = np.repeat(np.array([0, 1, 2], np.int8), [1, len(whole) - 1, len(holes)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys), pa.array(kind), *(pa.array([batch.column(c)[i].as_py()] * len(keys), batch.column(c).type) for c in ("h1", "h2", "doc_id", "line"))],
                names=names)


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = pa.array([within_one(a, b) for a, b in zip(batch.column("content").to_pylist(), batch.column("other").to_pylist())], pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("h1", "h2", "doc_id", "line")], names=["h1", "h2", "doc_id", "line"])


def repeated_lines(docs: DataFrame, least: int = LEAST, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(doc_id, key, line): lines with an earlier line within one edit; ``key`` hashes the text.

    Earlier is by (doc_id, line number), null ids first; every line is held against all
    lines, removed ones too. Equal lines are grouped by a 128-bit hash first. Lines of
    ``least`` characters and more that share an exact half with another line, and then all
    but one eighth, emit their deletion neighbourhood as hashed keys; equal keys meet, the earliest partner of each
    line is a combined minimum, and the edit distance to it is verified.
    """
    text = F.col(text_column)
    rows = docs.where(text.isNotNull()).select(F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(text).alias("key"), text.alias("text"))
    lines = materialize(rows.mapInArrow(functools.partial(_lines, least=least),
                                        "doc_id long, key long, line int, h1 long, h2 long, halves array<long>"), "lines")
    kinds = materialize(lines.groupBy("h1", "h2").agg(
        F.min(F.struct("doc_id", "line", "key")).alias("first"), F.count(F.lit(1)).alias("n"), F.first("halves").alias("halves")), "kinds")

    near = materialize(kinds.join(_sharing(kinds), ["h1", "h2"], "left_semi").select("h1", "h2", "first.*"), "near")
    holders = materialize(near.select(F.col("doc_id").alias("_id"), F.col("key").alias("_key")).distinct(), "holders")
    held = rows.join(holders, rows["doc_id"].eqNullSafe(holders["_id"]) & (rows["key"] == holders["_key"]), "left_semi")
    each = held.dropDuplicates(["doc_id", "key"]).select("doc_id", "key", F.posexplode(F.split("text", "\n")).alias("line", "content"))
    n, e = near.alias("n"), each.alias("e")
    contents = materialize(n.join(e, F.col("n.doc_id").eqNullSafe(F.col("e.doc_id")) & (F.col("n.key") == F.col("e.key")) & (F.col("n.line") == F.col("e.line"))).select(
        "n.h1", "n.h2", "n.doc_id", "n.line", "e.content"), "contents")

    keyed = materialize(contents.mapInArrow(_keyed, "h1 long, h2 long, halves array<long>"), "keyed")
    contents = materialize(contents.join(_sharing(keyed), ["h1", "h2"], "left_semi").select(contents.columns), "contents")
    keys = materialize(contents.mapInArrow(_varied, "variant long, kind byte, h1 long, h2 long, doc_id long, line int"), "variants")
    place = F.struct("doc_id", "line", "h1", "h2")
    met = keys.groupBy("variant", (F.col("kind") == 2).alias("hole")).agg(
        F.count(F.lit(1)).alias("n"), F.min(place).alias("any"),
        F.min(F.when(F.col("kind") == 0, place)).alias("whole"), F.min(F.when(F.col("kind") == 1, place)).alias("shorter"))
    met = materialize(met.where("n > 1"), "met").withColumnRenamed("hole", "_hole").withColumnRenamed("variant", "_variant")
    joined = keys.join(met, (F.col("variant") == F.col("_variant")) & ((F.col("kind") == 2) == F.col("_hole")))
    partner = F.when(F.col("kind") == 2, F.col("any")).when(F.col("kind") == 1, F.col("whole")).otherwise(F.col("shorter"))
    first = joined.withColumn("partner", partner).where(F.col("partner") < place).groupBy("h1", "h2").agg(F.min("partner").alias("p"))
    text1 = contents.select("h1", "h2", "content")
    text2 = contents.select(F.col("h1").alias("p1"), F.col("h2").alias("p2"), F.col("content").alias("other"))
    pairs = first.select("h1", "h2", F.col("p.doc_id").alias("doc_id"), F.col("p.line").alias("line"), F.col("p.h1").alias("p1"), F.col("p.h2").alias("p2"))
    verified = materialize(pairs.join(text1, ["h1", "h2"]).join(text2, ["p1", "p2"]).mapInArrow(_verified, "h1 long, h2 long, doc_id long, line int"), "verified")

    # The earliest place of each kind of line that repeats, by itself or by a partner.
    early = kinds.join(verified.select("h1", "h2", F.struct("doc_id", "line").alias("p")), ["h1", "h2"], "left")
    early = materialize(early.where("n > 1 OR p IS NOT NULL").select(
        "h1", "h2", F.least(F.struct("first.doc_id", "first.line"), F.col("p")).alias("p")), "early")
    return lines.select("doc_id", "key", "line", "h1", "h2").join(early, ["h1", "h2"]).where(
        F.col("p") < F.struct("doc_id", "line")).select("doc_id", "key", "line")


def without_repeated_lines(docs: DataFrame, least: int = LEAST, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with n_lines, n_removed and the kept lines as ``text``.

    A null text stays null with no lines; an empty text has no lines; empty lines stay and
    aren't compared. Documents that share an id are told apart by their text; rows that
    repeat a document keep the same lines, as none is earlier. No rows give no rows.
    """
    gone = repeated_lines(docs, least, id_column, text_column).groupBy("doc_id", "key").agg(F.collect_set("line").alias("gone")).alias("g")
    # Columns of the documents stay in a struct, so that their names can't clash.
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    own_id, text = F.col("row").getField(id_column).cast("long"), F.col("row").getField(text_column)
    met = rows.join(gone, own_id.eqNullSafe(F.col("g.doc_id")) & (F.xxhash64(text) == F.col("g.key")), "left")
    lines = F.split(text, "\n")
    kept = F.filter(lines, lambda _, i: ~F.array_contains(F.coalesce("gone", F.array().cast("array<int>")), i))
    n = F.when(text != "", F.size(lines)).otherwise(0).cast("long")
    left = F.when(F.col("gone").isNull(), text).otherwise(F.array_join(kept, "\n"))
    row = F.col("row").withField(text_column, left).alias("row")
    found = met.select(row, n.alias("n_lines"), F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_removed"))
    own = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in ("n_lines", "n_removed")]
    return found.select(*own, "n_lines", "n_removed")
