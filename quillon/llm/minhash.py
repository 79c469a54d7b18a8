"""Near-duplicate documents by b-bit MinHash."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from quillon.llm.components import components
from quillon.llm.text import mix, shingle_set
from quillon.session import materialize

BANDS, ROWS = 32, 4
MINIMA = BANDS * ROWS
#: Low bits kept of each minimum.
BITS = 2
PER_WORD = 64 // BITS
PACKED = MINIMA // PER_WORD
#: An estimate this far below the threshold (nearly five standard deviations) rules a pair
#: out: one link in a million.
MARGIN = 0.2
CHUNK = 2048
#: Members of a bucket compared by one task at a time, and bits of a set's outline.
BLOCK = 2048
OUTLINE = 4096

_SIGNED = ", ".join(["doc_id long, n_shingles long, d1 long, d2 long", *(f"s{i} long" for i in range(PACKED)), "bands array<long>"])


def _seeds() -> tuple[np.ndarray, np.ndarray]:
    seeds = mix(np.arange(1, MINIMA + 1, dtype=np.uint64))
    return (seeds >> np.uint64(32)).astype(np.uint32), (seeds.astype(np.uint32) | np.uint32(1))


def minima(shingles: np.ndarray) -> np.ndarray:
    """Least value of the set under each of the hash functions."""
    flips, factors = _seeds()
    values = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(MINIMA, 0xFFFFFFFF, np.uint32)
    for start in range(0, len(values), CHUNK):
        h = (values[start : start + CHUNK, None] ^ flips) * factors
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x85EBCA6B)
        np.minimum(least, h.min(axis=0), out=least)
    return least


def pack(table: np.ndarray) -> np.ndarray:
    """Low bits of each row's minima, packed into 64-bit words."""
    low = (table & np.uint32((1 << BITS) - 1)).astype(np.uint64).reshape(len(table), PACKED, PER_WORD)
    shifts = np.arange(PER_WORD, dtype=np.uint64) * np.uint64(BITS)
    return np.bitwise_or.reduce(low << shifts, axis=2)


def band_keys(table: np.ndarray) -> np.ndarray:
    """One 64-bit key per row and band, of the band's full minima and its number."""
    parts = table.reshape(len(table), BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), parts.shape[:2])
    for i in range(ROWS):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, i] + np.uint64(1))
    return keys


def _signed(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        table = np.zeros((batch.num_rows, MINIMA), np.uint32)
        sizes, digests = np.zeros(batch.num_rows, np.int64), np.zeros((batch.num_rows, 2), np.uint64)
        for i, text in enumerate(batch.column(1)):
            shingles = shingle_set(text.as_py(), n)
            sizes[i] = len(shingles)
            table[i] = minima(shingles)
            digests[i] = np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes()), np.uint64)
        packed, keys = pack(table), band_keys(table)
        some = sizes > 0
        offsets = np.concatenate([[0], np.cumsum(np.where(some, BANDS, 0))]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[some].view(np.int64).ravel()))
        columns = [batch.column(0), pa.array(sizes), *(pa.array(digests[:, j].view(np.int64)) for j in (0, 1)),
                   *(pa.array(np.ascontiguousarray(packed[:, j]).view(np.int64)) for j in range(PACKED)), lists]
        names = ["doc_id", "n_shingles", "d1", "d2", *(f"s{j}" for j in range(PACKED)), "bands"]
        yield pa.RecordBatch.from_arrays(columns, names=names)


def signatures(docs: DataFrame, words: int, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Set size, set digest, packed signature and band keys of each document."""
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("binary").alias("text"))
    return rows.mapInArrow(functools.partial(_signed, n=words), _SIGNED)


def similarity_estimate(left: str, right: str) -> Column:
    """Similarity from the bit counts of two packed signatures, corrected for collisions."""
    same = F.lit(0)
    for i in range(PACKED):
        differ = F.col(f"{left}.s{i}").bitwiseXOR(F.col(f"{right}.s{i}"))
        differ = differ.bitwiseOR(F.shiftrightunsigned(differ, 1)).bitwiseAND(F.lit(0x5555555555555555))
        same = same + PER_WORD - F.bit_count(differ)
    chance = 1 / (1 << BITS)
    return (same / F.lit(float(MINIMA)) - chance) / (1 - chance)


def _confirmed(batches: Iterator[pa.RecordBatch], n: int, percent: int) -> Iterator[pa.RecordBatch]:
    last: dict[str, tuple] = {"a": (None, None), "b": (None, None)}

    def of(side: str, key: int, text) -> np.ndarray:
        # An id may carry several texts.
        if last[side][0] != (key, held := text.as_py()):
            last[side] = ((key, held), shingle_set(held, n))
        return last[side][1]

    for batch in batches:
        keep = np.zeros(batch.num_rows, bool)
        a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for i in range(batch.num_rows):
            x, y = of("a", a[i], batch.column(2)[i]), of("b", b[i], batch.column(3)[i])
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep[i] = 100 * both >= percent * (len(x) + len(y) - both)
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep)), batch.column(1).filter(pa.array(keep))], names=["u", "v"])


def _near(pairs: DataFrame, reps: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Pairs (u, v) whose sizes and signatures allow the threshold and whose sets reach it."""
    held = ["doc_id", "n_shingles", *(f"s{i}" for i in range(PACKED))]
    x, y = reps.select(held).alias("x"), reps.select(held).alias("y")
    close = materialize(
        pairs.alias("p").join(x, F.col("p.u") == F.col("x.doc_id")).join(y, F.col("p.v") == F.col("y.doc_id"))
        .where(100 * F.least("x.n_shingles", "y.n_shingles") >= percent * F.greatest("x.n_shingles", "y.n_shingles"))
        .where(similarity_estimate("x", "y") >= percent / 100 - MARGIN).select("p.u", "p.v"), "close")
    ids = close.select(F.col("u").alias("doc_id")).unionByName(close.select(F.col("v").alias("doc_id"))).distinct()
    mine = materialize(texts.join(materialize(ids, "ids"), "doc_id", "left_semi"), "texts")
    joined = (
        close.join(mine.select(F.col("doc_id").alias("u"), F.col("text").alias("a")), "u")
        .join(mine.select(F.col("doc_id").alias("v"), F.col("text").alias("b")), "v")
        .select("u", "v", "a", "b")
    )
    return materialize(joined.mapInArrow(functools.partial(_confirmed, n=words, percent=percent), "u long, v long"), "near")


def _outlined(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """A bitmap of each set. Bits that only one of two bitmaps has are shingles that only
    its set has, which bounds the similarity from above."""
    for batch in batches:
        digests, bits = [], []
        for text in batch.column(1):
            shingles = shingle_set(text.as_py(), n)
            digests.append(int(np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes()), np.int64)[0]))
            flags = np.zeros(OUTLINE, bool)
            flags[(shingles & np.uint64(OUTLINE - 1)).astype(np.int64)] = True
            bits.append(np.packbits(flags).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(digests, pa.int64()), pa.array(bits, pa.binary())], names=["doc_id", "d1", "outline"])


def _across(frame: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Pairs of one block of a bucket that lie in different components and may be near.

    A pair is given by the first of the buckets it shares.
    """
    frame = frame.sort_values("doc_id")
    floor = percent / 100 - MARGIN
    ids, roots, side, sizes = (frame[c].to_numpy() for c in ("doc_id", "root", "side", "n_shingles"))
    bands = np.stack(frame["bands"].to_numpy())
    outlines = np.stack([np.frombuffer(o, np.uint64) for o in frame["outline"]])
    here = int(np.flatnonzero(bands[0] == frame["band"].iloc[0])[0])
    packed = frame[[f"s{i}" for i in range(PACKED)]].to_numpy().view(np.uint64)
    i, j = (int(frame[c].iloc[0]) for c in ("i", "j"))
    rows, columns = np.flatnonzero(side == i), np.flatnonzero(side == j)
    least = MINIMA * (floor * (1 - 1 / (1 << BITS)) + 1 / (1 << BITS))
    found = []
    for row in rows:
        differ = packed[columns] ^ packed[row]
        differ = (differ | (differ >> np.uint64(1))) & np.uint64(0x5555555555555555)
        same = MINIMA - np.bitwise_count(differ).sum(axis=1, dtype=np.int64)
        hit = columns[(same >= least) & (roots[columns] != roots[row]) & ((i != j) | (columns > row))]
        low, high = np.minimum(sizes[hit], sizes[row]), np.maximum(sizes[hit], sizes[row])
        hit = hit[100 * low >= percent * high]
        hit = hit[(bands[hit, : here + 1] == bands[row, : here + 1]).argmax(axis=1) == here]
        mine = np.bitwise_count(outlines[row] & ~outlines[hit]).sum(axis=1, dtype=np.int64)
        theirs = np.bitwise_count(outlines[hit] & ~outlines[row]).sum(axis=1, dtype=np.int64)
        common = np.minimum(sizes[row] - mine, sizes[hit] - theirs)
        hit = hit[100 * common >= percent * (sizes[hit] + sizes[row] - common)]
        found.append(np.stack([np.full(len(hit), ids[row]), ids[hit]]))
    pairs = np.concatenate(found, axis=1) if found else np.empty((2, 0), np.int64)
    return pd.DataFrame({"u": pairs[0], "v": pairs[1]})


def near_duplicates(
    docs: DataFrame, words: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept): documents grouped by similar shingle sets.

    Texts with equal sets form one class, found by a set digest. Classes that agree in all
    full minima of one of the bands meet in a bucket; every member is tested with the
    member of its bucket that shares the most buckets with others. Components of the confirmed links then tell which buckets still
    hold different components, and only there all members are compared, in blocks: by bit
    counts over the packed low bits, corrected for collisions, and by bitmaps of the sets,
    which bound the similarity. What passes is confirmed on full sets. A link of similarity 0.8 shares no band with a chance of 5e-8.

    A document without words has an empty set and is linked with nothing. A document
    without an id can't be named: its component is null and it is kept. Rows with the same
    id are one document, each row is returned, and their sets are linked. Other columns of
    ``docs`` are ignored. An empty table gives no rows.
    """
    signed = materialize(signatures(docs, words, id_column, text_column), "signed")
    named = signed.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = materialize(named.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep")), "classes")
    least = classes.select("d1", "d2", F.col("rep").alias("doc_id"))
    reps = materialize(named.join(least, ["d1", "d2", "doc_id"], "left_semi").dropDuplicates(["doc_id", "d1", "d2"]), "reps")
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("binary").alias("text"))

    banded = reps.select("doc_id", F.explode("bands").alias("band"))
    buckets = materialize(banded.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
    met = materialize(banded.join(buckets, "band"), "met")
    # What many others were made from meets them in the most bands: it leads.
    often = materialize(met.groupBy("doc_id").agg(F.sum("n").alias("often")), "often")
    led = met.join(often, "doc_id").groupBy("band").agg(F.max(F.struct("often", "doc_id")).alias("leader"))
    members = materialize(met.join(materialize(led.select("band", "leader.doc_id").withColumnRenamed("doc_id", "leader"), "leaders"), "band"), "members")
    first = members.where("doc_id <> leader").select(F.col("leader").alias("u"), F.col("doc_id").alias("v")).distinct()
    links = _near(first, reps, texts, words, percent)
    roots = materialize(components(links), "roots")

    # Buckets of three and more that are not one component: the leader is tested already.
    rest = members.where("n > 2 AND doc_id <> leader").join(
        roots.withColumnRenamed("node", "doc_id"), "doc_id", "left"
    ).select("band", "doc_id", F.coalesce("root", "doc_id").alias("root"))
    rest = materialize(rest, "rest")
    mixed = materialize(
        rest.groupBy("band").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("m"))
        .where("lo <> hi").select("band", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks")), "mixed")
    open_rows = materialize(rest.join(mixed, "band"), "open")
    open_ids = materialize(open_rows.select("doc_id").distinct(), "ids")
    outlines = materialize(texts.join(open_ids, "doc_id", "left_semi").mapInArrow(
        functools.partial(_outlined, n=words), "doc_id long, d1 long, outline binary").dropDuplicates(["doc_id", "d1"]), "outlines")
    held = reps.select("doc_id", "d1", "n_shingles", "bands", *(f"s{i}" for i in range(PACKED))).join(outlines, ["doc_id", "d1"]).drop("d1")
    placed = (
        # Of an id with several texts, those that are in the bucket.
        open_rows.distinct().join(held, "doc_id").where(F.array_contains("bands", F.col("band")))
        .withColumn("side", F.pmod(F.xxhash64("doc_id"), "blocks").cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("i", F.least("side", "other")).withColumn("j", F.greatest("side", "other"))
        .drop("blocks", "other")
    )
    across = placed.groupBy("band", "i", "j").applyInPandas(
        lambda frame: _across(frame, percent), "u long, v long").distinct()
    more = _near(across, reps, texts, words, percent)

    # Every document takes the component of its class; classes that share an id are linked.
    assigned = materialize(named.join(classes, ["d1", "d2"]).select("doc_id", "n_shingles", "rep"), "assigned")
    shared = assigned.groupBy("doc_id").agg(F.min("rep").alias("u"), F.max("rep").alias("hi")).where("u <> hi")
    shared = assigned.join(materialize(shared.select("doc_id", "u"), "shared"), "doc_id").select("u", F.col("rep").alias("v"))
    final = materialize(components(links.unionByName(more).unionByName(shared)), "components")
    found = assigned.join(final.withColumnRenamed("node", "rep"), "rep", "left").select(
        "doc_id", "n_shingles", F.coalesce("root", "rep").alias("component_id"))
    found = found.withColumn("kept", F.col("doc_id") == F.col("component_id"))
    rest = signed.where("doc_id IS NULL OR n_shingles = 0")
    return found.unionByName(rest.select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept")))
