"""Repeated substrings by merging Burrows-Wheeler transforms of shards."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from quillon.llm.text import mix
from quillon.session import materialize

#: Bytes of the strings that must not repeat, and of the anchors that route them.
LENGTH, ANCHOR = 200, 32
#: Starts that travel together, and bits of the broadcast sieves (8 MB whatever the input).
RANGE, SIEVE_BITS = 32, 1 << 26
#: Different contexts of one key that a task may hold; beyond, ranges are halved.
CONTEXTS = 2048
#: Windows of one shard, and of one merge.
SHARD_ROWS, MERGE_ROWS = 8192, 32768
PIECE = 1 << 22
_PLACE = np.uint64((1 << 24) - 1)
_BASE = 0x9E3779B97F4A7C15
_CODES = mix(np.arange(1, 257, dtype=np.uint64))


# --- Shards and their merge -----------------------------------------------------------------


def shard_columns(windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(columns, order) of one shard of equally long windows (rows of 16-bit symbols).

    ``columns[t]`` is the transform's column at depth t: the symbols that precede the
    suffixes of t symbols, in the order of those suffixes. ``order`` sorts the windows.
    """
    order, width = np.arange(len(windows)), windows.shape[1]
    columns = np.empty((width, len(windows)), np.uint16)
    for t in range(width):
        columns[t] = windows[order, width - 1 - t]
        order = order[np.argsort(columns[t], kind="stable")]
    return columns, order


def merge_shards(shards: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(source, common) of the merged order, from the shards' columns alone.

    Starts from the shards one after another and refines the interleave once per symbol:
    each shard is read in its own order, and a stable split by the symbols read gives the
    interleave one symbol deeper. Texts are neither read nor compared. ``source`` names
    the shard of each row; ``common`` is the number of the interval of rows whose whole
    windows agree, found by carrying interval bounds through the splits.
    """
    source = np.repeat(np.arange(len(shards)), [s.shape[1] for s in shards])
    interval = np.zeros(len(source), np.int64)
    symbols = np.empty(len(source), np.uint16)
    for t in range(shards[0].shape[0]):
        for z, columns in enumerate(shards):
            symbols[source == z] = columns[t]
        split = np.argsort(symbols, kind="stable")
        source, before, read = source[split], interval[split], symbols[split]
        fresh = (read[1:] != read[:-1]) | (before[1:] != before[:-1])
        interval = np.concatenate([[0], np.cumsum(fresh)]) if len(source) else interval
    return source, interval


def repeated_windows(windows: np.ndarray, shard_rows: int = SHARD_ROWS) -> np.ndarray:
    """Which rows (of LENGTH bytes) occur more than once."""
    if windows.shape[1] % 2:
        windows = np.pad(windows, ((0, 0), (0, 1)))
    symbols = np.ascontiguousarray(windows).view(">u2").astype(np.uint16)
    parts = [shard_columns(symbols[i : i + shard_rows]) for i in range(0, len(symbols), shard_rows)]
    source, interval = merge_shards([p[0] for p in parts])
    often = np.bincount(interval)[interval] > 1
    out = np.zeros(len(windows), bool)
    for z, (_, order) in enumerate(parts):
        out[z * shard_rows + order] = often[source == z]
    return out


# --- Anchors --------------------------------------------------------------------------------


@functools.lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2^64."""
    out = []
    for base in (_BASE, pow(_BASE, -1, 1 << 64)):
        factors = np.full(n, base, np.uint64)
        factors[0] = 1
        out.append(np.cumprod(factors, dtype=np.uint64))
    return out[0], out[1]


def _sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Least of every ``w`` neighbours, by running minima of blocks from both sides."""
    n = len(x)
    padded = np.full(-(-n // w) * w, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = x
    blocks = padded.reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - w + 1], ahead[w - 1 : n])


def anchors(data: bytes, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(place, first, last, hash): the least-hashed run of ANCHOR bytes of each window of
    ``length``, with the first and last start of the windows that share it. The choice
    depends on a window's bytes alone, so equal windows have equal anchors, equally far in."""
    found = []
    raw = np.frombuffer(data, np.uint8)
    for at in range(0, max(0, len(raw) - length + 1), PIECE):
        codes = _CODES[raw[at : at + PIECE + length - 1]]
        n = len(codes)
        size = 1 << max(12, int(n - 1).bit_length())
        powers, inverses = _powers(size)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(codes * powers[:n], dtype=np.uint64)])
        hashes = mix((sums[ANCHOR:] - sums[:-ANCHOR]) * inverses[: n - ANCHOR + 1])
        keys = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
        chosen = (_sliding_min(keys, length - ANCHOR + 1) & _PLACE).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
        last = np.concatenate([first[1:], [len(chosen)]]) - 1
        found.append((chosen[first] + at, first + at, last + at, hashes[chosen[first]]))
    if not found:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    return tuple(np.concatenate(c) for c in zip(*found))


def _sieve(hashes: DataFrame, column: str) -> np.ndarray:
    """Bits of all hashes of a column; a bit too many only costs time."""
    bit = F.pmod(F.col(column), F.lit(SIEVE_BITS))
    words = hashes.groupBy(F.shiftright(bit, 6).alias("word")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(F.lit(63)).cast("int"))).alias("bits")).toArrow()
    out = np.zeros(SIEVE_BITS // 64, np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return out.view(np.uint64)


def _in_sieve(sieve: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bit = hashes & np.uint64(SIEVE_BITS - 1)
    return (sieve[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.column(0)[i].as_py(), batch.column(1)[i].as_py(), batch.column(2)[i].as_py()


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema)], schema=schema)


def _batched(rows: Iterator[tuple], schema: pa.Schema, size: int = 20_000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _table(held, schema)
            held = []
    yield _table(held, schema)


def _anchor_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        parts = [anchors(t.as_py())[3] for t in batch.column(0)]
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(parts).view(np.int64) if parts else np.empty(0, np.int64))], names=["anchor"])


_OCCURS = pa.schema([("anchor", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64()), ("occurrence", pa.int64()),
                     ("doc_id", pa.int64()), ("key", pa.int64()), ("first", pa.int64()), ("last", pa.int64())])


def _number(doc_id, key: int, first: int) -> int:
    return xxhash.xxh3_64_intdigest(f"{doc_id}:{key}:{first}".encode())


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _content(data: bytes) -> tuple[int, int]:
    digest = xxhash.xxh3_128_intdigest(data)
    return _signed(digest >> 64), _signed(digest & ((1 << 64) - 1))


def _occurrences(batches: Iterator[pa.RecordBatch], sieve) -> Iterator[pa.RecordBatch]:
    def rows():
        for doc_id, key, data in _texts(batches):
            place, first, last, hashes = anchors(data)
            for j in np.flatnonzero(_in_sieve(sieve.value, hashes)):
                a, b = int(first[j]), int(last[j])
                inside = int(place[j]) - a
                yield (_signed(int(hashes[j])), *_content(inside.to_bytes(4, "big") + data[a : b + LENGTH]),
                       _signed(_number(doc_id, key, a)), doc_id, key, a, b)

    return _batched(rows(), _OCCURS)


_PIECES = pa.schema([("center", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64()), ("doc_id", pa.int64()), ("key", pa.int64()),
                     ("first", pa.int64()), ("last", pa.int64()), ("inside", pa.int32()), ("context", pa.binary())])


def _piece(data: bytes, doc_id, key, place: int, first: int, last: int, at: int, low: int, high: int) -> tuple | None:
    """Starts of ``first`` to ``last`` whose anchor is ``low`` to ``high`` - 1 bytes in.

    All their windows hold the bytes from ``low`` before the anchor on, which route them.
    ``at`` is where ``data`` begins in its document.
    """
    a, b = max(first, place - high + 1), min(last, place - low)
    if a > b:
        return None
    center = data[place - low - at : place - high + 1 + LENGTH - at]
    context = data[a - at : b + LENGTH - at]
    inside = place - a
    routed = _signed(xxhash.xxh3_64_intdigest(low.to_bytes(4, "big") + high.to_bytes(4, "big") + center))
    return routed, *_content(inside.to_bytes(4, "big") + context), doc_id, key, a, b, inside, context


def _pieces(batches: Iterator[pa.RecordBatch], sieve, wanted) -> Iterator[pa.RecordBatch]:
    def rows():
        for doc_id, key, data in _texts(batches):
            place, first, last, hashes = anchors(data)
            for j in np.flatnonzero(_in_sieve(sieve.value, hashes)):
                a, b, p = int(first[j]), int(last[j]), int(place[j])
                if not _in_sieve(wanted.value, np.array([_number(doc_id, key, a)], np.uint64))[0]:
                    continue
                for low in range(0, LENGTH - ANCHOR + 1, RANGE):
                    piece = _piece(data, doc_id, key, p, a, b, 0, low, low + RANGE)
                    if piece:
                        yield piece

    return _batched(rows(), _PIECES, 5_000)


def _halved(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Pieces of ``size`` starts as two of half as many."""
    def rows():
        for batch in batches:
            for r in batch.to_pylist():
                place = r["first"] + r["inside"]
                low = r["inside"] - (r["last"] - r["first"])  # of the last start
                for start in (low // size * size, low // size * size + size // 2):
                    piece = _piece(r["context"], r["doc_id"], r["key"], place, r["first"], r["last"], r["first"], start, start + size // 2)
                    if piece:
                        yield piece

    return _batched(rows(), _PIECES, 5_000)


_SPANS = pa.schema([("doc_id", pa.int64()), ("key", pa.int64()), ("first", pa.int64()), ("last", pa.int64())])


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edges = np.diff(np.concatenate([[0], flags.astype(np.int8), [0]]))
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1) - 1


def _solve(rows: list[dict]) -> Iterator[tuple]:
    windows = np.concatenate([np.lib.stride_tricks.sliding_window_view(np.frombuffer(r["context"], np.uint8), LENGTH) for r in rows])
    often, at = repeated_windows(windows), 0
    for r in rows:
        n = r["last"] - r["first"] + 1
        for a, b in zip(*_runs(often[at : at + n])):
            yield r["doc_id"], r["key"], r["first"] + int(a), r["first"] + int(b)
        at += n


def _sieved(batches: Iterator[pa.RecordBatch], sieve, column: str, inside: bool = True) -> Iterator[pa.RecordBatch]:
    """Rows whose hash is in the sieve, or isn't."""
    for batch in batches:
        hit = _in_sieve(sieve.value, batch.column(column).to_numpy().view(np.uint64))
        yield batch.filter(pa.array(hit == inside))


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated starts of pieces that arrive sorted by content within ``center``; merges
    hold whole keys, and equal pieces once."""
    def rows():
        held, size = [], 0
        for batch in batches:
            for r in batch.to_pylist():
                if held and all(r[c] == held[-1][c] for c in ("center", "c1", "c2")):
                    continue
                if size >= MERGE_ROWS and r["center"] != held[-1]["center"]:
                    yield from _solve(held)
                    held, size = [], 0
                held.append(r)
                size += r["last"] - r["first"] + 1
        if held:
            yield from _solve(held)

    return _batched(rows(), _SPANS)


# --- The operator ---------------------------------------------------------------------------


def repeated_starts(texts: DataFrame) -> DataFrame:
    """(doc_id, key, first, last): runs of starts whose LENGTH bytes occur elsewhere too.

    ``texts`` has doc_id, key and data (binary).
    """
    spark, context = texts.sparkSession, texts.sparkSession.sparkContext
    hashes = texts.select("data").mapInArrow(_anchor_hashes, "anchor long")
    sieve = context.broadcast(_sieve(hashes.groupBy("anchor").count().where("count > 1"), "anchor"))
    schema = "anchor long, c1 long, c2 long, occurrence long, doc_id long, key long, first long, last long"
    occurs = materialize(texts.mapInArrow(functools.partial(_occurrences, sieve=sieve), schema), "occurrences")
    contexts = materialize(occurs.groupBy("anchor", "c1", "c2").agg(
        F.count(F.lit(1)).alias("n"), F.min("occurrence").alias("occurrence")), "contexts")
    often = materialize(contexts.where("n > 1").select("anchor", "c1", "c2"), "often")
    spans = ["doc_id", "key", "first", "last"]
    found = [occurs.join(often, ["anchor", "c1", "c2"], "left_semi").select(spans)]

    # Anchors with different contexts: the ends of what repeats lie somewhere inside.
    open_anchors = materialize(contexts.groupBy("anchor").agg(F.count(F.lit(1)).alias("m"), F.min("n").alias("n")).where(
        "m > 1 AND n = 1").select("anchor"), "open")
    wanted = context.broadcast(_sieve(contexts.join(open_anchors, "anchor", "left_semi"), "occurrence"))
    narrow = context.broadcast(_sieve(open_anchors, "anchor"))
    schema = "center long, c1 long, c2 long, doc_id long, key long, first long, last long, inside int, context binary"
    pieces, size = texts.mapInArrow(functools.partial(_pieces, sieve=narrow, wanted=wanted), schema), RANGE
    while True:
        pieces = materialize(pieces, "pieces")
        each = materialize(pieces.groupBy("center", "c1", "c2").agg(F.count(F.lit(1)).alias("n")), "each")
        same = materialize(each.where("n > 1").select("center", "c1", "c2"), "same")
        found.append(pieces.join(same, ["center", "c1", "c2"], "left_semi").select(spans))
        keys = materialize(each.groupBy("center").agg(F.count(F.lit(1)).alias("m"), F.min("n").alias("n")).where("m > 1 AND n = 1"), "keys")
        few = keys.where(F.col("m") <= CONTEXTS)
        # Contexts are shuffled once: a sieve tells which may share a middle with others.
        some = context.broadcast(_sieve(few, "center"))
        once = pieces.mapInArrow(functools.partial(_sieved, sieve=some, column="center"), schema)
        found.append(once.repartition("center").sortWithinPartitions("center", "c1", "c2").mapInArrow(
            _merged, "doc_id long, key long, first long, last long"))
        many = materialize(keys.where(F.col("m") > CONTEXTS).select("center"), "many")
        if size == 1 or many.isEmpty():
            break
        hot = pieces.join(many, "center", "left_semi")
        pieces, size = hot.mapInArrow(functools.partial(_halved, size=size), schema), size // 2
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def _cut(batches: Iterator[pa.RecordBatch], keep_text: bool) -> Iterator[pa.RecordBatch]:
    import hashlib

    for batch in batches:
        removed, spans, digests, texts = [], [], [], []
        for data, first, last in zip(*(batch.column(i) for i in (1, 2, 3))):
            data = data.as_py()
            gone = np.zeros(len(data) + 1, np.int32)
            if first.is_valid:
                np.add.at(gone, np.asarray(first.as_py()), 1)
                np.add.at(gone, np.asarray(last.as_py()) + LENGTH, -1)
            flags = np.cumsum(gone[:-1]) > 0
            removed.append(int(flags.sum()))
            spans.append(len(_runs(flags)[0]))
            rest = np.frombuffer(data, np.uint8)[~flags].tobytes() if removed[-1] else data
            digests.append(hashlib.sha256(rest).hexdigest())
            texts.append(rest)
        sizes = pa.array([len(d.as_py()) for d in batch.column(1)], pa.int64())
        columns = [batch.column(0), sizes, pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests, pa.string())]
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        if keep_text:
            columns.append(pa.array(texts, pa.binary()))
            names.append("kept")
        yield pa.RecordBatch.from_arrays(columns, names=names)


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep_text: bool = False) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) per row, and ``kept`` if asked.

    Every byte covered by a string of LENGTH bytes that also starts elsewhere, in any row,
    is removed; strings are judged on the input and don't cross texts. Suffixes that can
    repeat are first brought together: equal windows have equal anchors, so anchors seen
    twice (a broadcast sieve of fixed size holds their hashes) tell which parts of the texts
    can repeat at all. Parts equal as a whole repeat as a whole; of the rest, which holds
    the ends of what repeats, parts that share their middle bytes meet in one task. There
    shards of windows have their transforms built and merged by interleave refinement, and
    the intervals of the merged order are the repeated strings. A middle shared by very
    many different parts is split into narrower ranges until each is bounded.

    Null texts are empty. Rows may repeat and ids may be null or shared: every row is an
    occurrence of its own and is returned. Other columns are ignored; an empty table gives
    no rows.
    """
    data = F.coalesce(F.col(text_column).cast("binary"), F.lit("").cast("binary"))
    texts = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(data).alias("key"), data.alias("data"))
    starts = repeated_starts(texts.where(F.octet_length("data") >= LENGTH))
    spans = materialize(starts.groupBy("doc_id", "key").agg(F.collect_set(F.struct("first", "last")).alias("spans")).select(
        F.col("doc_id").alias("_id"), F.col("key").alias("_key"), "spans"), "spans")
    # Only texts that may lose something meet their spans; the others stay where they are.
    sieve = docs.sparkSession.sparkContext.broadcast(_sieve(spans, "_key"))
    some, rest = (texts.mapInArrow(functools.partial(_sieved, sieve=sieve, column="key", inside=inside), texts.schema) for inside in (True, False))
    none = F.lit(None).cast("array<long>")
    met = some.join(spans, some["doc_id"].eqNullSafe(spans["_id"]) & (some["key"] == spans["_key"]), "left").select(
        "doc_id", "data", F.col("spans.first").alias("first"), F.col("spans.last").alias("last")).unionByName(
        rest.select("doc_id", "data", none.alias("first"), none.alias("last")))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * keep_text
    return met.mapInArrow(functools.partial(_cut, keep_text=keep_text), schema)
