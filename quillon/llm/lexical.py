"""Reversed lexical search: documents stream through an inverted index over the queries."""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from quillon.session import fresh_path, materialize

TOP = 10
#: Bytes of query texts whose index travels at a time; more items are searched in more blocks.
BLOCK_BYTES = 8 << 20
#: Heaps of this many tasks are merged before an item's heaps meet.
FAN_IN = 64
#: Cells (documents times items) scored at a time in a task.
CELLS = 1 << 20

#: Letters, digits and all beyond ASCII stay, capitals as small letters; the rest separates.
_TERMS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms(data: bytes | None) -> list[bytes]:
    """Terms of a text in order, repeats included."""
    return (data or b"").translate(_TERMS).split()


def _counts(batches: Iterator[pa.RecordBatch], known: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    """Number of terms of each document that has one, and how often it holds the known ones."""
    for batch in batches:
        ids, sizes, lists, counts, offsets = [], [], [], [], [0]
        for i, text in enumerate(batch.column(1)):
            words = terms(text.as_py())
            if not words:
                continue
            found = np.fromiter((known.get(w, -1) for w in words), np.int32, len(words))
            at, n = np.unique(found[found >= 0], return_counts=True)
            ids.append(i), sizes.append(len(words)), lists.append(at), counts.append(n)
            offsets.append(offsets[-1] + len(at))
        flat = lambda parts, kind: np.concatenate(parts).astype(kind) if parts else np.empty(0, kind)
        of = pa.array(offsets, pa.int32())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(ids, pa.int32())), pa.array(sizes, pa.int64()),
             pa.ListArray.from_arrays(of, pa.array(flat(lists, np.int32))), pa.ListArray.from_arrays(of, pa.array(flat(counts, np.int64)))],
            names=["doc_id", "n", "terms", "tfs"])


@dataclass(frozen=True)
class Index:
    """Items, and for each of their terms the items that hold it and how often."""

    items: int
    known: dict[bytes, int]
    postings: list[tuple[np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, texts: list[bytes | None]) -> Index:
        known: dict[bytes, int] = {}
        held: list[dict[int, int]] = []
        for i, text in enumerate(texts):
            for word in terms(text):
                t = known.setdefault(word, len(known))
                if t == len(held):
                    held.append({})
                held[t][i] = held[t].get(i, 0) + 1
        return cls(len(texts), known, [
            (np.fromiter(h, np.int64, len(h)), np.fromiter(h.values(), np.int64, len(h))) for h in held])


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class _Heaps:
    """Best ``k`` documents of each item so far: higher score first, then the smaller id."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.floor = np.zeros(items, np.int64)
        self.ids = [np.empty(0, np.int64)] * items
        self.scores = [np.empty(0, np.int64)] * items

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        """``scores`` has a row per item and a column per document; scores of 0 don't count."""
        hit = (scores >= self.floor[:, None]) & (scores > 0)
        for item in np.flatnonzero(hit.any(axis=1)):
            new = np.flatnonzero(hit[item])
            row = scores[item, new]
            if len(new) > self.k:  # what ties with the k-th stays, so that ids decide
                new = new[row >= np.partition(row, len(row) - self.k)[len(row) - self.k]]
            all_ids = np.concatenate([self.ids[item], ids[new]])
            all_scores = np.concatenate([self.scores[item], scores[item, new]])
            best = np.lexsort((all_ids, -all_scores))[: self.k]
            self.ids[item], self.scores[item] = all_ids[best], all_scores[best]
            if len(best) == self.k:
                self.floor[item] = all_scores[best[-1]]


_NO_ID = np.iinfo(np.int64).max


def _streamed(batches: Iterator[pa.RecordBatch], index: Index, weights: np.ndarray, n_docs: int, total: int, k: int) -> Iterator[pa.RecordBatch]:
    """The task's heaps, after all its documents went through the index."""
    heaps = _Heaps(index.items, k)
    step = max(1, CELLS // max(1, index.items))
    for whole in batches:
        for start in range(0, whole.num_rows, step):
            batch = whole.slice(start, step)
            ids = batch.column(0).fill_null(_NO_ID).to_numpy(zero_copy_only=False)
            # Python's integers: a product of three counts may pass 64 bits.
            m = np.array([100 - 75 + 75 * n * n_docs // total for n in batch.column(1).to_pylist()], np.int64)
            lists = batch.column(2)
            at = lists.flatten().to_numpy(zero_copy_only=False)
            tf = batch.column(3).flatten().to_numpy(zero_copy_only=False)
            doc = np.repeat(np.arange(len(ids)), lists.value_lengths().to_numpy(zero_copy_only=False))
            gain = weights[at] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
            order = np.argsort(at, kind="stable")
            at, doc, gain = at[order], doc[order], gain[order]
            starts = np.flatnonzero(np.diff(at, prepend=-1))
            scores = np.zeros((index.items, len(ids)), np.int64)
            for a, b in zip(starts, [*starts[1:], len(at)]):
                items, often = index.postings[at[a]]
                scores[np.ix_(items, doc[a:b])] += often[:, None] * gain[a:b]
            heaps.add(ids, scores)
    lengths = [len(x) for x in heaps.ids]
    if sum(lengths):
        found = np.concatenate(heaps.ids)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(index.items, dtype=np.int32), lengths)), pa.array(found, mask=found == _NO_ID),
             pa.array(np.concatenate(heaps.scores)), pa.array(np.full(len(found), TaskContext.get().partitionId(), np.int32))],
            names=["place", "doc_id", "score", "task"])


def _merged(heaps: DataFrame, k: int, *by: str) -> DataFrame:
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    return heaps.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("rank") <= k)


def _block(counted: DataFrame, index: Index, n_docs: int, total: int, k: int) -> DataFrame:
    """(place, doc_id, score, rank) for the items of one block."""
    seen = counted.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("df"))
    weights = np.zeros(len(index.known), np.int64)
    for r in seen.collect():  # one row per term of the block
        weights[r.t] = weight(n_docs, r.df)
    body = functools.partial(_streamed, index=index, weights=weights, n_docs=n_docs, total=total, k=k)
    heaps = counted.mapInArrow(body, "place int, doc_id long, score long, task int")
    nearer = _merged(heaps.withColumn("task", (F.col("task") / FAN_IN).cast("int")), k, "place", "task")
    return _merged(nearer.select("place", "doc_id", "score"), k, "place")


def ranked_search(
    docs: DataFrame, items: DataFrame, k: int = TOP, block_bytes: int = BLOCK_BYTES,
    id_column: str = "doc_id", text_column: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of every item.

    The inverted index over the items' terms is what travels, in blocks of about
    ``block_bytes`` of item texts (an item is never cut). Documents are read once per block: a first pass writes how often each holds the block's terms, which gives
    the collection's counts; a second streams these counts through the index and keeps one
    bounded heap per item and task. Heaps of 64 tasks are merged before those of an item
    meet, so one task reads at most ``k`` rows per item and 64 tasks. No pair is shuffled.

    Scores are integers: a term of weight w = floor(1000 ln((2N+2)/(2df+1))) gives, for tf
    occurrences in a document of n terms, w * (10^9 tf div (1000 tf + 8 m)) with m = 25 +
    75 n N div L, for each time the item holds it. Equal scores go to the smaller id, a
    null id last. Documents that score 0 aren't listed.

    Null texts have no terms; documents without any are not counted in N. Rows with equal
    ids are documents of their own. Item rows with the same id and text count once; other
    texts of that id, and null ids, are items of their own, ranked apart. Other columns are
    ignored. Empty documents, items or texts give no rows.
    """
    spark = docs.sparkSession
    wanted = items.select(F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{item_text}`").cast("binary").alias("text"))
    wanted = materialize(wanted.where(F.length("text") > 0).distinct(), "items")
    parts = -(-(wanted.agg(F.sum(F.length("text"))).first()[0] or 0) // block_bytes)
    texts = docs.select(F.col(f"`{id_column}`").cast("long").alias("doc_id"), F.col(f"`{text_column}`").cast("binary").alias("text"))
    path = fresh_path(spark, "ranked")
    kind = wanted.schema["item_id"].dataType.simpleString()
    for part in range(max(1, parts)):
        # A hashed share of the items: about ``block_bytes`` of text.
        block = wanted.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(max(1, parts))) == part).collect()
        index = Index.of([r.text for r in block])
        counted = texts.mapInArrow(functools.partial(_counts, known=index.known), "doc_id long, n long, terms array<int>, tfs array<long>")
        counted = materialize(counted, "counted")
        n_docs, total = counted.agg(F.count(F.lit(1)), F.sum("n")).first()
        names = spark.createDataFrame([(i, r.item_id) for i, r in enumerate(block)], f"place int, item_id {kind}")
        _block(counted, index, n_docs, total or 1, k).join(names, "place").select(
            "item_id", "rank", "doc_id", "score").write.parquet(f"{path}/block={part}")
    return spark.read.schema(f"item_id {kind}, rank int, doc_id long, score long").parquet(path).select("item_id", "rank", "doc_id", "score")
