"""Quality classifier: logistic regression over hashed word n-grams, trained with FTRL."""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from quillon.llm.text import mix, ngram_hashes

BUCKETS = 1 << 18
#: Labelled rows the model is fitted on: all, or about this many picked by a hash of the id.
TRAIN_ROWS = 20_000
#: Rows per learner: learners train apart and their weights are averaged.
LEARNER_ROWS = 5_000
THRESHOLD = 0.3
#: Rows whose features, or whose scored copies, a task holds at a time.
ROWS_AT_ONCE = 256

_SHAPE = bytes(
    ord("A") if 65 <= c <= 90 else ord("0") if 48 <= c <= 57 else ord("a") if 97 <= c <= 122 or c >= 128 else c
    for c in range(256))
_RUNS = re.compile(rb"a+|A+|0+")


def _hashes(data: bytes, salt: int) -> np.ndarray:
    words = data.split()
    return mix(np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words)) + np.uint64(salt))


def features(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and weights of a text: words and pairs of words; of word shapes; of repeats.

    A shape has runs of small letters, capitals and digits as one sign each; a repeat tells
    whether a word equals the one before or the one before that. Weights are log(1 + count),
    scaled to unit length. No words, no features.
    """
    data = text or b""
    words, shapes = _hashes(data, 1), _hashes(_RUNS.sub(lambda m: m[0][:1], data.translate(_SHAPE)), 2)
    again = np.zeros(len(words), np.uint64)
    again[2:] = words[2:] == words[:-2]
    again[1:] += np.uint64(2) * (words[1:] == words[:-1]).astype(np.uint64)
    grams = []
    for stream in (words, shapes, mix(again + np.uint64(3))):
        grams += [stream, ngram_hashes(stream, 2)]
    buckets, counts = np.unique(np.concatenate(grams) >> np.uint64(64 - 18), return_counts=True)
    values = np.log1p(counts)
    return buckets.astype(np.int32), (values / (np.linalg.norm(values) or 1.0)).astype(np.float32)


class Ftrl:
    """Follow the regularised leader, per coordinate; the last coordinate is the bias."""

    def __init__(self, alpha: float = 4.0, beta: float = 1.0, l1: float = 0.005, l2: float = 0.05):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)

    def weights(self, at) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def learn(self, buckets: np.ndarray, values: np.ndarray, label: int) -> None:
        at, x = np.append(buckets, BUCKETS), np.append(values, 1.0)
        w = self.weights(at)
        gradient = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x
        grown = self.n[at] + gradient * gradient
        self.z[at] += gradient - (np.sqrt(grown) - np.sqrt(self.n[at])) / self.alpha * w
        self.n[at] = grown


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield batch.slice(start, ROWS_AT_ONCE)


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches):
        pairs = [features(t.as_py()) for t in batch.column("text")]
        yield pa.RecordBatch.from_arrays(
            [batch.column("learner"), batch.column("place"), batch.column("label"),
             pa.array([p[0] for p in pairs], pa.list_(pa.int32())), pa.array([p[1] for p in pairs], pa.list_(pa.float32()))],
            names=["learner", "place", "label", "buckets", "vals"])


def _trained(table: pa.Table, epochs: int) -> pa.Table:
    # Rows are read in their order from where they are: features aren't copied to sort them.
    order = pc.sort_indices(table.select(["place", "label"]), [("place", "ascending"), ("label", "ascending")]).to_pylist()
    model = Ftrl()
    labels, columns = table["label"].to_pylist(), (table["buckets"], table["vals"])
    rows = [(*(c[i].values.to_numpy() for c in columns), labels[i]) for i in order]
    for _ in range(epochs):
        for buckets, values, label in rows:
            model.learn(buckets, values, label)
    weights = model.weights(slice(None)).astype(np.float32)
    return pa.table({"learner": table["learner"].slice(0, 1).cast(pa.int32()), "weights": pa.array([weights.tobytes()], pa.binary())})


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS, epochs: int = 5,
        id_column: str = "doc_id", label_column: str = "quality") -> np.ndarray:
    """Weights (BUCKETS and a bias) learnt from the labelled documents that aren't held out.

    Held out are rows with crc32 of the id as text divisible by 5. Of the others at most
    about ``train_rows`` are taken, by a hash of the id; they are dealt to learners of
    LEARNER_ROWS that train apart, in a hashed order, and their weights are averaged. An id
    counts once: of several labels or texts the least is taken. Null ids, labels and texts
    are left out; without any row the weights are 0 (score 0.5).
    """
    known = labels.where(f"{id_column} IS NOT NULL AND {label_column} IS NOT NULL").select(
        F.col(id_column).cast("long").alias("_id"), F.col(label_column).cast("int").alias("label"))
    known = known.groupBy("_id").agg(F.min("label").alias("label"))
    known = known.where(F.crc32(F.col("_id").cast("string").cast("binary")) % 5 != 0)
    count = known.count()
    share = min(1.0, train_rows / max(1, count))
    learners = max(1, -(-min(count, train_rows) // LEARNER_ROWS))
    picked = known.where(F.pmod(F.xxhash64("_id", F.lit("sample")), F.lit(1 << 20)) < int(share * (1 << 20)))
    # Bounded by ``train_rows``, whatever the number of labels.
    texts = docs.where("text IS NOT NULL").select(F.col(id_column).cast("long").alias("_doc"), "text")
    # One row per id, so that a learner stays within its rows however often an id repeats.
    met = texts.join(F.broadcast(picked), F.col("_doc") == F.col("_id")).groupBy("_id").agg(
        F.min("label").alias("label"), F.min("text").alias("text"))
    rows = met.select(
        F.pmod(F.xxhash64("_id", F.lit("learner")), F.lit(learners)).cast("int").alias("learner"),
        F.xxhash64("_id", F.lit("place")).alias("place"), "label", F.col("text").cast("binary").alias("text"))
    sample = rows.mapInArrow(_featured, "learner int, place long, label int, buckets array<int>, vals array<float>")
    models = sample.groupBy("learner").applyInArrow(
        lambda table: _trained(table, epochs), "learner int, weights binary").collect()
    if not models:
        return np.zeros(BUCKETS + 1, np.float32)
    return np.mean([np.frombuffer(m.weights, np.float32) for m in sorted(models)], axis=0, dtype=np.float64).astype(np.float32)


def _scored(batches: Iterator[pa.RecordBatch], weights: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in _slices(batches):
        scores = np.empty(batch.num_rows)
        for i, text in enumerate(batch.column(batch.num_columns - 1)):
            buckets, values = features(text.as_py())
            scores[i] = values @ weights[buckets] + weights[-1]
        scores = 1 / (1 + np.exp(-np.clip(scores, -35, 35)))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(scores)], names=[*batch.schema.names[:-1], "score"])


def score(docs: DataFrame, weights: np.ndarray, threshold: float = THRESHOLD) -> DataFrame:
    """(row, score, predicted): each row, as a struct, with its score from the text alone.

    A null or empty text scores by the bias; an empty table gives no rows.
    """
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), F.col("text").cast("binary").alias("_text"))
    schema = rows.select("row", F.lit(0.0).alias("score")).schema
    scored = rows.mapInArrow(functools.partial(_scored, weights=weights), schema)
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def quality(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row; a null id is not held out."""
    scored = score(docs.select("doc_id", "text"), fit(docs, labels, **options))
    held = F.coalesce(F.crc32(F.col("row.doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    return scored.select("row.doc_id", held.alias("held_out"), "score", "predicted")
