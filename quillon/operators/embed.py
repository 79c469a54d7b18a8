"""Bulk text embedding with an injected model."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

Embedder = Callable[[Sequence[str]], np.ndarray]
MAX_CACHED_WORDS = 1_000_000


class _Buckets(dict):
    """Bucket of each word, hashed on first use; forgets everything when it grows too large."""

    def __init__(self, dim: int):
        super().__init__()
        self.dim = dim

    def __missing__(self, word: str) -> int:
        if len(self) >= MAX_CACHED_WORDS:
            self.clear()
        self[word] = found = int.from_bytes(hashlib.md5(word.encode()).digest()[:4]) % self.dim
        return found


def hashed_words(dim: int) -> Embedder:
    """Built-in model: counts of lower-cased words, hashed into ``dim`` buckets, unit length."""
    bucket = _Buckets(dim).__getitem__

    def embed(texts: Sequence[str]) -> np.ndarray:
        matrix = np.zeros((len(texts), dim))
        for row, text in enumerate(texts):
            words = text.lower().split()
            buckets = np.fromiter(map(bucket, words), np.int64, len(words))
            matrix[row] = np.bincount(buckets, minlength=dim)
        norms = np.linalg.norm(matrix, axis=1, keepdims=True)
        return np.divide(matrix, norms, out=matrix, where=norms > 0)

    return embed


def embed_texts(
    df: DataFrame, make_embedder: Callable[[], Embedder], dim: int,
    id_column: str = "record_id", text_column: str = "text", batch_rows: int = 256,
    partitions: int | None = None,
) -> DataFrame:
    """(id, vector): every text embedded whole.

    ``partitions`` spreads the texts anew, for tables that come in too few files.

    ``make_embedder`` runs once per task, so a model is loaded where it is used. Null
    texts embed as empty ones.
    """
    id_field = df.schema[id_column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        embedder = make_embedder()
        for whole in batches:
            for start in range(0, whole.num_rows, batch_rows):
                batch = whole.slice(start, batch_rows)
                texts = [t or "" for t in batch.column(1).to_pylist()]
                matrix = np.asarray(embedder(texts), dtype=np.float32).reshape(len(texts), dim)
                offsets = np.arange(0, matrix.size + 1, dim, dtype=np.int32)
                vectors = pa.ListArray.from_arrays(offsets, matrix.ravel())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), vectors], names=[id_column, "vector"]
                )

    schema = T.StructType([id_field, T.StructField("vector", T.ArrayType(T.FloatType()))])
    texts = df.select(id_column, text_column)
    if partitions:
        texts = texts.repartition(partitions, id_column)
    return texts.mapInArrow(run, schema)


REQUEST_SCHEMA = (
    "key string, request struct<output_dimensionality:int,content:struct<parts:array<struct<text:string>>>>"
)


def answer_requests(
    requests: DataFrame, make_embedder: Callable[[], Embedder], dim: int
) -> DataFrame:
    """Result lines (all columns but ``value``, then ``value``) of request lines.

    Stands in for a remote embedding job: the text parts of each request are embedded, and
    a request without text is answered with an error.
    """
    kept = [c for c in requests.columns if c != "value"]
    parsed = requests.withColumn("_r", F.from_json("value", REQUEST_SCHEMA))
    texts = F.array_compact(F.transform("_r.request.content.parts", lambda p: p["text"]))
    asked = parsed.select(
        F.struct(*kept, F.col("_r.key").alias("key"), (F.size(texts) > 0).alias("has_text")).alias("origin"),
        F.array_join(texts, " ").alias("text"),
    )
    answered = embed_texts(asked, make_embedder, dim, id_column="origin")
    response = F.struct(F.struct(F.col("vector").alias("values")).alias("embedding")).alias("response")
    key = F.col("origin.key").alias("key")
    line = F.when(F.col("origin.has_text"), F.to_json(F.struct(key, response))).otherwise(
        F.to_json(F.struct(key, F.lit("no text to embed").alias("error")))
    )
    return answered.select(*[F.col(f"origin.`{c}`").alias(c) for c in kept], line.alias("value"))

