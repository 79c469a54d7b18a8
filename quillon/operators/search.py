"""Exact and filtered cosine search, and search by sign sketches.

The corpus stays where it is. Each task scores its own vectors against all queries with one
matrix product per Arrow batch and keeps only its best ``k`` per query, so neither pairs nor
vectors are shuffled: the only exchange carries ``k`` short rows per query and task. Query
sets above a checked size go through the blocked form instead.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from quillon.session import fresh_path, materialize

SCORE_DIGITS = 9
MAX_BROADCAST_BYTES = 128 << 20
BLOCK_QUERIES = 4096
SCORE_CELLS = 4 << 20
#: Bytes of query vectors that one scan of the corpus serves.
SCAN_BYTES = 16 << 20


@dataclass(frozen=True)
class QuerySet:
    """Queries small enough to travel to every task."""

    ids: list
    vectors: np.ndarray
    id_type: str

    @property
    def units(self) -> np.ndarray:
        return unit_rows(self.vectors)


def unit_rows(matrix: np.ndarray) -> np.ndarray:
    """Rows scaled to unit length; zero rows stay zero."""
    norms = np.sqrt(np.einsum("ij,ij->i", matrix, matrix))[:, None]
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


def list_matrix(column: pa.Array, dim: int) -> np.ndarray:
    """List column of equal lengths as a float64 matrix, without per-row Python objects."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(-1, dim).astype(np.float64)


def small_queries(
    queries: DataFrame, id_column: str, vector_column: str, dim: int,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> QuerySet | None:
    """Fetch the queries if they fit ``max_bytes``, else None. At most one row too many is read."""
    most = max(1, max_bytes // (8 * dim))
    rows = (
        queries.select(id_column, vector_column).where(F.size(vector_column) == dim)
        .limit(most + 1).toArrow()
    )
    return None if rows.num_rows > most else _query_set(rows, queries, id_column, vector_column, dim)


def _fetched(queries: DataFrame, id_column: str, vector_column: str, dim: int) -> QuerySet:
    """One block of queries."""
    rows = queries.where(F.size(vector_column) == dim).toArrow()
    return _query_set(rows, queries, id_column, vector_column, dim)


def _query_set(rows: pa.Table, queries: DataFrame, id_column: str, vector_column: str, dim: int) -> QuerySet:
    rows = rows.sort_by(id_column)
    vectors = list_matrix(rows[vector_column].combine_chunks(), dim)
    id_type = queries.schema[id_column].dataType.simpleString()
    return QuerySet(rows[id_column].to_pylist(), vectors, id_type)


class _Best:
    """Running best ``k`` of each query inside one task: higher score first, then lower id.

    ``floors`` holds each query's k-th best score so far, -inf while it has fewer.
    """

    def __init__(self, n_queries: int, k: int):
        self.k = k
        self.floors = np.full(n_queries, -np.inf)
        self._where, self._scores, self._ids = np.empty(0, np.int64), np.empty(0), None

    def _lowest(self, scores: np.ndarray) -> np.ndarray:
        """Below this no score of a query can be among its best."""
        lowest, few = self.floors.copy(), np.flatnonzero(np.isneginf(self.floors))
        if len(few) and scores.shape[1] > self.k:
            known = scores[few]
            known = np.where(np.isnan(known), -np.inf, known)
            if np.count_nonzero(known > -np.inf) > 4 * self.k * len(few):
                lowest[few] = np.partition(known, -self.k, axis=1)[:, -self.k]
        return lowest

    def add(self, scores: np.ndarray, ids: np.ndarray, digits: int | None = None) -> None:
        """Take in a row of scores per query; -inf and NaN count as none.

        With ``digits`` scores are rounded before they are compared, though only those that
        can matter: all within one unit of the last digit of the k-th stay in.
        """
        slack = 0.0 if digits is None else 10.0**-digits
        lowest = np.maximum(self._lowest(scores) - slack, np.finfo(np.float64).min)
        q, i = np.nonzero(scores >= lowest[:, None])
        found = scores[q, i] if digits is None else np.round(scores[q, i], digits)
        kept = found >= self.floors[q]
        if not kept.any():
            return
        # Everything tied with the k-th score stays in, so ids can break the tie.
        where = np.concatenate([self._where, q[kept]])
        all_scores = np.concatenate([self._scores, found[kept]])
        all_ids = ids[i[kept]] if self._ids is None else np.concatenate([self._ids, ids[i[kept]]])
        order = np.lexsort((all_ids, -all_scores, where))
        place = np.arange(len(order)) - np.searchsorted(where[order], where[order])
        order, place = order[place < self.k], place[place < self.k]
        self._where, self._scores, self._ids = where[order], all_scores[order], all_ids[order]
        last = place == self.k - 1
        self.floors[self._where[last]] = self._scores[last]

    def rows(self) -> tuple[list[int], list, list[float]]:
        return self._where.tolist(), [] if self._ids is None else self._ids.tolist(), self._scores.tolist()


def _id_array(column: pa.Array) -> np.ndarray:
    """Ids as a comparable array: native integers, or strings as objects."""
    return np.asarray(column.to_numpy(zero_copy_only=False))


def _batches(batch: pa.RecordBatch, n_queries: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that its score matrix stays small."""
    step = max(1, SCORE_CELLS // max(1, n_queries))
    for start in range(0, batch.num_rows, step):
        yield batch.slice(start, step)


def _scorer(
    units: np.ndarray, query_ids: list, k: int, out_schema: pa.Schema, read, score,
    digits: int | None = None, block: int = BLOCK_QUERIES,
):
    """mapInArrow body: ``score(units, read(batch))`` gives one row of scores per query.

    A batch is read once and meets the queries ``block`` at a time.
    """
    starts = range(0, len(query_ids), block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [(units[at : at + block], _Best(len(query_ids[at : at + block]), k)) for at in starts]
        for whole in batches if parts else ():
            for batch in _batches(whole, min(block, len(query_ids))):
                stored, ids = read(batch), _id_array(batch.column(0))
                for own, best in parts:
                    best.add(score(own, stored), ids, digits)
        for at, (_, best) in zip(starts, parts):
            where, ids, scores = best.rows()
            columns = [[query_ids[at + q] for q in where], ids, scores]
            arrays = [pa.array(c, t) for c, t in zip(columns, out_schema.types)]
            yield pa.RecordBatch.from_arrays(arrays, schema=out_schema)

    return run


def _arrow_type(spark_type: str) -> pa.DataType:
    known = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    if spark_type not in known:
        raise ValueError(f"search ids must be string, int or bigint, not {spark_type}")
    return known[spark_type]


def _search_schema(query_type: str, id_type: str) -> tuple[str, pa.Schema]:
    ddl = f"query_id {query_type}, id {id_type}, score double"
    fields = [("query_id", _arrow_type(query_type)), ("id", _arrow_type(id_type)), ("score", pa.float64())]
    return ddl, pa.schema(fields)


def _ranked(scored: DataFrame, k: int) -> DataFrame:
    """Best ``k`` per query over all tasks, with their rank."""
    order = [F.col("score").desc(), F.col("id").asc()]
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(*order))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k)


def _broadcast_top_k(
    corpus: DataFrame, id_column: str, vector_column: str, dim: int, queries: QuerySet, k: int,
    block: int = BLOCK_QUERIES,
) -> DataFrame:
    id_type = corpus.schema[id_column].dataType.simpleString()
    ddl, out_schema = _search_schema(queries.id_type, id_type)

    def read(batch):
        return unit_rows(list_matrix(batch.column(1), dim)).T

    body = _scorer(queries.units, queries.ids, k, out_schema, read, np.matmul, SCORE_DIGITS, block)
    fitting = corpus.select(id_column, vector_column).where(F.size(vector_column) == dim)
    return _ranked(fitting.mapInArrow(body, ddl), k)


def _by_blocks(
    queries: DataFrame, query_id: str, query_vector: str, dim: int, block_queries: int, search: Callable[[QuerySet], DataFrame]
) -> DataFrame:
    """Hits of all queries, from searches for one block of them after the other."""
    spark = queries.sparkSession
    # Equal queries count once, so that a repeated one doesn't fill its block.
    asked = materialize(queries.select(query_id, query_vector).distinct(), "queries")
    blocks = max(1, -(-asked.count() // block_queries))
    path = fresh_path(spark, "hits")
    for block in range(blocks):
        part = asked.where(F.pmod(F.xxhash64(query_id), F.lit(blocks)) == block)
        found = search(_fetched(part, query_id, query_vector, dim))
        found.write.mode("overwrite").parquet(f"{path}/block={block}")
    return spark.read.schema(found.schema).parquet(path).select(found.columns)


def blocked_top_k(
    corpus: DataFrame, queries: DataFrame, *, dim: int, k: int, block_queries: int = BLOCK_QUERIES,
    id_column: str = "record_id", vector_column: str = "vector",
    query_id: str = "query_id", query_vector: str = "vector",
) -> DataFrame:
    """The same search for any number of queries.

    A scan of the corpus, which stays where it is, serves as many blocks of ``block_queries``
    as fit ``SCAN_BYTES``; queries are hashed into such scans. A scan's hits are written
    before the next one starts, so the driver holds the queries of one scan at a time, and a
    task scores one block at a time.
    """
    blocks = max(1, SCAN_BYTES // (8 * dim * block_queries))
    return _by_blocks(
        queries, query_id, query_vector, dim, blocks * block_queries,
        lambda held: _broadcast_top_k(corpus, id_column, vector_column, dim, held, k, block_queries))


def cosine_top_k(
    corpus: DataFrame, queries: DataFrame, *, dim: int, k: int = 5,
    id_column: str = "record_id", vector_column: str = "vector",
    query_id: str = "query_id", query_vector: str = "vector",
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """(query_id, id, score, rank): the ``k`` most similar vectors of each query, exactly.

    Runs the query side once to see whether it fits ``max_bytes``. Scores are rounded to
    nine digits before ranking, ties go to the lower id, zero vectors score 0.
    """
    small = small_queries(queries, query_id, query_vector, dim, max_bytes)
    if small is not None:
        return _broadcast_top_k(corpus, id_column, vector_column, dim, small, k)
    return blocked_top_k(
        corpus, queries, dim=dim, k=k, block_queries=max(1, min(BLOCK_QUERIES, max_bytes // (8 * dim))),
        id_column=id_column, vector_column=vector_column, query_id=query_id, query_vector=query_vector,
    )


def self_search(found: DataFrame, threshold: float = 0.99) -> DataFrame:
    """Per query: whether its best hit is itself with a score above ``threshold``."""
    return found.where("rank = 1").select(
        "query_id",
        F.col("id").alias("top_id"),
        "score",
        ((F.col("id") == F.col("query_id")) & (F.col("score") > threshold)).alias("ok"),
    )


# Search by sign sketches.


def _pack_signs(matrix: np.ndarray) -> np.ndarray:
    return np.packbits(matrix > 0, axis=1, bitorder="little")


def _sketch_bytes(column: pa.Array, dim: int) -> np.ndarray:
    """Packed sign bits from the 64-bit words of a sketch column."""
    words = -(-dim // 64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype("<i8")
    return flat.reshape(-1, words).view(np.uint8).reshape(len(column), words * 8)


def _query_bytes(vectors: np.ndarray, dim: int) -> np.ndarray:
    words = -(-dim // 64)
    packed = _pack_signs(vectors)
    return np.pad(packed, ((0, 0), (0, words * 8 - packed.shape[1])))


def hamming_top_k(
    corpus: DataFrame, queries: QuerySet, *, dim: int, k: int,
    id_column: str = "record_id", sketch_column: str = "sketch",
) -> DataFrame:
    """(query_id, id, distance, rank): nearest sketches by differing sign bits.

    Reads ids and sketches only, a 32nd of the vectors' bytes.
    """
    id_type = corpus.schema[id_column].dataType.simpleString()
    ddl, out_schema = _search_schema(queries.id_type, id_type)

    def read(batch):
        return _sketch_bytes(batch.column(1), dim)

    def score(signs, stored):
        return -np.stack([np.bitwise_count(stored ^ q).sum(axis=1) for q in signs]).astype(np.float64)

    body = _scorer(_query_bytes(queries.vectors, dim), queries.ids, k, out_schema, read, score)
    found = _ranked(corpus.select(id_column, sketch_column).mapInArrow(body, ddl), k)
    return found.select("query_id", "id", (-F.col("score")).cast("int").alias("distance"), "rank")


def blocked_hamming_top_k(
    corpus: DataFrame, queries: DataFrame, *, dim: int, k: int, block_queries: int = BLOCK_QUERIES,
    id_column: str = "record_id", sketch_column: str = "sketch", query_id: str = "query_id", query_vector: str = "vector",
) -> DataFrame:
    """``hamming_top_k`` for any number of queries, a block of them at a time."""
    search = functools.partial(hamming_top_k, corpus, dim=dim, k=k, id_column=id_column, sketch_column=sketch_column)
    return _by_blocks(queries, query_id, query_vector, dim, block_queries, lambda held: search(held))
