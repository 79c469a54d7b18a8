"""Search where every query has its own filter: only admitted pairs are scored."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quillon.operators.search import (
    BLOCK_QUERIES, SCORE_DIGITS, QuerySet, _batches, _Best, _by_blocks, _id_array, _ranked, _search_schema, list_matrix, unit_rows,
)
from quillon.operators.textindex import TermMatches
from quillon.session import materialize


def _scored(batches: Iterator[pa.RecordBatch], queries: QuerySet, dim: int, k: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Best ``k`` per query of a task; each row names the queries that admit it."""
    units, best = queries.units, _Best(len(queries.ids), k)
    for whole in batches:
        for batch in _batches(whole, len(queries.ids)):
            asked = batch.column(2).flatten().to_numpy()
            row = np.repeat(np.arange(batch.num_rows), batch.column(2).value_lengths().to_numpy())
            vectors = unit_rows(list_matrix(batch.column(1), dim))
            scores = np.full((len(queries.ids), batch.num_rows), -np.inf)
            scores[asked, row] = np.round(np.einsum("ij,ij->i", units[asked], vectors[row]), SCORE_DIGITS)
            best.add(scores, _id_array(batch.column(0)))
    found = [hit for hit in zip(*best.rows()) if hit[2] > -np.inf]
    columns = [[queries.ids[q] for q, _, _ in found], [i for _, i, _ in found], [s for _, _, s in found]]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)


class _Needs:
    """Which rows hold all terms of a query; ``terms`` has those of each query."""

    def __init__(self, terms: list[np.ndarray]):
        self.used, places = np.unique(np.concatenate([np.empty(0, np.int64), *terms]), return_inverse=True)
        lengths = np.array([len(t) for t in terms], np.int64)
        at = np.cumsum(lengths) - lengths
        #: Queries with more than n terms, and where the n-th one of each is in ``used``.
        self.turns = [(own, places[at[own] + n]) for n in range(max(lengths, default=0)) for own in [np.flatnonzero(lengths > n)]]
        self.asking = lengths > 0

    def met(self, column: pa.Array) -> np.ndarray:
        """(query, row): whether the row's terms hold all the query's."""
        terms, row = column.flatten().to_numpy(), np.repeat(np.arange(len(column)), column.value_lengths().to_numpy())
        held = np.zeros((len(self.used), len(column)), bool)
        if len(self.used):
            place = np.minimum(np.searchsorted(self.used, terms), len(self.used) - 1)
            known = self.used[place] == terms
            held[place[known], row[known]] = True
        met = np.repeat(self.asking[:, None], len(column), axis=1)
        for own, term in self.turns:
            met[own] &= held[term]
        return met


def _met(batches: Iterator[pa.RecordBatch], queries: QuerySet, terms: list[np.ndarray], dim: int, k: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Best ``k`` per query of a task among the rows that hold all its terms."""
    units, best, needs = queries.units, _Best(len(queries.ids), k), _Needs(terms)
    for whole in batches if queries.ids else ():
        for batch in _batches(whole, max(len(queries.ids), len(needs.used))):
            scores = units @ unit_rows(list_matrix(batch.column(1), dim)).T
            scores[~needs.met(batch.column(2))] = -np.inf
            best.add(scores, _id_array(batch.column(0)), SCORE_DIGITS)
    where, ids, scores = best.rows()
    columns = [[queries.ids[q] for q in where], ids, scores]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)


def admitted_top_k(
    corpus: DataFrame, queries: DataFrame, pairs: DataFrame | TermMatches, *, dim: int, k: int = 5, block_queries: int = BLOCK_QUERIES,
    id_column: str = "record_id", vector_column: str = "vector", query_id: str = "query_id", query_vector: str = "vector",
) -> DataFrame:
    """(query_id, id, score, rank): the ``k`` most similar vectors among those a query admits.

    ``pairs`` (query_id, id) come from a filter, as ``text_matches`` or ``geo_circles`` give
    them; repeated ones count once. Pairs of a block of queries are gathered by id before they
    meet the vectors, so that a vector is joined once however many queries admit it. Queries
    that admit nothing have no rows; scores and ties are those of ``cosine_top_k``.

    ``TermMatches`` in place of pairs meet the vectors once, for all queries, and are written
    beside them; each block of queries then reads that table and settles the matches where
    it scores, so that no pair is ever sent or stored.
    """
    spark = corpus.sparkSession
    fitting = corpus.select(F.col(id_column).alias("id"), F.col(vector_column).alias("vector")).where(F.size("vector") == dim)
    id_type = fitting.schema["id"].dataType.simpleString()

    def search(held: QuerySet) -> DataFrame:
        ddl, schema = _search_schema(held.id_type, id_type)
        numbers = spark.createDataFrame(list(zip(held.ids, range(len(held.ids)))), f"query_id {held.id_type}, number int")
        # Numbers of one block, so at most ``block_queries`` rows travel and as many meet an id.
        met = pairs.select("query_id", "id").join(F.broadcast(numbers), "query_id")
        admitted = met.groupBy("id").agg(F.collect_set("number").alias("asked"))
        rows = fitting.join(admitted, "id").select("id", "vector", "asked")
        return _ranked(rows.mapInArrow(functools.partial(_scored, queries=held, dim=dim, k=k, schema=schema), ddl), k)

    def search_terms(held: QuerySet) -> DataFrame:
        ddl, schema = _search_schema(held.id_type, id_type)
        numbers = spark.createDataFrame(list(zip(held.ids, range(len(held.ids)))), f"filter_id {held.id_type}, number int")
        terms = [np.empty(0, np.int64)] * len(held.ids)
        for row in pairs.needed.join(F.broadcast(numbers), "filter_id").collect():
            terms[row.number] = np.array(row.terms, np.int64)
        return _ranked(rows.mapInArrow(functools.partial(_met, queries=held, terms=terms, dim=dim, k=k, schema=schema), ddl), k)

    if isinstance(pairs, TermMatches):
        rows = materialize(fitting.join(pairs.held.hint("merge"), "id").select("id", "vector", "terms"), "admitted")
        return _by_blocks(queries, query_id, query_vector, dim, block_queries, search_terms)
    return _by_blocks(queries, query_id, query_vector, dim, block_queries, search)
