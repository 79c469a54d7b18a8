"""Exact top-k by inner product: a kNN join over Voronoi cells."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from quillon.session import materialize

PIVOTS = 64
#: Queries solved together, and stored vectors a task holds at a time.
QUERY_BLOCK, DATA_BLOCK = 2048, 8192


def integer_vectors(rows: DataFrame, id_column: str, vector_column: str, scale: int) -> DataFrame:
    """(id, v): floor(scale * x) of each component. Null ids and vectors, and vectors with
    null or non-finite components, take no part."""
    x = F.col(vector_column)
    good = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    return rows.where(F.col(id_column).isNotNull() & x.isNotNull()).where(good).select(
        F.col(id_column).cast("long").alias("id"), F.transform(x, lambda c: F.floor(c.cast("double") * scale)).alias("v"))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column, padded with zeros to ``dim``."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if (sizes == dim).all():
        return flat.reshape(len(sizes), dim)
    out = np.zeros((len(sizes), dim), np.int64)
    out[np.arange(dim) < sizes[:, None]] = flat
    return out


def _celled(batches: Iterator[pa.RecordBatch], pivots: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = matrix(batch.column("v"), pivots.shape[1]).astype(np.float64)
        squares = (x * x).sum(axis=1)
        cell = ((pivots * pivots).sum(axis=1) - 2 * (x @ pivots.T)).argmin(axis=1)
        distance = np.linalg.norm(x - pivots[cell], axis=1)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(cell, pa.int32()), pa.array(distance), pa.array(np.sqrt(squares))],
            names=["id", "v", "cell", "distance", "norm"])


def _groups(pivots: np.ndarray, counts: np.ndarray, block: int) -> np.ndarray:
    """Group of each query cell: cells near one another, about ``block`` queries together."""
    group, left, number, size = np.full(len(counts), -1), set(np.flatnonzero(counts)), 0, 0
    at = min(left, default=None)
    while left:
        left.discard(at)
        if size and size + counts[at] > block:
            number, size = number + 1, 0
        group[at], size = number, size + counts[at]
        at = min(left, key=lambda c: (((pivots[c] - pivots[at]) ** 2).sum(), c), default=None)
    return group


def _needed(batches: Iterator[pa.RecordBatch], base, reach, floor, group, parts, blocks: int) -> Iterator[pa.RecordBatch]:
    """Each stored vector once per query group (and part of it) that may need it.

    A query of cell i scores at most base[i, j] + reach[i] * d with a vector at distance d
    from the pivot of its cell j, and its k-th best scores at least floor[i].
    """
    for batch in batches:
        cell, distance = batch.column("cell").to_numpy(), batch.column("distance").to_numpy()
        wanted = base[:, cell] + reach[:, None] * distance >= floor[:, None]
        for g, n in enumerate(parts):
            rows = np.flatnonzero(wanted[group == g].any(axis=0))
            for part in range(n):
                kept = batch.select(["id", "v"]).take(pa.array(rows))
                ids = kept.column("id").to_numpy()
                block = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(blocks)
                yield pa.RecordBatch.from_arrays(
                    [*kept.columns, *(pa.array(np.full(len(rows), c, np.int32)) for c in (g, part)),
                     pa.array(block.astype(np.int32)), pa.array(np.zeros(len(rows), bool))],
                    names=["id", "v", "g", "part", "block", "asks"])


def _saturated(a: np.ndarray, b: np.ndarray) -> int:
    """Inner product in integers of any size, then the nearest one of 64 bits."""
    return min(max(sum(x * y for x, y in zip(a.tolist(), b.tolist())), -(1 << 63)), (1 << 63) - 1)


def _solved(table: pa.Table, dim: int, k: int) -> pa.Table:
    """The k best of one block of vectors for each query that meets it."""
    asks = table["asks"].combine_chunks().to_numpy(zero_copy_only=False)
    ids = table["id"].to_numpy()
    vectors = matrix(pa.concat_arrays(table["v"].chunks) if table["v"].num_chunks else pa.array([], pa.list_(pa.int64())), dim)
    order = np.argsort(ids[~asks], kind="stable")
    data, held = vectors[~asks][order], ids[~asks][order]
    reach = np.linalg.norm(data.astype(np.float64), axis=1)
    asked = np.linalg.norm(vectors[asks].astype(np.float64), axis=1)
    # Partial sums stay below the product of the norms of absolute values, these same norms.
    largest = reach.max(initial=0) * asked.max(initial=0)
    exact = np.float64 if largest < 1 << 52 else np.int64
    wide, data = data, data.astype(exact).T
    out: list[list] = [[], [], []]
    for start in range(0, int(asks.sum()), 256):
        asking = ids[asks][start : start + 256]
        some = vectors[asks][start : start + 256]
        scores = (some.astype(exact) @ data).astype(np.int64)
        # Sums wrap around in 64 bits, which is right in the end where the score fits.
        beyond = np.outer(asked[start : start + 256], reach) >= 2.0**62 if largest >= 2.0**62 else np.zeros((0, 0))
        for q, v in np.argwhere(beyond):
            scores[q, v] = _saturated(some[q], wide[v])
        for query, row in zip(asking, scores):
            other = np.flatnonzero(held != query)
            if len(other) > k:
                least = np.partition(row[other], len(other) - k)[len(other) - k]
                other = other[row[other] >= least]
            best = other[np.argsort(~row[other], kind="stable")[:k]]
            out[0].append(np.full(len(best), query))
            out[1].append(held[best])
            out[2].append(row[best])
    columns = [pa.array(np.concatenate(c) if c else np.empty(0, np.int64), pa.int64()) for c in out]
    return pa.table(columns, names=["query_id", "vec_id", "score"])


def exact_top_k(rows: DataFrame, every: int = 100, k: int = 10, scale: int = 1024, id_column: str = "vec_id",
                vector_column: str = "embedding", pivots: int = PIVOTS) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best partners of each query, ties to lower ids.

    Queries are the rows whose id is divisible by ``every``, candidates all rows of another
    id. Vectors belong to the nearest of a few pivots. Summaries of the cells (radius,
    norms, the k + 1 ids nearest to each pivot) give every query cell a score that its
    k-th best surely reaches and every vector the most it can score there; only vectors
    that may reach it are sent, to blocks of bounded size, which a task solves exactly in
    integers. The k best of each block are ranked again per query.

    Vectors of different length are padded with zeros. Of a repeated query id one vector is
    asked (the least); candidates of one id are rows of their own. Fewer rows than k give
    fewer ranks; no usable vector, no rows. Components and scores beyond 64 bits are the nearest
    64-bit integer. Other columns are ignored.
    """
    data = materialize(integer_vectors(rows, id_column, vector_column, scale), "vectors")
    spark = rows.sparkSession
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    dim, count = data.agg(F.max(F.size("v")), F.count(F.lit(1))).first()
    if not count:
        return empty
    chosen = data.orderBy(F.xxhash64("id"), "id", "v").limit(pivots).collect()  # ``pivots`` rows
    points = np.zeros((len(chosen), dim or 0))
    for i, r in enumerate(chosen):
        points[i, : len(r.v)] = r.v
    celled = materialize(data.mapInArrow(
        functools.partial(_celled, pivots=points), "id long, v array<long>, cell int, distance double, norm double"), "cells")
    queries = celled.where(F.pmod("id", F.lit(every)) == 0)
    asked = queries.groupBy("cell").agg(F.count(F.lit(1)), F.max("distance"), F.max("norm")).collect()
    if not asked:
        return empty
    near = Window.partitionBy("cell").orderBy("distance")
    # One row per id: only one of the counted rows can then be the query's own.
    apart = celled.groupBy("id").agg(F.min(F.struct("distance", "cell")).alias("least")).select("least.cell", "least.distance")
    nearest = apart.withColumn("at", F.row_number().over(near)).where(F.col("at") <= k + 1).collect()

    cells = len(points)
    counts, radius, reach = np.zeros(cells, int), np.zeros(cells), np.zeros(cells)
    for cell, n, r, norm in asked:
        counts[cell], radius[cell], reach[cell] = n, r, norm
    lengths = np.linalg.norm(points, axis=1)
    products = points @ points.T
    floor = np.full(cells, -np.inf)
    if len(nearest) > k:
        cell, distance = np.array([r.cell for r in nearest]), np.array([r.distance for r in nearest])
        least = products[:, cell] - radius[:, None] * lengths[cell] - reach[:, None] * distance
        floor = np.sort(least, axis=1)[:, -(k + 1)]  # one of them may be the query itself
    floor = floor - 1 - 1e-9 * np.abs(np.where(np.isfinite(floor), floor, 0))
    # Rounding of the largest terms, and scores that end at the ends of 64 bits.
    floor -= 1e-12 * (np.abs(products).max(axis=1) + radius * lengths.max() + reach * max((r.distance for r in nearest), default=0))
    floor = np.where(floor <= -(2.0**63), -np.inf, np.minimum(floor, 2.0**63 * (1 - 1e-9)))
    base = products + radius[:, None] * lengths * (1 + 1e-9)
    group = _groups(points, counts, QUERY_BLOCK)
    parts = [int(np.ceil(counts[group == g].sum() / QUERY_BLOCK)) for g in range(group.max() + 1)]
    blocks = int(np.ceil(count / DATA_BLOCK))

    sent = celled.mapInArrow(
        functools.partial(_needed, base=base, reach=reach * (1 + 1e-9), floor=floor, group=group, parts=parts, blocks=blocks),
        "id long, v array<long>, g int, part int, block int, asks boolean")
    of_cell = spark.createDataFrame([(int(c), int(g), parts[g]) for c, g in enumerate(group) if g >= 0], "cell int, g int, parts int")
    once = queries.groupBy("id").agg(F.min(F.struct("v", "cell")).alias("q")).select("id", "q.v", "q.cell")
    asking = once.join(F.broadcast(of_cell), "cell").select(
        "id", "v", "g", F.pmod(F.xxhash64("id"), "parts").cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(True).alias("asks"))
    found = sent.unionByName(asking).groupBy("g", "part", "block").applyInArrow(
        lambda table: _solved(table, dim, k), "query_id long, vec_id long, score long")
    ranked = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
