"""Cosine search through a band index over sign sketches, with a radius that grows per query.

A vector's code is the signs of a seeded random rotation. Codes are cut into bands of 16
bits and stored by (band, key). A query probes the keys that differ from its own in 0, then
1, then more bits of a band: codes within ``bands * (r + 1) - 1`` bits then have been met,
as one of their bands differs in at most ``r``. Its radius is enough when vectors further
away can't (exact mode), or with a stated probability don't (recall mode), reach its k-th
best score. Queries whose radius would open too much of the index are answered by one scan
that scores only what lies within their radius.
"""

from __future__ import annotations

import functools
import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quillon.operators.search import (
    SCORE_CELLS, SCORE_DIGITS, QuerySet, _arrow_type, _Best, _fetched, _id_array, _ranked, _search_schema, list_matrix, unit_rows,
)
from quillon.session import fresh_path, materialize

BAND_BITS = 16
#: Rows of a band that a folder should hold; folders are split by up to 8 leading key bits.
FOLDER_ROWS = 4_000_000
MAX_PREFIX_BITS = 8
CODE_BITS = 256
SEED = 42
BLOCK_QUERIES = 1024
#: Bits of a band that probes may differ in, and candidates a query may meet in the index.
MAX_PROBE_BITS = 2
MAX_CANDIDATES = 2_000
#: Candidate pairs that may travel to the vectors (about 24 bytes each).
BROADCAST_PAIRS = 1_000_000
RECALL = 0.95
_EPSILON = 1e-8


@dataclass(frozen=True)
class SketchIndex:
    """A corpus with its codes, and its ids by (band, key), both written."""

    vectors: DataFrame
    entries: DataFrame
    dim: int
    bits: int
    id_type: str
    prefix_bits: int

    @property
    def bands(self) -> int:
        return -(-self.bits // BAND_BITS)


def rotation(dim: int, bits: int) -> np.ndarray:
    """Orthonormal directions, the same in every task."""
    return np.linalg.qr(np.random.default_rng(SEED).normal(size=(dim, bits)))[0]


def codes(units: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """Sign bits, packed: one row of bytes per vector, whole bands."""
    signs = units @ turn > 0
    signs = np.pad(signs, ((0, 0), (0, -signs.shape[1] % BAND_BITS)))
    return np.packbits(signs, axis=1)


def _keys(packed: np.ndarray) -> np.ndarray:
    """Band keys of packed codes, highest bit first."""
    return np.ascontiguousarray(packed).view(">u2").astype(np.int32)


def _coded(batches: Iterator[pa.RecordBatch], dim: int, bits: int) -> Iterator[pa.RecordBatch]:
    turn = rotation(dim, bits)
    for batch in batches:
        keys = _keys(codes(unit_rows(list_matrix(batch.column(1), dim)), turn))
        offsets = pa.array(np.arange(0, keys.size + 1, keys.shape[1], dtype=np.int32))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.ListArray.from_arrays(offsets, pa.array(keys.ravel()))], names=["id", "vector", "keys"])


def build_index(corpus: DataFrame, dim: int, *, id_column: str = "record_id", vector_column: str = "vector", bits: int | None = None) -> SketchIndex:
    """Write codes and band entries of every vector of ``dim`` components.

    Entries lie in folders of (band, leading bits of the key), so that a probe opens the
    folders it can hit; there are more folders the more vectors there are. They are ranged by (band, key, id): a key that very many vectors
    share is spread over tasks and files. Vectors of another size, and those with a null
    id, are left out.
    """
    bits = min(dim, bits or CODE_BITS)
    id_type = corpus.schema[id_column].dataType.simpleString()
    _arrow_type(id_type)
    fitting = corpus.select(F.col(id_column).alias("id"), F.col(vector_column).cast("array<float>").alias("vector"))
    fitting = fitting.where((F.size("vector") == dim) & F.col("id").isNotNull())
    coded = materialize(fitting.mapInArrow(functools.partial(_coded, dim=dim, bits=bits), f"id {id_type}, vector array<float>, keys array<int>"), "coded")
    entries = coded.select("id", F.posexplode("keys").alias("band", "key"))
    prefix_bits = min(MAX_PREFIX_BITS, (coded.count() // FOLDER_ROWS).bit_length())
    entries = entries.withColumn("prefix", F.shiftright("key", BAND_BITS - prefix_bits))
    spark, path = corpus.sparkSession, fresh_path(corpus.sparkSession, "bands")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    entries.repartitionByRange(parts, "band", "key", "id").write.partitionBy("band", "prefix").parquet(path)
    stored = spark.read.schema(f"id {id_type}, key int, band int, prefix int").parquet(path)
    return SketchIndex(coded, stored, dim, bits, id_type, prefix_bits)


def radius_within(score: float, bits: int, recall: float) -> int:
    """Least radius that holds a vector of at least this cosine with probability ``recall``.

    Signs of a random direction differ with probability angle / pi.
    """
    p = math.acos(max(-1.0, min(1.0, score))) / math.pi
    total = 0.0
    for r in range(bits + 1):
        total += math.comb(bits, r) * p**r * (1 - p) ** (bits - r)
        if total >= recall:
            return r
    return bits


def radius_beyond(score: float, turned: np.ndarray) -> int:
    """Least radius beyond which no unit vector reaches ``score``.

    Where signs differ a product isn't positive, so with ``r + 1`` differing signs the
    cosine is at most the length of the query without its ``r + 1`` least components.
    """
    lost = np.cumsum(np.sort(turned * turned))
    bound = np.sqrt(np.maximum(0.0, 1.0 - lost)) + _EPSILON
    return int(np.searchsorted(-bound, -score, side="right"))


class _Radii:
    """Radius each query needs for its k-th best score so far; all bits while that is unknown."""

    def __init__(self, units: np.ndarray, bits: int, recall: float | None):
        self.bits, self.recall = bits, recall
        self.turned = units @ rotation(units.shape[1], bits)

    def of(self, query: int, floor: float) -> int:
        if not np.isfinite(floor):
            return self.bits
        if self.recall is None:
            return min(self.bits, radius_beyond(floor, self.turned[query]))
        return radius_within(floor, self.bits, self.recall)


def _flips(width: int, n: int) -> np.ndarray:
    """All masks of ``n`` bits of a band."""
    return np.array([sum(1 << i for i in c) for c in itertools.combinations(range(width), n)], np.int64)


def _probes(index: SketchIndex, keys: np.ndarray, asking: list[int], n: int) -> DataFrame:
    """(query, band, prefix, key): keys that differ from the query's in exactly ``n`` bits."""
    flips, rows = _flips(BAND_BITS, n), []
    for q in asking:
        for band, key in enumerate(keys[q]):
            rows += [(q, band, int(k) >> (BAND_BITS - index.prefix_bits), int(k)) for k in int(key) ^ flips]
    return index.entries.sparkSession.createDataFrame(rows, "query int, p_band int, p_prefix int, p_key int")


def _met(index: SketchIndex, probes: DataFrame) -> DataFrame:
    """(query, id) of the entries under the probed keys; only folders that hold some are opened."""
    folders = [r[0] * 1000 + r[1] for r in probes.select("p_band", "p_prefix").distinct().collect()]  # bands * 256 at most
    near = index.entries.where((F.col("band") * 1000 + F.col("prefix")).isin(folders))
    same = (F.col("band") == F.col("p_band")) & (F.col("key") == F.col("p_key"))
    # Bounded by the block's queries, the bands and the flips.
    return near.join(F.broadcast(probes), same).select("query", "id")


def _scored_pairs(batches: Iterator[pa.RecordBatch], units: np.ndarray, dim: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        asked = units[batch.column(0).to_numpy()]
        scores = np.einsum("ij,ij->i", asked, unit_rows(list_matrix(batch.column(2), dim)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(np.round(scores, SCORE_DIGITS))], names=["query_id", "id", "score"])


def _rescored(index: SketchIndex, pairs: DataFrame, units: np.ndarray, k: int) -> DataFrame:
    """Best ``k`` per query of the candidate pairs; pairs travel, vectors don't."""
    near = F.broadcast(pairs) if pairs.count() <= BROADCAST_PAIRS else pairs
    rows = index.vectors.join(near, "id").select("query", "id", "vector")
    found = rows.mapInArrow(functools.partial(_scored_pairs, units=units, dim=index.dim), f"query_id int, id {index.id_type}, score double")
    return _ranked(found, k)


def _scan(batches: Iterator[pa.RecordBatch], queries: QuerySet, floors: np.ndarray, dim: int, bits: int, k: int,
          recall: float | None, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Best ``k`` per query of a task, scoring what lies within the query's radius only."""
    units, turn = queries.units, rotation(dim, bits)
    radii, best = _Radii(units, bits, recall), _Best(len(queries.ids), k)
    asked = codes(units, turn)
    step = max(1, SCORE_CELLS // max(1, len(queries.ids)))
    for whole in batches:
        for start in range(0, whole.num_rows, step):
            batch = whole.slice(start, step)
            stored = batch.column(2).flatten().to_numpy(zero_copy_only=False).astype(">u2").view(np.uint8).reshape(batch.num_rows, -1)
            vectors, ids = unit_rows(list_matrix(batch.column(1), dim)), _id_array(batch.column(0))
            scores = np.full((len(queries.ids), batch.num_rows), -np.inf)
            for q in range(len(queries.ids)):
                radius = radii.of(q, max(best.floors[q], floors[q]))
                near = np.flatnonzero(np.bitwise_count(stored ^ asked[q]).sum(axis=1, dtype=np.int64) <= radius)
                scores[q, near] = np.round(vectors[near] @ units[q], SCORE_DIGITS)
            best.add(scores, ids)
    where, ids, scores = best.rows()
    real = [i for i, s in enumerate(scores) if s > -np.inf]
    columns = [[queries.ids[where[i]] for i in real], [ids[i] for i in real], [scores[i] for i in real]]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)


def _searched(index: SketchIndex, queries: QuerySet, k: int, recall: float | None) -> DataFrame:
    """(query_id, id, score, rank) for one block of queries."""
    spark = index.vectors.sparkSession
    ddl, schema = _search_schema(queries.id_type, index.id_type)
    units, radii = queries.units, _Radii(queries.units, index.bits, recall)
    keys = _keys(codes(units, rotation(index.dim, index.bits)))
    floors, asking = np.full(len(queries.ids), -np.inf), list(range(len(queries.ids)))
    done: list[int] = []
    met: DataFrame | None = None
    hits = None
    for n in range(MAX_PROBE_BITS + 1):
        if not asking:
            break
        new = materialize(_met(index, _probes(index, keys, asking, n)), "met")
        met = new if met is None else met.unionByName(new)
        counts = {r["query"]: r["n"] for r in met.groupBy("query").agg(F.count(F.lit(1)).alias("n")).collect()}
        # Keys that too many vectors share are left to the scan, with all their vectors.
        asking = [q for q in asking if counts.get(q, 0) <= MAX_CANDIDATES]
        kept = spark.createDataFrame([(q,) for q in asking + done], "query int")
        pairs = materialize(met.join(F.broadcast(kept), "query").distinct(), "pairs")
        hits = materialize(_rescored(index, pairs, units, k), "hits")
        for r in hits.where(F.col("rank") == k).collect():
            floors[r.query_id] = max(floors[r.query_id], r.score)
        reached = index.bands * (n + 1) - 1
        finished = [q for q in asking if radii.of(q, floors[q]) <= reached]
        done, asking = done + finished, [q for q in asking if q not in set(finished)]
        # With ``n`` bits more in each band no radius of these can be reached: scan them.
        if all(radii.of(q, floors[q]) > index.bands * (MAX_PROBE_BITS + 1) - 1 for q in asking):
            break
    names = spark.createDataFrame([(q, queries.ids[q]) for q in done], f"query int, name {queries.id_type}")
    found = hits.join(F.broadcast(names), F.col("query_id") == F.col("query")).select(
        F.col("name").alias("query_id"), "id", "score", F.col("rank").cast("int").alias("rank"))
    rest = [q for q in range(len(queries.ids)) if q not in set(done)]
    if not rest:
        return found
    left = QuerySet([queries.ids[q] for q in rest], queries.vectors[rest], queries.id_type)
    body = functools.partial(_scan, queries=left, floors=floors[rest], dim=index.dim, bits=index.bits, k=k, recall=recall, schema=schema)
    return found.unionByName(_ranked(index.vectors.mapInArrow(body, ddl), k))


def sketch_top_k(
    index: SketchIndex, queries: DataFrame, *, k: int = 5, recall: float | None = RECALL,
    query_id: str = "query_id", query_vector: str = "vector", block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """(query_id, id, score, rank): the ``k`` most similar vectors of each query.

    ``recall`` is the probability with which a vector as good as a query's k-th best lies
    within the radius searched; None searches until nothing further away can be as good, and
    equals the exact search. Queries are taken in blocks of a hash of their id, whose best
    ``k`` come to the driver between rounds. A query with a null id or of another size is
    left out, equal queries count once. Scores and ties are those of ``cosine_top_k``.
    """
    spark = index.vectors.sparkSession
    asked = queries.select(F.col(query_id).alias("query_id"), F.col(query_vector).alias("vector"))
    asked = materialize(asked.where((F.size("vector") == index.dim) & F.col("query_id").isNotNull()).distinct(), "queries")
    blocks = max(1, -(-asked.count() // block_queries))
    path = fresh_path(spark, "hits")
    for block in range(blocks):
        part = asked.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == block)
        held = _fetched(part, "query_id", "vector", index.dim)
        if held.ids:
            _searched(index, held, k, recall).write.parquet(f"{path}/block={block}")
    kind = asked.schema["query_id"].dataType.simpleString()
    ddl = f"query_id {kind}, id {index.id_type}, score double, rank int"
    if not asked.count():
        return spark.createDataFrame([], ddl)
    return spark.read.schema(ddl).parquet(path).select("query_id", "id", "score", "rank")
