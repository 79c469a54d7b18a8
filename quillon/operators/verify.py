"""Audits of a finished collection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quillon.operators.search import cosine_top_k, self_search
from quillon.operators.sampling import seeded_sample

SPOT_SAMPLE, SELF_SAMPLE, RECALL_SAMPLE, RECALL_K = 100, 20, 5, 5


def _check(name: str, passed: Column, other: str) -> list[Column]:
    return [
        F.lit(name).alias("check"),
        F.when(passed, "PASS").otherwise(other).alias("status"),
        F.col("ok").cast("long").alias("ok"),
        F.col("n").cast("long").alias("n"),
    ]


def count_match(state: DataFrame, points: DataFrame) -> DataFrame:
    """Stored points against records marked as stored."""
    stored = points.agg(F.count(F.lit(1)).alias("n"))
    marked = state.agg(F.count_if(F.col("upsert_status") == "ok").alias("ok"))
    return marked.withColumn("n", stored.scalar()).select(
        *_check("count_match", F.col("ok") == F.col("n"), "FAIL")
    )


def spot_check(
    state: DataFrame, records: DataFrame, points: DataFrame, n: int = SPOT_SAMPLE, seed: int = 42
) -> DataFrame:
    """How many of a sample of stored records have their point."""
    stored = state.where("upsert_status = 'ok'").select("record_id")
    # The sample has at most ``n`` rows, so the tables it meets are only scanned.
    sample = records.join(
        F.broadcast(seeded_sample(stored, "record_id", n, seed)), "record_id", "left_semi"
    ).select("point_id")
    asked = sample.agg(F.count(F.lit(1)).alias("n"))
    found = points.join(F.broadcast(sample), "point_id", "left_semi")
    return found.agg(F.count_distinct("point_id").alias("ok")).withColumn("n", asked.scalar()).select(
        *_check("spot_check", F.col("ok") == F.col("n"), "WARN")
    )


def self_search_check(
    points: DataFrame, dim: int, n: int = SELF_SAMPLE, seed: int = 42, id_column: str = "record_id"
) -> DataFrame:
    """Whether sampled vectors find themselves first; those that can't be searched miss."""
    sample = seeded_sample(points.select(id_column, "vector"), id_column, n, seed).select(
        F.col(id_column).alias("query_id"), "vector"
    )
    found = self_search(cosine_top_k(points, sample, dim=dim, k=1, id_column=id_column))
    asked = sample.select("query_id").join(found.select("query_id", "ok"), "query_id", "left")
    return asked.agg(F.count_if(F.coalesce("ok", F.lit(False))).alias("ok"), F.count(F.lit(1)).alias("n")).select(
        *_check("self_search", (F.col("ok") == F.col("n")) & (F.col("n") > 0), "WARN")
    )


def size_check(points: DataFrame, dim: int, vector: str = "vector") -> DataFrame:
    """Vectors of the right size against all: others take no part in a search."""
    right = F.coalesce(F.size(vector) == dim, F.lit(False))
    return points.agg(F.count_if(right).alias("ok"), F.count(F.lit(1)).alias("n")).select(
        *_check("vector_size", F.col("ok") == F.col("n"), "FAIL")
    )


def recall_hits(
    sample: DataFrame, points: DataFrame, query_vectors: DataFrame, dim: int, k: int = RECALL_K,
    id_column: str = "record_id",
) -> DataFrame:
    """(record_id, hit): whether each sampled record is among its text's ``k`` nearest.

    Samples without a query vector (blank text) count as missed.
    """
    asked = query_vectors.select(F.col(id_column).alias("query_id"), "vector")
    found = cosine_top_k(points, asked, dim=dim, k=k, id_column=id_column)
    own = found.where("id = query_id").select(F.col("query_id").alias(id_column), F.lit(True).alias("_hit"))
    return sample.select(id_column).join(own, id_column, "left").select(
        id_column, F.coalesce("_hit", F.lit(False)).alias("hit")
    )


def recall_check(hits: DataFrame) -> DataFrame:
    """Passes at half the sample, rounded down; ``n`` shows when that says nothing."""
    return hits.agg(F.count_if("hit").alias("ok"), F.count(F.lit(1)).alias("n")).select(
        *_check("cross_modal", F.col("ok") >= F.floor(F.col("n") / 2), "WARN")
    )


def skipped_check(name: str, spark) -> DataFrame:
    return spark.range(1).select(
        F.lit(name).alias("check"), F.lit("SKIP").alias("status"),
        F.lit(0).cast("long").alias("ok"), F.lit(0).cast("long").alias("n"),
    )


def metric_rows(counts: DataFrame) -> DataFrame:
    """(metric, count) rows of a one-row report."""
    cells = [F.struct(F.lit(c).alias("metric"), F.col(c).alias("count")) for c in counts.columns]
    return counts.select(F.inline(F.array(*cells)))
