"""Batch lifecycle as an append-only event log and its folded state."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

BATCH_EVENT_SCHEMA = (
    "shard_id bigint, seq bigint, state string, batch_id string, est_tokens bigint, "
    "record_count bigint, request_file string, result_file string"
)
BATCH_COLUMNS = (
    "shard_id", "batch_id", "state", "est_tokens", "record_count", "request_file", "result_file",
)


def as_batch_events(df: DataFrame, seq: int) -> DataFrame:
    """Fill the event columns ``df`` lacks with nulls; all rows get the same ``seq``."""
    types = dict(part.split() for part in BATCH_EVENT_SCHEMA.split(", "))
    return df.withColumn("seq", F.lit(seq)).select(*[
        (F.col(c) if c in df.columns or c == "seq" else F.lit(None)).cast(t).alias(c)
        for c, t in types.items()
    ])


def fold_batches(events: DataFrame) -> DataFrame:
    """Current row of every batch: the latest state, and the last value given of the rest."""
    last = {
        c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("seq"))).alias(c)
        for c in BATCH_COLUMNS if c != "shard_id"
    }
    return events.groupBy("shard_id").agg(*last.values()).select(*BATCH_COLUMNS)
