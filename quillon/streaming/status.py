"""Job polls as a stream of state changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillon.operators.dedupe import last_write_wins
from quillon.operators.jobs import latest_states
from quillon.sources.epochs import read_epochs, write_epoch
from quillon.streaming.sink import run_available

STATE_SCHEMA = "batch_id string, state string, seq bigint, terminal boolean"


def status_stream(polls: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Keep the state of each batch up to date; returns the current states.

    ``polls`` is a stream of (batch_id, seq, job_state). Spark's state store holds one row
    per batch, the same aggregation as in batch; each epoch writes only the changed ones.
    """
    spark: SparkSession = polls.sparkSession

    def each(changed: DataFrame, epoch: int) -> None:
        write_epoch(changed, path, epoch)

    run_available(latest_states(polls), each, checkpoint, mode="update")
    return last_write_wins(read_epochs(spark, path, STATE_SCHEMA), ["batch_id"], ["epoch"]).drop("epoch")
