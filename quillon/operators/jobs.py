"""Remote job board."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quillon.config import BATCH_STATES
from quillon.functions.states import is_terminal, local_state


def job_board(jobs: DataFrame, batches: DataFrame) -> DataFrame:
    """Jobs (batch_id, display_name, job_state) beside the locally stored state."""
    known = batches.where("batch_id IS NOT NULL").select(
        "batch_id", F.col("state").alias("local_state")
    )
    return jobs.join(known, "batch_id", "left").select(
        "batch_id",
        "display_name",
        "job_state",
        F.coalesce("local_state", F.lit("—")).alias("local_state"),
    )


def polled(jobs: DataFrame) -> DataFrame:
    """Jobs with the local state their remote state maps to."""
    return jobs.withColumn("state", local_state(F.col("job_state"))).withColumn(
        "terminal", is_terminal(F.col("job_state"))
    )


def _states() -> Column:
    return F.array(*[F.lit(s) for s in BATCH_STATES])


def _code(state: Column) -> Column:
    """State as a number: unlike text, it can be combined in a hash aggregation."""
    return F.array_position(_states(), state).cast("int")


def _settled(seen: DataFrame) -> DataFrame:
    """Per batch the first terminal state, else the newest (batch_id, seq, state, terminal).

    A plain hash aggregation, so a batch with most of the polls is combined map-side.
    """
    ended = F.when(F.col("terminal"), F.col("seq"))
    code = _code(F.col("state"))
    return seen.groupBy("batch_id").agg(
        F.min_by(code, ended).alias("_final"),
        F.max_by(code, "seq").alias("_last"),
        F.min(ended).alias("_ended"),
        F.max("seq").alias("_seen"),
    ).select(
        "batch_id",
        F.element_at(_states(), F.coalesce("_final", "_last")).alias("state"),
        F.coalesce("_ended", "_seen").alias("seq"),
        F.col("_final").isNotNull().alias("terminal"),
    )


def latest_states(polls: DataFrame) -> DataFrame:
    """State of each batch after polls (batch_id, seq, job_state).

    The first terminal state sticks; until then the last poll counts.
    """
    return _settled(polled(polls))


def merge_states(old: DataFrame, new: DataFrame) -> DataFrame:
    """Two results of :func:`latest_states` as one."""
    return _settled(old.unionByName(new))
