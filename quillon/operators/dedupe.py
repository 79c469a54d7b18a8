"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows of each key.

    Spark limits groups before the shuffle as well, so a task sends at most ``k`` rows of
    any key and a hot key costs no more than the number of tasks.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= k).drop("_rank")


def first_write_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Earliest row of each key; ``order`` must be total within a key."""
    return top_per_key(df, keys, [F.col(c).asc() for c in order], 1)


def last_write_wins(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Latest row of each key; ``order`` must be total within a key."""
    return top_per_key(df, keys, [F.col(c).desc() for c in order], 1)


def insert_or_ignore(
    state: DataFrame, incoming: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Incoming rows whose key is new, one per key (the first); existing rows win.

    Duplicates fall before the anti join, which therefore sees unique keys on both sides.
    """
    fresh = first_write_wins(incoming, keys, order)
    return fresh.join(state.select(*keys).hint("merge"), list(keys), "left_anti")
