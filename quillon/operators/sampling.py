"""Repeatable samples and newest-first limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def sample_key(column: str, seed: int) -> Column:
    """Hash that decides a row's place in the sample order."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(column).cast("string")))


def seeded_sample(df: DataFrame, column: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows chosen by hash of a unique column; the same seed gives the same rows.

    A top-n by hash: tasks keep ``n`` rows each, nothing is sorted as a whole.
    """
    return df.orderBy(sample_key(column, seed), column).limit(n)


def most_recent(df: DataFrame, order: str, n: int, tie: str) -> DataFrame:
    """The ``n`` newest rows."""
    return df.orderBy(F.col(order).desc(), F.col(tie).asc()).limit(n)


def pilot(df: DataFrame, key: str, n: int) -> DataFrame:
    """The first ``n`` rows by key, for a trial run."""
    return df.orderBy(key).limit(n)
