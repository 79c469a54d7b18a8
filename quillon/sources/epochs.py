"""Append-only tables: one folder per epoch, so a repeated epoch replaces itself."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def write_epoch(df: DataFrame, path: str, epoch: int) -> None:
    """Store the rows of one epoch; running the epoch again leaves the same table."""
    df.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Scan a table that may not have been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def read_epochs(
    spark: SparkSession, path: str, schema: T.StructType | str, only: Collection[int] | None = None
) -> DataFrame:
    """All epochs written so far, or those in ``only``, with their ``epoch``; empty before the first.

    Of ``only`` the folders are named, so that the others, however many, aren't even listed.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    full = T.StructType([*schema.fields, T.StructField("epoch", T.LongType())])
    if only is None:
        return read_or_empty(spark, path, full)
    if not only:
        return spark.createDataFrame([], full)
    try:
        return spark.read.schema(full).option("basePath", path).parquet(*[f"{path}/epoch={e}" for e in sorted(only)])
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
    return read_or_empty(spark, path, full).where(F.col("epoch").isin(sorted(only)))


def earlier_epochs(stored: DataFrame, epoch: int) -> DataFrame:
    """Epochs before the given one: a repeated epoch must not see its own first run."""
    return stored.where(F.col("epoch") < epoch)
