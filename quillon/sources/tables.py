"""Table scans and dataset-order numbering."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", split: str | None = None, **options
) -> DataFrame:
    """Scan a dataset, or one split of it: a folder or files named as the split, also with a
    dash and a number behind."""
    if split:
        path = f"{path.rstrip('/')}/{{{split},{split}.*,{split}-*}}"
    return spark.read.format(fmt).options(**options).load(path)


def read_with_row_index(
    spark: SparkSession, path: str, index: str = "row_index", broadcast: bool = True
) -> DataFrame:
    """Scan Parquet with each row's position in the dataset (files by name, then rows).

    Positions come from file metadata: one count per file gives the offsets, so no row
    is sorted or shuffled. ``broadcast`` sends one row per file to all tasks; turn it off
    for datasets of millions of files.
    """
    rows = spark.read.parquet(path)
    located = rows.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.row_index").alias("_row"),
    )
    sizes = located.groupBy("_file").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    if broadcast:
        offsets = F.broadcast(offsets)
    return located.join(offsets, "_file").select(
        *rows.columns, (F.col("_offset") + F.col("_row")).alias(index)
    )


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """Scan a vectors table (record_id, point_id, vector, and its collection order)."""
    return spark.read.parquet(path)
