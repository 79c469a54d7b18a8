"""Result files: JSON lines written by an embedding job.

A batch's results are a file ``<batch>.jsonl``, or a folder of that name holding parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quillon.functions.keys import result_file_name

# Place of a line: its file, the byte offset of its split, then its number inside the split.
POSITION = ("file_path", "file_block", "line_no")
RESULT_NAME = r"([^/]+\.jsonl)(?:/[^/]+)?$"
WRITTEN_NAME = r"/results=([^/]+\.jsonl)/[^/]+$"


def unescaped(text: Column) -> Column:
    """Percent escapes undone (a plus stays one); text that holds broken ones stays as it is."""
    return F.coalesce(F.try_url_decode(F.replace(text, F.lit("+"), F.lit("%2B"))), text)


def batch_file(file_path: Column) -> Column:
    """Name under which a batch's results are stored, from the path of one of its files.

    Paths are escaped as URIs; names of folders written by ``write_result_files`` once more.
    """
    path = unescaped(file_path)
    written = F.regexp_extract(path, WRITTEN_NAME, 1)
    return F.when(written != "", unescaped(written)).otherwise(F.regexp_extract(path, RESULT_NAME, 1))


def located_lines(scan: DataFrame) -> DataFrame:
    """Non-blank lines of a text scan (batch or stream) with the file each came from."""
    return scan.select(
        F.trim("value").alias("value"),
        batch_file(F.col("_metadata.file_path")).alias("file_name"),
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("file_block"),
    ).where(F.length("value") > 0)


def numbered_lines(lines: DataFrame) -> DataFrame:
    """Add the number that orders lines inside their split (batch frames only)."""
    return lines.withColumn("line_no", F.monotonically_increasing_id())


def read_result_lines(spark: SparkSession, path: str) -> DataFrame:
    """Scan a folder of result files."""
    return numbered_lines(located_lines(spark.read.option("recursiveFileLookup", "true").text(path)))


def attach_batches(lines: DataFrame, batches: DataFrame) -> DataFrame:
    """Keep lines of the given batches, found by result file name, and add ``batch_id``."""
    names = batches.select("batch_id", result_file_name(F.col("batch_id")).alias("file_name"))
    return lines.join(names, "file_name")


def unknown_lines(lines: DataFrame, batches: DataFrame) -> DataFrame:
    """(file_path, n): lines of files that belong to none of the batches."""
    names = batches.select(result_file_name(F.col("batch_id")).alias("file_name"))
    left = lines.join(names, "file_name", "left_anti")
    return left.groupBy("file_path").agg(F.count(F.lit(1)).alias("n"))


def write_result_files(lines: DataFrame, path: str) -> None:
    """Result lines (batch_id, value) as one folder per batch, named as its result file."""
    named = lines.select("value", result_file_name(F.col("batch_id")).alias("results"))
    named.write.mode("append").partitionBy("results").text(path)
