"""File listings and content-addressed blobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def list_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Files below a folder as (path, file_name, length); contents are never read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select(
        "path", F.element_at(F.split("path", "/"), -1).alias("file_name"), "length"
    )


def read_blobs(spark: SparkSession, path: str) -> DataFrame:
    """Image files of a folder as (sha, content), named by content hash."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(
        F.regexp_extract("path", r"([^/.]+)\.[^/]*$", 1).alias("sha"), "content"
    )


def read_images(spark: SparkSession, path: str) -> DataFrame:
    """Decoded images (Spark's image source); undecodable files keep a null image."""
    files = spark.read.format("image").option("recursiveFileLookup", "true").load(path)
    return files.select("image.*")
