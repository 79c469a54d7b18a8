"""Reachability of stored files: epochs, packs and blobs that nothing refers to (a report).

Marks are keys of committed rows; the sweep is an anti-join of the listing. Nothing is
deleted. What is newer than ``before`` may belong to a step that still runs and is left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quillon.session import shared_dir

SWEPT = "kind string, name string, bytes bigint"


def stored_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, length, modified) of all files below a folder; contents are never read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def orphan_epochs(files: DataFrame, committed: DataFrame, before: int) -> DataFrame:
    """Folders ``<table>/epoch=N`` whose epoch never was committed and lies below ``before``.

    ``committed`` holds the finished epochs. A table's name is its path's last part.
    """
    epoch = F.regexp_extract("path", r"/epoch=(\d+)/", 1)
    held = files.where(epoch != "").select(
        epoch.cast("long").alias("epoch"), F.regexp_extract("path", r"([^/]+/epoch=\d+)/", 1).alias("name"), "length")
    left = held.where(F.col("epoch") < before).join(committed.select("epoch").distinct(), "epoch", "left_anti")
    return left.groupBy("name").agg(F.sum("length").alias("bytes")).select(F.lit("epoch").alias("kind"), "name", "bytes")


def orphan_packs(files: DataFrame, used: DataFrame, before: int) -> DataFrame:
    """Packs, without their index, that hold no used entry; ``used`` has the pack of each.

    ``before`` is in milliseconds, as epochs are, and is held against the file's time.
    """
    pack = F.regexp_extract("path", r"/data/(pack-[0-9a-f]+)$", 1)
    held = files.where((pack != "") & (F.unix_millis("modified") < before)).select(pack.alias("pack"), F.col("length").alias("bytes"))
    left = held.join(used.select("pack").distinct(), "pack", "left_anti")
    return left.select(F.lit("pack").alias("kind"), F.col("pack").alias("name"), "bytes")


def orphan_entries(index: DataFrame, places: DataFrame, used: DataFrame) -> DataFrame:
    """Entries of packs that are in use which nobody reads: of an unused key, or a second copy.

    ``index`` has every entry (pack, key, offset, length), ``places`` the one read for each
    key, ``used`` the keys referred to.
    """
    read = places.join(used.select("key").where("key IS NOT NULL").distinct(), "key", "left_semi").select("pack", "key", "offset")
    live = read.select("pack").distinct()
    left = index.join(live, "pack", "left_semi").join(read, ["pack", "key", "offset"], "left_anti")
    return left.groupBy("key").agg(F.sum("length").alias("bytes")).select(F.lit("blob").alias("kind"), F.col("key").alias("name"), "bytes")


def stale_intermediates(spark: SparkSession, before: int) -> DataFrame:
    """Written intermediate tables in the shared folder that no file was added to since ``before``."""
    files = stored_files(spark, shared_dir(spark))
    name = F.regexp_extract("path", r"/([a-z_]+-[0-9a-f]{32})/", 1)
    held = files.where(name != "").groupBy(name.alias("name")).agg(F.sum("length").alias("bytes"), F.max("modified").alias("last"))
    return held.where(F.unix_millis("last") < before).select(F.lit("intermediate").alias("kind"), "name", "bytes")
