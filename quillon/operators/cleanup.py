"""Which intermediate files are no longer needed (a report; nothing is deleted)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quillon.functions.keys import request_file_name, result_file_name
from quillon.sources.results import WRITTEN_NAME, unescaped


def _all_done(state: DataFrame, key: str, done) -> DataFrame:
    """Keys whose members all pass ``done``; the members are combined before any join."""
    return (
        state.where(F.col(key).isNotNull()).groupBy(key)
        .agg(F.count(F.lit(1)).alias("members"), F.bool_and(done).alias("_done"))
        .where("_done").drop("_done")
    )


def eligible_shards(batches: DataFrame, state: DataFrame) -> DataFrame:
    """(shard_id, request_file, members): every record of the shard is embedded."""
    done = _all_done(state, "shard_id", F.col("embed_status") == "ok")
    files = batches.where("request_file IS NOT NULL").select("shard_id", "request_file")
    return files.join(done, "shard_id")


def eligible_results(batches: DataFrame, state: DataFrame) -> DataFrame:
    """(batch_id, result_file, members): every record of a succeeded batch is stored."""
    done = _all_done(state, "batch_id", F.col("upsert_status") == "ok")
    succeeded = batches.where("state = 'SUCCEEDED'").select(
        "batch_id", result_file_name(F.col("batch_id")).alias("result_file")
    )
    return succeeded.join(done, "batch_id")


def artifact_files(files: DataFrame) -> DataFrame:
    """(file_name, length) per artifact of a listing (path, file_name, length).

    A folder ``shard_id=N`` is the request file of shard N, a folder ``results=X`` the
    result file X (escaped once); the sizes of its parts are added. Other files, and listings
    without paths, stand for themselves.
    """
    if "path" not in files.columns:
        return files
    path = F.col("path")
    shard = F.regexp_extract(path, r"/shard_id=(\d+)/[^/]+$", 1)
    written = F.regexp_extract(path, WRITTEN_NAME, 1)
    name = (
        F.when(shard != "", request_file_name(F.when(shard != "", shard).cast("long")))
        .when(written != "", unescaped(written)).otherwise(F.col("file_name"))
    )
    return files.select(name.alias("file_name"), "length").groupBy("file_name").agg(F.sum("length").alias("length"))


def present_files(eligible: DataFrame, files: DataFrame, name: str) -> DataFrame:
    """Eligible files that exist, with their size (``files``: file_name, length)."""
    listing = files.select(F.col("file_name").alias(name), "length")
    return eligible.join(listing, name)


def reclaimable(
    batches: DataFrame, state: DataFrame, shard_files: DataFrame, result_files: DataFrame,
    image_files: DataFrame, scope: str = "all",
) -> DataFrame:
    """One row per kind of artifact: eligible and total count, skipped, reclaimable bytes.

    ``scope``: shards (requests and results), images, or all. Images are all eligible.
    """
    if scope not in ("all", "shards", "images"):
        raise ValueError(f"Invalid scope: {scope}. Must be one of: shards, images, all")
    parts = []
    if scope in ("all", "shards"):
        shards = present_files(eligible_shards(batches, state), shard_files, "request_file")
        results = present_files(eligible_results(batches, state), result_files, "result_file")
        parts.append(_summary("shards", shards, batches.where("request_file IS NOT NULL")))
        parts.append(_summary("results", results, batches.where("state = 'SUCCEEDED'")))
    if scope in ("all", "images"):
        parts.append(_summary("images", image_files, image_files))
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report.select(
        "artifact", "eligible", "total", (F.col("total") - F.col("eligible")).alias("skipped"), "bytes"
    )


def _summary(artifact: str, eligible: DataFrame, everything: DataFrame) -> DataFrame:
    total = everything.agg(F.count(F.lit(1)).alias("n"))
    return eligible.agg(
        F.count(F.lit(1)).alias("eligible"),
        F.coalesce(F.sum("length"), F.lit(0)).cast("long").alias("bytes"),
    ).select(F.lit(artifact).alias("artifact"), "eligible", total.scalar().alias("total"), "bytes")
