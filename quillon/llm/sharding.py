"""Shards that each hold the same mixture of sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quillon.operators.numbering import global_index
from quillon.session import materialize

#: More sources than this are joined by a shuffle instead of a broadcast (32 bytes each).
BROADCAST_SOURCES = 100_000


def interleaved(rows: DataFrame, shards: int, seed: int, source: str, keys: list[str]) -> DataFrame:
    """Adds ``shard`` and ``slot`` to narrow rows by proportional stratified interleaving.

    Within its source a row has a rank in the order of a seeded hash of ``keys``; all rows
    sort by (rank + 1/2) / source size, and equal runs of that order are the shards. Both
    orders are range partitions with counted offsets, so a source may hold any share of the
    rows. Rows equal in source and keys are interchangeable.
    """
    key = F.concat_ws(":", F.lit(str(seed)), *(F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys))
    rows = rows.withColumn("_source", F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("")))
    shuffled = global_index(rows.withColumn("_hash", F.md5(key)), ["_source", "_hash", *keys], "_at")
    counts = materialize(shuffled.groupBy("_source").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n")), "counts")
    total = counts.agg(F.sum("_n")).first()[0] or 0
    small = F.broadcast(counts) if counts.count() <= BROADCAST_SOURCES else counts
    ranked = shuffled.join(small, "_source").withColumn(
        "_share", (2 * (F.col("_at") - F.col("_first")) + 1).cast("double") / (2 * F.col("_n")).cast("double"))
    placed = global_index(ranked, ["_share", "_source", "_hash", *keys], "_place")
    # The first row of shard s is at ceil(s * total / shards).
    shard = F.expr(f"(_place * {shards}) div {max(total, 1)}")
    start = F.expr(f"(shard * {max(total, 1)} + {shards - 1}) div {shards}")
    return placed.withColumn("shard", shard).withColumn("slot", F.col("_place") - start).withColumn(
        "shard", F.col("shard").cast("int")).drop("_source", "_hash", "_at", "_first", "_n", "_share", "_place")


def shard_rows(docs: DataFrame, shards: int = 40, seed: int = 42, id_column: str = "doc_id",
               text_column: str = "text", source_column: str = "source") -> DataFrame:
    """(doc_id, size, text_crc32, source, law, shard, slot, grown_shard) of every row.

    Follows the law ``rows``: shards differ by one row at most, and each source is spread
    evenly over them. Size is the text's UTF-8 bytes plus 16; a null text has no bytes, a
    null source is a source of its own, null ids sort like any other. Repeated rows are
    rows of their own and interchangeable. ``grown_shard`` belongs to another law and is
    null. Other columns are ignored; an empty table gives no rows. Texts don't move.
    """
    data = F.coalesce(F.col(text_column).cast("binary"), F.lit("").cast("binary"))
    rows = docs.select(
        F.col(id_column).alias("doc_id"), (F.octet_length(data) + 16).cast("long").alias("size"),
        F.crc32(data).alias("text_crc32"), F.col(source_column).alias("source"))
    placed = interleaved(rows, shards, seed, "source", ["doc_id", "text_crc32"])
    return placed.select("doc_id", "size", "text_crc32", "source", F.lit("rows").alias("law"), "shard",
                         F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def sharded(docs: DataFrame, shards: int = 40, seed: int = 42) -> DataFrame:
    """The documents with all their columns, ``shard`` and ``slot`` (which replace columns of
    these names).

    Rows that repeat a document are stored once while shards are dealt, keyed by a hash of
    all columns, checksum and length of the text, and are met again by that key.
    """
    data = F.coalesce(F.col("text").cast("binary"), F.lit("").cast("binary"))
    docs = docs.drop("shard", "slot")
    whole = [F.col(f"`{c}`") for c in docs.columns]
    rows = docs.select(
        F.struct(*whole).alias("row"), F.col("source").alias("_src"), F.xxhash64(*whole).alias("_all"),
        F.crc32(data).alias("_crc"), F.octet_length(data).alias("_bytes"))
    key = ["_all", "_crc", "_bytes"]
    held = rows.groupBy(*key).agg(F.first("row").alias("row"))
    placed = interleaved(rows.select("_src", *key), shards, seed, "_src", key)
    return placed.join(held, key).select("row.*", "shard", F.col("slot").cast("long").alias("slot"))
