"""Request shards: chunking, token budgets and admission."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quillon.config import DatasetSpec, Limits
from quillon.functions.keys import request_file_name
from quillon.functions.requests import content_parts, has_content, request_line
from quillon.operators.dedupe import top_per_key
from quillon.operators.images import blob_index
from quillon.operators.numbering import global_index
from quillon.operators.state import active_batches, as_events, pending_shards
from quillon.sources.packs import one_place, pack_index, read_packed, with_content, write_packed


def next_shard_id(batches: DataFrame) -> DataFrame:
    """One row: the id the next shard gets."""
    return batches.agg(F.coalesce(F.max("shard_id") + 1, F.lit(0)).cast("long").alias("next_shard_id"))


def split_by_content(
    eligible: DataFrame, spec: DatasetSpec, has_image: Column
) -> tuple[DataFrame, DataFrame]:
    """(with content, skipped): skipped records stay pending and take no place in a shard."""
    found = has_content(spec, F.col("text"), has_image)
    return eligible.where(found), eligible.where(~found)


def assign_shards(eligible: DataFrame, batches: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """(record_id, shard_id): consecutive chunks in id order, after the existing shards.

    Only ids are numbered; texts and images join later, so the sort stays narrow.
    """
    indexed = global_index(eligible.select("record_id"), ["record_id"], "_index")
    base = next_shard_id(batches).scalar()
    chunk = F.floor(F.col("_index") / F.lit(limits.records_per_shard)).cast("long")
    return indexed.select("record_id", (base + chunk).alias("shard_id"))


def assign_events(assignment: DataFrame, seq: int) -> DataFrame:
    return as_events(assignment.withColumn("event", F.lit("assign")).withColumn("seq", F.lit(seq)))


def shard_batches(assignment: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """New PENDING batch rows: size, token estimate and request file of each shard."""
    return assignment.groupBy("shard_id").agg(F.count(F.lit(1)).alias("record_count")).select(
        F.lit(None).cast("string").alias("batch_id"),
        "shard_id",
        F.lit("PENDING").alias("state"),
        (F.col("record_count") * limits.tokens_per_record).alias("est_tokens"),
        "record_count",
        request_file_name(F.col("shard_id")).alias("request_file"),
    )


def request_lines(
    records: DataFrame, assignment: DataFrame, spec: DatasetSpec, *, dim: int, model: str,
    blobs: str | None = None,
) -> DataFrame:
    """(shard_id, record_id, line) of every assigned record that has content.

    ``records`` needs record_id and text; with ``blobs``, the folder of a blob store, also
    image_sha. Records then meet the store's index by hash and move to the task of their
    shard with the place of their picture; its bytes are read there and cross no exchange.
    A shard's lines lie together and in id order.
    """
    joined = assignment.join(records.hint("merge"), "record_id")
    if blobs is not None:
        joined = by_shard(_with_places(joined, blob_index(records.sparkSession, blobs)))
        joined = with_content(joined, blobs).withColumnRenamed("content", "image")
    else:
        if "image" not in records.columns:
            joined = joined.withColumn("image", F.lit(None).cast("binary"))
        joined = by_shard(joined)
    parts = content_parts(spec, F.col("text"), F.col("image"))
    line = request_line(F.col("record_id"), parts, dim=dim, model=model)
    return joined.select("shard_id", "record_id", line.alias("line")).where("line IS NOT NULL")


def by_shard(rows: DataFrame) -> DataFrame:
    """Each shard's rows in one task, in id order; a shard holds a fixed number of records."""
    return rows.repartition("shard_id").sortWithinPartitions("shard_id", "record_id")


def _with_places(records: DataFrame, index: DataFrame) -> DataFrame:
    """Records with the place of their picture, nulls for those without one.

    The index is unique by hash, so a picture shared by many records is a skewed left side
    that adaptive execution can split; records without a picture stay out of the join, where
    all would meet under the null key.
    """
    rows = records.select("shard_id", "record_id", "text", "image_sha")
    bare = rows.where("image_sha IS NULL")
    for name, kind in (("pack", "string"), ("offset", "long"), ("length", "long")):
        bare = bare.withColumn(name, F.lit(None).cast(kind))
    found = rows.where("image_sha IS NOT NULL").join(index.withColumnRenamed("sha", "image_sha"), "image_sha", "left")
    return found.unionByName(bare)


def write_request_shards(lines: DataFrame, path: str, epoch: int = 0) -> None:
    """Request files, many shards to a pack.

    ``lines`` come from :func:`request_lines`, each shard's together and in id order, and are
    written where they lie. The number of files follows the bytes and tasks, not the
    shards. Writing the shards of an epoch again changes nothing that is read.
    """
    write_packed(
        lines.select(
            F.concat(F.lit(f"{epoch}:"), F.col("shard_id").cast("string")).alias("key"),
            F.encode(F.concat("line", F.lit("\n")), "UTF-8").alias("content"),
        ),
        path,
    )


def request_index(spark: SparkSession, path: str) -> DataFrame:
    """(epoch, shard_id, pack, offset, length) of the written shards."""
    part = F.split("key", ":")
    return one_place(pack_index(spark, path)).select(
        part[0].cast("long").alias("epoch"), part[1].cast("long").alias("shard_id"), "pack", "offset", "length"
    )


def read_request_shards(places: DataFrame, path: str) -> DataFrame:
    """The rows of ``places`` with ``value``, a row for each line of their shards.

    ``places`` are rows of :func:`request_index`, all or some, perhaps with more columns;
    only their byte ranges are read.
    """
    found = read_packed(places, path, lines=True)
    return found.withColumn("value", F.decode("content", "UTF-8")).drop("pack", "offset", "length", "content")


def request_files(index: DataFrame) -> DataFrame:
    """(file_name, length): each written shard as the request file it stands for."""
    return index.select(request_file_name(F.col("shard_id")).alias("file_name"), "length")


def in_flight_budget(batches: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """One row: tokens in flight, free job slots and remaining tokens."""
    active = active_batches(batches).agg(
        F.coalesce(F.sum("est_tokens"), F.lit(0)).cast("long").alias("active_tokens"),
        F.count(F.lit(1)).alias("active_jobs"),
    )
    return active.select(
        "active_tokens",
        F.greatest(F.lit(limits.max_concurrent_jobs) - F.col("active_jobs"), F.lit(0))
        .cast("int").alias("free_slots"),
        F.greatest(F.lit(limits.max_enqueued_tokens) - F.col("active_tokens"), F.lit(0))
        .alias("free_tokens"),
    )


def oversized_shards(batches: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Pending shards no round can ever admit."""
    return pending_shards(batches).where(F.col("est_tokens") > limits.max_enqueued_tokens)


def admission_round(batches: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Pending shards submitted in one round, first fit in shard order.

    A shard is refused once an earlier one of the same size was, so of each size only the
    first ``max_concurrent_jobs`` can matter. Sizes above the remaining tokens drop out,
    which bounds the final fold by the limits (sizes x slots), not by the data.
    """
    budget = in_flight_budget(batches, limits)
    free_tokens = budget.select("free_tokens").scalar()
    pending = pending_shards(batches).select("shard_id", "est_tokens")
    # The static bound reaches the scan; the scalar one needs the active batches first.
    fitting = pending.where(F.col("est_tokens") <= limits.max_enqueued_tokens).where(
        F.col("est_tokens") <= free_tokens
    )
    few = top_per_key(
        fitting, ["est_tokens"], [F.col("shard_id").asc()], limits.max_concurrent_jobs
    )
    queue = few.withColumns({
        "free_slots": budget.select("free_slots").scalar(),
        "free_tokens": free_tokens,
    }).agg(
        F.array_sort(F.collect_list(F.struct("shard_id", "est_tokens"))).alias("queue"),
        F.max("free_slots").alias("free_slots"),
        F.max("free_tokens").alias("free_tokens"),
    )
    start = F.struct(
        F.array().cast("array<struct<shard_id:bigint,est_tokens:bigint>>").alias("taken"),
        F.col("free_tokens").cast("long").alias("left"),
    )

    def step(acc: Column, shard: Column) -> Column:
        tokens = shard["est_tokens"].cast("long")
        fits = (F.size(acc["taken"]) < F.col("free_slots")) & (tokens <= acc["left"])
        entry = F.struct(shard["shard_id"].cast("long").alias("shard_id"), tokens.alias("est_tokens"))
        return F.struct(
            F.when(fits, F.array_append(acc["taken"], entry)).otherwise(acc["taken"]).alias("taken"),
            F.when(fits, acc["left"] - tokens).otherwise(acc["left"]).alias("left"),
        )

    folded = queue.select(F.aggregate("queue", start, step)["taken"].alias("taken"))
    return folded.select(F.posexplode("taken").alias("position", "shard")).select(
        "position", "shard.shard_id", "shard.est_tokens"
    )


def cost_estimate(
    records: DataFrame, *, tokens: Column, images: Column,
    token_rate: float, image_rate: float, discount: float,
) -> DataFrame:
    """Cost of each record: tokens and images at their rates, less the batch discount."""
    full = tokens * F.lit(token_rate) + images * F.lit(image_rate)
    return records.withColumn("cost", full * F.lit(1.0 - discount))
