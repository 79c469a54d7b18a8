"""Record lifecycle as an append-only event log and its folded state.

Event columns: record_id, seq, event, and where the event has them image_status,
image_sha, shard_id, batch_id. ``seq`` orders the events of a record.

    insert        the record exists
    image         image_status and image_sha are set
    assign        embed_status in_batch, shard_id is set
    submit        batch_id is set
    embed_ok      embed_status ok
    embed_failed  embed_status failed, one more attempt
    reset         embed_status pending, batch_id and shard_id cleared, one more attempt
    upsert        upsert_status ok

Each state column depends only on the last event that sets it (or on a count), so the fold
is a plain aggregation with map-side combine: no list of events is ever built, and a record
with a third of all events costs one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from quillon.config import ACTIVE_STATES, RESET_STATES

EVENT_SCHEMA = (
    "record_id string, seq bigint, event string, image_status string, image_sha string, "
    "shard_id bigint, batch_id string"
)
EVENT_COLUMNS = tuple(part.split()[0] for part in EVENT_SCHEMA.split(", "))
STATE_COLUMNS = (
    "record_id", "image_status", "image_sha", "embed_status", "embed_attempts",
    "batch_id", "shard_id", "upsert_status", "updated_seq",
)


def as_events(df: DataFrame) -> DataFrame:
    """Fill the event columns ``df`` lacks with nulls and put them in log order."""
    types = dict(part.split() for part in EVENT_SCHEMA.split(", "))
    return df.select(*[
        (F.col(c) if c in df.columns else F.lit(None)).cast(types[c]).alias(c)
        for c in EVENT_COLUMNS
    ])


def _seq_of(*events: str) -> Column:
    return F.when(F.col("event").isin(*events), F.col("seq"))


def _changes(events: DataFrame) -> DataFrame:
    """Per record: the last value each kind of event sets, and what was counted."""
    embed = (
        F.when(F.col("event") == "assign", "in_batch")
        .when(F.col("event") == "embed_ok", "ok")
        .when(F.col("event") == "embed_failed", "failed")
        .when(F.col("event") == "reset", "pending")
    )
    # Only assign and submit carry these ids; a reset event may name the batch it undoes.
    shard = F.when(F.col("event") == "assign", F.col("shard_id"))
    batch = F.when(F.col("event") == "submit", F.col("batch_id"))
    placed, sent = _seq_of("assign", "reset"), _seq_of("submit", "reset")
    return events.groupBy("record_id").agg(
        F.max(F.col("event") == "insert").alias("inserted"),
        F.max_by("image_status", _seq_of("image")).alias("image_status"),
        F.max_by("image_sha", _seq_of("image")).alias("image_sha"),
        F.max(_seq_of("image")).alias("image_seq"),
        F.max_by(embed, F.when(embed.isNotNull(), F.col("seq"))).alias("embed_status"),
        F.count_if(F.col("event").isin("embed_failed", "reset")).alias("attempts"),
        F.max_by(batch, sent).alias("batch_id"),
        F.max(sent).alias("batch_seq"),
        F.max_by(shard, placed).alias("shard_id"),
        F.max(placed).alias("shard_seq"),
        F.max(F.col("event") == "upsert").alias("upserted"),
        F.max("seq").alias("updated_seq"),
    )


def fold_events(events: DataFrame, require_insert: bool = False) -> DataFrame:
    """Current state of every record from its whole log.

    ``require_insert`` drops events of records that were never inserted.
    """
    changes = _changes(events)
    if require_insert:
        changes = changes.where("inserted")
    return changes.select(
        "record_id",
        F.coalesce("image_status", F.lit("pending")).alias("image_status"),
        "image_sha",
        F.coalesce("embed_status", F.lit("pending")).alias("embed_status"),
        F.col("attempts").cast("int").alias("embed_attempts"),
        "batch_id",
        "shard_id",
        F.when(F.col("upserted"), "ok").otherwise("pending").alias("upsert_status"),
        "updated_seq",
    )


def apply_events(state: DataFrame, events: DataFrame) -> DataFrame:
    """State after newer ``events``; equals folding both logs together.

    Events are reduced to one row per record before they meet the snapshot, so the join
    has unique keys on both sides. Events of unknown records need an insert among them.
    """
    old, new = state.alias("old"), _changes(events).alias("new")
    joined = old.join(new, F.col("old.record_id") == F.col("new.record_id"), "full_outer").where(
        "old.record_id IS NOT NULL OR new.inserted"
    )

    def newer(column: str, changed: Column, default: str | None = None) -> Column:
        start = F.col(f"old.{column}")
        if default:
            start = F.coalesce(start, F.lit(default))
        return F.when(changed, F.col(f"new.{column}")).otherwise(start).alias(column)

    return joined.select(
        F.coalesce("old.record_id", "new.record_id").alias("record_id"),
        newer("image_status", F.col("new.image_seq").isNotNull(), "pending"),
        newer("image_sha", F.col("new.image_seq").isNotNull()),
        newer("embed_status", F.col("new.embed_status").isNotNull(), "pending"),
        (F.coalesce("old.embed_attempts", F.lit(0)) + F.coalesce("new.attempts", F.lit(0)))
        .cast("int")
        .alias("embed_attempts"),
        newer("batch_id", F.col("new.batch_seq").isNotNull()),
        newer("shard_id", F.col("new.shard_seq").isNotNull()),
        F.when(F.coalesce("new.upserted", F.lit(False)), "ok")
        .otherwise(F.coalesce("old.upsert_status", F.lit("pending")))
        .alias("upsert_status"),
        F.greatest("old.updated_seq", "new.updated_seq").alias("updated_seq"),
    )


def submit_events(state: DataFrame, submitted: DataFrame, seq: int) -> DataFrame:
    """Push the ids of submitted batches (shard_id, batch_id) to the shards' records."""
    members = state.where("shard_id IS NOT NULL").select("record_id", "shard_id")
    pushed = members.join(submitted.select("shard_id", "batch_id"), "shard_id")
    return as_events(pushed.withColumn("event", F.lit("submit")).withColumn("seq", F.lit(seq)))


def reset_events(state: DataFrame, batches: DataFrame, seq: int) -> DataFrame:
    """Send the records of failed, expired, cancelled or deleted batches back to pending.

    Every member is reset, also those already embedded.
    """
    members = state.where("batch_id IS NOT NULL").select("record_id", "batch_id")
    undone = members.join(batches.select("batch_id"), "batch_id", "left_semi")
    return as_events(undone.withColumn("event", F.lit("reset")).withColumn("seq", F.lit(seq)))


def failed_batches(batches: DataFrame) -> DataFrame:
    return batches.where(F.col("state").isin(*RESET_STATES))


def cancel_batches(batches: DataFrame, batch_ids: DataFrame) -> DataFrame:
    """Batches after cancelling or deleting the given ids: those become FAILED."""
    hit = batch_ids.select("batch_id").distinct().withColumn("_hit", F.lit(True))
    state = F.when(F.col("_hit"), "FAILED").otherwise(F.col("state"))
    return batches.join(hit, "batch_id", "left").withColumn("state", state).drop("_hit")


# Selections over the folded state.


def pending_images(state: DataFrame) -> DataFrame:
    return state.where(F.col("image_status") == "pending")


def embeddable(state: DataFrame, modality: str = "multimodal", max_attempts: int = 3) -> DataFrame:
    """Records ready for a shard; anything but plain text also needs its image."""
    ready = (F.col("embed_status") == "pending") & (F.col("embed_attempts") < max_attempts)
    if modality != "text":
        ready &= F.col("image_status") == "ok"
    return state.where(ready)


def upsert_pending(state: DataFrame) -> DataFrame:
    return state.where((F.col("upsert_status") == "pending") & (F.col("embed_status") == "ok"))


def pending_shards(batches: DataFrame) -> DataFrame:
    return batches.where(F.col("state") == "PENDING")


def active_batches(batches: DataFrame) -> DataFrame:
    return batches.where(F.col("state").isin(*ACTIVE_STATES))


def succeeded_batches(batches: DataFrame) -> DataFrame:
    return batches.where(F.col("state") == "SUCCEEDED")


# Reports over the folded state.


def status_counts(state: DataFrame) -> DataFrame:
    """One row of totals; an empty table counts zero everywhere."""
    return state.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("image_status") == "ok").alias("image_ok"),
        F.count_if(F.col("image_status").startswith("failed")).alias("image_failed"),
        F.count_if(F.col("embed_status") == "ok").alias("embed_ok"),
        F.count_if(F.col("embed_status") == "failed").alias("embed_failed"),
        F.count_if(F.col("upsert_status") == "ok").alias("upserted"),
    )


def batch_states(batches: DataFrame) -> DataFrame:
    return batches.groupBy("state").agg(F.count(F.lit(1)).alias("n"))
