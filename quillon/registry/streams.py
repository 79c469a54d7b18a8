"""Queries that run as Structured Streaming over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillon.config import DatasetSpec, PayloadSpec
from quillon.functions.vectors import l2_norm
from quillon.registry.fixtures import DIM, line_id, result_lines, table
from quillon.registry.lifecycle import JOB_STATES_SQL, _polls
from quillon.registry.results import ORACLES as RESULT_ORACLES, _records
from quillon.session import fresh_path
from quillon.sources.results import write_result_files
from quillon.streaming.collect import collect_stream
from quillon.streaming.expiry import expiry_stream
from quillon.streaming.ingest import ingest_stream
from quillon.streaming.status import status_stream


def stream_collect(spark, sf_dir):
    """Result files arrive in two waves, the first before its batches are known."""
    lines = result_lines(spark, sf_dir)
    folder, vectors, checkpoint = (fresh_path(spark, n) for n in ("arriving", "vectors", "offsets"))
    batches = lines.select("batch_id").distinct()
    collected = None
    for wave, known in ((F.col("label") < 5, batches.where("false")), (F.col("label") >= 5, batches)):
        write_result_files(lines.withColumn("label", F.col("batch_id").substr(9, 9).cast("int")).where(wave), folder)
        collected = collect_stream(
            spark, folder, vectors, checkpoint, _records(spark, sf_dir), known, DIM, files_per_trigger=3
        )
    return collected.select(
        "batch_id", "record_id", "point_id", "known",
        F.size("vector").alias("dim"), F.round(l2_norm(F.col("vector")), 4).alias("norm"),
    )


def stream_status(spark, sf_dir):
    polls = fresh_path(spark, "polls")
    _polls(spark, sf_dir).repartition(6, "seq").write.parquet(polls)
    stream = (
        spark.readStream.schema("batch_id string, seq bigint, job_state string")
        .option("maxFilesPerTrigger", 2).parquet(polls)
    )
    states = status_stream(stream, fresh_path(spark, "states"), fresh_path(spark, "offsets"))
    return states.select("batch_id", "state", "seq", "terminal")


TIMEOUT_SECONDS, DELAY_SECONDS = 2 * 86400, 3600


def stream_expiry(spark, sf_dir):
    """Polls by the hour they were made, half an hour out of order; the query stops halfway and goes on."""
    source = fresh_path(spark, "polls")
    polls = _polls(spark, sf_dir).join(
        table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), F.col("ts").cast("timestamp").alias("at")), "seq")
    arrival = F.col("at").cast("double") + F.pmod("seq", F.lit(2)) * 1800
    states, offsets = fresh_path(spark, "ended"), fresh_path(spark, "offsets")
    middle = F.lit("2024-01-16").cast("timestamp").cast("double")
    ended = None
    for wave in (arrival < middle, arrival >= middle):
        polls.where(wave).repartitionByRange(4, arrival).write.mode("append").parquet(source)
        stream = spark.readStream.schema(polls.schema).parquet(source)
        ended = expiry_stream(stream, states, offsets, timeout_seconds=TIMEOUT_SECONDS, delay_seconds=DELAY_SECONDS)
    return ended.select(
        "batch_id", "state", F.unix_millis("ended_at").alias("ended_ms"), F.unix_millis("last_poll_at").alias("last_poll_ms")
    )


def stream_ingest(spark, sf_dir):
    """Order lines arrive in several files; ids repeat within and across them."""
    source = fresh_path(spark, "lines")
    lines = table(spark, sf_dir, "lineitem").select(line_id().alias("id"), "l_orderkey")
    lines.repartition(6).write.parquet(source)
    spec = DatasetSpec(dataset="lines", id_column="id", text_template="order {l_orderkey}", modality="text",
                       payload=PayloadSpec(include=("l_orderkey",)))
    stream = spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", 2).parquet(source)
    records = ingest_stream(stream, spec, fresh_path(spark, "records"), fresh_path(spark, "offsets"))
    return records.select("record_id", "text", "payload")


QUERIES = {
    "stream_collect": stream_collect,
    "stream_status": stream_status,
    "stream_expiry": stream_expiry,
    "stream_ingest": stream_ingest,
}

ORACLES = {
    "stream_collect": RESULT_ORACLES["collect_join"],
    "stream_status": JOB_STATES_SQL,
    "stream_expiry": f"""
        WITH p AS (SELECT user_id::VARCHAR AS batch_id, event_id AS seq, date_trunc('milliseconds', ts) AS made,
                     CASE WHEN event_type = 'purchase' AND value > 90 THEN 'SUCCEEDED'
                          WHEN event_type = 'error' AND value > 120 THEN 'FAILED'
                          WHEN event_type = 'error' AND value > 100 THEN 'EXPIRED' END AS final
                   FROM events WHERE user_id IS NOT NULL AND event_id IS NOT NULL AND ts IS NOT NULL),
        w AS (SELECT max(made) - INTERVAL {DELAY_SECONDS} SECOND AS mark FROM p),
        n AS (SELECT *, lead(made) OVER (PARTITION BY batch_id ORDER BY made, seq) AS following FROM p),
        e AS (SELECT batch_id, final AS state, made AS ended_at, made AS last_poll_at, seq FROM n WHERE final IS NOT NULL
              UNION ALL
              SELECT batch_id, 'EXPIRED', made + INTERVAL {TIMEOUT_SECONDS} SECOND, made, NULL FROM n
              WHERE following IS NULL OR following > made + INTERVAL {TIMEOUT_SECONDS} SECOND),
        f AS (SELECT *, row_number() OVER (PARTITION BY batch_id ORDER BY ended_at, seq) AS place FROM e)
        SELECT batch_id, state, epoch_ms(ended_at) AS ended_ms, epoch_ms(last_poll_at) AS last_poll_ms
        FROM f, w WHERE place = 1 AND ended_at < mark""",
    "stream_ingest": """
        SELECT DISTINCT l_orderkey || '-' || l_linenumber AS record_id, 'order ' || l_orderkey AS text,
               '{"l_orderkey":' || l_orderkey || '}' AS payload FROM lineitem""",
}
