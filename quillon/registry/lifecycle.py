"""Queries over record and batch state."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillon.operators import state as st
from quillon.operators.dedupe import first_write_wins, insert_or_ignore, last_write_wins
from quillon.operators.jobs import job_board, latest_states, merge_states
from quillon.operators.verify import metric_rows
from quillon.registry.fixtures import (
    LIFECYCLE_EVENTS_SQL, LINE_ORDER, LINE_STATES_SQL, ORDER_BATCHES_SQL,
    lifecycle_events, line_states, order_batches, table,
)


def insert_ignore(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    state = lines.where("l_linestatus = 'F'").select(*keys).distinct()
    return insert_or_ignore(state, lines, keys, LINE_ORDER).select(
        *keys, "l_partkey", "l_suppkey", "l_quantity", "l_returnflag"
    )


def first_wins(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    return first_write_wins(turns, ["conv_id"], ["turn", "role", "text"]).select("conv_id", "turn", "text")


def last_wins(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return last_write_wins(events, ["user_id"], ["ts", "event_id"]).select(
        "user_id", "event_id", "event_type", "value"
    )


STATE_COLUMNS = [c for c in st.STATE_COLUMNS]


def lifecycle_fold(spark, sf_dir):
    return st.fold_events(lifecycle_events(spark, sf_dir)).select(*STATE_COLUMNS)


def lifecycle_increment(spark, sf_dir):
    """The log folded in two steps; later events include inserts of unseen records."""
    log = lifecycle_events(spark, sf_dir)
    cut = log.agg((F.max("seq") / 2).cast("long")).scalar()
    early, late = log.where(F.col("seq") <= cut), log.where(F.col("seq") > cut)
    inserts = late.select("record_id").distinct().select(
        "record_id", F.lit(-1).cast("long").alias("seq"), F.lit("insert").alias("event")
    )
    state = st.fold_events(early)
    newer = late.unionByName(st.as_events(inserts))
    return st.apply_events(state, newer).select(*STATE_COLUMNS)


def eligible_text(spark, sf_dir):
    state = line_states(spark, sf_dir)
    return st.embeddable(state, "text").select("record_id", "l_partkey", "l_suppkey").orderBy("record_id")


def eligible_image(spark, sf_dir):
    state = line_states(spark, sf_dir)
    return st.embeddable(state, "multimodal").select("record_id", "l_partkey", "l_suppkey").orderBy("record_id")


def pending_images(spark, sf_dir):
    return st.pending_images(line_states(spark, sf_dir)).groupBy("shard_id").agg(
        F.count(F.lit(1)).alias("n")
    )


def upsert_pending(spark, sf_dir):
    return st.upsert_pending(line_states(spark, sf_dir)).groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("l_partkey").alias("first_part")
    )


def status_counts(spark, sf_dir):
    return st.status_counts(line_states(spark, sf_dir))


def status_metrics(spark, sf_dir):
    return metric_rows(st.status_counts(line_states(spark, sf_dir)))


def batch_states(spark, sf_dir):
    return st.batch_states(order_batches(spark, sf_dir))


def batch_selections(spark, sf_dir):
    batches = order_batches(spark, sf_dir)
    parts = {
        "pending": st.pending_shards(batches),
        "active": st.active_batches(batches),
        "succeeded": st.succeeded_batches(batches),
        "failed": st.failed_batches(batches),
    }
    union = None
    for name, part in parts.items():
        row = part.agg(
            F.lit(name).alias("selection"), F.count(F.lit(1)).alias("n"),
            F.sum("est_tokens").alias("tokens"), F.min("shard_id").alias("first_shard"),
        )
        union = row if union is None else union.unionByName(row)
    return union


def batch_reset(spark, sf_dir):
    """Failed batches put their lines back to pending."""
    state = line_states(spark, sf_dir).withColumn("image_sha", F.lit(None).cast("string")).withColumn(
        "updated_seq", F.lit(0).cast("long")
    )
    state = state.select("l_partkey", *STATE_COLUMNS)
    unique = first_write_wins(state, ["record_id"], ["l_partkey", "embed_status", "image_status"])
    failed = st.failed_batches(order_batches(spark, sf_dir))
    events = st.reset_events(unique, failed, seq=1)
    return st.apply_events(unique.drop("l_partkey"), events).groupBy(
        "embed_status", "embed_attempts", F.col("batch_id").isNull().alias("cleared")
    ).agg(F.count(F.lit(1)).alias("n"), F.count("shard_id").alias("n_sharded"))


def submit_members(spark, sf_dir):
    """Newly submitted batches reach the records of their shards."""
    state = line_states(spark, sf_dir)
    submitted = order_batches(spark, sf_dir).where("state = 'SUBMITTED'").select(
        "shard_id", F.concat(F.lit("job/"), "shard_id").alias("batch_id")
    )
    return st.submit_events(state, submitted, seq=7).select("record_id", "seq", "event", "batch_id")


def cancelled_batches(spark, sf_dir):
    """Submitted batches are cancelled and become FAILED."""
    batches = order_batches(spark, sf_dir)
    cancelled = st.cancel_batches(batches, batches.where("state = 'SUBMITTED'").select("batch_id"))
    return st.batch_states(cancelled)


def _polls(spark, sf_dir):
    kind = F.col("event_type")
    job = (
        F.when(kind == "signup", "JOB_STATE_PENDING").when(kind == "view", "JOB_STATE_RUNNING")
        .when((kind == "purchase") & (F.col("value") > 90), "JOB_STATE_SUCCEEDED")
        .when((kind == "error") & (F.col("value") > 120), "JOB_STATE_CANCELLED")
        .when((kind == "error") & (F.col("value") > 100), "JOB_STATE_EXPIRED")
        .otherwise("JOB_STATE_QUEUED")
    )
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("batch_id"),
        F.col("event_id").alias("seq"),
        job.alias("job_state"),
    )


def job_states(spark, sf_dir):
    return latest_states(_polls(spark, sf_dir)).select("batch_id", "state", "seq", "terminal")


def job_states_merged(spark, sf_dir):
    """Polls of even and odd event ids folded apart, then merged."""
    polls = _polls(spark, sf_dir)
    even = F.pmod("seq", F.lit(2)) == 0
    merged = merge_states(latest_states(polls.where(even)), latest_states(polls.where(~even)))
    return merged.select("batch_id", "state", "seq", "terminal")


def board(spark, sf_dir):
    customers = table(spark, sf_dir, "orders")
    jobs = customers.select(
        F.concat(F.lit("batches/"), F.col("o_orderkey").cast("string")).alias("batch_id"),
        F.concat(F.lit("shard-"), F.col("o_orderkey").cast("string")).alias("display_name"),
        F.when(F.col("o_orderstatus") == "F", "JOB_STATE_SUCCEEDED")
        .when(F.col("o_orderstatus") == "O", "JOB_STATE_RUNNING").otherwise("JOB_STATE_PENDING")
        .alias("job_state"),
    )
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.max(F.col("l_linestatus") == "F").alias("closed")
    )
    batches = lines.select(
        F.concat(F.lit("batches/"), F.col("l_orderkey").cast("string")).alias("batch_id"),
        F.when(F.col("closed"), "F").otherwise("O").alias("state"),
    )
    return job_board(jobs, batches)


QUERIES = {
    "insert_ignore": insert_ignore,
    "first_write_wins": first_wins,
    "last_write_wins": last_wins,
    "lifecycle_fold": lifecycle_fold,
    "lifecycle_increment": lifecycle_increment,
    "eligible_text": eligible_text,
    "eligible_image": eligible_image,
    "pending_images": pending_images,
    "upsert_pending": upsert_pending,
    "status_counts": status_counts,
    "status_metrics": status_metrics,
    "batch_states": batch_states,
    "batch_selections": batch_selections,
    "batch_reset": batch_reset,
    "submit_members": submit_members,
    "cancelled_batches": cancelled_batches,
    "job_states": job_states,
    "job_states_merged": job_states_merged,
    "job_board": board,
}

REPLAY_SQL = f"""
  WITH log AS ({LIFECYCLE_EVENTS_SQL}),
  lists AS (
    SELECT record_id, max(seq) AS updated_seq,
           list({{'event': event, 'image_status': image_status, 'image_sha': image_sha,
                  'shard_id': shard_id, 'batch_id': batch_id}} ORDER BY seq) AS events
    FROM log GROUP BY 1),
  replayed AS (
    SELECT record_id, updated_seq, list_reduce(
      list_transform(events, lambda e: {{'e': e, 'image_status': 'pending', 'image_sha': NULL::VARCHAR,
        'embed_status': 'pending', 'embed_attempts': 0, 'batch_id': NULL::VARCHAR,
        'shard_id': NULL::BIGINT, 'upsert_status': 'pending'}}),
      lambda a, x: {{'e': x.e,
        'image_status': CASE WHEN x.e.event = 'image' THEN x.e.image_status ELSE a.image_status END,
        'image_sha': CASE WHEN x.e.event = 'image' THEN x.e.image_sha ELSE a.image_sha END,
        'embed_status': CASE x.e.event WHEN 'assign' THEN 'in_batch' WHEN 'embed_ok' THEN 'ok'
           WHEN 'embed_failed' THEN 'failed' WHEN 'reset' THEN 'pending' ELSE a.embed_status END,
        'embed_attempts': a.embed_attempts + CASE WHEN x.e.event IN ('embed_failed', 'reset') THEN 1 ELSE 0 END,
        'batch_id': CASE x.e.event WHEN 'submit' THEN x.e.batch_id WHEN 'reset' THEN NULL ELSE a.batch_id END,
        'shard_id': CASE x.e.event WHEN 'assign' THEN x.e.shard_id WHEN 'reset' THEN NULL ELSE a.shard_id END,
        'upsert_status': CASE WHEN x.e.event = 'upsert' THEN 'ok' ELSE a.upsert_status END}},
      {{'e': events[1], 'image_status': 'pending', 'image_sha': NULL::VARCHAR,
        'embed_status': 'pending', 'embed_attempts': 0, 'batch_id': NULL::VARCHAR,
        'shard_id': NULL::BIGINT, 'upsert_status': 'pending'}}) AS s
    FROM lists)
  SELECT record_id, s.image_status, s.image_sha, s.embed_status, s.embed_attempts, s.batch_id,
         s.shard_id, s.upsert_status, updated_seq FROM replayed"""

POLLS_SQL = """
  SELECT user_id::VARCHAR AS batch_id, event_id AS seq,
         CASE WHEN event_type = 'signup' THEN 'SUBMITTED' WHEN event_type = 'view' THEN 'RUNNING'
              WHEN event_type = 'purchase' AND value > 90 THEN 'SUCCEEDED'
              WHEN event_type = 'error' AND value > 120 THEN 'FAILED'
              WHEN event_type = 'error' AND value > 100 THEN 'EXPIRED' ELSE 'RUNNING' END AS state,
         (event_type = 'purchase' AND value > 90) OR (event_type = 'error' AND value > 100) AS ended
  FROM events"""

JOB_STATES_SQL = f"""
  SELECT batch_id, coalesce(arg_min(state, seq) FILTER (WHERE ended), arg_max(state, seq)) AS state,
         coalesce(min(seq) FILTER (WHERE ended), max(seq)) AS seq, bool_or(ended) AS terminal
  FROM ({POLLS_SQL}) GROUP BY 1"""

UNIQUE_LINES_SQL = f"""
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY record_id
      ORDER BY l_partkey, embed_status, image_status) AS rn FROM ({LINE_STATES_SQL})) WHERE rn = 1"""

ORACLES = {
    "insert_ignore": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag FROM (
          SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey,
            l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) AS rn
          FROM lineitem) a
        WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM lineitem s WHERE s.l_linestatus = 'F'
          AND s.l_orderkey = a.l_orderkey AND s.l_linenumber = a.l_linenumber)""",
    "first_write_wins": """
        SELECT conv_id, turn, text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id
          ORDER BY turn, role, text) AS rn FROM conversations) WHERE rn = 1""",
    "last_write_wins": """
        SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (
          PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
    "lifecycle_fold": REPLAY_SQL,
    "lifecycle_increment": REPLAY_SQL,
    "eligible_text": f"""
        SELECT record_id, l_partkey, l_suppkey FROM ({LINE_STATES_SQL})
        WHERE embed_status = 'pending' AND embed_attempts < 3 ORDER BY record_id""",
    "eligible_image": f"""
        SELECT record_id, l_partkey, l_suppkey FROM ({LINE_STATES_SQL})
        WHERE embed_status = 'pending' AND image_status = 'ok' AND embed_attempts < 3 ORDER BY record_id""",
    "pending_images": f"""
        SELECT shard_id, count(*) AS n FROM ({LINE_STATES_SQL}) WHERE image_status = 'pending' GROUP BY 1""",
    "upsert_pending": f"""
        SELECT batch_id, count(*) AS n, min(l_partkey) AS first_part FROM ({LINE_STATES_SQL})
        WHERE upsert_status = 'pending' AND embed_status = 'ok' GROUP BY 1""",
    "status_counts": f"""
        SELECT count(*) AS total, count(*) FILTER (WHERE image_status = 'ok') AS image_ok,
               count(*) FILTER (WHERE image_status LIKE 'failed%') AS image_failed,
               count(*) FILTER (WHERE embed_status = 'ok') AS embed_ok,
               count(*) FILTER (WHERE embed_status = 'failed') AS embed_failed,
               count(*) FILTER (WHERE upsert_status = 'ok') AS upserted
        FROM ({LINE_STATES_SQL})""",
    "status_metrics": f"""
        SELECT 'total' AS metric, count(*) AS count FROM lineitem
        UNION ALL SELECT 'image_ok', count(*) FROM lineitem WHERE l_returnflag = 'A'
        UNION ALL SELECT 'image_failed', count(*) FROM lineitem WHERE l_returnflag = 'N'
        UNION ALL SELECT 'embed_ok', count(*) FROM lineitem WHERE l_linestatus = 'F'
        UNION ALL SELECT 'embed_failed', 0
        UNION ALL SELECT 'upserted', count(*) FROM lineitem WHERE l_returnflag = 'R'""",
    "batch_states": f"SELECT state, count(*) AS n FROM ({ORDER_BATCHES_SQL}) GROUP BY 1",
    "batch_selections": f"""
        SELECT CASE state WHEN 'PENDING' THEN 'pending' WHEN 'SUBMITTED' THEN 'active'
                 WHEN 'SUCCEEDED' THEN 'succeeded' ELSE 'failed' END AS selection,
               count(*) AS n, sum(est_tokens)::BIGINT AS tokens, min(shard_id) AS first_shard
        FROM ({ORDER_BATCHES_SQL}) GROUP BY 1""",
    "batch_reset": f"""
        WITH u AS ({UNIQUE_LINES_SQL}), f AS (SELECT batch_id FROM ({ORDER_BATCHES_SQL}) WHERE state = 'FAILED'),
        r AS (SELECT u.*, u.batch_id IN (SELECT batch_id FROM f) AS hit FROM u)
        SELECT CASE WHEN hit THEN 'pending' ELSE embed_status END AS embed_status,
               embed_attempts + hit::INTEGER AS embed_attempts, hit AS cleared,
               count(*) AS n, count(CASE WHEN NOT hit THEN shard_id END) AS n_sharded
        FROM r GROUP BY 1, 2, 3""",
    "submit_members": f"""
        SELECT record_id, 7 AS seq, 'submit' AS event, 'job/' || s.shard_id AS batch_id
        FROM ({LINE_STATES_SQL}) s JOIN ({ORDER_BATCHES_SQL}) b
          ON s.shard_id = b.shard_id AND b.state = 'SUBMITTED'""",
    "cancelled_batches": f"""
        SELECT CASE state WHEN 'SUBMITTED' THEN 'FAILED' ELSE state END AS state, count(*) AS n
        FROM ({ORDER_BATCHES_SQL}) GROUP BY 1""",
    "job_states": JOB_STATES_SQL,
    "job_states_merged": JOB_STATES_SQL,
    "job_board": """
        SELECT 'batches/' || o_orderkey AS batch_id, 'shard-' || o_orderkey AS display_name,
               CASE o_orderstatus WHEN 'F' THEN 'JOB_STATE_SUCCEEDED' WHEN 'O' THEN 'JOB_STATE_RUNNING'
                    ELSE 'JOB_STATE_PENDING' END AS job_state,
               coalesce(s, '—') AS local_state
        FROM orders LEFT JOIN (SELECT l_orderkey, min(l_linestatus) AS s FROM lineitem GROUP BY 1)
          ON l_orderkey = o_orderkey""",
}
