"""Queries over audits, cleanup and status reports."""

from __future__ import annotations

import functools

from pyspark.sql import functions as F

from quillon.config import Limits
from quillon.operators import cleanup as cl
from quillon.operators import orphans as orp
from quillon.operators import state as st
from quillon.operators import verify as vf
from quillon.operators.embed import hashed_words
from quillon.operators.normalize import normalize
from quillon.plans.workspace import Workspace
from quillon.registry.fixtures import (
    DIM, LINE_STATES_SQL, ORDER_BATCHES_SQL, PRODUCTS, line_states, order_batches, table,
)
from quillon.session import fresh_path, materialize
from quillon.sources.files import list_files
from quillon.sources.packs import one_place, pack_index, write_packed
from quillon.sources.results import write_result_files


def _collection(spark, sf_dir):
    """Products with embeddings; all but PROMO parts are marked as stored."""
    records = normalize(table(spark, sf_dir, "part"), PRODUCTS)
    stored = F.when(F.col("p_type") != "PROMO", "ok").otherwise("pending")
    state = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("record_id"), F.lit("ok").alias("embed_status"),
        stored.alias("upsert_status"),
    )
    points = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("record_id"), F.col("embedding").alias("vector")
    ).join(records, "record_id").select("point_id", "record_id", "vector", "payload")
    return state, records, points


def count_match(spark, sf_dir):
    state, _, points = _collection(spark, sf_dir)
    return vf.count_match(state, points)


def spot_check(spark, sf_dir):
    return vf.spot_check(*_collection(spark, sf_dir))


def verify_report(spark, sf_dir):
    state, records, points = _collection(spark, sf_dir)
    report = vf.count_match(state, points).unionByName(vf.spot_check(state, records, points))
    return report.unionByName(vf.self_search_check(points, DIM)).unionByName(
        vf.skipped_check("cross_modal", spark)
    )


def cleanup_shards(spark, sf_dir):
    return cl.eligible_shards(order_batches(spark, sf_dir), line_states(spark, sf_dir))


def cleanup_results(spark, sf_dir):
    return cl.eligible_results(order_batches(spark, sf_dir), line_states(spark, sf_dir))


def _files(spark, sf_dir):
    """File sizes derived from the tables: shards by line count, results by price, pages as images."""
    orders = table(spark, sf_dir, "orders")
    shard = orders.select(
        F.concat(F.lit("shard_"), F.col("o_orderkey").cast("string")).alias("file_name"),
        (F.col("o_orderkey") + 100).alias("length"), "o_orderpriority",
    )
    result = orders.select(
        F.concat(F.lit("batches_"), F.col("o_orderkey").cast("string"), F.lit(".jsonl")).alias("file_name"),
        F.floor("o_totalprice").cast("long").alias("length"), "o_orderpriority",
    )
    image = table(spark, sf_dir, "pages").select(
        F.concat(F.sha2("html", 256), F.lit(".jpg")).alias("file_name"),
        F.octet_length("html").cast("long").alias("length"),
    )
    # Some files are gone already.
    there = F.col("o_orderpriority") != "5-LOW"
    return shard.where(there), result.where(there), image


def reclaimable(spark, sf_dir):
    shard, result, image = _files(spark, sf_dir)
    return cl.reclaimable(order_batches(spark, sf_dir), line_states(spark, sf_dir), shard, result, image)


def reclaimable_images(spark, sf_dir):
    shard, result, image = _files(spark, sf_dir)
    return cl.reclaimable(
        order_batches(spark, sf_dir), line_states(spark, sf_dir), shard, result, image, "images"
    )


def file_listing(spark, sf_dir):
    """Result files written for batches with odd names, listed by artifact."""
    folder = fresh_path(spark, "listed")
    lines = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("jobs:é/a=b%x "), "o_orderpriority").alias("batch_id"),
        F.col("o_orderkey").cast("string").alias("value"),
    )
    write_result_files(lines, folder)
    return cl.artifact_files(list_files(spark, folder, "*.txt"))


def orphans(spark, sf_dir):
    """What crashed epochs, unread packs and unused blobs of a store made from tables hold.

    Two of five order epochs were never committed; texts of every third document are stored
    once more by a write whose entries are not used, and those of Latin documents by none.
    """
    root, committed = fresh_path(spark, "store"), spark.createDataFrame([(1,), (2,), (4,)], "epoch bigint")
    orders = table(spark, sf_dir, "orders").select(F.left("o_orderpriority", F.lit(1)).cast("long").alias("epoch"), F.col("o_orderkey").cast("string").alias("value"))
    orders.write.partitionBy("epoch").text(f"{root}/orders")
    docs = table(spark, sf_dir, "documents").select(F.sha2("text", 256).alias("key"), F.encode("text", "UTF-8").alias("content"), "doc_id", "lang")
    docs = docs.where("content IS NOT NULL")
    write_packed(docs, f"{root}/blobs")
    write_packed(docs.where("doc_id % 3 = 0").select(F.concat(F.lit("unused "), "key").alias("key"), "content"), f"{root}/blobs")
    index = pack_index(spark, f"{root}/blobs")
    places, used = one_place(index), docs.where("lang <> 'de'").select("key")
    files = orp.stored_files(spark, root)
    later = 1 << 50
    packs = places.join(used.distinct(), "key", "left_semi").select("pack")
    found = orp.orphan_epochs(files, committed, later).unionByName(orp.orphan_packs(files, packs, later))
    return found.unionByName(orp.orphan_entries(index, places, used)).groupBy("kind").agg(
        F.count_if(F.col("kind") != "pack").alias("n"), F.sum("bytes").alias("bytes"))


def status_report(spark, sf_dir):
    """Record metrics and batches by state in one table."""
    metrics = vf.metric_rows(st.status_counts(line_states(spark, sf_dir))).select(
        F.lit("records").alias("section"), F.col("metric").alias("name"), "count"
    )
    states = st.batch_states(order_batches(spark, sf_dir)).select(
        F.lit("batches").alias("section"), F.col("state").alias("name"), F.col("n").alias("count")
    )
    return metrics.unionByName(states)


def workspace_report(spark, sf_dir):
    """Products through every step of a workspace, embedded in Spark, then reported."""
    root, results = fresh_path(spark, "workspace"), fresh_path(spark, "results")
    limits = Limits(embedding_dim=64, records_per_shard=500, max_concurrent_jobs=100,
                    max_enqueued_tokens=100_000_000)
    ws = Workspace(spark, root, PRODUCTS, limits)
    ws.ingest(table(spark, sf_dir, "part"), ["p_partkey"])
    ws.build_shards()
    # The limits bound a round, not the table: rounds follow until no shard is admitted.
    while not (admitted := materialize(ws.admit(), "admitted")).isEmpty():
        ws.submitted(admitted.select("shard_id", F.concat(F.lit("jobs/"), "shard_id").alias("batch_id")))
        ws.polled(ws.embed(functools.partial(hashed_words, 64), results))
    ws.collect(results)
    ws.upsert()
    metrics, states = ws.status()
    checks = ws.verify(functools.partial(hashed_words, 64))
    return metrics.select(F.col("metric").alias("name"), F.col("count").cast("long").alias("count")).unionByName(
        states.select(F.col("state").alias("name"), F.col("n").alias("count"))
    ).unionByName(checks.where("check IN ('count_match', 'spot_check')").select(
        F.concat_ws(" ", "check", "status").alias("name"), F.col("ok").alias("count")
    ))


QUERIES = {
    "status_report": status_report,
    "workspace_report": workspace_report,
    "count_match": count_match,
    "spot_check": spot_check,
    "verify_report": verify_report,
    "cleanup_eligible_shards": cleanup_shards,
    "cleanup_eligible_results": cleanup_results,
    "reclaimable": reclaimable,
    "reclaimable_images": reclaimable_images,
    "file_listing": file_listing,
    "orphans": orphans,
}

_COUNT_SQL = """
  SELECT 'count_match' AS "check", CASE WHEN a = b THEN 'PASS' ELSE 'FAIL' END AS status, a AS ok, b AS n
  FROM (SELECT (SELECT count(*) FROM part WHERE p_type <> 'PROMO') AS a,
               (SELECT count(*) FROM part JOIN embeddings ON vec_id = p_partkey) AS b)"""

_SPOT_SQL = """
  SELECT 'spot_check' AS "check", CASE WHEN count(*) = count(vec_id) THEN 'PASS' ELSE 'WARN' END AS status,
         count(vec_id) AS ok, count(*) AS n
  FROM (SELECT p_partkey FROM part WHERE p_type <> 'PROMO'
        ORDER BY md5('42:' || p_partkey), p_partkey::VARCHAR LIMIT 100)
  LEFT JOIN embeddings ON vec_id = p_partkey"""

_SELF_SQL = """
  WITH p AS (SELECT vec_id::VARCHAR AS id, embedding::DOUBLE[] AS v FROM part JOIN embeddings ON vec_id = p_partkey),
  s AS (SELECT id AS q, v AS qv FROM p ORDER BY md5('42:' || id), id LIMIT 20),
  t AS (SELECT q, arg_max(id, score) AS id, max(score) AS score
        FROM (SELECT q, id, round(list_cosine_similarity(qv, v), 9) AS score FROM s CROSS JOIN p) GROUP BY q)
  SELECT 'self_search' AS "check",
         CASE WHEN count(*) = count(*) FILTER (WHERE q = id AND score > 0.99) THEN 'PASS' ELSE 'WARN' END AS status,
         count(*) FILTER (WHERE q = id AND score > 0.99) AS ok, count(*) AS n FROM t"""

_SHARDS_SQL = f"""
  SELECT b.shard_id, b.request_file, count(*) AS members
  FROM ({ORDER_BATCHES_SQL}) b JOIN ({LINE_STATES_SQL}) r ON r.shard_id = b.shard_id
  GROUP BY 1, 2 HAVING count(*) = count(*) FILTER (WHERE r.embed_status = 'ok')"""

_RESULTS_SQL = f"""
  SELECT b.batch_id, replace(b.batch_id, '/', '_') || '.jsonl' AS result_file, count(*) AS members
  FROM ({ORDER_BATCHES_SQL}) b JOIN ({LINE_STATES_SQL}) r ON r.batch_id = b.batch_id
  WHERE b.state = 'SUCCEEDED'
  GROUP BY 1, 2 HAVING count(*) = count(*) FILTER (WHERE r.upsert_status = 'ok')"""

_IMAGES_SQL = """
  SELECT 'images' AS artifact, count(*) AS eligible, count(*) AS total, 0::BIGINT AS skipped,
         sum(octet_length(encode(html)))::BIGINT AS bytes FROM pages"""

ORACLES = {
    "status_report": f"""
        SELECT 'records' AS section, 'total' AS name, count(*) AS count FROM lineitem
        UNION ALL SELECT 'records', 'image_ok', count(*) FROM lineitem WHERE l_returnflag = 'A'
        UNION ALL SELECT 'records', 'image_failed', count(*) FROM lineitem WHERE l_returnflag = 'N'
        UNION ALL SELECT 'records', 'embed_ok', count(*) FROM lineitem WHERE l_linestatus = 'F'
        UNION ALL SELECT 'records', 'embed_failed', 0
        UNION ALL SELECT 'records', 'upserted', count(*) FROM lineitem WHERE l_returnflag = 'R'
        UNION ALL SELECT 'batches', state, count(*) FROM ({ORDER_BATCHES_SQL}) GROUP BY state""",
    "workspace_report": """
        WITH n AS (SELECT count(*) AS n FROM part)
        SELECT name, CASE WHEN name IN ('image_ok', 'image_failed', 'embed_failed') THEN 0
                          WHEN name = 'SUCCEEDED' THEN ceil(n / 500)::BIGINT
                          WHEN name = 'spot_check PASS' THEN least(n, 100) ELSE n END::BIGINT AS count
        FROM n CROSS JOIN (VALUES ('total'), ('image_ok'), ('image_failed'), ('embed_ok'), ('embed_failed'),
                                  ('upserted'), ('SUCCEEDED'), ('count_match PASS'), ('spot_check PASS')) t(name)""",
    "count_match": _COUNT_SQL,
    "spot_check": _SPOT_SQL,
    "verify_report": f"""
        SELECT * FROM ({_COUNT_SQL}) UNION ALL SELECT * FROM ({_SPOT_SQL})
        UNION ALL SELECT * FROM ({_SELF_SQL}) UNION ALL SELECT 'cross_modal', 'SKIP', 0, 0""",
    "file_listing": """
        SELECT 'jobs:é_a=b%x ' || o_orderpriority || '.jsonl' AS file_name, sum(length(o_orderkey::VARCHAR) + 1)::BIGINT AS length
        FROM orders GROUP BY 1""",
    "orphans": """
        WITH d AS (SELECT text, strlen(text) AS size, count(*) AS copies, bool_or(lang <> 'de') AS used, count(*) FILTER (doc_id % 3 = 0) AS more
                   FROM documents GROUP BY text)
        SELECT 'epoch' AS kind, count(DISTINCT left(o_orderpriority, 1)) AS n, sum(length(o_orderkey::VARCHAR) + 1)::BIGINT AS bytes
        FROM orders WHERE left(o_orderpriority, 1) IN ('3', '5')
        UNION ALL SELECT 'blob', count(*) FILTER (copies > 1 OR NOT used), sum((copies - used::INTEGER) * size)::BIGINT FROM d
        UNION ALL SELECT 'pack', 0, sum(more * size)::BIGINT FROM d""",
    "cleanup_eligible_shards": _SHARDS_SQL,
    "cleanup_eligible_results": _RESULTS_SQL,
    "reclaimable": f"""
        SELECT 'shards' AS artifact, count(*) AS eligible, (SELECT count(*) FROM orders) AS total,
               (SELECT count(*) FROM orders) - count(*) AS skipped, coalesce(sum(o_orderkey + 100), 0)::BIGINT AS bytes
        FROM ({_SHARDS_SQL}) JOIN orders ON o_orderkey = shard_id WHERE o_orderpriority <> '5-LOW'
        UNION ALL
        SELECT 'results', count(*), (SELECT count(*) FROM orders WHERE o_orderstatus = 'F'),
               (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') - count(*),
               coalesce(sum(floor(o_totalprice)::BIGINT), 0)::BIGINT
        FROM ({_RESULTS_SQL}) JOIN orders ON 'batches/' || o_orderkey = batch_id WHERE o_orderpriority <> '5-LOW'
        UNION ALL {_IMAGES_SQL}""",
    "reclaimable_images": _IMAGES_SQL,
}
