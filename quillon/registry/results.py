"""Queries over result parsing, collection and points."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillon.functions.keys import point_id, result_file_name
from quillon.functions.vectors import l2_norm, norm_is_off, truncated
from quillon.operators import points as pt
from quillon.operators import results as rs
from quillon.operators.normalize import normalize
from quillon.operators.state import fold_events
from quillon.registry.fixtures import DIM, PRODUCTS, RESULT_CLASS_SQL, result_lines, table, vectors
from quillon.registry.records import uuid_sql
from quillon.session import fresh_path
from quillon.sources.lines import read_lines, with_line_numbers
from quillon.sources.results import attach_batches, read_result_lines, write_result_files
from quillon.sources.tables import read_vectors


def _parsed(spark, sf_dir):
    return rs.parse_result_lines(result_lines(spark, sf_dir), DIM)


def _records(spark, sf_dir):
    """Records for the embeddings of even labels; the others are unknown."""
    known = table(spark, sf_dir, "embeddings").where(F.col("label").isin(0, 2, 4, 6, 8))
    return known.select(F.col("vec_id").cast("string").alias("record_id"))


def parse_results(spark, sf_dir):
    return _parsed(spark, sf_dir).select(
        F.col("line_no").alias("vec_id"), "batch_id", "key", "error_class", "error_text",
        F.round("norm", 4).alias("norm"), "norm_warning",
    )


def result_split(spark, sf_dir):
    parsed = _parsed(spark, sf_dir)
    ok = rs.usable_results(parsed).select("key", F.lit("ok").alias("outcome"))
    failed = rs.failed_results(parsed).select("key", F.lit("failed").alias("outcome"))
    return ok.unionByName(failed)


def split_lines(spark, sf_dir):
    """Events written in order, a file for each type, and numbered from ranges of the files."""
    folder = fresh_path(spark, "lines")
    events = table(spark, sf_dir, "events").select(F.to_json(F.struct("*")).alias("value"), F.col("event_type").alias("type"), "event_id")
    placed = events.repartition("type").sortWithinPartitions("type", "event_id").select("value", "type")
    placed.write.partitionBy("type").text(folder)
    numbered = with_line_numbers(read_lines(spark, folder, range_bytes=1 << 16))
    return numbered.select(F.regexp_extract("file_path", "/type=([^/]+)/", 1).alias("event_type"), "number",
                           F.get_json_object("value", "$.event_id").cast("long").alias("event_id"))


def collect_totals(spark, sf_dir):
    return rs.collect_totals(_parsed(spark, sf_dir))


def error_classes(spark, sf_dir):
    return rs.embedding_errors(_parsed(spark, sf_dir))


def result_states(spark, sf_dir):
    """States after two collection runs of the same lines, the second with all wrong sizes."""
    lines = result_lines(spark, sf_dir)
    first = rs.result_events(rs.parse_result_lines(lines, DIM), run=1)
    second = rs.result_events(rs.parse_result_lines(lines, DIM // 2), run=2)
    state = fold_events(first.unionByName(second))
    return state.select("record_id", "embed_status", "embed_attempts", "updated_seq")


def collect_join(spark, sf_dir):
    collected = rs.collect_vectors(_parsed(spark, sf_dir), _records(spark, sf_dir))
    return collected.select(
        "batch_id", "record_id", "point_id", "known",
        F.size("vector").alias("dim"), F.round(l2_norm(F.col("vector")), 4).alias("norm"),
    )


def collect_rerun(spark, sf_dir):
    """Result files written, read back by name, appended, and collected a second time."""
    lines = result_lines(spark, sf_dir)
    path, out = fresh_path(spark, "results"), fresh_path(spark, "vectors")
    # Repeated lines: every batch's content twice.
    write_result_files(lines.unionByName(lines), path)
    batches = lines.select("batch_id").distinct()
    parsed = rs.parse_result_lines(attach_batches(read_result_lines(spark, path), batches), DIM)
    records = _records(spark, sf_dir)
    first = rs.collect_vectors(parsed, records)
    rs.append_vectors(first, out)
    again = rs.collect_vectors(parsed, records, read_vectors(spark, out))
    rs.append_vectors(again, out)
    stored = read_vectors(spark, out)
    return stored.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("known").alias("known"),
        F.count_distinct("record_id").alias("ids"),
    )


def result_files(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        result_file_name(F.concat(F.lit("batches/"), F.col("o_orderkey").cast("string"))).alias("name"),
    )


def _store(spark, sf_dir):
    """Products as records, embeddings as their vectors, collected twice."""
    records = normalize(table(spark, sf_dir, "part"), PRODUCTS)
    state = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("record_id"),
        F.when(F.col("p_size") < 45, "ok").otherwise("pending").alias("embed_status"),
        F.when(F.col("p_type") == "PROMO", "ok").otherwise("pending").alias("upsert_status"),
    )
    base = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("record_id"), F.col("embedding").alias("vector"), "label"
    )
    first = base.withColumn("seq", F.lit(1))
    second = base.where("label < 5").select(
        "record_id", F.transform("vector", lambda x: -x).alias("vector"), "label", F.lit(2).alias("seq")
    )
    return state, records, first.unionByName(second)


def _point_columns():
    return ["point_id", "record_id", F.round(F.col("vector")[0].cast("double"), 6).alias("first"),
            F.get_json_object("payload", "$.p_brand").alias("brand")]


def upsert_incoming(spark, sf_dir):
    state, records, stored = _store(spark, sf_dir)
    return pt.points_to_upsert(state, records, stored, ["seq"]).select(*_point_columns())


def upsert_skipped(spark, sf_dir):
    state, _, stored = _store(spark, sf_dir)
    return pt.upsert_skipped(state, stored).select("record_id")


def upsert_snapshot(spark, sf_dir):
    """A snapshot of first vectors takes the last vectors of pending records."""
    state, records, stored = _store(spark, sf_dir)
    old = stored.where("seq = 1").join(records.hint("merge"), "record_id").select(*pt.POINT_COLUMNS)
    incoming = pt.points_to_upsert(state, records, stored, ["seq"])
    return pt.upsert_points(old, incoming).select(*_point_columns())


def upsert_log(spark, sf_dir):
    """The same through a version log, with the second upsert run twice."""
    state, records, stored = _store(spark, sf_dir)
    old = stored.where("seq = 1").join(records.hint("merge"), "record_id").select(*pt.POINT_COLUMNS)
    incoming = pt.points_to_upsert(state, records, stored, ["seq"])
    store = pt.PointStore(spark, fresh_path(spark, "points"), int(spark.conf.get("spark.sql.shuffle.partitions")))
    store.write(old, 1, [])
    store.write(incoming, 2, [1])
    store.write(incoming, 2, [1])
    return store.current([1, 2]).select(*_point_columns())


def _accepting_writer():
    def write(rows):
        if not all(len(r["vector"]) == DIM for r in rows):
            raise ValueError("wrong size")

    return write


def deliver(spark, sf_dir):
    """Pending points handed to a store, in chunks, through its injected writer."""
    state, records, stored = _store(spark, sf_dir)
    incoming = pt.points_to_upsert(state, records, stored, ["seq"])
    return pt.deliver_points(incoming, _accepting_writer)


def typed_layout(spark, sf_dir):
    """Products stored by type with their typed payload, read through both kinds of filter."""
    records = normalize(table(spark, sf_dir, "part"), PRODUCTS).select("record_id", "point_id", "payload")
    path = fresh_path(spark, "typed")
    pt.write_typed_points(records, path, PRODUCTS.payload.indexes, ["p_type"])
    kept = spark.read.parquet(path).where(F.col("p_type").isin("PROMO", "ECONOMY") & (F.col("p_size") > 30))
    return kept.select("record_id", "p_type", "p_brand", "p_size", "p_retailprice")


def latest(spark, sf_dir):
    _, _, stored = _store(spark, sf_dir)
    return rs.latest_vectors(stored, ["seq"]).select("record_id", "seq")


def truncate_dim(spark, sf_dir):
    cut = vectors(spark, sf_dir).select("record_id", truncated(F.col("vector"), 16).alias("v"))
    return cut.select(
        "record_id", F.size("v").alias("dim"), F.round(l2_norm(F.col("v")), 4).alias("norm"),
        F.posexplode("v").alias("position", "x"),
    ).select("record_id", "dim", "norm", "position", F.round(F.col("x").cast("double"), 4).alias("x"))


def norm_check(spark, sf_dir):
    stretched = vectors(spark, sf_dir).select(
        "record_id",
        F.transform("vector", lambda x: x * (F.lit(0.9) + F.col("label") / 50.0)).alias("v"),
    )
    return stretched.select(
        "record_id", norm_is_off(F.col("v")).alias("off"), F.round(l2_norm(F.col("v")), 4).alias("norm")
    )


def point_keys(spark, sf_dir):
    """Keys of every text id: order lines and non-ASCII document openings."""
    docs = table(spark, sf_dir, "documents").select(F.col("text").alias("id"))
    return docs.select(F.md5("id").alias("id_md5"), point_id(F.col("id")).alias("point_id"))


QUERIES = {
    "parse_results": parse_results,
    "result_split": result_split,
    "split_lines": split_lines,
    "collect_totals": collect_totals,
    "error_classes": error_classes,
    "result_states": result_states,
    "collect_join": collect_join,
    "collect_rerun": collect_rerun,
    "result_file_names": result_files,
    "upsert_incoming": upsert_incoming,
    "upsert_skipped": upsert_skipped,
    "upsert_points": upsert_snapshot,
    "upsert_log": upsert_log,
    "deliver_points": deliver,
    "typed_layout": typed_layout,
    "latest_vectors": latest,
    "truncate_dim": truncate_dim,
    "norm_check": norm_check,
    "point_keys": point_keys,
}

_NORM = "sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * factor * x * factor)))"
_KEYED = "error_class IS NULL OR error_class NOT IN ('bad_json', 'missing_key')"
_KNOWN = "label IN (0, 2, 4, 6, 8)"

_INCOMING_SQL = f"""
  SELECT p_partkey, p_partkey::VARCHAR AS record_id, p_brand AS brand,
         CASE WHEN label < 5 THEN -1 ELSE 1 END * embedding[1]::DOUBLE AS first
  FROM part JOIN embeddings ON vec_id = p_partkey
  WHERE p_size < 45 AND p_type <> 'PROMO'"""

_SNAPSHOT_SQL = f"""
  SELECT {uuid_sql('p.p_partkey::VARCHAR')} AS point_id, p.p_partkey::VARCHAR AS record_id,
         round(coalesce(i.first, embedding[1]::DOUBLE), 6) AS first, p.p_brand AS brand
  FROM part p JOIN embeddings ON vec_id = p.p_partkey LEFT JOIN ({_INCOMING_SQL}) i ON i.p_partkey = p.p_partkey"""

ORACLES = {
    "split_lines": """
        SELECT event_type, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS number, event_id FROM events""",
    "parse_results": f"""
        SELECT vec_id, 'batches/' || label AS batch_id,
               CASE WHEN {_KEYED} THEN vec_id::VARCHAR END AS key, error_class,
               CASE WHEN error_class = 'error' THEN '{{"code":429}}' END AS error_text,
               CASE WHEN error_class IS NULL THEN round({_NORM}, 4) END AS norm,
               CASE WHEN error_class IS NULL THEN NOT ({_NORM} BETWEEN 0.95 AND 1.05) END AS norm_warning
        FROM ({RESULT_CLASS_SQL})""",
    "result_split": f"""
        SELECT vec_id::VARCHAR AS key, CASE WHEN error_class IS NULL THEN 'ok' ELSE 'failed' END AS outcome
        FROM ({RESULT_CLASS_SQL}) WHERE {_KEYED}""",
    "collect_totals": f"""
        SELECT count(*) FILTER (WHERE error_class IS NULL) AS vectors,
               count(*) FILTER (WHERE error_class IS NOT NULL AND ({_KEYED})) AS failures,
               count(*) FILTER (WHERE NOT ({_KEYED})) AS keyless,
               count(*) FILTER (WHERE error_class IS NULL AND NOT ({_NORM} BETWEEN 0.95 AND 1.05)) AS norm_warnings
        FROM ({RESULT_CLASS_SQL})""",
    "error_classes": f"""
        SELECT error_class, count(*) AS n FROM ({RESULT_CLASS_SQL}) WHERE error_class IS NOT NULL GROUP BY 1""",
    "result_states": f"""
        SELECT vec_id::VARCHAR AS record_id, CASE WHEN error_class = 'wrong_dim' THEN 'ok' ELSE 'failed' END
               AS embed_status, CASE WHEN error_class IS NULL OR error_class = 'wrong_dim' THEN 1 ELSE 2 END
               AS embed_attempts, CASE WHEN error_class = 'wrong_dim' THEN 4 ELSE 5 END AS updated_seq
        FROM ({RESULT_CLASS_SQL}) WHERE {_KEYED}""",
    "collect_join": f"""
        SELECT 'batches/' || label AS batch_id, vec_id::VARCHAR AS record_id,
               CASE WHEN {_KNOWN} THEN {uuid_sql('vec_id::VARCHAR')} ELSE '' END AS point_id,
               {_KNOWN} AS known, 64 AS dim, round({_NORM}, 4) AS norm
        FROM ({RESULT_CLASS_SQL}) WHERE error_class IS NULL""",
    "collect_rerun": f"""
        SELECT 'batches/' || label AS batch_id, count(*) AS n, count(*) FILTER (WHERE {_KNOWN}) AS known,
               count(DISTINCT vec_id) AS ids
        FROM ({RESULT_CLASS_SQL}) WHERE error_class IS NULL GROUP BY 1""",
    "result_file_names": "SELECT o_orderkey, 'batches_' || o_orderkey || '.jsonl' AS name FROM orders",
    "upsert_incoming": f"""
        SELECT {uuid_sql('record_id')} AS point_id, record_id, round(first, 6) AS first, brand
        FROM ({_INCOMING_SQL})""",
    "upsert_skipped": """
        SELECT p_partkey::VARCHAR AS record_id FROM part WHERE p_size < 45 AND p_type <> 'PROMO'
          AND NOT EXISTS (SELECT 1 FROM embeddings WHERE vec_id = p_partkey)""",
    "upsert_points": _SNAPSHOT_SQL,
    "upsert_log": _SNAPSHOT_SQL,
    "deliver_points": f"""
        SELECT {uuid_sql('record_id')} AS point_id, record_id, true AS delivered FROM ({_INCOMING_SQL})""",
    "typed_layout": """
        SELECT p_partkey::VARCHAR AS record_id, p_type, p_brand, p_size::BIGINT AS p_size, p_retailprice
        FROM part WHERE p_type IN ('PROMO', 'ECONOMY') AND p_size > 30""",
    "latest_vectors": """
        SELECT vec_id::VARCHAR AS record_id, CASE WHEN label < 5 THEN 2 ELSE 1 END AS seq FROM embeddings""",
    "truncate_dim": """
        SELECT record_id, 16 AS dim, 1.0::DOUBLE AS norm, position::INTEGER - 1 AS position,
               round((v[position] / n)::FLOAT::DOUBLE, 4) AS x
        FROM (SELECT vec_id AS record_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS n,
                     unnest(range(1, 17)) AS position
              FROM (SELECT vec_id, list_slice(embedding, 1, 16)::DOUBLE[] AS v FROM embeddings))""",
    "norm_check": """
        SELECT record_id, NOT (n BETWEEN 0.95 AND 1.05) AS off, round(n, 4) AS norm FROM (
          SELECT vec_id AS record_id, sqrt(list_sum(list_transform(embedding::DOUBLE[],
            lambda x: (x * (0.9::DOUBLE + label / 50.0::DOUBLE)) * (x * (0.9::DOUBLE + label / 50.0::DOUBLE))))) AS n
          FROM embeddings)""",
    "point_keys": f"SELECT md5(text) AS id_md5, {uuid_sql('text')} AS point_id FROM documents",
}
