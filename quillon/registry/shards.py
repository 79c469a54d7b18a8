"""Queries over sharding, budgets and requests."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillon.config import DatasetSpec, Limits
from quillon.functions.keys import base64_text, content_hash, zero_padded
from quillon.functions.requests import content_parts, has_content, request_line
from quillon.operators import shards as sh
from quillon.operators.images import store_blobs
from quillon.operators.normalize import normalize
from quillon.operators.schedule import admission_schedule
from quillon.registry.fixtures import DOCUMENTS, ORDER_BATCHES_SQL, order_batches, table
from quillon.session import fresh_path

LIMITS = Limits(records_per_shard=40, embedding_dim=64)


def _assignment(spark, sf_dir):
    docs = normalize(table(spark, sf_dir, "documents"), DOCUMENTS)
    usable, _ = sh.split_by_content(docs, DOCUMENTS, F.lit(False))
    batches = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("shard_id"))
    return docs, sh.assign_shards(usable, batches, LIMITS)


def shard_assign(spark, sf_dir):
    return _assignment(spark, sf_dir)[1]


def shard_batches(spark, sf_dir):
    return sh.shard_batches(_assignment(spark, sf_dir)[1], LIMITS).select(
        "shard_id", "state", "est_tokens", "record_count", "request_file"
    )


def next_shard(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("shard_id"))
    empty = orders.where("shard_id < 0")
    return sh.next_shard_id(orders).unionByName(sh.next_shard_id(empty))


def shard_files(spark, sf_dir):
    """Request shards written as JSON lines and read back."""
    docs, assignment = _assignment(spark, sf_dir)
    lines = sh.request_lines(docs.drop("image"), assignment, DOCUMENTS, dim=64, model="models/embedder")
    path = fresh_path(spark, "shards")
    sh.write_request_shards(lines, path)
    body = F.from_json("value", "key string, request struct<content:struct<parts:array<struct<text:string>>>>")
    return sh.read_request_shards(sh.request_index(spark, path), path).select("shard_id", body.alias("b")).select(
        "shard_id",
        F.col("b.key").alias("record_id"),
        F.md5(F.col("b.request.content.parts")[0]["text"]).alias("text_md5"),
    )


def request_json(spark, sf_dir):
    docs = normalize(table(spark, sf_dir, "documents"), DOCUMENTS)
    parts = content_parts(DOCUMENTS, F.col("text"), F.col("image"))
    line = request_line(F.col("record_id"), parts, dim=64, model="models/embedder")
    parsed = F.from_json(
        line,
        "key string, request struct<model:string,task_type:string,output_dimensionality:int,"
        "content:struct<parts:array<struct<text:string>>>>",
    )
    return docs.select(line.alias("line"), parsed.alias("p")).select(
        F.col("p.key").alias("record_id"),
        F.col("p.request.model").alias("model"),
        F.col("p.request.task_type").alias("task_type"),
        F.col("p.request.output_dimensionality").alias("dim"),
        F.size("p.request.content.parts").alias("n_parts"),
        F.md5(F.col("p.request.content.parts")[0]["text"]).alias("text_md5"),
        F.col("line").like('{"key":"%","request":{"model":"models/embedder","task_type":%').alias("shaped"),
    )


def request_multimodal(spark, sf_dir):
    """Pages as pictures: text and inline data per modality, content-less rows skipped."""
    pages = table(spark, sf_dir, "pages").select(
        F.col("page_id").cast("string").alias("record_id"),
        F.when(F.col("url").contains("/fr/"), "").otherwise(F.col("url")).alias("text"),
        F.when(~F.col("url").startswith("https"), F.encode("html", "UTF-8")).alias("image"),
    )
    found = None
    for modality in ("text", "image", "multimodal"):
        spec = DatasetSpec(dataset="pages", modality=modality, image_column="image")
        parts = content_parts(spec, F.col("text"), F.col("image"))
        line = request_line(F.col("record_id"), parts, dim=64, model="models/embedder")
        rows = pages.select(
            F.lit(modality).alias("modality"),
            "record_id",
            F.size(parts).alias("n_parts"),
            line.isNull().alias("skipped"),
            has_content(spec, F.col("text"), F.col("image").isNotNull()).alias("has_content"),
            F.md5(F.concat_ws("", F.transform(parts, lambda p: p["inline_data"]["data"]))).alias("data_md5"),
        )
        found = rows if found is None else found.unionByName(rows)
    return found


def image_requests(spark, sf_dir):
    """Pages ask with their picture, found in the blob store by hash; every language shares one too."""
    pages = table(spark, sf_dir, "pages").select(
        F.col("page_id").cast("string").alias("record_id"),
        F.regexp_extract("url", r"/(de|en|es|fr)/", 1).alias("text"),
        F.encode("html", "UTF-8").alias("content"),
    )
    path = fresh_path(spark, "blobs")
    shared = pages.select(F.encode("text", "UTF-8").alias("content"))
    store_blobs(pages.select("content").unionByName(shared), path)
    spec = DatasetSpec(dataset="pages", image_column="url", modality="multimodal")
    own = pages.select("record_id", "text", content_hash(F.col("content")).alias("image_sha"))
    lang = pages.select(
        F.concat(F.lit("lang-"), "record_id").alias("record_id"), F.lit("").alias("text"),
        content_hash(F.encode("text", "UTF-8")).alias("image_sha"),
    )
    records = own.unionByName(lang)
    assignment = sh.assign_shards(records, table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("shard_id")), LIMITS)
    lines = sh.request_lines(records, assignment, spec, dim=64, model="models/embedder", blobs=path)
    parts = F.from_json(
        "line", "request struct<content:struct<parts:array<struct<text:string,inline_data:struct<data:string>>>>>"
    )["request"]["content"]["parts"]
    return lines.select("shard_id", "record_id", parts.alias("p")).select(
        "shard_id", "record_id", F.size("p").alias("n_parts"), F.col("p")[0]["text"].alias("text"),
        F.md5(F.element_at("p", -1)["inline_data"]["data"]).alias("data_md5"),
    )


def base64_pages(spark, sf_dir):
    return table(spark, sf_dir, "pages").select(
        "page_id", F.md5(base64_text(F.encode("html", "UTF-8"))).alias("b64_md5")
    )


def in_flight(spark, sf_dir):
    limits = Limits(max_concurrent_jobs=1_000_000, max_enqueued_tokens=1_000_000_000)
    return sh.in_flight_budget(order_batches(spark, sf_dir), limits)


def _waiting(spark, sf_dir):
    """Orders as shards that all wait."""
    return order_batches(spark, sf_dir).withColumn("state", F.lit("PENDING"))


def admission(spark, sf_dir):
    """Nine slots and 18,000 tokens: large shards are passed over for later, smaller ones."""
    return sh.admission_round(_waiting(spark, sf_dir), Limits(max_enqueued_tokens=18_000))


def admission_tight(spark, sf_dir):
    """Tokens run out before slots do."""
    limits = Limits(max_concurrent_jobs=60, max_enqueued_tokens=40_000)
    return sh.admission_round(_waiting(spark, sf_dir), limits)


def schedule(spark, sf_dir):
    """Rounds of nine slots and 9,000 tokens, followed in blocks of 1,000 shards."""
    limits = Limits(max_enqueued_tokens=9_000)
    return admission_schedule(_waiting(spark, sf_dir), limits, block_size=1000)


def oversized(spark, sf_dir):
    return sh.oversized_shards(order_batches(spark, sf_dir), Limits(max_enqueued_tokens=2_000)).select(
        "shard_id", "est_tokens"
    )


def cost(spark, sf_dir):
    """Standard rates per token and picture at half price, one token per four characters."""
    docs = table(spark, sf_dir, "documents")
    priced = sh.cost_estimate(
        docs, tokens=F.ceil(F.col("n_chars") / 4), images=F.lit(1),
        token_rate=0.20 / 1_000_000, image_rate=0.00012, discount=0.5,
    )
    return priced.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("cost"), 8).alias("cost")
    )


def file_names(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(F.lit("shard_"), zero_padded(F.col("o_orderkey"), 5)).alias("name")
    )


QUERIES = {
    "shard_assign": shard_assign,
    "shard_batches": shard_batches,
    "next_shard_id": next_shard,
    "shard_files": shard_files,
    "request_json": request_json,
    "request_multimodal": request_multimodal,
    "image_requests": image_requests,
    "base64_blobs": base64_pages,
    "in_flight_budget": in_flight,
    "admission_round": admission,
    "admission_tight": admission_tight,
    "admission_schedule": schedule,
    "oversized_shards": oversized,
    "cost_estimate": cost,
    "request_file_names": file_names,
}

_ASSIGN_SQL = """
  SELECT doc_id::VARCHAR AS record_id,
         5 + (row_number() OVER (ORDER BY doc_id::VARCHAR) - 1) // 40 AS shard_id, text
  FROM documents WHERE length(text) > 0"""


def _admission_sql(slots: int, cap: int) -> str:
    return f"""
        WITH q AS (SELECT list({{'id': shard_id, 't': est_tokens}} ORDER BY shard_id) AS l
                   FROM ({ORDER_BATCHES_SQL})),
        r AS (SELECT list_reduce(
            list_transform(l, lambda s: {{'s': s, 'taken': []::STRUCT(id BIGINT, t BIGINT)[], 'left': {cap}::BIGINT}}),
            lambda a, x: {{'s': x.s,
              'taken': CASE WHEN len(a.taken) < {slots} AND x.s.t <= a.left
                            THEN list_append(a.taken, {{'id': x.s.id, 't': x.s.t}}) ELSE a.taken END,
              'left': CASE WHEN len(a.taken) < {slots} AND x.s.t <= a.left THEN a.left - x.s.t ELSE a.left END}},
            {{'s': l[1], 'taken': []::STRUCT(id BIGINT, t BIGINT)[], 'left': {cap}::BIGINT}}) AS s FROM q),
        u AS (SELECT unnest(s.taken) AS e, generate_subscripts(s.taken, 1) - 1 AS position FROM r)
        SELECT position::INTEGER AS position, e.id AS shard_id, e.t AS est_tokens FROM u"""


def _modality_sql(modality: str, text: str, image: str) -> str:
    return f"""
        SELECT '{modality}' AS modality, record_id, ({text})::INTEGER + ({image})::INTEGER AS n_parts,
               NOT ({text} OR {image}) AS skipped, ({text} OR {image}) AS has_content,
               md5(CASE WHEN {image} THEN base64(image) ELSE '' END) AS data_md5
        FROM p"""


_HAS_TEXT, _HAS_IMAGE = "text <> ''", "image IS NOT NULL"

ORACLES = {
    "shard_assign": f"SELECT record_id, shard_id FROM ({_ASSIGN_SQL})",
    "shard_batches": f"""
        SELECT shard_id, 'PENDING' AS state, count(*) * 330 AS est_tokens, count(*) AS record_count,
               'shard_' || CASE WHEN shard_id < 100000 THEN lpad(shard_id::VARCHAR, 5, '0')
                                ELSE shard_id::VARCHAR END || '.jsonl' AS request_file
        FROM ({_ASSIGN_SQL}) GROUP BY shard_id""",
    "next_shard_id": """
        SELECT max(o_orderkey) + 1 AS next_shard_id FROM orders UNION ALL SELECT 0""",
    "shard_files": f"SELECT shard_id, record_id, md5(text) AS text_md5 FROM ({_ASSIGN_SQL})",
    "request_json": """
        SELECT doc_id::VARCHAR AS record_id, 'models/embedder' AS model, 'RETRIEVAL_DOCUMENT' AS task_type,
               64 AS dim, 1 AS n_parts, md5(text) AS text_md5, true AS shaped FROM documents""",
    "request_multimodal": f"""
        WITH p AS (SELECT page_id::VARCHAR AS record_id,
                          CASE WHEN contains(url, '/fr/') THEN '' ELSE url END AS text,
                          CASE WHEN NOT starts_with(url, 'https') THEN encode(html) END AS image FROM pages)
        {_modality_sql('text', _HAS_TEXT, 'false')}
        UNION ALL {_modality_sql('image', 'false', _HAS_IMAGE)}
        UNION ALL {_modality_sql('multimodal', _HAS_TEXT, _HAS_IMAGE)}""",
    "image_requests": """
        WITH p AS (SELECT page_id::VARCHAR AS id, regexp_extract(url, '/(de|en|es|fr)/', 1) AS lang, html FROM pages),
        r AS (SELECT id AS record_id, lang AS text, encode(html) AS image FROM p
              UNION ALL SELECT 'lang-' || id, '', encode(lang) FROM p)
        SELECT 5 + (row_number() OVER (ORDER BY record_id) - 1) // 40 AS shard_id, record_id,
               CASE WHEN text <> '' THEN 2 ELSE 1 END AS n_parts, nullif(text, '') AS text,
               md5(base64(image)) AS data_md5
        FROM r""",
    "base64_blobs": "SELECT page_id, md5(base64(encode(html))) AS b64_md5 FROM pages",
    "in_flight_budget": f"""
        SELECT coalesce(sum(est_tokens), 0)::BIGINT AS active_tokens, (1000000 - count(*))::INTEGER AS free_slots,
               (1000000000 - coalesce(sum(est_tokens), 0))::BIGINT AS free_tokens
        FROM ({ORDER_BATCHES_SQL}) WHERE state = 'SUBMITTED'""",
    "admission_round": _admission_sql(9, 18000),
    "admission_tight": _admission_sql(60, 40000),
    "admission_schedule": f"""
        WITH RECURSIVE q AS (
          SELECT shard_id, est_tokens, row_number() OVER w AS i, sum(est_tokens) OVER w AS spent
          FROM ({ORDER_BATCHES_SQL}) WHERE est_tokens <= 9000 WINDOW w AS (ORDER BY shard_id ROWS UNBOUNDED PRECEDING)),
        f AS (SELECT a.i, max(b.i) + 1 AS following FROM q a JOIN q b
              ON b.i BETWEEN a.i AND a.i + 8 AND b.spent <= a.spent - a.est_tokens + 9000 GROUP BY 1),
        r(i, following, round) AS (
          SELECT i, following, 0 FROM f WHERE i = 1
          UNION ALL SELECT f.i, f.following, r.round + 1 FROM r JOIN f ON f.i = r.following)
        SELECT q.shard_id, q.est_tokens::BIGINT AS est_tokens, r.round::BIGINT AS round
        FROM r JOIN q ON q.i >= r.i AND q.i < r.following""",
    "oversized_shards": f"""
        SELECT shard_id, est_tokens FROM ({ORDER_BATCHES_SQL}) WHERE state = 'PENDING' AND est_tokens > 2000""",
    "cost_estimate": """
        SELECT lang, count(*) AS n,
               round(sum((ceil(n_chars / 4) * (0.20 / 1000000) + 0.00012) * 0.5), 8) AS cost
        FROM documents GROUP BY lang""",
    "request_file_names": """
        SELECT o_orderkey, 'shard_' || CASE WHEN o_orderkey < 100000
          THEN lpad(o_orderkey::VARCHAR, 5, '0') ELSE o_orderkey::VARCHAR END AS name FROM orders""",
}
