"""Queries over image fetch, blobs and shrinking."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillon.functions.states import fetch_status, is_terminal, local_state, should_retry
from quillon.operators import fetch as fe
from quillon.operators import images as im
from quillon.registry.fixtures import table
from quillon.session import fresh_path


def fetch_classify(spark, sf_dir):
    """Event types as outcomes of a try."""
    kind, cents = F.col("event_type"), F.pmod("event_id", F.lit(7))
    code = (
        F.when(kind == "click", 200).when((kind == "view") & (cents < 3), 404).when(kind == "view", 410)
        .when((kind == "signup") & (cents < 2), 503).when(kind == "signup", 403)
    )
    error = F.when(kind == "error", F.when(cents < 4, "timeout").otherwise("other")).when(
        kind == "purchase", "network"
    )
    attempt = (F.pmod("event_id", F.lit(5)) + 1).cast("int")
    tries = table(spark, sf_dir, "events").select(
        fetch_status(code, error).alias("image_status"),
        should_retry(code, error, attempt, 5).alias("retry"),
    )
    return tries.groupBy("image_status", "retry").agg(F.count(F.lit(1)).alias("n"))


def job_state_map(spark, sf_dir):
    states = ["JOB_STATE_PENDING", "JOB_STATE_RUNNING", "JOB_STATE_SUCCEEDED", "JOB_STATE_FAILED",
              "JOB_STATE_CANCELLED", "JOB_STATE_EXPIRED", "JOB_STATE_ODD"]
    job = F.element_at(F.array(*[F.lit(s) for s in states]), (F.pmod("o_orderkey", F.lit(7)) + 1).cast("int"))
    return table(spark, sf_dir, "orders").select(job.alias("job_state")).select(
        "job_state", local_state(F.col("job_state")).alias("state"),
        is_terminal(F.col("job_state")).alias("terminal"),
    ).groupBy("job_state", "state", "terminal").agg(F.count(F.lit(1)).alias("n"))


def _fetched(spark, sf_dir):
    """Answers by URL, as a fetch leaves them: status by page, a picture for every third."""
    pages = table(spark, sf_dir, "pages").groupBy("url").agg(F.min("page_id").alias("n"))
    body = F.when(F.col("n") % 3 == 0, F.concat(F.unhex(F.lit("89504E470D0A1A0A")), F.encode("url", "UTF-8"))).otherwise(
        F.encode("url", "UTF-8"))
    code = F.element_at(F.array(*(F.lit(c) for c in (200, 404, 503, 200, 410))), (F.col("n") % 5 + 1).cast("int"))
    return pages.select(
        "url", code.alias("status_code"), F.lit(None).cast("string").alias("error_kind"),
        F.when(code == 503, 5).otherwise(1).alias("attempts"), F.sha2(body, 256).alias("sha"), body.alias("content"),
    )


def fetch_images(spark, sf_dir):
    """Every page has its URL's outcome, and asks once more for an address nobody answered."""
    pages = table(spark, sf_dir, "pages")
    own = pages.select(F.concat(F.lit("p"), F.col("page_id").cast("string")).alias("record_id"),
                       F.col("url").alias("image_url"))
    none = pages.select(F.concat(F.lit("h"), F.col("page_id").cast("string")).alias("record_id"),
                        F.when(F.col("page_id") % 2 == 0, F.concat("url", F.lit("/missing"))).alias("image_url"))
    return fe.fetch_outcomes(own.unionByName(none), _fetched(spark, sf_dir)).select(
        "record_id", "image_status", "image_sha", "attempts")


def fetch_counts(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select(
        F.col("page_id").cast("string").alias("record_id"), F.col("url").alias("image_url")
    )
    return fe.outcome_counts(fe.fetch_outcomes(pages, _fetched(spark, sf_dir)))


def blob_store(spark, sf_dir):
    """Document texts as blobs: stored in two rounds that overlap, each content once."""
    docs = table(spark, sf_dir, "documents").select(
        "lang", F.encode("text", "UTF-8").alias("content")
    )
    path = fresh_path(spark, "blobs")
    im.store_blobs(docs.where("lang <> 'de'"), path)
    im.store_blobs(docs, path)
    return im.stored_blobs(spark, path).select("sha", F.octet_length("content").alias("length"))


def shrink_gray(spark, sf_dir):
    """Embeddings as 8 x 8 gray pictures, shrunk to 4 x 4."""
    gray = F.transform("embedding", lambda x: F.floor((x + 1) * 127).cast("int"))
    data = F.unhex(F.array_join(F.transform(gray, lambda v: F.lpad(F.hex(v), 2, "0")), ""))
    images = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").cast("string").alias("record_id"), F.lit(8).alias("height"), F.lit(8).alias("width"),
        F.lit(1).alias("nChannels"), data.alias("data"),
    )
    shrunk = im.shrink_images(images, 4, ["record_id"])
    return shrunk.select("record_id", "height", "width", "n_channels", F.hex("pixels").alias("pixels"))


QUERIES = {
    "fetch_classify": fetch_classify,
    "job_state_map": job_state_map,
    "fetch_images": fetch_images,
    "fetch_counts": fetch_counts,
    "blob_store": blob_store,
    "shrink_images": shrink_gray,
}

_OUTCOME_SQL = """
  SELECT record_id, coalesce(image_status, 'failed_other') AS image_status, image_sha, coalesce(attempts, 0) AS attempts FROM (
    SELECT 'p' || page_id AS record_id, url FROM pages
    UNION ALL SELECT 'h' || page_id, CASE WHEN page_id % 2 = 0 THEN url || '/missing' END FROM pages)
  LEFT JOIN (
    SELECT url, CASE WHEN n % 5 IN (1, 4) THEN 'failed_404' WHEN n % 5 = 2 OR n % 3 <> 0 THEN 'failed_other' ELSE 'ok' END AS image_status,
           CASE WHEN n % 5 IN (0, 3) AND n % 3 = 0 THEN sha256('\\x89PNG\\x0D\\x0A\\x1A\\x0A'::BLOB || encode(url)) END AS image_sha,
           CASE WHEN n % 5 = 2 THEN 5 ELSE 1 END AS attempts
    FROM (SELECT url, min(page_id) AS n FROM pages GROUP BY url)) USING (url)"""


def _axis_sql() -> str:
    """Lanczos-3 weights of an 8 to 4 reduction, from their definition."""
    return """
        SELECT o, i, w / sum(w) OVER (PARTITION BY o) AS w FROM (
          SELECT o, i, CASE WHEN x = 0 THEN 1.0 WHEN abs(x) < 3
                 THEN 3 * sin(pi() * x) * sin(pi() * x / 3) / (pi() * pi() * x * x) ELSE 0.0 END AS w
          FROM (SELECT o, i, (i + 0.5 - (o + 0.5) * 2) / 2.0::DOUBLE AS x
                FROM range(4) a(o) CROSS JOIN range(8) b(i)))"""


ORACLES = {
    "fetch_classify": """
        WITH t AS (SELECT event_id % 5 + 1 AS attempt,
            CASE WHEN event_type = 'click' THEN 200 WHEN event_type = 'view' AND event_id % 7 < 3 THEN 404
                 WHEN event_type = 'view' THEN 410 WHEN event_type = 'signup' AND event_id % 7 < 2 THEN 503
                 WHEN event_type = 'signup' THEN 403 END AS code,
            CASE WHEN event_type = 'error' AND event_id % 7 < 4 THEN 'timeout' WHEN event_type = 'error' THEN 'other'
                 WHEN event_type = 'purchase' THEN 'network' END AS err FROM events)
        SELECT CASE WHEN code IN (404, 410) THEN 'failed_404' WHEN code = 200 THEN 'ok' ELSE 'failed_other' END
               AS image_status,
               attempt < 5 AND (coalesce(code IN (403, 503), false) OR coalesce(err IN ('timeout', 'network'), false)) AS retry,
               count(*) AS n FROM t GROUP BY 1, 2""",
    "job_state_map": """
        SELECT job_state, state, terminal, count(*) AS n FROM (
          SELECT CASE o_orderkey % 7 WHEN 0 THEN 'JOB_STATE_PENDING' WHEN 1 THEN 'JOB_STATE_RUNNING'
                   WHEN 2 THEN 'JOB_STATE_SUCCEEDED' WHEN 3 THEN 'JOB_STATE_FAILED' WHEN 4 THEN 'JOB_STATE_CANCELLED'
                   WHEN 5 THEN 'JOB_STATE_EXPIRED' ELSE 'JOB_STATE_ODD' END AS job_state,
                 CASE o_orderkey % 7 WHEN 0 THEN 'SUBMITTED' WHEN 1 THEN 'RUNNING' WHEN 2 THEN 'SUCCEEDED'
                   WHEN 3 THEN 'FAILED' WHEN 4 THEN 'FAILED' WHEN 5 THEN 'EXPIRED' ELSE 'RUNNING' END AS state,
                 o_orderkey % 7 BETWEEN 2 AND 5 AS terminal FROM orders) GROUP BY ALL""",
    "fetch_images": _OUTCOME_SQL,
    "fetch_counts": f"""
        SELECT image_status, count(*) AS n FROM ({_OUTCOME_SQL}) WHERE starts_with(record_id, 'p') GROUP BY 1""",
    "blob_store": "SELECT DISTINCT sha256(text) AS sha, octet_length(encode(text)) AS length FROM documents",
    "shrink_images": f"""
        WITH w AS ({_axis_sql()}),
        p AS (SELECT vec_id, y, x, floor((embedding[y * 8 + x + 1] + 1) * 127) AS v
              FROM embeddings CROSS JOIN range(8) a(y) CROSS JOIN range(8) b(x)),
        s AS (SELECT vec_id, r.o AS oy, c.o AS ox, sum(r.w * c.w * v) AS v
              FROM p JOIN w r ON r.i = y JOIN w c ON c.i = x GROUP BY 1, 2, 3)
        SELECT vec_id::VARCHAR AS record_id, 4 AS height, 4 AS width, 1 AS n_channels,
               string_agg(printf('%02X', greatest(0, least(255, floor(v + 0.5)))::INTEGER), '' ORDER BY oy, ox) AS pixels
        FROM s GROUP BY vec_id""",
}
