"""Queries over vectors: search, embedding and audits of recall."""

from __future__ import annotations

import functools

from pyspark.sql import functions as F

from quillon.operators import geoindex as gi, multiindex as mi, search as se
from quillon.operators.admitted import admitted_top_k
from quillon.operators.embed import embed_texts, hashed_words
from quillon.operators.normalize import normalize
from quillon.operators.points import typed_payload, with_sketch
from quillon.operators.sampling import seeded_sample
from quillon.operators.textindex import build_text_index, text_matches
from quillon.operators.verify import recall_hits, self_search_check
from quillon.registry.fixtures import DIM, PRODUCTS, table, vectors

WORDS_DIM = 64


def _samples(spark, sf_dir, n=20):
    picked = seeded_sample(vectors(spark, sf_dir), "record_id", n)
    return picked.select(F.col("record_id").alias("query_id"), "vector")


def _asked(spark, sf_dir):
    """Queries of the searches: every vector whose id is divisible by 50."""
    picked = vectors(spark, sf_dir).where(F.col("vec_id") % 50 == 0)
    return picked.select(F.col("record_id").alias("query_id"), "vector")


def _hits():
    return ["query_id", "id", F.round("score", 4).alias("score"), "rank"]


def cosine_topk(spark, sf_dir):
    found = se.cosine_top_k(vectors(spark, sf_dir), _asked(spark, sf_dir), dim=DIM, k=5)
    return found.select(*_hits())


def blocked_topk(spark, sf_dir):
    """Every vector asks, in blocks, as done above the broadcast bound."""
    every = vectors(spark, sf_dir).select(F.col("record_id").alias("query_id"), "vector")
    found = se.blocked_top_k(vectors(spark, sf_dir), every, dim=DIM, k=5, block_queries=1000)
    return found.select(*_hits())


def self_search(spark, sf_dir):
    found = se.cosine_top_k(vectors(spark, sf_dir), _samples(spark, sf_dir), dim=DIM, k=1)
    return se.self_search(found).select("query_id", "top_id", F.round("score", 4).alias("score"), "ok")


def self_search_summary(spark, sf_dir):
    return self_search_check(vectors(spark, sf_dir), DIM)


def filtered_topk(spark, sf_dir):
    """Only vectors of three labels are searched."""
    kept = vectors(spark, sf_dir).where(F.col("label").isin(1, 4, 7))
    found = se.cosine_top_k(kept, _asked(spark, sf_dir), dim=DIM, k=5)
    return found.select(*_hits())


def payload_filtered_topk(spark, sf_dir):
    """Products with embeddings, searched among those whose typed payload passes."""
    records = normalize(table(spark, sf_dir, "part"), PRODUCTS).withColumn(
        "vec_id", F.col("record_id").cast("long")
    )
    points = records.join(table(spark, sf_dir, "embeddings"), "vec_id")
    typed = typed_payload(points, PRODUCTS.payload.indexes)
    kept = typed.where((F.col("p_size") >= 25) & F.col("p_type").isin("PROMO", "ECONOMY"))
    found = se.cosine_top_k(
        kept, _asked(spark, sf_dir), dim=DIM, k=5, id_column="vec_id", vector_column="embedding"
    )
    return found.select(*_hits())


def text_filtered_topk(spark, sf_dir):
    """Documents with embeddings: each query searches those that hold the first two words of its own."""
    documents = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("record_id"), "text")
    words = F.regexp_extract_all("text", F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    own = documents.where(F.col("record_id") % 50 == 0).select(
        F.col("record_id").alias("query_id"), F.array_join(F.slice(words, 1, 2), " ").alias("text"))
    matches = text_matches(build_text_index(documents), own, filter_id="query_id", paired=False)
    return admitted_top_k(vectors(spark, sf_dir), _asked(spark, sf_dir), matches, dim=DIM, k=5).select(*_hits())


def geo_filtered(spark, sf_dir):
    """Customers within every supplier's radius, places read from the payload's geo field."""
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    place = F.struct((nation * 14 - 170 + key * 7919 % 1000 / 500).alias("lon"), (nation * 6 - 75 + key * 1047 % 1000 / 500).alias("lat"))
    points = table(spark, sf_dir, "customer").select(key.alias("record_id"), F.to_json(F.struct(place.alias("place"))).alias("payload"))
    typed = typed_payload(points, {"place": "geo"}).select("record_id", "place.lon", "place.lat")
    nation = F.col("s_nationkey")
    circles = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("filter_id"), (nation * 14 - 169).alias("lon"), (nation * 6 - 74).alias("lat"),
        ((F.col("s_suppkey") % 7 + 1) * 5000).alias("radius"))
    found = gi.geo_circles(gi.build_geo_index(typed), circles)
    return found.select(F.col("filter_id").alias("s_suppkey"), F.col("id").alias("c_custkey"), F.round(F.col("metres") / 1000, 3).alias("km"))


def hamming_topk(spark, sf_dir):
    sketched = with_sketch(vectors(spark, sf_dir), DIM)
    return se.blocked_hamming_top_k(sketched, _asked(spark, sf_dir), dim=DIM, k=20)


def binary_topk(spark, sf_dir):
    """Through the band index, until nothing further away can be as good."""
    index = mi.build_index(vectors(spark, sf_dir), DIM)
    return mi.sketch_top_k(index, _asked(spark, sf_dir), k=5, recall=None).select(*_hits())


def sketch_topk(spark, sf_dir):
    """Through the band index, within the radius that holds good neighbours at 0.95 or more."""
    index = mi.build_index(vectors(spark, sf_dir), DIM)
    return mi.sketch_top_k(index, _asked(spark, sf_dir), k=5).select(*_hits())


def truncated_topk(spark, sf_dir):
    """Search over the first 16 dimensions."""
    short = vectors(spark, sf_dir).select("record_id", F.slice("vector", 1, 16).alias("vector"))
    queries = _asked(spark, sf_dir).select("query_id", F.slice("vector", 1, 16).alias("vector"))
    return se.cosine_top_k(short, queries, dim=16, k=5).select(*_hits())


def _embedded(df, id_column):
    return embed_texts(df, functools.partial(hashed_words, WORDS_DIM), WORDS_DIM, id_column=id_column, partitions=8)


def hash_embed(spark, sf_dir):
    embedded = _embedded(table(spark, sf_dir, "documents"), "doc_id")
    return embedded.select("doc_id", F.posexplode("vector").alias("bucket", "x")).where("x > 0").select(
        "doc_id", "bucket", F.round(F.col("x").cast("double"), 4).alias("x")
    )


def text_search(spark, sf_dir):
    """Documents nearest to every benchmark item."""
    documents = _embedded(table(spark, sf_dir, "documents"), "doc_id")
    items = _embedded(table(spark, sf_dir, "benchmark"), "item_id")
    found = se.cosine_top_k(
        documents, items, dim=WORDS_DIM, k=5, id_column="doc_id", query_id="item_id"
    )
    return found.select("query_id", "id", F.round("score", 4).alias("score"), "rank")


def cross_modal_recall(spark, sf_dir):
    """Sampled documents look themselves up by their own text."""
    docs = table(spark, sf_dir, "documents")
    sample = seeded_sample(docs.select("doc_id", "text"), "doc_id", 5)
    return recall_hits(
        sample, _embedded(docs, "doc_id"), _embedded(sample.where(F.trim("text") != ""), "doc_id"),
        WORDS_DIM, id_column="doc_id",
    )


QUERIES = {
    "cosine_topk": cosine_topk,
    "blocked_topk": blocked_topk,
    "self_search": self_search,
    "self_search_check": self_search_summary,
    "filtered_topk": filtered_topk,
    "payload_filtered_topk": payload_filtered_topk,
    "text_filtered_topk": text_filtered_topk,
    "geo_filtered": geo_filtered,
    "hamming_topk": hamming_topk,
    "binary_topk": binary_topk,
    "sketch_topk": sketch_topk,
    "truncated_topk": truncated_topk,
    "hash_embed": hash_embed,
    "text_search": text_search,
    "cross_modal_recall": cross_modal_recall,
}

_SAMPLE = "SELECT vec_id AS query_id, embedding AS qv FROM embeddings ORDER BY md5('42:' || vec_id), vec_id LIMIT 20"


_ASKED = "SELECT vec_id AS query_id, embedding AS qv FROM embeddings WHERE vec_id % 50 = 0"


def _topk_sql(
    k: int, corpus: str = "embeddings", vector: str = "embedding", query: str = "qv", sample: str = _ASKED
) -> str:
    return f"""
        SELECT query_id, id, round(score, 4) AS score, rank FROM (
          SELECT query_id, id, score,
                 row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank
          FROM (SELECT query_id, vec_id AS id,
                       round(list_cosine_similarity(({query})::DOUBLE[], ({vector})::DOUBLE[]), 9) AS score
                FROM ({sample}) CROSS JOIN {corpus})) WHERE rank <= {k}"""


_HAMMING_SQL = f"""
        SELECT query_id, id, distance, rank FROM (
          SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id) AS rank FROM (
            SELECT query_id, vec_id AS id,
                   list_sum(list_transform(range(1, 65), lambda i: ((qv[i] > 0) <> (embedding[i] > 0))::INTEGER))::INTEGER
                   AS distance
            FROM ({_ASKED}) CROSS JOIN embeddings)) WHERE rank <= 20"""


_TOKENS = r"regexp_extract_all({text}, '[\p{{L}}\p{{N}}]+')"

_TEXT_FILTERED_SQL = f"""
        WITH d AS (SELECT doc_id, {_TOKENS.format(text='lower(text)')} AS words FROM documents),
        f AS (SELECT doc_id AS query_id, words[1:2] AS need FROM d WHERE doc_id % 50 = 0 AND len(words) > 0),
        m AS (SELECT query_id, doc_id AS id FROM f JOIN d ON list_has_all(words, need))
        SELECT query_id, id, round(score, 4) AS score, rank FROM (
          SELECT query_id, id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank
          FROM (SELECT m.query_id, m.id, round(list_cosine_similarity(q.embedding::DOUBLE[], e.embedding::DOUBLE[]), 9) AS score
                FROM m JOIN embeddings q ON q.vec_id = m.query_id JOIN embeddings e ON e.vec_id = m.id)) WHERE rank <= 5"""

_GEO_SQL = """
        WITH c AS (SELECT c_custkey, c_nationkey * 14 - 170 + c_custkey * 7919 % 1000 / 500 AS lon,
                          c_nationkey * 6 - 75 + c_custkey * 1047 % 1000 / 500 AS lat FROM customer),
        s AS (SELECT s_suppkey, s_nationkey * 14 - 169 AS lon, s_nationkey * 6 - 74 AS lat,
                     (s_suppkey % 7 + 1) * 5000 AS radius FROM supplier),
        p AS (SELECT s_suppkey, c_custkey, radius, 2 * 6371008.8 * asin(sqrt(least(1.0,
                power(sin(radians(s.lat - c.lat) / 2), 2)
                + cos(radians(s.lat)) * cos(radians(c.lat)) * power(sin(radians(s.lon - c.lon) / 2), 2)))) AS metres
              FROM s CROSS JOIN c)
        SELECT s_suppkey, c_custkey, round(metres / 1000, 3) AS km FROM p WHERE metres <= radius"""


# Runs of anything but Unicode white space.
_WORD = (
    r"[^\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)


def _words_sql(source: str, id_column: str) -> str:
    return f"""
        SELECT id, bucket, n / sqrt(sum(n * n) OVER (PARTITION BY id)) AS x FROM (
          SELECT id, ('0x' || substr(md5(token), 1, 8))::BIGINT % {WORDS_DIM} AS bucket, count(*)::DOUBLE AS n
          FROM (SELECT {id_column} AS id,
                       unnest(regexp_extract_all(lower(text), '{_WORD}')) AS token FROM {source})
          GROUP BY 1, 2)"""


def _text_topk_sql(queries: str, k: int) -> str:
    """Scores from float32 weights, as stored vectors are."""
    return f"""
        WITH d AS (SELECT id, bucket, x::FLOAT::DOUBLE AS x FROM ({_words_sql('documents', 'doc_id')})),
        q AS (SELECT id, bucket, x::FLOAT::DOUBLE AS x FROM ({queries})),
        dn AS (SELECT id, sqrt(sum(x * x)) AS n FROM d GROUP BY 1),
        qn AS (SELECT id, sqrt(sum(x * x)) AS n FROM q GROUP BY 1),
        dot AS (SELECT q.id AS query_id, d.id AS id, sum(q.x * d.x) AS s
                FROM q JOIN d USING (bucket) GROUP BY 1, 2),
        scored AS (SELECT query_id, dot.id, round(s / (qn.n * dn.n), 9) AS score
                   FROM dot JOIN qn ON qn.id = query_id JOIN dn ON dn.id = dot.id)
        SELECT query_id, id, round(score, 4) AS score, rank FROM (
          SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS rank FROM scored)
        WHERE rank <= {k}"""


_DOC_SAMPLE = "(SELECT * FROM documents ORDER BY md5('42:' || doc_id), doc_id LIMIT 5)"

ORACLES = {
    "cosine_topk": _topk_sql(5),
    "blocked_topk": _topk_sql(5, sample="SELECT vec_id AS query_id, embedding AS qv FROM embeddings"),
    "self_search": f"""
        SELECT query_id, id AS top_id, score, id = query_id AND score > 0.99 AS ok FROM ({_topk_sql(1, sample=_SAMPLE)})""",
    "self_search_check": f"""
        SELECT 'self_search' AS "check", CASE WHEN count(*) = count(*) FILTER (WHERE id = query_id AND score > 0.99)
               THEN 'PASS' ELSE 'WARN' END AS status,
               count(*) FILTER (WHERE id = query_id AND score > 0.99) AS ok, count(*) AS n
        FROM ({_topk_sql(1, sample=_SAMPLE)})""",
    "filtered_topk": _topk_sql(5, "(SELECT * FROM embeddings WHERE label IN (1, 4, 7))"),
    "payload_filtered_topk": _topk_sql(
        5, "(SELECT e.* FROM embeddings e JOIN part ON vec_id = p_partkey "
        "WHERE p_size >= 25 AND p_type IN ('PROMO', 'ECONOMY'))"
    ),
    "hamming_topk": _HAMMING_SQL,
    "text_filtered_topk": _TEXT_FILTERED_SQL,
    "geo_filtered": _GEO_SQL,
    "binary_topk": _topk_sql(5),
    "truncated_topk": _topk_sql(5, vector="list_slice(embedding, 1, 16)", query="list_slice(qv, 1, 16)"),
    "hash_embed": f"""
        SELECT id AS doc_id, bucket::INTEGER AS bucket, round(x::FLOAT::DOUBLE, 4) AS x
        FROM ({_words_sql('documents', 'doc_id')})""",
    "text_search": _text_topk_sql(_words_sql("benchmark", "item_id"), 5),
    "cross_modal_recall": f"""
        SELECT s.doc_id, bool_or(coalesce(t.id = s.doc_id, false)) AS hit
        FROM {_DOC_SAMPLE} s LEFT JOIN ({_text_topk_sql(_words_sql(_DOC_SAMPLE, 'doc_id'), 5)}) t
          ON t.query_id = s.doc_id GROUP BY 1""",
}
