"""Queries of the operators over the given tables, and SQL where it can express them."""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

import quillon
from quillon.llm import bwt, cascade, decontaminate, interaction, knn, language, lexical, lines, minhash, mixing, quality, sharding, warc

# Python workers need no copy of the package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(quillon)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash(spark, sf_dir):
    """Two-word shingles, similarity 0.8."""
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"), words=2, percent=80)


def op2_mixing(spark, sf_dir):
    """Weights 1, 2, 3 over the sources, three copies at most."""
    counted = mixing.repetitions(_table(spark, sf_dir, "documents"))
    return counted.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


def op3_decontaminate(spark, sf_dir):
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_language(spark, sf_dir):
    return language.identify(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "documents"))


def op5_lines(spark, sf_dir):
    left = lines.without_repeated_lines(_table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op6_warc(spark, sf_dir):
    return warc.archived(_table(spark, sf_dir, "pages"))


def op7_sharding(spark, sf_dir):
    return sharding.shard_rows(_table(spark, sf_dir, "documents"), shards=40)


def op8_topk(spark, sf_dir):
    return knn.exact_top_k(_table(spark, sf_dir, "embeddings"), every=100, k=10, scale=1024)


def op9_quality(spark, sf_dir):
    return quality.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_repeats(spark, sf_dir):
    return bwt.without_repeats(_table(spark, sf_dir, "documents"))


def op11_cascade(spark, sf_dir):
    """All measures, and the cascade's verdict."""
    return cascade.quality_rules(_table(spark, sf_dir, "documents"))


def op12_lexical(spark, sf_dir):
    """The ten best documents of each benchmark item."""
    return lexical.ranked_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=10)


def op13_interaction(spark, sf_dir):
    return interaction.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_minhash": op1_minhash,
    "op2_mixing": op2_mixing,
    "op3_decontaminate": op3_decontaminate,
    "op4_language": op4_language,
    "op5_lines": op5_lines,
    "op6_warc": op6_warc,
    "op7_sharding": op7_sharding,
    "op8_topk": op8_topk,
    "op9_quality": op9_quality,
    "op10_repeats": op10_repeats,
    "op11_cascade": op11_cascade,
    "op12_lexical": op12_lexical,
    "op13_interaction": op13_interaction,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({text}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".replace("{text}", _LOWER)

ORACLES = {
    "op2_mixing": r"""
        WITH sized AS (
          SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                 ('0x' || substr(md5(concat_ws(':', '42', coalesce(doc_id::VARCHAR, 'null'), md5(coalesce(text, '')))), 1, 12))::BIGINT
                 / 281474976710656.0::DOUBLE AS u FROM documents),
        totals AS (
          SELECT source, sum(size)::BIGINT AS source_size,
                 ((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1)::DOUBLE AS weight FROM sized GROUP BY source),
        levels AS (
          SELECT 3.0::DOUBLE * source_size / weight AS ratio, row_number() OVER o AS place,
                 ((SELECT sum(size) FROM sized)::DOUBLE - coalesce(sum(3.0::DOUBLE * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                 / ((SELECT sum(weight) FROM totals) - coalesce(sum(weight) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
          FROM totals WINDOW o AS (ORDER BY 3.0::DOUBLE * source_size / weight, source)),
        fill AS (SELECT arg_min(level, place) AS level FROM levels WHERE level < ratio),
        rates AS (
          SELECT source, source_size, target, CASE WHEN source_size = 0 THEN 0.0 WHEN target >= 3.0::DOUBLE * source_size THEN 3.0 ELSE target / source_size END::DOUBLE AS rate
          FROM (SELECT *, least((SELECT level FROM fill) * weight, 3.0::DOUBLE * source_size) AS target FROM totals))
        SELECT doc_id, size, source_size, target, ((floor(rate) + (u < rate - floor(rate))::INTEGER) * size)::BIGINT AS taken
        FROM sized JOIN rates ON sized.source IS NOT DISTINCT FROM rates.source""",
    "op3_decontaminate": f"""
        WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        b AS (SELECT item_id::VARCHAR AS item, {_WORDS} AS w FROM benchmark),
        starts AS (SELECT item, w, least(len(w), 10) AS n, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0),
        win AS (SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS run FROM starts),
        runs AS (
          SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS run
          FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d CROSS JOIN (SELECT DISTINCT n FROM win))),
        hits AS (SELECT DISTINCT doc_id, i, n, item FROM runs JOIN win USING (run, n)),
        places AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY 1),
        items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY 1)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
        FROM d LEFT JOIN places USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op5_lines": """
        WITH l AS (SELECT doc_id, unnest(range(len(s))) AS line, unnest(s) AS t FROM (SELECT doc_id, string_split(text, chr(10)) AS s FROM documents)),
        kinds AS (SELECT t, min((doc_id, line)) AS p, length(t) AS n FROM l WHERE t <> '' GROUP BY t),
        halves AS (
          SELECT DISTINCT t, p, n, k FROM (
            SELECT *, unnest(['a' || (n // 2) || ':' || left(t, n // 2), 'a' || ((n - 1) // 2) || ':' || left(t, (n - 1) // 2),
                              'z' || ((n + 1) // 2) || ':' || right(t, (n + 1) // 2), 'z' || (n // 2) || ':' || right(t, n // 2)]) AS k
            FROM kinds)),
        near AS (
          SELECT a.t, min(b.p) AS q FROM halves a JOIN halves b ON a.k = b.k AND a.t <> b.t AND abs(a.n - b.n) <= 1
          WHERE levenshtein(a.t, b.t) <= 4 -- bytes, of which a character has up to four
            AND len(list_filter(range(1, greatest(a.n, b.n) + 1), lambda i: left(a.t, i - 1) = left(b.t, i - 1)
                                AND substr(a.t, i + (a.n >= b.n)::BIGINT) = substr(b.t, i + (b.n >= a.n)::BIGINT))) > 0
          GROUP BY a.t),
        kept AS (
          SELECT doc_id, l.line, l.t, l.t <> '' AND least(p, coalesce(q, p)) < (doc_id, line) AS gone
          FROM l LEFT JOIN kinds ON l.t = kinds.t LEFT JOIN near ON near.t = l.t),
        texts AS (
          SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed, count(*) AS n, coalesce(string_agg(t, chr(10) ORDER BY line) FILTER (WHERE NOT coalesce(gone, false)), '') AS k
          FROM kept GROUP BY doc_id)
        SELECT doc_id, CASE WHEN text <> '' THEN n ELSE 0 END::BIGINT AS n_lines, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
        FROM documents LEFT JOIN texts USING (doc_id)""",
    "op6_warc": """
        WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS n, sha1(coalesce(html, '')) AS h FROM pages),
        d AS (
          SELECT page_id, n, max(page_id) OVER (PARTITION BY h, n) AS best,
                 array_to_string(list_transform(range(32), lambda g: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   (1 + (((('0x' || substr(h, (g // 4) * 5 + 1, 5))::BIGINT) >> (15 - 5 * (g % 4))) & 31))::BIGINT, 1)), '') AS digest
          FROM p)
        SELECT page_id, n AS payload_bytes, digest AS payload_digest, CASE WHEN page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> best THEN best END AS refers_to FROM d""",
    "op8_topk": """
        WITH v AS (
          SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)::DOUBLE) AS e FROM embeddings
          WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)
        SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
          SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM (
            SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.e, v.e)::BIGINT AS score
            FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 100 = 0)) WHERE rank <= 10""",
    "op11_cascade": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
                          regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        lines AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d),
        dup AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup FROM lines
                WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
        runs AS (SELECT r, i, array_to_string(w[i:i + 4], ' ') AS run FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
        again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, run) AS n FROM runs) WHERE n > 1),
        rep AS (SELECT r, count(DISTINCT p) AS n_rep FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM again) GROUP BY r),
        m AS (SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
                     length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, coalesce(n_dup, 0)::BIGINT AS n_dup_lines,
                     coalesce(n_rep, 0)::BIGINT AS n_repeat_words, coalesce(n_lines, 0) AS n_lines
              FROM d LEFT JOIN dup USING (r) LEFT JOIN rep USING (r))
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
               NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR 10 * n_symbols > n_words
                    OR word_chars < 2 * n_words OR word_chars > 15 * n_words OR 2 * n_dup_lines > n_lines) AS kept
        FROM m""",
    "op12_lexical": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, unnest(regexp_extract_all(
                     translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS t FROM documents),
        tf AS (SELECT r, doc_id, t, count(*) AS tf FROM d GROUP BY ALL),
        sizes AS (SELECT r, sum(tf)::BIGINT AS n FROM tf GROUP BY r),
        c AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM sizes),
        w AS (SELECT t, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tf, c GROUP BY t, docs),
        q AS (SELECT item_id, t, count(*)::BIGINT AS often FROM (SELECT item_id, unnest(regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS t FROM benchmark) GROUP BY ALL),
        scored AS (
          SELECT item_id, r, doc_id, sum(often * w * ((1000000000 * tf::BIGINT) // (1000 * tf::BIGINT + 8 * (25 + (75 * n * docs) // total))))::BIGINT AS score
          FROM q JOIN w USING (t) JOIN tf USING (t) JOIN sizes USING (r), c GROUP BY item_id, r, doc_id)
        SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (
          SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= 10""",
    "op13_interaction": r"""
        WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        known AS (SELECT doc_id, max((quality = 1)::INTEGER) AS good, max((toxic = 1)::INTEGER) AS toxic FROM labels GROUP BY doc_id),
        f AS (
          SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
                 (len(w) < 100)::INTEGER + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::INTEGER
                 + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t))::INTEGER
                 + 8 * regexp_matches(t, '[#$%&*|]')::INTEGER + 16 * coalesce(d.doc_id > min(d.doc_id) OVER (PARTITION BY t), false)::INTEGER AS bits
          FROM d LEFT JOIN known ON known.doc_id = d.doc_id),
        n AS (SELECT part, bits, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, bits),
        five AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c, unnest([1, 2, 4, 8, 16]) AS b),
        orders AS (
          SELECT a.c || b.c || c.c || d.c || e.c AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS o
          FROM five a, five b, five c, five d, five e WHERE a.b + b.b + c.b + d.b + e.b = 31 AND len(list_distinct([a.b, b.b, c.b, d.b, e.b])) = 5),
        steps AS (SELECT filter_order, step, o[step] AS f, coalesce(list_sum(o[1:step - 1]), 0)::INTEGER AS b FROM orders, range(1, 6) AS s(step))
        SELECT part, filter_order, step::INTEGER AS step,
               coalesce(sum(n) FILTER (WHERE bits & f = 0 AND bits & b = 0), 0)::BIGINT AS kept,
               coalesce(sum(n) FILTER (WHERE bits & f > 0 AND bits & b = 0), 0)::BIGINT AS removed,
               coalesce(sum(n) FILTER (WHERE bits & f > 0 AND bits & b > 0), 0)::BIGINT AS redundant,
               coalesce(sum(n) FILTER (WHERE bits = f), 0)::BIGINT AS unique_fails,
               coalesce(sum(good) FILTER (WHERE bits & f > 0 AND bits & b = 0), 0)::BIGINT AS good_lost,
               coalesce(sum(toxic) FILTER (WHERE bits & f > 0 AND bits & b = 0), 0)::BIGINT AS toxic_lost,
               coalesce(sum(n * (120 // greatest(bit_count(bits), 1))) FILTER (WHERE bits & f > 0), 0)::BIGINT AS shapley
        FROM n, steps GROUP BY part, filter_order, step""",
}
