"""Queries over normalisation, profiling and the input contract."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillon.config import DatasetSpec, PayloadSpec
from quillon.functions.keys import point_id
from quillon.operators.contract import input_contract
from quillon.operators.normalize import normalize, split_null_ids
from quillon.operators.numbering import global_index
from quillon.operators.points import typed_payload
from quillon.operators.profile import column_roles, profile
from quillon.operators.rollup import RANK_ERROR, ProfileStore
from quillon.operators.sampling import most_recent, pilot, seeded_sample
from quillon.registry.fixtures import CUSTOMERS, DOCUMENTS, PAGES, PRODUCTS, line_id, table
from quillon.session import fresh_path, materialize
from quillon.sources.tables import read_table, read_with_row_index

UUID_SQL = """(SELECT substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-'
  || substr('89ab', (('0x' || substr(h, 17, 1))::INTEGER & 3) + 1, 1) || substr(h, 18, 3) || '-'
  || substr(h, 21, 12)
  FROM (SELECT sha1(from_hex('6ba7b8109dad11d180b400c04fd430c8') || encode({id})) AS h))"""


def uuid_sql(expression: str) -> str:
    return UUID_SQL.replace("{id}", expression)


def normalize_products(spark, sf_dir):
    return normalize(table(spark, sf_dir, "part"), PRODUCTS).select(
        "record_id", "point_id", "text", "payload"
    )


def normalize_customers(spark, sf_dir):
    records = normalize(table(spark, sf_dir, "customer"), CUSTOMERS)
    return records.select("record_id", "point_id", "text", "payload")


def normalize_pages(spark, sf_dir):
    return normalize(table(spark, sf_dir, "pages"), PAGES).select(
        "record_id", "point_id", "text", "image_url", "payload"
    )


def format_template(spark, sf_dir):
    spec = DatasetSpec(
        dataset="part", id_column="p_partkey", modality="text",
        text_template="{{{p_name}}} costs {p_retailprice:.1f} ({p_size:04d}), plain {p_retailprice}",
    )
    return normalize(table(spark, sf_dir, "part"), spec).select("record_id", "text")


def payload_coercion(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", F.to_date("o_orderdate").alias("day"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("price"),
        (F.col("o_orderstatus") == "F").alias("done"),
    )
    spec = DatasetSpec(dataset="orders", id_column="o_orderkey", modality="text",
                       text_template="{done} {o_orderkey}")
    return normalize(orders, spec).select("record_id", "text", "payload")


def row_index(spark, sf_dir):
    rows = read_with_row_index(spark, f"{sf_dir}/documents.parquet")
    spec = DatasetSpec(dataset="documents", text_template="{lang}", modality="text",
                       payload=PayloadSpec(include=("doc_id",)))
    return normalize(rows, spec, "row_index").select("record_id", "point_id", "payload")


def split_rows(spark, sf_dir):
    """Labelled documents stored as one split, the others as a second one; both read by name."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    path = fresh_path(spark, "splits")
    docs.join(labels, "doc_id", "left_semi").write.parquet(f"{path}/train")
    docs.join(labels, "doc_id", "left_anti").write.parquet(f"{path}/test-00000")
    train, test = (
        read_table(spark, path, split=name).select(F.lit(name).alias("split"), "doc_id", F.md5("text").alias("text_md5"))
        for name in ("train", "test")
    )
    return train.unionByName(test)


def ordered_index(spark, sf_dir):
    ids = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("record_id"))
    return global_index(ids, ["record_id"])


def null_ids(spark, sf_dir):
    """Labels joined to documents from the left: documents without labels have no label id."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    joined = docs.join(labels.withColumnRenamed("doc_id", "label_id"), F.col("doc_id") == F.col("label_id"), "left")
    spec = DatasetSpec(dataset="labelled", id_column="label_id", text_template="{lang}", modality="text",
                       payload=PayloadSpec(include=("quality", "toxic")))
    usable, quarantined = split_null_ids(normalize(joined, spec))
    return usable.select(F.lit("usable").alias("part"), "payload").unionByName(
        quarantined.select(F.lit("quarantined").alias("part"), "payload")
    ).groupBy("part", "payload").agg(F.count(F.lit(1)).alias("n"))


def contract_of_lines(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("id", line_id())
    spec = DatasetSpec(
        dataset="lineitem", id_column="id", text_template="{l_returnflag}", modality="text",
        payload=PayloadSpec(include=("l_tax",), indexes={"l_tax": "float", "l_discount": "float"}),
    )
    records = normalize(lines, DatasetSpec(dataset="lineitem", id_column="id",
                                           text_template="{l_returnflag}", modality="text"))
    return input_contract(lines, records, spec)


def profile_products(spark, sf_dir):
    return profile(table(spark, sf_dir, "part"), distinct=False)


def profile_labelled(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return profile(docs.join(labels, "doc_id", "left"), distinct=False)


def profile_distinct(spark, sf_dir):
    """Distinct estimates of a profile, beside the exact counts they must be close to."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag", "l_shipdate")
    counts = [
        lines.select(c).distinct().agg(F.lit(c).alias("column"), F.count(c).alias("exact"))
        for c in lines.columns
    ]
    exact = counts[0]
    for count in counts[1:]:
        exact = exact.unionByName(count)
    close = F.abs(F.col("approx_distinct") - F.col("exact")) <= 0.05 * F.col("exact")
    return profile(lines).join(exact, "column").select("column", "exact", close.alias("close"))


def profile_epochs(spark, sf_dir):
    """Lines profiled in three epochs, merged from their sketches, beside what must be close."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus")
    store = ProfileStore(spark, fresh_path(spark, "profiles"))
    for epoch in range(3):
        store.add(lines.where(F.col("l_orderkey") % 3 == epoch), epoch)
    merged = materialize(store.profile(top=1), "profile")
    medians = {r.column: r.quantiles[1] for r in merged.where("quantiles IS NOT NULL").select("column", "quantiles").collect()}
    close = []
    for c in lines.columns:
        below, upto = F.lit(0.5), F.lit(0.5)
        if c in medians:
            below, upto = F.avg((F.col(c) < medians[c]).cast("int")), F.avg((F.col(c) <= medians[c]).cast("int"))
        close.append(F.struct(F.lit(c).alias("column"), F.count_distinct(c).alias("exact"),
                              ((below <= 0.5 + RANK_ERROR) & (upto >= 0.5 - RANK_ERROR)).alias("median_close")))
    exact = lines.agg(F.array(*close).alias("rows")).select(F.inline("rows"))
    near = F.abs(F.col("approx_distinct") - F.col("exact")) <= 0.05 * F.col("exact")
    few = F.col("exact") <= 100
    return merged.join(exact, "column").select(
        "column", "type", "n_rows", "n_nulls", near.alias("distinct_close"), "median_close",
        F.when(few, F.col("top")[0]["item"]).alias("top_value"), F.when(few, F.col("top")[0]["count"]).alias("top_count"))


def column_role_rows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumn("id", F.col("doc_id").cast("string"))
    return column_roles(profile(docs.select("lang", "id", "text", "source", "n_chars"), distinct=False))


def typed_filter(spark, sf_dir):
    records = normalize(table(spark, sf_dir, "part"), PRODUCTS)
    typed = typed_payload(records, PRODUCTS.payload.indexes)
    return typed.where((F.col("p_size") >= 10) & (F.col("p_retailprice") < 950.0)).select(
        "record_id", "p_brand", "p_type", "p_size", "p_retailprice"
    )


def typed_props(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", F.col("props").alias("payload"))
    typed = typed_payload(events, {"k": "integer", "absent": "keyword"})
    return typed.groupBy(F.pmod("k", F.lit(10)).alias("bucket")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("k").alias("total"), F.count("absent").alias("n_absent")
    )


def seeded_sample_rows(spark, sf_dir):
    return seeded_sample(table(spark, sf_dir, "part").select("p_partkey", "p_name"), "p_partkey", 100)


def most_recent_jobs(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus")
    return most_recent(orders, "o_orderdate", 20, "o_orderkey").select("o_orderkey", "o_orderstatus")


def pilot_rows(spark, sf_dir):
    return pilot(normalize(table(spark, sf_dir, "documents"), DOCUMENTS), "record_id", 500).select(
        "record_id", "payload"
    )


def index_types(spark, sf_dir):
    """Customers as points whose payload fields have every index type; some don't fit theirs."""
    key = F.col("c_custkey").cast("string")
    payload = F.to_json(F.struct(
        (F.col("c_acctbal") > 0).alias("flag"),
        F.when(F.col("c_custkey") % 3 > 0, F.date_format(
            F.timestamp_seconds(F.col("c_custkey") + 1704067200), "yyyy-MM-dd HH:mm:ss")).otherwise("no time").alias("at"),
        F.when(F.col("c_custkey") % 2 == 0, F.upper(point_id(key))).otherwise(key).alias("link"),
        F.struct(F.col("c_acctbal").alias("lon"), F.col("c_nationkey").alias("lat")).alias("pos"),
        F.col("c_name").alias("name"),
    ))
    points = table(spark, sf_dir, "customer").select(key.alias("point_id"), payload.alias("payload"))
    kinds = {"flag": "bool", "at": "datetime", "link": "uuid", "pos": "geo", "name": "text"}
    return typed_payload(points, kinds).select(
        "point_id", "flag", "at", "link", F.col("pos.lon").alias("lon"), F.col("pos.lat").alias("lat"), "name")


QUERIES = {
    "normalize_records": normalize_products,
    "normalize_customers": normalize_customers,
    "normalize_pages": normalize_pages,
    "format_template": format_template,
    "payload_coercion": payload_coercion,
    "row_index": row_index,
    "table_splits": split_rows,
    "ordered_index": ordered_index,
    "null_ids": null_ids,
    "input_contract": contract_of_lines,
    "profile_products": profile_products,
    "profile_labelled": profile_labelled,
    "profile_distinct": profile_distinct,
    "profile_epochs": profile_epochs,
    "column_roles": column_role_rows,
    "payload_typed_filter": typed_filter,
    "payload_typed_props": typed_props,
    "payload_index_types": index_types,
    "sample_seeded": seeded_sample_rows,
    "most_recent_jobs": most_recent_jobs,
    "pilot_rows": pilot_rows,
}

ORACLES = {
    "normalize_records": f"""
        SELECT p_partkey::VARCHAR AS record_id, {uuid_sql('p_partkey::VARCHAR')} AS point_id,
               p_name || ' ' || p_brand || ' ' || p_type AS text,
               '{{"p_name":"' || p_name || '","p_brand":"' || p_brand || '","p_type":"' || p_type
               || '","p_size":' || p_size || ',"p_retailprice":' || p_retailprice || '}}' AS payload
        FROM part""",
    "normalize_customers": f"""
        SELECT c_custkey::VARCHAR AS record_id, {uuid_sql('c_custkey::VARCHAR')} AS point_id,
               c_name || ' in ' || c_mktsegment AS text,
               '{{"c_acctbal":' || c_acctbal || ',"c_nationkey":' || c_nationkey
               || ',"c_phone":null}}' AS payload
        FROM customer""",
    "normalize_pages": f"""
        SELECT page_id::VARCHAR AS record_id, {uuid_sql('page_id::VARCHAR')} AS point_id,
               url AS text, url AS image_url, '{{"url":"' || url || '"}}' AS payload
        FROM pages""",
    "format_template": """
        SELECT p_partkey::VARCHAR AS record_id,
               '{' || p_name || '} costs ' || printf('%.1f', p_retailprice) || ' ('
               || printf('%04d', p_size) || '), plain ' || p_retailprice AS text
        FROM part""",
    "payload_coercion": """
        SELECT o_orderkey::VARCHAR AS record_id,
               CASE WHEN o_orderstatus = 'F' THEN 'True' ELSE 'False' END || ' ' || o_orderkey AS text,
               '{"o_orderdate":"' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '","day":"'
               || strftime(o_orderdate, '%Y-%m-%d') || '","price":"' || o_totalprice::DECIMAL(12,2)
               || '","done":' || (o_orderstatus = 'F') || '}' AS payload
        FROM orders""",
    "row_index": f"""
        SELECT i::VARCHAR AS record_id, {uuid_sql('i::VARCHAR')} AS point_id,
               '{{"doc_id":' || doc_id || '}}' AS payload
        FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents)""",
    "table_splits": """
        SELECT CASE WHEN doc_id IN (SELECT doc_id FROM labels) THEN 'train' ELSE 'test' END AS split,
               doc_id, md5(text) AS text_md5 FROM documents""",
    "ordered_index": """
        SELECT doc_id::VARCHAR AS record_id, row_number() OVER (ORDER BY doc_id::VARCHAR) - 1 AS row_index
        FROM documents""",
    "null_ids": """
        SELECT CASE WHEN l.doc_id IS NULL THEN 'quarantined' ELSE 'usable' END AS part,
               '{"quality":' || coalesce(quality::VARCHAR, 'null') || ',"toxic":'
               || coalesce(toxic::VARCHAR, 'null') || '}' AS payload, count(*) AS n
        FROM documents d LEFT JOIN labels l USING (doc_id) GROUP BY 1, 2""",
    "input_contract": """
        WITH c AS (SELECT count(*) AS n, count(DISTINCT l_orderkey || '-' || l_linenumber) AS d FROM lineitem)
        SELECT "check", severity, count::BIGINT AS count FROM (
          SELECT 'rows' AS "check", 'info' AS severity, n AS count FROM c
          UNION ALL SELECT 'null_ids', 'error', 0
          UNION ALL SELECT 'duplicate_ids', 'warning', n - d FROM c
          UNION ALL SELECT 'blank_text', 'warning', count(*) FROM lineitem WHERE trim(l_returnflag) = ''
          UNION ALL SELECT 'empty_urls', 'warning', 0
          UNION ALL SELECT 'schema_violations', 'error', 1
          UNION ALL SELECT 'unreachable_indexes', 'warning', 1)""",
    "profile_products": """
        SELECT position, "column", type, '' AS note, (SELECT count(*) FROM part) AS n_rows, n_nulls FROM (
          VALUES (0, 'p_partkey', 'int64', (SELECT count(*) FROM part WHERE p_partkey IS NULL)),
                 (1, 'p_name', 'string', (SELECT count(*) FROM part WHERE p_name IS NULL)),
                 (2, 'p_brand', 'string', (SELECT count(*) FROM part WHERE p_brand IS NULL)),
                 (3, 'p_type', 'string', (SELECT count(*) FROM part WHERE p_type IS NULL)),
                 (4, 'p_size', 'int32', (SELECT count(*) FROM part WHERE p_size IS NULL)),
                 (5, 'p_retailprice', 'float64', (SELECT count(*) FROM part WHERE p_retailprice IS NULL))
        ) AS t(position, "column", type, n_nulls)""",
    "profile_labelled": """
        WITH j AS (SELECT d.*, quality, toxic FROM documents d LEFT JOIN labels USING (doc_id))
        SELECT position, "column", type, '' AS note, (SELECT count(*) FROM j) AS n_rows, n_nulls FROM (
          VALUES (0, 'doc_id', 'int64', (SELECT count(*) FROM j WHERE doc_id IS NULL)),
                 (1, 'text', 'string', (SELECT count(*) FROM j WHERE text IS NULL)),
                 (2, 'lang', 'string', (SELECT count(*) FROM j WHERE lang IS NULL)),
                 (3, 'source', 'string', (SELECT count(*) FROM j WHERE source IS NULL)),
                 (4, 'n_chars', 'int64', (SELECT count(*) FROM j WHERE n_chars IS NULL)),
                 (5, 'quality', 'int32', (SELECT count(*) FROM j WHERE quality IS NULL)),
                 (6, 'toxic', 'int32', (SELECT count(*) FROM j WHERE toxic IS NULL))
        ) AS t(position, "column", type, n_nulls)""",
    "profile_distinct": """
        SELECT 'l_orderkey' AS "column", count(DISTINCT l_orderkey) AS exact, true AS close FROM lineitem
        UNION ALL SELECT 'l_partkey', count(DISTINCT l_partkey), true FROM lineitem
        UNION ALL SELECT 'l_returnflag', count(DISTINCT l_returnflag), true FROM lineitem
        UNION ALL SELECT 'l_shipdate', count(DISTINCT l_shipdate), true FROM lineitem""",
    "profile_epochs": """
        WITH n AS (SELECT count(*) AS n_rows FROM lineitem),
        v AS (SELECT 'l_returnflag' AS "column", l_returnflag AS item, count(*) AS n FROM lineitem GROUP BY 2
              UNION ALL SELECT 'l_linestatus', l_linestatus, count(*) FROM lineitem GROUP BY 2
              UNION ALL SELECT 'l_quantity', CASE WHEN l_quantity = floor(l_quantity) THEN l_quantity::BIGINT || '.0' ELSE l_quantity::VARCHAR END,
                               count(*) FROM lineitem GROUP BY 2),
        t AS (SELECT "column", item, n, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, item) AS place FROM v)
        SELECT c AS "column", kind AS type, n_rows, 0::BIGINT AS n_nulls, true AS distinct_close, true AS median_close,
               item AS top_value, t.n AS top_count
        FROM (VALUES ('l_orderkey', 'int64'), ('l_quantity', 'float64'), ('l_extendedprice', 'float64'),
                     ('l_returnflag', 'string'), ('l_linestatus', 'string')) AS k(c, kind)
        CROSS JOIN n LEFT JOIN t ON t."column" = c AND place = 1""",
    "column_roles": """
        SELECT * FROM (VALUES ('id', 'id'), ('lang', 'template'), ('text', 'template'),
                              ('text', 'modality')) AS t("column", role)
        WHERE (SELECT count(*) > 0 FROM documents)""",
    "payload_typed_filter": """
        SELECT p_partkey::VARCHAR AS record_id, p_brand, p_type, p_size::BIGINT AS p_size, p_retailprice
        FROM part WHERE p_size >= 10 AND p_retailprice < 950.0""",
    "payload_index_types": f"""
        SELECT c_custkey::VARCHAR AS point_id, c_acctbal > 0 AS flag,
               CASE WHEN c_custkey % 3 > 0 THEN TIMESTAMP '2024-01-01 00:00:00' + to_seconds(c_custkey) END AS at,
               CASE WHEN c_custkey % 2 = 0 THEN {uuid_sql('c_custkey::VARCHAR')} END AS link,
               c_acctbal AS lon, c_nationkey::DOUBLE AS lat, c_name AS name
        FROM customer""",
    "payload_typed_props": """
        SELECT k % 10 AS bucket, count(*) AS n, sum(k)::BIGINT AS total, 0::BIGINT AS n_absent
        FROM (SELECT (props->>'$.k')::BIGINT AS k FROM events) GROUP BY 1""",
    "sample_seeded": """
        SELECT p_partkey, p_name FROM part ORDER BY md5('42:' || p_partkey), p_partkey LIMIT 100""",
    "most_recent_jobs": """
        SELECT o_orderkey, o_orderstatus FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 20""",
    "pilot_rows": """
        SELECT doc_id::VARCHAR AS record_id,
               '{"lang":"' || lang || '","source":"' || source || '","n_chars":' || n_chars || '}' AS payload
        FROM documents ORDER BY 1 LIMIT 500""",
}
