"""Views of the given tables that stand for pipeline inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quillon.config import DatasetSpec, PayloadSpec

DIM = 64

PRODUCTS = DatasetSpec(
    dataset="part",
    id_column="p_partkey",
    text_template="{p_name} {p_brand} {p_type}",
    modality="text",
    payload=PayloadSpec(
        indexes={
            "p_brand": "keyword", "p_type": "keyword", "p_size": "integer", "p_retailprice": "float",
        }
    ),
)
DOCUMENTS = DatasetSpec(
    dataset="documents", id_column="doc_id", text_template="{text}", modality="text",
    payload=PayloadSpec(include=("lang", "source", "n_chars")),
)
CUSTOMERS = DatasetSpec(
    dataset="customer", id_column="c_custkey", text_template="{c_name} in {c_mktsegment}",
    modality="text",
    payload=PayloadSpec(
        include=("c_custkey", "c_acctbal", "c_nationkey", "c_phone", "c_mktsegment"),
        exclude=("c_mktsegment",),
    ),
)
PAGES = DatasetSpec(
    dataset="pages", id_column="page_id", text_template="{url}", image_column="url",
    modality="multimodal", payload=PayloadSpec(include=("url",)),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def line_id() -> Column:
    """Record id of an order line."""
    return F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))


# One order line, first by all columns, for each (l_orderkey, l_linenumber).
LINE_ORDER = [
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
]


def line_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as record states."""
    flag = F.col("l_returnflag")
    return table(spark, sf_dir, "lineitem").select(
        line_id().alias("record_id"),
        F.when(flag == "A", "ok").when(flag == "N", "failed_404").otherwise("pending").alias("image_status"),
        F.when(F.col("l_linestatus") == "F", "ok").otherwise("pending").alias("embed_status"),
        F.pmod("l_linenumber", F.lit(4)).cast("int").alias("embed_attempts"),
        F.concat(F.lit("batches/"), F.col("l_orderkey").cast("string")).alias("batch_id"),
        F.col("l_orderkey").alias("shard_id"),
        F.when(flag == "R", "ok").otherwise("pending").alias("upsert_status"),
        "l_partkey", "l_suppkey",
    )


LINE_STATES_SQL = """
  SELECT l_orderkey || '-' || l_linenumber AS record_id,
         CASE l_returnflag WHEN 'A' THEN 'ok' WHEN 'N' THEN 'failed_404' ELSE 'pending' END AS image_status,
         CASE l_linestatus WHEN 'F' THEN 'ok' ELSE 'pending' END AS embed_status,
         l_linenumber % 4 AS embed_attempts,
         'batches/' || l_orderkey AS batch_id,
         l_orderkey AS shard_id,
         CASE l_returnflag WHEN 'R' THEN 'ok' ELSE 'pending' END AS upsert_status,
         l_partkey, l_suppkey
  FROM lineitem"""


def order_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as batches, their lines giving the token estimate."""
    sizes = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("shard_id")).agg(
        F.count(F.lit(1)).alias("record_count")
    )
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("shard_id"),
        F.concat(F.lit("batches/"), F.col("o_orderkey").cast("string")).alias("batch_id"),
        F.when(F.col("o_orderstatus") == "F", "SUCCEEDED")
        .when(F.col("o_orderstatus") == "O", "PENDING")
        .when(F.col("o_orderpriority") == "1-URGENT", "SUBMITTED")
        .otherwise("FAILED").alias("state"),
    )
    count = F.coalesce("record_count", F.lit(0))
    return orders.join(sizes, "shard_id", "left").select(
        "shard_id", "batch_id", "state",
        count.alias("record_count"),
        (count * 330).alias("est_tokens"),
        F.concat(F.lit("shard_"), F.col("shard_id").cast("string")).alias("request_file"),
    )


ORDER_BATCHES_SQL = """
  SELECT o_orderkey AS shard_id, 'batches/' || o_orderkey AS batch_id,
         CASE WHEN o_orderstatus = 'F' THEN 'SUCCEEDED' WHEN o_orderstatus = 'O' THEN 'PENDING'
              WHEN o_orderpriority = '1-URGENT' THEN 'SUBMITTED' ELSE 'FAILED' END AS state,
         coalesce(n, 0) AS record_count, coalesce(n, 0) * 330 AS est_tokens,
         'shard_' || o_orderkey AS request_file
  FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1)
    ON l_orderkey = o_orderkey"""


def lifecycle_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User events as record events: one log entry each, in event order."""
    kind = F.col("event_type")
    event = (
        F.when(kind == "signup", "assign").when(kind == "click", "submit")
        .when(kind == "purchase", "embed_ok").when(kind == "error", "embed_failed")
        .when((kind == "view") & (F.col("value") < 20), "reset")
        .when((kind == "view") & (F.col("value") < 60), "upsert").otherwise("image")
    )
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("record_id"),
        F.col("event_id").alias("seq"),
        event.alias("event"),
        F.when(event == "image", F.when(F.pmod("event_id", F.lit(3)) == 0, "failed_404").otherwise("ok"))
        .alias("image_status"),
        F.when(event == "image", F.md5(F.col("event_id").cast("string"))).alias("image_sha"),
        F.when(event == "assign", F.pmod("event_id", F.lit(1000))).alias("shard_id"),
        F.when(event == "submit", F.concat(F.lit("b"), F.pmod("event_id", F.lit(1000)).cast("string")))
        .alias("batch_id"),
    )


LIFECYCLE_EVENTS_SQL = """
  SELECT user_id::VARCHAR AS record_id, event_id AS seq, event,
         CASE WHEN event = 'image' THEN CASE WHEN event_id % 3 = 0 THEN 'failed_404' ELSE 'ok' END END AS image_status,
         CASE WHEN event = 'image' THEN md5(event_id::VARCHAR) END AS image_sha,
         CASE WHEN event = 'assign' THEN event_id % 1000 END AS shard_id,
         CASE WHEN event = 'submit' THEN 'b' || (event_id % 1000) END AS batch_id
  FROM (SELECT *, CASE event_type WHEN 'signup' THEN 'assign' WHEN 'click' THEN 'submit'
          WHEN 'purchase' THEN 'embed_ok' WHEN 'error' THEN 'embed_failed'
          ELSE CASE WHEN value < 20 THEN 'reset' WHEN value < 60 THEN 'upsert' ELSE 'image' END END AS event
        FROM events)"""


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as stored vectors."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("record_id"), F.col("embedding").alias("vector"), "label"
    )


def result_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as result lines of every class, by vec_id % 10, in files of label batches."""
    key = F.col("vec_id").cast("string")
    kind = F.pmod("vec_id", F.lit(10))
    values = F.transform("embedding", lambda x: x.cast("double"))

    def line(vector):
        response = F.struct(F.struct(vector.alias("values")).alias("embedding")).alias("response")
        return F.to_json(F.struct(key.alias("key"), response))

    error = F.to_json(F.struct(
        key.alias("key"), F.struct(F.lit(429).alias("code")).alias("error")
    ))
    keyless = F.to_json(F.struct(
        F.struct(F.struct(values.alias("values")).alias("embedding")).alias("response")
    ))
    value = (
        F.when(kind == 0, error)
        .when(kind == 1, line(F.slice(values, 1, 32)))
        .when(kind == 2, F.concat(F.lit('{"key": "'), key, F.lit('", ')))
        .when(kind == 3, keyless)
        .when(kind == 4, line(F.slice(values, 1, 0)))
        .when(kind == 5, line(F.transform(values, lambda x: x * 1.5)))
        .otherwise(line(values))
    )
    batch = F.concat(F.lit("batches/"), F.col("label").cast("string"))
    return table(spark, sf_dir, "embeddings").select(
        value.alias("value"),
        batch.alias("batch_id"),
        F.concat(F.lit("/results/batches_"), F.col("label").cast("string"), F.lit(".jsonl")).alias("file_path"),
        F.lit(0).cast("long").alias("file_block"),
        F.col("vec_id").alias("line_no"),
    )


RESULT_CLASS_SQL = """
  SELECT vec_id, label, embedding,
         CASE vec_id % 10 WHEN 0 THEN 'error' WHEN 1 THEN 'wrong_dim' WHEN 2 THEN 'bad_json'
              WHEN 3 THEN 'missing_key' WHEN 4 THEN 'empty_values' END AS error_class,
         CASE WHEN vec_id % 10 = 5 THEN 1.5 ELSE 1.0 END AS factor
  FROM embeddings"""
