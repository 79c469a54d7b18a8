import re

import pytest
from pyspark.sql import functions as F

from quillon.operators import points as pt
from quillon.plans.workspace import Workspace
from quillon.registry.fixtures import PRODUCTS
from quillon.session import fresh_path
from quillon.sources.bucketed import BucketedLog
from quillon.sources.results import POSITION


def exchanged(df):
    """Input columns of every exchange of a frame's plan."""
    plan = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return re.findall(r"\(\d+\) (?:Broadcast)?Exchange\nInput \[\d+\]: \[(.*?)\]\n", plan)


@pytest.fixture
def large(spark):
    """Without broadcast joins, as for tables of any size."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def points(spark, names, value):
    return spark.createDataFrame([(f"p{n}", n, [float(value)], "{}") for n in names], pt.POINT_SCHEMA)


def held(df):
    return sorted((r.record_id, r.vector[0]) for r in df.collect())


def test_versions_replace_each_other(spark):
    store = pt.PointStore(spark, fresh_path(spark, "points"), 4)
    assert held(store.current([])) == []
    assert store.write(points(spark, "abc", 1), 1, []).count() == 3
    store.write(points(spark, "bd", 2), 2, [1])
    store.write(points(spark, "bc", 3), 3, [1, 2])
    assert held(store.current([1])) == [("a", 1), ("b", 1), ("c", 1)]
    assert held(store.current([1, 2])) == [("a", 1), ("b", 2), ("c", 1), ("d", 2)]
    assert held(store.current([1, 2, 3])) == [("a", 1), ("b", 3), ("c", 3), ("d", 2)]
    store.write(points(spark, "b", 9), 3, [1, 2])
    assert held(store.current([1, 2, 3])) == [("a", 1), ("b", 9), ("c", 1), ("d", 2)]
    store.write(points(spark, "", 9), 4, [1, 2, 3])
    assert len(held(store.current([1, 2, 3, 4]))) == 4
    # A version that was never committed is not seen, nor what it superseded.
    store.write(points(spark, "a", 7), 5, [1, 2, 3, 4])
    assert held(store.current([1, 2, 3, 4])) == [("a", 1), ("b", 9), ("c", 1), ("d", 2)]


def test_another_session_reads_the_folder(spark):
    path = fresh_path(spark, "log")
    log = BucketedLog(spark, path, "k string, v int", "k", 3)
    log.write(spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int"), 10)
    log.write(spark.createDataFrame([("a", 3)], "k string, v int"), 11)
    other = BucketedLog(spark.newSession(), path, "k string, v int", "k", 3)
    assert sorted(map(tuple, other.read([10, 11]).collect())) == [("a", 1, 10), ("a", 3, 11), ("b", 2, 10)]
    assert other.read([11]).count() == 1 and other.read([]).count() == 0


def test_no_exchange_carries_a_vector(large):
    spark = large
    ws = Workspace(spark, fresh_path(spark, "ws"), PRODUCTS, buckets=5)
    vectors = spark.range(60).select(
        F.lit("b").alias("batch_id"), F.col("id").cast("string").alias("record_id"), F.lit("").alias("point_id"),
        F.array(F.col("id").cast("float")).alias("vector"), F.lit(True).alias("known"), F.lit("f").alias("file_path"),
        F.lit(0).cast("long").alias("file_block"), "id").withColumnRenamed("id", "line_no")
    for epoch in (1, 2):
        ws._vectors.write(ws._vectors.placed(vectors), epoch)
        ws._commit("collect", epoch)
    state = spark.range(60).select(F.col("id").cast("string").alias("record_id"), F.lit("ok").alias("embed_status"), F.lit("pending").alias("upsert_status"))
    records = state.select("record_id", F.concat(F.lit("p"), "record_id").alias("point_id"), F.lit("{}").alias("payload"))
    incoming = pt.points_to_upsert(state, records, ws.vectors(), ["epoch", *POSITION])
    assert exchanged(incoming) and not any("vector" in c for c in exchanged(incoming))
    for version in (3, 4):
        ws._points.write(incoming, version, [v for v in (3,) if v < version])
        ws._commit("upsert", version)
    current = ws.points()
    assert exchanged(current) and not any("vector" in c for c in exchanged(current))
    assert current.count() == 60 and incoming.count() == 60
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(f"{ws.root}/points/versions/epoch=3")
    assert files.count() <= 5  # written from its buckets: one file each


def test_last_vector_of_a_pending_record_wins(spark, rows):
    state = spark.createDataFrame([("a", "ok", "pending"), ("b", "ok", "ok"), ("c", "pending", "pending"), ("d", "ok", "pending")],
                                  "record_id string, embed_status string, upsert_status string")
    records = state.selectExpr("record_id", "concat('p', record_id) AS point_id", "'{}' AS payload")
    vectors = spark.createDataFrame(
        [("a", [1.0], 1, None), ("a", [2.0], 2, None), ("a", [3.0], 2, 0), ("b", [4.0], 1, 0), ("c", [5.0], 1, 0), ("x", [6.0], 1, 0)],
        "record_id string, vector array<float>, seq int, line int")
    assert rows(pt.points_to_upsert(state, records, vectors, ["seq", "line"])) == [("pa", "a", [3.0], "{}")]
