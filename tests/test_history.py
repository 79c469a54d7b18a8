import random

import pytest
from pyspark.sql import functions as F

from quillon.config import DatasetSpec
from quillon.session import fresh_path
from quillon.streaming.history import KeyHistory
from quillon.streaming.ingest import ingest_stream

SPEC = DatasetSpec(dataset="d", id_column="id", text_template="{t}", modality="text")


def ids(spark, names):
    return spark.createDataFrame([(n,) for n in names], "record_id string")


def names(df):
    return sorted(r.record_id for r in df.collect())


def input_rows(spark, df, below):
    """Rows that scans below a folder read, from the finished plan's metrics."""
    df.collect()
    found, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif node.getClass().getSimpleName().endswith("QueryStageExec"):
            todo.append(node.plan())
        elif node.getClass().getSimpleName() == "FileSourceScanExec" and below in node.relation().location().rootPaths().mkString(","):
            found += node.metrics().apply("numOutputRows").value()
        for i in range(node.children().size()):
            todo.append(node.children().apply(i))
    return found


@pytest.mark.parametrize("buckets, blocks", [(1, 1), (8, 2)])
def test_known_ids_over_epochs(spark, buckets, blocks):
    history = KeyHistory(spark, fresh_path(spark, "history"), buckets, blocks)
    rng, seen = random.Random(buckets), set()
    for epoch in range(4):
        arrived = {f"k{rng.randrange(900)}" for _ in range(200)} | {"", "é"}
        assert names(history.known(ids(spark, arrived), epoch)) == sorted(arrived & seen)
        history.add(ids(spark, arrived - seen), epoch)
        seen |= arrived
    history.add(ids(spark, []), 4)
    assert names(history.known(ids(spark, seen), 5)) == sorted(seen)


def test_full_sieves_change_nothing(spark):
    """One bitmap for 20,000 ids has nearly every bit set."""
    history = KeyHistory(spark, fresh_path(spark, "history"), 2, 1)
    many = spark.range(20_000).select(F.concat(F.lit("a"), "id").alias("record_id"))
    history.add(many, 0)
    assert names(history.known(ids(spark, ["a5", "b5", "a19999", "a20000"]), 1)) == ["a19999", "a5"]


def test_only_hit_buckets_are_opened(spark):
    history = KeyHistory(spark, fresh_path(spark, "history"), 32, 4)
    many = spark.range(8_000).select(F.concat(F.lit("a"), "id").alias("record_id"))
    history.add(many, 0)
    sizes = {r.bucket: r.n for r in spark.read.parquet(f"{history.path}/ids").groupBy("bucket").agg(F.count("*").alias("n")).collect()}
    fresh = spark.range(500).select(F.concat(F.lit("b"), "id").alias("record_id"))
    assert len(sizes) == 32
    assert input_rows(spark, history.known(fresh, 1), "/ids") <= sum(sorted(sizes.values())[-8:])
    one = history.known(ids(spark, ["a77"]), 1)
    assert 0 < input_rows(spark, one, "/ids") <= max(sizes.values()) and names(one) == ["a77"]


def test_replayed_epoch_gives_the_same(spark, tmp_path):
    """A crash after the history is written, before the epoch is done."""
    source, out, offsets = (str(tmp_path / n) for n in ("in", "out", "offsets"))
    ddl = "id string, t string"

    def run(values):
        spark.createDataFrame(values, ddl).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(ddl).parquet(source)
        stored = ingest_stream(stream, SPEC, out, offsets, buckets=4, blocks=1)
        return sorted((r.record_id, r.text) for r in stored.collect())

    assert run([("a", "1"), ("b", "2")]) == [("a", "1"), ("b", "2")]
    # What the next epoch would leave behind if it died before it finished.
    KeyHistory(spark, f"{out}/history", 4, 1).add(ids(spark, ["c", "z"]), 1)
    assert run([("c", "3"), ("a", "9")]) == [("a", "1"), ("b", "2"), ("c", "3")]
    assert run([("c", "0"), ("z", "4"), (None, "x")]) == [("a", "1"), ("b", "2"), ("c", "3"), ("z", "4")]
