"""Documents prepared for training: one stage per step, each over all its predecessor kept."""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F

import quillon
from quillon.llm import decontaminate, minhash, mixing, quality, sharding
from quillon.session import materialize

# Python workers need no copy of the package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(quillon)


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones, does not reject."""
    weights = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, weights).where("predicted = 1").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity 0.8) stays.

    Each row is a document, whatever its id: rows are numbered as they are written, so rows
    that share an id are compared by their texts and rows without one take part. Of a group
    the row with the least id stays (a null one last), of equal ids the first. Texts without
    words are no copies of anything.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    rows = materialize(docs.select(F.monotonically_increasing_id().alias("number"), row), "numbered")
    texts = rows.select("number", F.col("row.doc_id").cast("long").alias("id"), F.col("row.text").alias("text"))
    found = minhash.near_duplicates(texts, id_column="number").where("n_shingles > 0").select(
        F.col("doc_id").alias("number"), F.col("component_id").alias("root"))
    found = materialize(found, "groups")
    # Groups of one row have nothing to lose.
    groups = materialize(found.groupBy("root").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("root"), "several")
    members = found.join(groups, "root", "left_semi").join(texts.select("number", "id"), "number")
    members = materialize(members, "members")
    stays = members.groupBy("root").agg(F.min(F.struct(F.col("id").isNull(), "id", "number")).alias("first"))
    dropped = materialize(members.join(stays, "root").where("number <> first.number").select("number"), "dropped")
    return rows.join(dropped, "number", "left_anti").select("row.*")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for."""
    return mixing.mix(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and slot; every shard has the mixture of the whole."""
    return sharding.sharded(docs)


STAGES = [
    ("quality_filter", quality_filter),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixture", mixture),
    ("shards", shards),
]

#: The classifier's training can't be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
