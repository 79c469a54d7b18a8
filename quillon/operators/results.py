"""Embedding results: tolerant parsing, validation and collection."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from quillon.functions.keys import point_id
from quillon.functions.vectors import l2_norm
from quillon.operators.dedupe import last_write_wins
from quillon.operators.state import as_events
from quillon.sources.results import POSITION

LINE_SCHEMA = (
    "key string, error string, "
    "response struct<embedding:struct<values:array<double>>>"
)
# The accepted range of a vector's length.
NORM_LOW, NORM_HIGH = 0.95, 1.05


def parse_result_lines(lines: DataFrame, dim: int) -> DataFrame:
    """Result lines with ``key``, ``vector`` (double), ``norm`` and ``error_class``.

    error_class is null for a usable vector, else one of bad_json (also JSON that is no
    object), missing_key, error, empty_values, wrong_dim. No line fails the job.
    """
    parsed = lines.withColumn("_obj", F.from_json("value", LINE_SCHEMA))
    # A second look at the field names, only where the parsed fields leave a doubt: no key,
    # or an error field (spelled out or escaped) that may be there with a null value.
    doubtful = F.col("_obj.key").isNull() | F.col("value").contains('"error"') | F.col("value").contains("\\u")
    parsed = parsed.withColumn(
        "_fields", F.when(doubtful, F.json_object_keys("value")).otherwise(F.array().cast("array<string>"))
    )
    values = F.col("_obj.response.embedding.values")
    # The length is null for absent vectors and for vectors with null components.
    measured = parsed.withColumn("_norm", l2_norm(values))
    empty = F.col("_norm").isNull() | (F.size(values) == 0)
    error = (
        F.when(F.col("_fields").isNull(), "bad_json")
        .when(F.col("_obj.key").isNull(), "missing_key")
        .when(F.array_contains("_fields", "error"), "error")
        .when(empty, "empty_values")
        .when(F.size(values) != dim, "wrong_dim")
    )
    kept = [c for c in lines.columns if c != "value"]
    checked = measured.withColumn("error_class", error)
    ok = F.col("error_class").isNull()
    return checked.select(
        *kept,
        F.col("_obj.key").alias("key"),
        F.when(ok, values).alias("vector"),
        F.col("_obj.error").alias("error_text"),
        "error_class",
        F.when(ok, F.col("_norm")).alias("norm"),
        F.when(ok, ~F.col("_norm").between(NORM_LOW, NORM_HIGH)).alias("norm_warning"),
    )


def usable_results(parsed: DataFrame) -> DataFrame:
    return parsed.where("error_class IS NULL")


def failed_results(parsed: DataFrame) -> DataFrame:
    """Failures that name a record; keyless lines can be blamed on nobody."""
    return parsed.where("error_class IS NOT NULL AND key <> ''")


def result_events(parsed: DataFrame, run: int) -> DataFrame:
    """Lifecycle events of one collection run; a key both ok and failed ends as failed."""
    named = parsed.where("error_class IS NULL OR key <> ''")
    ok = F.col("error_class").isNull()
    return as_events(named.select(
        F.col("key").alias("record_id"),
        F.when(ok, F.lit(2 * run)).otherwise(F.lit(2 * run + 1)).alias("seq"),
        F.when(ok, "embed_ok").otherwise("embed_failed").alias("event"),
    ))


def collect_vectors(
    parsed: DataFrame, records: DataFrame, collected: DataFrame | None = None
) -> DataFrame:
    """Vectors to append: batch_id, record_id, point_id, vector (float), known.

    Within a batch the last line of a key wins. ``collected`` rows (batch_id, record_id)
    are left out, so a rerun adds nothing. Keys no record has get an empty point_id. Vectors
    are shuffled once, by (batch, record): which keys are known is looked up with keys alone.
    Point ids are computed, not fetched.
    """
    ok = usable_results(parsed).withColumnRenamed("key", "record_id")
    latest = last_write_wins(ok, ["batch_id", "record_id"], list(POSITION))
    if collected is not None:
        latest = latest.join(
            collected.select("batch_id", "record_id").hint("merge"), ["batch_id", "record_id"], "left_anti"
        )
    keys = ok.select("batch_id", "record_id").distinct()
    known = keys.join(records.select("record_id").hint("merge"), "record_id", "left_semi").withColumn("_known", F.lit(True))
    joined = latest.join(known.hint("merge"), ["batch_id", "record_id"], "left")
    is_known = F.coalesce("_known", F.lit(False))
    return joined.select(
        "batch_id",
        "record_id",
        F.when(is_known, point_id(F.col("record_id"))).otherwise("").alias("point_id"),
        F.col("vector").cast("array<float>").alias("vector"),
        is_known.alias("known"),
        *POSITION,
    )


def collect_totals(parsed: DataFrame) -> DataFrame:
    """One row: vectors usable, failures with a key, keyless lines, odd norms."""
    ok = F.col("error_class").isNull()
    named = F.coalesce(F.col("key") != "", F.lit(False))
    return parsed.agg(
        F.count_if(ok).alias("vectors"),
        F.count_if(~ok & named).alias("failures"),
        F.count_if(~ok & ~named).alias("keyless"),
        F.count_if(F.col("norm_warning")).alias("norm_warnings"),
    )


def append_vectors(vectors: DataFrame, path: str) -> None:
    """Add rows to the vectors table without touching what it holds."""
    vectors.write.mode("append").parquet(path)


def latest_vectors(vectors: DataFrame, order: list[str]) -> DataFrame:
    """Last collected vector of each record."""
    return last_write_wins(vectors, ["record_id"], order)


def embedding_errors(parsed: DataFrame) -> DataFrame:
    return parsed.where("error_class IS NOT NULL").groupBy("error_class").agg(
        F.count(F.lit(1)).alias("n")
    )
