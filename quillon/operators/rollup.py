"""Profiles of growing tables: sketches stored per epoch and merged, so that no row is read twice."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from quillon.operators.profile import SKETCH_LG_K, SKETCHED_TYPES, type_name
from quillon.sources.epochs import read_epochs, write_epoch

#: Size of a quantile sketch, and how far a quantile's rank may be off (a share of the values).
QUANTILE_K, RANK_ERROR = 800, 0.01
#: Values tracked as frequent: counts are exact up to so many distinct values of a column.
TRACKED = 1_000
#: A longer value is counted as its beginning and a digest.
SHOWN = 200

SCHEMA = (
    "position int, column string, type string, n_rows bigint, n_nulls bigint, distinct binary, quantiles binary, "
    "top struct<sketch:binary, maxItemsTracked:int, itemDataType:string, itemDataTypeDDL:string>"
)


def _shown(value: Column, kind: T.DataType) -> Column:
    text = value.cast("string") if isinstance(kind, T.AtomicType) else F.to_json(F.struct(value.alias("value")))
    return F.when(F.length(text) <= SHOWN, text).otherwise(F.concat(F.left(text, F.lit(SHOWN)), F.lit("…"), F.md5(text)))


def sketched(rows: DataFrame) -> DataFrame:
    """One row of sketches per column, from one pass that shuffles a row per task.

    Quantiles are of numeric columns. An empty table has empty sketches.
    """
    fields = rows.schema.fields
    plain = rows.toDF(*(f"c{i}" for i in range(len(fields))))
    shown = [_shown(F.col(f"c{i}"), f.dataType).alias(f"s{i}") for i, f in enumerate(fields)]
    plain = plain.select("*", *shown)
    cells = [F.count(F.lit(1)).alias("n")]
    for i, f in enumerate(fields):
        value = F.col(f"c{i}")
        seen = value if isinstance(f.dataType, SKETCHED_TYPES) else F.col(f"s{i}")
        number = value.cast("double") if isinstance(f.dataType, T.NumericType) else F.lit(None).cast("double")
        cells += [
            F.count_if(value.isNull()).alias(f"nulls{i}"),
            F.hll_sketch_agg(seen, F.lit(SKETCH_LG_K)).alias(f"distinct{i}"),
            F.kll_sketch_agg_double(number, F.lit(QUANTILE_K)).alias(f"quantiles{i}"),
            F.expr(f"approx_top_k_accumulate(s{i}, {TRACKED}) FILTER (WHERE s{i} IS NOT NULL)").alias(f"top{i}"),
        ]
    found = [
        F.struct(
            F.lit(i).alias("position"), F.lit(f.name).alias("column"), F.lit(type_name(f.dataType)).alias("type"), F.col("n").alias("n_rows"),
            *(F.col(f"{name}{i}").alias(alias) for name, alias in (("nulls", "n_nulls"), ("distinct", "distinct"), ("quantiles", "quantiles"), ("top", "top"))))
        for i, f in enumerate(fields)
    ]
    kinds = T.StructType.fromDDL(SCHEMA)
    if not fields:
        return rows.sparkSession.createDataFrame([], kinds)
    return plain.agg(*cells).select(F.inline(F.array(*found))).select(*(F.col(f.name).cast(f.dataType) for f in kinds))


class ProfileStore:
    """Sketches of a table's epochs below a folder.

    Adding an epoch reads its rows alone; the profile of any epochs reads their sketches, one
    row per epoch and column.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def add(self, rows: DataFrame, epoch: int) -> None:
        """Store the sketches of one epoch's rows; adding it again replaces them."""
        write_epoch(sketched(rows).coalesce(1), self.path, epoch)

    def profile(self, epochs: Collection[int] | None = None, at: Sequence[float] = (0.25, 0.5, 0.75), top: int = 5) -> DataFrame:
        """(position, column, type, n_rows, n_nulls, approx_distinct, quantiles, top) over the epochs.

        ``quantiles`` are those ``at`` the given shares, of which each may be off by
        ``RANK_ERROR`` in rank; null where there are no numbers. ``top`` holds the most frequent
        values (item, count), ties by value. Columns are matched by name, so ``n_rows`` counts
        the rows of epochs that have it; type and position are the newest.
        """
        stored = read_epochs(self.spark, self.path, SCHEMA)
        if epochs is not None:
            stored = stored.where(F.col("epoch").isin(sorted(epochs)))
        merged = stored.groupBy("column").agg(
            F.max_by("position", "epoch").alias("position"), F.max_by("type", "epoch").alias("type"),
            F.sum("n_rows").alias("n_rows"), F.sum("n_nulls").alias("n_nulls"),
            F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("approx_distinct"),
            F.kll_merge_agg_double("quantiles", F.lit(QUANTILE_K)).alias("quantiles"),
            F.expr(f"approx_top_k_combine(top, {TRACKED})").alias("top"),
        )
        shares = F.array(*(F.lit(float(p)) for p in at))
        numbers = F.when(F.kll_sketch_get_n_double("quantiles") > 0, F.kll_sketch_get_quantile_double("quantiles", shares))
        # Ties at the cut are settled among the tracked values, not by the sketch.
        counted = F.transform(F.expr(f"approx_top_k_estimate(top, {TRACKED})"), lambda v: F.struct((-v["count"]).alias("less"), v["item"].alias("item")))
        best = F.transform(F.slice(F.array_sort(counted), 1, top), lambda v: F.struct(v["item"].alias("item"), (-v["less"]).alias("count")))
        return merged.select("position", "column", "type", "n_rows", "n_nulls", "approx_distinct", numbers.alias("quantiles"), best.alias("top"))
