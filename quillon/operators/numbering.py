"""Consecutive numbers over a whole table without gathering it in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from quillon.session import materialize

# monotonically_increasing_id holds the partition above this many row-number bits.
ROW_BITS = 33


def global_index(
    df: DataFrame, keys: Sequence[str], index: str = "row_index", partitions: int | None = None
) -> DataFrame:
    """Zero-based position of each row in the order of ``keys``, which must be unique.

    Rows are range partitioned and sorted, and written once with their place (range bounds
    are sampled, so a recomputed stage could place rows elsewhere). Per-partition counts
    then give the offsets: one row per partition, whatever the data size.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = (
        df.repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    placed = materialize(placed, "indexed")
    part = F.shiftright("_place", ROW_BITS)
    row = F.col("_place").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    sizes = placed.groupBy(part.alias("_part")).agg((F.max(row) + 1).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")
    )
    # At most ``n`` rows: bounded by the partition count, not by the data.
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select(*df.columns, (F.col("_offset") + row).alias(index))
    )
