"""Dataset profile and column roles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F, types as T

from quillon.operators.contract import is_image_struct

# Column names taken as ids.
ID_NAMES = ("id", "_id", "uuid", "key")

# Distinct counts: sketch size (2^14 registers, under one per cent error) and native types.
SKETCH_LG_K = 14
SKETCHED_TYPES = (T.IntegerType, T.LongType, T.StringType, T.BinaryType)

VALUE_NAMES = {
    "tinyint": "int8",
    "smallint": "int16",
    "int": "int32",
    "bigint": "int64",
    "float": "float32",
    "double": "float64",
    "boolean": "bool",
    "string": "string",
    "binary": "binary",
    "date": "date32",
    "timestamp": "timestamp[us]",
    "timestamp_ntz": "timestamp[us]",
}


def type_name(dtype: T.DataType) -> str:
    """Readable type of a column."""
    if is_image_struct(dtype):
        return "Image"
    if isinstance(dtype, T.ArrayType):
        return f"sequence<{type_name(dtype.elementType)}>"
    if isinstance(dtype, T.StructType):
        return "struct"
    return VALUE_NAMES.get(dtype.simpleString(), dtype.simpleString())


def _is_nested(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.ArrayType, T.MapType, T.StructType))


def id_candidates(df: DataFrame) -> list[str]:
    """String columns whose name suggests an id."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and f.name.lower() in ID_NAMES
    ]


def ids_are_unique(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row saying, per column, whether no value and no null repeats in the whole table."""
    text = [F.coalesce(F.col(c), F.lit("None")) for c in columns]
    return df.agg(
        *[(F.count_distinct(t) == F.count(F.lit(1))).alias(c) for t, c in zip(text, columns)]
    )


def profile(df: DataFrame, distinct: bool = True) -> DataFrame:
    """One row per column: position, name, type, note, rows, nulls and distinct estimate.

    The whole table is read once; every count is combined map-side and distinct counts are
    HyperLogLog sketches, so nothing is shuffled but one row per task. Only columns named
    like an id are counted exactly, by a shuffle of their values.
    """
    fields = df.schema.fields
    aggregates = [F.count(F.lit(1)).alias("n_rows")]
    for i, f in enumerate(fields):
        value = F.col(f"`{f.name}`")
        aggregates.append(F.count_if(value.isNull()).alias(f"nulls_{i}"))
        if distinct:
            # One binary sketch per column; types it does not take are counted by text.
            seen = value if isinstance(f.dataType, SKETCHED_TYPES) else value.cast("string")
            sketch = F.hll_sketch_agg(seen, F.lit(SKETCH_LG_K))
            aggregates.append(F.hll_sketch_estimate(sketch).alias(f"distinct_{i}"))
    totals = df.agg(*aggregates)

    candidates = id_candidates(df)
    if candidates:
        flags = ids_are_unique(df, candidates).select(
            *[F.col(c).alias(f"unique_{c}") for c in candidates]
        )
        # Two single-row results side by side.
        for c in candidates:
            totals = totals.withColumn(f"unique_{c}", flags.select(f"unique_{c}").scalar())

    def note(f: T.StructField):
        if is_image_struct(f.dataType):
            return F.lit("image column")
        if f.name in candidates:
            return F.when(F.col(f"unique_{f.name}"), "good ID candidate").otherwise("")
        return F.lit("not embeddable directly" if _is_nested(f.dataType) else "")

    rows = []
    for i, f in enumerate(fields):
        cells = [
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column"),
            F.lit(type_name(f.dataType)).alias("type"),
            note(f).alias("note"),
            F.col("n_rows"),
            F.col(f"nulls_{i}").alias("n_nulls"),
        ]
        if distinct:
            cells.append(F.col(f"distinct_{i}").alias("approx_distinct"))
        rows.append(F.struct(*cells))
    return totals.select(F.inline(F.array(*rows)))


def column_roles(profiled: DataFrame) -> DataFrame:
    """(column, role) suggestions from a profile, plus the modality they imply.

    Works on the profile table: one row per column of the dataset.
    """
    is_text = F.col("type") == "string"
    is_id = F.col("note") == "good ID candidate"
    kind = F.when(is_id, "id").when(F.col("type") == "Image", "image").when(is_text, "text")
    nth = F.row_number().over(Window.partitionBy("kind").orderBy("position"))
    ranked = profiled.withColumn("kind", kind).where("kind IS NOT NULL").withColumn("nth", nth)
    # Later id candidates are ordinary strings again, so they compete for the template.
    later = ranked.withColumn(
        "kind", F.when((F.col("kind") == "id") & (F.col("nth") > 1), "text").otherwise(F.col("kind"))
    ).withColumn("nth", nth)
    limits = F.when(F.col("kind") == "text", 2).otherwise(1)
    chosen = later.where(F.col("nth") <= limits).select(
        "column",
        F.when(F.col("kind") == "text", "template").otherwise(F.col("kind")).alias("role"),
    )
    modality = later.agg(
        F.coalesce(F.bool_or(F.col("kind") == "image"), F.lit(False)).alias("image"),
        F.coalesce(F.bool_or(F.col("kind") == "text"), F.lit(False)).alias("text"),
    ).select(
        F.when(F.col("image") & F.col("text"), "multimodal")
        .when(F.col("image"), "image")
        .otherwise("text")
        .alias("column"),
        F.lit("modality").alias("role"),
    )
    return chosen.unionByName(modality)
