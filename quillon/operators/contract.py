"""Input contract: what a table must offer before it is ingested."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from quillon.config import INDEX_TYPES, DatasetSpec, SpecError
from quillon.functions.pytext import payload_fields

IMAGE_TYPES = (T.StringType, T.BinaryType)


def is_image_struct(dtype: T.DataType) -> bool:
    """Whether a type is the decoded-picture struct of Spark's image source."""
    return isinstance(dtype, T.StructType) and {"height", "width", "data"} <= set(dtype.names)


def schema_violations(schema: T.StructType, spec: DatasetSpec) -> list[tuple[str, str]]:
    """(check, message) for every rule the schema and the dataset description break."""
    names = schema.names
    found: list[tuple[str, str]] = []

    def absent(check: str, column: str, what: str):
        if column not in names:
            found.append((check, f"{what} {column!r} not found. Available columns: {names}"))

    if spec.id_column:
        absent("id_column", spec.id_column, "id_column")
    for column in spec.template_columns:
        absent("text_template", column, "text_template column")
    if spec.needs_image and not spec.image_column:
        found.append(("modality", f"modality {spec.modality!r} requires image_column to be set."))
    if spec.image_column:
        absent("image_column", spec.image_column, "image_column")
        if spec.image_column in names:
            dtype = schema[spec.image_column].dataType
            if not isinstance(dtype, IMAGE_TYPES) and not is_image_struct(dtype):
                found.append((
                    "image_type",
                    f"image_column {spec.image_column!r} has unsupported type "
                    f"{dtype.simpleString()}. Supported: string (URL), binary or image.",
                ))
    included = spec.payload.include
    for column, kind in spec.payload.indexes.items():
        if included is not None and column not in included:
            found.append(("index_column", f"indexes column {column!r} is not in payload.include."))
        if kind not in INDEX_TYPES:
            found.append((
                "index_type",
                f"Unknown index type {kind!r} for field {column!r}. Supported: {list(INDEX_TYPES)}",
            ))
    return found


def require_valid(df: DataFrame, spec: DatasetSpec) -> None:
    """Raise the first schema violation; reads no data."""
    for _, message in schema_violations(df.schema, spec):
        raise SpecError(message)


def unreachable_indexes(df: DataFrame, spec: DatasetSpec) -> list[str]:
    """Indexed columns that never reach the payload (accepted, but useless)."""
    stored = payload_fields(spec, df.schema)
    return [c for c in spec.payload.indexes if c not in stored]


def input_contract(df: DataFrame, records: DataFrame, spec: DatasetSpec) -> DataFrame:
    """(check, severity, count) over normalised ``records`` of ``df``.

    All data checks share one aggregation, whose distinct count is combined map-side; a
    hot id costs one row per task.
    """
    url_missing = F.count_if(F.col("image_url") == "") if spec.image_column else F.lit(0)
    text_missing = F.count_if(F.trim("text") == "") if spec.needs_text else F.lit(0)
    totals = records.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("record_id").isNull()).alias("null_ids"),
        (F.count("record_id") - F.count_distinct("record_id")).alias("duplicate_ids"),
        text_missing.alias("blank_text"),
        url_missing.alias("empty_urls"),
    )
    static = {
        "schema_violations": ("error", len(schema_violations(df.schema, spec))),
        "unreachable_indexes": ("warning", len(unreachable_indexes(df, spec))),
    }
    severities = {
        "rows": "info",
        "null_ids": "error",
        "duplicate_ids": "warning",
        "blank_text": "warning",
        "empty_urls": "warning",
    }
    checks = [
        F.struct(F.lit(c).alias("check"), F.lit(s).alias("severity"), F.col(c).cast("long").alias("count"))
        for c, s in severities.items()
    ] + [
        F.struct(F.lit(c).alias("check"), F.lit(s).alias("severity"), F.lit(n).cast("long").alias("count"))
        for c, (s, n) in static.items()
    ]
    return totals.select(F.inline(F.array(*checks)))
