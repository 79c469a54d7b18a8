"""Rows of any table to records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from quillon.config import DatasetSpec
from quillon.functions.keys import point_id
from quillon.functions.pytext import payload_json, plain_text, render_template
from quillon.operators.contract import require_valid


def record_id(spec: DatasetSpec, schema: T.StructType, row_index: str | None) -> Column:
    """Id of a row: its id column as text, else its position in the dataset."""
    if spec.id_column:
        dtype = schema[spec.id_column].dataType
        value = F.col(f"`{spec.id_column}`")
        return F.when(value.isNotNull(), plain_text(value, dtype))
    if row_index is None:
        raise ValueError("no id_column: pass the column that holds the row index")
    return F.col(row_index).cast("string")


def image_reference(spec: DatasetSpec, schema: T.StructType) -> list[Column]:
    """``image_url`` (empty when absent) and ``image`` bytes (null for URL columns)."""
    url, content = F.lit(""), F.lit(None).cast("binary")
    if spec.image_column:
        value = F.col(f"`{spec.image_column}`")
        dtype = schema[spec.image_column].dataType
        if isinstance(dtype, T.StringType):
            url = F.coalesce(value, F.lit(""))
        elif isinstance(dtype, T.StructType):
            content = value["data"]
        else:
            content = value
    return [url.alias("image_url"), content.alias("image")]


def normalize(
    df: DataFrame, spec: DatasetSpec, row_index: str | None = None, keep: Sequence[str] = ()
) -> DataFrame:
    """Records: id, point key, rendered text, image reference and JSON payload.

    One projection without a shuffle. Rows with a null id keep a null ``record_id``;
    :func:`split_null_ids` separates them. ``row_index`` names a position column that is
    not part of the dataset itself. Columns to ``keep`` follow as ``_order_<name>``.
    """
    require_valid(df, spec)
    data = T.StructType([f for f in df.schema.fields if f.name != row_index])
    key = record_id(spec, df.schema, row_index)
    carried = [row_index] if row_index else []
    return df.select(
        key.alias("record_id"),
        point_id(key).alias("point_id"),
        render_template(spec.text_template, data).alias("text"),
        *image_reference(spec, df.schema),
        payload_json(spec, data).alias("payload"),
        *carried,
        *[F.col(f"`{c}`").alias(f"_order_{c}") for c in keep],
    )


def split_null_ids(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable, quarantined): rows without an id are set aside rather than merged."""
    return records.where("record_id IS NOT NULL"), records.where("record_id IS NULL")
