"""Text rendering with Python's formatting rules.

Strings, integers, booleans and nulls are rendered inside the JVM. Floats, nested values
and fields with a format spec go through one Arrow-batched helper, because Java and Python
disagree on exponents, rounding and nested quoting.
"""

from __future__ import annotations

import string

import pyarrow as pa
from pyspark.sql import Column, functions as F, types as T

from quillon.config import DatasetSpec, SpecError

PLAIN_TYPES = (T.StringType, T.IntegralType, T.BooleanType)
JSON_TYPES = (T.StringType, T.IntegralType, T.BooleanType, T.FloatType, T.DoubleType)


def _python_format(pattern: str):
    @F.arrow_udf(T.StringType())
    def render(values: pa.Array) -> pa.Array:
        return pa.array([pattern.format(_naive(v)) for v in values.to_pylist()], pa.string())

    return render


def _naive(value):
    """Drop the session zone Arrow attaches to timestamps."""
    return value.replace(tzinfo=None) if getattr(value, "tzinfo", None) else value


def plain_text(value: Column, dtype: T.DataType) -> Column:
    """``str(value)`` of a string, integer or boolean, with nulls as ``None``."""
    if isinstance(dtype, T.BooleanType):
        text = F.when(value, "True").otherwise("False")
        return F.when(value.isNull(), "None").otherwise(text)
    return F.coalesce(value.cast("string"), F.lit("None"))


def field_text(value: Column, dtype: T.DataType, conversion: str | None, spec: str) -> Column:
    """One replacement field of a template."""
    if isinstance(dtype, PLAIN_TYPES) and not conversion and not spec:
        return plain_text(value, dtype)
    pattern = "{0" + (f"!{conversion}" if conversion else "") + (f":{spec}" if spec else "") + "}"
    return _python_format(pattern)(value)


def render_template(template: str, schema: T.StructType) -> Column:
    """Render ``template`` over a table's columns; an empty template gives empty text."""
    types = {f.name: f.dataType for f in schema.fields}
    pieces: list[Column] = []
    for literal, name, spec, conversion in string.Formatter().parse(template):
        if literal:
            pieces.append(F.lit(literal))
        if name is None:
            continue
        if name not in types:
            raise SpecError(f"text_template references column {name!r} which doesn't exist")
        pieces.append(field_text(F.col(f"`{name}`"), types[name], conversion, spec))
    return F.concat(*pieces) if pieces else F.lit("")


def json_scalar(value: Column, dtype: T.DataType) -> Column:
    """Payload value: JSON scalars stay as they are, everything else becomes text."""
    if isinstance(dtype, JSON_TYPES):
        return value
    if isinstance(dtype, (T.DateType, T.DecimalType)):
        return value.cast("string")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return _timestamp_text(value)
    return F.when(value.isNotNull(), _python_format("{0}")(value))


def _timestamp_text(value: Column) -> Column:
    """ISO text with a blank; six fraction digits, or none for whole seconds."""
    whole = F.date_format(value, "yyyy-MM-dd HH:mm:ss")
    micros = F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.when(value == F.date_trunc("second", value), whole).otherwise(micros)


def payload_fields(spec: DatasetSpec, schema: T.StructType) -> dict[str, T.DataType | None]:
    """Name and type of each payload column in order, no type for requested ones a table lacks.

    The id stays out, and so does a picture that is stored as bytes: it travels as its URL
    or not at all.
    """
    types = {f.name: f.dataType for f in schema.fields}
    left_out = set(spec.payload.exclude) | {spec.id_column}
    if not isinstance(types.get(spec.image_column, T.StringType()), T.StringType):
        left_out.add(spec.image_column)
    requested = types if spec.payload.include is None else dict.fromkeys(spec.payload.include)
    return {name: types.get(name) for name in requested if name not in left_out}


def payload_json(spec: DatasetSpec, schema: T.StructType) -> Column:
    """Payload object of a row; requested columns the table lacks are null."""
    fields = payload_fields(spec, schema)
    if not fields:
        return F.lit("{}")
    values = [
        (F.lit(None).cast("string") if kind is None else json_scalar(F.col(f"`{name}`"), kind)).alias(name)
        for name, kind in fields.items()
    ]
    return F.to_json(F.struct(*values), {"ignoreNullFields": "false"})
