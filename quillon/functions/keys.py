"""Deterministic keys and names."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, functions as F

from quillon.config import POINT_NAMESPACE


def point_id(record_id: Column, namespace: uuid.UUID = POINT_NAMESPACE) -> Column:
    """Name-based UUID (version 5) of a record id, built from SHA-1 without a UDF."""
    name = F.concat(F.unhex(F.lit(namespace.hex)), record_id.cast("binary"))
    digest = F.sha1(name)
    # The variant field keeps the low two bits of its nibble and sets the high bits to 10.
    variant = F.translate(F.substring(digest, 17, 1), "0123456789abcdef", "89ab" * 4)
    return F.concat(
        F.substring(digest, 1, 8), F.lit("-"),
        F.substring(digest, 9, 4), F.lit("-5"),
        F.substring(digest, 14, 3), F.lit("-"),
        variant, F.substring(digest, 18, 3), F.lit("-"),
        F.substring(digest, 21, 12),
    )


def content_hash(content: Column) -> Column:
    """Hex SHA-256 of a blob: the name of its stored copy."""
    return F.sha2(content, 256)


def base64_text(content: Column) -> Column:
    """Base64 on one line (Spark's own output is broken into 76-character lines)."""
    return F.translate(F.base64(content), "\r\n", "")


def result_file_name(batch_id: Column) -> Column:
    """File that holds a batch's results; slashes of the id become underscores."""
    return F.concat(F.translate(batch_id, "/", "_"), F.lit(".jsonl"))


def request_file_name(shard_id: Column) -> Column:
    """File that holds a shard's requests."""
    return F.concat(F.lit("shard_"), zero_padded(shard_id, 5), F.lit(".jsonl"))


def zero_padded(number: Column, width: int) -> Column:
    """Decimal text padded with zeros to ``width``; longer numbers stay whole."""
    digits = number.cast("string")
    return F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits)
