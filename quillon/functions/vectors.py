"""Vector expressions on array columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def l2_norm(vector: Column) -> Column:
    """Euclidean length, summed in double in one pass; null if any component is."""
    return F.sqrt(F.aggregate(
        vector, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")
    ))


def truncated(vector: Column, dim: int) -> Column:
    """First ``dim`` components, scaled back to unit length; zero vectors stay zero."""
    head = F.transform(F.slice(vector, 1, dim), lambda x: x.cast("double"))
    norm = l2_norm(head)
    return F.transform(head, lambda x: F.when(norm > 0, x / norm).otherwise(x).cast("float"))


def norm_is_off(vector: Column, low: float = 0.95, high: float = 1.05) -> Column:
    """True where a vector is not near unit length."""
    return ~l2_norm(vector).between(low, high)


def sign_sketch(vector: Column, dim: int) -> Column:
    """Sign bits of a vector packed into 64-bit words, lowest component in the lowest bit."""
    words = []
    for start in range(0, dim, 64):
        width = min(64, dim - start)
        bits = F.transform(
            F.slice(vector, start + 1, width),
            lambda x, i: F.when(x > 0, _one_shifted(i)).otherwise(F.lit(0).cast("long")),
        )
        words.append(F.aggregate(bits, F.lit(0).cast("long"), lambda acc, b: acc.bitwiseOR(b)))
    return F.array(*words)


def _one_shifted(i: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), i)
