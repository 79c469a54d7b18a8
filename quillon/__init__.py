"""Embedding pipelines as Spark DataFrame operators."""

from quillon.config import DatasetSpec, Limits, PayloadSpec

__all__ = ["DatasetSpec", "Limits", "PayloadSpec"]
