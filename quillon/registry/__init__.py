"""Registered queries over the given tables, with the SQL each must agree with."""

from __future__ import annotations

import importlib

MODULES = ("records", "lifecycle", "shards", "results", "search", "audits", "images", "streams")


def _merged(name: str) -> dict:
    merged: dict = {}
    for module in MODULES:
        merged.update(getattr(importlib.import_module(f"{__name__}.{module}"), name))
    return merged


def all_queries() -> dict:
    return _merged("QUERIES")


def all_oracles() -> dict:
    return _merged("ORACLES")
