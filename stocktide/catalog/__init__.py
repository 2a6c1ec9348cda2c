"""Named queries over the star-schema tables, with their oracle statements."""

from __future__ import annotations

from importlib import import_module

PARTS = ("panel_queries", "feature_queries", "forecast_queries", "model_queries")


def _merge(attribute: str) -> dict:
    merged: dict = {}
    for part in PARTS:
        entries = getattr(import_module(f"stocktide.catalog.{part}"), attribute)()
        repeated = merged.keys() & entries.keys()
        if repeated:
            raise ValueError(f"{attribute} names repeat: {sorted(repeated)}")
        merged.update(entries)
    return merged


def queries() -> dict:
    return _merge("queries")


def oracle_sql() -> dict:
    return _merge("oracle_sql")
