"""All registered queries and oracles."""

from __future__ import annotations

from importlib import import_module

FAMILIES = [
    "summary_queries",
    "profile_queries",
    "cleaning_queries",
    "feature_queries",
    "model_queries",
    "insight_queries",
]


def _collect(kind: str) -> dict:
    out: dict = {}
    for family in FAMILIES:
        entries = getattr(import_module(f"tabforge.plans.{family}"), kind)()
        clash = out.keys() & entries.keys()
        if clash:
            raise ValueError(f"registered twice: {sorted(clash)}")
        out.update(entries)
    return out


def queries() -> dict:
    return _collect("queries")


def oracles() -> dict:
    return _collect("oracles")
