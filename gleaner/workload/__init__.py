"""Checked queries over the test tables, one module per area."""

from __future__ import annotations

import importlib

AREAS = ("text", "collections", "ranking", "relations", "vectors", "conversations", "analytics", "streams")


def _load() -> None:
    for area in AREAS:
        importlib.import_module(f"gleaner.workload.{area}")


def all_queries() -> dict:
    from gleaner.workload.base import QUERIES

    _load()
    return dict(QUERIES)


def all_oracles() -> dict[str, str]:
    from gleaner.workload.base import ORACLES

    _load()
    return dict(ORACLES)
