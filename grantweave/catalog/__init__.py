"""Queries over the driver tables with their SQL twins."""

from __future__ import annotations

import importlib

from grantweave.catalog.base import QUERIES, SQL, Query

_MODULES = ("texts", "tables", "registry", "reports", "changes", "published")


def _load() -> None:
    for name in _MODULES:
        importlib.import_module(f"grantweave.catalog.{name}")


def all_queries() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def all_sql() -> dict[str, str]:
    _load()
    return dict(SQL)
