"""Registered queries over the star-schema tables, with their SQL checks."""

from __future__ import annotations

from collections.abc import Callable

from .registry import REGISTRY, oracle_text

from . import analytics, columns, files, forecasts, maintenance, matching, raw, screening, streams, trends  # noqa: E402,F401  isort:skip


def queries() -> dict[str, Callable]:
    return {name: q.run for name, q in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {name: oracle_text(q.sql) for name, q in REGISTRY.items() if q.sql}
