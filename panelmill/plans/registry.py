"""Registry of named queries and the shared table expressions of their SQL."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .star import CTES, Star


@dataclass(frozen=True)
class Query:
    build: Callable[[Star], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return self.build(Star(spark, sf_dir))


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a function of the star tables under a name, with its SQL check."""

    def add(build):
        if name in REGISTRY:
            raise KeyError(name)
        REGISTRY[name] = Query(build, sql)
        return build

    return add


def _used(text: str) -> list[str]:
    return [name for name in CTES if re.search(rf"\b{name}\b", text)]


def oracle_text(sql: str) -> str:
    """SQL with the shared table expressions it uses, in dependency order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for other in _used(CTES[name]):
            if other != name:
                visit(other)
        ordered.append(name)

    for name in _used(sql):
        visit(name)
    if not ordered:
        return sql
    shared = ",\n".join(f"{name} AS ({CTES[name]})" for name in ordered)
    text = sql.strip()
    if text.upper().startswith("WITH "):
        return f"WITH {shared},\n{text[5:]}"
    return f"WITH {shared}\n{text}"
