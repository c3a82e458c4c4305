"""Data-quality gates; each returns the violating rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .views import missing_rates  # noqa: F401  (re-exported gate)


class GateError(ValueError):
    """A gate found violations."""


def require_empty(violations: DataFrame, message: str) -> None:
    """Fail with the first few violations; reads five rows at most."""
    rows = violations.take(5)
    if rows:
        raise GateError(f"{message}: {[r.asDict() for r in rows]}")


def foreign_key(child: DataFrame, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows with a key the parent lacks; null keys pass."""
    known = parent.select(F.col(parent_key).alias(key))
    return child.where(F.col(key).isNotNull()).join(known, key, "left_anti")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where(F.col("rows") > 1)


def domain(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Rows that break a rule, with the names of the broken rules.

    A rule that is unknown (null) does not count as broken, as in SQL checks.
    """
    broken = F.filter(
        F.array(*[F.when(~F.coalesce(rule, F.lit(True)), F.lit(name)) for name, rule in rules.items()]),
        lambda x: x.isNotNull(),
    )
    return df.withColumn("broken", broken).where(F.size("broken") > 0)


def split_rejects(df: DataFrame, bad: Column) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows)."""
    bad = F.coalesce(bad, F.lit(False))
    return df.where(~bad), df.where(bad)


def archive_detail_mismatch(archive: DataFrame, detail: DataFrame, keys=("record_id",), compare=("month", "published_at")) -> DataFrame:
    """Archive rows whose detail is missing or differs."""
    d = detail.select(*keys, *[F.col(c).alias(f"d_{c}") for c in compare], F.lit(True).alias("_d"))
    same = F.col("_d").isNotNull()
    for c in compare:
        same = same & F.col(c).eqNullSafe(F.col(f"d_{c}"))
    return archive.join(d, list(keys), "left").where(~same).drop("_d")


def reconcile_groups(snapshot: DataFrame, members: DataFrame, tolerance: float = 0.01) -> DataFrame:
    """Group rows that do not equal their constituents' totals.

    Sums and counts must be equal; simple and weighted growth may differ by
    ``tolerance``.
    """
    positive = F.col("yoy").isNotNull() & (F.col("revenue") > 0)
    totals = members.groupBy("classification", "key").agg(
        F.coalesce(F.sum("revenue"), F.lit(0)).alias("m_revenue"),
        F.count("revenue").alias("m_reporting"),
        F.avg("yoy").alias("m_simple"),
        (
            F.sum(F.when(positive, F.col("yoy") * F.col("revenue")))
            / F.sum(F.when(positive, F.col("revenue")))
        ).alias("m_weighted"),
    )
    apart = lambda a, b: F.abs(F.col(a) - F.col(b)) > tolerance
    lone = lambda a, b: F.col(a).isNull() != F.col(b).isNull()
    bad = (
        ~F.col("aggregate_revenue").eqNullSafe(F.col("m_revenue"))
        | ~F.col("reporting").eqNullSafe(F.col("m_reporting"))
        | apart("simple_yoy", "m_simple")
        | lone("simple_yoy", "m_simple")
        | apart("weighted_yoy", "m_weighted")
        | lone("weighted_yoy", "m_weighted")
    )
    return snapshot.join(totals, ["classification", "key"], "left").where(F.coalesce(bad, F.lit(False)))


def snapshot_series_mismatch(snapshot: DataFrame, series: DataFrame) -> DataFrame:
    """Fixed-month snapshot rows that differ from the monthly series."""
    figures = ["aggregate_revenue", "reporting", "simple_yoy", "weighted_yoy"]
    s = series.select(
        "classification",
        F.date_format("month", "yyyy-MM").alias("key"),
        *[F.col(c).alias(f"s_{c}") for c in figures],
    )
    joined = snapshot.join(s, ["classification", "key"])
    same = F.lit(True)
    for c in figures:
        same = same & F.col(c).eqNullSafe(F.col(f"s_{c}"))
    return joined.where(~same)


def momentum_mismatch(rows: DataFrame, tolerance: float = 0.02) -> DataFrame:
    """Momentum rows whose acceleration or direction contradicts the growths."""
    gap = F.abs(F.col("acceleration") - (F.col("current_growth") - F.col("previous_growth")))
    sign = (
        F.when(F.col("acceleration").isNull(), F.col("direction") == "unavailable")
        .when(F.col("acceleration") > 0, F.col("direction") == "accelerating")
        .when(F.col("acceleration") < 0, F.col("direction") == "decelerating")
        .otherwise(F.col("direction") == "unchanged")
    )
    return rows.where(F.coalesce(gap > tolerance, F.lit(False)) | ~sign)


def growth_mismatch(facts: DataFrame, momentum_rows: DataFrame, tolerance: float = 0.02) -> DataFrame:
    """Panel year-over-year growth that strays from the reported percent."""
    yoy = momentum_rows.where(F.col("period") == "yoy").select("entity", "month", "current_growth")
    return (
        facts.select("entity", "month", "yoy")
        .join(yoy, ["entity", "month"])
        .where(F.abs(F.col("yoy") - F.col("current_growth")) > tolerance)
    )


def over_retention(df: DataFrame, n: int = 12, entity="entity", month="month") -> DataFrame:
    """Entities that hold more than ``n`` distinct months."""
    months = df.select(entity, month).distinct()
    return months.groupBy(entity).agg(F.count("*").alias("months")).where(F.col("months") > n)
