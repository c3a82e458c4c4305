"""Search, filter, order and export projections of the report screens."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import export_timestamp, label_publication, label_schedule
from ..functions.months import month_label, period_bounds
from ..functions.text import trim_all
from .panel import PERIODS

SEARCH_BLANK = 12
SEARCH_MATCHES = 30
CHART_ROWS = 18


def matches(query: str, ticker: str, texts: Sequence[str] = (), lists: Sequence[str] = ()) -> Column:
    """True when the query is blank or found in the ticker, a text or a list."""
    needle = F.lower(trim_all(F.lit(query)))
    hit = F.contains(F.col(ticker), needle)
    for c in texts:
        hit = hit | F.contains(F.lower(F.col(c)), needle)
    for c in lists:
        hit = hit | F.exists(F.col(c), lambda x: F.contains(F.lower(x), needle))
    return (needle == "") | hit


def search(df: DataFrame, query: str, ticker="ticker", texts=("name",), lists=(), order=("ticker",)) -> DataFrame:
    """Selector list: the first 12 rows without a query, up to 30 hits with one."""
    n = SEARCH_MATCHES if query.strip() else SEARCH_BLANK
    return df.where(matches(query, ticker, texts, lists)).orderBy(*order).limit(n)


def ticker_order(ticker: str = "ticker") -> list[Column]:
    """Numeric order first, then text."""
    number = F.regexp_extract(ticker, r"^\s*(\d+)", 1).try_cast("bigint")
    return [F.coalesce(number, F.lit(0)).asc(), F.col(ticker).asc()]


def screen_status(rows: DataFrame, status: str) -> DataFrame:
    """Freshness rows that are reported, pending, overdue, unusual, or all."""
    keep = {
        "reported": F.col("reported"),
        "pending": ~F.col("reported"),
        "overdue": F.col("overdue"),
        "unusual": F.col("unusual"),
    }
    return rows.where(keep[status]) if status in keep else rows


def screen_direction(rows: DataFrame, direction: str) -> DataFrame:
    """Momentum rows with one direction, or all."""
    return rows if direction == "all" else rows.where(F.col("direction") == direction)


def momentum_order(direction: str = "all") -> list[Column]:
    """Fastest first; slowest first on the decelerating screen; nulls last."""
    first = F.asc_nulls_last if direction == "decelerating" else F.desc_nulls_last
    return [first("acceleration"), F.asc("ticker")]


def momentum_chart(rows: DataFrame, direction: str = "all", n: int = CHART_ROWS) -> DataFrame:
    """The chart's rows: largest moves, shown from low to high."""
    if direction == "all":
        size = F.abs(F.coalesce("acceleration", F.lit(0.0)))
        top = rows.orderBy(size.desc(), F.asc("ticker")).limit(n)
        return top.orderBy(F.coalesce("acceleration", F.lit(0.0)).asc(), F.asc("ticker"))
    kept = screen_direction(rows, direction).orderBy(*momentum_order(direction)).limit(n)
    if direction == "decelerating":
        return kept.orderBy(F.desc_nulls_first("acceleration"), F.desc("ticker"))
    return kept.orderBy(F.asc_nulls_first("acceleration"), F.desc("ticker"))


def breadth(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Direction counts, and the share of directional rows that accelerate."""
    out = rows.groupBy(*by).agg(
        *[
            F.count_if(F.col("direction") == d).alias(d)
            for d in ("accelerating", "decelerating", "unchanged")
        ]
    )
    total = F.greatest(F.lit(1), F.col("accelerating") + F.col("decelerating"))
    return out.withColumn("breadth_percent", F.col("accelerating") / total * 100)


def company_export(rows: DataFrame, currency: str = "TWD") -> DataFrame:
    """Fourteen export columns of an entity's visible history (after ``in_currency``)."""
    usd = currency.upper() == "USD"
    blank = lambda c, t: F.col(c) if usd else F.lit(None).cast(t)
    return rows.select(
        "entity",
        month_label("month").alias("month"),
        F.col("shown_revenue").alias("revenue"),
        F.col("mom").alias("mom_percent"),
        F.col("yoy").alias("yoy_percent"),
        F.col("shown_ytd").alias("ytd_revenue"),
        F.col("ytd_yoy").alias("ytd_yoy_percent"),
        F.col("shown_rate").alias("average_rate"),
        blank("fx_observations", "bigint").alias("fx_observations"),
        F.date_format(blank("fx_last_date", "date"), "yyyy-MM-dd").alias("fx_last_date"),
        export_timestamp("publication_timestamp", "publication_basis").alias("publication_timestamp"),
        label_publication("publication_basis").alias("publication_basis"),
        F.col("restated"),
        F.col("source_market").alias("market"),
        F.col("source_url"),
    )


def momentum_export(rows: DataFrame, period: str) -> DataFrame:
    """Momentum rows of one period with their window labels."""
    months, label = next((m, control) for p, m, _, control in PERIODS if p == period)
    b = period_bounds("analysis_month", months, period == "yoy")
    return rows.where(F.col("period") == period).select(
        "key",
        "ticker",
        "name",
        "classification",
        F.lit(label).alias("period_label"),
        *[month_label(v).alias(k) for k, v in b.items()],
        "current_revenue",
        "prior_revenue",
        "current_growth",
        "previous_growth",
        "acceleration",
        "direction",
    )


def freshness_export(rows: DataFrame, target) -> DataFrame:
    return rows.select(
        "ticker",
        "name",
        "classification",
        month_label(target).alias("reporting_month"),
        F.when(F.col("reported"), "Reported").otherwise("Pending").alias("status"),
        F.date_format("expected_date", "yyyy-MM-dd").alias("expected_date"),
        "expected_time",
        "overdue",
        "unusual",
        "unusual_reason",
        label_schedule("schedule_source", "samples").alias("schedule_basis"),
        F.date_format("deadline", "yyyy-MM-dd").alias("deadline"),
    )
