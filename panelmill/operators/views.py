"""Derived tables over facts, versions, dates and dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import EXACT_BASES, PUBLICATION_BASIS, choose, exact_flag
from ..functions.numbers import js_round
from .panel import latest_per_entity
from .pick import best_by_priority


def current_rows(observations: DataFrame, keys: Sequence[str] = ("entity", "month")) -> DataFrame:
    """Current version of each key with ``versions`` and ``restated``.

    Versions are counted by a partial aggregation over the keys alone, so a key
    with very many versions is never gathered; only current rows are joined.
    """
    counts = observations.groupBy(*keys).agg(F.count("*").alias("versions"))
    current = observations.where(F.col("is_current")).join(counts, list(keys))
    return current.withColumn("restated", (F.col("versions") > 1) | F.col("corrected"))


def never_restated(observations: DataFrame, keys: Sequence[str] = ("entity", "month")) -> DataFrame:
    """Current, uncorrected rows whose key has a single version."""
    return current_rows(observations, keys).where(~F.col("restated"))


def monthly_revenue(
    observations: DataFrame,
    companies: DataFrame,
    files: DataFrame,
    notes: DataFrame,
    keys: Sequence[str] = ("entity", "month"),
) -> DataFrame:
    """Current facts with company, source file and note translation."""
    return (
        current_rows(observations, keys)
        .join(companies, "entity")
        .join(files, "file_id")
        .join(notes, "note_hash", "left")
    )


def revenue_live(revenue: DataFrame, schedule: DataFrame) -> DataFrame:
    """Facts with their release schedule, where there is one."""
    return revenue.join(schedule, ["entity", "month"], "left")


def release_calendar(schedule: DataFrame, companies: DataFrame) -> DataFrame:
    return schedule.join(companies, "entity")


def report_date_history(report_dates: DataFrame, companies: DataFrame) -> DataFrame:
    """Report dates with company and whether the timestamp is exact."""
    return report_dates.join(companies, "entity").withColumn("exact", exact_flag("basis"))


def restrict_universe(rows: DataFrame, dim: DataFrame, expected_month=None, on: str = "entity") -> DataFrame:
    """Rows of known entities, for one month if given."""
    if expected_month is not None:
        rows = rows.where(F.col("month") == expected_month)
    return rows.join(dim.select(on), on, "left_semi")


def with_facts(rows: DataFrame, facts: DataFrame) -> DataFrame:
    """Rows whose (entity, month) has a fact."""
    return rows.join(facts.select("entity", "month"), ["entity", "month"], "left_semi")


def latest_attribute(dim: DataFrame, facts: DataFrame, attribute: str, default, order=("month", "obs_id")) -> DataFrame:
    """Dim with the latest non-null attribute of each entity, or a default."""
    known = facts.where(F.col(attribute).isNotNull())
    last = known.groupBy("entity").agg(F.max_by(attribute, F.struct(*order)).alias(attribute))
    return dim.join(last, "entity", "left").withColumn(
        attribute, F.coalesce(F.col(attribute), F.lit(default))
    )


def current_announcements(events: DataFrame, sources: DataFrame) -> DataFrame:
    """Announcement per (entity, month) from the best enabled source."""
    live = sources.where(F.col("enabled")).select("source_id", "source_priority")
    current = events.where(F.col("is_current")).join(live, "source_id")
    return best_by_priority(current, ["entity", "month"])


def exact_promotions(observations: DataFrame, report_dates: DataFrame, keys: Sequence[str] = ("entity", "month")) -> DataFrame:
    """Never-restated facts and the exact timestamp they should carry."""
    exact = report_dates.where(
        F.col("basis").isin(*EXACT_BASES) & F.col("reported_at").isNotNull()
    ).select(*keys, F.col("reported_at").alias("new_timestamp"), F.col("basis"))
    codes = {b: PUBLICATION_BASIS[b] for b in EXACT_BASES}
    return (
        never_restated(observations, keys)
        .join(exact, list(keys))
        .withColumn("new_basis", choose("basis", codes))
    )


def manifest(dim: DataFrame, bridge: DataFrame, facts: DataFrame, rates: DataFrame) -> DataFrame:
    """One row of totals: entities, classes, facts, months and FX coverage."""
    span = facts.agg(F.struct(F.min("month").alias("lo"), F.max("month").alias("hi")).alias("s")).scalar()
    seen = bridge.join(facts.select("entity").distinct(), "entity", "left_semi")
    fx = rates.where(F.col("month").between(span["lo"], span["hi"])).agg(
        F.struct(
            F.count("*").alias("rate_count"),
            F.min("month").alias("rate_start"),
            F.max("month").alias("rate_end"),
            F.max_by("average_rate", "month").alias("latest_rate"),
        ).alias("f")
    ).scalar()
    totals = facts.agg(
        F.min("month").alias("first_month"),
        F.max("month").alias("latest_month"),
        F.count("*").alias("observations"),
    )
    return totals.withColumns(
        {
            "entity_count": dim.agg(F.count("*")).scalar(),
            "class_count": seen.agg(F.count_distinct("classification")).scalar(),
            **{c: fx[c] for c in ("rate_count", "rate_start", "rate_end", "latest_rate")},
        }
    )


def latest_summary(dim: DataFrame, facts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Every entity with the figures of its latest month."""
    return dim.join(latest_per_entity(facts, columns), "entity", "left")


def monthly_rates(daily: DataFrame) -> DataFrame:
    """Average, count, first and last date of the daily rates of each month."""
    return daily.groupBy(F.trunc("date", "MM").alias("month")).agg(
        js_round(F.avg("rate"), 6).alias("average_rate"),
        F.count("*").alias("observations"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    )


def universe_difference(universe: DataFrame, dim: DataFrame, on: str = "ticker") -> DataFrame:
    """Keys on one side only, with the side that lacks them."""
    u, d = universe.select(on).distinct(), dim.select(on).distinct()
    return (
        d.join(u, on, "left_anti").withColumn("missing_from", F.lit("universe"))
        .unionByName(u.join(d, on, "left_anti").withColumn("missing_from", F.lit("dimension")))
    )


def universe_gate(universe: DataFrame, dim: DataFrame, expected: DataFrame, on: str = "ticker") -> DataFrame:
    """One row that tells whether a universe file may be loaded.

    Every key of the dimension must be in the file, and of the keys new in the
    file all must be ``expected`` and there may be at most one.
    """
    gap = universe_difference(universe, dim, on)
    known = expected.select(on).distinct().withColumn("_expected", F.lit(True))
    new = F.col("missing_from") == "dimension"
    counts = gap.join(known, on, "left").agg(
        F.count_if(~new).alias("missing"),
        F.count_if(new).alias("added"),
        F.count_if(new & F.col("_expected").isNull()).alias("unexpected"),
    )
    passes = (F.col("missing") == 0) & (F.col("added") <= 1) & (F.col("unexpected") == 0)
    return counts.withColumn("passes", passes)


def check_universe(universe: DataFrame, dim: DataFrame, expected: DataFrame, on: str = "ticker") -> None:
    """Raise unless the gate passes; one row of counts comes to the driver."""
    row = universe_gate(universe, dim, expected, on).first()
    if not row.passes:
        raise ValueError(f"universe file: {row.missing} keys missing, {row.added} added, {row.unexpected} of them not expected")


def missing_rates(facts: DataFrame, rates: DataFrame) -> DataFrame:
    """Fact months without an exchange rate."""
    return facts.select("month").distinct().join(rates.select("month"), "month", "left_anti")


def missing_months(wanted: DataFrame, have: DataFrame) -> DataFrame:
    """Wanted months that are not there."""
    return wanted.select("month").distinct().join(have.select("month"), "month", "left_anti")
