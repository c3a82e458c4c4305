"""Release-date forecasts: profiles, fallback, blending and the schedule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.months import (
    add_month,
    days_after_month_end,
    local_date,
    local_time,
    local_to_utc,
    minute_to_time,
    month_end,
    release_deadlines,
    time_to_minute,
)
from ..functions.labels import history_kind
from .pick import rank_history, retain_latest, stored

HISTORY_MONTHS = 12
FULL_HISTORY = 3
HIGH_CONFIDENCE_HISTORY = 6
HORIZON_MONTHS = 13


def release_history(report_dates: DataFrame) -> DataFrame:
    """Report dates as history items: entity, month, kind, date, minute."""
    return report_dates.select(
        "entity",
        "month",
        history_kind("basis").alias("kind"),
        F.col("reported_date").alias("release_date"),
        time_to_minute("reported_time").alias("release_minute"),
    )


def release_profile(history: DataFrame, before=None, seq: str | None = None, unique: bool = False) -> DataFrame:
    """Release profile of each entity over its latest twelve months.

    ``before`` keeps a profile free of the month it is to predict. One item
    per month survives, so an entity holds at most twelve rows when the medians
    are taken. ``unique`` says that the history already has one row per month.
    """
    if before is not None:
        history = history.where(F.col("month") < before)
    ranked = history if unique else rank_history(history, seq)
    recent = retain_latest(ranked, HISTORY_MONTHS).withColumn(
        "offset_days", days_after_month_end("release_date", "month").cast("double")
    )
    first = recent.groupBy("entity").agg(
        F.count("*").cast("int").alias("samples"),
        F.count_if(F.col("kind") == "actual").cast("int").alias("actual_samples"),
        F.count_if(F.col("kind") == "ir").cast("int").alias("ir_samples"),
        F.count_if(F.col("kind") == "proxy").cast("int").alias("_proxies"),
        F.median("offset_days").alias("median_offset"),
        F.median("release_minute").alias("median_minute"),
        F.max("month").alias("as_of_month"),
        F.collect_list("offset_days").alias("_offsets"),  # at most twelve values
    )
    gaps = F.sort_array(F.transform("_offsets", lambda x: F.abs(x - F.col("median_offset"))))
    half = F.size(gaps)
    low = F.element_at(gaps, F.floor((half + 1) / 2).cast("int"))
    high = F.element_at(gaps, F.floor((half + 2) / 2).cast("int"))
    confidence = (
        F.when(
            (F.col("samples") >= HIGH_CONFIDENCE_HISTORY) & (F.col("_proxies") < F.col("samples")),
            "high",
        )
        .when(F.col("samples") >= FULL_HISTORY, "medium")
        .otherwise("low")
    )
    return first.select(
        "entity",
        "samples",
        "actual_samples",
        "ir_samples",
        "median_offset",
        "median_minute",
        ((low + high) / 2).alias("mad_days"),
        F.lit("company_history").alias("method"),
        confidence.alias("confidence"),
        "as_of_month",
    )


def complete_profiles(dim: DataFrame, profiles: DataFrame) -> DataFrame:
    """A profile for every entity; those without history get the prior."""
    return dim.select("entity").join(profiles, "entity", "left").fillna(
        {
            "samples": 0,
            "actual_samples": 0,
            "ir_samples": 0,
            "method": "regulatory_prior",
            "confidence": "low",
        }
    )


def fallback_profile(profiles: DataFrame) -> DataFrame:
    """One row: median and MAD of the entities' median offsets.

    No row when no entity has history. Offsets are half days within a bounded
    range, so the median's value counts stay small however many entities.
    """
    known = profiles.where((F.col("samples") > 0) & F.col("median_offset").isNotNull())
    counts = known.groupBy("median_offset").agg(F.count("*").alias("n"), F.max("as_of_month").alias("m"))
    middle = counts.agg(F.percentile("median_offset", 0.5, F.col("n")).alias("v")).scalar()
    return (
        counts.select("*", F.abs(F.col("median_offset") - middle).alias("_gap"), middle.alias("_mid"))
        .groupBy("_mid")
        .agg(
            F.percentile("_gap", 0.5, F.col("n")).alias("mad_days"),
            F.max("m").alias("as_of_month"),
            F.sum("n").alias("entities"),
        )
        .select(F.col("_mid").alias("median_offset"), "mad_days", "as_of_month", "entities")
    )


def blend(profiles: DataFrame, fallback: DataFrame) -> DataFrame:
    """Blend thin histories with the cross-entity fallback.

    Three or more months stand alone; fewer are weighted n/3 against the
    fallback; none takes the fallback as it is.
    """
    # The fallback has at most one row: read it as one scalar subquery.
    row = fallback.select(F.struct("median_offset", "mad_days", "as_of_month")).scalar()
    p = profiles.withColumns({"_fo": row["median_offset"], "_fm": row["mad_days"], "_fa": row["as_of_month"]})
    have = F.col("_fo").isNotNull()
    replaced = have & F.col("median_offset").isNull()
    mixed = have & F.col("median_offset").isNotNull() & (F.col("samples") < FULL_HISTORY)
    weight = F.col("samples") / FULL_HISTORY
    pick = lambda own, whole, part: F.when(replaced, whole).when(mixed, part).otherwise(own)
    return p.select(
        "entity",
        "samples",
        pick(
            F.col("median_offset"),
            F.col("_fo"),
            F.col("median_offset") * weight + F.col("_fo") * (1 - weight),
        ).alias("median_offset"),
        F.when(~replaced, F.col("median_minute")).alias("median_minute"),
        pick(
            F.col("mad_days"),
            F.col("_fm"),
            F.greatest(F.coalesce("mad_days", F.lit(0.0)), F.coalesce("_fm", F.lit(0.0))),
        ).alias("mad_days"),
        F.when(replaced | mixed, "historical_estimate").otherwise(F.col("method")).alias("method"),
        F.when(replaced | mixed, "low").otherwise(F.col("confidence")).alias("confidence"),
        F.when(replaced, F.col("_fa")).otherwise(F.col("as_of_month")).alias("as_of_month"),
        replaced.alias("is_fallback"),
    )


def schedule_rows(rows: DataFrame, now) -> DataFrame:
    """Schedule of each row: one projection over profile, dates and deadline.

    Rows carry entity, month, deadline, the blended profile columns, the
    announcement (announced_date, announced_time), the actual report
    (actual_date, actual_time, actual_at) and has_revenue.
    """
    now = F.lit(now).cast("timestamp") if not isinstance(now, Column) else now
    today = local_date(now)
    end = month_end("month")
    has = F.col("median_offset").isNotNull()
    d = rows.withColumn(
        "expected_date",
        F.when(has, F.date_add(end, F.floor(F.col("median_offset") + 0.5).cast("int"))).otherwise(
            F.col("deadline")
        ),
    ).withColumn("expected_time", minute_to_time("median_minute"))
    radius = F.greatest(F.lit(1), F.ceil(2 * F.coalesce("mad_days", F.lit(0.0))).cast("int"))
    open_end = F.when(has, F.date_add("expected_date", radius)).otherwise(F.col("deadline"))
    clamp = F.coalesce(F.col("is_fallback"), F.lit(False))
    d = d.withColumn(
        "window_start",
        F.when(has, F.date_sub("expected_date", radius)).otherwise(F.date_add(end, 1)),
    ).withColumn("window_end", F.when(clamp, F.least(open_end, F.col("deadline"))).otherwise(open_end))

    actual, announced = F.col("actual_date"), F.col("announced_date")
    late = F.when(announced.isNotNull(), today > announced).otherwise(today > F.col("window_end"))
    filled = F.col("has_revenue") & (F.col("month") < F.trunc(today, "MM"))
    d = d.withColumn(
        "status",
        F.when(actual.isNotNull(), "reported")
        .when(filled, "historical_backfill")
        # A passed window counts only without an announcement; a passed announcement always.
        .when(late, "overdue")
        .when(announced.isNotNull(), "announced")
        .otherwise("forecast"),
    )
    overdue = F.col("status") == "overdue"
    observed = F.coalesce(actual, announced)
    known = F.col("samples") >= FULL_HISTORY
    reason = (
        F.when(observed > F.col("deadline"), "AFTER_REGULATORY_DEADLINE")
        .when(known & (observed < F.col("window_start")), "EARLY")
        .when(known & (observed > F.col("window_end")), "LATE")
        .when(overdue, "LATE_NOT_YET_REPORTED")
    )
    d = d.withColumns(
        {
            "effective_date": F.coalesce(actual, announced, F.col("expected_date")),
            "effective_time": F.when(actual.isNotNull(), F.col("actual_time"))
            .when(announced.isNotNull(), F.col("announced_time"))
            .otherwise(F.col("expected_time")),
            "schedule_source": F.when(actual.isNotNull(), "actual_first_seen")
            .when(announced.isNotNull(), "ir_calendar")
            .when(has, "company_history")
            .otherwise("regulatory_prior"),
            "deviation_days": F.when(
                observed.isNotNull(), F.datediff(observed, F.col("expected_date"))
            ).when(overdue, F.datediff(today, F.col("expected_date"))),
            "unusual_reason": reason,
            "unusual": F.when(reason.isNotNull(), 1).otherwise(0),
        }
    )
    return d.select(
        "entity",
        "month",
        "expected_date",
        "expected_time",
        "window_start",
        "window_end",
        "effective_date",
        "effective_time",
        local_to_utc("effective_date", "effective_time").alias("effective_at"),
        "deadline",
        "schedule_source",
        "announced_date",
        "announced_time",
        local_to_utc("announced_date", "announced_time").alias("announced_at"),
        "actual_at",
        "actual_date",
        "actual_time",
        "deviation_days",
        "unusual",
        "unusual_reason",
        "status",
        "method",
        "confidence",
        "samples",
    )


def actual_reports(keys: DataFrame, report_dates: DataFrame, first_seen=None, existing=None) -> DataFrame:
    """Actual report per (entity, month) key that has or lacks revenue.

    The stored report date counts only once revenue exists; then a first
    sighting from this run; then what the schedule already held.
    """
    dated = report_dates.select(
        "entity",
        "month",
        F.col("reported_date").alias("_rd"),
        F.col("reported_time").alias("_rt"),
        F.col("reported_at").alias("_ra"),
    )
    k = keys.join(dated, ["entity", "month"], "left")
    for name in ("_rd", "_rt", "_ra"):
        k = k.withColumn(name, F.when(F.col("has_revenue"), F.col(name)))
    if first_seen is not None:
        k = k.join(first_seen.select("entity", "month", F.col("first_seen").alias("_fs")), ["entity", "month"], "left")
    else:
        k = k.withColumn("_fs", F.lit(None).cast("timestamp"))
    if existing is not None:
        old = existing.select(
            "entity",
            "month",
            F.col("actual_at").alias("_ea"),
            F.col("actual_date").alias("_ed"),
            F.col("actual_time").alias("_et"),
        )
        k = k.join(old, ["entity", "month"], "left")
    else:
        k = k.withColumns(
            {
                "_ea": F.lit(None).cast("timestamp"),
                "_ed": F.lit(None).cast("date"),
                "_et": F.lit(None).cast("string"),
            }
        )
    at = F.coalesce("_ra", "_fs", "_ea")
    return (
        k.withColumn("actual_at", at)
        .withColumn("actual_date", F.coalesce("_rd", "_ed", local_date("actual_at")))
        .withColumn("actual_time", F.coalesce("_rt", "_et", local_time("actual_at")))
        .drop("_rd", "_rt", "_ra", "_fs", "_ea", "_ed", "_et")
    )


def release_schedule(
    dim: DataFrame,
    report_dates: DataFrame,
    facts: DataFrame,
    announcements: DataFrame,
    holidays: DataFrame,
    target,
    now,
    months: int = HORIZON_MONTHS,
    first_seen: DataFrame | None = None,
    existing: DataFrame | None = None,
) -> DataFrame:
    """Schedule of every entity over the months from ``target`` on.

    The target month uses a profile of the months before it; later months use
    the full profile. The fallback only sees months before the target.
    """
    target = F.lit(target).cast("date") if not isinstance(target, Column) else target
    history = release_history(report_dates)
    # One row per entity; the blend and the fallback both read it.
    earlier = stored(complete_profiles(dim, release_profile(history, before=target, unique=True)))
    full = complete_profiles(dim, release_profile(history, unique=True))
    fallback = fallback_profile(earlier)
    month_step = F.expr("interval 1 month")
    ahead = F.explode(F.sequence(add_month(target, 1), add_month(target, months - 1), month_step))
    grid = blend(earlier, fallback).withColumn("month", target)
    if months > 1:
        grid = grid.unionByName(blend(full, fallback).withColumn("month", ahead))
    horizon = F.explode(F.sequence(target, add_month(target, months - 1), month_step))
    deadlines = release_deadlines(dim.sparkSession.range(1).select(horizon.alias("month")), holidays)
    revenue = facts.select("entity", "month", F.lit(True).alias("has_revenue"))
    rows = (
        grid.join(revenue, ["entity", "month"], "left")
        .fillna({"has_revenue": False})
        .join(
            announcements.select("entity", "month", "announced_date", "announced_time"),
            ["entity", "month"],
            "left",
        )
    )
    # At most one deadline per scheduled month, which bounds the broadcast.
    rows = actual_reports(rows, report_dates, first_seen, existing).join(F.broadcast(deadlines), "month")
    return schedule_rows(rows, now)
