"""Which entities have reported the target month, and when the rest should."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.months import add_month
from .panel import latest_month


def target_period(schedule: DataFrame, facts: DataFrame, dim: DataFrame) -> DataFrame:
    """One row: first scheduled month, from the latest fact month on, that not
    every entity has reported; else the month after the latest."""
    last = latest_month(facts)
    everyone = dim.agg(F.count("*")).scalar()
    reported = (
        schedule.where(F.col("month") >= last)
        .select("entity", "month")
        .join(facts.select("entity", "month", F.lit(1).alias("_hit")), ["entity", "month"], "left")
        .groupBy("month")
        .agg(F.count("_hit").alias("reported"))
    )
    missing = reported.where(F.col("reported") < everyone)
    return missing.agg(F.coalesce(F.min("month"), add_month(last, 1)).alias("target_month"))


def freshness(dim: DataFrame, schedule: DataFrame, facts: DataFrame, target) -> DataFrame:
    """One row per entity for the target month."""
    due = schedule.where(F.col("month") == target).select(
        "entity",
        F.coalesce("announced_date", "effective_date", "expected_date").alias("expected_date"),
        F.coalesce("announced_time", "effective_time").alias("expected_time"),
        F.col("deadline"),
        "schedule_source",
        "confidence",
        "samples",
        "status",
        "unusual",
        "unusual_reason",
        "deviation_days",
    )
    latest = facts.groupBy("entity").agg(F.max("month").alias("latest_month"))
    here = facts.where(F.col("month") == target).select("entity", F.lit(True).alias("reported"))
    rows = (
        dim.join(due, "entity", "left")
        .join(here, "entity", "left")
        .join(latest, "entity", "left")
        .fillna({"reported": False, "samples": 0})
    )
    return rows.withColumns(
        {
            "overdue": F.coalesce(~F.col("reported") & (F.col("status") == "overdue"), F.lit(False)),
            "release_status": F.when(F.col("reported"), "reported").otherwise(
                F.coalesce("status", F.lit("pending"))
            ),
            "unusual": F.coalesce(F.col("unusual") == 1, F.lit(False)),
        }
    ).drop("status")


def freshness_order():
    """Reported first, then by expected date with unscheduled ones last."""
    return [F.desc("reported"), F.asc_nulls_last("expected_date")]


def freshness_summary(rows: DataFrame) -> DataFrame:
    return rows.agg(
        F.count_if("reported").alias("reported"),
        F.count_if(~F.col("reported")).alias("pending"),
        F.count_if("overdue").alias("overdue"),
        F.count_if("unusual").alias("unusual"),
    )


def progress(summary: DataFrame) -> DataFrame:
    """Share of entities that have reported, in percent."""
    total = F.greatest(F.lit(1), F.col("reported") + F.col("pending"))
    return summary.withColumn("progress_percent", F.col("reported") / total * 100)


def schedule_histogram(rows: DataFrame, dates: int = 14) -> DataFrame:
    """Reported and pending per expected date, first dates only."""
    day = F.coalesce(F.date_format("expected_date", "yyyy-MM-dd"), F.lit("Unscheduled"))
    return (
        rows.groupBy(day.alias("expected_date"))
        .agg(
            F.count_if("reported").alias("reported"),
            F.count_if(~F.col("reported")).alias("pending"),
        )
        .orderBy("expected_date")
        .limit(dates)
    )
