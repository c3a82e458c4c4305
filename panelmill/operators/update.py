"""One poll applied to the stored tables: facts, dates, evidence, forecasts."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import REPORT_DATE_PRIORITY
from . import forecast, maintain, match, pick, views

FACT_SCHEMA = (
    "entity bigint, month date, version int, file_id bigint, revenue bigint, previous_revenue bigint, "
    "prior_year_revenue bigint, mom double, yoy double, ytd bigint, prior_year_ytd bigint, ytd_yoy double, "
    "note_hash string, corrected boolean, row_hash string, is_current boolean, publication_timestamp timestamp, "
    "publication_basis string, first_observed_at timestamp, last_observed_at timestamp"
)
DATE_SCHEMA = (
    "entity bigint, month date, reported_date date, reported_time string, reported_at timestamp, basis string, "
    "source_priority int, source_url string, source_subject string, first_recorded_at timestamp, updated_at timestamp"
)
EVIDENCE_SCHEMA = (
    "basis string, record_id string, entity bigint, month date, published_at timestamp, published_date date, "
    "published_time string, source_url string, source_title string, exact int, matched_revenue bigint, "
    "matched_mom double, matched_yoy double, first_recorded_at timestamp, updated_at timestamp"
)
COMPARED = (
    "revenue",
    "previous_revenue",
    "prior_year_revenue",
    "mom",
    "yoy",
    "ytd",
    "prior_year_ytd",
    "ytd_yoy",
    "note_hash",
    "corrected",
)
KEYS = ("entity", "month")


@dataclass
class Tables:
    """Stored tables; each is one version of a dataset."""

    companies: DataFrame
    facts: DataFrame
    dates: DataFrame
    evidence: DataFrame
    schedule: DataFrame | None = None
    profiles: DataFrame | None = None


@dataclass
class Poll:
    """What one poll brought, already typed."""

    archive: DataFrame | None = None
    feed: DataFrame | None = None
    articles: dict[str, DataFrame] = field(default_factory=dict)
    releases: DataFrame | None = None
    announcements: DataFrame | None = None
    holidays: DataFrame | None = None


def _known(rows: DataFrame, companies: DataFrame) -> DataFrame:
    return rows.join(companies.select("ticker", "entity"), "ticker")


def _observations(facts: DataFrame) -> DataFrame:
    return facts.withColumn("obs_id", F.col("version").cast("bigint"))


def feed_dates(feed: DataFrame, companies: DataFrame, now) -> DataFrame:
    """Exact announcements of known companies as incoming report dates."""
    at = F.lit(now).cast("timestamp")
    basis = "mops_current_feed"
    return _known(feed, companies).select(
        *KEYS,
        "reported_date",
        "reported_time",
        "reported_at",
        F.lit(basis).alias("basis"),
        F.lit(REPORT_DATE_PRIORITY[basis]).alias("source_priority"),
        "source_url",
        "source_subject",
        at.alias("first_recorded_at"),
        at.alias("updated_at"),
    )


def apply_poll(tables: Tables, poll: Poll, target, now, schedule_months: int = 13) -> tuple[Tables, DataFrame]:
    """Next tables and the (table, action, rows) counters of the run.

    Order: facts, first sightings, exact feed dates, corroborated articles,
    company releases, timestamp promotion, forecasts. Facts and dates are
    stored between the steps that read them several times. The same poll again
    changes nothing.
    """
    changes: dict[str, DataFrame] = {}
    at = F.lit(now).cast("timestamp")
    facts, dates, evidence = tables.facts, tables.dates, tables.evidence
    seen = None
    if poll.archive is not None:
        mine = _known(poll.archive.where(F.col("month") == F.lit(target).cast("date")), tables.companies)
        incoming = pick.pick_market(mine, keys=KEYS)
        applied = pick.stored(maintain.apply_facts(facts, incoming, KEYS, COMPARED, now))
        changes["facts"] = applied
        facts = maintain.next_rows(applied).drop("restated")
        seen = maintain.first_seen(applied, now)
        solved = maintain.priority_upsert(
            dates,
            maintain.first_seen_dates(seen, now),
            retain=("first_recorded_at", "source_url", "source_subject"),
        )
        changes["first_observed_dates"] = solved = pick.stored(solved)
        dates = maintain.next_rows(solved)
    if poll.feed is not None:
        solved = pick.stored(maintain.priority_upsert(dates, feed_dates(poll.feed, tables.companies, now)))
        changes["exact_dates"] = solved
        dates = maintain.next_rows(solved)
    for basis, articles in poll.articles.items():
        matched = pick.stored(
            match.corroborate(_known(articles, tables.companies), _observations(facts), percents=["mom", "yoy"])
        )
        rows = match.evidence_rows(matched, basis, False, now)
        evidence, changes[f"evidence_{basis}"] = _with_evidence(evidence, rows)
        incoming = match.evidence_dates(matched, basis, now)
        solved = pick.stored(maintain.priority_upsert(dates, incoming))
        changes[f"dates_{basis}"] = solved
        dates = maintain.next_rows(solved)
        promoted = pick.stored(maintain.promote_proxy(_observations(facts), incoming))
        changes[f"timestamps_{basis}"] = promoted
        facts = maintain.next_rows(promoted).drop("obs_id")
    if poll.releases is not None:
        basis = "company_ir_monthly_revenue"
        claims = _known(poll.releases, tables.companies).withColumn(
            "tolerance", F.lit(match.RELEASE_TOLERANCE).cast("bigint")
        )
        matched = pick.stored(
            match.tolerance_match(
                claims,
                _observations(facts).where("is_current"),
                percents=["mom", "yoy", "ytd_yoy"],
                also=[("ytd", match.RELEASE_TOLERANCE)],
            )
        )
        rows = match.evidence_rows(matched, basis, True, now)
        evidence, changes["evidence_releases"] = _with_evidence(evidence, rows)
        solved = pick.stored(maintain.company_release_upsert(dates, match.evidence_dates(matched, basis, now)))
        changes["dates_releases"] = solved
        dates = maintain.next_rows(solved)
        promoted = pick.stored(maintain.promote_company(_observations(facts), matched))
        changes["timestamps_releases"] = promoted
        facts = maintain.next_rows(promoted).drop("obs_id")
    dates = maintain.trim_dates(dates)
    promoted = pick.stored(maintain.promote_exact(_observations(facts), dates))
    changes["timestamps_exact"] = promoted
    facts = maintain.next_rows(promoted).drop("obs_id")

    profiles = forecast.complete_profiles(
        tables.companies, forecast.release_profile(forecast.release_history(dates), unique=True)
    )
    current = facts.where("is_current")
    holidays = poll.holidays
    if holidays is None:
        holidays = dates.limit(0).select(F.col("month").alias("holiday"))
    announcements = poll.announcements
    if announcements is None:
        announcements = dates.limit(0).select(
            *KEYS, F.col("reported_date").alias("announced_date"), F.col("reported_time").alias("announced_time")
        )
    plan = forecast.release_schedule(
        tables.companies, dates, current, announcements, holidays, target, now, schedule_months, seen, tables.schedule
    )
    stored_plan = plan.limit(0) if tables.schedule is None else tables.schedule
    changes["schedule"] = scheduled = pick.stored(_upsert_schedule(stored_plan, plan))
    stored_profiles = profiles.limit(0) if tables.profiles is None else tables.profiles
    changes["profiles"] = profiled = pick.stored(maintain.apply_profiles(stored_profiles, profiles))
    after = Tables(
        companies=tables.companies,
        facts=facts,
        dates=dates.withColumn("updated_at", F.coalesce("updated_at", at)),
        evidence=evidence,
        schedule=maintain.next_rows(scheduled),
        profiles=maintain.next_rows(profiled),
    )
    return after, maintain.run_counters(changes)


def _with_evidence(evidence: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    columns = [c for c in evidence.columns if not c.startswith("matched_")]
    shaped = rows.select(
        *columns,
        F.col("matched_revenue"),
        *[F.col(f"matched_{c}").alias(f"matched_{c}") for c in ("mom", "yoy")],
    )
    applied = pick.stored(maintain.apply_evidence(evidence, shaped))
    return maintain.trim_evidence(maintain.next_rows(applied)), applied


def _upsert_schedule(stored: DataFrame, plan: DataFrame) -> DataFrame:
    return maintain.apply_schedule(stored.select(*plan.columns), plan)


def empty_tables(spark, companies: DataFrame) -> Tables:
    """Stored tables before the first poll."""
    return Tables(
        companies=companies,
        facts=spark.createDataFrame([], FACT_SCHEMA),
        dates=spark.createDataFrame([], DATE_SCHEMA),
        evidence=spark.createDataFrame([], EVIDENCE_SCHEMA),
    )


def revenue_rows(tables: Tables) -> DataFrame:
    """Current facts with version counts and the restatement flag."""
    return views.current_rows(tables.facts)
