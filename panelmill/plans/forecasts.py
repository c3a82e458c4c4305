"""Queries: release profiles, schedules and freshness."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.months import release_deadlines
from ..operators import forecast, freshness, pick, quality, screens, views
from .columns import DEADLINE_SQL
from .registry import query
from .star import CTES, NOW, TARGET, day, sql_day, sql_stamp, sql_ym, stamp, ym

_KIND = """CASE WHEN basis = 'ir_calendar_matched' THEN 'ir'
      WHEN basis IN ('cnyes_revenue_news', 'moneydj_revenue_news') THEN 'proxy' ELSE 'actual' END"""


def _profiles(where: str) -> str:
    return f"""
    SELECT entity, CAST(count(*) AS INTEGER) AS samples,
      CAST(count(*) FILTER (WHERE kind = 'actual') AS INTEGER) AS actual_samples,
      CAST(count(*) FILTER (WHERE kind = 'ir') AS INTEGER) AS ir_samples,
      any_value(med) AS median_offset, median(CAST(minute_local AS DOUBLE)) AS median_minute, median(abs(off - med)) AS mad_days,
      'company_history' AS method,
      CASE WHEN count(*) >= 6 AND count(*) FILTER (WHERE kind = 'proxy') < count(*) THEN 'high'
        WHEN count(*) >= 3 THEN 'medium' ELSE 'low' END AS confidence, max(month) AS as_of_month
    FROM (SELECT *, median(off) OVER (PARTITION BY entity) AS med
          FROM (SELECT entity, month, {_KIND} AS kind, minute_local,
                  CAST(date_diff('day', CAST(last_day(month) AS DATE), reported_date) AS DOUBLE) AS off,
                  row_number() OVER (PARTITION BY entity ORDER BY month DESC) AS rn
                FROM report_dates {where}) WHERE rn <= 12)
    GROUP BY 1"""


CTES["profiles"] = _profiles("")
CTES["early_profiles"] = _profiles(f"WHERE month < DATE '{TARGET}'")
CTES["fallback"] = """
    SELECT any_value(med) AS median_offset, median(abs(median_offset - med)) AS mad_days,
      max(as_of_month) AS as_of_month, count(*) AS entities
    FROM (SELECT *, median(median_offset) OVER () AS med FROM early_profiles)"""


def _complete(profiles: str) -> str:
    return f"""
    SELECT entity, coalesce(samples, 0) AS samples, median_offset, median_minute, mad_days,
      coalesce(method, 'regulatory_prior') AS method, coalesce(confidence, 'low') AS confidence, as_of_month
    FROM (SELECT entity FROM every_entity) LEFT JOIN {profiles} USING (entity)"""


def _blend(profiles: str) -> str:
    return f"""
    SELECT p.entity, p.samples,
      CASE WHEN p.median_offset IS NULL THEN f.median_offset WHEN f.median_offset IS NULL OR p.samples >= 3 THEN p.median_offset
        ELSE p.median_offset * (CAST(p.samples AS DOUBLE) / 3) + f.median_offset * (1 - CAST(p.samples AS DOUBLE) / 3) END AS median_offset,
      p.median_minute,
      CASE WHEN p.median_offset IS NULL THEN f.mad_days WHEN f.median_offset IS NULL OR p.samples >= 3 THEN p.mad_days
        ELSE greatest(coalesce(p.mad_days, 0), coalesce(f.mad_days, 0)) END AS mad_days,
      CASE WHEN f.median_offset IS NOT NULL AND (p.median_offset IS NULL OR p.samples < 3) THEN 'historical_estimate' ELSE p.method END AS method,
      CASE WHEN f.median_offset IS NOT NULL AND (p.median_offset IS NULL OR p.samples < 3) THEN 'low' ELSE p.confidence END AS confidence,
      CASE WHEN f.median_offset IS NOT NULL AND p.median_offset IS NULL THEN f.as_of_month ELSE p.as_of_month END AS as_of_month,
      f.median_offset IS NOT NULL AND p.median_offset IS NULL AS is_fallback
    FROM ({_complete(profiles)}) p LEFT JOIN fallback f ON TRUE"""


# Entities: every supplier, and every customer as one that never reported.
CTES["every_entity"] = """
    SELECT s_suppkey AS entity FROM supplier UNION ALL SELECT -1 - c_custkey FROM customer"""
CTES["blended"] = _blend("profiles")
CTES["early_blended"] = _blend("early_profiles")
CTES["deadlines"] = f"""
    SELECT month, max(d) AS deadline FROM (
      SELECT month, CAST(unnest(generate_series(CAST(month + INTERVAL 1 MONTH AS DATE) - 356,
               CAST(month + INTERVAL 1 MONTH AS DATE) + 9, INTERVAL 1 DAY)) AS DATE) AS d
      FROM (SELECT CAST(DATE '{TARGET}' + to_months(CAST(k AS INTEGER)) AS DATE) AS month FROM (SELECT unnest(generate_series(0, 12)) AS k)))
    WHERE isodow(d) < 6 AND d NOT IN (SELECT holiday FROM holidays) GROUP BY 1"""
_TODAY = "DATE '2002-01-20'"
CTES["schedule"] = f"""
    SELECT *, CASE WHEN actual_date IS NOT NULL OR announced_date IS NOT NULL THEN
          CAST(date_diff('day', expected_date, coalesce(actual_date, announced_date)) AS INTEGER)
        WHEN status = 'overdue' THEN CAST(date_diff('day', expected_date, {_TODAY}) AS INTEGER) END AS deviation_days,
      coalesce(actual_date, announced_date, expected_date) AS effective_date,
      CASE WHEN actual_date IS NOT NULL THEN actual_time WHEN announced_date IS NOT NULL THEN announced_time
        ELSE expected_time END AS effective_time,
      CASE WHEN actual_date IS NOT NULL THEN 'actual_first_seen' WHEN announced_date IS NOT NULL THEN 'ir_calendar'
        WHEN median_offset IS NOT NULL THEN 'company_history' ELSE 'regulatory_prior' END AS schedule_source,
      CASE WHEN coalesce(actual_date, announced_date) > deadline THEN 'AFTER_REGULATORY_DEADLINE'
        WHEN samples >= 3 AND coalesce(actual_date, announced_date) < window_start THEN 'EARLY'
        WHEN samples >= 3 AND coalesce(actual_date, announced_date) > window_end THEN 'LATE'
        WHEN status = 'overdue' THEN 'LATE_NOT_YET_REPORTED' END AS unusual_reason
    FROM (SELECT *, CASE WHEN actual_date IS NOT NULL THEN 'reported'
            WHEN has_revenue AND month < DATE '2002-01-01' THEN 'historical_backfill'
            WHEN announced_date IS NULL AND {_TODAY} > window_end THEN 'overdue'
            WHEN announced_date IS NOT NULL AND {_TODAY} > announced_date THEN 'overdue'
            WHEN announced_date IS NOT NULL THEN 'announced' ELSE 'forecast' END AS status
      FROM (SELECT *, CASE WHEN median_offset IS NULL THEN CAST(last_day(month) AS DATE) + 1
              ELSE expected_date - radius END AS window_start,
            CASE WHEN is_fallback THEN least(expected_date + radius, deadline)
              WHEN median_offset IS NULL THEN deadline ELSE expected_date + radius END AS window_end
        FROM (SELECT b.*, d.deadline, r.entity IS NOT NULL AS has_revenue, a.announced_date, a.announced_time,
                CASE WHEN r.entity IS NOT NULL THEN rd.reported_date END AS actual_date,
                CASE WHEN r.entity IS NOT NULL THEN coalesce(rd.reported_time,
                  strftime(rd.reported_at + INTERVAL 8 HOUR, '%H:%M:%S')) END AS actual_time,
                CASE WHEN r.entity IS NOT NULL THEN rd.reported_at END AS actual_at,
                CASE WHEN median_offset IS NULL THEN d.deadline
                  ELSE CAST(last_day(b.month) AS DATE) + CAST(floor(median_offset + 0.5) AS INTEGER) END AS expected_date,
                CASE WHEN median_minute IS NOT NULL THEN
                  lpad(CAST(CAST(floor(median_minute + 0.5) AS INTEGER) // 60 AS VARCHAR), 2, '0') || ':' ||
                  lpad(CAST(CAST(floor(median_minute + 0.5) AS INTEGER) % 60 AS VARCHAR), 2, '0') || ':00' END AS expected_time,
                CAST(greatest(1, ceil(2 * coalesce(mad_days, 0))) AS INTEGER) AS radius
              FROM (SELECT *, DATE '{TARGET}' AS month FROM early_blended
                    UNION ALL
                    SELECT blended.*, CAST(DATE '{TARGET}' + to_months(CAST(k AS INTEGER)) AS DATE) FROM blended,
                      (SELECT unnest(generate_series(1, 12)) AS k)) b
              JOIN deadlines d USING (month)
              LEFT JOIN facts r ON r.entity = b.entity AND r.month = b.month
              LEFT JOIN report_dates rd ON rd.entity = b.entity AND rd.month = b.month
              LEFT JOIN announcements a ON a.entity = b.entity AND a.month = b.month)))"""


def everyone(s):
    never = s.table("customer").select((F.lit(-1) - F.col("c_custkey")).alias("entity"))
    return s.table("supplier").select(F.col("s_suppkey").alias("entity")).unionByName(never)


def announcements(s):
    return views.current_announcements(s.events, s.sources)


def schedule(s):
    """The schedule reads the report dates several times, so they are stored first."""
    return forecast.release_schedule(
        everyone(s), pick.stored(s.report_dates), s.kept_months, announcements(s), s.holidays, TARGET, NOW
    )


_PROFILE = [
    "entity", "samples", "actual_samples", "ir_samples", "median_offset", "median_minute", "mad_days",
    "method", "confidence",
]


@query("release_profiles", f"SELECT {', '.join(_PROFILE)}, {sql_ym('as_of_month')} AS as_of_month FROM profiles")
def release_profiles(s):
    return forecast.release_profile(forecast.release_history(s.report_dates)).select(*_PROFILE, ym("as_of_month"))


@query(
    "release_profiles_before_target",
    f"SELECT {', '.join(_PROFILE)}, {sql_ym('as_of_month')} AS as_of_month FROM early_profiles",
)
def release_profiles_before_target(s):
    history = forecast.release_history(s.report_dates)
    target = F.lit(TARGET).cast("date")
    return forecast.release_profile(history, before=target).select(*_PROFILE, ym("as_of_month"))


@query(
    "history_ranked_by_kind",
    f"""SELECT entity, {sql_ym('month')} AS month, kind, {sql_day('release_date')} AS release_date FROM (
      SELECT *, row_number() OVER (PARTITION BY entity, month ORDER BY CASE kind WHEN 'actual' THEN 2 WHEN 'proxy' THEN 1 ELSE 0 END DESC,
        release_date) AS rn
      FROM (SELECT user_id AS entity, CAST(date_trunc('month', ts) AS DATE) AS month, CAST(ts AS DATE) AS release_date,
              CASE event_type WHEN 'signup' THEN 'actual' WHEN 'purchase' THEN 'proxy' ELSE 'ir' END AS kind FROM events))
    WHERE rn = 1""",
)
def history_ranked_by_kind(s):
    kind = F.when(F.col("kind") == "signup", "actual").when(F.col("kind") == "purchase", "proxy").otherwise("ir")
    history = s.records.select("entity", "month", F.col("day").alias("release_date"), kind.alias("kind"))
    return pick.rank_history(history).select("entity", ym("month"), "kind", day("release_date"))


@query(
    "fallback_profile",
    f"SELECT median_offset, mad_days, {sql_ym('as_of_month')} AS as_of_month, entities FROM fallback",
)
def fallback_profile(s):
    history = forecast.release_history(s.report_dates)
    early = forecast.release_profile(history, before=F.lit(TARGET).cast("date"))
    return forecast.fallback_profile(early).withColumn("as_of_month", ym("as_of_month"))


@query("blended_profiles", f"SELECT * REPLACE ({sql_ym('as_of_month')} AS as_of_month) FROM sparse_blended")
def blended_profiles(s):
    """Customers' order months as release history: thin, thick and empty ones."""
    history = _order_history(s)
    profiles = forecast.complete_profiles(s.customers, forecast.release_profile(history))
    fallback = forecast.fallback_profile(forecast.release_profile(history))
    return forecast.blend(profiles, fallback).withColumn("as_of_month", ym("as_of_month"))


def _order_history(s):
    """First order of a customer's month, as the release of the month before."""
    d = F.col("o_orderdate").cast("date")
    first = (
        s.table("orders")
        .groupBy(F.col("o_custkey").alias("entity"), F.add_months(F.trunc(d, "MM"), -1).alias("month"))
        .agg(F.min(d).alias("release_date"))
    )
    return first.select("*", F.lit("actual").alias("kind"), (F.dayofmonth("release_date") * 30).alias("release_minute"))


CTES["sparse_profiles"] = """
    SELECT entity, CAST(count(*) AS INTEGER) AS samples, any_value(med) AS median_offset,
      median(CAST(minute_local AS DOUBLE)) AS median_minute, median(abs(off - med)) AS mad_days, 'company_history' AS method,
      CASE WHEN count(*) >= 6 THEN 'high' WHEN count(*) >= 3 THEN 'medium' ELSE 'low' END AS confidence,
      max(month) AS as_of_month
    FROM (SELECT *, median(off) OVER (PARTITION BY entity) AS med
          FROM (SELECT o_custkey AS entity, CAST(date_trunc('month', o_orderdate) - INTERVAL 1 MONTH AS DATE) AS month,
                  CAST(min(day(o_orderdate)) AS DOUBLE) AS off, min(day(o_orderdate)) * 30 AS minute_local,
                  row_number() OVER (PARTITION BY o_custkey ORDER BY date_trunc('month', o_orderdate) DESC) AS rn
                FROM orders GROUP BY o_custkey, date_trunc('month', o_orderdate)) WHERE rn <= 12)
    GROUP BY 1"""
CTES["sparse_fallback"] = """
    SELECT any_value(med) AS median_offset, median(abs(median_offset - med)) AS mad_days, max(as_of_month) AS as_of_month
    FROM (SELECT *, median(median_offset) OVER () AS med FROM sparse_profiles)"""
CTES["sparse_blended"] = (
    _blend("sparse_profiles").replace("fallback f", "sparse_fallback f").replace("every_entity", "customers")
)

_SCHEDULE = {
    "entity": "entity",
    "month": sql_ym("month"),
    **{c: sql_day(c) for c in ("expected_date", "window_start", "window_end", "effective_date", "deadline", "announced_date", "actual_date")},
    **{c: c for c in ("expected_time", "effective_time", "schedule_source", "announced_time", "actual_time", "deviation_days", "unusual_reason", "status", "method", "confidence", "samples")},
    "unusual": "CASE WHEN unusual_reason IS NULL THEN 0 ELSE 1 END",
    "actual_at": sql_stamp("actual_at"),
    "effective_at": sql_stamp("CAST(effective_date || ' ' || effective_time AS TIMESTAMP) - INTERVAL 8 HOUR"),
    "announced_at": sql_stamp("CAST(announced_date || ' ' || announced_time AS TIMESTAMP) - INTERVAL 8 HOUR"),
}
_SCHEDULE_SQL = "SELECT " + ", ".join(f"{v} AS {k}" for k, v in _SCHEDULE.items()) + " FROM schedule"


def _shown(rows):
    rows = rows.withColumns({c: stamp(c) for c in ("actual_at", "effective_at", "announced_at")})
    dates = ("expected_date", "window_start", "window_end", "effective_date", "deadline", "announced_date", "actual_date")
    return rows.withColumns({c: day(c) for c in dates}).withColumn("month", ym("month"))


@query("release_schedule", _SCHEDULE_SQL)
def release_schedule(s):
    return _shown(schedule(s))


@query(
    "current_announcements",
    f"SELECT entity, {sql_ym('month')} AS month, {sql_day('announced_date')} AS announced_date, announced_time, event_id FROM announcements",
)
def current_announcements(s):
    return announcements(s).select("entity", ym("month"), day("announced_date"), "announced_time", "event_id")


@query(
    "release_calendar",
    f"""SELECT entity, ticker, name, {sql_ym('month')} AS month, {sql_day('effective_date')} AS effective_date, status
    FROM schedule JOIN dim USING (entity) WHERE month = DATE '2002-01-01'""",
)
def release_calendar(s):
    """Calendar of one month by date, then ticker."""
    rows = views.release_calendar(schedule(s), s.dim).where(F.col("month") == "2002-01-01")
    rows = rows.orderBy("effective_date", *screens.ticker_order())
    return rows.select("entity", "ticker", "name", ym("month"), day("effective_date"), "status")


@query(
    "revenue_with_schedule",
    f"""SELECT f.entity, {sql_ym('f.month')} AS month, f.revenue, s.status, {sql_day('s.deadline')} AS deadline,
      s.deviation_days FROM facts f LEFT JOIN schedule s ON s.entity = f.entity AND s.month = f.month""",
)
def revenue_with_schedule(s):
    return views.revenue_live(s.facts, schedule(s)).select(
        "entity", ym("month"), "revenue", "status", day("deadline"), "deviation_days"
    )


@query(
    "report_date_history",
    f"""SELECT entity, ticker, {sql_ym('month')} AS month, {sql_day('reported_date')} AS reported_date, reported_time,
      {sql_stamp('reported_at')} AS reported_at, basis, source_priority,
      CASE WHEN basis IN ('mops_current_feed','mops_revenue_announcement','company_ir_monthly_revenue') THEN 1 ELSE 0 END AS exact
    FROM report_dates JOIN dim USING (entity)""",
)
def report_date_history(s):
    rows = views.report_date_history(s.report_dates, s.dim)
    return rows.select(
        "entity", "ticker", ym("month"), day("reported_date"), "reported_time", stamp("reported_at"), "basis",
        "source_priority", "exact",
    )


@query(
    "best_source_dates",
    f"""SELECT entity, {sql_ym('month')} AS month, source_priority, event_id FROM (
      SELECT *, row_number() OVER (PARTITION BY entity, month ORDER BY source_priority, event_id DESC) AS rn
      FROM (SELECT user_id AS entity, CAST(ts AS DATE) AS month, event_id,
              CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 ELSE 3 END AS source_priority FROM events)) WHERE rn = 1""",
)
def best_source_dates(s):
    rank = F.when(F.col("kind") == "view", 1).when(F.col("kind") == "click", 2).otherwise(3)
    rows = s.records.select("entity", F.col("day").alias("month"), F.col("record_id").alias("event_id"), rank.alias("source_priority"))
    return pick.best_by_priority(rows, ["entity", "month"]).withColumn("month", ym("month"))


@query(
    "retained_dates",
    f"""SELECT entity, {sql_ym('month')} AS month, {sql_day('reported_date')} AS reported_date FROM (
      SELECT *, row_number() OVER (PARTITION BY entity ORDER BY month DESC) AS rn FROM report_dates) WHERE rn <= 12""",
)
def retained_dates(s):
    return pick.retain_latest(s.report_dates).select("entity", ym("month"), day("reported_date"))


@query(
    "retained_evidence",
    f"""SELECT record_id, entity, {sql_day('day')} AS day FROM (
      SELECT *, dense_rank() OVER (PARTITION BY entity ORDER BY day DESC) AS rn FROM records) WHERE rn <= 12""",
)
def retained_evidence(s):
    return pick.retain_latest_distinct(s.records, 12, month="day").select("record_id", "entity", day("day"))


@query(
    "over_retention",
    "SELECT entity, count(DISTINCT month) AS months FROM report_dates GROUP BY 1 HAVING count(DISTINCT month) > 12",
)
def over_retention(s):
    return quality.over_retention(s.report_dates)


# --- freshness -------------------------------------------------------------

CTES["fresh_target"] = """
    SELECT coalesce(min(month), (SELECT CAST(max(month) + INTERVAL 1 MONTH AS DATE) FROM facts)) AS target_month FROM (
      SELECT s.month, count(f.entity) AS n FROM schedule s LEFT JOIN facts f ON f.entity = s.entity AND f.month = s.month
      WHERE s.entity >= 0 AND s.month >= (SELECT max(month) FROM facts) GROUP BY 1)
    WHERE n < (SELECT count(*) FROM supplier)"""
CTES["fresh"] = """
    SELECT c.entity, c.ticker, c.name, c.classification, f.entity IS NOT NULL AS reported,
      coalesce(s.announced_date, s.effective_date, s.expected_date) AS expected_date,
      coalesce(s.announced_time, s.effective_time) AS expected_time, s.deadline, s.schedule_source, s.confidence,
      coalesce(s.samples, 0) AS samples,
      CASE WHEN f.entity IS NOT NULL THEN 'reported' ELSE coalesce(s.status, 'pending') END AS release_status,
      coalesce(f.entity IS NULL AND s.status = 'overdue', FALSE) AS overdue,
      coalesce(s.unusual_reason IS NOT NULL, FALSE) AS unusual, s.unusual_reason, s.deviation_days,
      (SELECT max(month) FROM facts l WHERE l.entity = c.entity) AS latest_month
    FROM classed c LEFT JOIN schedule s ON s.entity = c.entity AND s.month = (SELECT target_month FROM fresh_target)
    LEFT JOIN facts f ON f.entity = c.entity AND f.month = (SELECT target_month FROM fresh_target)"""


def own_schedule(s):
    return pick.stored(schedule(s).where(F.col("entity") >= 0))


def target_month(s, planned):
    return freshness.target_period(planned, s.kept_months, s.classed).scalar()


def fresh(s):
    planned = own_schedule(s)
    return freshness.freshness(s.classed, planned, s.kept_months, target_month(s, planned))


@query("target_period", f"SELECT {sql_ym('target_month')} AS target_month FROM fresh_target")
def target_period(s):
    return freshness.target_period(own_schedule(s), s.kept_months, s.classed).select(ym("target_month"))


@query(
    "target_period_of_months",
    f"""SELECT {sql_ym('coalesce(min(month), (SELECT CAST(max(month) + INTERVAL 1 MONTH AS DATE) FROM sparse))')} AS target_month
    FROM (SELECT m.month, count(f.entity) AS n FROM (SELECT entity, month FROM (SELECT DISTINCT month FROM panel), customers) m
      LEFT JOIN sparse f ON f.entity = m.entity AND f.month = m.month
      WHERE m.month >= (SELECT max(month) FROM sparse) GROUP BY 1) WHERE n < (SELECT count(*) FROM customers)""",
)
def target_period_of_months(s):
    """Customers' target month, with every shipping month as their schedule."""
    last = s.panel.agg(F.min("month")).scalar(), s.panel.agg(F.max("month")).scalar()
    planned = s.customers.select("entity", F.explode(F.sequence(*last, F.expr("interval 1 month"))).alias("month"))
    return freshness.target_period(planned, s.sparse, s.customers).select(ym("target_month"))


@query(
    "freshness",
    f"""SELECT * REPLACE ({sql_day('expected_date')} AS expected_date, {sql_day('deadline')} AS deadline,
      {sql_ym('latest_month')} AS latest_month) FROM fresh""",
)
def freshness_rows(s):
    rows = fresh(s).orderBy(*freshness.freshness_order(), "entity")
    return rows.withColumns({"expected_date": day("expected_date"), "deadline": day("deadline"), "latest_month": ym("latest_month")})


@query(
    "freshness_summary",
    """SELECT *, CAST(reported AS DOUBLE) / greatest(1, reported + pending) * 100 AS progress_percent FROM (
      SELECT count(*) FILTER (WHERE reported) AS reported, count(*) FILTER (WHERE NOT reported) AS pending,
        count(*) FILTER (WHERE overdue) AS overdue, count(*) FILTER (WHERE unusual) AS unusual FROM fresh)""",
)
def freshness_summary(s):
    return freshness.progress(freshness.freshness_summary(fresh(s)))


@query(
    "schedule_histogram",
    f"""SELECT coalesce({sql_day('expected_date')}, 'Unscheduled') AS expected_date, count(*) FILTER (WHERE reported) AS reported,
      count(*) FILTER (WHERE NOT reported) AS pending FROM fresh GROUP BY 1 ORDER BY 1 LIMIT 14""",
)
def schedule_histogram(s):
    return freshness.schedule_histogram(fresh(s))


@query("freshness_screen", "SELECT ticker, release_status FROM fresh WHERE unusual AND contains(lower(classification), 'nation_1')")
def freshness_screen(s):
    rows = screens.screen_status(fresh(s), "unusual").where(screens.matches("Nation_1", "ticker", ["name", "classification"]))
    return rows.select("ticker", "release_status")


@query(
    "freshness_export",
    f"""SELECT ticker, name, classification, (SELECT {sql_ym('target_month')} FROM fresh_target) AS reporting_month,
      CASE WHEN reported THEN 'Reported' ELSE 'Pending' END AS status, {sql_day('expected_date')} AS expected_date, expected_time,
      overdue, unusual, unusual_reason,
      CASE schedule_source WHEN 'ir_calendar' THEN 'IR calendar' WHEN 'actual_first_seen' THEN 'Actual'
        WHEN 'regulatory_prior' THEN 'Regulatory deadline' WHEN 'company_history' THEN
          CASE WHEN samples >= 3 THEN 'Historical estimate' WHEN samples > 0 THEN 'Blended estimate' ELSE 'Market fallback' END
        ELSE 'Not available' END AS schedule_basis, {sql_day('deadline')} AS deadline FROM fresh""",
)
def freshness_export(s):
    planned = own_schedule(s)
    target = target_month(s, planned)
    return screens.freshness_export(freshness.freshness(s.classed, planned, s.kept_months, target), target)


@query("schedule_deadlines", f"SELECT {sql_ym('month')} AS month, {sql_day('deadline')} AS deadline FROM deadlines")
def schedule_deadlines(s):
    ahead = s.table("supplier").select(
        F.explode(F.sequence(F.lit(TARGET).cast("date"), F.add_months(F.lit(TARGET).cast("date"), 12), F.expr("interval 1 month"))).alias("month")
    )
    return release_deadlines(ahead, s.holidays).select(ym("month"), day("deadline"))
