"""Queries: panel windows, momentum, group roll-ups, currency."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import groups, panel, pick, quality, screens, views
from .registry import query
from .star import CTES, day, growth, jr, sql_day, sql_ym, ym


def _win(n: int, lag: int) -> str:
    frame = f"OVER (PARTITION BY entity ORDER BY idx RANGE BETWEEN {lag + n - 1} PRECEDING AND {lag} PRECEDING)"
    return f"CASE WHEN count(revenue) {frame} = {n} THEN CAST(sum(revenue) {frame} AS BIGINT) END"


def _dense(source: str) -> str:
    return f"""
    SELECT entity, month, CAST(year(month)*12+month(month)-1 AS INTEGER) AS idx, revenue
    FROM (SELECT entity, CAST(m AS DATE) AS month FROM (SELECT DISTINCT entity FROM {source}),
            (SELECT unnest(generate_series((SELECT min(month) FROM {source}), (SELECT max(month) FROM {source}),
              INTERVAL 1 MONTH)) AS m))
    LEFT JOIN {source} USING (entity, month)"""


def _window_momentum(dense: str) -> str:
    parts = []
    for period, n, *_ in panel.PERIODS:
        cur, prior, before, base = (
            ((1, 0), (1, 12), (1, 1), (1, 13)) if period == "yoy" else ((n, 0), (n, n), (n, n), (n, 2 * n))
        )
        parts.append(
            f"""SELECT entity, month, '{period}' AS period, {_win(*cur)} AS cur, {_win(*prior)} AS prior,
              {_win(*before)} AS bef, {_win(*base)} AS base FROM {dense}"""
        )
    now, then = growth("cur", "prior"), growth("bef", "base")
    acc = jr(f"{now} - {then}")
    return f"""
    SELECT entity, month, period, cur AS current_revenue, prior AS prior_revenue, {jr(now)} AS current_growth,
      {jr(then)} AS previous_growth, {acc} AS acceleration,
      CASE WHEN {acc} > 0 THEN 'accelerating' WHEN {acc} < 0 THEN 'decelerating' WHEN {acc} = 0 THEN 'unchanged'
        ELSE 'unavailable' END AS direction
    FROM ({' UNION ALL '.join(parts)})"""


def _ends(dim: str, facts: str) -> str:
    return f"""
    SELECT entity, 'mix' AS key, own AS analysis_month
    FROM {dim} LEFT JOIN (SELECT entity, max(month) AS own FROM {facts} GROUP BY 1) USING (entity)
    UNION ALL
    SELECT entity, strftime(m, '%Y-%m'), m FROM {dim},
      (SELECT CAST((SELECT max(month) FROM {facts}) - to_months(k) AS DATE) AS m
       FROM (SELECT CAST(unnest([0, 1, 2]) AS INTEGER) AS k))"""


def _snapshot(ends: str, dim: str, facts: str, momentum: str) -> str:
    return f"""
    SELECT e.entity, d.ticker, d.name, d.classification, e.key, {sql_ym('e.analysis_month')} AS analysis_month,
      {sql_ym('f.month')} AS latest_month, f.revenue AS latest_revenue, f.mom AS mom_percent, f.yoy AS yoy_percent,
      g.yoy AS previous_yoy_percent, f.ytd_yoy AS ytd_yoy_percent, p.period,
      m.current_revenue, m.prior_revenue, m.current_growth, m.previous_growth, m.acceleration,
      coalesce(m.direction, 'unavailable') AS direction
    FROM {ends} e JOIN {dim} d USING (entity)
    JOIN (SELECT unnest(['mom','yoy','3m','6m','ltm']) AS period) p ON TRUE
    LEFT JOIN {facts} f ON f.entity = e.entity AND f.month = e.analysis_month
    LEFT JOIN {facts} g ON g.entity = e.entity AND g.month = e.analysis_month - INTERVAL 1 MONTH
    LEFT JOIN {momentum} m ON m.entity = e.entity AND m.month = e.analysis_month AND m.period = p.period"""


CTES["dense"] = _dense("panel")
CTES["sparse_dense"] = _dense("sparse")
CTES["wmom"] = _window_momentum("dense")
CTES["sparse_wmom"] = _window_momentum("sparse_dense")
CTES["panel_ends"] = _ends("classed", "facts")
CTES["sparse_ends"] = _ends("customers", "sparse_facts")
CTES["snap"] = _snapshot("panel_ends", "classed", "facts", "wmom")
CTES["sparse_snap"] = _snapshot("sparse_ends", "customers", "sparse_facts", "sparse_wmom")
_GROWTH = f"""CAST(coalesce(sum(revenue), 0) AS BIGINT) AS aggregate_revenue, count(revenue) AS reporting,
      {jr('avg(yoy)')} AS simple_yoy,
      {jr('sum(yoy*revenue) FILTER (WHERE yoy IS NOT NULL AND revenue > 0) / sum(revenue) FILTER (WHERE yoy IS NOT NULL AND revenue > 0)')} AS weighted_yoy"""
CTES["series"] = f"""
    SELECT classification, month, {_GROWTH} FROM facts JOIN bridge USING (entity) GROUP BY 1, 2"""
CTES["members"] = """
    SELECT b.classification, e.key, e.entity, d.ticker, d.name, f.month AS reporting_month, f.revenue, f.yoy
    FROM panel_ends e JOIN dim d USING (entity) JOIN bridge b USING (entity)
    LEFT JOIN facts f ON f.entity = e.entity AND f.month = e.analysis_month"""
CTES["grouped"] = f"SELECT classification, key, {_GROWTH} FROM members GROUP BY 1, 2"
_CONSTITUENTS = f"""
    SELECT m.*, {jr('CASE WHEN t.r > 0 THEN CAST(m.revenue AS DOUBLE) / t.r * 100 END')} AS revenue_weight,
      {jr('CASE WHEN t.n > 0 THEN m.yoy / t.n END')} AS simple_contribution,
      {jr('CASE WHEN m.yoy IS NOT NULL AND m.revenue > 0 AND t.w > 0 THEN m.yoy * m.revenue / t.w END')} AS weighted_contribution
    FROM members m JOIN (SELECT classification, key, CAST(coalesce(sum(revenue), 0) AS DOUBLE) AS r, count(yoy) AS n,
        CAST(sum(revenue) FILTER (WHERE yoy IS NOT NULL AND revenue > 0) AS DOUBLE) AS w
      FROM members GROUP BY 1, 2) t USING (classification, key)"""
CTES["parts"] = _CONSTITUENTS


def momentum_rows(s):
    return panel.momentum(s.classed, s.facts)


def sparse_momentum(s):
    return panel.momentum(s.customers, s.sparse_facts)


def members(s):
    return groups.snapshot_members(s.dim.drop("labels"), s.kept_facts, s.bridge)


# --- panel windows ---------------------------------------------------------


@query(
    "reported_facts",
    f"SELECT entity, {sql_ym('month')} AS month, idx, revenue, ytd, mom, yoy, ytd_yoy FROM sparse_facts",
)
def reported_facts(s):
    return s.sparse_facts.withColumn("month", ym("month"))


@query(
    "window_momentum",
    f"SELECT * REPLACE ({sql_ym('month')} AS month) FROM wmom",
)
def window_momentum(s):
    return panel.window_momentum(s.panel).withColumn("month", ym("month"))


@query(
    "window_momentum_sparse",
    f"SELECT * REPLACE ({sql_ym('month')} AS month) FROM sparse_wmom",
)
def window_momentum_sparse(s):
    return panel.window_momentum(s.sparse).withColumn("month", ym("month"))


@query(
    "complete_window_sums",
    f"""SELECT entity, {sql_ym('month')} AS month, {_win(3, 0)} AS three, {_win(3, 3)} AS three_before,
      {_win(12, 0)} AS twelve, {_win(6, 12)} AS six_last_year FROM sparse_dense""",
)
def complete_window_sums(s):
    sums = {
        "three": panel.period_sum("revenue", 3),
        "three_before": panel.period_sum("revenue", 3, 3),
        "twelve": panel.period_sum("revenue", 12),
        "six_last_year": panel.period_sum("revenue", 6, 12),
    }
    return panel.densify(s.sparse).withColumns(sums).drop("idx", "revenue").withColumn("month", ym("month"))


def _momentum_out(rows):
    return rows.withColumns({"analysis_month": ym("analysis_month"), "latest_month": ym("latest_month")})


@query("momentum_snapshot", "SELECT * FROM snap")
def momentum_snapshot(s):
    return _momentum_out(momentum_rows(s))


@query("momentum_snapshot_sparse", "SELECT * FROM sparse_snap")
def momentum_snapshot_sparse(s):
    return _momentum_out(sparse_momentum(s))


@query("analysis_spine", f"SELECT entity, key, {sql_ym('analysis_month')} AS analysis_month FROM sparse_ends")
def analysis_spine(s):
    spine = panel.analysis_spine(s.customers.select("entity"), s.sparse_facts)
    return spine.withColumn("analysis_month", ym("analysis_month"))


@query(
    "latest_per_entity",
    f"""SELECT entity, {sql_ym('max(month)')} AS month, arg_max(revenue, month) AS revenue,
      arg_max(ytd, month) AS ytd FROM sparse_facts GROUP BY 1""",
)
def latest_per_entity(s):
    return panel.latest_per_entity(s.sparse_facts, ["month", "revenue", "ytd"]).withColumn("month", ym("month"))


@query(
    "previous_month_yoy",
    f"""SELECT f.entity, {sql_ym('f.month')} AS month, f.yoy, g.yoy AS previous_yoy FROM facts f
    LEFT JOIN facts g ON g.entity = f.entity AND g.idx = f.idx - 1""",
)
def previous_month_yoy(s):
    return panel.previous_yoy(s.facts).select("entity", ym("month"), "yoy", "previous_yoy")


@query(
    "tail_rows_24",
    f"""SELECT entity, {sql_ym('month')} AS month, revenue FROM
      (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY month DESC) AS rn FROM sparse) WHERE rn <= 24""",
)
def tail_rows_24(s):
    return panel.tail_rows(s.sparse, 24).withColumn("month", ym("month"))


@query(
    "ascending_months",
    f"""SELECT entity, seq, {sql_ym('month')} AS month FROM (SELECT o_custkey AS entity, o_orderkey AS seq,
        date_trunc('month', o_orderdate) AS month,
        lag(date_trunc('month', o_orderdate)) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS before FROM orders)
    WHERE month <= before""",
)
def ascending_months(s):
    series = s.table("orders").select(
        F.col("o_custkey").alias("entity"),
        F.col("o_orderkey").alias("seq"),
        F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("month"),
    )
    return panel.check_ascending(series, segment=1024).withColumn("month", ym("month"))


# --- groups ----------------------------------------------------------------


@query("label_bridge", "SELECT entity, classification, CAST(label_order AS INTEGER) AS label_order FROM bridge")
def label_bridge(s):
    return s.bridge


@query(
    "unknown_labels",
    "SELECT entity, classification, CAST(label_order AS INTEGER) AS label_order FROM bridge WHERE classification NOT IN (SELECT r_name FROM region)",
)
def unknown_labels(s):
    return groups.unknown_labels(s.bridge, s.table("region").select(F.col("r_name").alias("classification")))


@query("group_growth", f"SELECT * REPLACE ({sql_ym('month')} AS month) FROM series")
def group_growth(s):
    return groups.group_growth(s.facts, s.bridge).withColumn("month", ym("month"))


@query("group_snapshot", "SELECT * FROM grouped")
def group_snapshot(s):
    return groups.group_snapshot(members(s))


@query(
    "constituents",
    f"SELECT * REPLACE ({sql_ym('reporting_month')} AS reporting_month) FROM parts",
)
def constituents(s):
    rows = groups.constituents(members(s))
    return rows.withColumn("reporting_month", ym("reporting_month"))


@query(
    "constituents_in_order",
    """SELECT classification, key, ticker, revenue,
      row_number() OVER (PARTITION BY classification, key ORDER BY revenue DESC NULLS LAST, ticker) AS position FROM parts""",
)
def constituents_in_order(s):
    """Constituent order as positions; every class is numbered by a range sort."""
    order = [F.asc("classification"), F.asc("key"), *groups.constituent_order()]
    ranked = pick.global_rank(members(s).select("classification", "key", "ticker", "revenue"), order)
    first = ranked.groupBy("classification", "key").agg(F.min("rank").alias("_first"))
    joined = ranked.join(first, ["classification", "key"])
    return joined.select(
        "classification", "key", "ticker", "revenue", (F.col("rank") - F.col("_first") + 1).alias("position")
    )


_RANKED = """
    SELECT *, row_number() OVER (ORDER BY {metric} DESC NULLS LAST, classification) AS rank FROM grouped
    WHERE key = (SELECT strftime(max(month), '%Y-%m') FROM facts)"""


def _latest_snapshot(s):
    rows = members(s)
    latest = F.date_format(panel.latest_month(s.kept_facts), "yyyy-MM")
    return groups.group_snapshot(rows.where(F.col("key") == latest))


@query("group_growth_leaderboard", _RANKED.format(metric="simple_yoy"))
def group_growth_leaderboard(s):
    return groups.leaderboard(_latest_snapshot(s), "simple_yoy")


@query("group_growth_leaderboard_weighted", _RANKED.format(metric="weighted_yoy"))
def group_growth_leaderboard_weighted(s):
    return groups.leaderboard(_latest_snapshot(s), "weighted_yoy")


@query(
    "group_leaders",
    """SELECT key, metric, classification, value FROM (
      SELECT *, row_number() OVER (PARTITION BY key, metric ORDER BY value DESC NULLS LAST, classification) AS rn
      FROM (SELECT key, classification, 'simple_yoy' AS metric, simple_yoy AS value FROM grouped
            UNION ALL SELECT key, classification, 'weighted_yoy', weighted_yoy FROM grouped)) WHERE rn = 1""",
)
def group_leaders(s):
    return groups.leaders(groups.group_snapshot(members(s)))


@query(
    "group_chart_series",
    f"""SELECT * REPLACE ({sql_ym('month')} AS month) FROM series WHERE month < DATE '2001-10-01'
    UNION ALL
    SELECT classification, key, aggregate_revenue, reporting, simple_yoy, weighted_yoy FROM grouped WHERE key = '2001-10'""",
)
def group_chart_series(s):
    series = groups.group_growth(s.kept_facts, s.bridge)
    rows = groups.chart_series(series, groups.group_snapshot(members(s)), "2001-10")
    return rows.withColumn("month", ym("month"))


@query("class_counts", "SELECT classification, count(*) AS entities FROM classed GROUP BY 1")
def class_counts(s):
    return groups.class_counts(s.classed)


# --- momentum screens ------------------------------------------------------

_MIX = "SELECT * FROM sparse_snap WHERE key = 'mix' AND period = '3m'"


def _mix_3m(s):
    return sparse_momentum(s).where((F.col("key") == "mix") & (F.col("period") == "3m"))


@query(
    "momentum_breadth",
    """SELECT key, period, count(*) FILTER (WHERE direction = 'accelerating') AS accelerating,
      count(*) FILTER (WHERE direction = 'decelerating') AS decelerating,
      count(*) FILTER (WHERE direction = 'unchanged') AS unchanged,
      CAST(count(*) FILTER (WHERE direction = 'accelerating') AS DOUBLE)
        / greatest(1, count(*) FILTER (WHERE direction IN ('accelerating', 'decelerating'))) * 100 AS breadth_percent
    FROM sparse_snap GROUP BY 1, 2""",
)
def momentum_breadth(s):
    return screens.breadth(sparse_momentum(s), ["key", "period"])


@query(
    "momentum_chart",
    f"""SELECT entity, acceleration FROM ({_MIX} ORDER BY abs(coalesce(acceleration, 0)) DESC, ticker LIMIT 18)""",
)
def momentum_chart(s):
    return screens.momentum_chart(_mix_3m(s)).select("entity", "acceleration")


@query(
    "momentum_chart_decelerating",
    """SELECT entity, acceleration FROM (SELECT * FROM snap WHERE key = 'mix' AND period = '3m'
      AND direction = 'decelerating' ORDER BY acceleration, ticker LIMIT 18)""",
)
def momentum_chart_decelerating(s):
    rows = momentum_rows(s).where((F.col("key") == "mix") & (F.col("period") == "3m"))
    return screens.momentum_chart(rows, "decelerating").select("entity", "acceleration")


@query(
    "momentum_screen",
    """SELECT key, entity, acceleration, direction FROM sparse_snap
    WHERE period = 'mom' AND direction = 'accelerating' AND (ticker LIKE '%7%' OR lower(name) LIKE '%7%'
      OR lower(classification) LIKE '%7%')""",
)
def momentum_screen(s):
    rows = sparse_momentum(s).where(F.col("period") == "mom")
    rows = screens.screen_direction(rows, "accelerating").where(
        screens.matches(" 7 ", "ticker", ["name", "classification"])
    )
    return rows.orderBy(*screens.momentum_order("accelerating")).select("key", "entity", "acceleration", "direction")


@query(
    "momentum_export",
    f"""SELECT key, ticker, name, classification, '3M/3M' AS period_label,
      {sql_ym("CAST((analysis_month || '-01') AS DATE) - INTERVAL 2 MONTH")} AS current_start, analysis_month AS current_end,
      {sql_ym("CAST((analysis_month || '-01') AS DATE) - INTERVAL 5 MONTH")} AS prior_start,
      {sql_ym("CAST((analysis_month || '-01') AS DATE) - INTERVAL 3 MONTH")} AS prior_end,
      current_revenue, prior_revenue, current_growth, previous_growth, acceleration, direction
    FROM snap WHERE period = '3m'""",
)
def momentum_export(s):
    return screens.momentum_export(momentum_rows(s), "3m")


# --- currency --------------------------------------------------------------

CTES["usd"] = f"""
    SELECT f.*, x.average_rate, x.observations AS fx_observations, x.last_date AS fx_last_date,
      {jr('f.revenue / x.average_rate')} AS revenue_usd,
      CASE WHEN x.average_rate IS NOT NULL THEN {jr('sum(f.revenue / x.average_rate) OVER (PARTITION BY f.entity, year(f.month) ORDER BY f.month)')} END AS ytd_usd
    FROM sparse_facts f LEFT JOIN full_rates x USING (month)"""


def _usd(s):
    return panel.translate(s.sparse_facts, s.full_rates)


@query(
    "monthly_rates",
    f"SELECT {sql_ym('month')} AS month, average_rate, observations, {sql_day('first_date')} AS first_date, {sql_day('last_date')} AS last_date FROM rates",
)
def monthly_rates(s):
    return s.rates.select(ym("month"), "average_rate", "observations", day("first_date"), day("last_date"))


@query(
    "usd_translation",
    f"SELECT entity, {sql_ym('month')} AS month, revenue, revenue_usd, ytd_usd, average_rate FROM usd",
)
def usd_translation(s):
    return panel.translate_checked(s.sparse_facts, s.full_rates).select(
        "entity", ym("month"), "revenue", "revenue_usd", "ytd_usd", "average_rate"
    )


@query(
    "usd_translation_gaps",
    f"""SELECT f.entity, {sql_ym('f.month')} AS month, {jr('f.revenue / x.average_rate')} AS revenue_usd,
      CASE WHEN x.average_rate IS NOT NULL THEN
        {jr('sum(f.revenue / x.average_rate) OVER (PARTITION BY f.entity, year(f.month) ORDER BY f.month)')} END AS ytd_usd
    FROM facts f LEFT JOIN rates x USING (month)""",
)
def usd_translation_gaps(s):
    return panel.translate(s.facts, s.rates).select("entity", ym("month"), "revenue_usd", "ytd_usd")


@query(
    "currency_switch",
    f"""SELECT entity, {sql_ym('month')} AS month, CAST(revenue AS DOUBLE) AS twd, CAST(ytd AS DOUBLE) AS twd_ytd,
      revenue_usd AS usd, ytd_usd AS usd_ytd, yoy FROM usd""",
)
def currency_switch(s):
    twd = panel.in_currency(_usd(s), "TWD").select(
        "*", F.col("shown_revenue").alias("twd"), F.col("shown_ytd").alias("twd_ytd")
    )
    usd = panel.in_currency(twd.drop("shown_revenue", "shown_ytd", "shown_rate"), "USD")
    return usd.select(
        "entity", ym("month"), "twd", "twd_ytd", F.col("shown_revenue").alias("usd"), F.col("shown_ytd").alias("usd_ytd"), "yoy"
    )


@query("missing_rates", f"SELECT DISTINCT {sql_ym('month')} AS month FROM panel WHERE month NOT IN (SELECT month FROM rates)")
def missing_rates(s):
    return views.missing_rates(s.facts, s.rates).select(ym("month"))


@query(
    "company_export",
    f"""SELECT entity, {sql_ym('month')} AS month, revenue_usd AS revenue, mom AS mom_percent, yoy AS yoy_percent,
      ytd_usd AS ytd_revenue, ytd_yoy AS ytd_yoy_percent, average_rate, fx_observations,
      {sql_day('fx_last_date')} AS fx_last_date,
      CASE WHEN entity % 2 = 0 THEN {sql_day('month')} END AS publication_timestamp,
      CASE WHEN entity % 2 = 0 THEN 'First observed' ELSE 'Original time unavailable' END AS publication_basis,
      entity % 3 = 0 AS restated, 'sii' AS market, 'u' AS source_url
    FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY month DESC) AS rn FROM usd) WHERE rn <= 12""",
)
def company_export(s):
    stamped = panel.tail_rows(panel.in_currency(_usd(s), "USD"), 12).withColumns(
        {
            "publication_timestamp": F.date_format("month", "yyyy-MM-dd"),
            "publication_basis": F.when(F.col("entity") % 2 == 0, "MOPS_ARCHIVE_FIRST_OBSERVED").otherwise(
                "MOPS_ARCHIVE_HTTP_LAST_MODIFIED_CURRENT_VERSION"
            ),
            "restated": F.col("entity") % 3 == 0,
            "source_market": F.lit("sii"),
            "source_url": F.lit("u"),
        }
    )
    return screens.company_export(stamped, "USD")


# --- manifest and reconciliation -------------------------------------------


@query(
    "manifest",
    f"""SELECT {sql_ym('min(month)')} AS first_month, {sql_ym('max(month)')} AS latest_month, count(*) AS observations,
      (SELECT count(*) FROM dim) AS entity_count, (SELECT count(DISTINCT classification) FROM bridge) AS class_count,
      (SELECT count(*) FROM rates WHERE month BETWEEN (SELECT min(month) FROM facts) AND (SELECT max(month) FROM facts)) AS rate_count,
      (SELECT {sql_ym('min(month)')} FROM rates WHERE month >= (SELECT min(month) FROM facts)) AS rate_start,
      (SELECT {sql_ym('max(month)')} FROM rates WHERE month <= (SELECT max(month) FROM facts)) AS rate_end,
      (SELECT arg_max(average_rate, month) FROM rates WHERE month <= (SELECT max(month) FROM facts)) AS latest_rate
    FROM facts""",
)
def manifest(s):
    row = views.manifest(s.dim, s.bridge, s.kept_months, s.rates)
    return row.withColumns({c: ym(c) for c in ("first_month", "latest_month", "rate_start", "rate_end")})


@query(
    "latest_summary",
    f"""SELECT c.entity, c.ticker, c.name, {sql_ym('max(month)')} AS month, arg_max(revenue, month) AS revenue,
      max_by(ytd, month) AS ytd FROM customers c LEFT JOIN sparse_facts f USING (entity) GROUP BY 1, 2, 3""",
)
def latest_summary(s):
    dim = s.customers.drop("classification")
    return views.latest_summary(dim, s.sparse_facts, ["month", "revenue", "ytd"]).withColumn("month", ym("month"))


@query(
    "reconcile_groups",
    """SELECT classification, key FROM grouped JOIN (SELECT classification, key, avg(yoy) AS m,
        sum(yoy*revenue) FILTER (WHERE yoy IS NOT NULL AND revenue > 0)
          / sum(revenue) FILTER (WHERE yoy IS NOT NULL AND revenue > 0) AS w FROM members GROUP BY 1, 2)
      USING (classification, key)
    WHERE abs(simple_yoy - m) > 0.002 OR abs(weighted_yoy - w) > 0.002""",
)
def reconcile_groups(s):
    """Groups against their constituents, at a tolerance below the rounding."""
    rows = members(s)
    return quality.reconcile_groups(groups.group_snapshot(rows), rows, 0.002).select("classification", "key")


@query(
    "reconcile_series",
    f"""SELECT g.classification, s.month AS key FROM grouped g JOIN (SELECT classification, strftime(month, '%Y-%m') AS month,
        aggregate_revenue, reporting, simple_yoy, weighted_yoy FROM series) s
      ON s.classification = g.classification AND s.month = CASE g.key WHEN 'mix' THEN (SELECT {sql_ym('max(month)')} FROM facts) ELSE g.key END
    WHERE (g.aggregate_revenue, g.reporting, g.simple_yoy, g.weighted_yoy)
      IS DISTINCT FROM (s.aggregate_revenue, s.reporting, s.simple_yoy, s.weighted_yoy)""",
)
def reconcile_series(s):
    """Snapshot rows that differ from the series; mix is held against the latest month."""
    snapshot = groups.group_snapshot(members(s), exact=True)
    latest = F.date_format(panel.latest_month(s.kept_facts), "yyyy-MM")
    held = snapshot.withColumn("key", F.when(F.col("key") == "mix", latest).otherwise(F.col("key")))
    series = groups.group_growth(s.kept_facts, s.bridge, exact=True)
    return quality.snapshot_series_mismatch(held, series).select("classification", "key")


@query(
    "reconcile_momentum",
    """SELECT entity, key, period FROM snap
    WHERE abs(acceleration - (current_growth - previous_growth)) > 0.005""",
)
def reconcile_momentum(s):
    """Acceleration against the rounded growths, at a tolerance below the rounding."""
    return quality.momentum_mismatch(momentum_rows(s), 0.005).select("entity", "key", "period")


@query(
    "reconcile_growth",
    f"""SELECT entity, {sql_ym('month')} AS month, yoy, current_growth FROM facts JOIN wmom USING (entity, month)
    WHERE period = 'yoy' AND abs(yoy - current_growth) > 0.004""",
)
def reconcile_growth(s):
    """Reported against panel growth, at a tolerance some rows exceed."""
    rows = quality.growth_mismatch(s.facts, panel.window_momentum(s.panel), tolerance=0.004)
    return rows.withColumn("month", ym("month"))

