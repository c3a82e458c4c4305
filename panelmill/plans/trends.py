"""Queries: seasonal adjustment, inflections, concentration, chained indexes, quarters."""

from __future__ import annotations

from ..operators import trend
from .registry import query
from .star import CTES, day, sql_day, sql_ym, ym

CTES["season_ratios"] = """
    SELECT entity, month, idx, revenue, idx % 12 AS calendar,
      CASE WHEN count(*) OVER w6 = 13 AND sum(revenue) OVER w5 + sum(revenue) OVER w6 > 0
        THEN CAST(24 * revenue AS DOUBLE) / CAST(sum(revenue) OVER w5 + sum(revenue) OVER w6 AS DOUBLE) END AS ratio
    FROM facts WINDOW w5 AS (PARTITION BY entity ORDER BY idx RANGE BETWEEN 5 PRECEDING AND 5 FOLLOWING),
      w6 AS (PARTITION BY entity ORDER BY idx RANGE BETWEEN 6 PRECEDING AND 6 FOLLOWING)"""
CTES["season_means"] = "SELECT entity, calendar, avg(ratio) AS mean FROM season_ratios GROUP BY 1, 2"
CTES["season_factors"] = """
    SELECT r.entity, r.month, r.idx, r.revenue, CASE WHEN t.n = 12 AND t.total > 0 THEN m.mean * 12 / t.total END AS factor
    FROM season_ratios r JOIN season_means m USING (entity, calendar)
    JOIN (SELECT entity, count(mean) AS n, sum(mean) AS total FROM season_means GROUP BY 1) t ON t.entity = r.entity"""


@query(
    "seasonal_growth",
    f"""SELECT a.entity, {sql_ym('a.month')} AS month, a.revenue, round(a.factor, 6) AS factor,
      round(CASE WHEN a.factor > 0 THEN a.revenue / a.factor END, 2) AS adjusted,
      round(CASE WHEN a.factor > 0 AND b.factor > 0 AND b.revenue > 0 THEN ((a.revenue / a.factor) / (b.revenue / b.factor) - 1) * 100 END, 6) AS adjusted_growth
    FROM season_factors a LEFT JOIN season_factors b ON b.entity = a.entity AND b.idx = a.idx - 1""",
)
def seasonal_growth(s):
    return trend.seasonal_growth(s.facts).withColumn("month", ym("month"))


def _slopes(low: int, high: int) -> str:
    return f"""
    SELECT f.entity, f.idx, CAST(b.revenue - a.revenue AS DOUBLE) / (b.idx - a.idx) AS slope, f.month
    FROM facts f JOIN facts a ON a.entity = f.entity AND a.idx BETWEEN f.idx + {low} AND f.idx + {high}
    JOIN facts b ON b.entity = f.entity AND b.idx BETWEEN f.idx + {low} AND f.idx + {high} AND b.idx > a.idx"""


def _points(low: int, high: int) -> str:
    return f"count(*) OVER (PARTITION BY entity ORDER BY idx RANGE BETWEEN {-low} PRECEDING AND {-high} PRECEDING)"


CTES["slopes_now"] = _slopes(-5, 0)
CTES["slopes_then"] = _slopes(-17, -6)
CTES["slope_trend"] = "SELECT entity, idx, median(slope) AS trend FROM slopes_then GROUP BY 1, 2"
CTES["slope_spread"] = "SELECT entity, idx, any_value(trend) AS trend, median(abs(slope - trend)) AS spread FROM slopes_then JOIN slope_trend USING (entity, idx) GROUP BY 1, 2"
CTES["slope_scores"] = f"""
    SELECT n.entity, n.month, n.recent, t.trend, round(CASE WHEN t.spread > 0 THEN (n.recent - t.trend) / t.spread END, 6) AS score
    FROM (SELECT entity, idx, any_value(month) AS month, median(slope) AS recent FROM slopes_now GROUP BY 1, 2) n
    JOIN slope_spread t USING (entity, idx)
    JOIN (SELECT entity, idx, {_points(-5, 0)} AS now, {_points(-17, -6)} AS then FROM facts) p USING (entity, idx) WHERE p.now >= 4 AND p.then >= 8"""


@query(
    "inflections",
    f"""SELECT entity, {sql_ym('month')} AS month, round(recent, 4) AS recent, round(trend, 4) AS trend, score,
      CASE WHEN score >= 3 THEN 'up' WHEN score <= -3 THEN 'down' WHEN score IS NOT NULL THEN 'none' END AS inflection FROM slope_scores""",
)
def inflections(s):
    return trend.inflections(s.facts).withColumn("month", ym("month"))


CTES["grouped_before"] = """
    SELECT b.classification, f.month, f.entity, f.revenue, y.revenue AS last_year, m.revenue AS last_month
    FROM facts f JOIN bridge b ON b.entity = f.entity LEFT JOIN facts y ON y.entity = f.entity AND y.idx = f.idx - 12
    LEFT JOIN facts m ON m.entity = f.entity AND m.idx = f.idx - 1"""
CTES["concentrated"] = """
    SELECT classification, month, count(*) AS members, CAST(sum(revenue) AS BIGINT) AS revenue,
      CAST(sum(revenue) AS DOUBLE) AS total, CAST(sum(CAST(revenue AS HUGEINT) * revenue) AS DOUBLE) AS squares,
      CAST(sum(revenue) FILTER (WHERE last_year IS NOT NULL) AS DOUBLE) AS now_both, CAST(sum(last_year) AS DOUBLE) AS then_both,
      CAST(max(revenue) FILTER (WHERE last_year IS NOT NULL) AS DOUBLE) AS top_now,
      CAST(arg_max(last_year, (revenue, -entity)) FILTER (WHERE last_year IS NOT NULL) AS DOUBLE) AS top_then,
      CAST(sum(revenue) FILTER (WHERE place <= 3) AS DOUBLE) AS top
    FROM (SELECT *, row_number() OVER (PARTITION BY classification, month ORDER BY revenue DESC, entity) AS place FROM grouped_before) GROUP BY 1, 2"""


@query(
    "concentration",
    f"""SELECT classification, {sql_ym('month')} AS month, members, revenue,
      round(CASE WHEN then_both > 0 THEN (now_both / then_both - 1) * 100 END, 6) AS yoy,
      round(CASE WHEN then_both - top_then > 0 THEN ((now_both - top_now) / (then_both - top_then) - 1) * 100 END, 6) AS yoy_ex_largest,
      round(CASE WHEN total > 0 THEN top * 100 / total END, 6) AS top_share,
      round(CASE WHEN total > 0 THEN squares / total / total * 10000 END, 4) AS herfindahl FROM concentrated""",
)
def concentration(s):
    return trend.concentration(s.facts, s.bridge).withColumn("month", ym("month"))


CTES["links"] = """
    SELECT classification, month, count(last_month) AS matched,
      CASE WHEN sum(last_month) > 0 AND sum(revenue) FILTER (WHERE last_month IS NOT NULL) > 0
        THEN CAST(sum(revenue) FILTER (WHERE last_month IS NOT NULL) AS DOUBLE) / CAST(sum(last_month) AS DOUBLE) END AS link
    FROM grouped_before GROUP BY 1, 2"""
CTES["chains"] = "SELECT *, count(*) FILTER (WHERE link IS NULL) OVER (PARTITION BY classification ORDER BY month) AS chain FROM links"


@query(
    "chained_index",
    f"""SELECT classification, {sql_ym('month')} AS month, matched, round(link, 6) AS link, chain,
      round(100 * exp(sum(coalesce(ln(link), 0)) OVER (PARTITION BY classification, chain ORDER BY month)), 6) AS index FROM chains""",
)
def chained_index(s):
    return trend.chained_index(s.facts, s.bridge).withColumn("month", ym("month"))


@query(
    "quarter_totals",
    f"""SELECT a.entity, {sql_day('a.quarter')} AS quarter, a.months, a.revenue, a.by_ytd - coalesce(b.by_ytd, 0) AS by_ytd,
      a.revenue - (a.by_ytd - coalesce(b.by_ytd, 0)) AS difference
    FROM (SELECT entity, idx // 3 AS q, CAST(date_trunc('quarter', min(month)) AS DATE) AS quarter, count(*) AS months, CAST(sum(revenue) AS BIGINT) AS revenue,
            max(ytd) FILTER (WHERE idx % 3 = 2) AS by_ytd FROM facts GROUP BY 1, 2) a
    LEFT JOIN (SELECT entity, idx // 3 + 1 AS q, idx % 12 = 11 AS ends_year, ytd AS by_ytd FROM facts WHERE idx % 3 = 2) b
      ON b.entity = a.entity AND b.q = a.q AND a.q % 4 <> 0
    WHERE a.q % 4 = 0 OR b.by_ytd IS NOT NULL
    UNION ALL
    SELECT entity, {sql_day("date_trunc('quarter', min(month))")}, count(*), CAST(sum(revenue) AS BIGINT), NULL, NULL FROM facts f
    WHERE (idx // 3) % 4 <> 0 AND NOT EXISTS (SELECT 1 FROM facts g WHERE g.entity = f.entity AND g.idx = (f.idx // 3) * 3 - 1) GROUP BY entity, idx // 3""",
)
def quarter_totals(s):
    return trend.quarter_totals(s.facts).withColumn("quarter", day("quarter"))
