"""Queries: picking, names, tolerance matches, corroborated evidence."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import name_key
from ..operators import maintain, match, pick
from .registry import query
from .star import CTES, NOW, day, sql_day, sql_stamp, sql_ym, stamp, ym

# Claims: every event claims its value for its user's day, with a tolerance by
# kind. Observations: the mean of each user, day and kind.

_TOLERANCE = "CASE kind WHEN 'view' THEN 50 WHEN 'click' THEN 500 WHEN 'purchase' THEN 5000 WHEN 'signup' THEN 1 ELSE 20000 END"
CTES["claims"] = f"""
    SELECT record_id, entity, day, revenue, CAST({_TOLERANCE} AS BIGINT) AS tolerance,
      CASE WHEN revenue % 7 <> 0 THEN CAST(revenue % 100 AS DOUBLE) / 1000 END AS mom FROM records"""
CTES["means"] = """
    SELECT entity, day, min(record_id) AS obs_id, kind = 'view' AS is_current, CAST(floor(sum(revenue) / count(*)) AS BIGINT) AS revenue,
      CASE WHEN min(revenue) % 5 <> 0 THEN CAST(min(revenue) % 100 AS DOUBLE) / 1000 END AS mom FROM records GROUP BY entity, day, kind"""
CTES["best_match"] = """
    SELECT * FROM (SELECT c.record_id, c.entity, c.day, c.revenue, o.obs_id, o.is_current, o.revenue AS matched_revenue,
        row_number() OVER (PARTITION BY c.record_id ORDER BY o.is_current DESC, o.obs_id) AS rn
      FROM claims c JOIN means o ON o.entity = c.entity AND o.day = c.day AND abs(o.revenue - c.revenue) <= c.tolerance
        AND coalesce(abs(c.mom - o.mom) <= 0.06, TRUE)) WHERE rn = 1"""


def claims(s):
    tolerance = (
        F.when(F.col("kind") == "view", 50)
        .when(F.col("kind") == "click", 500)
        .when(F.col("kind") == "purchase", 5000)
        .when(F.col("kind") == "signup", 1)
        .otherwise(20000)
        .cast("long")
    )
    mom = F.when(F.col("revenue") % 7 != 0, F.col("revenue") % 100 / 1000)
    return s.records.select("record_id", "entity", "day", "revenue", tolerance.alias("tolerance"), mom.alias("mom"))


def means(s):
    low = F.min("revenue")
    return s.records.groupBy("entity", "day", "kind").agg(
        F.min("record_id").alias("obs_id"),
        F.floor(F.sum("revenue") / F.count("*")).cast("long").alias("revenue"),
        F.when(low % 5 != 0, low % 100 / 1000).alias("mom"),
    ).withColumn("is_current", F.col("kind") == "view")


@query(
    "tolerance_match",
    f"SELECT record_id, entity, {sql_day('day')} AS day, revenue, obs_id, is_current, matched_revenue FROM best_match",
)
def tolerance_match(s):
    found = match.tolerance_match(claims(s), means(s), keys=["entity", "day"], percents=["mom"])
    return found.select("record_id", "entity", day("day"), "revenue", "obs_id", "is_current", "matched_revenue")


@query(
    "release_match",
    """SELECT entity, version, obs_id FROM (SELECT l.entity, l.version, o.obs_id,
        row_number() OVER (PARTITION BY l.entity, l.version ORDER BY o.is_current DESC, o.obs_id) AS rn
      FROM (SELECT entity, obs_id AS version, revenue + 700 AS revenue, quantity + 5 AS quantity FROM obs) l
      JOIN obs o ON o.entity = l.entity AND abs(o.revenue - l.revenue) <= 1000 AND abs(o.quantity - l.quantity) <= 10) WHERE rn = 1""",
)
def release_match(s):
    """Five-metric form: two amounts within fixed tolerances."""
    rows = s.observations.select("entity", "obs_id", "is_current", "revenue", "quantity")
    shifted = rows.select(
        "entity", F.col("obs_id").alias("version"), (F.col("revenue") + 700).alias("revenue"),
        (F.col("quantity") + 5).alias("quantity"), F.lit(match.RELEASE_TOLERANCE).cast("long").alias("tolerance"),
    )
    found = match.tolerance_match(shifted, rows, keys=["entity"], also=[("quantity", 10)])
    return found.select("entity", "version", "obs_id")


@query(
    "match_counts",
    "SELECT count(*) AS seen, (SELECT count(*) FROM best_match) AS matched, count(*) - (SELECT count(*) FROM best_match) AS rejected FROM claims",
)
def match_counts(s):
    found = match.tolerance_match(claims(s), means(s), keys=["entity", "day"], percents=["mom"])
    return match.match_counts(claims(s), found)


# --- corroborated evidence (suppliers' months) -----------------------------
# Articles: each supplier's shipments of the month after, claiming the month's
# revenue to within a relative rounding. Observations: the panel.

CTES["articles"] = """
    SELECT l.l_orderkey * 8 + l.l_linenumber AS record_id, p.entity, p.month, CAST(l_shipdate AS DATE) AS published_date,
      p.revenue + l_orderkey % 900 AS revenue, CASE l_returnflag WHEN 'A' THEN 400 WHEN 'N' THEN 700 ELSE 100 END AS tolerance, l_returnflag AS flag,
      l_shipdate + CAST(l_orderkey % 1440 AS INTEGER) * INTERVAL 1 MINUTE - INTERVAL 8 HOUR AS published_at, l_partkey AS part
    FROM lineitem l JOIN panel p ON p.entity = l.l_suppkey AND p.month = CAST(date_trunc('month', l_shipdate) - INTERVAL 1 MONTH AS DATE)"""


def articles(s):
    shipped = F.col("l_shipdate").cast("date")
    tolerance = F.when(F.col("l_returnflag") == "A", 400).when(F.col("l_returnflag") == "N", 700).otherwise(100)
    rows = s.table("lineitem").select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("record_id"),
        F.col("l_suppkey").alias("entity"),
        F.add_months(F.trunc(shipped, "MM"), -1).alias("month"),
        shipped.alias("published_date"),
        F.col("l_orderkey"),
        tolerance.cast("long").alias("tolerance"),
        (
            F.col("l_shipdate").cast("timestamp")
            + F.make_dt_interval(mins=(F.col("l_orderkey") % 1440).cast("int"))
            - F.expr("interval 8 hours")
        ).alias("published_at"),
        F.col("l_partkey").alias("part"),
    )
    claimed = rows.join(s.panel, ["entity", "month"])
    return claimed.withColumn("revenue", F.col("revenue") + F.col("l_orderkey") % 900).drop("l_orderkey")


def panel_observations(s):
    return s.panel.withColumns({"obs_id": F.col("entity"), "is_current": F.lit(True)})


CTES["confirmed"] = """
    SELECT a.* FROM articles a JOIN panel p USING (entity, month)
    WHERE abs(p.revenue - a.revenue) <= a.tolerance
      AND date_diff('day', CAST(last_day(a.month) AS DATE), published_date) BETWEEN 0 AND 45"""


@query(
    "corroborated_articles",
    f"SELECT record_id, part, entity, {sql_ym('month')} AS month, {sql_stamp('published_at')} AS published_at, revenue FROM confirmed",
)
def corroborated_articles(s):
    found = _corroborated(s)
    return found.select("record_id", "part", "entity", ym("month"), stamp("published_at"), "revenue")


def _corroborated(s):
    return match.corroborate(articles(s), panel_observations(s))


def _described(s):
    found = _corroborated(s)
    return found.withColumns(
        {
            "published_time": F.date_format(F.col("published_at") + F.expr("interval 8 hours"), "HH:mm:ss"),
            "source_url": F.lit("u"),
            "source_title": F.lit("t"),
        }
    )


@query(
    "evidence_dates",
    f"""SELECT entity, {sql_ym('month')} AS month, {sql_stamp('min(published_at)')} AS reported_at, 'cnyes_revenue_news' AS basis,
      4 AS source_priority FROM confirmed GROUP BY 1, 2""",
)
def evidence_dates(s):
    rows = match.evidence_dates(_described(s), "cnyes_revenue_news", NOW)
    return rows.select("entity", ym("month"), stamp("reported_at"), "basis", "source_priority")


@query(
    "evidence_rows",
    f"""SELECT record_id, {sql_stamp('min(published_at)')} AS published_at, 0 AS exact FROM confirmed GROUP BY 1""",
)
def evidence_rows(s):
    return match.evidence_rows(_described(s), "cnyes_revenue_news", False, NOW).select(
        "record_id", stamp("published_at"), "exact"
    )


@query(
    "evidence_pipeline",
    f"""SELECT entity, {sql_ym('month')} AS month, basis, source_priority, {sql_stamp('reported_at')} AS reported_at FROM (
      SELECT *, row_number() OVER (PARTITION BY entity, month ORDER BY source_priority, coalesce(reported_at, TIMESTAMP '9999-12-31'), fresh) AS rn FROM (
        SELECT entity, month, basis, source_priority, reported_at, 0 AS fresh FROM report_dates
        UNION ALL SELECT entity, month, 'moneydj_revenue_news', 4, min(published_at), 1 FROM confirmed GROUP BY 1, 2)) WHERE rn = 1
      QUALIFY row_number() OVER (PARTITION BY entity ORDER BY month DESC) <= 12""",
)
def evidence_pipeline(s):
    """Corroborated articles to report dates: match, earliest, priority, retention."""
    incoming = match.evidence_dates(_described(s), "moneydj_revenue_news", NOW)
    solved = maintain.next_rows(maintain.priority_upsert(s.report_dates, incoming))
    return maintain.trim_dates(solved).select("entity", ym("month"), "basis", "source_priority", stamp("reported_at"))


@query(
    "earliest_evidence",
    f"""SELECT record_id, basis, {sql_stamp('min(published_at)')} AS published_at FROM (
      SELECT record_id % 1000 AS record_id, kind AS basis, published_at FROM records
      UNION ALL SELECT record_id % 1000, kind, published_at - INTERVAL 1 DAY FROM records WHERE kind = 'click') GROUP BY 1, 2""",
)
def earliest_evidence(s):
    """Two overlapping windows of one source; re-used ids keep the earliest."""
    one = s.records.select((F.col("record_id") % 1000).alias("record_id"), F.col("kind").alias("basis"), "published_at", "entity")
    other = one.where("basis = 'click'").withColumn("published_at", F.col("published_at") - F.expr("interval 1 day"))
    return maintain.earliest_evidence(one, other).select("record_id", "basis", stamp("published_at"))


# --- names -----------------------------------------------------------------


CTES["part_names"] = r"""
    SELECT lower(regexp_replace(p_name, '\s+', '', 'g')) AS name_key, CAST(p_partkey AS VARCHAR) AS ticker, p_size, p_brand, p_partkey FROM part"""


def _names(s):
    return s.table("part").select(
        name_key(F.concat("p_name", F.lit(" ")), fold=False).alias("name_key"),
        F.col("p_partkey").cast("string").alias("ticker"),
        F.col("p_size").alias("month"),
        F.col("p_brand").alias("priority"),
        F.col("p_partkey").alias("row_no"),
        F.col("p_type").alias("kind"),
    )


def _brand_records(s):
    """Part names as written in listings: full-width letters, other spacing."""
    wide = F.concat(F.lit("　"), F.upper(F.replace("p_name", F.lit(" "), F.lit("  "))))
    return s.table("part").select(F.col("p_partkey").alias("record_id"), name_key(wide).alias("name_key"))


@query("name_map", "SELECT name_key, arg_min(ticker, (p_size, p_brand, p_partkey)) AS ticker FROM part_names GROUP BY 1")
def name_map(s):
    return match.name_map(_names(s))


@query(
    "mapped_names",
    """SELECT n.p_partkey AS record_id, m.ticker FROM part_names n JOIN (SELECT name_key, arg_min(ticker, (p_size, p_brand, p_partkey)) AS ticker
      FROM part_names GROUP BY 1) m USING (name_key)""",
)
def mapped_names(s):
    return match.map_names(_brand_records(s), _names(s)).select("record_id", "ticker")


@query(
    "unmapped_names",
    "SELECT p_partkey AS record_id FROM part_names WHERE name_key NOT IN (SELECT name_key FROM part_names JOIN part USING (p_partkey) WHERE p_type = 'ECONOMY' AND part.p_size = 11)",
)
def unmapped_names(s):
    known = _names(s).where("kind = 'ECONOMY' AND month = 11")
    return match.unmapped_names(_brand_records(s), known).select("record_id")


# --- picking ---------------------------------------------------------------


@query(
    "earliest_records",
    f"SELECT entity, kind, {sql_day('day')} AS day, arg_min(record_id, (published_at, record_id)) AS record_id FROM records GROUP BY 1, 2, 3",
)
def earliest_records(s):
    rows = pick.earliest(s.records, ["entity", "kind", "day"], "published_at", "record_id")
    return rows.select("entity", "kind", day("day"), "record_id")


@query("last_values", f"SELECT entity, {sql_day('day')} AS day, arg_max(revenue, record_id) AS revenue FROM records GROUP BY 1, 2")
def last_values(s):
    return pick.last_wins(s.records, ["entity", "day"], "record_id").select("entity", day("day"), "revenue")


@query(
    "market_pick",
    """SELECT l_orderkey AS ticker, arg_min(l_partkey, (CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END, l_linenumber, l_partkey, l_suppkey)) AS part
    FROM lineitem GROUP BY 1""",
)
def market_pick(s):
    market = F.when(F.col("l_returnflag") == "A", "sii").when(F.col("l_returnflag") == "N", "otc").otherwise("rotc")
    rows = s.table("lineitem").select(
        F.col("l_orderkey").alias("ticker"),
        market.alias("market"),
        F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("row_no"),
        F.col("l_partkey").alias("part"),
    )
    return pick.pick_market(rows, keys=["ticker"]).select("ticker", "part")


@query(
    "ranked_orders",
    "SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders",
)
def ranked_orders(s):
    """Exact rank over a whole table, without a single-task window."""
    rows = s.table("orders").select("o_orderkey", "o_totalprice")
    return pick.global_rank(rows, [F.desc("o_totalprice"), F.asc("o_orderkey")]).drop("o_totalprice")
