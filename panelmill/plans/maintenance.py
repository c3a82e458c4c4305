"""Queries: versioned facts, priority upserts, promotions, registries."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.months import month_index
from ..functions.text import pending_note, row_hash, text_hash
from ..operators import maintain, pick, quality, views
from .forecasts import announcements, everyone, schedule
from .registry import query
from .star import BASES, CTES, NOW, TARGET, day, sql_day, sql_stamp, sql_ym, stamp, ym
from ..operators import forecast

# --- versioned facts -------------------------------------------------------
# Stored: lines 1-4 of each order as versions. Incoming: the last line of orders
# with a low key share, else the first line; a third of them print a decimal.

_HASH = """sha256('["' || CAST(obs_id AS VARCHAR) || '","' || {money} || '","' || CAST(quantity AS VARCHAR) || '",' ||
      CASE WHEN note IS NULL THEN 'null' ELSE '"' || note || '"' END || ']')"""
CTES["v_cur"] = f"""
    SELECT entity, obs_id AS version, revenue, quantity, note, corrected,
      obs_id = max(obs_id) OVER (PARTITION BY entity) AS is_current, supplier_id AS file_id,
      {_HASH.format(money="CAST(revenue AS VARCHAR)")} AS row_hash
    FROM (SELECT *, max(obs_id) OVER (PARTITION BY entity) AS last FROM obs) WHERE entity % 2 = 1 OR obs_id < last"""
CTES["v_inc"] = f"""
    SELECT entity, revenue, quantity, note, corrected, supplier_id AS file_id,
      {_HASH.format(money="CAST(revenue AS VARCHAR) || CASE WHEN entity % 3 = 0 THEN '.0' ELSE '' END")} AS row_hash
    FROM (SELECT *, row_number() OVER (PARTITION BY entity ORDER BY CASE WHEN entity % 2 = 1 THEN obs_id ELSE -obs_id END) AS rn FROM obs)
    WHERE rn = 1"""
CTES["v_changed"] = """
    SELECT i.*, h.entity IS NOT NULL AS restated, coalesce(t.top, 0) AS top
    FROM v_inc i LEFT JOIN (SELECT * FROM v_cur WHERE is_current) h ON h.entity = i.entity
    LEFT JOIN (SELECT entity, max(version) AS top FROM v_cur GROUP BY 1) t ON t.entity = i.entity
    WHERE h.entity IS NULL OR NOT (h.row_hash = i.row_hash OR (h.revenue = i.revenue AND h.quantity = i.quantity
      AND h.note IS NOT DISTINCT FROM i.note))"""
CTES["v_next"] = """
    SELECT c.entity, c.version, c.revenue, c.quantity, c.note,
      CASE WHEN n.row_hash = c.row_hash THEN TRUE WHEN n.entity IS NOT NULL THEN FALSE ELSE c.is_current END AS is_current,
      CASE WHEN n.row_hash = c.row_hash THEN n.file_id ELSE c.file_id END AS file_id,
      CASE WHEN n.row_hash = c.row_hash THEN n.corrected ELSE c.corrected END AS corrected,
      CASE WHEN n.row_hash = c.row_hash THEN 'reactivate' WHEN n.entity IS NOT NULL AND c.is_current THEN 'deactivate' ELSE 'keep' END AS action,
      CASE WHEN n.row_hash = c.row_hash THEN n.restated ELSE FALSE END AS restated
    FROM v_cur c LEFT JOIN v_changed n USING (entity)
    UNION ALL
    SELECT n.entity, n.top + 1, n.revenue, n.quantity, n.note, TRUE, n.file_id, n.corrected, 'insert', n.restated
    FROM v_changed n WHERE NOT EXISTS (SELECT 1 FROM v_cur c WHERE c.entity = n.entity AND c.row_hash = n.row_hash)"""


def stored_facts(s):
    """All lines of odd orders, which come again with their first; of even ones all but the last, which comes anew."""
    every, entity = s.observations.drop("is_current"), W.partitionBy("entity")
    rows = every.withColumn("_last", F.max("obs_id").over(entity)).where("entity % 2 = 1 OR obs_id < _last")
    rows = rows.withColumn("_top", F.max("obs_id").over(entity))
    old = F.lit("2000-01-01 00:00:00").cast("timestamp")
    return rows.select(
        "entity",
        F.col("obs_id").alias("version"),
        "revenue",
        "quantity",
        "note",
        "corrected",
        (F.col("obs_id") == F.col("_top")).alias("is_current"),
        F.col("supplier").alias("file_id"),
        row_hash("obs_id", "revenue", "quantity", "note").alias("row_hash"),
        old.alias("publication_timestamp"),
        F.lit("MOPS_ARCHIVE_FIRST_OBSERVED").alias("publication_basis"),
        old.alias("first_observed_at"),
        old.alias("last_observed_at"),
    )


def incoming_facts(s):
    first = F.when(F.col("entity") % 2 == 1, F.col("obs_id")).otherwise(-F.col("obs_id"))
    rows = pick.top_per_key(s.observations.drop("is_current"), ["entity"], [first.asc()])
    money = F.concat(F.col("revenue").cast("string"), F.when(F.col("entity") % 3 == 0, ".0").otherwise(""))
    return rows.select(
        "entity",
        "revenue",
        "quantity",
        "note",
        "corrected",
        F.col("supplier").alias("file_id"),
        row_hash("obs_id", money, "quantity", "note").alias("row_hash"),
    )


def applied_facts(s):
    """Both sides are stored tables in use, and read several times."""
    return maintain.apply_facts(
        pick.stored(stored_facts(s)), pick.stored(incoming_facts(s)), ["entity"], ["revenue", "quantity", "note"], NOW
    )


_FACT_COLUMNS = "entity, version, revenue, quantity, note, is_current, file_id, corrected, action, restated"


@query(
    "versioned_facts",
    f"""SELECT {_FACT_COLUMNS},
      CASE WHEN action IN ('insert', 'reactivate') THEN '{NOW}' ELSE '2000-01-01 00:00:00' END AS publication_timestamp FROM v_next""",
)
def versioned_facts(s):
    return applied_facts(s).select(*_FACT_COLUMNS.split(", "), stamp("publication_timestamp"))


@query(
    "version_counts",
    """SELECT count(*) FILTER (WHERE action IN ('insert', 'reactivate')) AS inserted,
      count(*) FILTER (WHERE action IN ('insert', 'reactivate') AND restated) AS restatements FROM v_next""",
)
def version_counts(s):
    return maintain.version_counts(applied_facts(s))


@query("first_seen_keys", f"SELECT DISTINCT entity, '{NOW}' AS first_seen FROM v_next WHERE action <> 'keep'")
def first_seen_keys(s):
    return maintain.first_seen(applied_facts(s), NOW, ["entity"]).withColumn("first_seen", stamp("first_seen"))


@query("run_counters", """SELECT 'facts' AS "table", action, count(*) AS "rows" FROM v_next WHERE action <> 'keep' GROUP BY 2""")
def run_counters(s):
    return maintain.run_counters({"facts": applied_facts(s)})


@query(
    "source_files",
    f"""SELECT {sql_ym('month')} AS month, market, source_hash, version, is_current, action FROM (
      SELECT c.month, c.market, c.source_hash, c.version,
        CASE WHEN p.source_hash = c.source_hash THEN TRUE WHEN p.month IS NOT NULL AND hc.source_hash IS DISTINCT FROM p.source_hash THEN FALSE ELSE c.is_current END AS is_current,
        CASE WHEN hc.source_hash = p.source_hash THEN 'keep' WHEN p.source_hash = c.source_hash THEN 'reactivate'
          WHEN p.month IS NOT NULL AND c.is_current THEN 'deactivate' ELSE 'keep' END AS action
      FROM f_cur c LEFT JOIN f_inc p USING (month, market)
      LEFT JOIN (SELECT * FROM f_cur WHERE is_current) hc ON hc.month = c.month AND hc.market = c.market
      UNION ALL
      SELECT p.month, p.market, p.source_hash, coalesce((SELECT max(version) FROM f_cur c WHERE c.month = p.month AND c.market = p.market), 0) + 1, TRUE, 'insert'
      FROM f_inc p WHERE NOT EXISTS (SELECT 1 FROM f_cur c WHERE c.month = p.month AND c.market = p.market AND c.source_hash = p.source_hash))""",
)
def source_files(s):
    """Per order month and priority: statuses seen so far are stored file versions."""
    o = s.table("orders").select(
        F.trunc(F.col("o_orderdate").cast("date"), "MM").alias("month"),
        F.col("o_orderpriority").alias("market"),
        F.col("o_orderstatus").alias("source_hash"),
        "o_orderkey",
        F.dayofmonth("o_orderdate").alias("d"),
    )
    seen = o.where("d <= 15").groupBy("month", "market", "source_hash").agg(F.min("o_orderkey").alias("k"))
    # At most three statuses per month and market meet in this window.
    w = W.partitionBy("month", "market").orderBy("k")
    files = seen.withColumn("version", F.row_number().over(w)).drop("k")
    last = F.max("version").over(W.partitionBy("month", "market"))
    files = files.withColumn("is_current", F.col("version") == last)
    payloads = o.groupBy("month", "market").agg(F.max_by("source_hash", "o_orderkey").alias("source_hash"))
    return maintain.apply_files(files, payloads).drop("restated").withColumn("month", ym("month"))


CTES["f_cur"] = """
    SELECT *, version = max(version) OVER (PARTITION BY month, market) AS is_current FROM (
      SELECT month, market, source_hash, CAST(row_number() OVER (PARTITION BY month, market ORDER BY k) AS INTEGER) AS version
      FROM (SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_orderpriority AS market, o_orderstatus AS source_hash,
              min(o_orderkey) AS k FROM orders WHERE day(o_orderdate) <= 15 GROUP BY 1, 2, 3))"""
CTES["f_inc"] = """
    SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS month, o_orderpriority AS market,
      arg_max(o_orderstatus, o_orderkey) AS source_hash FROM orders GROUP BY 1, 2"""


@query(
    "changed_payloads",
    """SELECT file_id, count(*) AS lines FROM (SELECT DISTINCT s_suppkey AS file_id FROM supplier)
    JOIN lineitem ON l_suppkey = file_id
    WHERE file_id IN (SELECT file_id FROM v_next WHERE action IN ('insert', 'reactivate')) GROUP BY 1""",
)
def changed_payloads(s):
    payloads = s.table("lineitem").groupBy(F.col("l_suppkey").alias("file_id")).agg(F.count("*").alias("lines"))
    return maintain.changed_payloads(payloads, applied_facts(s))


# --- report dates ----------------------------------------------------------
# Stored: the report dates whose basis is not a company release. Incoming, in
# this order: last shipments of the month, then first ones, under other bases.

_BASIS_SQL = "[" + ", ".join(f"'{b}'" for b in BASES) + "]"


def _incoming_sql(shift: int, agg: str, seq: int) -> str:
    return f"""
    SELECT entity, month, {agg} AS reported_date, {_BASIS_SQL}[CAST((entity + idx + {shift}) % 7 + 1 AS INTEGER)] AS basis,
      CASE WHEN (entity + idx) % 5 <> 0 THEN CAST({agg} AS TIMESTAMP) + INTERVAL {seq} HOUR END AS reported_at, {seq} AS seq
    FROM (SELECT *, year(month)*12+month(month)-1 AS idx FROM (
      SELECT l_suppkey AS entity, CAST(date_trunc('month', l_shipdate) - INTERVAL 1 MONTH AS DATE) AS month,
        CAST(min(l_shipdate) AS DATE) AS lo, CAST(max(l_shipdate) AS DATE) AS hi FROM lineitem GROUP BY 1, 2))"""


_PRIO = """CASE WHEN basis IN ('mops_current_feed','mops_revenue_announcement') THEN 1
      WHEN basis IN ('mops_first_observed','company_ir_monthly_revenue') THEN 2 WHEN basis = 'ir_calendar_matched' THEN 3 ELSE 4 END"""
CTES["d_cur"] = """
    SELECT entity, month, reported_date, basis, reported_at, source_priority FROM report_dates
    WHERE basis <> 'company_ir_monthly_revenue'"""
CTES["d_inc"] = f"SELECT *, {_PRIO} AS source_priority FROM ({_incoming_sql(2, 'hi', 1)} UNION ALL {_incoming_sql(4, 'lo', 2)})"


def stored_dates(s):
    return s.report_dates.where("basis <> 'company_ir_monthly_revenue'")


def incoming_dates(s):
    from ..functions.labels import basis_priority

    d = F.col("l_shipdate").cast("date")
    base = (
        s.table("lineitem")
        .groupBy(F.col("l_suppkey").alias("entity"), F.add_months(F.trunc(d, "MM"), -1).alias("month"))
        .agg(F.min(d).alias("lo"), F.max(d).alias("hi"))
    )
    mix = F.col("entity") + month_index("month")
    names = F.array(*[F.lit(b) for b in BASES])

    def side(shift, date, seq):
        at = F.col(date).cast("timestamp") + F.make_dt_interval(hours=F.lit(seq))
        return F.struct(
            F.col(date).alias("reported_date"),
            F.element_at(names, ((mix + shift) % 7 + 1).cast("int")).alias("basis"),
            F.when(mix % 5 != 0, at).alias("reported_at"),
            F.lit(seq).alias("seq"),
        )

    rows = base.select("entity", "month", F.explode(F.array(side(2, "hi", 1), side(4, "lo", 2))).alias("_r"))
    return rows.select("entity", "month", "_r.*").withColumns(
        {
            "source_priority": basis_priority("basis"),
            "reported_time": F.lit(None).cast("string"),
            "source_url": F.concat(F.lit("n/"), "basis"),
            "source_subject": F.lit("new"),
            "first_recorded_at": F.lit(NOW).cast("timestamp"),
            "updated_at": F.lit(NOW).cast("timestamp"),
        }
    )


@query(
    "priority_dates",
    f"""SELECT entity, {sql_ym('month')} AS month, {sql_day('reported_date')} AS reported_date, basis, source_priority,
      {sql_stamp('reported_at')} AS reported_at,
      CASE WHEN seq = 0 THEN 'keep' WHEN had THEN 'update' ELSE 'insert' END AS action,
      CASE WHEN had THEN '2000-01-01 00:00:00' ELSE '{NOW}' END AS first_recorded_at
    FROM (SELECT *, row_number() OVER (PARTITION BY entity, month ORDER BY source_priority, coalesce(reported_at, TIMESTAMP '9999-12-31'), seq) AS rn,
            bool_or(seq = 0) OVER (PARTITION BY entity, month) AS had
          FROM (SELECT entity, month, reported_date, basis, reported_at, source_priority, 0 AS seq FROM d_cur
                UNION ALL SELECT entity, month, reported_date, basis, reported_at, source_priority, seq FROM d_inc)) WHERE rn = 1""",
)
def priority_dates(s):
    solved = maintain.priority_upsert(stored_dates(s), incoming_dates(s), seq=["seq"])
    return solved.select(
        "entity", ym("month"), day("reported_date"), "basis", "source_priority", stamp("reported_at"), "action",
        stamp("first_recorded_at"),
    )


@query(
    "company_release_dates",
    f"""SELECT entity, {sql_ym('month')} AS month, coalesce({sql_day('CASE WHEN take THEN i.reported_date ELSE c.reported_date END')}) AS reported_date,
      CASE WHEN take THEN i.basis ELSE c.basis END AS basis,
      CASE WHEN c.basis IS NULL THEN 'insert' WHEN take THEN 'update' ELSE 'keep' END AS action
    FROM (SELECT coalesce(c.entity, i.entity) AS entity, coalesce(c.month, i.month) AS month, c, i,
            coalesce(c.entity IS NULL OR (i.entity IS NOT NULL AND (2 < c.source_priority OR (c.source_priority = 2
              AND c.basis NOT IN ('mops_current_feed', 'mops_revenue_announcement')))), FALSE) AS take
          FROM d_cur c FULL JOIN (SELECT entity, month, reported_date, 'company_ir_monthly_revenue' AS basis FROM d_inc WHERE seq = 1) i
            ON c.entity = i.entity AND c.month = i.month)""",
)
def company_release_dates(s):
    releases = incoming_dates(s).where("seq = 1").withColumns(
        {"basis": F.lit("company_ir_monthly_revenue"), "source_priority": F.lit(2)}
    )
    solved = maintain.company_release_upsert(stored_dates(s), releases)
    return solved.select("entity", ym("month"), day("reported_date"), "basis", "action")


@query(
    "migrated_dates",
    f"""SELECT entity, {sql_ym('month')} AS month, basis, CASE basis WHEN 'mops_revenue_announcement' THEN 1
      WHEN 'mops_first_observed' THEN 2 ELSE 3 END AS source_priority FROM report_dates""",
)
def migrated_dates(s):
    return maintain.migrate_dates(s.report_dates).select("entity", ym("month"), "basis", "source_priority")


@query(
    "backfilled_dates",
    f"""SELECT entity, {sql_ym('month')} AS month, {sql_day('reported_date')} AS reported_date, basis, source_priority FROM (
      SELECT *, row_number() OVER (PARTITION BY entity, month ORDER BY source_priority) AS rn FROM (
        SELECT a.entity, a.month, announced_date AS reported_date, 'ir_calendar_matched' AS basis, 3 AS source_priority
        FROM (SELECT entity, CAST(month - INTERVAL 2 MONTH AS DATE) AS month, announced_date FROM announcements) a JOIN facts f ON f.entity = a.entity AND f.month = a.month
        UNION ALL SELECT entity, month, actual_date, 'mops_first_observed', 2 FROM schedule WHERE actual_date IS NOT NULL)) WHERE rn = 1""",
)
def backfilled_dates(s):
    """Announcements moved back two months, so that some of their months have facts."""
    moved = announcements(s).withColumn("month", F.add_months("month", -2))
    return maintain.backfill_dates(moved, schedule(s), s.facts).select(
        "entity", ym("month"), day("reported_date"), "basis", "source_priority"
    )


@query(
    "seeded_dates",
    f"""SELECT entity, {sql_ym('month')} AS month, {sql_day('reported_date')} AS reported_date, reported_time,
      {sql_stamp('reported_at')} AS reported_at, 'mops_revenue_announcement' AS basis
    FROM report_dates WHERE EXISTS (SELECT 1 FROM facts f WHERE f.entity = report_dates.entity AND f.month = report_dates.month)""",
)
def seeded_dates(s):
    seeds = s.report_dates.select(
        F.col("entity").cast("string").alias("ticker"), "month", "reported_date", "reported_time",
        F.lit("seed").alias("subject"),
    )
    return maintain.seed_dates(seeds, s.dim, s.facts).select(
        "entity", ym("month"), day("reported_date"), "reported_time", stamp("reported_at"), "basis"
    )


# --- timestamp promotion ---------------------------------------------------


def stamped_observations(s):
    """Observations with an old archive stamp, a proxy stamp, or none."""
    proxy = "CNYES_PUBLICATION_CORROBORATED_PROXY"
    basis = F.when(F.col("flag") == "A", "MOPS_ARCHIVE_HTTP_LAST_MODIFIED_CURRENT_VERSION").when(
        F.col("flag") == "R", proxy
    )
    return s.observations.select(
        "entity",
        "obs_id",
        "revenue",
        "is_current",
        "corrected",
        F.when(basis.isNotNull(), F.col("shipped").cast("timestamp")).alias("publication_timestamp"),
        basis.alias("publication_basis"),
    )


CTES["st_obs"] = """
    SELECT entity, obs_id, is_current, corrected, versions,
      CASE flag WHEN 'A' THEN 'MOPS_ARCHIVE_HTTP_LAST_MODIFIED_CURRENT_VERSION' WHEN 'R' THEN 'CNYES_PUBLICATION_CORROBORATED_PROXY' END AS pb,
      CASE WHEN flag IN ('A', 'R') THEN CAST(shipped AS TIMESTAMP) END AS pt FROM obs"""
_EXACT_CASE = """CASE basis WHEN 'mops_current_feed' THEN 'MOPS_CURRENT_REPORT_FEED_EXACT'
      WHEN 'mops_revenue_announcement' THEN 'MOPS_MATERIAL_ANNOUNCEMENT_EXACT' WHEN 'company_ir_monthly_revenue' THEN 'COMPANY_IR_MONTHLY_REVENUE_EXACT' END"""


def _promoted(rows):
    return rows.select("entity", "obs_id", stamp("publication_timestamp"), "publication_basis", "action")


@query(
    "promoted_exact",
    f"""SELECT entity, obs_id, {sql_stamp('CASE WHEN take THEN reported_at ELSE pt END')} AS publication_timestamp,
      CASE WHEN take THEN nb ELSE pb END AS publication_basis, CASE WHEN take THEN 'update' ELSE 'keep' END AS action
    FROM (SELECT o.*, d.reported_at, {_EXACT_CASE} AS nb, coalesce(is_current AND NOT corrected AND versions = 1
        AND basis IN ('mops_current_feed','mops_revenue_announcement','company_ir_monthly_revenue') AND d.reported_at IS NOT NULL, FALSE) AS take
      FROM st_obs o LEFT JOIN order_dates d USING (entity))""",
)
def promoted_exact(s):
    return _promoted(maintain.promote_exact(stamped_observations(s), s.order_dates, ["entity"]))


@query(
    "promoted_proxy",
    f"""SELECT entity, obs_id, {sql_stamp('CASE WHEN take THEN reported_at ELSE pt END')} AS publication_timestamp,
      CASE WHEN take THEN 'CNYES_PUBLICATION_CORROBORATED_PROXY' ELSE pb END AS publication_basis,
      CASE WHEN take THEN 'update' ELSE 'keep' END AS action
    FROM (SELECT o.*, d.reported_at, coalesce(is_current AND d.entity IS NOT NULL AND (pb IS NULL
        OR pb = 'MOPS_ARCHIVE_HTTP_LAST_MODIFIED_CURRENT_VERSION' OR pt > d.reported_at), FALSE) AS take
      FROM st_obs o LEFT JOIN (SELECT * FROM order_dates WHERE basis = 'cnyes_revenue_news' AND reported_at IS NOT NULL) d USING (entity))""",
)
def promoted_proxy(s):
    rows = stamped_observations(s)
    dates = s.order_dates.where("basis = 'cnyes_revenue_news' AND reported_at IS NOT NULL").join(
        rows.where("is_current").select("entity", "obs_id", "is_current"), "entity"
    )
    return _promoted(maintain.promote_proxy(rows, dates, ["entity"]))


@query(
    "promoted_company",
    f"""SELECT entity, obs_id, {sql_stamp('CASE WHEN take THEN o_orderdate ELSE pt END')} AS publication_timestamp,
      CASE WHEN take THEN 'COMPANY_IR_MONTHLY_REVENUE_EXACT' ELSE pb END AS publication_basis,
      CASE WHEN take THEN 'update' ELSE 'keep' END AS action
    FROM (SELECT *, coalesce(is_current AND NOT corrected AND versions = 1 AND pb IS NOT NULL, FALSE) AS take
      FROM st_obs JOIN orders ON o_orderkey = entity)""",
)
def promoted_company(s):
    rows = stamped_observations(s)
    released = s.table("orders").select(
        F.col("o_orderkey").alias("entity"), F.col("o_orderdate").cast("timestamp").alias("published_at")
    )
    matched = rows.where("is_current").select("entity", "obs_id").join(released, "entity")
    return _promoted(maintain.promote_company(rows, matched, ["entity"]))


@query(
    "exact_promotions",
    f"""SELECT entity, obs_id, {sql_stamp('reported_at')} AS new_timestamp, {_EXACT_CASE} AS new_basis
    FROM st_obs JOIN order_dates USING (entity) WHERE is_current AND NOT corrected AND versions = 1 AND reported_at IS NOT NULL
      AND basis IN ('mops_current_feed','mops_revenue_announcement','company_ir_monthly_revenue')""",
)
def exact_promotions(s):
    rows = views.exact_promotions(stamped_observations(s), s.order_dates, ["entity"])
    return rows.select("entity", "obs_id", stamp("new_timestamp"), "new_basis")


# --- versions as tables ----------------------------------------------------


@query(
    "current_facts",
    "SELECT entity, obs_id, revenue, versions, versions > 1 OR corrected AS restated FROM obs WHERE is_current",
)
def current_facts(s):
    return views.current_rows(s.observations, ["entity"]).select("entity", "obs_id", "revenue", "versions", "restated")


@query("never_restated", "SELECT entity, obs_id, revenue FROM obs WHERE versions = 1 AND NOT corrected")
def never_restated(s):
    return views.never_restated(s.observations, ["entity"]).select("entity", "obs_id", "revenue")


@query(
    "monthly_revenue_view",
    """SELECT o.entity, o.revenue, o.versions > 1 OR o.corrected AS restated, c_name AS name, s_name AS file_name, r.r_name AS english
    FROM obs o JOIN orders ON o_orderkey = o.entity JOIN customer ON c_custkey = o_custkey JOIN supplier ON s_suppkey = o.supplier_id
    LEFT JOIN (SELECT substr(r_name, 1, 1) AS n, min(r_name) AS r_name FROM region GROUP BY 1) r ON r.n = o.note
    WHERE o.is_current""",
)
def monthly_revenue_view(s):
    companies = s.table("orders").join(s.table("customer"), F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("entity"), F.col("c_name").alias("name")
    )
    files = s.table("supplier").select(F.col("s_suppkey").alias("file_id"), F.col("s_name").alias("file_name"))
    notes = s.table("region").groupBy(F.substring("r_name", 1, 1).alias("note_hash")).agg(F.min("r_name").alias("english"))
    rows = s.observations.withColumnsRenamed({"supplier": "file_id", "note": "note_hash"})
    return views.monthly_revenue(rows, companies, files, notes, ["entity"]).select(
        "entity", "revenue", "restated", "name", "file_name", "english"
    )


@query(
    "latest_attributes",
    """SELECT o_orderkey AS entity, coalesce(note, 'none') AS note FROM orders
    LEFT JOIN (SELECT entity, arg_max(note, obs_id) AS note FROM obs WHERE note IS NOT NULL GROUP BY 1) ON entity = o_orderkey""",
)
def latest_attributes(s):
    dim = s.table("orders").select(F.col("o_orderkey").alias("entity"))
    return views.latest_attribute(dim, s.observations, "note", "none", order=("obs_id",))


@query(
    "universe_rows",
    f"SELECT entity, {sql_ym('month')} AS month, revenue FROM panel WHERE month = DATE '{TARGET}' AND entity IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)",
)
def universe_rows(s):
    dim = s.table("customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("entity"))
    return views.restrict_universe(s.panel, dim, TARGET).select("entity", ym("month"), "revenue")


@query(
    "dates_with_facts",
    f"""SELECT entity, {sql_ym('month')} AS month, basis FROM report_dates d
    WHERE EXISTS (SELECT 1 FROM panel p WHERE p.entity = d.entity AND p.month = d.month)""",
)
def dates_with_facts(s):
    return views.with_facts(s.report_dates, s.panel).select("entity", ym("month"), "basis")


@query(
    "universe_difference",
    """SELECT CAST(s_suppkey AS VARCHAR) AS ticker, 'universe' AS missing_from FROM supplier WHERE s_suppkey NOT IN (SELECT l_suppkey FROM lineitem WHERE l_quantity = 50 AND l_discount = 0.1)
    UNION ALL SELECT DISTINCT CAST(l_suppkey AS VARCHAR), 'dimension' FROM lineitem
    WHERE l_quantity = 50 AND l_discount = 0.1 AND l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)
    EXCEPT SELECT CAST(s_suppkey AS VARCHAR), 'universe' FROM supplier WHERE s_acctbal <= 0""",
)
def universe_difference(s):
    universe = s.table("lineitem").where("l_quantity = 50 AND l_discount = 0.1").select(F.col("l_suppkey").cast("string").alias("ticker"))
    dim = s.table("supplier").where("s_acctbal > 0").select(F.col("s_suppkey").cast("string").alias("ticker"))
    return views.universe_difference(universe, dim)


@query(
    "missing_months",
    f"SELECT DISTINCT {sql_ym('month')} AS month FROM panel WHERE month NOT IN (SELECT month FROM sparse)",
)
def missing_months(s):
    return views.missing_months(s.panel, s.sparse).select(ym("month"))


# --- rates, evidence, notes ------------------------------------------------


@query(
    "applied_rates",
    f"""SELECT {sql_ym('coalesce(c.month, i.month)')} AS month,
      CASE WHEN i.month IS NULL THEN c.average_rate ELSE i.average_rate END AS average_rate,
      CASE WHEN c.month IS NULL THEN 'insert' WHEN i.month IS NULL THEN 'keep'
        WHEN (c.average_rate, c.observations, c.first_date, c.last_date) IS DISTINCT FROM (i.average_rate, i.observations, i.first_date, i.last_date) THEN 'update'
        ELSE 'keep' END AS action
    FROM full_rates c FULL JOIN rates i USING (month)""",
)
def applied_rates(s):
    """Order rates over shipment rates; the last shipping months have no new rate."""
    solved = maintain.apply_rates(s.full_rates, maintain.valid_rates(s.rates))
    return solved.select(ym("month"), "average_rate", "action")


@query("reapplied_rates", f"SELECT {sql_ym('month')} AS month, 'keep' AS action FROM rates")
def reapplied_rates(s):
    """The same rates again change nothing."""
    return maintain.apply_rates(s.rates, s.rates).select(ym("month"), "action")


def _evidence(s, shift=0):
    title = F.when(F.col("kind") == "click", F.concat("kind", F.lit(str(shift)))).otherwise(F.col("kind"))
    mom = F.when(F.col("kind") == "error", F.lit(None if shift else 1.0).cast("double")).otherwise(F.col("revenue") / 100)
    return s.records.select(
        F.lit("cnyes_revenue_news").alias("basis"),
        F.col("record_id").cast("string").alias("record_id"),
        "entity",
        "month",
        "published_at",
        F.lit("u").alias("source_url"),
        title.alias("source_title"),
        F.col("revenue").alias("matched_revenue"),
        mom.alias("matched_mom"),
        F.lit(0).alias("exact"),
        F.lit(NOW if shift else "2000-01-01 00:00:00").cast("timestamp").alias("first_recorded_at"),
        F.lit(NOW if shift else "2000-01-01 00:00:00").cast("timestamp").alias("updated_at"),
    )


@query(
    "applied_evidence",
    f"""SELECT CAST(record_id AS VARCHAR) AS record_id, CASE kind WHEN 'signup' THEN 'insert' WHEN 'click' THEN 'update' WHEN 'error' THEN 'update' ELSE 'keep' END AS action,
      CASE kind WHEN 'click' THEN 'click1' ELSE kind END AS source_title,
      CASE kind WHEN 'signup' THEN '{NOW}' ELSE '2000-01-01 00:00:00' END AS first_recorded_at,
      CASE kind WHEN 'error' THEN NULL ELSE CAST(revenue AS DOUBLE) / 100 END AS matched_mom FROM records""",
)
def applied_evidence(s):
    stored = _evidence(s).where("source_title <> 'signup'")
    solved = maintain.apply_evidence(stored, _evidence(s, 1))
    return solved.select("record_id", "action", "source_title", stamp("first_recorded_at"), "matched_mom")


CTES["memo"] = """
    SELECT sha256(text) AS note_hash, CASE min(lang) WHEN 'en' THEN 'complete' ELSE 'pending' END AS status
    FROM documents WHERE source <> 'src1' GROUP BY 1"""


def _memo(s):
    rows = s.table("documents").where("source <> 'src1'").groupBy(text_hash("text").alias("note_hash")).agg(F.min("lang").alias("lang"))
    done = F.col("lang") == "en"
    return rows.select(
        "note_hash",
        F.when(done, "old").otherwise("wait").alias("english"),
        F.when(done, "p").otherwise("placeholder").alias("provider"),
        F.when(done, "complete").otherwise("pending").alias("status"),
    )


@query(
    "note_worklist",
    "SELECT DISTINCT sha256(text) AS note_hash FROM documents WHERE sha256(text) NOT IN (SELECT note_hash FROM memo WHERE status = 'complete')",
)
def note_worklist(s):
    notes = s.table("documents").select(text_hash("text").alias("note_hash"))
    return maintain.memo_worklist(notes, _memo(s))


@query(
    "applied_notes",
    """SELECT coalesce(m.note_hash, f.note_hash) AS note_hash,
      CASE WHEN m.note_hash IS NULL THEN 'insert' WHEN f.note_hash IS NULL THEN 'keep'
        WHEN f.lang <> 'de' THEN 'update' ELSE 'keep' END AS action,
      CASE WHEN m.note_hash IS NULL THEN CASE WHEN f.lang = 'de' THEN 'pending' ELSE 'complete' END WHEN f.note_hash IS NULL OR f.lang = 'de' THEN m.status ELSE 'complete' END AS status
    FROM memo m FULL JOIN (SELECT sha256(text) AS note_hash, min(lang) AS lang FROM documents GROUP BY 1) f ON f.note_hash = m.note_hash""",
)
def applied_notes(s):
    """New translations fail for German texts and work for the rest."""
    rows = s.table("documents").groupBy(text_hash("text").alias("note_hash"), pending_note("text").alias("wait")).agg(F.min("lang").alias("lang"))
    failed = F.col("lang") == "de"
    finished = rows.select(
        "note_hash",
        F.when(failed, F.col("wait")).otherwise("new").alias("english"),
        F.when(failed, "placeholder").otherwise("p").alias("provider"),
        F.when(failed, "pending").otherwise("complete").alias("status"),
    )
    return maintain.apply_memo(_memo(s), finished).select("note_hash", "action", "status")


# --- profiles, schedule, onboarding ----------------------------------------


@query(
    "applied_profiles",
    """SELECT coalesce(c.entity, i.entity) AS entity, i.samples, CASE WHEN c.entity IS NULL THEN 'insert'
      WHEN (c.samples, c.actual_samples, c.ir_samples, c.median_offset, c.median_minute, c.mad_days, c.method, c.confidence, c.as_of_month)
        IS DISTINCT FROM (i.samples, i.actual_samples, i.ir_samples, i.median_offset, i.median_minute, i.mad_days, i.method, i.confidence, i.as_of_month)
      THEN 'update' ELSE 'keep' END AS action FROM early_profiles c FULL JOIN profiles i ON c.entity = i.entity""",
)
def applied_profiles(s):
    history = forecast.release_history(s.report_dates)
    stored = forecast.release_profile(history, before=F.lit(TARGET).cast("date"))
    return maintain.apply_profiles(stored, forecast.release_profile(history)).select("entity", "samples", "action")


@query(
    "reapplied_schedule",
    f"SELECT entity, {sql_ym('month')} AS month, 'keep' AS action FROM schedule",
)
def reapplied_schedule(s):
    """The same schedule evaluated again changes nothing."""
    return maintain.apply_schedule(schedule(s), schedule(s)).select("entity", ym("month"), "action")


@query(
    "onboarded_rows",
    """SELECT i.entity, CASE WHEN c.entity IS NULL THEN 'insert' WHEN c.row_hash = i.row_hash THEN 'skip' ELSE 'conflict' END AS action
    FROM v_inc i LEFT JOIN (SELECT * FROM v_cur WHERE is_current) c ON c.entity = i.entity""",
)
def onboarded_rows(s):
    return maintain.onboard(incoming_facts(s), stored_facts(s).where("is_current"), ["entity"]).select("entity", "action")


@query(
    "refreshed_manifest",
    """SELECT CAST(coalesce(s_suppkey, c_custkey) AS VARCHAR) AS ticker, coalesce(s_name, c_name) AS name,
      coalesce(c_nationkey, s_nationkey) AS row_number,
      CASE WHEN s_suppkey IS NULL THEN 'insert' WHEN c_custkey IS NULL THEN 'keep' ELSE 'renumber' END AS action
    FROM supplier FULL JOIN customer ON c_custkey = s_suppkey""",
)
def refreshed_manifest(s):
    dim = s.table("supplier").select(
        F.col("s_suppkey").cast("string").alias("ticker"), F.col("s_name").alias("name"), F.lit("a").alias("labels"),
        F.col("s_nationkey").alias("row_number"), F.lit(NOW).cast("timestamp").alias("created_at"),
        F.lit(NOW).cast("timestamp").alias("updated_at"),
    )
    universe = s.table("customer").select(
        F.col("c_custkey").cast("string").alias("ticker"), F.col("c_name").alias("name"), F.lit("b").alias("labels"),
        F.col("c_nationkey").alias("row_number"),
    )
    return maintain.refresh_manifest(dim, universe, NOW).select("ticker", "name", "row_number", "action")


# --- source registry -------------------------------------------------------
# One stored source per supplier; polls keep, move, fail or deny them by nation.

_POLL = "s_nationkey % 6"


@query(
    "source_registry",
    """SELECT s_suppkey AS entity, CASE s_nationkey % 6 WHEN 1 THEN 'new/' ELSE 'old/' END || s_name AS source_url,
      CASE s_nationkey % 6 WHEN 0 THEN 'h0' WHEN 5 THEN 'h0' WHEN 2 THEN 'h0' WHEN 3 THEN 'h0' ELSE 'h1' END AS content_hash,
      CASE s_nationkey % 6 WHEN 2 THEN 'broken' END AS last_error_message,
      s_nationkey % 6 IN (1, 4) AS content_changed,
      CASE s_nationkey % 6 WHEN 0 THEN 'keep' ELSE 'update' END AS action FROM supplier
    UNION ALL
    SELECT -1 - c_custkey, 'first/' || c_name, 'h1', NULL, TRUE, 'insert' FROM customer""",
)
def source_registry(s):
    return _applied_sources(s).select(
        "entity", "source_url", "content_hash", "last_error_message", "content_changed", "action"
    )


def _applied_sources(s):
    supplier, customer = s.table("supplier"), s.table("customer")
    kind = F.col("s_nationkey") % 6
    stored = supplier.select(
        F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("source_id"),
        F.col("s_suppkey").alias("entity"),
        F.lit("calendar").alias("source_type"),
        F.concat(F.lit("old/"), "s_name").alias("source_url"),
        F.lit("umc").alias("parser_name"),
        F.lit(1).alias("source_priority"),
        F.lit(True).alias("enabled"),
        F.lit("h0").alias("content_hash"),
        F.lit(None).cast("timestamp").alias("last_success_at"),
        F.when(kind.isin(3, 5), F.lit("2000-01-01 00:00:00").cast("timestamp")).alias("last_error_at"),
        F.when(kind.isin(3, 5), "earlier").alias("last_error_message"),
    )
    shape = lambda df, entity, url, h, error, denied: df.select(
        entity.alias("entity"),
        F.lit("calendar").alias("source_type"),
        url.alias("source_url"),
        F.lit("umc").alias("parser_name"),
        F.lit(1).alias("source_priority"),
        F.lit(True).alias("enabled"),
        denied.alias("unavailable"),
        error.alias("error"),
        h.alias("content_hash"),
    )
    # 0 same content, 1 moved with new content, 2 fails, 3 denied, 4 new content, 5 recovers.
    polls = shape(
        supplier,
        F.col("s_suppkey"),
        F.concat(F.when(kind == 1, "new/").otherwise("old/"), "s_name"),
        F.when(kind.isin(1, 4), "h1").when(kind.isin(0, 5), "h0"),
        F.when(kind == 2, "broken"),
        kind == 3,
    ).unionByName(
        shape(
            customer,
            F.lit(-1) - F.col("c_custkey"),
            F.concat(F.lit("first/"), "c_name"),
            F.lit("h1"),
            F.lit(None).cast("string"),
            F.lit(False),
        )
    )
    return maintain.apply_sources(stored, polls, NOW)


CTES["polled_state"] = """
    SELECT 's' || CAST(entity AS VARCHAR) AS source_id, event_id, entity, month, announced_date, announced_time, is_current,
      sha256('["' || strftime(month, '%Y-%m-%d') || '","' || strftime(announced_date, '%Y-%m-%d') || '",' ||
        CASE WHEN announced_time IS NULL THEN 'null' ELSE '"' || announced_time || '"' END || ']') AS event_hash,
      s_nationkey % 6 IN (1, 4) AS renewed FROM evt JOIN supplier ON s_suppkey = entity"""


@query(
    "source_events",
    """SELECT source_id, event_hash, CASE WHEN renewed THEN live ELSE cur END AS is_current,
      CASE WHEN NOT renewed THEN 'keep' WHEN live THEN CASE WHEN stored THEN 'activate' ELSE 'insert' END
        WHEN cur THEN 'deactivate' ELSE 'keep' END AS action
    FROM (SELECT source_id, event_hash, any_value(renewed) AS renewed, bool_or(is_current AND event_id % 3 <> 0) AS cur,
            bool_or(event_id % 3 <> 0) AS stored, bool_or(event_id % 3 <> 1) AS live FROM polled_state GROUP BY 1, 2)
    WHERE stored OR (renewed AND live)""",
)
def source_events(s):
    """Two thirds of the events are stored, another two thirds are polled."""
    grid = s.events.withColumn("source_id", F.concat(F.lit("s"), F.col("entity").cast("string"))).withColumn(
        "event_hash", row_hash("month", "announced_date", "announced_time")
    )
    at = F.lit("2000-01-01 00:00:00").cast("timestamp")
    one = ["source_id", "event_hash"]
    facts = lambda df: df.groupBy(*one).agg(
        F.first("entity").alias("entity"), F.first("month").alias("month"),
        F.first("announced_date").alias("announced_date"), F.first("announced_time").alias("announced_time"),
        F.bool_or("is_current").alias("is_current"),
    )
    stored = facts(grid.where("event_id % 3 <> 0")).withColumns({"first_detected_at": at, "last_detected_at": at})
    polled = facts(grid.where("event_id % 3 <> 1")).drop("is_current")
    return maintain.apply_events(stored, polled, _applied_sources(s), NOW).select(*one, "is_current", "action")


# --- quality gates ---------------------------------------------------------


@query(
    "foreign_key_gate",
    "SELECT l_orderkey, l_suppkey, l_linenumber, l_partkey FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)",
)
def foreign_key_gate(s):
    parents = s.table("supplier").where("s_acctbal > 0")
    child = s.table("lineitem").select("l_orderkey", "l_suppkey", "l_linenumber", "l_partkey")
    return quality.foreign_key(child, "l_suppkey", parents, "s_suppkey")


@query(
    "duplicate_key_gate",
    """SELECT l_orderkey, l_linenumber, count(*) AS "rows" FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""",
)
def duplicate_key_gate(s):
    return quality.duplicate_keys(s.table("lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "domain_gate",
    """SELECT o_orderkey, CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'status;' ELSE '' END ||
      CASE WHEN o_totalprice NOT BETWEEN 1000 AND 400000 THEN 'price;' ELSE '' END ||
      CASE WHEN NOT regexp_matches(o_orderpriority, '^[1-4]-[A-Z]+$') THEN 'shape;' ELSE '' END AS broken FROM orders
    WHERE o_orderstatus NOT IN ('F', 'O') OR o_totalprice NOT BETWEEN 1000 AND 400000 OR NOT regexp_matches(o_orderpriority, '^[1-4]-[A-Z]+$')""",
)
def domain_gate(s):
    rules = {
        "status;": F.col("o_orderstatus").isin("F", "O"),
        "price;": F.col("o_totalprice").between(1000, 400000),
        "shape;": F.col("o_orderpriority").rlike("^[1-4]-[A-Z]+$"),
    }
    return quality.domain(s.table("orders"), rules).select("o_orderkey", F.array_join("broken", "").alias("broken"))


@query(
    "archive_detail_gate",
    """SELECT o_orderkey AS record_id FROM orders LEFT JOIN (SELECT entity, min(shipped) AS shipped FROM obs GROUP BY 1) ON entity = o_orderkey
    WHERE shipped IS NULL OR date_trunc('month', shipped) <> date_trunc('month', o_orderdate)""",
)
def archive_detail_gate(s):
    month = lambda c: F.trunc(c, "MM").alias("month")
    archive = s.table("orders").select(F.col("o_orderkey").alias("record_id"), month(F.col("o_orderdate").cast("date")))
    detail = s.observations.groupBy(F.col("entity").alias("record_id")).agg(month(F.min("shipped")))
    return quality.archive_detail_mismatch(archive, detail, compare=("month",)).select("record_id")
