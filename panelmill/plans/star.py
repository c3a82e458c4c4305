"""Panel tables derived from the star-schema tables.

``Star`` builds them with Spark; ``CTES`` has the same tables as SQL table
expressions for checking. Money is whole cents (BIGINT), so sums are exact in
any order.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.labels import basis_priority
from ..functions.months import minute_to_time, month_index
from ..operators.groups import build_bridge, primary_class
from ..operators.panel import reported_facts
from ..operators.pick import stored
from ..operators.views import monthly_rates

NOW = "2002-01-20 04:00:00"
TARGET = "2001-10-01"
BASES = (
    "mops_current_feed",
    "mops_first_observed",
    "company_ir_monthly_revenue",
    "ir_calendar_matched",
    "cnyes_revenue_news",
    "moneydj_revenue_news",
    "mops_revenue_announcement",
)


def cents(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("long")


def day(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd").alias(c)


def ym(c: str) -> Column:
    return F.date_format(c, "yyyy-MM").alias(c)


def stamp(c: str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)


class Star:
    """Lazily built frames over one data folder; times are UTC."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        spark.conf.set("spark.sql.session.timeZone", "UTC")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(name))

    @cached_property
    def panel(self) -> DataFrame:
        month = F.trunc(F.col("l_shipdate").cast("date"), "MM")
        return (
            self.table("lineitem")
            .groupBy(F.col("l_suppkey").alias("entity"), month.alias("month"))
            .agg(F.sum(cents("l_extendedprice")).alias("revenue"))
        )

    @cached_property
    def sparse(self) -> DataFrame:
        month = F.trunc(F.col("o_orderdate").cast("date"), "MM")
        return (
            self.table("orders")
            .groupBy(F.col("o_custkey").alias("entity"), month.alias("month"))
            .agg(F.sum(cents("o_totalprice")).alias("revenue"))
        )

    @cached_property
    def facts(self) -> DataFrame:
        return reported_facts(self.panel)

    @cached_property
    def kept_facts(self) -> DataFrame:
        """Facts as a stored table, for queries that read them several times."""
        return stored(self.facts)

    @cached_property
    def kept_months(self) -> DataFrame:
        """(entity, month) of the facts as a stored table."""
        return stored(self.panel.select("entity", "month"))

    @cached_property
    def sparse_facts(self) -> DataFrame:
        return reported_facts(self.sparse)

    @cached_property
    def dim(self) -> DataFrame:
        labels = F.concat("n_name", F.lit("; "), "r_name", F.lit(";"))
        return (
            self.table("supplier")
            .join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.col("s_suppkey").alias("entity"),
                F.col("s_suppkey").cast("string").alias("ticker"),
                F.col("s_name").alias("name"),
                labels.alias("labels"),
            )
        )

    @cached_property
    def customers(self) -> DataFrame:
        return self.table("customer").select(
            F.col("c_custkey").alias("entity"),
            F.col("c_custkey").cast("string").alias("ticker"),
            F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("classification"),
        )

    @cached_property
    def bridge(self) -> DataFrame:
        return build_bridge(self.dim)

    @cached_property
    def classes(self) -> DataFrame:
        nations = self.table("nation").select(F.col("n_name").alias("classification"))
        return nations.union(self.table("region").select("r_name"))

    @cached_property
    def classed(self) -> DataFrame:
        return primary_class(self.dim.drop("labels"), self.bridge)

    @cached_property
    def report_dates(self) -> DataFrame:
        """First shipment in the month after: the release of the month before."""
        shipped = F.col("l_shipdate").cast("date")
        first = (
            self.table("lineitem")
            .groupBy(F.col("l_suppkey").alias("entity"), F.add_months(F.trunc(shipped, "MM"), -1).alias("month"))
            .agg(F.min(shipped).alias("reported_date"))
        )
        mix = F.col("entity") + month_index("month")
        minute = F.when(mix % 7 != 0, (F.col("entity") * 37 + month_index("month") * 11) % 1440)
        names = F.array(*[F.lit(b) for b in BASES])
        dated = first.withColumn("reported_time", minute_to_time(minute)).withColumn(
            "basis", F.element_at(names, (mix % len(BASES) + 1).cast("int"))
        )
        at = F.when(
            F.col("reported_time").isNotNull(),
            F.to_timestamp(F.concat_ws(" ", F.col("reported_date").cast("string"), "reported_time"))
            - F.expr("interval 8 hours"),
        )
        return dated.select(
            "entity",
            "month",
            "reported_date",
            "reported_time",
            at.alias("reported_at"),
            "basis",
            basis_priority("basis").alias("source_priority"),
            F.concat(F.lit("u/"), "basis").alias("source_url"),
            F.lit(None).cast("string").alias("source_subject"),
            F.lit("2000-01-01 00:00:00").cast("timestamp").alias("first_recorded_at"),
            F.lit("2000-01-01 00:00:00").cast("timestamp").alias("updated_at"),
        )

    @cached_property
    def daily(self) -> DataFrame:
        return (
            self.table("orders")
            .groupBy(F.col("o_orderdate").cast("date").alias("date"))
            .agg((F.lit(10) + F.sum("o_orderkey") % 9000 / 100).alias("rate"))
        )

    @cached_property
    def rates(self) -> DataFrame:
        """Monthly rates; the last shipping months have none."""
        return monthly_rates(self.daily)

    @cached_property
    def full_rates(self) -> DataFrame:
        """Monthly rates that cover every shipping month."""
        daily = (
            self.table("lineitem")
            .groupBy(F.col("l_shipdate").cast("date").alias("date"))
            .agg((F.lit(10) + F.sum("l_orderkey") % 9000 / 100).alias("rate"))
        )
        return monthly_rates(daily)

    @cached_property
    def holidays(self) -> DataFrame:
        """Order dates whose keys add up to a multiple of five."""
        return (
            self.table("orders")
            .groupBy(F.col("o_orderdate").cast("date").alias("holiday"))
            .agg((F.sum("o_orderkey") % 5).alias("k"))
            .where("k = 0")
            .select("holiday")
        )

    @cached_property
    def sources(self) -> DataFrame:
        return (
            self.table("supplier")
            .select(F.col("s_suppkey").alias("entity"), F.explode(F.sequence(F.lit(1), F.lit(2))).alias("k"))
            .select(
                (F.col("entity") * 2 + F.col("k")).alias("source_id"),
                "entity",
                F.col("k").alias("source_priority"),
                ((F.col("entity") + F.col("k")) % 4 != 0).alias("enabled"),
            )
        )

    @cached_property
    def events(self) -> DataFrame:
        grid = self.table("supplier").select(
            F.col("s_suppkey").alias("entity"),
            F.explode(F.sequence(F.lit(0), F.lit(5))).alias("g"),
        )
        k, j = F.floor(F.col("g") / 3) + 1, F.col("g") % 3
        grid = grid.select("entity", k.alias("k"), j.alias("j")).withColumn(
            "month", F.add_months(F.lit("2001-12-01").cast("date"), (F.col("j") % 2).cast("int"))
        )
        ahead = ((F.col("entity") * 7 + F.col("k") * 3 + F.col("j")) % 25).cast("int")
        hour = (F.col("entity") % 8 + 9).cast("int")
        time = F.when((F.col("entity") + F.col("j")) % 2 != 0, F.format_string("%02d:30:00", hour))
        return grid.select(
            (F.col("entity") * 10 + F.col("k") * 3 + F.col("j")).alias("event_id"),
            (F.col("entity") * 2 + F.col("k")).alias("source_id"),
            "entity",
            "month",
            F.date_add(F.last_day("month"), ahead).alias("announced_date"),
            time.alias("announced_time"),
            ((F.col("entity") + F.col("k") + F.col("j")) % 5 != 0).alias("is_current"),
        )

    @cached_property
    def observations(self) -> DataFrame:
        """Lines of an order as versions of one fact; the last line is current."""
        # Dealt by order, so the windows by order that follow need no second shuffle.
        lines = (
            self.table("lineitem")
            .repartition("l_orderkey")
            .groupBy(F.col("l_orderkey").alias("entity"), F.col("l_linenumber").cast("long").alias("obs_id"))
            .agg(
                F.sum(cents("l_extendedprice")).alias("revenue"),
                F.sum(F.col("l_quantity").cast("long")).alias("quantity"),
                F.max("l_returnflag").alias("flag"),
                F.min("l_suppkey").alias("supplier"),
                F.min(F.col("l_shipdate").cast("date")).alias("shipped"),
            )
        )
        top = F.max("obs_id").over(W.partitionBy("entity"))
        return lines.select(
            "*",
            F.nullif("flag", F.lit("N")).alias("note"),
            (F.col("revenue") % 10 == 0).alias("corrected"),
            (F.col("obs_id") == top).alias("is_current"),
        )

    @cached_property
    def order_dates(self) -> DataFrame:
        """Report date of every order: the order's own date."""
        basis = (
            F.when(F.col("o_orderpriority") == "1-URGENT", "mops_current_feed")
            .when(F.col("o_orderpriority") == "2-HIGH", "mops_revenue_announcement")
            .when(F.col("o_orderpriority") == "3-MEDIUM", "company_ir_monthly_revenue")
            .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "mops_first_observed")
            .otherwise("cnyes_revenue_news")
        )
        at = F.when(
            F.col("o_orderstatus") != "P",
            F.col("o_orderdate").cast("timestamp")
            + F.make_dt_interval(mins=(F.col("o_orderkey") % 1440).cast("int")),
        )
        return self.table("orders").select(
            F.col("o_orderkey").alias("entity"),
            F.col("o_orderdate").cast("date").alias("reported_date"),
            at.alias("reported_at"),
            basis.alias("basis"),
        )

    @cached_property
    def records(self) -> DataFrame:
        """Events as published records that claim a figure for a user's day."""
        at = F.date_trunc("second", F.col("ts").cast("timestamp"))
        local = at + F.expr("interval 8 hours")
        return self.table("events").select(
            F.col("event_id").alias("record_id"),
            F.col("user_id").alias("entity"),
            F.trunc(at.cast("date"), "MM").alias("month"),
            at.cast("date").alias("day"),
            at.alias("published_at"),
            local.cast("date").alias("published_date"),
            F.date_format(local, "HH:mm:ss").alias("published_time"),
            F.col("event_type").alias("kind"),
            cents("value").alias("revenue"),
        )


def jr(x: str, n: int = 2) -> str:
    """SQL: round half up to n digits."""
    return f"(floor((CAST({x} AS DOUBLE))*1e{n}+0.5)/1e{n})"


def growth(c: str, p: str) -> str:
    return f"((CAST({c} AS DOUBLE)/NULLIF(CAST({p} AS DOUBLE),0)-1)*100)"


def sql_day(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d')"


def sql_ym(x: str) -> str:
    return f"strftime({x}, '%Y-%m')"


def sql_stamp(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%d %H:%M:%S')"


def _facts(panel: str) -> str:
    back = lambda n: f"OVER (PARTITION BY entity ORDER BY idx RANGE BETWEEN {n} PRECEDING AND {n} PRECEDING)"
    return f"""
    SELECT entity, month, idx, revenue, ytd,
      {jr(growth('revenue', f'max(revenue) {back(1)}'), 4)} AS mom,
      {jr(growth('revenue', f'max(revenue) {back(12)}'), 4)} AS yoy,
      {jr(growth('ytd', f'max(ytd) {back(12)}'), 4)} AS ytd_yoy
    FROM (SELECT *, CAST(year(month)*12+month(month)-1 AS INTEGER) AS idx,
            CAST(sum(revenue) OVER (PARTITION BY entity, year(month) ORDER BY month) AS BIGINT) AS ytd
          FROM {panel})"""


_BASIS_LIST = "[" + ", ".join(f"'{b}'" for b in BASES) + "]"
_PRIORITY = (
    "CASE WHEN basis IN ('mops_current_feed','mops_revenue_announcement') THEN 1 "
    "WHEN basis IN ('mops_first_observed','company_ir_monthly_revenue') THEN 2 "
    "WHEN basis = 'ir_calendar_matched' THEN 3 ELSE 4 END"
)

CTES: dict[str, str] = {
    "panel": """
    SELECT l_suppkey AS entity, CAST(date_trunc('month', l_shipdate) AS DATE) AS month,
      CAST(sum(CAST(round(l_extendedprice*100) AS BIGINT)) AS BIGINT) AS revenue
    FROM lineitem GROUP BY 1, 2""",
    "sparse": """
    SELECT o_custkey AS entity, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
      CAST(sum(CAST(round(o_totalprice*100) AS BIGINT)) AS BIGINT) AS revenue
    FROM orders GROUP BY 1, 2""",
    "facts": _facts("panel"),
    "sparse_facts": _facts("sparse"),
    "dim": """
    SELECT s_suppkey AS entity, CAST(s_suppkey AS VARCHAR) AS ticker, s_name AS name,
      n_name || '; ' || r_name || ';' AS labels
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "customers": """
    SELECT c_custkey AS entity, CAST(c_custkey AS VARCHAR) AS ticker, c_name AS name,
      c_mktsegment AS classification FROM customer""",
    "bridge": """
    SELECT s_suppkey AS entity, n_name AS classification, 1 AS label_order
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
    UNION ALL
    SELECT s_suppkey, r_name, 2
    FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "classed": """
    SELECT s_suppkey AS entity, CAST(s_suppkey AS VARCHAR) AS ticker, s_name AS name, n_name AS classification
    FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "report_dates": f"""
    SELECT *, {_PRIORITY} AS source_priority,
      CAST(reported_date AS TIMESTAMP) + (minute_local - 480) * INTERVAL 1 MINUTE AS reported_at,
      lpad(CAST(minute_local // 60 AS VARCHAR), 2, '0') || ':' || lpad(CAST(minute_local % 60 AS VARCHAR), 2, '0')
        || ':00' AS reported_time
    FROM (SELECT *, {_BASIS_LIST}[CAST((entity + idx) % {len(BASES)} + 1 AS INTEGER)] AS basis,
            CASE WHEN (entity + idx) % 7 <> 0 THEN (entity * 37 + idx * 11) % 1440 END AS minute_local
          FROM (SELECT *, year(month)*12+month(month)-1 AS idx
                FROM (SELECT l_suppkey AS entity,
                        CAST(date_trunc('month', l_shipdate) - INTERVAL 1 MONTH AS DATE) AS month,
                        CAST(min(l_shipdate) AS DATE) AS reported_date
                      FROM lineitem GROUP BY 1, 2)))""",
    "daily": """
    SELECT CAST(o_orderdate AS DATE) AS date, 10 + CAST(sum(o_orderkey) % 9000 AS DOUBLE) / 100 AS rate
    FROM orders GROUP BY 1""",
    "rates": f"""
    SELECT CAST(date_trunc('month', date) AS DATE) AS month, {jr('avg(rate)', 6)} AS average_rate,
      count(*) AS observations, min(date) AS first_date, max(date) AS last_date
    FROM daily GROUP BY 1""",
    "full_rates": f"""
    SELECT CAST(date_trunc('month', date) AS DATE) AS month, {jr('avg(rate)', 6)} AS average_rate,
      count(*) AS observations, min(date) AS first_date, max(date) AS last_date
    FROM (SELECT CAST(l_shipdate AS DATE) AS date, 10 + CAST(sum(l_orderkey) % 9000 AS DOUBLE) / 100 AS rate
          FROM lineitem GROUP BY 1) GROUP BY 1""",
    "holidays": """
    SELECT CAST(o_orderdate AS DATE) AS holiday FROM orders GROUP BY 1 HAVING sum(o_orderkey) % 5 = 0""",
    "src": """
    SELECT s_suppkey*2+k AS source_id, s_suppkey AS entity, k AS source_priority, (s_suppkey+k) % 4 <> 0 AS enabled
    FROM supplier, (SELECT unnest([1, 2]) AS k)""",
    "evt": """
    SELECT s_suppkey*10+k*3+j AS event_id, s_suppkey*2+k AS source_id, s_suppkey AS entity, month,
      CAST(last_day(month) + CAST((s_suppkey*7+k*3+j) % 25 AS INTEGER) AS DATE) AS announced_date,
      CASE WHEN (s_suppkey+j) % 2 <> 0 THEN lpad(CAST(s_suppkey % 8 + 9 AS VARCHAR), 2, '0') || ':30:00' END
        AS announced_time,
      (s_suppkey+k+j) % 5 <> 0 AS is_current
    FROM (SELECT s_suppkey, g // 3 + 1 AS k, g % 3 AS j,
            CASE WHEN (g % 3) % 2 = 0 THEN DATE '2001-12-01' ELSE DATE '2002-01-01' END AS month
          FROM supplier, (SELECT unnest([0,1,2,3,4,5]) AS g))""",
    "announcements": """
    SELECT entity, month, announced_date, announced_time, event_id FROM (
      SELECT evt.*, source_priority,
        row_number() OVER (PARTITION BY evt.entity, month ORDER BY source_priority, event_id DESC) AS rn
      FROM evt JOIN src ON evt.source_id = src.source_id
      WHERE is_current AND enabled) WHERE rn = 1""",
    "obs": """
    SELECT *, nullif(flag, 'N') AS note, revenue % 10 = 0 AS corrected,
      obs_id = max(obs_id) OVER (PARTITION BY entity) AS is_current,
      count(*) OVER (PARTITION BY entity) AS versions
    FROM (SELECT l_orderkey AS entity, CAST(l_linenumber AS BIGINT) AS obs_id,
            CAST(sum(CAST(round(l_extendedprice*100) AS BIGINT)) AS BIGINT) AS revenue,
            CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity,
            max(l_returnflag) AS flag, min(l_suppkey) AS supplier_id, CAST(min(l_shipdate) AS DATE) AS shipped
          FROM lineitem GROUP BY 1, 2)""",
    "order_dates": """
    SELECT o_orderkey AS entity, CAST(o_orderdate AS DATE) AS reported_date,
      CASE WHEN o_orderstatus <> 'P'
        THEN o_orderdate + CAST(o_orderkey % 1440 AS INTEGER) * INTERVAL 1 MINUTE END AS reported_at,
      CASE o_orderpriority WHEN '1-URGENT' THEN 'mops_current_feed' WHEN '2-HIGH' THEN 'mops_revenue_announcement'
        WHEN '3-MEDIUM' THEN 'company_ir_monthly_revenue' WHEN '4-NOT SPECIFIED' THEN 'mops_first_observed'
        ELSE 'cnyes_revenue_news' END AS basis
    FROM orders""",
    "records": """
    SELECT event_id AS record_id, user_id AS entity, CAST(date_trunc('month', ts) AS DATE) AS month,
      CAST(ts AS DATE) AS day, date_trunc('second', ts) AS published_at,
      CAST(date_trunc('second', ts) + INTERVAL 8 HOUR AS DATE) AS published_date,
      strftime(date_trunc('second', ts) + INTERVAL 8 HOUR, '%H:%M:%S') AS published_time,
      event_type AS kind, CAST(round(value*100) AS BIGINT) AS revenue
    FROM events""",
}
