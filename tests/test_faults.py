"""Cases that once gave wrong or lost rows."""

import datetime

import pytest
from pyspark.sql import functions as F

from panelmill.functions import months, numbers
from panelmill.operators import panel
from panelmill.sources.steps import must


def test_rounding_of_large_numbers(spark):
    row = spark.range(1).select(*[numbers.js_round(F.lit(x), n) for x, n in ((1e18, 2), (1e13, 6), (-2.5, 0), (1.005, 2))]).first()
    assert tuple(row)[:3] == (1e18, 1e13, -2.0)


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_local_time_in_any_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        at = F.lit("2024-03-09T05:25:22Z").cast("timestamp")
        back = months.local_to_utc(F.lit("2024-03-09"), F.lit("13:25:22"))
        first, after = months.month_bounds_utc(F.lit("2024-03-01").cast("date"))
        row = spark.range(1).select(
            months.local_date(at), months.local_time(at), F.unix_seconds(back) == F.unix_seconds(at), F.unix_seconds(first), F.unix_seconds(after)
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert tuple(row) == (datetime.date(2024, 3, 9), "13:25:22", True, 1709222400, 1711900800)


def test_a_gate_holds_for_any_columns(spark):
    facts = spark.sql("SELECT 1 AS entity, DATE '2024-01-01' + make_ym_interval(0, CAST(id AS INT)) AS month, 100L AS revenue FROM range(3)")
    rates = spark.sql("SELECT DATE '2024-01-01' AS month, 30.0D AS average_rate, 20 AS observations, DATE '2024-01-31' AS last_date")
    checked = panel.translate_checked(facts, rates)
    for read in (checked.select("month"), checked.select("month", "revenue_usd", "ytd_usd"), checked.groupBy().count()):
        with pytest.raises(Exception, match="Missing exchange rate"):
            read.collect()
    assert panel.translate_checked(facts.limit(1).where("month = '2024-01-01'"), rates.union(rates)).count() == 1
    with pytest.raises(Exception, match="bad"):
        must(facts, F.col("entity") == 2, F.lit("bad")).count()
