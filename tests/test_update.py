"""A whole poll over stored tables; the second identical poll changes nothing."""

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_sources import HEADER, ROW, article, payload, write

from panelmill.operators import maintain, update
from panelmill.sources import archive, feeds

NOW = "2035-01-02 23:50:00"


@pytest.fixture
def companies(spark):
    return spark.createDataFrame([(1, "2330", "a"), (2, "2303", "b")], "entity bigint, ticker string, name string")


def archive_poll(spark, tmp_path, text=ROW, name="a"):
    moved = text.replace("115/08/01", "124/01/03").replace("115/7", "123/12")
    rows_ = archive.scan_archive(spark, write(tmp_path / f"{name}.csv", f"{HEADER}\n{moved}\n"), "sii", "2034-12-01")
    return rows_.withColumn("file_id", F.lit(7).cast("bigint"))


def history(spark):
    """Eleven earlier report dates of the first company."""
    months = [(1, f"2034-{m:02d}-01") for m in range(1, 12)]
    d = spark.createDataFrame(months, "entity bigint, month string").withColumn("month", F.col("month").cast("date"))
    return d.select(
        "entity",
        "month",
        F.date_add(F.last_day("month"), 5).alias("reported_date"),
        F.lit("07:00:00").alias("reported_time"),
        F.lit(None).cast("timestamp").alias("reported_at"),
        F.lit("ir_calendar_matched").alias("basis"),
        F.lit(3).alias("source_priority"),
        F.lit(None).cast("string").alias("source_url"),
        F.lit(None).cast("string").alias("source_subject"),
        F.lit("2034-01-01 00:00:00").cast("timestamp").alias("first_recorded_at"),
        F.lit("2034-01-01 00:00:00").cast("timestamp").alias("updated_at"),
    )


def feed(spark, tmp_path):
    value = {"code": 200, "datetime": "124/01/03 07:46:00", "result": {"data": [{"companyId": "2330", "time": "07:45:00", "subject": "公告本公司123年12月營收", "url": "/x"}]}}
    return feeds.scan_current_feed(spark, payload(tmp_path / "f.json", value), "2034-12-01", NOW)


def counts(frame):
    return {(r["table"], r["action"]): r["rows"] for r in frame.collect()}


def test_poll_twice(spark, tmp_path, companies):
    tables = update.empty_tables(spark, companies)
    tables.dates = history(spark)
    poll = update.Poll(archive=archive_poll(spark, tmp_path), feed=feed(spark, tmp_path))
    first, changed = update.apply_poll(tables, poll, "2034-12-01", NOW)
    got = counts(changed)
    assert got[("facts", "insert")] == 1 and got[("exact_dates", "update")] == 1
    assert rows(first.dates.where("month = '2034-12-01'"), "basis", "source_priority", "reported_at") == [
        ("mops_current_feed", 1, "2035-01-02 23:45:00")
    ]
    assert rows(first.facts, "revenue", "publication_basis", "publication_timestamp", "is_current") == [
        (442679969000, "MOPS_CURRENT_REPORT_FEED_EXACT", "2035-01-02 23:45:00", True)
    ]
    plan = first.schedule.where("entity = 1 AND month = '2034-12-01'")
    assert rows(plan, "samples", "status", "actual_date", "schedule_source") == [(11, "reported", "2035-01-03", "actual_first_seen")]
    assert first.schedule.count() == 26

    later = "2035-01-03 00:20:00"
    second, changed = update.apply_poll(first, poll, "2034-12-01", later)
    assert counts(changed) == {}
    assert rows(second.facts, "row_hash") == rows(first.facts, "row_hash")


def test_restatement_and_return(spark, tmp_path, companies):
    tables = update.empty_tables(spark, companies)
    run = lambda t, text, name: update.apply_poll(t, update.Poll(archive=archive_poll(spark, tmp_path, text, name)), "2034-12-01", NOW)
    other = ROW.replace("442679969", "442679970")
    one, _ = run(tables, ROW, "a")
    two, changed = run(one, other, "b")
    assert counts(changed)[("facts", "deactivate")] == 1 and counts(changed)[("facts", "insert")] == 1
    three, changed = run(two, ROW, "c")
    assert counts(changed)[("facts", "reactivate")] == 1
    assert rows(three.facts, "version", "revenue", "is_current") == [(1, 442679969000, True), (2, 442679970000, False)]
    assert rows(update.revenue_rows(three), "versions", "restated") == [(2, True)]


def test_unchanged_numbers_under_another_hash(spark, tmp_path, companies):
    tables = update.empty_tables(spark, companies)
    run = lambda t, text, name: update.apply_poll(t, update.Poll(archive=archive_poll(spark, tmp_path, text, name)), "2034-12-01", NOW)
    one, _ = run(tables, ROW, "a")
    _, changed = run(one, ROW.replace("6.1645", "6.16450"), "b")
    assert ("facts", "insert") not in counts(changed)


def news(spark, tmp_path, name, news_id, publish_at):
    text = "<p>x(2330-TW)今天公告2034年12月營收為新台幣4,426.80億元，年增率67.87%，月增率6.16%。</p>"
    one = article(text, news_id)
    one["publishAt"] = publish_at
    page = {"statusCode": 200, "items": {"data": [one]}}
    return feeds.scan_articles(spark, payload(tmp_path / f"{name}.json", page))


def test_evidence_twice_and_earliest_proxy(spark, tmp_path, companies):
    base, _ = update.apply_poll(update.empty_tables(spark, companies), update.Poll(archive=archive_poll(spark, tmp_path)), "2034-12-01", NOW)
    base.dates = base.dates.limit(0)
    base.facts = base.facts.withColumn("publication_basis", F.lit("MOPS_ARCHIVE_HTTP_LAST_MODIFIED_CURRENT_VERSION"))
    early = news(spark, tmp_path, "n1", 1, 2051324400)  # 2035-01-02 03:00 UTC
    late = news(spark, tmp_path, "n2", 2, 2051328000)
    poll = update.Poll(articles={"moneydj_revenue_news": early, "cnyes_revenue_news": late})
    first, changed = update.apply_poll(base, poll, "2034-12-01", NOW)
    got = counts(changed)
    assert got[("evidence_moneydj_revenue_news", "insert")] == 1 and got[("evidence_cnyes_revenue_news", "insert")] == 1
    assert ("dates_cnyes_revenue_news", "update") not in got and ("timestamps_cnyes_revenue_news", "update") not in got
    assert rows(first.dates, "basis", "source_priority") == [("moneydj_revenue_news", 4)]
    assert rows(first.facts, "publication_basis") == [("MONEYDJ_PUBLICATION_CORROBORATED_PROXY",)]
    second, changed = update.apply_poll(first, poll, "2034-12-01", NOW)
    assert counts(changed) == {}
    assert second.evidence.count() == 2


def test_company_release_outranks_proxy_once(spark, tmp_path, companies):
    base, _ = update.apply_poll(update.empty_tables(spark, companies), update.Poll(archive=archive_poll(spark, tmp_path)), "2034-12-01", NOW)
    claim = base.facts.select(
        F.lit("2330").alias("ticker"), "month", F.lit("r").alias("record_id"), F.lit("t").alias("source_title"),
        F.lit("2035-01-01 05:00:00").cast("timestamp").alias("published_at"), F.lit("2035-01-01").cast("date").alias("published_date"),
        F.lit("13:00:00").alias("published_time"), F.lit("u").alias("source_url"), "revenue", "mom", "yoy", "ytd", "ytd_yoy",
    )
    poll = update.Poll(releases=claim)
    first, changed = update.apply_poll(base, poll, "2034-12-01", NOW)
    got = counts(changed)
    assert got[("evidence_releases", "insert")] == 1 and got[("dates_releases", "update")] == 1
    assert rows(first.dates, "basis", "source_priority") == [("company_ir_monthly_revenue", 2)]
    assert rows(first.facts, "publication_basis") == [("COMPANY_IR_MONTHLY_REVENUE_EXACT",)]
    assert rows(first.evidence, "exact") == [(1,)]
    _, changed = update.apply_poll(first, poll, "2034-12-01", NOW)
    assert counts(changed) == {}


def test_memo_never_downgrades(spark):
    schema = "note_hash string, english string, provider string, status string"
    memo = spark.createDataFrame([("a", "w", "h", "pending"), ("b", "x", "p", "complete")], schema)
    new = spark.createDataFrame([("a", "A", "p", "complete"), ("b", "w", "h", "pending"), ("c", "w", "h", "pending")], schema)
    applied = maintain.apply_memo(memo, new)
    assert rows(applied, "note_hash", "english", "status", "action") == [
        ("a", "A", "complete", "update"), ("b", "x", "complete", "keep"), ("c", "w", "pending", "insert"),
    ]
    assert maintain.changed_rows(maintain.apply_memo(maintain.next_rows(applied), new)).count() == 0
