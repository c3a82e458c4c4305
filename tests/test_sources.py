"""Raw inputs: files on disk to typed rows."""

import hashlib
import json

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from panelmill.functions import finished_note, has_han, name_key, expand_roc_years
from panelmill.operators import maintain, match, pick, views
from panelmill.sources import archive, feeds, manifest, pages, reference, sinks

HEADER = ",".join(archive.HEADERS.values())
ROW = "115/08/01,115/7,2330,source company,source industry,442679969,416975163,263708978,6.1645,67.8668,2404483690,1773045533,35.6131,-"


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def payload(path, value):
    return write(path, json.dumps(value, ensure_ascii=False))


def test_archive_values(spark, tmp_path):
    path = write(tmp_path / "a.csv", f"﻿{HEADER}\n{ROW}\n\n")
    got = archive.scan_archive(spark, path, "sii", "2026-07-01").collect()
    assert len(got) == 1
    r = got[0]
    assert (str(r.month), str(r.source_report_date), r.ticker) == ("2026-07-01", "2026-08-01", "2330")
    assert (r.revenue, r.previous_revenue, r.prior_year_revenue) == (442679969000, 416975163000, 263708978000)
    assert (r.ytd, r.prior_year_ytd, r.mom, r.yoy, r.ytd_yoy) == (2404483690000, 1773045533000, 6.1645, 67.8668, 35.6131)
    assert r.note is None and r.note_hash is None and not r.corrected and r.rejects == []


def test_archive_header_only_is_empty(spark, tmp_path):
    assert archive.scan_archive(spark, write(tmp_path / "a.csv", HEADER + "\n"), "sii").count() == 0


def test_archive_missing_column(spark, tmp_path):
    with pytest.raises(archive.ArchiveError):
        archive.scan_archive(spark, write(tmp_path / "a.csv", "資料年月,公司代號\n115/7,2330\n"), "sii")


def test_archive_wrong_month(spark, tmp_path):
    path = write(tmp_path / "a.csv", f"{HEADER}\n{ROW}\n")
    with pytest.raises(PySparkException, match="expected 2026-06-01"):
        archive.scan_archive(spark, path, "sii", "2026-06-01").collect()


def test_archive_quotes_short_rows_and_rejects(spark, tmp_path):
    quoted = ROW.replace("442679969", '"442,679,969"').replace(",-", ',"更正 ""x"", y"')
    short = "115/08/01,115/7,9999,n,i,5,,--,x%,1,7"
    path = write(tmp_path / "a.csv", f"{HEADER}\n{quoted}\n{short}\n")
    good, bad = archive.scan_archive(spark, path, "sii").orderBy("ticker").collect()
    assert good.revenue == 442679969000 and good.corrected and good.note == '更正 "x", y'
    assert bad.rejects == ["mom"] and bad.prior_year_ytd is None and bad.note is None


def test_row_hash_ignores_report_date_only(spark, tmp_path):
    later = ROW.replace("115/08/01", "115/08/02")
    other = ROW.replace("442679969", "442679970")
    path = write(tmp_path / "a.csv", "\n".join([HEADER, ROW, later, other]))
    hashes = [r.row_hash for r in archive.scan_archive(spark, path, "sii").collect()]
    assert len(set(hashes)) == 2


def test_market_priority(spark, tmp_path):
    one = archive.scan_archive(spark, write(tmp_path / "sii/a.csv", f"{HEADER}\n{ROW}\n"), "sii")
    two = archive.scan_archive(spark, write(tmp_path / "otc/a.csv", f"{HEADER}\n{ROW}\n"), "otc")
    assert rows(pick.pick_market(two.unionByName(one)), "ticker", "market") == [("2330", "sii")]


def test_file_manifest(spark, tmp_path):
    path = write(tmp_path / "a.csv", "abc")
    got = archive.file_manifest(spark, path, "otc", "2026-08-01 00:00:00").collect()[0]
    assert got.source_hash == "ba7816bf8f01cfea414140de5dae2223b00361a396177a9cb410ff61f20015ad"
    assert got.market_priority == 2


FEED = {
    "code": 200,
    "datetime": "115/08/06 02:57:43",
    "result": {
        "data": [
            {"companyId": "2330", "time": "13:55:01", "subject": "公告本公司115年07月營收", "url": "/mops/web/t05st10_ifrs"},
            {"companyId": "2330", "time": "14:20:00", "subject": "更正本公司115年07月營收", "url": "/x"},
            {"companyId": "2303", "time": "15:00:00", "subject": "115年第2季財務報告", "url": "/y"},
            {"companyId": "2454", "time": "17:10:00", "subject": "115年06月份營業收入資訊"},
        ]
    },
}


def test_current_feed(spark, tmp_path):
    path = payload(tmp_path / "f.json", FEED)
    got = feeds.scan_current_feed(spark, path, "2026-07-01", "2026-08-05 19:00:00")
    assert rows(got, "ticker", "month", "reported_date", "reported_time", "reported_at", "source_url") == [
        ("2330", "2026-07-01", "2026-08-06", "13:55:01", "2026-08-06 05:55:01", "https://mops.twse.com.tw/mops/web/t05st10_ifrs"),
        ("2454", "2026-06-01", "2026-08-06", "17:10:00", "2026-08-06 09:10:00", feeds.FEED_PAGE),
    ]


def article(content, news_id=6500001, market=({"code": "2330", "name": "x"},)):
    return {"newsId": news_id, "publishAt": 1783924495, "title": "<mark>A</mark> &amp; B", "content": content, "market": list(market)}


def article_file(path, articles):
    return payload(path, {"statusCode": 200, "items": {"total": 1, "current_page": 1, "last_page": 1, "data": articles}})


TEXT = "&lt;p&gt;台積電(2330-TW)今天公告2026年6月營收為新台幣4,426.80億元，年增率67.87%，月增率6.16%。&lt;/p&gt;"


def test_articles(spark, tmp_path):
    article_file(tmp_path / "p1.json", [article(TEXT), article(TEXT.replace("公告", "更正公告"), 2), article("<p>2026年6月營收一覽</p>", 3, ())])
    article_file(tmp_path / "p2.json", [article(TEXT)])
    got = feeds.scan_articles(spark, str(tmp_path))
    assert rows(got, "ticker", "month", "published_at", "published_date", "published_time", "revenue", "tolerance", "mom", "yoy", "source_title") == [
        ("2330", "2026-06-01", "2026-07-13 06:34:55", "2026-07-13", "14:34:55", 442680000000, 500001, 6.16, 67.87, "A & B")
    ]


def test_article_corroboration(spark, tmp_path):
    got = feeds.scan_articles(spark, article_file(tmp_path / "p.json", [article(TEXT)])).withColumn("entity", F.lit(1))
    obs = "entity int, month date, obs_id long, is_current boolean, revenue long, mom double, yoy double"
    near = spark.createDataFrame([(1, 442679969000, 6.1645, 67.8668)], "obs_id long, revenue long, mom double, yoy double")
    far = near.withColumn("revenue", F.lit(440000000000))
    shape = lambda d: d.select(F.lit(1).alias("entity"), F.lit("2026-06-01").cast("date").alias("month"), "obs_id", F.lit(True).alias("is_current"), "revenue", "mom", "yoy")
    assert obs and match.corroborate(got, shape(near), percents=["mom", "yoy"]).count() == 1
    assert match.corroborate(got, shape(far), percents=["mom", "yoy"]).count() == 0


RELEASE = (
    "<p>ASPEED Technology (TWSE: 5274) today announced its net revenue for June 2026. The revenue for June was NT$ 1,310.195 million, "
    "an increase of 2.19% from May 2026 and an increase of 67.47% compared to June 2025. The total revenue for 2026 year-to-date reached "
    "NT$ 7,018.166 million, marking a 62.77% increase compared to the same period last year.</p>"
)
YEAR_END = (
    "ASPEED Technology (TWSE: 5274) today announced its net revenue for December 2025. The revenue for December was NT$872.214 million, an "
    "increase of 3.8% from November 2025 and a decrease of 18.37% compared to December 2024. The total revenue for 2025 reached "
    "NT$9,084.875 million, representing a 40.64% decrease compared to the same period last year."
)


def release(name, content, _id="r1", kind=3):
    return {"success": True, "data": {"_id": _id, "name": name, "type": kind, "postTime": "2026-07-03T05:25:22.368Z", "content": content}}


def test_releases(spark, tmp_path):
    payload(tmp_path / "1.json", release("ASPEED Reports June 2026 Revenue", RELEASE))
    payload(tmp_path / "2.json", release("ASPEED Reports December 2025 Revenue", YEAR_END, "r2"))
    payload(tmp_path / "3.json", release("ASPEED Wins Award", RELEASE.replace("5274", "1111"), "r3"))
    got = feeds.release_records(feeds.read_payloads(spark, str(tmp_path), feeds.RELEASE_SCHEMA))
    assert rows(got, "record_id", "month", "revenue", "mom", "yoy", "ytd", "ytd_yoy", F.array_join("rejects", ",")) == [
        ("r1", "2026-06-01", 1310195000, 2.19, 67.47, 7018166000, 62.77, ""),
        ("r2", "2025-12-01", 872214000, 3.8, -18.37, 9084875000, -40.64, ""),
        ("r3", None, 1310195000, 2.19, 67.47, 7018166000, 62.77, "ticker,month"),
    ]
    first = got.where("record_id = 'r1'").select("published_date", "published_time").collect()[0]
    assert (str(first[0]), first[1]) == ("2026-07-03", "13:25:22")


def test_release_archive_equals_detail(spark, tmp_path):
    from panelmill.operators import quality

    listing = {"success": True, "data": [{"_id": "r1", "name": "ASPEED Reports June 2026 Revenue", "postTime": "2026-07-03T05:25:22.368Z"}, {"_id": "z", "name": "Other", "postTime": "x"}], "pages": {"hasNext": True, "next": "2"}}
    archive_rows = feeds.release_archive_records(feeds.read_payloads(spark, payload(tmp_path / "a.json", listing), feeds.RELEASE_ARCHIVE_SCHEMA))
    path = payload(tmp_path / "d/1.json", release("ASPEED Reports June 2026 Revenue", RELEASE))
    detail = feeds.release_records(feeds.read_payloads(spark, path, feeds.RELEASE_SCHEMA))
    assert archive_rows.count() == 1
    assert quality.archive_detail_mismatch(archive_rows, detail).count() == 0
    later = detail.withColumn("published_at", F.col("published_at") + F.expr("interval 1 second"))
    assert quality.archive_detail_mismatch(archive_rows, later).count() == 1


def test_release_match_needs_both_amounts(spark, tmp_path):
    path = payload(tmp_path / "1.json", release("ASPEED Reports June 2026 Revenue", RELEASE))
    claim = feeds.release_records(feeds.read_payloads(spark, path, feeds.RELEASE_SCHEMA)).withColumns({"entity": F.lit(1), "tolerance": F.lit(1000).cast("long")})
    schema = "entity int, month string, obs_id long, is_current boolean, revenue long, mom double, yoy double, ytd long, ytd_yoy double"
    make = lambda ytd: spark.createDataFrame([(1, "2026-06-01", 1, True, 1310195000, 2.1854, 67.4707, ytd, 62.7716)], schema).withColumn("month", F.col("month").cast("date"))
    found = lambda o: match.tolerance_match(claim, o, percents=["mom", "yoy", "ytd_yoy"], also=[("ytd", 1000)]).count()
    assert found(make(7018166000)) == 1
    assert found(make(7000000000)) == 0


def listing_row(title, record="D81D6A39-e2ea", at="2026-07-07   15:39:04"):
    return f'<tr bgcolor="White"><td><a href="../news/newsviewer.aspx?a={record}">{title}</a></td><td align="center" width="100">{at}</td></tr>'


def test_listing(spark):
    html = listing_row("茂迪 115年6月營收3.08億、年增65.82%") + listing_row("茂迪 115年6月營收更正公告", "b") + listing_row("茂迪 115年6月營收500萬、年減1.5%", "c") + '<a href="?index1=2&amp;x=1">2</a>'
    page = spark.createDataFrame([(html,)], "html string")
    got = pages.listing_records(page)
    assert rows(got, "company_name", "month", "published_at", "record_id", "revenue", "tolerance", "yoy") == [
        ("茂迪", "2026-06-01", "2026-07-07 07:39:04", "c", 5000000, 5001, -1.5),
        ("茂迪", "2026-06-01", "2026-07-07 07:39:04", "d81d6a39-e2ea", 308000000, 500001, 65.82),
    ]
    assert pages.last_page(page).collect()[0].last_page == 2


def test_listing_keeps_the_sign_of_a_small_fall(spark):
    from types import SimpleNamespace

    from panelmill.plans import raw

    facts = spark.createDataFrame([(7, "2001-05-01", 24016, 10**9, -0.0012), (8, "2001-05-01", 24016, 10**9, 0.0012)], "entity long, month string, idx int, revenue long, yoy double")
    page = raw.raw_listing(SimpleNamespace(facts=facts.withColumn("month", F.col("month").cast("date"))))
    assert rows(pages.listing_records(page), "company_name", "yoy") == [("公司7", -0.0012), ("公司8", 0.0012)]


def test_name_map_first_seen_wins(spark):
    names = spark.createDataFrame([("Ａ b", "1", 1, 1, 2), ("ab", "2", 1, 1, 3), ("c", "9", 1, 1, 1)], "name string, ticker string, month int, priority int, row_no int")
    names = names.withColumn("name_key", name_key("name"))
    records = spark.createDataFrame([(1, "A　B"), (2, "zz")], "id int, n string").withColumn("name_key", name_key("n"))
    assert rows(match.map_names(records, names), "id", "ticker") == [(1, "1")]
    assert rows(match.unmapped_names(records, names), "id") == [(2,)]


CALENDARS = {
    "tsmc": '<var class="atc_event"><var class="atc_date_start">2026-08-10 13:30:00</var>\n<var class="atc_title">TSMC Monthly Sales - July 2026</var></var>',
    "honhai": '"Hon Hai&#8217;s Unaudited Consolidated July 2026 Revenue","2026/08/05"\n"Hon Hai&#8217;s Unaudited Consolidated April 2025 Revenue","2026/05/05"',
    "umc": '<strong>July 2026, Monthly Sales Announcement</strong>\n<div class="date">8/6/2026*</div>',
    "mediatek": '<div class="events_calendar_item"\n data-title="Monthly Sales - July 2026"\n data-start-date="2026-08-10T17:00:00">\n</div>',
}


def test_calendars(spark):
    frame = spark.createDataFrame(list(CALENDARS.items()), "parser_name string, html string")
    got = pages.calendar_records(frame)
    assert rows(got, "parser_name", "month", "announced_date", "announced_time", "announced_at", "title") == [
        ("honhai", "2026-07-01", "2026-08-05", None, None, "Hon Hai's Unaudited Consolidated July 2026 Revenue"),
        ("mediatek", "2026-07-01", "2026-08-10", "17:00:00", "2026-08-10 09:00:00", "Monthly Sales - July 2026"),
        ("tsmc", "2026-07-01", "2026-08-10", "13:30:00", "2026-08-10 05:30:00", "TSMC Monthly Sales - July 2026"),
        ("umc", "2026-07-01", "2026-08-06", None, None, "July 2026, Monthly Sales Announcement"),
    ]


def test_annual_calendar(spark):
    html = """<div class="table_title">Monthly Sales Announcement - 2026</div>
    <div class="inner">January：2/5/2026(Thu)</div><div class="inner">July：8/6/2026(Thu)*</div>
    <div class="inner">December：1/7/2027(Thu)*</div><div>Quarterly Earnings Release &amp; Call</div>"""
    frame = spark.createDataFrame([("umc", html), ("umc", "<p>nothing</p>")], "parser_name string, html string").withColumn("page", F.monotonically_increasing_id())
    got = pages.calendar_records(frame)
    assert rows(got, "month", "announced_date", "title") == [
        ("2026-01-01", "2026-02-05", "January 2026, Monthly Sales Announcement"),
        ("2026-07-01", "2026-08-06", "July 2026, Monthly Sales Announcement"),
        ("2026-12-01", "2027-01-07", "December 2026, Monthly Sales Announcement"),
    ]


def test_calendars_of_long_entries(spark):
    """Dates and titles 10,000 characters apart; an entry without one does not take it from the next."""
    gap = "<p>" + "long text " * 1000 + "</p>"
    atc = lambda date, title: f'<var class="atc_date_start">{date} 13:30:00</var>{gap}' + (f'<var class="atc_title">TSMC Monthly Sales - {title}</var>{gap}' if title else "")
    overview = lambda title, date: f"<strong>{title}, Monthly Sales Announcement</strong>{gap}" + (f'<div class="date">{date}</div>{gap}' if date else "")
    annual = lambda year, *days: f"Monthly Sales Announcement - {year}{gap}" + gap.join(f"<div>{d}</div>" for d in days) + gap
    html = {
        "tsmc": atc("2026-08-10", "July 2026") + atc("2026-07-11", None) + atc("2026-07-10", "June 2026"),
        "umc": overview("July 2026", "8/6/2026") + overview("June 2026", None) + "<strong>July 2026, Meeting</strong>" + '<div class="date">7/9/2026</div>'
        + annual(2025, "January：2/5/2025", "March：4/7/2025") + annual(2024, "May：6/5/2024") + "Quarterly Earnings Release",
    }
    got = pages.calendar_records(spark.createDataFrame(list(html.items()), "parser_name string, html string"))
    assert rows(got, "parser_name", "month", "announced_date") == [
        ("tsmc", "2026-06-01", "2026-07-10"), ("tsmc", "2026-07-01", "2026-08-10"),
        ("umc", "2024-05-01", "2024-06-05"), ("umc", "2025-01-01", "2025-02-05"), ("umc", "2025-03-01", "2025-04-07"), ("umc", "2026-07-01", "2026-08-06"),
    ]


RATES = [["20260702", "32.500"], ["invalid", "32"], ["20260701", "32.300"], ["20260701", "32.400"], ["20260703", "-"], ["20260704", "500"]]


def test_daily_and_monthly_rates(spark, tmp_path):
    path = payload(tmp_path / "r.json", {"meta": {"last_updated": "2026-07-03T00:00"}, "data": {"dataSets": RATES}})
    daily = feeds.scan_daily_fx(spark, path)
    assert rows(daily, "date", "rate") == [("2026-07-01", 32.4), ("2026-07-02", 32.5)]
    with pytest.raises(feeds.FeedError):
        feeds.scan_daily_fx(spark, payload(tmp_path / "bad.json", {"meta": {}, "data": {"dataSets": [["x", "1"]]}}))


def test_monthly_rates_upsert(spark):
    def month(last):
        daily = spark.createDataFrame([("2026-06-30", 31.0), ("2026-07-01", 32.0), ("2026-07-02", last)], "date string, rate double")
        return feeds.rate_records(views.monthly_rates(daily.withColumn("date", F.col("date").cast("date"))), "2026-07-03", "2026-07-04 00:00:00")

    first = month(34.0)
    assert rows(first.where("month = '2026-07-01'"), "average_rate", "observations", "first_date", "last_date") == [(33.0, 2, "2026-07-01", "2026-07-02")]
    empty = first.limit(0)
    assert maintain.changed_rows(maintain.apply_rates(empty, first)).count() == 2
    again = first.withColumn("retrieved_at", F.lit("2026-08-01 00:00:00").cast("timestamp"))
    assert maintain.changed_rows(maintain.apply_rates(first, again)).count() == 0
    changed = maintain.changed_rows(maintain.apply_rates(first, month(35.0)))
    assert rows(changed, "month", "average_rate", "action") == [("2026-07-01", 33.5, "update")]


def test_file_manifest(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    write(folder / "a.csv", "x,y\n1,2\n3,4\n")
    write(folder / "b.csv", "x,y\n")
    read = lambda: manifest.with_file(spark.read.option("header", True).csv(str(folder)))
    found = manifest.file_manifest(spark, str(folder), read(), "2026-08-01 00:00:00")
    name = lambda d: d.withColumn("file", F.regexp_extract("file", "[^/]+$", 0))
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    first = [("a.csv", 12, digest("x,y\n1,2\n3,4\n"), 2), ("b.csv", 4, digest("x,y\n"), 0)]
    assert rows(name(found), "file", "bytes", "content_hash", "row_count") == first
    known = pick.stored(found)
    write(folder / "a.csv", "x,y\n9,9\n")
    write(folder / "c.csv", "x,y\n")
    later = manifest.file_manifest(spark, str(folder), read(), "2026-08-02 00:00:00")
    applied = manifest.apply_manifest(known, later)
    got = name(applied).select("file", "row_count", F.dayofmonth("imported_at").alias("day"), "action")
    assert rows(got, "file", "row_count", "day", "action") == [("a.csv", 1, 2, "update"), ("b.csv", 0, 1, "keep"), ("c.csv", 0, 2, "insert")]
    again = manifest.apply_manifest(applied.drop("action"), later)
    assert {r.action for r in again.collect()} == {"keep"}
    assert manifest.apply_manifest(known, later.limit(0)).where("action <> 'keep'").count() == 0


def test_universe_gate(spark):
    frame = lambda *t: spark.createDataFrame([(x,) for x in t], "ticker string")
    dim = frame("1", "2")
    views.check_universe(frame("1", "2", "2"), dim, frame("9"))
    views.check_universe(frame("1", "2", "9"), dim, frame("9"))
    for bad, expected in ((frame("1"), frame()), (frame("1", "2", "3"), frame("9")), (frame("1", "2", "8", "9"), frame("8", "9"))):
        with pytest.raises(ValueError, match="universe file"):
            views.check_universe(bad, dim, expected)


def test_reference_inputs(spark, tmp_path):
    holidays = reference.scan_holidays(spark, payload(tmp_path / "h.json", [{"Name": "國慶日", "Date": "1151009", "Description": "10月9日補假。"}, {"Name": "x", "Date": "1151010"}, {"Name": "放假", "Date": "bad"}]))
    assert rows(holidays) == [("2026-10-09",)]
    path = write(tmp_path / "u.csv", '﻿Company Name (English),Ticker,Classification\n"A, Inc",1, x ; y;\nB,2,x\n')
    universe = reference.scan_universe(spark, path)
    assert rows(universe, "name", "ticker", "labels") == [("A, Inc", "1", "x ; y;"), ("B", "2", "x")]
    with pytest.raises(reference.UniverseError):
        reference.scan_universe(spark, write(tmp_path / "e.csv", "Company Name (English),Ticker,Classification\nA,,x\n"))
    registry = [{"ticker": "1", "sourceUrl": "a", "fallbackUrls": ["b", "a"], "parserName": "umc", "priority": 1, "enabled": True, "sourceType": "t"}, {"ticker": "2", "sourceUrl": "c", "enabled": False}]
    got = reference.scan_source_registry(spark, payload(tmp_path / "s.json", registry))
    assert [(r.ticker, r.urls, r.fallback_on_denied) for r in got.collect()] == [("1", ["a", "b"], False)]


def test_notes(spark):
    frame = spark.createDataFrame([("115年資料", "2026 data"), ("原始備註", "仍是中文"), ("更正", ""), ("x", "Café – thousand yuan ＡＢ")], "note string, english string")
    got = frame.select("note", expand_roc_years("note").alias("prepared"), has_han("english").alias("han"), finished_note("english", "note").alias("n")).select("*", "n.*")
    assert [(r.prepared, r.status, r.english) for r in got.collect()] == [
        ("2026 資料", "complete", "2026 data"),
        ("原始備註", "pending", "Translation pending; consult the official MOPS source record."),
        ("更正", "pending", "Translation pending; the official MOPS note indicates a correction or restatement."),
        ("x", "complete", "Cafe - thousand New Taiwan dollars AB"),
    ]


def test_sinks(spark, tmp_path):
    dim = spark.createDataFrame([(1, "A", "n1"), (2, "B", "n2")], "entity int, ticker string, name string")
    facts = spark.createDataFrame([(1, "2026-02-01", 5), (1, "2026-01-01", 4)], "entity int, month string, revenue long").withColumn("month", F.col("month").cast("date"))
    out = str(tmp_path / "docs")
    docs = sinks.entity_documents(dim, facts, ["revenue"])
    sinks.write_entity_docs(docs, out)
    sinks.write_entity_docs(docs.where("ticker = 'A'"), out)
    back = spark.read.json(out)
    assert rows(back, "ticker", F.col("history.month").cast("string"), F.col("history.revenue").cast("string")) == [("A", "[2026-01, 2026-02]", "[4, 5]")]
    sinks.write_bundle({"m": dim}, str(tmp_path / "b"))
    assert list((tmp_path / "b/m").glob("*.json.gz")) and spark.read.json(str(tmp_path / "b/m")).count() == 2
    frame = spark.createDataFrame([('a"b,c', None, 1), ("d", "", 2)], "x string, y string, z int")
    sinks.export_csv(frame.coalesce(1), str(tmp_path / "c"))
    text = next((tmp_path / "c").glob("*.csv")).read_text()
    assert text.splitlines() == ["x,y,z", '"a""b,c",,1', "d,,2"]
    assert rows(sinks.csv_lines(frame)) == [('"a""b,c",,1',), ("d,,2",)]


def test_run_log(spark, tmp_path):
    counters = spark.createDataFrame([("facts", "insert", 2)], "table string, action string, rows long")
    log = str(tmp_path / "runs")
    assert sinks.append_run(counters, log, "2026-08-01 00:00:00", [("mops:sii", "HTTP 307")])
    assert not sinks.append_run(counters.limit(0), log, "2026-08-01 01:00:00")
    got = spark.read.parquet(log).collect()
    assert len(got) == 1 and got[0].changed_rows == 2 and got[0].errors[0].message == "HTTP 307"


def test_company_documents(spark, tmp_path):
    doc = {"company": {"id": 1, "ticker": "6526", "name": "n", "classifications": ["a"]}, "history": [{"month": "2026-01", "revenueNt": 5, "momPercent": None, "restatementFlag": False, "publicationTimestamp": "2026-02-01T00:00:00.000Z"}]}
    got = reference.read_company_documents(spark, payload(tmp_path / "6526.json", doc))
    assert rows(got, "ticker", "month", "revenue", "mom", "restated") == [("6526", "2026-01-01", 5, None, False)]


def test_every_archive_file_goes_by_its_own_header(spark, tmp_path):
    folder = tmp_path / "orders of columns [1]"
    folder.mkdir()
    names = [archive.HEADERS[c] for c in ("month", "ticker", "revenue", "ytd", "note")]
    write(folder / "a.csv", ",".join(names) + '\n115/7,1,"1,000","2,000","x\ny"\n115/7,2,5,6,\n')
    write(folder / "b.csv", ",".join([names[0], names[3], names[2], names[1], "other"]) + '\n115/7,"9,000",8,3,junk\n')
    write(folder / "c.csv", "﻿" + ",".join(names) + "\n115/7,4,1,2,z\n")
    got = archive.scan_archive(spark, str(folder).replace("[", "\\[").replace("]", "\\]") + "/*.csv", "sii")
    assert rows(got, "ticker", "revenue", "ytd", "note") == [("1", 1000000, 2000000, "x\ny"), ("2", 5000, 6000, None), ("3", 8000, 9000000, None), ("4", 1000, 2000, "z")]
    assert got.select("row_no").distinct().count() == 4
    write(folder / "d.csv", "junk,other\n1,2\n")
    with pytest.raises(archive.ArchiveError):
        archive.scan_archive(spark, str(folder).replace("[", "\\[").replace("]", "\\]") + "/*.csv", "sii")


def test_failed_and_missing_payload_pages(spark):
    sent = [("a", 1, 4, True), ("a", 1, 4, False), ("a", 3, 4, False), ("b", 1, 2, True), ("b", 2, 2, True), ("c", 5, None, False), ("c", 4, None, None), ("c", None, None, True), ("c", 0, None, True)]
    payloads = spark.createDataFrame(sent, "source string, page int, last int, ok boolean")
    got = feeds.payload_rejects(payloads, ["source"], F.col("ok"), last="last")
    assert rows(got) == sorted(
        [("a", 2, 2, "missing"), ("a", 3, 3, "failed"), ("a", 4, 4, "missing"), ("c", 1, 3, "missing"), ("c", 4, 5, "failed"), ("c", 0, 0, "unnumbered"), ("c", None, None, "unnumbered")],
        key=repr,
    )
    good = payloads.where("source = 'b'")
    assert feeds.require_complete(good, ["source"], F.col("ok"), last="last").count() == 2
    with pytest.raises(feeds.FeedError, match="missing"):
        feeds.require_complete(payloads, ["source"], F.col("ok"), last="last")
    assert feeds.payload_rejects(payloads.limit(0), ["source"], F.col("ok")).collect() == []
