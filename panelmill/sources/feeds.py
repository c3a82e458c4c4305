"""JSON sources: current-report feed, articles, company releases, daily rates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.months import (
    MONTH_NAMES,
    clock_text,
    compact_date,
    feed_date,
    iso_date,
    local_date,
    local_time,
    local_to_utc,
    month_from_name,
)
from ..functions.numbers import millions, percent_after, signed_percent, unit_amount
from ..functions.text import (
    CORRECTION_ARTICLE,
    decode_release,
    decode_text,
    carries_ticker,
    decode_title,
    is_correction,
    is_revenue_subject,
    listed_tickers,
    match_groups,
    month_from_subject,
    month_of,
    printed_ticker,
    resolve_ticker,
)
from ..operators.pick import earliest, last_wins
from .steps import computed

FEED_SCHEMA = (
    "code int, message string, datetime string, "
    "result struct<data: array<struct<companyId: string, time: string, subject: string, url: string>>>"
)
ARTICLE_SCHEMA = (
    "statusCode int, message string, items struct<total: int, current_page: int, last_page: int, "
    "data: array<struct<newsId: bigint, publishAt: bigint, title: string, content: string, "
    "market: array<struct<code: string, name: string>>>>>"
)
RELEASE_SCHEMA = (
    "success boolean, data struct<_id: string, name: string, type: int, postTime: string, content: string>"
)
RELEASE_ARCHIVE_SCHEMA = (
    "success boolean, data array<struct<_id: string, name: string, postTime: string>>, "
    "pages struct<hasNext: boolean, next: string>"
)
RATE_SCHEMA = "meta struct<last_updated: string>, data struct<dataSets: array<array<string>>>"

# Source addresses that stored rows carry.
FEED_HOST = "https://mops.twse.com.tw"
FEED_PAGE = "https://mops.twse.com.tw/mops/api/home_page/t51sb10"
ARTICLE_PAGE = "https://news.cnyes.com/news/id/"
RELEASE_PAGE = "https://www.aspeedtech.com/monthly_revenue_content/?id="
RATE_METHOD = "arithmetic_mean_daily_1600_interbank_spot"
RATE_SOURCE = "Central Bank of the Republic of China (Taiwan)"
RATE_PAGE = "https://cpx.cbc.gov.tw/API/DataAPI/Get?FileName=BP01D01"

# Patterns of disclosure sentences and release texts.
DISCLOSURE = (
    r"(?iu)(?:公告|公佈|公布)\s*(\d{2,4})\s*年\s*(\d{1,2})\s*月(?:合併)?營收(?:為|達)\s*"
    r"(?:新台幣)?\s*([\d,.]+)\s*(兆元|億元|萬元|元)"
)
RELEASE_REVENUE = r"(?i)\brevenue for [A-Za-z]+ was NT\$\s*([\d,]+(?:\.\d+)?)\s+million\b"
RELEASE_MOM = r"(?i),\s+an?\s+(increase|decrease)\s+of\s+([\d.]+)%\s+from\b"
RELEASE_YOY = r"(?i)\band\s+an?\s+(increase|decrease)\s+of\s+([\d.]+)%\s+compared to\b"
RELEASE_YTD = (
    r"(?i)\btotal revenue for \d{4}(?: year-to-date)? reached NT\$\s*([\d,]+(?:\.\d+)?)\s+million,\s+"
    r"(?:marking|representing)\s+an?\s+([\d.]+)%\s+(increase|decrease)\b"
)

RATE_RANGE = (10, 100)


class FeedError(ValueError):
    """A payload says it failed, or holds nothing usable."""


def read_payloads(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON payload files, one document per file."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def failed_payloads(payloads: DataFrame, ok: Column) -> DataFrame:
    """Payloads that do not report success."""
    return payloads.where(~F.coalesce(ok, F.lit(False)))


def payload_rejects(payloads: DataFrame, keys: Sequence[str], ok: Column, page: str = "page", last: str | None = None) -> DataFrame:
    """What a set of payload pages lacks: keys, first_page, last_page and reason of every run of pages.

    ``keys`` name the set; its pages count from 1 to the greatest number that a page of
    it names as ``last``, or to the greatest page seen. A page that came only with
    failures is ``failed``, one that never came is ``missing``. Page numbers that are
    null or below 1 stand alone, with the reason ``unnumbered``. A set that is complete gives no rows.
    """
    keys = list(keys)
    number = F.col(page).cast("long")
    named = F.col(last).cast("long") if last else F.lit(None).cast("long")
    rows = payloads.select(*keys, number.alias("_page"), named.alias("_last"), F.coalesce(ok, F.lit(False)).alias("_ok"))
    numbered = F.coalesce(F.col("_page") >= 1, F.lit(False))
    odd = rows.where(~numbered).select(
        *keys, F.col("_page").alias("first_page"), F.col("_page").alias("last_page"), F.lit("unnumbered").alias("reason")
    ).distinct()
    # One row a page from here on, however often it was sent.
    pages = rows.where(numbered).groupBy(*keys, "_page").agg(F.bool_or("_ok").alias("_ok"), F.max("_last").alias("_last"))
    in_order = W.partitionBy(*keys).orderBy("_page")
    # Runs of failed pages: the distance to their place among the failed is the same along a run.
    failed = pages.where(~F.col("_ok")).withColumn("_run", F.col("_page") - F.row_number().over(in_order))
    failed = failed.groupBy(*keys, "_run").agg(F.min("_page").alias("first_page"), F.max("_page").alias("last_page"))
    failed = failed.select(*keys, "first_page", "last_page", F.lit("failed").alias("reason"))
    # Gaps lie before each page, and after the last.
    before = pages.select(*keys, (F.coalesce(F.lag("_page").over(in_order), F.lit(0)) + 1).alias("first_page"), (F.col("_page") - 1).alias("last_page"))
    after = pages.groupBy(*keys).agg((F.max("_page") + 1).alias("first_page"), F.greatest(F.max("_last"), F.max("_page")).alias("last_page"))
    missing = before.unionByName(after).where("first_page <= last_page").withColumn("reason", F.lit("missing"))
    return failed.unionByName(missing).unionByName(odd)


def require_complete(payloads: DataFrame, keys: Sequence[str], ok: Column, page: str = "page", last: str | None = None) -> DataFrame:
    """The payloads that report success; a failed or missing page fails the job."""
    lacking = payload_rejects(payloads, keys, ok, page, last).take(5)
    if lacking:
        raise FeedError(f"incomplete payloads: {[r.asDict() for r in lacking]}")
    return payloads.where(F.coalesce(ok, F.lit(False)))


def _absolute(url: Column) -> Column:
    return (
        F.when(F.coalesce(url, F.lit("")) == "", FEED_PAGE)
        .when(url.rlike(r"^https?://"), url)
        .when(F.startswith(url, F.lit("/")), F.concat(F.lit(FEED_HOST), url))
        .otherwise(F.concat(F.lit(FEED_HOST + "/"), url))
    )


def feed_records(payloads: DataFrame, expected_month, observed_at) -> DataFrame:
    """Revenue announcements of the current-report feed.

    Corrections and other subjects drop out. Rows that name another month keep
    it. The earliest announcement of each (ticker, month) stays.
    """
    to_col = lambda v, t: v if isinstance(v, Column) else F.lit(v).cast(t)
    day = feed_date("datetime", local_date(to_col(observed_at, "timestamp")))
    rows = payloads.where(F.col("code") == 200).select(
        day.alias("_day"), F.posexplode("result.data").alias("_pos", "_r")
    )
    rows = rows.select(
        F.trim("_r.companyId").alias("ticker"),
        F.trim(F.coalesce("_r.subject", F.lit(""))).alias("source_subject"),
        F.col("_r.time").alias("_time"),
        _absolute(F.col("_r.url")).alias("source_url"),
        "_day",
        "_pos",
    )
    rows = rows.where(
        (F.coalesce("ticker", F.lit("")) != "")
        & is_revenue_subject("source_subject")
        & ~is_correction("source_subject")
    )
    rows = computed(
        rows,
        {
            "month": month_from_subject("source_subject", to_col(expected_month, "date")),
            "reported_date": feed_date(F.coalesce("_time", F.lit("")), "_day"),
            "reported_time": clock_text("_time"),
        },
    )
    rows = computed(rows, {"reported_at": local_to_utc("reported_date", "reported_time")})
    kept = rows.where(F.col("month").isNotNull() & F.col("reported_at").isNotNull()).drop("_time", "_day")
    return earliest(kept, ["ticker", "month"], "reported_at", "_pos").drop("_pos")


def scan_current_feed(spark: SparkSession, path: str, expected_month, observed_at) -> DataFrame:
    return feed_records(read_payloads(spark, path, FEED_SCHEMA), expected_month, observed_at)


def article_rows(payloads: DataFrame) -> DataFrame:
    """All pages' articles as rows."""
    return payloads.where(F.col("statusCode") == 200).select(F.explode("items.data").alias("a")).select("a.*")


def article_records(articles: DataFrame) -> DataFrame:
    """Disclosures in article texts: ticker, month, amount and percents.

    Corrections, texts without a disclosure and texts without the ticker mark
    drop out. The earliest copy of each article id stays.
    """
    text = computed(articles, {"_text": decode_text("content")}).where(
        ~is_correction("_text", CORRECTION_ARTICLE) & F.col("_text").rlike(DISCLOSURE)
    )
    codes = F.transform(
        F.coalesce("market", F.array().cast("array<struct<code:string,name:string>>")), lambda m: m["code"]
    )
    at = F.timestamp_seconds("publishAt")
    parts = computed(
        text,
        {
            "_d": match_groups(F.regexp_extract("_text", DISCLOSURE, 0), DISCLOSURE, 4),
            "_printed": printed_ticker("_text"),
            "_listed": listed_tickers(codes),
            "published_at": at,
            "record_id": F.col("newsId").cast("string"),
        },
    )
    parts = computed(parts, {"ticker": resolve_ticker("_printed", "_listed")})
    group = lambda i: F.col("_d")[i]
    amount = unit_amount(group(2), group(3))
    rows = parts.where(carries_ticker("_text", "ticker")).select(
        "ticker",
        month_of(group(0), group(1)).alias("month"),
        "published_at",
        local_date("published_at").alias("published_date"),
        local_time("published_at").alias("published_time"),
        "record_id",
        F.concat(F.lit(ARTICLE_PAGE), "record_id").alias("source_url"),
        decode_title("title").alias("source_title"),
        amount["value"].alias("revenue"),
        amount["tolerance"].alias("tolerance"),
        percent_after("_text", "月增率").alias("mom"),
        percent_after("_text", "年增率").alias("yoy"),
    )
    good = rows.where(
        F.col("month").isNotNull()
        & F.col("revenue").isNotNull()
        & F.col("published_at").isNotNull()
        & F.col("record_id").isNotNull()
    )
    return earliest(good, ["record_id"], "published_at", "ticker")


def scan_articles(spark: SparkSession, path: str) -> DataFrame:
    return article_records(article_rows(read_payloads(spark, path, ARTICLE_SCHEMA)))


def _title_pattern(company: str) -> str:
    return rf"(?i)^{company} Reports ({'|'.join(MONTH_NAMES)}) (\d{{4}}) Revenue$"


def _release_head(df: DataFrame, name: str, company: str) -> dict[str, Column]:
    pattern = _title_pattern(company)
    title = F.trim(F.coalesce(F.col(name), F.lit("")))
    return {
        "source_title": title,
        "month": month_from_name(F.regexp_extract(title, pattern, 1), F.regexp_extract(title, pattern, 2)),
    }


def release_archive_records(payloads: DataFrame, company: str = "ASPEED", ticker: str = "5274") -> DataFrame:
    """Revenue releases listed on the archive pages."""
    rows = payloads.where("success").select(F.explode("data").alias("_d")).select("_d.*")
    at = F.try_to_timestamp("postTime")
    return (
        rows.withColumns(_release_head(rows, "name", company))
        .where(F.col("month").isNotNull())
        .select(
            F.lit(ticker).alias("ticker"),
            "month",
            F.trim("_id").alias("record_id"),
            "source_title",
            at.alias("published_at"),
            local_date(at).alias("published_date"),
            local_time(at).alias("published_time"),
            F.concat(F.lit(RELEASE_PAGE), F.trim("_id")).alias("source_url"),
        )
    )


def release_records(payloads: DataFrame, company: str = "ASPEED", ticker: str = "5274") -> DataFrame:
    """Five metrics of each press release; ``rejects`` names what is missing."""
    rows = payloads.select("success", "data.*")
    rows = rows.withColumn("_text", decode_release("content"))
    part = lambda pattern, i: F.regexp_extract("_text", pattern, i)
    at = F.try_to_timestamp("postTime")
    typed = rows.withColumns(_release_head(rows, "name", company)).withColumns(
        {
            "ticker": F.lit(ticker),
            "record_id": F.when(F.trim("_id") != "", F.trim("_id")),
            "published_at": at,
            "published_date": local_date(at),
            "published_time": local_time(at),
            "source_url": F.concat(F.lit(RELEASE_PAGE), F.trim("_id")),
            "revenue": millions(part(RELEASE_REVENUE, 1)),
            "mom": signed_percent(part(RELEASE_MOM, 1), part(RELEASE_MOM, 2)),
            "yoy": signed_percent(part(RELEASE_YOY, 1), part(RELEASE_YOY, 2)),
            "ytd": millions(part(RELEASE_YTD, 1)),
            "ytd_yoy": signed_percent(part(RELEASE_YTD, 3), part(RELEASE_YTD, 2)),
        }
    )
    wrong = {
        "success": ~F.coalesce("success", F.lit(False)),
        "type": ~F.col("type").eqNullSafe(3),
        "ticker": ~F.col("_text").rlike(rf"(?i)(?:TWSE|TPEX)\s*:\s*{ticker}\b"),
        **{c: F.col(c).isNull() for c in ("month", "record_id", "published_at", "revenue", "mom", "yoy", "ytd", "ytd_yoy")},
    }
    rejects = F.array_compact(F.array(*[F.when(t, F.lit(c)) for c, t in wrong.items()]))
    return typed.select(
        "ticker",
        "month",
        "record_id",
        "source_title",
        "published_at",
        "published_date",
        "published_time",
        "source_url",
        "revenue",
        "mom",
        "yoy",
        "ytd",
        "ytd_yoy",
        rejects.alias("rejects"),
    )


def daily_rates(payloads: DataFrame) -> DataFrame:
    """Valid daily rates; the last entry of a date wins.

    Impossible dates, non-numbers and rates outside the plausible range drop
    out. Payloads may carry a ``payload_no`` that says which one is later.
    """
    updated = iso_date(F.substring("meta.last_updated", 1, 10))
    number = F.col("payload_no") if "payload_no" in payloads.columns else F.lit(0)
    rows = payloads.select(
        updated.alias("source_updated"), number.alias("_no"), F.posexplode("data.dataSets").alias("_pos", "_r")
    )
    typed = rows.select(
        compact_date(F.try_element_at("_r", F.lit(1))).alias("date"),
        F.try_element_at("_r", F.lit(2)).try_cast("double").alias("rate"),
        F.struct("_no", "_pos").alias("pos"),
        "source_updated",
    )
    valid = typed.where(F.col("date").isNotNull() & F.col("rate").between(*RATE_RANGE))
    return last_wins(valid, ["date"], "pos").drop("pos")


def scan_daily_fx(spark: SparkSession, path: str) -> DataFrame:
    """Daily rates from files; a source without any valid rate is an error."""
    rates = daily_rates(read_payloads(spark, path, RATE_SCHEMA))
    if not rates.take(1):
        raise FeedError(f"No valid daily rates in {path}")
    return rates


def rate_records(monthly, source_updated=None, retrieved_at=None) -> DataFrame:
    """Monthly averages in the shape of the stored rate table."""
    return monthly.withColumns(
        {
            "method": F.lit(RATE_METHOD),
            "source_name": F.lit(RATE_SOURCE),
            "source_url": F.lit(RATE_PAGE),
            "source_updated": F.lit(source_updated).cast("date"),
            "retrieved_at": F.lit(retrieved_at).cast("timestamp"),
        }
    )
