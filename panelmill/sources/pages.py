"""HTML sources: result listings and event calendars, found by pattern."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import choose
from ..functions.months import (
    in_window,
    iso_date,
    local_to_utc,
    month_from_name,
    suffix_time,
    us_date,
)
from ..functions.numbers import signed_percent, unit_amount
from ..functions.text import (
    CORRECTION_ARTICLE,
    decode_calendar,
    decode_text,
    is_correction,
    match_groups,
    month_of,
)
from ..operators.pick import last_wins
from .steps import computed

ANNOUNCEMENT_DAYS = (0, 31)

# Patterns of listing rows, titles and calendar entries.
LISTING_ROW = (
    r"(?iu)<tr[^>]*>\s*<td>\s*<a[^>]+href=\"(?:\.\./|/kmdj/)?news/newsviewer\.aspx\?a=([0-9a-f-]+)\"[^>]*>"
    r"([\s\S]*?)</a>\s*</td>\s*<td[^>]*>(\d{4}-\d{2}-\d{2})\s+(\d{2}:\d{2}:\d{2})</td>\s*</tr>"
)
LISTING_TITLE = (
    r"(?iu)^(.+?)\s+(\d{2,3})年(\d{1,2})月(?:合併)?營收(?:為)?\s*([\d,.]+)\s*(兆|億|萬)?(?:元)?"
    r"(?:、年(增|減)([\d.]+)%?)?\s*$"
)
LISTING_PAGE_LINK = r"(?i)(?:\?|&amp;|&)index1=(\d+)"
LISTING_ARTICLE = "https://www.moneydj.com/kmdj/news/newsviewer.aspx?a="
ATC_EVENT = (
    r"(?i)<var\s+class=[\"']atc_date_start[\"']>\s*([^<]+)</var>[\s\S]*?"
    r"<var\s+class=[\"']atc_title[\"']>\s*([^<]+)</var>"
)
ATC_TITLE = r"(?i)TSMC Monthly Sales\s*-\s*([A-Za-z]+)\s+(\d{4})"
ITEM_TAG = r"(?i)<div\b[^>]*class=[\"'][^\"']*events_calendar_item[^\"']*[\"'][^>]*>"
ITEM_TITLE = r"(?i)\bdata-title=[\"']([^\"']+)[\"']"
ITEM_START = r"(?i)\bdata-start-date=[\"']([^\"']+)[\"']"
ITEM_MONTH = r"(?i)Monthly Sales\s*-\s*([A-Za-z]+)\s+(\d{4})"
OVERVIEW_EVENT = (
    r"(?i)<strong>\s*([A-Za-z]+)\s+(\d{4}),\s*Monthly Sales Announcement\s*</strong>[\s\S]*?"
    r"<div\s+class=[\"']date[\"']>\s*(\d{1,2}/\d{1,2}/\d{4})\*?"
)
OVERVIEW_HEAD = r"(?i)<strong>\s*([A-Za-z]+\s+\d{4}),"
ANNUAL_SECTION = (
    r"(?i)Monthly Sales Announcement\s*-\s*(\d{4})([\s\S]*?)"
    r"(?=Quarterly Earnings Release|Monthly Sales Announcement\s*-\s*\d{4}|\z)"
)
ANNUAL_MONTH = (
    r"(?i)(January|February|March|April|May|June|July|August|September|October|November|December)\s*"
    r"(?:：|:|&#(?:x?ff1a|65306);)\s*(\d{1,2}/\d{1,2}/\d{4})"
)
QUOTED_EVENT = (
    r"(?i)[\"'](Hon Hai[^\"']*?Unaudited Consolidated\s+([A-Za-z]+)\s+(\d{4})\s+Revenue)[\"']\s*,\s*"
    r"[\"'](\d{4}/\d{1,2}/\d{1,2})[\"']"
)
# Where the next entry starts: a page is cut there, so that an entry may be of any length.
ATC_CUT = r"(?i)(?=<var\s+class=[\"']atc_date_start[\"']>)"
OVERVIEW_CUT = r"(?i)(?=<strong>\s*[A-Za-z]+\s+\d{4},|Monthly Sales Announcement\s*-\s*\d{4})"


# What to cut from the matched text of each layout: pattern and group of the
# title, pattern and group of the date, and the pattern that finds month name
# and year in the title (with the section's year behind it).
LAYOUT_RULES = {
    "atc": (ATC_EVENT, 2, ATC_EVENT, 1, ATC_TITLE),
    "item": (ITEM_TITLE, 1, ITEM_START, 1, ITEM_MONTH),
    "overview": (OVERVIEW_HEAD, 1, OVERVIEW_EVENT, 3, r"^([A-Za-z]+) (\d{4})$"),
    "annual": (ANNUAL_MONTH, 1, ANNUAL_MONTH, 2, r"^([A-Za-z]+) (\d{4})$"),
    "quoted": (QUOTED_EVENT, 1, QUOTED_EVENT, 4, r"(?i)Unaudited Consolidated\s+([A-Za-z]+)\s+(\d{4})\s+Revenue"),
}


def extract_all(df: DataFrame, text: str, pattern: str, groups: dict[str, int]) -> DataFrame:
    """One row per match of ``pattern``, with its groups and position.

    The whole text is searched once; groups are cut from the short matches.
    """
    found = df.withColumn("_all", F.regexp_extract_all(text, F.lit(pattern), 0)).drop(text)
    rows = found.select(
        *[c for c in found.columns if c != "_all"], F.posexplode("_all").alias("pos", "_match")
    )
    rows = rows.withColumn("_g", match_groups("_match", pattern, max(groups.values())))
    return rows.withColumns({name: F.col("_g")[i - 1] for name, i in groups.items()}).drop("_match", "_g")


def listing_records(pages: DataFrame, html: str = "html") -> DataFrame:
    """Revenue headlines of result-listing pages.

    The headline gives company name, month, amount and year-over-year percent;
    corrections and other headlines drop out. The ticker comes from a name map.
    """
    rows = extract_all(pages, html, LISTING_ROW, {"_id": 1, "_title": 2, "_date": 3, "_time": 4})
    rows = computed(rows, {"source_title": decode_text("_title")}).where(
        ~is_correction("source_title", CORRECTION_ARTICLE) & F.col("source_title").rlike(LISTING_TITLE)
    )
    rows = computed(rows, {"_g": match_groups("source_title", LISTING_TITLE, 7)})
    part = lambda i: F.col("_g")[i - 1]
    amount = unit_amount(part(4), part(5), default_scale=1)
    date = iso_date("_date")
    typed = rows.select(
        F.trim(part(1)).alias("company_name"),
        month_of(part(2).try_cast("int") + 1911, part(3)).alias("month"),
        local_to_utc(date, F.col("_time")).alias("published_at"),
        date.alias("published_date"),
        F.col("_time").alias("published_time"),
        F.lower("_id").alias("record_id"),
        F.concat(F.lit(LISTING_ARTICLE), F.lower("_id")).alias("source_url"),
        "source_title",
        amount["value"].alias("revenue"),
        amount["tolerance"].alias("tolerance"),
        F.lit(None).cast("double").alias("mom"),
        signed_percent(part(6), part(7)).alias("yoy"),
    )
    return typed.where(F.col("month").isNotNull() & F.col("revenue").isNotNull())


def last_page(pages: DataFrame, html: str = "html") -> DataFrame:
    """Pages with the highest page number they link to (at least 1)."""
    numbers = F.transform(
        F.regexp_extract_all(html, F.lit(LISTING_PAGE_LINK), 1), lambda x: x.try_cast("int")
    )
    return pages.withColumn("last_page", F.greatest(F.lit(1), F.array_max(numbers))).drop(html)


def _tagged(layout: str, matches: Column) -> Column:
    return F.transform(matches, lambda m: F.struct(F.lit(layout).alias("layout"), F.lit("").alias("year"), m.alias("text")))


def _layout_matches(html: Column) -> dict[str, Column]:
    """Calendar parser name to the matches its layouts find."""
    every = lambda pattern, text=html: F.regexp_extract_all(text, F.lit(pattern), 0)
    each = lambda pattern, cut: F.flatten(F.transform(F.split(html, cut), lambda entry: every(pattern, entry)))
    annual = F.flatten(
        F.transform(
            every(ANNUAL_SECTION),
            lambda s: F.transform(
                F.regexp_extract_all(s, F.lit(ANNUAL_MONTH), 0),
                lambda m: F.struct(
                    F.lit("annual").alias("layout"),
                    F.regexp_extract(s, ANNUAL_SECTION, 1).alias("year"),
                    m.alias("text"),
                ),
            ),
        )
    )
    return {
        "tsmc": _tagged("atc", each(ATC_EVENT, ATC_CUT)),
        "mediatek": _tagged("item", every(ITEM_TAG)),
        "umc": F.concat(_tagged("overview", each(OVERVIEW_EVENT, OVERVIEW_CUT)), annual),
        "honhai": _tagged("quoted", every(QUOTED_EVENT)),
    }


def calendar_records(pages: DataFrame, html: str = "html", parser: str = "parser_name") -> DataFrame:
    """Announced release dates on company calendar pages.

    Each page's ``parser_name`` picks the layout. The reporting month in the
    title must fit the date: 0 to 31 days after the month ends. A repeated
    (month, date, time) of a page counts once. Other page columns are kept.
    """
    none = F.array().cast("array<struct<layout:string,year:string,text:string>>")
    matches = none
    for name, found in _layout_matches(F.col(html)).items():
        matches = F.when(F.col(parser) == name, found).otherwise(matches)
    carried = [c for c in pages.columns if c != html]
    rows = pages.select(*carried, F.posexplode(matches).alias("_pos", "_e")).select(*carried, "_pos", "_e.*")
    rule = lambda n: choose("layout", {name: r[n] for name, r in LAYOUT_RULES.items()})
    extract = lambda c, pattern, group: F.call_function("regexp_extract", F.col(c), pattern, group)
    cut = computed(
        rows,
        {
            "title": decode_calendar(extract("text", rule(0), rule(1))),
            "date_text": extract("text", rule(2), rule(3)),
        },
    )
    named = cut.withColumn("_named", F.concat_ws(" ", "title", F.nullif("year", F.lit(""))))
    name_part = lambda group: extract("_named", rule(4), F.lit(group))
    suffixed = F.concat("_named", F.lit(", Monthly Sales Announcement"))
    events = computed(
        named,
        {
            "month": month_from_name(name_part(1), name_part(2)),
            "announced_date": F.coalesce(iso_date("date_text"), us_date("date_text")),
            "announced_time": suffix_time("date_text"),
            "title": F.when(F.col("layout").isin("overview", "annual"), suffixed).otherwise(F.col("title")),
        },
    )
    fitting = events.where(
        F.coalesce(in_window("announced_date", "month", *ANNOUNCEMENT_DAYS), F.lit(False))
    ).withColumn("announced_at", local_to_utc("announced_date", "announced_time"))
    one = last_wins(fitting, [*carried, "month", "announced_date", "announced_time"], "_pos")
    return one.select(*carried, "month", "announced_date", "announced_time", "announced_at", "title")


def empty_calendars(pages: DataFrame, events: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Calendar pages on which no event was found; each is an error."""
    return pages.join(events.select(*keys).distinct(), list(keys), "left_anti")
