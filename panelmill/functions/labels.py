"""Source bases, their ranks and their display labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .months import _col

# Report-date bases and their source priority (1 is best).
REPORT_DATE_PRIORITY = {
    "mops_current_feed": 1,
    "mops_revenue_announcement": 1,
    "mops_first_observed": 2,
    "company_ir_monthly_revenue": 2,
    "ir_calendar_matched": 3,
    "cnyes_revenue_news": 4,
    "moneydj_revenue_news": 4,
}
OFFICIAL_EXACT = ("mops_current_feed", "mops_revenue_announcement")
EXACT_BASES = OFFICIAL_EXACT + ("company_ir_monthly_revenue",)
PROXY_BASES = ("cnyes_revenue_news", "moneydj_revenue_news")

# Publication-timestamp basis that an exact or proxy date earns.
PUBLICATION_BASIS = {
    "mops_current_feed": "MOPS_CURRENT_REPORT_FEED_EXACT",
    "mops_revenue_announcement": "MOPS_MATERIAL_ANNOUNCEMENT_EXACT",
    "company_ir_monthly_revenue": "COMPANY_IR_MONTHLY_REVENUE_EXACT",
    "cnyes_revenue_news": "CNYES_PUBLICATION_CORROBORATED_PROXY",
    "moneydj_revenue_news": "MONEYDJ_PUBLICATION_CORROBORATED_PROXY",
}
FIRST_OBSERVED = "MOPS_ARCHIVE_FIRST_OBSERVED"
ARCHIVE_ONLY = "MOPS_ARCHIVE_HTTP_LAST_MODIFIED_CURRENT_VERSION"

# Display label of each publication basis.
PUBLICATION_LABELS = {
    "MOPS_CURRENT_REPORT_FEED_EXACT": "Exact MOPS time",
    "MOPS_MATERIAL_ANNOUNCEMENT_EXACT": "Exact MOPS announcement",
    "COMPANY_IR_MONTHLY_REVENUE_EXACT": "Exact company IR time",
    "MOPS_ARCHIVE_FIRST_OBSERVED": "First observed",
    "CNYES_PUBLICATION_CORROBORATED_PROXY": "Cnyes public-web proxy",
    "MONEYDJ_PUBLICATION_CORROBORATED_PROXY": "MoneyDJ public-web proxy",
    "MOPS_ARCHIVE_HTTP_LAST_MODIFIED_CURRENT_VERSION": "Original time unavailable",
}

# Listing markets in order of priority.
MARKET_PRIORITY = {"sii": 1, "otc": 2, "rotc": 3, "pub": 4}


def choose(c, mapping: dict, default=None) -> Column:
    """Look a code up in a small literal mapping, as one CASE expression."""
    c = _col(c)
    out = None
    for key, value in mapping.items():
        out = F.when(c == key, F.lit(value)) if out is None else out.when(c == key, F.lit(value))
    return out if default is None else out.otherwise(default)


def basis_priority(c) -> Column:
    return choose(c, REPORT_DATE_PRIORITY)


def migrated_priority(c) -> Column:
    """Priority given to dates stored before priorities covered every source."""
    return choose(c, {"mops_revenue_announcement": 1, "mops_first_observed": 2}, 3)


def exact_flag(c) -> Column:
    return _col(c).isin(*EXACT_BASES).cast("int")


def history_kind(c) -> Column:
    """Kind of a release date: company calendar, public proxy, or actual."""
    c = _col(c)
    return (
        F.when(c == "ir_calendar_matched", "ir")
        .when(c.isin(*PROXY_BASES), "proxy")
        .otherwise("actual")
    )


def label_publication(c) -> Column:
    c = _col(c)
    return F.coalesce(choose(c, PUBLICATION_LABELS), c, F.lit("Not available"))


def label_schedule(source, samples) -> Column:
    """Label of a schedule source; history splits by its sample count."""
    source, samples = _col(source), F.coalesce(_col(samples), F.lit(0))
    history = (
        F.when(samples >= 3, "Historical estimate")
        .when(samples > 0, "Blended estimate")
        .otherwise("Market fallback")
    )
    return (
        F.when(F.coalesce(source, F.lit("")) == "", "Not available")
        .when(source == "ir_calendar", "IR calendar")
        .when(source == "actual_first_seen", "Actual")
        .when(source == "company_history", history)
        .when(source.isin("regulatory_prior", "late_roll_forward"), "Regulatory deadline")
        .otherwise(F.replace(source, F.lit("_"), F.lit(" ")))
    )


def export_timestamp(instant, basis) -> Column:
    """Publication instant for exports; hidden when only the archive knows it."""
    return F.when(_col(basis) == ARCHIVE_ONLY, F.lit(None)).otherwise(_col(instant))
