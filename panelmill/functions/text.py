"""Text predicates, clean-up, hashes and identifiers."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .months import SPACES, _col, gregorian_year, plausible_month

# Patterns over source text, one group per concept.
CORRECTION_ARCHIVE = r"(?iu)更正|重新公告|修正|重編|correct|restat|revis"
CORRECTION_ARTICLE = r"(?iu)更正|重編|修正|correct|restat"
CORRECTION_NOTE = r"(?iu)更正|重新公告|修正|重編"
REVENUE_SUBJECT = (
    r"(?iu)月(?:份)?(?:自結)?(?:合併)?(?:營收|營業收入)"
    r"|monthly\s+(?:sales|revenue|operating\s+revenue)"
)
HOLIDAY_TEXT = r"放假|補假|休市|無交易"
HAN = r"[㐀-鿿]"

# Placeholder texts for notes without an English version yet.
PENDING_NOTE = "Translation pending; consult the official MOPS source record."
PENDING_CORRECTION_NOTE = (
    "Translation pending; the official MOPS note indicates a correction or restatement."
)

# Entity spellings and what they stand for.
BASIC_ENTITIES = (
    ("&amp;", "&"),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;|&apos;", "'"),
)
CALENDAR_ENTITIES = (
    ("&amp;", "&"),
    ("&quot;", '"'),
    ("&#0*39;|&apos;", "'"),
    ("&nbsp;", " "),
    ("&#x2019;|&#8217;", "'"),
    ("[‘’]", "'"),
)
RELEASE_ENTITIES = (
    ("&nbsp;|&#160;", " "),
    ("&amp;", "&"),
    ("&quot;", '"'),
    ("&#39;|&apos;", "'"),
)


def squeeze(c) -> Column:
    """Collapse every run of Unicode whitespace to one space, and trim."""
    return F.trim(F.regexp_replace(_col(c), f"[{SPACES}]+", " "))


def trim_all(c) -> Column:
    """Trim Unicode whitespace."""
    return F.regexp_replace(_col(c), f"^[{SPACES}]+|[{SPACES}]+$", "")


def _replace_all(c: Column, pairs) -> Column:
    for pattern, value in pairs:
        c = F.regexp_replace(c, "(?i)" + pattern, value.replace("\\", "\\\\"))
    return c


def decode_text(c) -> Column:
    """Entities first, then tags to spaces, then whitespace."""
    decoded = _replace_all(F.coalesce(_col(c), F.lit("")), BASIC_ENTITIES)
    return squeeze(F.regexp_replace(decoded, "<[^>]*>", " "))


def decode_title(c) -> Column:
    """As :func:`decode_text`, with search-hit marks removed first."""
    return decode_text(F.regexp_replace(F.coalesce(_col(c), F.lit("")), "(?i)</?mark>", ""))


def decode_calendar(c) -> Column:
    return squeeze(_replace_all(_col(c), CALENDAR_ENTITIES))


def decode_release(c) -> Column:
    """Tags to spaces first, then entities, then whitespace."""
    plain = F.regexp_replace(F.coalesce(_col(c), F.lit("")), "<[^>]*>", " ")
    return squeeze(_replace_all(plain, RELEASE_ENTITIES))


def is_correction(c, pattern: str = CORRECTION_ARCHIVE) -> Column:
    return F.coalesce(_col(c).rlike(pattern), F.lit(False))


def is_revenue_subject(c) -> Column:
    return F.coalesce(_col(c).rlike(REVENUE_SUBJECT), F.lit(False))


def has_han(c) -> Column:
    return F.coalesce(_col(c).rlike(HAN), F.lit(False))


def month_from_subject(c, default) -> Column:
    """Reporting month named in a subject line, else ``default``."""
    c = F.coalesce(_col(c), F.lit(""))
    roc, iso = r"(\d{2,4})\s*年\s*(\d{1,2})\s*月", r"\b(20\d{2})[/-](\d{1,2})\b"
    part = lambda pattern, i: F.regexp_extract(c, pattern, i)

    def month(year, number):
        number = number.try_cast("int")
        ok = year.isNotNull() & number.between(1, 12)
        return F.when(ok, F.make_date(year, number, F.lit(1)))

    return (
        F.when(c.rlike(roc), month(gregorian_year(part(roc, 1)), part(roc, 2)))
        .when(c.rlike(iso), month(part(iso, 1).try_cast("int"), part(iso, 2)))
        .otherwise(_col(default))
    )


def month_of(year, number) -> Column:
    """Month from year and month text, null outside the plausible range."""
    year, number = gregorian_year(year), _col(number).try_cast("int")
    return F.when(plausible_month(year, number), F.make_date(year, number, F.lit(1)))


def printed_ticker(text) -> Column:
    """First ticker mark in a text, or empty text."""
    return F.regexp_extract(_col(text), r"(?i)(\d{4,5})-TW", 1)


def listed_tickers(codes) -> Column:
    """Market codes that look like tickers."""
    return F.filter(F.transform(_col(codes), lambda t: F.trim(t)), lambda t: t.rlike(r"^\d{4,5}$"))


def resolve_ticker(printed, listed) -> Column:
    """Ticker of an article, from its text and its market list.

    The printed ticker wins if the list has it; else a single listed ticker;
    else the printed one. ``carries_ticker`` then checks the text.
    """
    printed, listed = _col(printed), _col(listed)
    return (
        F.when(F.array_contains(listed, printed), printed)
        .when(F.size(listed) == 1, F.try_element_at(listed, F.lit(1)))
        .otherwise(printed)
    )


def carries_ticker(text, ticker) -> Column:
    """True when the text has the ticker as ``(ticker-TW)``."""
    ticker = _col(ticker)
    return (ticker != "") & F.contains(_col(text), F.concat(F.lit("("), ticker, F.lit("-TW)")))


def match_groups(c, pattern: str, groups: int) -> Column:
    """Groups of a pattern that matches the whole text, in one pass, as an array."""
    joined = "\u0001".join(f"${i}" for i in range(1, groups + 1))
    return F.split(F.regexp_replace(_col(c), pattern, joined), "\u0001")


@F.pandas_udf(T.StringType())
def nfkc(s: pd.Series) -> pd.Series:
    """Unicode compatibility composition; Spark has no built-in for it."""
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x))


@F.pandas_udf(T.StringType())
def nfkd(s: pd.Series) -> pd.Series:
    """Unicode compatibility decomposition; Spark has no built-in for it."""
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFKD", x))


def name_key(c, fold: bool = True) -> Column:
    """Company-name key: compatibility form, no whitespace, lower case.

    ``fold=False`` skips the compatibility step, for text known to be in it.
    """
    c = F.coalesce(_col(c), F.lit(""))
    return F.lower(F.regexp_replace(nfkc(c) if fold else c, f"[{SPACES}]+", ""))


def expand_roc_years(c) -> Column:
    """Year marks counted from 1911 become Gregorian years followed by a space."""
    # Split so that every year mark starts a new piece, then rewrite its number.
    marked = F.regexp_replace(_col(c), r"(?<!\d)(\d{2,3})\s*年", "\u0001$1\u0002")
    pieces = F.split(marked, "\u0001")

    def rewrite(piece):
        year = F.regexp_extract(piece, "^(\\d{2,3})\u0002", 1).try_cast("int")
        rest = F.regexp_replace(piece, "^\\d{2,3}\u0002", "")
        return (
            F.when(year.between(1, 199), F.concat((year + 1911).cast("string"), F.lit(" "), rest))
            .otherwise(F.regexp_replace(piece, "\u0002", "年"))
        )

    return F.array_join(F.transform(pieces, rewrite), "")


def ascii_clean(c) -> Column:
    """Typographic marks to ASCII, accents folded, the rest dropped."""
    c = F.translate(_col(c), "‘’“”–— ", "''\"\"-- ")
    c = F.regexp_replace(nfkd(c), "[̀-ͯ]", "")
    return squeeze(F.regexp_replace(c, r"[^\x09\x0A\x0D\x20-\x7E]", ""))


def normalise_units(c) -> Column:
    """Spell out the currency of amounts in thousands."""
    return F.regexp_replace(
        _col(c), r"(?i)\b(?:thousand yuan|NTD thousand)\b", "thousand New Taiwan dollars"
    )


def pending_note(c) -> Column:
    return F.when(is_correction(c, CORRECTION_NOTE), PENDING_CORRECTION_NOTE).otherwise(PENDING_NOTE)


def finished_note(candidate, source) -> Column:
    """``struct(english, status)`` for a note and its candidate English text.

    A candidate that is empty, or still has CJK text, leaves the note pending.
    """
    candidate = _col(candidate)
    cleaned = normalise_units(ascii_clean(candidate))
    done = F.coalesce((candidate != "") & ~has_han(candidate) & (cleaned != ""), F.lit(False))
    return F.struct(
        F.when(done, cleaned).otherwise(pending_note(source)).alias("english"),
        F.when(done, "complete").otherwise("pending").alias("status"),
    )


def row_hash(*cols) -> Column:
    """SHA-256 of the ordered raw cells as a JSON array; null cells stay null."""
    return F.sha2(F.to_json(F.array(*[_col(c).cast("string") for c in cols])), 256)


def text_hash(c) -> Column:
    return F.sha2(_col(c).cast("string"), 256)
