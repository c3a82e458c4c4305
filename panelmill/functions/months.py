"""Reporting months, local time and release calendars as Column functions.

A reporting month is a DATE on the first of the month. Its *month index*
(year * 12 + month - 1) turns calendar arithmetic into integer arithmetic, so
window frames can be RANGE frames over real calendar distance.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOCAL_ZONE = "Asia/Taipei"
#: The zone has one offset, all year.
LOCAL_OFFSET, LOCAL_SECONDS = "+08:00", 8 * 3600
ROC_OFFSET = 1911

# English month names, in calendar order.
MONTH_NAMES = (
    "january", "february", "march", "april", "may", "june",
    "july", "august", "september", "october", "november", "december",
)

# First and last day of each release window in the month after
# the reporting month; None stands for the last day of that month.
RELEASE_WINDOWS = ((1, 4), (5, 7), (8, 10), (11, 15), (16, None))

DEADLINE_DAY = 10

# The white space that source texts may hold, as a character class.
SPACES = "\\s\\p{Z}\ufeff"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_start(c) -> Column:
    """First day of the month of a date or timestamp."""
    return F.trunc(_col(c).cast("date"), "MM")


def month_index(c) -> Column:
    """Calendar index of a month: consecutive months differ by one."""
    c = _col(c)
    return (F.year(c) * 12 + F.month(c) - 1).cast("int")


def month_of_index(i) -> Column:
    """Inverse of :func:`month_index`."""
    i = _col(i)
    return F.make_date(F.floor(i / 12).cast("int"), (F.pmod(i, F.lit(12)) + 1).cast("int"), F.lit(1))


def month_label(c) -> Column:
    """``yyyy-MM`` text of a month, for sinks."""
    return F.date_format(_col(c), "yyyy-MM")


def _cast_date(text: Column, shape: str) -> Column:
    """Text of a known shape to a date; other shapes and impossible dates are null.

    The cast's own parser is far cheaper than a formatter pattern, but lenient
    about shapes, hence the check.
    """
    return F.regexp_extract(text, shape, 0).try_cast("date")


def parse_month(c) -> Column:
    """``yyyy-MM-01`` text to a month; anything else is null."""
    return _cast_date(_col(c), r"^\d{4}-\d{2}-01$")


def month_from_name(name, year) -> Column:
    """English month name (any case, padded) and a year to a month."""
    names = F.array(*[F.lit(m) for m in MONTH_NAMES])
    number = F.array_position(names, F.lower(F.trim(_col(name))))
    text = F.concat(_col(year).cast("string"), F.lit("-"), number.cast("string"), F.lit("-01"))
    return _cast_date(text, r"^\d{4}-\d{1,2}-01$")


def add_month(c, n) -> Column:
    return F.add_months(_col(c), n)


def month_end(c) -> Column:
    return F.last_day(_col(c))


def days_after_month_end(date, month) -> Column:
    """Release offset: days from the end of the reporting month to ``date``."""
    return F.datediff(_col(date), F.last_day(_col(month)))


def local_to_utc(date, time) -> Column:
    """Local date and ``HH:mm:ss`` text to an instant in any session zone; a null time gives null."""
    text = F.concat(_col(date).cast("string"), F.lit(" "), _col(time), F.lit(LOCAL_OFFSET))
    return text.try_cast("timestamp")


def local_timestamp(instant) -> Column:
    """Instant to local wall-clock timestamp."""
    return F.from_utc_timestamp(_col(instant).cast("timestamp"), LOCAL_ZONE)


def _local_seconds(instant) -> Column:
    return F.unix_seconds(_col(instant).cast("timestamp")) + LOCAL_SECONDS


def local_date(instant) -> Column:
    """Local date of an instant, whatever the session zone."""
    return F.date_from_unix_date(F.floor(_local_seconds(instant) / 86400).cast("int"))


def local_time(instant) -> Column:
    """Local ``HH:mm:ss`` of an instant, whatever the session zone."""
    s = F.pmod(_local_seconds(instant), F.lit(86400))
    two = lambda c: F.lpad(F.floor(c).cast("string"), 2, "0")
    text = F.concat_ws(":", two(s / 3600), two(F.pmod(s, F.lit(3600)) / 60), two(F.pmod(s, F.lit(60))))
    return F.when(s.isNotNull(), text)


def month_bounds_utc(month) -> tuple[Column, Column]:
    """UTC instants at which a local month starts and the next one starts."""
    month = _col(month)
    start = lambda day: F.concat(day.cast("date").cast("string"), F.lit(f" 00:00:00{LOCAL_OFFSET}")).cast("timestamp")
    return start(month), start(F.add_months(month, 1))


def target_month(instant) -> Column:
    """The local month before the one an instant falls in."""
    return F.add_months(F.trunc(local_date(instant), "MM"), -1)


def rolling_months(instant, n: int = 12) -> Column:
    """Array of the last ``n`` reporting months, ending at the target month."""
    last = target_month(instant)
    return F.sequence(F.add_months(last, 1 - n), last, F.expr("interval 1 month"))


def gregorian_year(year) -> Column:
    """Two- to four-digit year; anything before 1911 counts from 1911."""
    y = _col(year).try_cast("int")
    return F.when(y < ROC_OFFSET, y + ROC_OFFSET).otherwise(y)


def _shifted_date(c: Column, shape: str, year) -> Column:
    """Date from ``y/m/d`` text whose year part ``year`` turns into a full year.

    ``shape`` has two groups: the year, and the month and day behind it.
    """
    rest = F.translate(F.regexp_extract(c, shape, 2), "/", "-")
    return F.concat(year(F.regexp_extract(c, shape, 1)).cast("string"), F.lit("-"), rest).try_cast("date")


def _from_1911(text: Column) -> Column:
    return text.try_cast("int") + ROC_OFFSET


def roc_month(c) -> Column:
    """``115/7`` to 2026-07-01."""
    return _shifted_date(F.concat(F.trim(_col(c)), F.lit("/01")), r"^(\d{2,3})/(\d{1,2}/01)$", _from_1911)


def roc_date(c) -> Column:
    """``115/08/01`` or ``1150801`` to 2026-08-01."""
    slashed = F.regexp_replace(F.trim(_col(c)), r"^(\d{3})(\d{2})(\d{2})$", "$1/$2/$3")
    return _shifted_date(slashed, r"^(\d{2,3})/(\d{1,2}/\d{1,2})$", _from_1911)


def feed_date(c, default) -> Column:
    """Leading ``y/m/d`` or ``y-m-d`` date of a feed field, else ``default``."""
    c = F.trim(_col(c))
    shape = r"^(\d{2,4})[/-](\d{1,2}[/-]\d{1,2})"
    return F.when(c.rlike(shape), _shifted_date(c, shape, gregorian_year)).otherwise(_col(default))


# What padding an empty time leaves, so that it can become null again.
_NO_TIME = ":00:00:0"


def _full_time(c: Column) -> Column:
    """``HH:mm`` or ``HH:mm:ss`` to the latter; empty text to null."""
    return F.nullif(F.rpad(c, 8, ":00"), F.lit(_NO_TIME))


def clock_text(c) -> Column:
    """First clock time in a text as ``HH:mm:ss``; seconds default to 00."""
    found = F.regexp_extract(_col(c), r"\d{1,2}:\d{2}(?::\d{2})?", 0)
    return _full_time(F.regexp_replace(found, r"^(\d):", "0$1:"))


def time_to_minute(c) -> Column:
    """``HH:mm`` or ``HH:mm:ss`` to minute of day; other text is null."""
    c = _col(c)
    pattern = r"^(\d{2}):(\d{2})(?::\d{2})?$"
    part = lambda i: F.regexp_extract(c, pattern, i).try_cast("int")
    return part(1) * 60 + part(2)


def minute_to_time(c) -> Column:
    """Minute of day, rounded half up and clamped to the day, as ``HH:mm:00``."""
    minute = F.least(F.greatest(F.floor(_col(c) + 0.5), F.lit(0)), F.lit(1439)).cast("int")
    two = lambda n: F.lpad(n.cast("int").cast("string"), 2, "0")
    text = F.concat(two(F.floor(minute / 60)), F.lit(":"), two(minute % 60), F.lit(":00"))
    return F.when(_col(c).isNotNull(), text)


def iso_date(c) -> Column:
    """Leading ``y-m-d`` or ``y/m/d`` of a text, re-checked as a real date."""
    return _cast_date(F.translate(F.trim(_col(c)), "/", "-"), r"^\d{4}-\d{1,2}-\d{1,2}")


def us_date(c) -> Column:
    """Leading ``m/d/yyyy`` of a text, re-checked as a real date."""
    turned = F.regexp_replace(F.trim(_col(c)), r"^(\d{1,2})/(\d{1,2})/(\d{4}).*$", "$3-$1-$2")
    return _cast_date(turned, r"^\d{4}-\d{1,2}-\d{1,2}$")


def compact_date(c) -> Column:
    """``yyyymmdd`` to a date; impossible dates are null."""
    turned = F.regexp_replace(_col(c), r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3")
    return _cast_date(turned, r"^\d{4}-\d{2}-\d{2}$")


def suffix_time(c) -> Column:
    """Clock part behind a ``T`` or a space, as ``HH:mm:ss``."""
    return _full_time(F.regexp_extract(_col(c), r"[T\s](\d{2}:\d{2}(?::\d{2})?)", 1))


def plausible_month(year, month) -> Column:
    return _col(year).between(2000, 2100) & _col(month).between(1, 12)


def in_window(date, month, first: int, last: int) -> Column:
    """True when ``date`` falls ``first``..``last`` days after the month end."""
    return days_after_month_end(date, month).between(first, last)


def release_bucket(date, last_available_day=None) -> Column:
    """Release window ``start-end`` of a date within its month.

    ``last_available_day`` (today's day, for the current month) shortens the
    window it falls into, as later days cannot be covered yet.
    """
    date = _col(date)
    day = F.dayofmonth(date)
    last = F.dayofmonth(F.last_day(date))
    cap = last if last_available_day is None else F.least(last, _col(last_available_day))
    bucket = F.lit(None).cast("string")
    for start, end in RELEASE_WINDOWS:
        upper = last if end is None else F.lit(end)
        label = F.format_string("%d-%d", F.lit(start), F.least(upper, cap))
        bucket = F.when(day.between(F.lit(start), upper), label).otherwise(bucket)
    return F.when(day <= cap, bucket)


def period_bounds(end_month, period_months: int, year_over_year: bool = False) -> dict[str, Column]:
    """First and last month of the current and of the comparison window."""
    end = _col(end_month)
    span = 1 if year_over_year else period_months
    back = 12 if year_over_year else period_months
    return {
        "current_start": F.add_months(end, 1 - span),
        "current_end": end,
        "prior_start": F.add_months(end, 1 - span - back),
        "prior_end": F.add_months(end, -back),
    }


def release_deadlines(months: DataFrame, holidays: DataFrame, month: str = "month") -> DataFrame:
    """Deadline per distinct reporting month.

    The deadline is the last business day on or before the 10th of the next
    month. Each month gets its candidate days; weekends and holidays drop out;
    the latest remaining day wins. ``holidays`` has one DATE column ``holiday``.
    Holidays can shut a whole month, so candidates reach back a year.
    """
    tenth = F.date_add(F.add_months(F.col(month), 1), DEADLINE_DAY - 1)
    days = (
        months.select(month)
        .distinct()
        .withColumn("day", F.explode(F.sequence(F.date_sub(tenth, 365), tenth)))
        .where(F.weekday("day") < 5)
    )
    open_days = days.join(holidays.select(F.col("holiday").alias("day")), "day", "left_anti")
    latest = open_days.groupBy(month).agg(F.max("day").alias("deadline"))
    # A month without any open day in reach keeps its row, with no deadline.
    return months.select(month).distinct().join(latest, month, "left")
