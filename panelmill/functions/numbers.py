"""Rounding, growth, money and percent parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .months import SPACES, _col

MAX_DOUBLE = 1.7976931348623157e308
MAX_SAFE_INTEGER = 2**53 - 1
PERCENT_TOLERANCE = 0.06

# Scale of each amount unit (trillion, hundred million, ten thousand, one).
AMOUNT_UNITS = {
    "兆元": 1_000_000_000_000,
    "億元": 100_000_000,
    "萬元": 10_000,
    "元": 1,
    "兆": 1_000_000_000_000,
    "億": 100_000_000,
    "萬": 10_000,
}

# Cells that stand for no value, once cleaned.
NULL_TOKEN = "^-{0,2}$"


def js_round(c, digits: int = 0) -> Column:
    """Round half up (toward +infinity); null for null and non-finite values.

    Spark's ``round`` goes half away from zero, which differs for negatives.
    """
    c = _col(c).cast("double")
    factor = float(10**digits)
    # From 2**53 on a double has no fraction, and floor() would leave the range of its result.
    # Ordinary values pass one test and are computed twice, as Spark repeats ``c`` for each mention.
    small = F.abs(c * factor) < float(1 << 53)
    return F.when(small, F.floor(c * factor + 0.5) / factor).when(F.abs(c) <= MAX_DOUBLE, c)


def growth_pct(current, prior) -> Column:
    """Unrounded growth in percent; null if a side is null or prior is zero."""
    prior = _col(prior).cast("double")
    return (_col(current).cast("double") / F.when(prior != 0, prior) - 1) * 100


def direction(acceleration) -> Column:
    """Direction of an already rounded acceleration."""
    a = _col(acceleration)
    return (
        F.when(a > 0, "accelerating")
        .when(a < 0, "decelerating")
        .when(a == 0, "unchanged")
        .otherwise("unavailable")
    )


def _clean(c, percent: bool = False) -> Column:
    """Cell without grouping commas, outer whitespace and, if asked, its % sign."""
    sign = rf"|[{SPACES},]*%,*$" if percent else ""
    return F.regexp_replace(F.coalesce(_col(c), F.lit("")), rf",|^[{SPACES},]+{sign}|[{SPACES},]+$", "")


def no_value(c, percent: bool = False) -> Column:
    """True for a cell that stands for no value."""
    return _clean(c, percent).rlike(NULL_TOKEN)


def parse_thousands(c) -> Column:
    """Text in thousands to whole units; null for null tokens and bad text.

    Up to three decimals stay whole after scaling; larger amounts than a
    double holds exactly are refused.
    """
    shaped = F.regexp_extract(_clean(c), r"^-?\d{1,13}(?:\.\d{1,3}0*)?$", 0)
    value = (shaped.try_cast("decimal(19,3)") * 1000).cast("long")
    return F.when(F.abs(value) <= MAX_SAFE_INTEGER, value)


def bad_cell(raw, typed, required: bool = False, percent: bool = False) -> Column:
    """True when a cell has a value but no typed form, or lacks a required one."""
    missing = F.lit(False) if required else no_value(raw, percent)
    return _col(typed).isNull() & ~missing


def parse_percent(c) -> Column:
    """Percent text (commas, trailing %) to double; null tokens to null."""
    number = r"^[-+]?(?:\d+\.?\d*|\.\d+)(?:[eE][-+]?\d{1,2})?$"
    return F.regexp_extract(_clean(c, percent=True), number, 0).try_cast("double")


def _scale(unit: Column, default) -> Column:
    known = F.create_map(*[F.lit(x) for name, value in AMOUNT_UNITS.items() for x in (name, float(value))])
    scale = F.try_element_at(known, unit)
    return scale if default is None else F.coalesce(scale, F.lit(float(default)))


def unit_amount(text, unit, default_scale=None) -> dict[str, Column]:
    """Amount text with a unit word to ``value`` and ``tolerance``.

    The tolerance is half a unit in the last printed place, plus one. Both are
    null for a bad number, an unknown unit or an amount that is too large.
    """
    digits = F.regexp_replace(_col(text), ",", "")
    scale = _scale(_col(unit), default_scale)
    places = F.length(F.regexp_extract(digits, r"\.(.*)$", 1))
    value = F.floor(digits.try_cast("double") * scale + 0.5)
    half = F.ceil(0.5 * scale * F.pow(F.lit(10.0), -places)) + 1
    return {
        "value": F.when(F.abs(value) <= MAX_SAFE_INTEGER, value).cast("long"),
        "tolerance": F.greatest(F.lit(1), half).cast("long"),
    }


def millions(c) -> Column:
    """Amount text in millions to whole units."""
    return F.floor(F.regexp_replace(_col(c), ",", "").try_cast("double") * 1_000_000 + 0.5).cast("long")


def signed_percent(word, value, negative=("decrease", "減")) -> Column:
    """Percent with the sign told by a direction word."""
    sign = F.when(F.lower(_col(word)).isin(*negative), -1.0).otherwise(1.0)
    return _col(value).try_cast("double") * sign


def percent_after(text, label: str) -> Column:
    """Number with a percent sign right behind a label."""
    pattern = rf"(?iu){label}(?:高達)?\s*(-?\d+(?:\.\d+)?)\s*[%％]"
    return F.regexp_extract(_col(text), pattern, 1).try_cast("double")


def percent_close(a, b, tolerance: float = PERCENT_TOLERANCE) -> Column:
    """True when two percents agree within a tolerance or either is unknown."""
    a, b = _col(a), _col(b)
    return F.coalesce(F.abs(a - b) <= tolerance, F.lit(True))
