"""Entity x month panels: calendar lags, windows, momentum, currency.

A panel has one row per (entity, month). Frames are RANGE frames over the
month index, so gaps count as gaps. After the aggregation that makes a panel,
an entity holds at most one row per calendar month, which bounds every
per-entity window here whatever the raw row counts were.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.months import add_month, month_index, month_of_index
from ..functions.numbers import direction, growth_pct, js_round
from ..sources.steps import must
from .pick import top_per_key

# Period id, window length in months, display labels.
PERIODS = (
    ("mom", 1, "MoM", "MoM"),
    ("yoy", 1, "YoY", "YoY"),
    ("3m", 3, "3M", "3M/3M"),
    ("6m", 6, "6M", "6M/6M"),
    ("ltm", 12, "LTM", "LTM YoY"),
)
MIX = "mix"
RECENT_MONTHS = 3


def with_index(df: DataFrame, month: str = "month") -> DataFrame:
    return df.withColumn("idx", month_index(month))


def _calendar(entity: str = "entity"):
    return W.partitionBy(entity).orderBy("idx")


def lagged(value, months: int, entity: str = "entity") -> Column:
    """Value exactly ``months`` calendar months earlier, or null."""
    return F.max(value).over(_calendar(entity).rangeBetween(-months, -months))


def by_entity(df: DataFrame, entity: str = "entity") -> DataFrame:
    """Partition a panel by entity once, for all windows and joins that follow.

    A panel holds at most one row per month and entity, so no entity is large.
    """
    return df.repartition(entity)


def reported_facts(panel: DataFrame) -> DataFrame:
    """Derive the reported metrics of each month from (entity, month, revenue)."""
    p = with_index(by_entity(panel))
    year = W.partitionBy("entity", F.year("month")).orderBy("idx").rowsBetween(W.unboundedPreceding, 0)
    p = p.withColumn("ytd", F.sum("revenue").over(year))
    return p.select(
        "entity",
        "month",
        "idx",
        "revenue",
        "ytd",
        js_round(growth_pct("revenue", lagged("revenue", 1)), 4).alias("mom"),
        js_round(growth_pct("revenue", lagged("revenue", 12)), 4).alias("yoy"),
        js_round(growth_pct("ytd", lagged("ytd", 12)), 4).alias("ytd_yoy"),
    )


def densify(panel: DataFrame, values: Sequence[str] = ("revenue",), start=None, end=None) -> DataFrame:
    """A row for every entity and month from ``start`` to ``end``.

    Bounds default to the months of the panel. Each row expands over the gap
    behind it, the first row also over the months before it, so no join and no
    second shuffle are needed. Values of added months are null.
    """
    if start is None or end is None:
        bounds = panel.agg(F.struct(F.min("month").alias("lo"), F.max("month").alias("hi")).alias("b")).scalar()
    lo = bounds["lo"] if start is None else F.lit(start).cast("date")
    hi = bounds["hi"] if end is None else F.lit(end).cast("date")
    p = with_index(by_entity(panel))
    first = F.when(F.lag("idx").over(_calendar()).isNull(), month_index(lo)).otherwise(F.col("idx"))
    last = F.coalesce(F.lead("idx").over(_calendar()) - 1, month_index(hi))
    spread = p.withColumns({"_first": first, "_last": last}).withColumn(
        "_i", F.explode(F.sequence("_first", "_last"))
    )
    kept = [F.when(F.col("_i") == F.col("idx"), F.col(v)).alias(v) for v in values]
    return spread.select("entity", month_of_index("_i").alias("month"), F.col("_i").alias("idx"), *kept)


def period_sum(value, months: int, lag: int = 0, entity: str = "entity") -> Column:
    """Sum over a complete window of ``months`` ending ``lag`` months back.

    Null as soon as one month of the window is missing or has a null value.
    """
    frame = _calendar(entity).rangeBetween(-(lag + months - 1), -lag)
    return F.when(F.count(value).over(frame) == months, F.sum(value).over(frame))


def complete_sums(dense: DataFrame, windows: dict[str, tuple[int, int]], value: str = "revenue") -> DataFrame:
    """Columns named by ``windows``, each the sum over a complete window of (length, lag).

    ``dense`` has a row for every month between an entity's first and last, as
    :func:`densify` returns it, so lags by rows are lags by months. A long window
    is added up from shorter ones and their lags; a missing month makes every
    sum over it null. This visits far fewer rows than a frame for each window.
    """
    if dict(dense.dtypes)[value] not in ("tinyint", "smallint", "int", "bigint"):
        # Sums that depend on the order of adding stay frames.
        return dense.withColumns({name: period_sum(value, n, lag) for name, (n, lag) in windows.items()})
    back = lambda c, k: F.lag(c, k).over(_calendar()) if k else F.col(c)
    sums, out = {1: "_sum1"}, dense.withColumn("_sum1", F.col(value).cast("long"))
    for n in sorted({n for n, _ in windows.values()} - {1}):
        part = max(k for k in sums if n % k == 0)
        pieces = [back(sums[part], k) for k in range(0, n, part)]
        sums[n] = f"_sum{n}"
        out = out.withColumn(sums[n], reduce(lambda a, b: a + b, pieces))
    lags = {name: back(sums[n], lag) for name, (n, lag) in windows.items()}
    return out.withColumns(lags).drop(*sums.values())


def window_momentum(panel: DataFrame, periods=PERIODS) -> DataFrame:
    """Momentum of every entity, month and period (long form)."""
    windows = {
        f"{period}_{role}": window
        for period, months, *_ in periods
        for role, window in _windows(period, months).items()
    }
    return _long_momentum(complete_sums(densify(panel), windows), ["entity", "month"], periods)


def _windows(period: str, months: int) -> dict[str, tuple[int, int]]:
    """(length, lag) of the four sums that a period compares."""
    if period == "yoy":
        return {"cur": (1, 0), "prior": (1, 12), "before": (1, 1), "base": (1, 13)}
    return {
        "cur": (months, 0),
        "prior": (months, months),
        "before": (months, months),
        "base": (months, 2 * months),
    }


def _long_momentum(wide: DataFrame, keys: Sequence[str], periods=PERIODS) -> DataFrame:
    roles = ("cur", "prior", "before", "base")
    # Growths are computed once behind the explode, not in five structs for every row.
    sums = [
        F.struct(F.lit(period).alias("period"), *[F.col(f"{period}_{role}").alias(f"_{role}") for role in roles])
        for period, *_ in periods
    ]
    picked = wide.select(*keys, F.explode(F.array(*sums)).alias("m")).select(*keys, "m.*")
    grown = picked.withColumns({"_now": growth_pct("_cur", "_prior"), "_then": growth_pct("_before", "_base")})
    out = grown.select(
        *keys,
        "period",
        F.col("_cur").alias("current_revenue"),
        F.col("_prior").alias("prior_revenue"),
        js_round("_now", 2).alias("current_growth"),
        js_round("_then", 2).alias("previous_growth"),
        js_round(F.col("_now") - F.col("_then"), 2).alias("acceleration"),
    )
    return out.withColumn("direction", direction("acceleration"))


def latest_month(facts: DataFrame) -> Column:
    """Latest month of a panel, as a scalar subquery."""
    return facts.agg(F.max("month")).scalar()


def _recent(facts: DataFrame, recent: int) -> list[tuple[Column, Column]]:
    """(key, month) of the latest month of a panel and the ones before it."""
    last = latest_month(facts)
    months = [add_month(last, -back) for back in range(recent)]
    return [(F.date_format(m, "yyyy-MM"), m) for m in months]


def analysis_spine(dim: DataFrame, facts: DataFrame, recent: int = RECENT_MONTHS) -> DataFrame:
    """Entity x analysis key: each entity's own latest month, and recent months.

    Columns: the dim columns, ``key`` and ``analysis_month`` (null for an
    entity without facts under the mix key).
    """
    own = facts.groupBy("entity").agg(F.max("month").alias("_own"))
    keys = [F.struct(F.lit(MIX).alias("key"), F.col("_own").alias("analysis_month"))]
    keys += [F.struct(k.alias("key"), m.alias("analysis_month")) for k, m in _recent(facts, recent)]
    spread = dim.join(own, "entity", "left").withColumn("_k", F.explode(F.array(*keys)))
    return spread.select(*dim.columns, "_k.key", "_k.analysis_month")


def key_grid(dim: DataFrame, facts: DataFrame, recent: int = RECENT_MONTHS) -> DataFrame:
    """Dim x analysis key with the fixed months; the mix month is left null."""
    none = F.lit(None).cast("date")
    keys = [F.struct(F.lit(MIX).alias("key"), none.alias("_fixed"))]
    keys += [F.struct(k.alias("key"), m.alias("_fixed")) for k, m in _recent(facts, recent)]
    return dim.withColumn("_k", F.explode(F.array(*keys))).select(*dim.columns, "_k.key", "_k._fixed")


def keyed_facts(facts: DataFrame, recent: int = RECENT_MONTHS, reach: int = 0) -> DataFrame:
    """Facts under every analysis key they are within ``reach`` months of.

    Adds ``key`` and ``_back``, the months from the fact to the key's month.
    The facts are read once: an entity's own latest month comes from a window
    in the partitioning that the facts already have.
    """
    dated = with_index(facts).withColumn("_own", F.max("idx").over(W.partitionBy("entity")))
    ends = [F.struct(F.lit(MIX).alias("key"), F.col("_own").alias("_end"))]
    ends += [F.struct(k.alias("key"), month_index(m).alias("_end")) for k, m in _recent(facts, recent)]
    last = month_index(latest_month(facts))
    close = (F.col("idx") >= F.col("_own") - reach) | (F.col("idx") > last - recent - reach)
    spread = dated.where(close).withColumn("_k", F.explode(F.array(*ends)))
    back = (F.col("_k._end") - F.col("idx")).alias("_back")
    return spread.select(*facts.columns, "_k.key", back).where(F.col("_back").between(0, reach))


def latest_per_entity(facts: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns of each entity's latest month, even when some are null."""
    return facts.groupBy("entity").agg(*[F.max_by(c, "month").alias(c) for c in columns])


def momentum(dim: DataFrame, facts: DataFrame, recent: int = RECENT_MONTHS, periods=PERIODS) -> DataFrame:
    """Momentum snapshot per entity, analysis key and period.

    ``dim`` has (entity, classification, ...); ``facts`` has (entity, month,
    revenue, mom, yoy, ytd_yoy). Every fact within reach of an analysis month
    adds to that key's window sums: one aggregation gives all fourteen windows,
    with no dense spine and no join of facts with facts.
    """
    reach = max(lag + n - 1 for p, m, *_ in periods for n, lag in _windows(p, m).values())
    near = keyed_facts(facts, recent, reach)
    sums = []
    done: dict[tuple[int, int], str] = {}
    for period, months, *_ in periods:
        for length, lag in _windows(period, months).values():
            if (length, lag) in done:
                continue
            name = done[(length, lag)] = f"_w{length}_{lag}"
            value = F.when(F.col("_back").between(lag, lag + length - 1), F.col("revenue"))
            sums.append(F.when(F.count(value) == length, F.sum(value)).alias(name))
    at = lambda c, back=0: F.max(F.when(F.col("_back") == back, F.col(c)))
    attributes = {
        "latest_month": at("month"),
        "latest_revenue": at("revenue"),
        "mom_percent": at("mom"),
        "yoy_percent": at("yoy"),
        "previous_yoy_percent": at("yoy", 1),
        "ytd_yoy_percent": at("ytd_yoy"),
    }
    wide = near.groupBy("entity", "key").agg(*sums, *[v.alias(k) for k, v in attributes.items()])
    joined = key_grid(dim, facts, recent).join(wide, ["entity", "key"], "left")
    named = {
        f"{period}_{role}": F.col(done[window])
        for period, months, *_ in periods
        for role, window in _windows(period, months).items()
    }
    # Under the mix key the analysis month is the latest month itself.
    joined = joined.withColumn("analysis_month", F.coalesce("_fixed", "latest_month"))
    keys = [*dim.columns, "key", "analysis_month", *attributes]
    return _long_momentum(joined.withColumns(named), keys, periods)


def translate(facts: DataFrame, rates: DataFrame) -> DataFrame:
    """Add USD revenue and the running USD total of each calendar year.

    The total is added up unrounded and rounded for output. A month without
    revenue has no USD figures and does not reset the total. Months without a
    rate keep null figures here; ``quality.missing_rates`` reports them and
    :func:`translate_checked` refuses them.
    """
    fx = rates.select(
        "month",
        F.col("average_rate"),
        F.col("observations").alias("fx_observations"),
        F.col("last_date").alias("fx_last_date"),
    )
    # One row per calendar month, the one with the most observations; that bounds the broadcast.
    fx = top_per_key(fx, ["month"], [F.desc("fx_observations"), F.desc("fx_last_date"), F.asc("average_rate")])
    joined = facts.join(F.broadcast(fx), "month", "left")
    usd = F.col("revenue") / F.col("average_rate")
    running = F.sum("_usd").over(
        W.partitionBy("entity", F.year("month")).orderBy("month").rowsBetween(W.unboundedPreceding, 0)
    )
    return (
        joined.withColumn("_usd", usd)
        .withColumn("revenue_usd", js_round("_usd", 2))
        .withColumn("ytd_usd", F.when(F.col("_usd").isNotNull(), js_round(running, 2)))
        .drop("_usd")
    )


def translate_checked(facts: DataFrame, rates: DataFrame) -> DataFrame:
    """As :func:`translate`; a row without a rate fails the job, whatever columns are read."""
    checked = translate(facts, rates)
    message = F.concat(F.lit("Missing exchange rate for "), F.date_format("month", "yyyy-MM"))
    return must(checked, F.col("average_rate").isNotNull(), message)


def in_currency(translated: DataFrame, currency: str) -> DataFrame:
    """Show revenue and its yearly total in one currency; growth never changes."""
    usd = currency.upper() == "USD"
    return translated.withColumns(
        {
            "shown_revenue": F.col("revenue_usd") if usd else F.col("revenue").cast("double"),
            "shown_ytd": F.col("ytd_usd") if usd else F.col("ytd").cast("double"),
            "shown_rate": F.col("average_rate") if usd else F.lit(None).cast("double"),
        }
    )


def tail_rows(df: DataFrame, n: int | None, entity="entity", month="month") -> DataFrame:
    """Last ``n`` rows (not calendar months) of every series; None keeps all."""
    from .pick import retain_latest

    return df if n is None else retain_latest(df, n, entity, month)


def previous_yoy(facts: DataFrame) -> DataFrame:
    """Each month's YoY beside the calendar month before."""
    return with_index(facts).withColumn("previous_yoy", lagged("yoy", 1))


def check_ascending(series: DataFrame, seq: str = "seq", entity="entity", month="month", segment: int = 4096) -> DataFrame:
    """Rows whose month does not rise above the row before, in ``seq`` order.

    Long series are checked in segments of ``seq``: inside a segment with a
    lag, and across segments by carrying each one's last month forward, so no
    task needs a whole series.
    """
    cut = series.withColumn("_seg", F.floor(F.col(seq) / segment))
    inside = cut.withColumn(
        "_before", F.lag(month).over(W.partitionBy(entity, "_seg").orderBy(seq))
    )
    ends = cut.groupBy(entity, "_seg").agg(F.max_by(month, seq).alias("_last"))
    carried = ends.select(
        entity, "_seg", F.lag("_last").over(W.partitionBy(entity).orderBy("_seg")).alias("_carry")
    )
    before = F.coalesce("_before", "_carry")
    return (
        inside.join(carried, [entity, "_seg"])
        .where(F.col(month) <= before)
        .drop("_seg", "_before", "_carry")
    )
