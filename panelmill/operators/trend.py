"""Seasonal adjustment, inflection against trend, concentration, chained indexes.

Entities are partitioned once; every window over an entity or a group holds at most
as many rows as the calendar has months. ``facts`` has one row per entity and month:
(entity, month, idx, revenue, ytd), idx counting months.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .pick import top_per_key


def _months(low: int, high: int):
    """The months from ``low`` to ``high`` of each row's own, as a range of values: gaps stay gaps."""
    return W.partitionBy("entity").orderBy("idx").rangeBetween(low, high)


def seasonal_growth(facts: DataFrame) -> DataFrame:
    """Month factors, adjusted revenue and its growth on the month before, in percent.

    A month's ratio to its centred moving average (half of both end months, 13 months in
    all) needs all 13. A calendar month's factor is the mean of its ratios; an entity's
    twelve factors are scaled to a mean of 1. Entities that lack a factor, and months
    whose month before is absent, have nulls.
    """
    calendar = F.pmod("idx", F.lit(12))
    inner = F.sum("revenue").over(_months(-5, 5))
    outer = F.sum("revenue").over(_months(-6, 6))
    whole = F.count("*").over(_months(-6, 6)) == 13
    rows = facts.select("entity", "month", "idx", "revenue", calendar.alias("_calendar"), F.when(whole & (inner + outer > 0), 24 * F.col("revenue") / (inner + outer)).alias("_ratio"))
    means = rows.groupBy("entity", "_calendar").agg(F.avg("_ratio").alias("_mean"))
    every = means.groupBy("entity").agg(F.count("_mean").alias("_n"), F.sum("_mean").alias("_sum"), F.map_from_entries(F.collect_list(F.struct("_calendar", "_mean"))).alias("_means"))
    # One row an entity, joined on the key the panel is partitioned by.
    joined = rows.join(every, "entity", "left")
    factor = F.when((F.col("_n") == 12) & (F.col("_sum") > 0), F.element_at("_means", F.col("_calendar")) * 12 / F.col("_sum"))
    adjusted = joined.withColumn("factor", factor).withColumn("_adjusted", F.when(F.col("factor") > 0, F.col("revenue") / F.col("factor")))
    before = F.first("_adjusted").over(_months(-1, -1))
    growth = F.when(before > 0, (F.col("_adjusted") / before - 1) * 100)
    return adjusted.select("entity", "month", "revenue", F.round("factor", 6).alias("factor"), F.round("_adjusted", 2).alias("adjusted"), F.round(growth, 6).alias("adjusted_growth"))


def median(values: Column) -> Column:
    """Median of an array without nulls; null if it is empty."""
    ordered, n = F.sort_array(values), F.size(values)
    low, high = F.get(ordered, F.floor((n - 1) / 2).cast("int")), F.get(ordered, F.floor(n / 2).cast("int"))
    return (low + high) / 2


def pairwise_slopes(points: Column) -> Column:
    """Slopes between all pairs of an array of (idx, revenue); meant for a bounded window."""
    later = lambda a: F.transform(F.filter(points, lambda b: b["idx"] > a["idx"]), lambda b: (b["revenue"] - a["revenue"]) / (b["idx"] - a["idx"]))
    return F.flatten(F.transform(points, later))


def inflections(facts: DataFrame, recent: int = 6, base: int = 12, threshold: float = 3.0, least: float = 2 / 3) -> DataFrame:
    """Slope of the latest months against the trend before them, for every entity and month.

    Slopes are medians of pairwise slopes, in revenue a month: ``recent`` over the latest
    ``recent`` months, ``trend`` over the ``base`` months before. The score is their difference
    over the median distance of the trend's own pairwise slopes from it; beyond
    ``threshold`` the entity inflects up or down. Windows with less than ``least`` of their months, and
    trends without spread, give nulls.
    """
    points = lambda low, high: F.collect_list(F.struct("idx", "revenue")).over(_months(low, high))
    rows = facts.select("entity", "month", points(1 - recent, 0).alias("_now"), points(1 - recent - base, -recent).alias("_then"))
    enough = (F.size("_now") >= least * recent) & (F.size("_then") >= least * base)
    rows = rows.where(enough).select("entity", "month", median(pairwise_slopes(F.col("_now"))).alias("recent"), pairwise_slopes(F.col("_then")).alias("_slopes"))
    rows = rows.withColumn("trend", median(F.col("_slopes")))
    spread = median(F.transform("_slopes", lambda s: F.abs(s - F.col("trend"))))
    rows = rows.withColumn("spread", spread)
    score = F.when(F.col("spread") > 0, (F.col("recent") - F.col("trend")) / F.col("spread"))
    turn = F.when(F.col("score") >= threshold, "up").when(F.col("score") <= -threshold, "down").when(F.col("score").isNotNull(), "none")
    rows = rows.withColumn("score", F.round(score, 6)).withColumn("inflection", turn)
    return rows.select("entity", "month", F.round("recent", 4).alias("recent"), F.round("trend", 4).alias("trend"), "score", "inflection")


def _with_before(facts: DataFrame, months: int) -> DataFrame:
    """Facts with the revenue of the same entity so many months before, if it is there."""
    return facts.withColumn("before", F.first("revenue").over(_months(-months, -months)))


def concentration(facts: DataFrame, bridge: DataFrame, top: int = 3) -> DataFrame:
    """How far a group's month depends on its largest members.

    Yearly growth of the members that have both years, and the same without the one
    that is largest this month (the smallest entity of equal ones); share of the ``top`` largest;
    sum of squared shares times 10,000; members. All come from sums, two maxima and a ranking that keeps
    ``top`` rows a group and task, so no group is held as a whole.
    """
    keys = ["classification", "month"]
    rows = _with_before(facts, 12).select("entity", "month", "revenue", "before").join(bridge.select("entity", "classification"), "entity")
    both = F.col("before").isNotNull()
    largest = F.max(F.when(both, F.struct("revenue", (-F.col("entity")).alias("_entity"), "before")))
    square = (F.col("revenue").cast("decimal(19,0)") * F.col("revenue").cast("decimal(19,0)")).cast("decimal(38,0)")
    sums = rows.groupBy(*keys).agg(
        F.count("*").alias("members"), F.sum("revenue").alias("revenue"), F.sum(square).alias("_squares"),
        F.sum(F.when(both, F.col("revenue"))).alias("_now"), F.sum("before").alias("_then"), largest.alias("_largest"),
    )
    leaders = top_per_key(rows.select(*keys, "entity", "revenue"), keys, [F.desc("revenue"), F.asc("entity")], top)
    leaders = leaders.groupBy(*keys).agg(F.sum("revenue").alias("_top"))
    growth = lambda now, then: F.round(F.when(then > 0, (now / then - 1) * 100), 6)
    rest_now, rest_then = F.col("_now") - F.col("_largest.revenue"), F.col("_then") - F.col("_largest.before")
    total = F.col("revenue").cast("double")
    return sums.join(leaders, keys).select(
        *keys, "members", "revenue", growth(F.col("_now"), F.col("_then")).alias("yoy"), growth(rest_now, rest_then).alias("yoy_ex_largest"),
        F.round(F.when(total > 0, F.col("_top") * 100 / total), 6).alias("top_share"),
        F.round(F.when(total > 0, F.col("_squares").cast("double") / total / total * 10000), 4).alias("herfindahl"),
    )


def chained_index(facts: DataFrame, bridge: DataFrame) -> DataFrame:
    """Index of each group, linked month by month over the members that have both months.

    Members who join or leave change no link. A link is this month's revenue over the last
    month's of the same members; the index is 100 times the product of links, as a sum of logarithms.
    Where a month has no link, a new chain begins at 100.
    """
    keys = ["classification", "month"]
    rows = _with_before(facts, 1).select("entity", "month", "revenue", "before").join(bridge.select("entity", "classification"), "entity")
    both = F.col("before").isNotNull()
    sums = rows.groupBy(*keys).agg(F.sum(F.when(both, F.col("revenue"))).alias("_now"), F.sum("before").alias("_then"), F.count_if(both).alias("matched"))
    link = F.when((F.col("_then") > 0) & (F.col("_now") > 0), F.col("_now") / F.col("_then"))
    # A group has one row a month here.
    in_order = W.partitionBy("classification").orderBy("month").rowsBetween(W.unboundedPreceding, W.currentRow)
    linked = sums.withColumn("_link", link).withColumn("chain", F.count_if(F.col("_link").isNull()).over(in_order))
    of_chain = W.partitionBy("classification", "chain").orderBy("month").rowsBetween(W.unboundedPreceding, W.currentRow)
    index = 100 * F.exp(F.sum(F.coalesce(F.log("_link"), F.lit(0.0))).over(of_chain))
    return linked.select(*keys, "matched", F.round("_link", 6).alias("link"), "chain", F.round(index, 6).alias("index"))


def quarter_totals(facts: DataFrame) -> DataFrame:
    """Each entity's quarters from its months, against what its cumulative figures say.

    ``by_ytd`` is the cumulative figure at the quarter's last month less the one at the quarter before;
    it is null where either is absent, except for first quarters. ``difference`` is what the months miss of it.
    """
    quarter = F.floor(F.col("idx") / 3).cast("int")
    rows = facts.groupBy("entity", quarter.alias("quarter_no")).agg(
        F.min("month").alias("_first"), F.count("*").alias("months"), F.sum("revenue").alias("revenue"), F.max(F.when(F.pmod("idx", F.lit(3)) == 2, F.col("ytd"))).alias("_ytd")
    )
    before = F.first("_ytd").over(W.partitionBy("entity").orderBy("quarter_no").rangeBetween(-1, -1))
    by_ytd = F.when(F.pmod("quarter_no", F.lit(4)) == 0, F.col("_ytd")).otherwise(F.col("_ytd") - before)
    rows = rows.withColumn("by_ytd", by_ytd)
    return rows.select("entity", F.trunc("_first", "quarter").alias("quarter"), "months", "revenue", "by_ytd", (F.col("revenue") - F.col("by_ytd")).alias("difference"))
