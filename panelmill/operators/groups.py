"""Multi-label roll-ups: bridges, growth series, snapshots, constituents."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import js_round
from ..functions.text import trim_all
from .panel import MIX, key_grid, keyed_facts
from .pick import global_rank, top_per_key


def build_bridge(universe: DataFrame, labels: str = "labels", separator: str = ";") -> DataFrame:
    """(entity, classification, label_order) from a separated label text."""
    pieces = F.filter(
        F.transform(F.split(labels, separator), lambda x: trim_all(x)), lambda x: x != ""
    )
    return universe.select("entity", F.posexplode(pieces).alias("_pos", "classification")).select(
        "entity", "classification", (F.col("_pos") + 1).alias("label_order")
    )


def unknown_labels(bridge: DataFrame, classes: DataFrame) -> DataFrame:
    """Bridge rows whose label the class dimension does not know."""
    return bridge.join(classes.select("classification"), "classification", "left_anti")


def primary_class(dim: DataFrame, bridge: DataFrame) -> DataFrame:
    """Dim with each entity's first label by (order, name), or Unclassified."""
    first = bridge.groupBy("entity").agg(
        F.min_by("classification", F.struct("label_order", "classification")).alias("classification")
    )
    return dim.join(first, "entity", "left").fillna({"classification": "Unclassified"})


def _exact_avg(c: str):
    """Average of doubles that no order of the rows changes, where all are decimals of at most six digits.

    Other values are averaged as doubles.
    """
    value, exact = F.col(c), F.col(c).try_cast("decimal(19,6)")
    fits = F.count_if(value.isNotNull() & ~exact.cast("double").eqNullSafe(value)) == 0
    return F.when(fits, F.sum(exact).cast("double") / F.count(c)).otherwise(F.avg(c))


def _growth_columns(exact: bool = False):
    """Aggregates that a group's growth figures come from.

    A sum of doubles depends on the order of its rows, so an average on the edge
    of two roundings can differ between two groupings of the same members.
    Growths are rounded decimals; ``exact`` averages them as such, for figures
    that are held against each other.
    """
    positive = F.col("yoy").isNotNull() & (F.col("revenue") > 0)
    return [
        F.coalesce(F.sum("revenue"), F.lit(0)).alias("aggregate_revenue"),
        F.count("revenue").alias("reporting"),
        js_round(_exact_avg("yoy") if exact else F.avg("yoy"), 2).alias("simple_yoy"),
        js_round(
            F.sum(F.when(positive, F.col("yoy") * F.col("revenue")))
            / F.sum(F.when(positive, F.col("revenue"))),
            2,
        ).alias("weighted_yoy"),
    ]


def group_growth(facts: DataFrame, bridge: DataFrame, exact: bool = False) -> DataFrame:
    """Revenue, reporters, simple and revenue-weighted YoY per class and month.

    An entity counts in full in each of its classes. Partial aggregation runs
    before the shuffle, so the size of a class does not matter.
    """
    narrow = facts.select("entity", "month", "revenue", "yoy")
    return (
        narrow.join(bridge.select("entity", "classification"), "entity")
        .groupBy("classification", "month")
        .agg(*_growth_columns(exact))
    )


def snapshot_members(dim: DataFrame, facts: DataFrame, bridge: DataFrame, recent: int = 3) -> DataFrame:
    """Every member of every class under every analysis key.

    Members without a row for the key's month stay, with null figures.
    """
    observed = keyed_facts(facts.select("entity", "month", "revenue", "yoy"), recent).drop("_back")
    labelled = dim.join(bridge.select("entity", "classification"), "entity")
    grid = key_grid(labelled, facts, recent).drop("_fixed")
    return grid.join(observed, ["entity", "key"], "left").withColumnRenamed("month", "reporting_month")


def group_snapshot(members: DataFrame, exact: bool = False) -> DataFrame:
    """Growth figures per class and analysis key; keys without data give sum 0."""
    return members.groupBy("classification", "key").agg(*_growth_columns(exact))


def constituents(members: DataFrame) -> DataFrame:
    """Revenue share and growth contributions of each member.

    Totals are aggregated and joined back rather than taken over a window, so a
    large class is never gathered in one task.
    """
    positive = F.col("yoy").isNotNull() & (F.col("revenue") > 0)
    totals = members.groupBy("classification", "key").agg(
        F.coalesce(F.sum("revenue"), F.lit(0)).alias("_revenue"),
        F.count("yoy").alias("_yoys"),
        F.sum(F.when(positive, F.col("revenue"))).alias("_weights"),
    )
    share = F.when(F.col("_revenue") > 0, F.col("revenue") / F.col("_revenue") * 100)
    simple = F.when(F.col("_yoys") > 0, F.col("yoy") / F.col("_yoys"))
    weighted = F.when(
        positive & (F.col("_weights") > 0), F.col("yoy") * F.col("revenue") / F.col("_weights")
    )
    return (
        members.join(totals, ["classification", "key"])
        .withColumn("revenue_weight", js_round(share, 2))
        .withColumn("simple_contribution", js_round(simple, 2))
        .withColumn("weighted_contribution", js_round(weighted, 2))
        .drop("_revenue", "_yoys", "_weights")
    )


def constituent_order():
    """Sort order of constituents: revenue descending, nulls last, then ticker."""
    return [F.desc_nulls_last("revenue"), F.asc("ticker")]


def leaderboard(snapshot: DataFrame, metric: str = "simple_yoy") -> DataFrame:
    """Classes of one analysis key, ranked by a metric with nulls last."""
    return global_rank(snapshot, [F.desc_nulls_last(metric), F.asc("classification")])


def leaders(snapshot: DataFrame) -> DataFrame:
    """Best class per analysis key by simple and by revenue-weighted growth."""
    metrics = ["simple_yoy", "weighted_yoy"]
    long = snapshot.select(
        "key",
        "classification",
        F.explode(
            F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in metrics])
        ).alias("_m"),
    ).select("key", "classification", "_m.metric", "_m.value")
    return top_per_key(long, ["key", "metric"], [F.desc_nulls_last("value"), F.asc("classification")])


def chart_series(series: DataFrame, snapshot: DataFrame, key: str) -> DataFrame:
    """Monthly series through a fixed month, with its row from the snapshot.

    Under the mix key the series stays whole.
    """
    if key == MIX:
        return series
    month = F.lit(key + "-01").cast("date")
    chosen = snapshot.where(F.col("key") == key).drop("key").withColumn("month", month)
    return series.where(F.col("month") < month).unionByName(chosen.select(*series.columns))


def class_counts(dim: DataFrame) -> DataFrame:
    """Entities per primary class."""
    return dim.groupBy("classification").agg(F.count("*").alias("entities"))
