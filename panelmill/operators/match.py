"""Matching outside records to facts: names, tolerances, corroboration."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.labels import REPORT_DATE_PRIORITY
from ..functions.months import in_window
from ..functions.numbers import percent_close
from .pick import earliest, stored

PUBLICATION_DAYS = (0, 45)
RELEASE_TOLERANCE = 1000
#: Keys of at most so many distinct observations are matched in one join.
FEW = 8
SO_FAR = (W.unboundedPreceding, W.currentRow)


def name_map(names: DataFrame) -> DataFrame:
    """One ticker per company-name key; the first seen wins.

    ``names`` has (name_key, ticker, month, priority, row_no).
    """
    first = F.min_by("ticker", F.struct("month", "priority", "row_no"))
    return names.groupBy("name_key").agg(first.alias("ticker"))


def map_names(records: DataFrame, names: DataFrame) -> DataFrame:
    """Records with the ticker of their company name; unknown names drop out."""
    return records.join(name_map(names), "name_key")


def unmapped_names(records: DataFrame, names: DataFrame) -> DataFrame:
    return records.join(names.select("name_key"), "name_key", "left_anti")


def tolerance_match(
    claims: DataFrame,
    observations: DataFrame,
    keys: Sequence[str] = ("entity", "month"),
    value: str = "revenue",
    tolerance: str = "tolerance",
    percents: Sequence[str] = (),
    also: Sequence[tuple[str, int]] = (),
) -> DataFrame:
    """Best observation for every claim that one corroborates.

    An observation corroborates a claim with the same keys if the values differ
    by at most the claim's tolerance, every percent agrees or is unknown on a
    side, and every (column, tolerance) of ``also`` agrees. The best one is
    current first, then the lowest id. Null keys, values and tolerances and
    negative tolerances match nothing.

    Equal observations are reduced to one each and stored, gathered by key. A key
    with at most ``FEW`` of them keeps them in one row, which its claims meet in
    a join. Keys with more, if there are any, are matched in blocks
    (``_block_match``), their claims stored first.
    """
    keys, percents = list(keys), list(percents)
    figures = [value, *[c for c, _ in also], *percents]
    matched = [f"matched_{c}" for c in figures]
    rank = F.when(F.col("is_current"), 0).when(~F.col("is_current"), 1).otherwise(2)
    unique = observations.where(F.col(value).isNotNull()).groupBy(*keys, *figures).agg(
        F.min(F.struct(rank.alias("rank"), "obs_id")).alias("_first")
    )
    seen = F.struct("_first.rank", "_first.obs_id", *[F.col(c).alias(m) for c, m in zip(figures, matched, strict=True)])
    place = F.row_number().over(W.partitionBy(*keys).orderBy("_first", *figures))
    placed = unique.select(*keys, seen.alias("_one"), place.alias("_place")).where(F.col("_place") <= FEW + 1)
    many = F.max("_place") > FEW
    by_key = stored(placed.groupBy(*keys).agg(many.alias("_many"), F.when(~many, F.collect_list("_one")).alias("_seen")))

    same = [F.col(f"c.{k}") == F.col(f"m.{k}") for k in keys]
    few = by_key.where(~F.col("_many")).drop("_many")
    claim = lambda c: F.col(f"c.{c}")

    def agrees(o: Column) -> Column:
        near = o[f"matched_{value}"].between(claim(value) - claim(tolerance), claim(value) + claim(tolerance))
        tests = [F.abs(claim(c) - o[f"matched_{c}"]) <= t for c, t in also]
        tests += [percent_close(claim(c), o[f"matched_{c}"]) for c in percents]
        return reduce(lambda a, b: a & b, tests, near)

    best = F.array_min(F.filter("m._seen", agrees))
    current = F.when(F.col("_best.rank") < 2, F.col("_best.rank") == 0)
    found = (
        claims.alias("c")
        .join(few.alias("m"), reduce(lambda a, b: a & b, same))
        .select("c.*", best.alias("_best"))
        .where(F.col("_best").isNotNull())
        .select(
            *claims.columns,
            F.col("_best.obs_id").alias("obs_id"),
            current.alias("is_current"),
            *[F.col(f"_best.{m}").alias(m) for m in matched],
        )
    )
    busy = by_key.where("_many").select(*keys)
    if busy.isEmpty():
        return found
    crowded = stored(claims.join(busy, keys, "left_semi").select(*claims.columns))
    return found.unionByName(_block_match(crowded, unique.join(busy, keys, "left_semi"), keys, value, tolerance, percents, also))


def _block_match(
    claims: DataFrame,
    unique: DataFrame,
    keys: Sequence[str],
    value: str,
    tolerance: str,
    percents: Sequence[str],
    also: Sequence[tuple[str, int]],
) -> DataFrame:
    """Tolerance match of keys with many observations, ``unique`` of ``tolerance_match``.

    Equal claims are reduced to one each before they meet observations, and a claim
    is never paired with the observations of its range; ``claims`` is read three
    times. Values are cut into blocks of 2^k, the widest that fits a claim's whole
    range, so that a range is the end of one block, perhaps a whole block, and the
    start of another. Inside a block both sides are sorted by value, and the best
    observation so far, from the left or from the right, answers a claim.
    Percents and ``also`` are settled before: a claim meets each distinct set of
    them once a block, however many observations share it.
    """
    settled = [c for c, _ in also] + percents
    figures = [value, *settled]
    distinct = claims.where(F.col(tolerance) >= 0).select(*keys, *figures, tolerance).distinct()
    distinct = distinct.withColumn("_level", F.length(F.bin(F.col(tolerance) * 2 + 1)) - 1)

    levels = distinct.select(*keys, "_level").distinct()
    found = [F.col(value).alias(f"matched_{value}"), *[F.col(f"matched_{c}") for c in settled]]
    seen = (
        unique.join(levels, keys)
        .withColumns({"_block": F.expr(f"shiftright({value}, _level)"), **{f"matched_{c}": F.col(c) for c in settled}})
        .withColumn("_best", F.struct("_first.rank", "_first.obs_id", *found))
    )
    place = [*keys, "_level", "_block", *[f"matched_{c}" for c in settled]]

    low, high = F.col(value) - F.col(tolerance), F.col(value) + F.col(tolerance)
    shifted = lambda edge: F.call_function("shiftright", edge, F.col("_level"))
    asking = distinct.withColumn("_block", F.explode(F.sequence(shifted(low), shifted(high))))
    tests = [F.abs(F.col(c) - F.col(f"matched_{c}")) <= t for c, t in also]
    tests += [percent_close(c, f"matched_{c}") for c in percents]
    if settled:
        asking = asking.join(seen.select(*place).distinct(), [*keys, "_level", "_block"])
        asking = asking.where(reduce(lambda a, b: a & b, tests))

    claim = F.struct(*figures, tolerance).alias("_claim")
    from_low = F.col("_block") == shifted(low)
    asking = asking.select(*place, F.when(from_low, low).otherwise(high).alias("_at"), from_low.alias("_up"), claim)
    offered = seen.select(*place, F.col(value).alias("_at"), "_best")
    both = offered.unionByName(asking, allowMissingColumns=True)
    # At one value observations come before claims.
    last = F.col("_claim").isNotNull()
    block = W.partitionBy(*place)
    best = F.when(F.col("_up"), F.min("_best").over(block.orderBy(F.desc("_at"), last).rowsBetween(*SO_FAR)))
    best = best.otherwise(F.min("_best").over(block.orderBy(F.asc("_at"), last).rowsBetween(*SO_FAR)))
    answered = both.withColumn("_best", best).where(last & F.col("_best").isNotNull())
    chosen = answered.groupBy(*keys, "_claim").agg(F.min("_best").alias("_best"))
    chosen = chosen.select(
        *keys,
        "_claim.*",
        F.col("_best.obs_id").alias("obs_id"),
        F.when(F.col("_best.rank") < 2, F.col("_best.rank") == 0).alias("is_current"),
        *[F.col(f"_best.matched_{c}").alias(f"matched_{c}") for c in figures],
    )

    same = [F.col(f"c.{k}").eqNullSafe(F.col(f"m.{k}")) for k in [*keys, *figures, tolerance]]
    return (
        claims.alias("c")
        .join(chosen.alias("m"), reduce(lambda a, b: a & b, same))
        .select("c.*", "m.obs_id", "m.is_current", *[f"m.matched_{c}" for c in figures])
    )


def corroborate(articles: DataFrame, observations: DataFrame, percents: Sequence[str] = ()) -> DataFrame:
    """Articles published in the plausible window that an observation confirms."""
    timely = articles.where(in_window("published_date", "month", *PUBLICATION_DAYS))
    return tolerance_match(timely, observations, percents=percents)


def match_counts(articles: DataFrame, matched: DataFrame) -> DataFrame:
    """One row: articles seen, matched, and rejected."""
    seen = articles.agg(F.count("*")).scalar()
    return matched.agg(F.count("*").alias("matched")).select(
        seen.alias("seen"), "matched", (seen - F.col("matched")).alias("rejected")
    )


def evidence_rows(matched: DataFrame, basis: str, exact: bool, now) -> DataFrame:
    """Matched articles in the shape of the evidence table."""
    rows = matched.withColumns(
        {
            "basis": F.lit(basis),
            "exact": F.lit(int(exact)),
            "first_recorded_at": F.lit(now).cast("timestamp"),
            "updated_at": F.lit(now).cast("timestamp"),
        }
    )
    return earliest(rows, ["basis", "record_id"], "published_at", "entity")


def evidence_dates(matched: DataFrame, basis: str, now) -> DataFrame:
    """Earliest matched article per (entity, month) as an incoming report date."""
    first = earliest(matched, ["entity", "month"], "published_at", "record_id")
    return first.select(
        "entity",
        "month",
        F.col("published_date").alias("reported_date"),
        F.col("published_time").alias("reported_time"),
        F.col("published_at").alias("reported_at"),
        F.lit(basis).alias("basis"),
        F.lit(REPORT_DATE_PRIORITY[basis]).alias("source_priority"),
        "source_url",
        F.col("source_title").alias("source_subject"),
        F.lit(now).cast("timestamp").alias("first_recorded_at"),
        F.lit(now).cast("timestamp").alias("updated_at"),
        "obs_id",
        "is_current",
    )
