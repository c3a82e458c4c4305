"""Picking rows per key, retention, and exact global ranks.

``row_number() <= n`` over a key becomes a partial group limit before the
shuffle, so a hot key sends at most n rows per input task.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.labels import MARKET_PRIORITY, choose


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """First ``n`` rows of every key in ``order``; make ``order`` total."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def retain_latest(df: DataFrame, n: int = 12, entity="entity", month="month") -> DataFrame:
    """Rows of the latest ``n`` months of each entity; one row per month."""
    return top_per_key(df, [entity], [F.desc(month)], n)


def retain_latest_distinct(df: DataFrame, n: int = 12, entity="entity", month="month") -> DataFrame:
    """All rows of the latest ``n`` distinct months of each entity.

    The months are reduced to one cut-off per entity first, so the many rows of
    a busy entity never meet in one window; the join back is splittable.
    """
    months = df.select(entity, month).distinct()
    cutoff = top_per_key(months, [entity], [F.desc(month)], n).groupBy(entity).agg(
        F.min(month).alias("_from")
    )
    return df.join(cutoff, entity).where(F.col(month) >= F.col("_from")).drop("_from")


def best_by_priority(df: DataFrame, keys: Sequence[str], priority="source_priority", row_id="event_id") -> DataFrame:
    """One row per key: lowest source priority number, then the newest id."""
    return top_per_key(df, keys, [F.asc(priority), F.desc(row_id)])


def earliest(df: DataFrame, keys: Sequence[str], ts: str, *tie_break: str) -> DataFrame:
    """Earliest row of every key; ties go to the first in ``tie_break`` order."""
    return top_per_key(df, keys, [F.asc(ts), *[F.asc(c) for c in tie_break]])


def last_wins(df: DataFrame, keys: Sequence[str], position: str) -> DataFrame:
    """The row with the highest position of every key."""
    return top_per_key(df, keys, [F.desc(position)])


def pick_market(rows: DataFrame, keys: Sequence[str] = ("ticker", "month"), market="market", row_no="row_no") -> DataFrame:
    """One row per key: best listing market, then file order."""
    order = choose(market, MARKET_PRIORITY, 99)
    return top_per_key(rows, list(keys), [order.asc(), F.asc(row_no)])


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder: the session's own, set here only if unset.

    Without one, a session on a single machine gets a local folder; a cluster is
    refused, because its machines do not see each other's disks.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not configured and not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        context.setCheckpointDir(configured or "spark-checkpoints")
    return configured or context.getCheckpointDir()


def new_folder(spark: SparkSession) -> str:
    """Path of a new folder inside the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/panelmill/{uuid.uuid4()}"


def stored(df: DataFrame) -> DataFrame:
    """Frame written once as a table in the shared checkpoint folder.

    It cuts the lineage for several readers; being columnar, each reads only
    the columns it needs, and the planner knows its size. Losing an executor
    later costs nothing that was written.
    """
    folder = new_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def global_rank(df: DataFrame, order: Sequence[Column], name: str = "rank") -> DataFrame:
    """Exact 1..N rank over all rows without one global window.

    Rows are range-partitioned and sorted, and stored by a checkpoint so that
    both passes below see the same partitions. Row numbers inside a partition
    plus the sizes of the partitions before it give the rank.
    """
    ensure_checkpoint_dir(df.sparkSession)
    # A checkpoint, not a table: files read back could be split or merged.
    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order).checkpoint()
    # The id holds the partition in its high bits and the row in the low 33.
    placed = ordered.withColumn("_id", F.monotonically_increasing_id())
    part = F.shiftrightunsigned("_id", 33).alias("_part")
    placed = placed.select("*", part, F.col("_id").bitwiseAND((1 << 33) - 1).alias("_row"))
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_size"))
    # One row per partition, so this unpartitioned window is bounded by their number.
    before = F.sum("_size").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1))
    starts = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_start"))
    ranked = placed.join(F.broadcast(starts), "_part")
    return ranked.withColumn(name, F.col("_start") + F.col("_row") + 1).drop(
        "_id", "_part", "_row", "_start"
    )


def rank_history(history: DataFrame, seq: str | None = None) -> DataFrame:
    """One item per entity and month: actual before proxy before calendar.

    ``seq`` keeps the first of equal kinds.
    """
    rank = choose("kind", {"ir": 0, "proxy": 1, "actual": 2}, -1)
    order = [rank.desc()] + ([F.asc(seq)] if seq else [F.asc("release_date")])
    return top_per_key(history, ["entity", "month"], order)
