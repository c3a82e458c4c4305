"""Shards of near-equal bytes by sampled splitters (operator 7).

Records are range-partitioned by the hash of their text, so equal texts meet. The
ranges' limits are quantiles of a sample in which a record's chance grows with
its size. A text that fills ranges of its own gets a range to itself. Then all
records are counted: each range is cut into cells, by text or, where one text
fills it, by document; cells that go together are put into shards, largest first,
each into the emptiest shard. A range that is more than a shard can hold is
overfull and is subdivided at its cells.

The driver sees the sample and one row for each cell, both bounded by the
parameters below. Slots are numbered within cells, after the exact counts of the
cells before them, so no shard is ever in one task.

Defined results: a null text has size 1 and the checksum of no bytes; rows with
equal ids and texts are separate records with adjacent slots; an empty table
gives an empty one; ``assign`` ignores other columns, ``write_shards`` keeps them.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import stored, text_of, unit

RANGES, CELLS, SAMPLE = 512, 32, 16384


def records(docs: DataFrame) -> DataFrame:
    text = text_of()
    return docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.xxhash64(text).alias("key"),
    )


def splitters(rows: DataFrame, ranges: int = RANGES, sample: int = SAMPLE) -> tuple[list[int], list[int]]:
    """Upper ends of ranges, and the keys that have a range to themselves.

    About ``sample`` records are drawn, each with a chance in proportion to its
    size, which depends on its id and text alone.
    """
    total = rows.agg(F.sum("size")).first()[0] or 0
    chance = F.col("size") * (sample / max(total, 1))
    drawn = rows.where(unit(F.col("doc_id"), F.col("key"), F.lit("splitters")) < chance).select("key", F.greatest(chance, F.lit(1.0)).alias("weight"))
    by_key = drawn.groupBy("key").agg(F.sum("weight").alias("weight")).toPandas().sort_values("key")
    key, weight = by_key["key"].to_numpy(np.int64), by_key["weight"].to_numpy(float)
    if not len(key):
        return [], []
    share = weight.sum() / ranges
    alone = key[weight >= 2 * share]
    ends = key[np.searchsorted(np.cumsum(weight), share * np.arange(1, ranges), side="left").clip(max=len(key) - 1)]
    return sorted({int(x) for x in ends} | {int(x) - 1 for x in alone} | {int(x) for x in alone}), sorted(map(int, alone))


def _placed(rows: DataFrame, ends: list[int], alone: list[int], cells: int) -> DataFrame:
    limits, single = np.array(ends, np.int64), np.array(alone, np.int64)

    @F.pandas_udf("int")
    def range_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(limits, key.to_numpy(np.int64), side="left"))

    @F.pandas_udf("boolean")
    def is_alone(key: pd.Series) -> pd.Series:
        return pd.Series(np.isin(key.to_numpy(np.int64), single))

    by_text, by_doc = unit(F.col("key"), F.lit("cell")), unit(F.col("doc_id"), F.lit("cell"))
    rows = rows.withColumn("range", range_of("key")).withColumn("alone", is_alone("key"))
    return rows.withColumn("cell", F.floor(F.when(F.col("alone"), by_doc).otherwise(by_text) * cells).cast("int"))


def pack(counts: pd.DataFrame, shards: int) -> pd.DataFrame:
    """Shard and first slot of every cell.

    A range that fits into a shard stays together; an overfull one is cut into
    as few near-equal parts as it needs.
    """
    counts = counts.sort_values(["range", "cell"]).reset_index(drop=True)
    capacity = counts["bytes"].sum() / shards
    whole = counts.groupby("range")["bytes"].transform("sum")
    parts = np.ceil(whole / max(capacity, 1)).clip(lower=1)
    middle = counts.groupby("range")["bytes"].cumsum() - counts["bytes"] / 2
    counts["part"] = np.minimum(np.floor(middle / (whole / parts)), parts - 1).astype(int)
    units = counts.groupby(["range", "part"], as_index=False)["bytes"].sum()
    units = units.sort_values(["bytes", "range", "part"], ascending=[False, True, True])
    fill, shard = np.zeros(shards), []
    for size in units["bytes"]:
        shard.append(int(fill.argmin()))
        fill[shard[-1]] += size
    units["shard"] = shard
    counts = counts.merge(units[["range", "part", "shard"]], on=["range", "part"]).sort_values(["shard", "range", "cell"])
    counts["start"] = counts.groupby("shard")["rows"].cumsum() - counts["rows"]
    return counts[["range", "cell", "shard", "start"]]


def assign(docs: DataFrame, shards: int = 8, ranges: int = RANGES, cells: int = CELLS) -> DataFrame:
    """doc_id, size, text_crc32, key, shard and slot of every record."""
    rows = stored(records(docs))
    ends, alone = splitters(rows, ranges)
    placed = stored(_placed(rows, ends, alone, cells))
    counts = placed.groupBy("range", "cell").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).toPandas()
    if counts.empty:
        return placed.select("doc_id", "size", "text_crc32", "key", F.col("cell").alias("shard"), F.col("size").alias("slot"))
    where = pack(counts, shards).astype({"shard": "int32", "start": "int64", "range": "int32", "cell": "int32"})
    # One row for each cell: 16,384 with the defaults, whatever the input.
    where = F.broadcast(docs.sparkSession.createDataFrame(where, "range int, cell int, shard int, start long"))
    order = W.partitionBy("range", "cell").orderBy("key", "doc_id", "size")
    got = placed.withColumn("_row", F.row_number().over(order)).join(where, ["range", "cell"])
    return got.select("doc_id", "size", "text_crc32", "key", "shard", (F.col("start") + F.col("_row") - 1).alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = 8) -> None:
    """Records in one folder a shard, all columns as they were.

    Equal rows are interchangeable, so a record's place is found by its id and
    its text; the first of several equal ones takes the first of their slots.
    """
    place = assign(docs, shards).select("doc_id", "key", "shard", "slot")
    twins = W.partitionBy("doc_id", "key")
    place = place.withColumn("_twin", F.row_number().over(twins.orderBy("slot")))
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), "doc_id", F.xxhash64(text_of()).alias("key"))
    row = row.withColumn("_twin", F.row_number().over(twins.orderBy(F.lit(0))))
    same = row["doc_id"].eqNullSafe(place["doc_id"]) & (row["key"] == place["key"]) & (row["_twin"] == place["_twin"])
    got = row.join(place, same).select("_row", place["shard"], place["slot"])
    got = got.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    got.select("shard", "slot", F.col("_row").alias("record")).write.partitionBy("shard").parquet(path)


def op7_sharding(spark, sf_dir: str) -> DataFrame:
    got = assign(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return got.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
