"""Weighted fair queueing of sources (operator 8, DataFrame functions only).

Every source offers its documents in a shuffled order, twice over. An item's
virtual finish time is the number of words its source has offered up to and
including it, divided by the source's target. Items are taken in order of finish
time until the budget is full, so at any moment the sources are served in
proportion to their targets, and each ends near its own.

A busy source is cut into 4,096 slices of the shuffled order: sums per slice give
each slice its start, and running sums stay within a slice. Slice and order come
from a hash of id and text, so rows without an id, or with one id, spread over the
slices too. The point of truncation is found from sums per band of finish time: the
band in which the budget ends is cut into bands again, ``LEVELS`` times in all, and
only what is then left is put in order.

Defined results: null and empty texts have size 0 and are never taken; null is a
source of its own, after the others; rows with equal ids are separate documents,
each with its own place; those of equal text as well stand next to each other and are
interchangeable;
no rows or no words give targets of 0; other columns are passed through by
``mix`` and ignored by ``plan``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import WORD, stored, text_of

WEIGHTS = (5, 2, 1)
#: Words to take, as a share of all words, and at most this many times a source.
SHARE, EPOCHS = 1.5, 2
BANDS = 4096
#: After three levels a band is 1/2^36 of a target, fewer words than most documents have.
LEVELS = 3
_SLICE = ["_has", "_source", "_slice"]


def _keyed(docs: DataFrame, doc_id: Column, source: Column, size: Column, text: Column) -> DataFrame:
    """Place of each document in its source's order; ``text`` is the text's hash."""
    key = F.md5(F.concat(F.lit("mix:"), F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"), text))
    return docs.select(
        "*",
        size.alias("_size"),
        source.isNotNull().alias("_has"),
        F.coalesce(source.cast("string"), F.lit("")).alias("_source"),
        key.alias("_key"),
        F.substring(key, 1, 3).alias("_slice"),
    )


def n_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """Target of every source, from (_has, _source, source_size).

    Without limits a source would get its weight's share. Those that reach
    ``EPOCHS`` times their size stop there, in order of size per weight, and the
    rest share what is left at one common level, which is the fixed point of
    resharing the excess. One row for each source, so the windows are small.
    """
    ordered = W.orderBy(F.desc("_has"), "_source")
    weight = F.get(F.array(*map(F.lit, WEIGHTS)), (F.col("rank") - 1) % len(WEIGHTS)).cast("long")
    s = sizes.withColumn("rank", F.row_number().over(ordered)).withColumn("weight", weight)
    s = s.withColumn("_most", F.lit(EPOCHS) * F.col("source_size")).withColumn("_ratio", F.col("_most") / F.col("weight"))
    full = W.orderBy("_ratio", "rank").rowsBetween(W.unboundedPreceding, -1)
    everything = W.partitionBy()
    spent = F.coalesce(F.sum("_most").over(full), F.lit(0))
    weights = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(full), F.lit(0))
    budget = F.lit(SHARE) * F.sum("source_size").over(everything)
    s = s.withColumn("budget", budget).withColumn("_level", (budget - spent) / weights)
    first = F.min(F.when(F.col("_level") <= F.col("_ratio"), F.struct("_ratio", "rank", "_level"))).over(everything)
    level = F.coalesce(first["_level"], F.lit(0.0))
    target = F.least(F.col("_most").cast("double"), level * F.col("weight"))
    return s.select("_has", "_source", "rank", "source_size", "budget", target.alias("target"))


def _starts(keyed: DataFrame) -> DataFrame:
    """Words before each slice, with what is known of its source."""
    slices = keyed.groupBy(*_SLICE).agg(F.sum("_size").alias("_words"))
    slices = stored(slices)
    before = W.partitionBy("_has", "_source").orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    slices = slices.withColumn("_start", F.coalesce(F.sum("_words").over(before), F.lit(0)))
    sources = targets(slices.groupBy("_has", "_source").agg(F.sum("_words").alias("source_size")))
    return slices.drop("_words").join(sources, ["_has", "_source"])


def _finished(keyed: DataFrame, starts: DataFrame) -> DataFrame:
    """Finish time of a document's first turn; the next one is a source's size later."""
    within = W.partitionBy(*_SLICE).orderBy("_key", "_size").rowsBetween(W.unboundedPreceding, W.currentRow)
    got = keyed.withColumn("_upto", F.sum("_size").over(within)).join(starts, _SLICE)
    return got.withColumn("_upto", F.col("_upto") + F.col("_start"))


def _finish(epoch: int) -> Column:
    return F.when(F.col("_size") > 0, (F.lit(epoch) * F.col("source_size") + F.col("_upto")) / F.col("target"))


def _cut(finished: DataFrame) -> tuple[Column, Column]:
    """The last level's band in which the budget ends, and the last item taken from it.

    Both are scalar subqueries. A band of the first level is a 4,096th of a target's
    finish time, one of the next level a 4,096th of that; beyond two targets all is one
    band, which the budget never reaches.
    """
    item = F.explode(F.array(*[F.struct(_finish(e).alias("finish"), F.col("rank").alias("rank")) for e in range(EPOCHS)]))
    items = finished.where("_size > 0").select("_size", "budget", F.lit(0).cast("long").alias("before"), item.alias("item"))
    for level in range(1, LEVELS + 1):
        items = items.withColumn("band", band(F.col("item")["finish"], level))
        bands = items.groupBy("band").agg(F.sum("_size").alias("words"), F.max("budget").alias("budget"), F.max("before").alias("before"))
        # At most 8,193 bands on the first level and 4,096 on the others.
        bands = bands.withColumn("upto", F.col("before") + F.sum("words").over(W.orderBy("band")))
        first = bands.where("upto > budget").groupBy().agg(F.min(F.struct("band", "upto", "words")).alias("c")).select("c.*")
        crossed = stored(first.where("band IS NOT NULL").select("band", (F.col("upto") - F.col("words")).alias("_before")))
        items = items.join(F.broadcast(crossed), "band").select("_size", "budget", F.col("_before").alias("before"), "item")
        items = stored(items) if level < LEVELS else items
    last = items.withColumn("upto", F.col("before") + F.sum("_size").over(W.orderBy("item")))
    last = last.where("upto <= budget").agg(F.max("item").alias("item"))
    return crossed.select("band").scalar(), last.scalar()


def band(finish: Column, level: int = LEVELS) -> Column:
    """Number of the band; scaling by a power of two is exact, so bands of a level lie within those of the one before."""
    return F.least(F.floor(finish * BANDS**level), F.lit(2 * BANDS**level)).cast("long")


def _times(finished: DataFrame) -> Column:
    """How often each document is taken."""
    edge, last = _cut(finished)
    total = F.lit(0).cast("long")
    for e in range(EPOCHS):
        item = F.struct(_finish(e).alias("finish"), F.col("rank").alias("rank"))
        inside = (band(_finish(e)) < F.coalesce(edge, F.lit(2 * BANDS**LEVELS + 1))) | ((band(_finish(e)) == edge) & (item <= last))
        total = total + F.when(inside, 1).otherwise(0)
    return total


def plan(docs: DataFrame) -> DataFrame:
    """One row for each document: its size, its source's size and target, words taken."""
    read = docs.select("doc_id", "source", n_words(text_of()).alias("size"), F.md5(text_of()).alias("_text"))
    narrow = stored(_keyed(read, F.col("doc_id"), F.col("source"), F.col("size"), F.col("_text")).drop("_text"))
    finished = stored(_finished(narrow, _starts(narrow)))
    taken = F.col("size") * _times(finished)
    return finished.select("doc_id", "size", "source_size", F.coalesce("target", F.lit(0.0)).alias("target"), taken.alias("taken"))


def mix(docs: DataFrame) -> DataFrame:
    """The documents of the mix, all columns as they were, in order of finish time.

    A document that is taken twice is there twice. The rows are range-partitioned
    and sorted by finish time over the whole result.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    wide = docs.select(row.alias("_row"), n_words(text_of()).alias("_n"))
    wide = _keyed(wide, F.col("_row")["doc_id"], F.col("_row")["source"], F.col("_n"), F.md5(text_of(F.col("_row")["text"])))
    narrow = stored(wide.drop("_row"))
    starts = stored(_starts(narrow))
    edge_of = stored(_finished(narrow, starts).drop("_key", "_slice"))
    finished = _finished(wide, starts)
    finished = finished.withColumn("_taken", _times(edge_of))
    turns = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_taken") - 1))
    got = finished.where("_taken > 0").select("_row", "_size", "_upto", "source_size", "target", "rank", turns.alias("_turn"))
    finish = (F.col("_turn") * F.col("source_size") + F.col("_upto")) / F.col("target")
    got = got.select("_row", finish.alias("_finish"), "rank")
    return got.repartitionByRange("_finish", "rank").sortWithinPartitions("_finish", "rank").select("_row.*")


def op8_mixing(spark, sf_dir: str) -> DataFrame:
    return plan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP8_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || md5(coalesce(text, ''))) AS k FROM documents),
s0 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM s0),
s2 AS (SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s1),
s3 AS (SELECT *, CAST(2 * source_size AS DOUBLE) / weight AS ratio,
    CAST(1.5 AS DOUBLE) * CAST(sum(source_size) OVER () AS DOUBLE) AS budget, sum(weight) OVER () AS weights FROM s2),
s4 AS (SELECT *, (budget - coalesce(CAST(sum(2 * source_size) OVER o AS DOUBLE), 0))
    / CAST(weights - coalesce(sum(weight) OVER o, 0) AS DOUBLE) AS level FROM s3
  WINDOW o AS (ORDER BY ratio, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lv AS (SELECT level AS l FROM s4 WHERE level <= ratio ORDER BY ratio, rank LIMIT 1),
s AS (SELECT source, rank, source_size, budget,
    least(CAST(2 * source_size AS DOUBLE), coalesce((SELECT l FROM lv), 0) * weight) AS target FROM s4),
c AS (SELECT rid, doc_id, size, source_size, target, budget, rank,
    CAST(sum(size) OVER (PARTITION BY d.source ORDER BY k, size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto
  FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
i AS (SELECT rid, size, budget, rank, CAST(e * source_size + upto AS DOUBLE) / target AS finish FROM c, range(0, 2) AS r(e) WHERE size > 0),
o AS (SELECT rid, size, sum(size) OVER (ORDER BY finish, rank ROWS UNBOUNDED PRECEDING) <= budget AS inside FROM i),
t AS (SELECT rid, CAST(sum(size) AS BIGINT) AS taken FROM o WHERE inside GROUP BY rid)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken FROM c LEFT JOIN t USING (rid)
"""
