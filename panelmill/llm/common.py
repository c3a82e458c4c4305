"""Shared pieces of the text operators: words, bindings, hashes, stored tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import pick

__all__ = ["Recent", "WORD", "SPACE", "let", "most_frequent", "small_batches", "stored", "text_of", "unit", "words"]

#: A word is a run of anything but these six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


#: Rows of text that a Python task holds at once; long texts then stay within its memory.
BATCH = "1000"


def stored(df: DataFrame) -> DataFrame:
    """Frame written once as a table in the shared folder, its texts in small batches."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(key)
    conf.set(key, BATCH)
    try:
        return pick.stored(df)
    finally:
        conf.set(key, before)


def small_batches(spark: SparkSession) -> None:
    """Keep this session's batches of rows for Python at ``BATCH``.

    For results that are computed after the call that makes them: unlike ``stored``, such
    a call cannot put the setting back, as Spark reads it when the result is used.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= int(BATCH):
        spark.conf.set(key, BATCH)


def text_of(c: Column | str = "text") -> Column:
    """The text, with null as empty."""
    return F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(""))


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def unit(*columns: Column | str) -> Column:
    """Uniform number in [0, 1) that only depends on the columns."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 11) / F.lit(float(1 << 53))


def table(df: DataFrame, **columns: Column | str) -> DataFrame:
    """Only the named columns, so that others of any name cannot clash."""
    return df.select(*[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in columns.items()])


def most_frequent(counted: DataFrame, count: str, most: int) -> DataFrame:
    """Rows with the highest counts, at most ``most``; rows of equal counts come all or not at all.

    Only the distinct counts and their numbers go through the driver.
    """
    sizes = counted.groupBy(count).agg(F.count("*").alias("rows")).orderBy(F.desc(count)).limit(most).collect()
    least, taken = None, 0
    for row in sizes:
        taken += row["rows"]
        if taken > most:
            break
        least = row[count]
    return counted.where(F.col(count) >= least) if least is not None else counted.limit(0)


class Recent:
    """What a worker remembers of words: those of two spans of about ``most`` words each, long ones counting more."""

    def __init__(self, most: int):
        self.most, self.weight = most, 0
        self.new: dict = {}
        self.old: dict = {}

    def of(self, words: Iterable, learn: Callable[[list], Iterable]) -> dict:
        """A table that holds all given words; ``learn`` gives what is not known yet."""
        if self.weight > self.most:
            self.new, self.old, self.weight = {}, self.new, 0
        new, old, missing = self.new, self.old, []
        for word in set(words).difference(new):
            self.weight += 1 + len(word) // 32
            if word in old:
                new[word] = old[word]
            else:
                missing.append(word)
        if missing:
            new.update(zip(missing, learn(missing), strict=True))
        return new
