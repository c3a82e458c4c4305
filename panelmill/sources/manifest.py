"""Manifest of input files: what each holds, and what changed since the last load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = ("file", "bytes", "content_hash", "row_count", "imported_at")


def file_key(path: Column) -> Column:
    """Address of a file, alike for all readers: one slash after the scheme."""
    return F.regexp_replace(path, r"^([A-Za-z][A-Za-z0-9+.-]*:)/+", "$1/")


def with_file(rows: DataFrame) -> DataFrame:
    """Rows of a file source with the ``file`` they come from."""
    return rows.withColumn("file", file_key(F.col("_metadata.file_path")))


def file_manifest(spark: SparkSession, path: str, rows: DataFrame, now) -> DataFrame:
    """One row for each file under a path: size, SHA-256 of its bytes, rows read, time of import.

    ``rows`` are the rows read, with their ``file``; a file without any has a
    count of 0. Files are hashed whole in one task each, so this is for inputs
    that a task can hold; Spark refuses one of 2 GB or more.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    hashed = files.select(
        file_key(F.col("path")).alias("file"),
        F.col("length").alias("bytes"),
        F.sha2("content", 256).alias("content_hash"),
    )
    counts = rows.groupBy("file").agg(F.count("*").alias("row_count"))
    counted = hashed.join(counts, "file", "left").withColumns(
        {"row_count": F.coalesce("row_count", F.lit(0).cast("long")), "imported_at": F.lit(now).cast("timestamp")}
    )
    return counted.select(*MANIFEST)


def apply_manifest(known: DataFrame, found: DataFrame) -> DataFrame:
    """Next manifest with an ``action``: insert, update for new bytes, keep for the same or absent ones.

    A file of the same bytes keeps its first time of import.
    """
    k, f = known.select(*MANIFEST).alias("k"), found.select(*MANIFEST).alias("f")
    both = k.join(f, F.col("k.file") == F.col("f.file"), "full_outer")
    fresh, here = F.col("k.file").isNull(), F.col("f.file").isNotNull()
    changed = here & ~fresh & ~F.col("k.content_hash").eqNullSafe(F.col("f.content_hash"))
    action = F.when(fresh, "insert").when(changed, "update").otherwise("keep")
    return both.select(
        *[F.when(fresh | changed, F.col(f"f.{c}")).otherwise(F.col(f"k.{c}")).alias(c) for c in MANIFEST],
        action.alias("action"),
    )
