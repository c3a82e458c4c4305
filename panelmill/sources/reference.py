"""Reference inputs: holidays, universe, source registry, stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.months import roc_date
from ..functions.text import HOLIDAY_TEXT, trim_all

HOLIDAY_SCHEMA = "Name string, Date string, Description string"
REGISTRY_SCHEMA = (
    "ticker string, company string, sourceType string, sourceUrl string, fallbackUrls array<string>, "
    "historicalFallbackOnAccessDenied boolean, parserName string, priority int, enabled boolean"
)

# Columns of the universe file.
UNIVERSE_COLUMNS = {
    "Company Name (English)": "name",
    "Ticker": "ticker",
    "Classification": "labels",
}


class UniverseError(ValueError):
    """The universe file lacks a column or a value."""


def holidays(rows: DataFrame) -> DataFrame:
    """Days off, from rows whose texts say so; malformed dates drop out."""
    text = F.concat_ws(" ", F.coalesce("Name", F.lit("")), F.coalesce("Description", F.lit("")))
    days = rows.where(text.rlike(HOLIDAY_TEXT)).select(roc_date("Date").alias("holiday"))
    return days.where(F.col("holiday").isNotNull()).distinct()


def scan_holidays(spark: SparkSession, path: str) -> DataFrame:
    return holidays(spark.read.schema(HOLIDAY_SCHEMA).option("multiLine", True).json(path))


def scan_universe(spark: SparkSession, path: str) -> DataFrame:
    """Name, ticker, labels text and row number of the universe CSV."""
    raw = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    names = {c.lstrip("﻿").strip(): c for c in raw.columns}
    missing = [c for c in UNIVERSE_COLUMNS if c not in names]
    if missing:
        raise UniverseError(f"Universe columns missing: {missing}")
    rows = raw.select(
        *[F.coalesce(trim_all(F.col(f"`{names[c]}`")), F.lit("")).alias(a) for c, a in UNIVERSE_COLUMNS.items()],
        (F.monotonically_increasing_id() + 1).alias("row_number"),
    )
    if empty_cells(rows).take(1):
        raise UniverseError(f"Empty cells in {path}")
    return rows


def empty_cells(universe: DataFrame) -> DataFrame:
    """Universe rows with an empty cell."""
    return universe.where((F.col("name") == "") | (F.col("ticker") == "") | (F.col("labels") == ""))


def registry_rows(rows: DataFrame) -> DataFrame:
    """Enabled sources with their ordered, distinct list of addresses."""
    urls = F.array_distinct(
        F.concat(F.array("sourceUrl"), F.coalesce("fallbackUrls", F.array().cast("array<string>")))
    )
    return rows.where("enabled").select(
        "ticker",
        F.col("sourceType").alias("source_type"),
        F.col("sourceUrl").alias("source_url"),
        urls.alias("urls"),
        F.coalesce("historicalFallbackOnAccessDenied", F.lit(False)).alias("fallback_on_denied"),
        F.col("parserName").alias("parser_name"),
        F.col("priority").alias("source_priority"),
        "enabled",
    )


def scan_source_registry(spark: SparkSession, path: str) -> DataFrame:
    return registry_rows(spark.read.schema(REGISTRY_SCHEMA).option("multiLine", True).json(path))


def load_tables(spark: SparkSession, folder: str, names) -> dict[str, DataFrame]:
    """Stored parquet tables by name; readers prune columns by themselves."""
    return {name: spark.read.parquet(f"{folder}/{name}") for name in names}


def read_company_documents(spark: SparkSession, path: str) -> DataFrame:
    """Published per-entity documents back to one row per month."""
    schema = (
        "company struct<id: bigint, ticker: string, name: string, classifications: array<string>>, "
        "history array<struct<month: string, revenueNt: bigint, momPercent: double, yoyPercent: double, "
        "cumulativeYtdRevenueNt: bigint, ytdYoyPercent: double, publicationTimestamp: string, "
        "restatementFlag: boolean, publicationTimestampBasis: string, sourceMarket: string, sourceUrl: string, "
        "sourceReportDate: string, sourceNoteTranslationStatus: string>>"
    )
    docs = spark.read.schema(schema).option("multiLine", True).json(path)
    return docs.select("company.*", F.explode("history").alias("h")).select(
        F.col("id").alias("entity"),
        "ticker",
        "name",
        "classifications",
        F.to_date(F.concat("h.month", F.lit("-01"))).alias("month"),
        F.col("h.revenueNt").alias("revenue"),
        F.col("h.momPercent").alias("mom"),
        F.col("h.yoyPercent").alias("yoy"),
        F.col("h.cumulativeYtdRevenueNt").alias("ytd"),
        F.col("h.ytdYoyPercent").alias("ytd_yoy"),
        F.try_to_timestamp("h.publicationTimestamp").alias("publication_timestamp"),
        F.col("h.publicationTimestampBasis").alias("publication_basis"),
        F.col("h.restatementFlag").alias("restated"),
        F.col("h.sourceMarket").alias("source_market"),
        F.col("h.sourceUrl").alias("source_url"),
    )
