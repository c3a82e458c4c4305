"""Monthly archive files: one CSV per reporting month and market."""

from __future__ import annotations

import csv
import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import MARKET_PRIORITY
from ..functions.months import roc_date, roc_month
from ..functions.numbers import bad_cell, parse_percent, parse_thousands
from ..functions.text import is_correction, row_hash, text_hash, trim_all
from .steps import computed, must

# Header text of every archive column.
HEADERS = {
    "report_date": "出表日期",
    "month": "資料年月",
    "ticker": "公司代號",
    "company_name": "公司名稱",
    "industry": "產業別",
    "revenue": "營業收入-當月營收",
    "previous_revenue": "營業收入-上月營收",
    "prior_year_revenue": "營業收入-去年當月營收",
    "mom": "營業收入-上月比較增減(%)",
    "yoy": "營業收入-去年同月增減(%)",
    "ytd": "累計營業收入-當月累計營收",
    "prior_year_ytd": "累計營業收入-去年累計營收",
    "ytd_yoy": "累計營業收入-前期比較增減(%)",
    "note": "備註",
}
REQUIRED = ("month", "ticker", "revenue", "ytd")
# The report date changes daily without new figures, so it is no part of a row's identity.
IDENTITY = (
    "month",
    "ticker",
    "revenue",
    "previous_revenue",
    "prior_year_revenue",
    "mom",
    "yoy",
    "ytd",
    "prior_year_ytd",
    "ytd_yoy",
    "note",
)
MONEY = ("revenue", "previous_revenue", "prior_year_revenue", "ytd", "prior_year_ytd")
PERCENTS = ("mom", "yoy", "ytd_yoy")


class ArchiveError(ValueError):
    """An archive file does not have the columns or the month it should."""


def header_groups(spark: SparkSession, path: str) -> list[tuple[list[str], list[str]]]:
    """Column names and files of each header that occurs under ``path``.

    One line a file is kept of a plain text scan; the driver holds a path a file, as Spark's own listing does.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")
    )
    first = lines.where(F.col("block") == 0).groupBy("file").agg(F.min_by("value", "line").alias("header"))
    groups = first.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("header").collect()
    names = lambda header: [c.lstrip("\ufeff").strip() for c in next(csv.reader([header]))]
    literal = lambda uri: re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(uri))
    return [(names(g["header"]), [literal(f) for f in g["files"]]) for g in groups]


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Raw text cells of the archive CSVs under ``path``, with file and order.

    Every file's cells go by its own header, in whatever order the columns stand; files
    of one header are read in one scan. Files are the unit of parallelism.
    """
    groups = header_groups(spark, path)
    by_header = {h: c for c, h in HEADERS.items()}
    scans = []
    for names, files in groups or [([], [path])]:
        place = {by_header[h]: f"c{k}" for k, h in enumerate(names) if h in by_header}
        missing = [HEADERS[c] for c in REQUIRED if c not in place]
        if missing:
            raise ArchiveError(f"Missing archive columns {missing} in {files[0]}")
        raw = (
            spark.read.schema(", ".join(f"c{k} string" for k in range(len(names))))
            .option("header", True)
            .option("multiLine", True)
            .option("quote", '"')
            .option("escape", '"')
            .option("encoding", "UTF-8")
            .csv(files)
        )
        cells = [
            F.coalesce(trim_all(F.col(place[c])), F.lit("")).alias(c) if c in place else F.lit(None).cast("string").alias(c)
            for c in HEADERS
        ]
        scans.append(raw.select(*cells, F.col("_metadata.file_path").alias("source_file")))
    rows = reduce(DataFrame.unionByName, scans).withColumn("row_no", F.monotonically_increasing_id())
    return rows.where(F.concat_ws("", *HEADERS) != "")


def type_archive(raw: DataFrame, market) -> DataFrame:
    """Typed rows; ``rejects`` lists the cells that cannot be typed."""
    market = F.lit(market) if isinstance(market, str) else market
    note = F.col("note")
    kept_note = F.when(~F.coalesce(note, F.lit("")).isin("", "-", "--"), note)
    carried = [c for c in ("source_file", "row_no", "file_id") if c in raw.columns]
    checked = [*MONEY, *PERCENTS, "month", "report_date"]
    # Typed columns first; rejects then compare them with the raw cells.
    typed = computed(
        raw.select(*HEADERS, *carried, *[F.col(c).alias(f"_raw_{c}") for c in checked]),
        {
            "market": market,
            "month": roc_month("month"),
            "source_report_date": roc_date("report_date"),
            **{c: parse_thousands(c) for c in MONEY},
            **{c: parse_percent(c) for c in PERCENTS},
            "note": kept_note,
            "corrected": is_correction(note),
            "row_hash": row_hash(*IDENTITY),
        },
    )
    bad = {
        "month": F.col("month").isNull(),
        "report_date": F.col("source_report_date").isNull() & (F.col("_raw_report_date") != ""),
        **{c: bad_cell(f"_raw_{c}", c, required=c in REQUIRED) for c in MONEY},
        **{c: bad_cell(f"_raw_{c}", c, percent=True) for c in PERCENTS},
    }
    rejects = F.array_compact(F.array(*[F.when(test, F.lit(c)) for c, test in bad.items()]))
    return computed(typed, {"rejects": rejects, "note_hash": text_hash("note")}).select(
        "market",
        "ticker",
        "month",
        "source_report_date",
        F.col("company_name").alias("source_company_name"),
        F.col("industry").alias("source_industry"),
        *MONEY,
        *PERCENTS,
        "note",
        "note_hash",
        "corrected",
        "row_hash",
        "rejects",
        *carried,
    )


def scan_archive(spark: SparkSession, path: str, market: str, expected_month=None) -> DataFrame:
    """Typed archive of one market; a file with only a header gives no rows.

    With ``expected_month``, a row of another month fails the job, whatever columns are read.
    """
    typed = type_archive(read_archive(spark, path), market)
    if expected_month is None:
        return typed
    wanted = F.lit(expected_month).cast("date")
    wrong = F.concat(
        F.lit(f"{market}: expected {expected_month}, received "),
        F.coalesce(F.col("month").cast("string"), F.lit("no month")),
    )
    return must(typed, F.col("month") == wanted, wrong)


def file_manifest(spark: SparkSession, path: str, market: str, observed_at) -> DataFrame:
    """One row per file: hash, size and retrieval time."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(
        F.col("path").alias("source_file"),
        F.lit(market).alias("market"),
        F.lit(MARKET_PRIORITY.get(market)).alias("market_priority"),
        F.sha2("content", 256).alias("source_hash"),
        "length",
        F.col("modificationTime").alias("last_modified_at"),
        F.lit(observed_at).cast("timestamp").alias("retrieved_at"),
    )


def unreadable(column: str) -> Column:
    """True for typed rows with at least one rejected cell."""
    return F.size(column) > 0
