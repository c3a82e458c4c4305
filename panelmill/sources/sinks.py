"""Sinks: entity documents, marts, bundles, CSV exports, the run log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def entity_documents(dim: DataFrame, facts: DataFrame, columns) -> DataFrame:
    """One nested row per entity: its attributes and its history in month order.

    ``facts`` holds one row per month, so a history is bounded by the calendar.
    """
    rows = facts.select("entity", F.struct(F.date_format("month", "yyyy-MM").alias("month"), *columns).alias("_h"))
    history = rows.groupBy("entity").agg(F.sort_array(F.collect_list("_h")).alias("history"))
    company = F.struct(*[c for c in dim.columns]).alias("company")
    empty = F.array().cast(history.schema["history"].dataType)
    return (
        dim.select("entity", "ticker", company)
        .join(history, "entity", "left")
        .select("ticker", "company", F.coalesce("history", empty).alias("history"))
    )


def write_entity_docs(documents: DataFrame, path: str) -> None:
    """JSON documents in one folder per ticker; folders of gone entities vanish."""
    documents.write.partitionBy("ticker").mode("overwrite").json(path)


def write_marts(marts: dict[str, DataFrame], path: str, compressed: bool = False) -> None:
    """One JSON dataset per mart; ``compressed`` writes the gzip bundle."""
    for name, mart in marts.items():
        writer = mart.write.mode("overwrite")
        if compressed:
            writer = writer.option("compression", "gzip")
        writer.json(f"{path}/{name}")


def write_bundle(marts: dict[str, DataFrame], path: str) -> None:
    write_marts(marts, path, compressed=True)


def csv_lines(df: DataFrame) -> DataFrame:
    """Each row as one CSV line: quotes only where needed, null as empty."""

    def cell(c):
        text = F.col(c).cast("string")
        quoted = F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))
        return F.coalesce(F.when(text.rlike('[",\n]'), quoted).otherwise(text), F.lit(""))

    # concat, not concat_ws: empty cells must keep their comma.
    parts = []
    for n, c in enumerate(df.columns):
        parts += ([F.lit(",")] if n else []) + [cell(c)]
    return df.select(F.concat(*parts).alias("line"))


def export_csv(df: DataFrame, path: str) -> None:
    """CSV dataset with a header."""
    df.write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').option(
        "emptyValue", ""
    ).option("nullValue", "").csv(path)


def append_run(counters: DataFrame, path: str, started_at, errors=None) -> bool:
    """Append one audit row to the run log, only if something changed.

    ``counters`` has (table, action, rows) and at most a few dozen rows.
    """
    spark = counters.sparkSession
    totals = counters.agg(
        F.sum("rows").alias("changed_rows"),
        F.to_json(F.sort_array(F.collect_list(F.struct("table", "action", "rows")))).alias("counters"),
    ).where(F.col("changed_rows") > 0)
    error_type = "array<struct<source:string,message:string>>"
    problems = spark.createDataFrame([(errors or [],)], f"e {error_type}")
    row = totals.select(
        F.lit(started_at).cast("timestamp").alias("started_at"), "changed_rows", "counters"
    ).withColumn("errors", problems.select("e").scalar())
    if not row.take(1):
        return False
    row.write.mode("append").parquet(path)
    return True

