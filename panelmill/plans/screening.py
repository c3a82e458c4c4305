"""Queries: searches, orders, exports and documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import screens
from ..operators.pick import global_rank
from ..sources import sinks
from .registry import query
from .star import sql_ym


@query(
    "search_blank",
    "SELECT CAST(s_suppkey AS VARCHAR) AS ticker, s_name AS name FROM supplier ORDER BY s_suppkey LIMIT 12",
)
def search_blank(s):
    return screens.search(s.dim.select("ticker", "name"), "  ", order=screens.ticker_order())


@query(
    "search_matches",
    """SELECT ticker, name FROM dim WHERE contains(ticker, 'nation_1') OR contains(lower(name), 'nation_1')
      OR contains(lower(labels), 'nation_1') ORDER BY CAST(ticker AS BIGINT) LIMIT 30""",
)
def search_matches(s):
    labelled = s.dim.withColumn("classes", F.split("labels", ";"))
    hits = screens.search(labelled, " Nation_1 ", lists=["classes"], order=screens.ticker_order())
    return hits.select("ticker", "name")


@query(
    "ticker_order",
    """SELECT ticker, row_number() OVER (ORDER BY n, ticker) AS rank FROM (
      SELECT CASE WHEN s_suppkey % 3 = 0 THEN 'T' ELSE '' END || CAST(s_suppkey AS VARCHAR) AS ticker,
        CASE WHEN s_suppkey % 3 = 0 THEN 0 ELSE s_suppkey END AS n FROM supplier)""",
)
def ticker_order(s):
    """Numeric tickers by number; text tickers count as zero and go by text."""
    ticker = F.concat(F.when(F.col("s_suppkey") % 3 == 0, "T").otherwise(""), F.col("s_suppkey").cast("string"))
    return global_rank(s.table("supplier").select(ticker.alias("ticker")), screens.ticker_order())


@query(
    "csv_lines",
    """SELECT CAST(doc_id AS VARCHAR) || ',' || CASE WHEN regexp_matches(text, '[",\n]') THEN '"' || replace(text, '"', '""') || '"' ELSE text END
      || ',' || coalesce(CASE WHEN lang <> 'en' THEN lang END, '') || ',' || CAST(n_chars AS VARCHAR) AS line FROM documents""",
)
def csv_lines(s):
    lang = F.when(F.col("lang") != "en", F.col("lang")).alias("lang")
    return sinks.csv_lines(s.table("documents").select("doc_id", "text", lang, "n_chars"))


@query(
    "entity_documents",
    f"""SELECT c.ticker, c.name, coalesce(h.months, 0) AS months, coalesce(h.line, '') AS line FROM customers c LEFT JOIN (
      SELECT entity, count(*) AS months, string_agg({sql_ym('month')} || '=' || CAST(revenue AS VARCHAR), ';' ORDER BY month) AS line
      FROM sparse GROUP BY 1) h USING (entity)""",
)
def entity_documents(s):
    """Nested documents, flattened to one text per entity for the comparison."""
    docs = sinks.entity_documents(s.customers, s.sparse, ["revenue"])
    text = F.transform("history", lambda h: F.concat(h["month"], F.lit("="), h["revenue"].cast("string")))
    return docs.select(
        "ticker", "company.name", F.size("history").cast("long").alias("months"), F.array_join(text, ";").alias("line")
    )
