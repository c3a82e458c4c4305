"""Queries: files written from whole tables and read back, input manifests, the run log."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ..operators import maintain, pick, views
from ..operators.pick import new_folder
from ..sources import manifest, reference, sinks
from .registry import query
from .star import CTES, NOW, cents, sql_stamp, stamp

# --- universe files: one a nation, of its suppliers ------------------------

_HEADER = ["\ufeffCompany Name (English)", "Ticker", "Classification"]

CTES["universe_lines"] = """
    SELECT s_nationkey AS nation, s_suppkey AS entity, s_name AS name,
      CAST(s_nationkey % 3 AS VARCHAR) || '; ' || CAST(s_suppkey % 5 AS VARCHAR) || ' ;' AS labels FROM supplier"""
CTES["universe_files"] = """
    SELECT nation, count(*) AS row_count, sha256(chr(65279) || 'Company Name (English),Ticker,Classification' || chr(10)
      || string_agg(name || ',' || CAST(entity AS VARCHAR) || ',' || labels || chr(10), '' ORDER BY entity)) AS content_hash,
      CASE nation % 3 WHEN 0 THEN 'keep' WHEN 1 THEN 'update' ELSE 'insert' END AS action
    FROM universe_lines GROUP BY nation"""


def universe_folder(s) -> str:
    folder = new_folder(s.spark)
    text = lambda c: F.col(c).cast("string")
    labels = F.concat((F.col("s_nationkey") % 3).cast("string"), F.lit("; "), (F.col("s_suppkey") % 5).cast("string"), F.lit(" ;"))
    cells = [c.alias(h) for c, h in zip([F.col("s_name"), text("s_suppkey"), labels], _HEADER, strict=True)]
    rows = s.table("supplier").repartition("s_nationkey").sortWithinPartitions("s_nationkey", "s_suppkey")
    rows.select(*cells, F.col("s_nationkey").alias("nation")).write.partitionBy("nation").option("header", True).csv(folder)
    return folder


@query("universe_file_rows", "SELECT CAST(entity AS VARCHAR) AS ticker, name, labels FROM universe_lines")
def universe_file_rows(s):
    return reference.scan_universe(s.spark, universe_folder(s)).select("ticker", "name", "labels")


def _manifest(s):
    folder = universe_folder(s)
    lines = manifest.with_file(s.spark.read.option("header", True).csv(folder))
    found = pick.stored(manifest.file_manifest(s.spark, folder, lines, NOW))
    return found.withColumn("nation", F.regexp_extract("file", r"nation=(\d+)", 1).cast("long"))


@query(
    "input_manifest",
    f"""SELECT nation, CASE action WHEN 'keep' THEN row_count - 1 ELSE row_count END AS row_count, content_hash,
      CASE action WHEN 'keep' THEN {sql_stamp("TIMESTAMP '2001-01-01 00:00:00'")} ELSE {sql_stamp(f"TIMESTAMP '{NOW}'")} END AS imported_at, action
    FROM universe_files""",
)
def input_manifest(s):
    """A third of the files is known as it is, a third by other bytes, a third is new."""
    found = _manifest(s)
    before = found.where("nation % 3 < 2").withColumns(
        {
            "content_hash": F.when(F.col("nation") % 3 == 0, F.col("content_hash")).otherwise("old"),
            "row_count": F.col("row_count") - 1,
            "imported_at": F.lit("2001-01-01 00:00:00").cast("timestamp"),
        }
    )
    applied = manifest.apply_manifest(before, found)
    nation = F.regexp_extract("file", r"nation=(\d+)", 1).cast("int").alias("nation")
    return applied.select(nation, "row_count", "content_hash", stamp("imported_at"), "action")


def _members(s, table: str, key: str, name: str, segment):
    return s.table(table).select(
        F.col(key).cast("string").alias("ticker"), F.col(name).alias("name"), segment.alias("labels"),
        F.col(key).cast("long").alias("row_number"), F.lit(NOW).cast("timestamp").alias("created_at"),
        F.lit(NOW).cast("timestamp").alias("updated_at"),
    )


@query(
    "manifest_labels",
    """SELECT CAST(c_custkey AS VARCHAR) AS ticker, classification, label_order FROM (
      SELECT c_custkey, c_mktsegment AS classification, 1 AS label_order FROM customer
      UNION ALL SELECT c_custkey, CAST(c_nationkey AS VARCHAR), 2 FROM customer) WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier)""",
)
def manifest_labels(s):
    dim = _members(s, "supplier", "s_suppkey", "s_name", F.lit("known"))
    segment = F.concat("c_mktsegment", F.lit("; "), F.col("c_nationkey").cast("string"))
    universe = _members(s, "customer", "c_custkey", "c_name", segment)
    return maintain.labels_of_new(maintain.refresh_manifest(dim, universe, NOW))


@query(
    "universe_gate",
    """SELECT k, missing, added, unexpected, missing = 0 AND added <= 1 AND unexpected = 0 AS passes FROM (
      SELECT k, (SELECT count(*) FROM supplier WHERE k = 2 AND s_nationkey = 3) AS missing,
        CASE k WHEN 1 THEN 1 WHEN 3 THEN (SELECT count(*) FROM customer WHERE c_custkey > (SELECT max(s_suppkey) FROM supplier)) ELSE 0 END AS added,
        CASE k WHEN 3 THEN (SELECT count(*) - 1 FROM customer WHERE c_custkey > (SELECT max(s_suppkey) FROM supplier)) ELSE 0 END AS unexpected
      FROM range(0, 4) AS r(k))""",
)
def universe_gate(s):
    """The same file, one with the expected addition, one without a nation, one with every later customer."""
    dim = s.table("supplier").select(F.col("s_suppkey").alias("ticker"), "s_nationkey")
    top = dim.agg(F.max("ticker")).scalar()
    later = s.table("customer").where(F.col("c_custkey") > top).select(F.col("c_custkey").alias("ticker"), (F.col("c_custkey") == top + 1).alias("next"))
    keys, expected = dim.select("ticker"), later.where("next").select("ticker")
    files = [keys, keys.union(expected), dim.where("s_nationkey <> 3").select("ticker"), keys.union(later.select("ticker"))]
    gates = [views.universe_gate(f, keys, expected).select(F.lit(k).cast("long").alias("k"), "*") for k, f in enumerate(files)]
    return reduce(lambda a, b: a.unionByName(b), gates)


# --- stored tables, marts, run log -----------------------------------------

CTES["mart_rows_of"] = """
    SELECT 'nations' AS mart, n_name AS name, CAST(count(s_suppkey) AS BIGINT) AS members, CAST(coalesce(sum(CAST(round(s_acctbal * 100) AS BIGINT)), 0) AS BIGINT) AS amount
    FROM nation LEFT JOIN supplier ON s_nationkey = n_nationkey GROUP BY n_name
    UNION ALL SELECT 'suppliers', s_name, 1, CAST(round(s_acctbal * 100) AS BIGINT) FROM supplier"""


@query("written_marts", "SELECT form, m.* FROM mart_rows_of m, (VALUES ('plain'), ('bundle')) AS f(form)")
def written_marts(s):
    """Marts of stored tables, written as JSON and as a gzip bundle, and read back."""
    tables = reference.load_tables(s.spark, s.folder, ["supplier.parquet", "nation.parquet"])
    supplier = tables["supplier.parquet"].withColumn("amount", cents("s_acctbal"))
    joined = tables["nation.parquet"].join(supplier, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    totals = [F.count("s_suppkey").alias("members"), F.coalesce(F.sum("amount"), F.lit(0).cast("long")).alias("amount")]
    marts = {
        "nations": joined.groupBy(F.col("n_name").alias("name")).agg(*totals),
        "suppliers": supplier.select(F.col("s_name").alias("name"), F.lit(1).cast("long").alias("members"), "amount"),
    }
    folder = new_folder(s.spark)
    sinks.write_marts(marts, f"{folder}/plain")
    sinks.write_bundle(marts, f"{folder}/bundle")
    parts = [
        s.spark.read.schema(marts[m].schema).json(f"{folder}/{form}/{m}").select(F.lit(form).alias("form"), F.lit(m).alias("mart"), "name", "members", "amount")
        for form in ("plain", "bundle")
        for m in marts
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


_COUNTED = """'[' || string_agg('{"table":"orders","action":"' || action || '","rows":' || n || '}', ',' ORDER BY action) || ']'"""
CTES["order_changes"] = """
    SELECT CASE o_orderstatus WHEN 'O' THEN 'insert' WHEN 'P' THEN 'update' END AS action, count(*) AS n
    FROM orders WHERE o_orderstatus IN ('O', 'P') GROUP BY 1"""


@query(
    "run_log",
    f"""SELECT {sql_stamp("TIMESTAMP '2002-01-01 00:00:00'")} AS started_at, CAST(sum(n) AS BIGINT) AS changed_rows, {_COUNTED} AS counters, CAST(0 AS BIGINT) AS n_errors FROM order_changes
    UNION ALL SELECT {sql_stamp("TIMESTAMP '2002-01-03 00:00:00'")}, CAST(sum(n) AS BIGINT), {_COUNTED}, 1 FROM order_changes WHERE action = 'update'""",
)
def run_log(s):
    """Three runs: all orders, unchanged ones only, which leave no row, and updated ones with an error."""
    action = F.when(F.col("o_orderstatus") == "O", "insert").when(F.col("o_orderstatus") == "P", "update").otherwise("keep")
    orders = s.table("orders").select("o_orderkey", action.alias("action"))
    path = f"{new_folder(s.spark)}/runs"
    runs = [
        ("2002-01-01 00:00:00", orders, None),
        ("2002-01-02 00:00:00", orders.where("action = 'keep'"), None),
        ("2002-01-03 00:00:00", orders.where("action = 'update'"), [("feed", "HTTP 307")]),
    ]
    for at, changes, errors in runs:
        sinks.append_run(maintain.run_counters({"orders": changes}), path, at, errors)
    log = s.spark.read.parquet(path)
    return log.select(stamp("started_at"), "changed_rows", "counters", F.size("errors").cast("long").alias("n_errors"))
