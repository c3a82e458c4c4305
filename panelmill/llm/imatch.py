"""I-Match fingerprints with randomised lexicons (operator 5, DataFrame functions only).

Document frequencies of all terms over all documents give a lexicon: the terms
whose share of documents, and so whose idf, lies in a band. A text keeps its
terms that are in the lexicon, sorted and distinct. Each of 32 random
sub-lexicons, which keep from a half down to a 128th of it, hashes the terms it
has of them; the fingerprint is these hashes in order. Equal texts have equal
fingerprints, and two fingerprints are alike by the share of sub-lexicons that
agree among those that have a term of either.

A lower end of the band as a share of the documents bounds the lexicon: there
are at most (mean distinct terms of a text) / ``least`` such terms, however large
the corpus. It travels as one constant.

Defined results: null and empty texts, and texts without terms in the band, have
a fingerprint of empty hashes, alike (1.0) only to another such; rows with equal
ids follow each other by a hash of the text; null ids come last; a single row is
its own next one; an empty table gives an empty one; other columns are ignored.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import let, text_of, words

#: Band of document shares, and the least number of documents.
LEAST, MOST, DOCUMENTS = 0.001, 0.1, 2
CELLS = 16384
#: Even cuts between two quantiles of the ids.
PARTS = 8
#: Each of eight groups of md5 digits orders the terms at random; a sub-lexicon
#: keeps those whose digits are below one of these limits.
GROUPS, LIMITS = 8, ("8000", "2000", "0800", "0200")


def lexicon(texts: DataFrame, least: float = LEAST, most: float = MOST) -> DataFrame:
    """Terms in the band, counted over all rows of ``text``."""
    total = texts.count()
    terms = texts.select(F.explode(F.array_distinct(words(F.col("text")))).alias("term"))
    df = terms.groupBy("term").agg(F.count("*").alias("df"))
    return df.where((F.col("df") >= max(DOCUMENTS, least * total)) & (F.col("df") <= most * total))


def constant(lexicon: DataFrame) -> Column:
    """The lexicon as a constant array of cells by hash; size as bounded above."""
    cell = F.pmod(F.xxhash64("term"), F.lit(CELLS)).cast("int").alias("cell")
    cells: list[list[str]] = [[] for _ in range(CELLS)]
    for row in lexicon.select(cell, "term").toLocalIterator():
        cells[row["cell"]].append(row["term"])
    return F.from_json(F.lit(json.dumps([sorted(c) for c in cells], ensure_ascii=False)), "array<array<string>>")


def fingerprint(text: Column, cells: Column) -> Column:
    known = lambda t: F.array_contains(F.get(cells, F.pmod(F.xxhash64(t), F.lit(CELLS)).cast("int")), t)
    kept = F.array_sort(F.filter(F.array_distinct(words(text)), known))
    marked = F.transform(kept, lambda t: F.struct(t.alias("t"), F.md5(t).alias("m")))

    def piece(part: Column) -> Column:
        joined = F.array_join(F.transform(part, lambda x: x["t"]), " ")
        return F.when(F.size(part) == 0, F.lit("")).otherwise(F.substring(F.md5(joined), 1, 12))

    def group(part: Column, g: int, limits: tuple[str, ...]) -> Column:
        """Hashes of ever smaller sub-lexicons, each drawn from the one before."""
        smaller = F.filter(part, lambda x: F.substring(x["m"], 1 + 4 * g, 4) < limits[0])
        if len(limits) == 1:
            return let(smaller, piece)
        return let(smaller, lambda s: F.concat(piece(s), F.lit("-"), group(s, g, limits[1:])))

    return let(marked, lambda m: F.concat_ws("-", *[group(m, g, LIMITS) for g in range(GROUPS)]))


def likeness(a: Column, b: Column) -> Column:
    pairs = F.arrays_zip(F.split(a, "-").alias("a"), F.split(b, "-").alias("b"))
    used = F.filter(pairs, lambda p: (p["a"] != "") | (p["b"] != ""))
    alike = F.size(F.filter(used, lambda p: p["a"] == p["b"])) / F.size(used)
    return F.when(a == b, F.lit(1.0)).when(F.size(used) == 0, F.lit(0.0)).otherwise(alike)


def with_next(docs: DataFrame) -> DataFrame:
    """Rows in buckets of descending id, each bucket followed by the next one's first row.

    The buckets' limits are approximate quantiles of the ids; every bucket is then
    complete in itself for a look at the next row. ``guest`` marks the borrowed row.
    """
    spark = docs.sparkSession
    n = min(1024, max(32, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    limits = rows.agg(F.percentile_approx("doc_id", [i / n for i in range(n + 1)], 10000)).first()[0] or [0]
    limits = sorted(set(limits))
    ends = F.array(*[F.lit(x).cast("long") for x in limits])
    at = F.size(F.filter(ends, lambda x: x < F.col("doc_id")))
    # Ids between two quantiles are cut evenly once more.
    low, high = F.coalesce(F.get(ends, at - 1), F.lit(limits[0])), F.coalesce(F.get(ends, at), F.lit(limits[-1]))
    share = (F.col("doc_id") - low) / F.greatest(high - low, F.lit(1))
    bucket = at * PARTS + F.least(F.floor(F.greatest(share, F.lit(0.0)) * PARTS), F.lit(PARTS - 1)).cast("int")
    rows = rows.withColumn("bucket", F.coalesce(bucket, F.lit(-1))).withColumn("tie", F.xxhash64("text"))
    # One row for each bucket, so at most about n * PARTS.
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), (-F.col("doc_id")).alias("neg"), "tie")).alias("first")
    heads = rows.groupBy("bucket").agg(first)
    upwards = W.orderBy("bucket")
    lowest = F.min("bucket").over(W.partitionBy())
    heads = heads.select("bucket", F.col("first")["tie"].alias("tie"), F.coalesce(-F.col("first")["neg"], F.lit(0)).alias("_id"),
        F.coalesce(F.lead("bucket").over(upwards), lowest).alias("to"))
    rows = rows.withColumn("_id", F.coalesce("doc_id", F.lit(0))).join(F.broadcast(heads), ["bucket", "tie", "_id"], "left")
    places = F.array(
        F.struct(F.col("bucket").alias("bucket"), F.lit(False).alias("guest")),
        F.struct(F.col("to").alias("bucket"), F.lit(True).alias("guest")),
    )
    placed = F.explode(F.filter(places, lambda p: p["bucket"].isNotNull()))
    return rows.select("doc_id", "text", "tie", placed.alias("_p")).select("doc_id", "text", "tie", "_p.*")


def fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprint of every text and of its edited text, with their likeness."""
    cells = constant(lexicon(docs.select(text_of().alias("text"))))
    order = W.partitionBy("bucket").orderBy("guest", F.col("doc_id").desc_nulls_last(), "tie")
    rows = with_next(docs).withColumn("next", F.lead("text").over(order))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.left("text", F.length("text") - half), F.left(F.coalesce("next", F.lit("")), half))
    rows = rows.select("bucket", "guest", "doc_id", "tie", "text", F.when(~F.col("guest"), edited).alias("edited"))
    rows = rows.select(
        "bucket", "guest", "doc_id", "tie",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(F.col("text"), cells).alias("fingerprint"),
        F.when(~F.col("guest"), fingerprint(F.col("edited"), cells)).alias("edited_fingerprint"),
    )
    rows = rows.withColumn("_next", F.lead("fingerprint").over(order)).where(~F.col("guest"))
    return rows.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("_next")).alias("near_next"),
    )


def op5_imatch(spark, sf_dir: str) -> DataFrame:
    return fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql() -> str:
    pieces = ", '-', ".join(
        f"coalesce(substr(md5(string_agg(term, ' ' ORDER BY term) FILTER (WHERE substr(m, {1 + 4 * g}, 4) < '{limit}')), 1, 12), '')"
        for g in range(GROUPS)
        for limit in LIMITS
    )
    empty = "-" * (GROUPS * len(LIMITS) - 1)
    near = lambda a, b: f"""CASE WHEN {a} = {b} THEN 1.0::DOUBLE ELSE (
      SELECT count(*) FILTER (WHERE x = y)::DOUBLE / count(*) FROM
      (SELECT unnest(string_split({a}, '-')) AS x, unnest(string_split({b}, '-')) AS y) WHERE x <> '' OR y <> '') END"""
    return rf"""
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id DESC NULLS LAST) AS rn, doc_id, coalesce(text, '') AS t FROM documents),
e AS (SELECT rn, doc_id, t, coalesce(lead(t) OVER (ORDER BY rn), first_value(t) OVER (ORDER BY rn)) AS nt,
  CAST(floor(length(t) / 2) AS BIGINT) AS h FROM d),
x AS (SELECT rn, doc_id, t, substr(t, 1, length(t) - h) || substr(nt, 1, h) AS ed FROM e),
tt AS (SELECT rn, 0 AS kind, unnest(list_distinct(regexp_extract_all(t, '[^\x20\x09-\x0D]+'))) AS term FROM x
  UNION ALL SELECT rn, 1, unnest(list_distinct(regexp_extract_all(ed, '[^\x20\x09-\x0D]+'))) FROM x),
lex AS (SELECT term, md5(term) AS m FROM tt WHERE kind = 0 GROUP BY term
  HAVING count(*) >= greatest({DOCUMENTS}, {LEAST} * (SELECT count(*) FROM d)) AND count(*) <= {MOST} * (SELECT count(*) FROM d)),
fp AS (SELECT rn, kind, concat({pieces}) AS f FROM tt JOIN lex USING (term) GROUP BY rn, kind),
a AS (SELECT x.rn, x.doc_id, length(t) AS n_chars, sha256(ed) AS edited_sha256,
    coalesce(f0.f, '{empty}') AS fingerprint, coalesce(f1.f, '{empty}') AS edited_fingerprint
  FROM x LEFT JOIN fp f0 ON f0.rn = x.rn AND f0.kind = 0 LEFT JOIN fp f1 ON f1.rn = x.rn AND f1.kind = 1),
b AS (SELECT *, coalesce(lead(fingerprint) OVER (ORDER BY rn), first_value(fingerprint) OVER (ORDER BY rn)) AS nf FROM a)
SELECT doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
  {near("fingerprint", "edited_fingerprint")} AS near_edited, {near("fingerprint", "nf")} AS near_next
FROM b
"""


OP5_SQL = _sql()
