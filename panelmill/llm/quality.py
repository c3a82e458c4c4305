"""Quality rules as a short-circuit cascade (operator 10, DataFrame functions only).

Each rule says when a text fails. A sample gives every rule its cost (seconds a
text) and its selectivity (share of texts it rejects); the cascade asks the rules
in order of rejections per second, and a text that fails one is not shown to the
rest. The order changes the work, never the verdict: a text is kept if no rule
rejects it.

Defined results: null and empty texts have no words and are rejected by
``few_words``; repeated rows are judged alike, one row out for each row in; an
empty table gives an empty one; other columns are passed through by ``cascade``
and ignored by ``measure``.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.steps import computed
from .common import let, stored, text_of, words

WINDOW = 5
SYMBOLS = "[#*$%&|<>]"


def _windows(w: Column) -> Column:
    """One 64-bit hash for each window of five words."""
    return F.transform(
        F.sequence(F.lit(0), F.size(w) - WINDOW),
        lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)]),
    )


def _covered(h: Column) -> Column:
    """Words inside windows that occur twice or more.

    Equal hashes are neighbours after one sort; a window that starts ``d`` words
    after the last repeated one covers ``min(5, d)`` new words.
    """
    placed = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))

    def starts(p: Column) -> Column:
        twin = lambda e, j: (F.get(p, j - 1)["h"] == e["h"]) | (F.get(p, j + 1)["h"] == e["h"])
        return F.array_sort(F.transform(F.filter(p, lambda e, j: F.coalesce(twin(e, j), F.lit(False))), lambda e: e["at"]))

    def total(at: Column) -> Column:
        zero = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("long").alias("sum"))
        step = lambda s, x: F.struct(x.alias("last"), (s["sum"] + F.least(F.lit(WINDOW), x - s["last"])).alias("sum"))
        return F.aggregate(at, zero, step, lambda s: s["sum"])

    return let(placed, lambda p: total(starts(p)))


def repeated_words(w: Column) -> Column:
    none = F.lit(0).cast("long")
    count = lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), none).otherwise(_covered(h))
    return F.when(F.size(w) <= WINDOW, none).otherwise(let(_windows(w), count))


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))


def measures(text: Column, w: Column) -> dict[str, Column]:
    """What the rules look at, as expressions of a text and its words."""
    length = lambda c: F.length(c).cast("long")
    return {
        "n_words": F.size(w).cast("long"),
        "word_chars": length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")),
        "n_symbols": length(text) - length(F.regexp_replace(text, SYMBOLS, "")),
        "n_lines": F.size(_lines(text)).cast("long"),
        "n_dup_lines": let(_lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        "n_repeat_words": repeated_words(w),
        "n_upper": length(text) - length(F.regexp_replace(text, "[A-Z]", "")),
    }


#: Measures that the query returns for every document.
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """``fails`` maps the measures to a condition; ``base`` marks the fixed rules."""

    name: str
    fails: Callable[[Mapping[str, Column]], Column]
    base: bool = False


RULES = (
    Rule("few_words", lambda m: m["n_words"] < 10, base=True),
    Rule("repeated_words", lambda m: 100 * m["n_repeat_words"] > 20 * m["n_words"], base=True),
    Rule("symbols", lambda m: 100 * m["n_symbols"] > 25 * m["n_words"]),
    Rule("upper_case", lambda m: 100 * m["n_upper"] > 50 * m["word_chars"]),
    Rule("repeated_lines", lambda m: (m["n_dup_lines"] >= 3) & (100 * m["n_dup_lines"] > 30 * m["n_lines"])),
    Rule("short_words", lambda m: m["word_chars"] < 2 * m["n_words"]),
    Rule("long_words", lambda m: m["word_chars"] > 25 * m["n_words"]),
)


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    seconds: float
    rejected: float

    @property
    def worth(self) -> float:
        return self.rejected / self.seconds


def estimate(docs: DataFrame, rules: Sequence[Rule] = RULES, sample_rows: int = 4000, seed: int = 7) -> list[Estimate]:
    """Cost and selectivity of every rule on a uniform sample, best rule first.

    ``sample_rows`` is the expected size of the sample. Cost is the time of one
    pass with the rule less that of a pass without any. Equal worth keeps the
    given order.
    """
    total = docs.count()
    if not total:
        return [Estimate(r, 1.0, 0.0) for r in rules]
    picked = docs.select(text_of().alias("text")).sample(min(1.0, sample_rows / total), seed)
    sample = stored(picked.withColumn("_w", words(F.col("text"))))
    m = measures(F.col("text"), F.col("_w"))

    def timed(fails: Column) -> tuple[float, float]:
        start = time.perf_counter()
        share = sample.agg(F.avg(F.coalesce(fails, F.lit(False)).cast("double"))).first()[0]
        return time.perf_counter() - start, share or 0.0

    blank = F.length("text") + F.size("_w") < 0
    timed(blank)
    idle = timed(blank)[0]
    found = []
    for rule in rules:
        seconds, share = timed(rule.fails(m))
        found.append(Estimate(rule, max(seconds - idle, 0.001), share))
    return sorted(found, key=lambda e: -e.worth)


def first_failure(m: Mapping[str, Column], rules: Sequence[Rule]) -> Column:
    """Name of the first rule that rejects, null if none does; later ones are not evaluated."""
    reason = F.lit(None).cast("string")
    for rule in reversed(rules):
        reason = F.when(rule.fails(m), F.lit(rule.name)).otherwise(reason)
    return reason


def cascade(docs: DataFrame, rules: Sequence[Rule] | None = None, text: str = "text") -> DataFrame:
    """Rows that no rule rejects, all columns as they were.

    Only what a rule needs is computed, and only for texts that reach it.
    """
    ordered = [e.rule for e in estimate(docs.select(F.col(text).alias("text")))] if rules is None else rules
    row = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), text_of(f"`{text}`").alias("_text"))
    # A filter would otherwise be pushed down and split the text anew for every word it looks at.
    row = computed(row, {"_w": words(F.col("_text"))})
    row = computed(row, {"_why": first_failure(measures(F.col("_text"), F.col("_w")), ordered)})
    return row.where("_why IS NULL").select("_row.*")


def measure(docs: DataFrame, rules: Sequence[Rule] | None = None) -> DataFrame:
    """One row for each document: the base measures, the verdict and the rejecting rule.

    Every row gets the base measures, because they are returned. The rest goes by the
    cascade: a base rule comes first as it costs nothing more, then the others in
    their order, and what only they look at is computed for texts that reach them.
    """
    ordered = [e.rule for e in estimate(docs)] if rules is None else rules
    read = computed(docs.select("doc_id", text_of().alias("_text")), {"_w": words(F.col("_text"))})
    made = measures(F.col("_text"), F.col("_w"))
    got = computed(read, {k: made[k] for k in BASE}).select("doc_id", "_text", *BASE)
    m = {**made, **{k: F.col(k) for k in BASE}}
    base_failed = F.lit(False)
    for rule in RULES:
        if rule.base:
            base_failed = base_failed | rule.fails(m)
    first = sorted(ordered, key=lambda r: not r.base)
    got = computed(got, {"base_failed": base_failed, "rejected_by": first_failure(m, first)})
    kept = ~F.col("base_failed") & F.col("rejected_by").isNull()
    return got.select("doc_id", *BASE, "base_failed", "rejected_by", kept.alias("kept"))


def op10_quality(spark, sf_dir: str) -> DataFrame:
    got = measure(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return got.select("doc_id", *BASE, "base_failed", "kept")


OP10_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM d),
g AS (SELECT rid, i, list_aggregate(ws[i:i + 4], 'string_agg', chr(31)) AS gram
      FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
hot AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS c FROM g) WHERE c > 1),
rep AS (SELECT rid, CAST(count(DISTINCT i + k) AS BIGINT) AS n FROM hot, range(0, 5) AS r(k) GROUP BY rid),
l AS (SELECT rid, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
m AS (SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(ls) AS BIGINT) AS n_lines,
    CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    coalesce(rep.n, 0) AS n_repeat_words,
    length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_upper
  FROM d JOIN w USING (rid) JOIN l USING (rid) LEFT JOIN rep USING (rid))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words OR 100 * n_symbols > 25 * n_words
    OR 100 * n_upper > 50 * word_chars OR (n_dup_lines >= 3 AND 100 * n_dup_lines > 30 * n_lines)
    OR word_chars < 2 * n_words OR word_chars > 25 * n_words) AS kept
FROM m
"""
