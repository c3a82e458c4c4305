"""Queries over the column functions, applied to whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import labels, months, numbers, text
from .registry import query
from .star import day, growth, jr, sql_day, sql_stamp, sql_ym, stamp, ym


@query(
    "month_arithmetic",
    f"""SELECT entity, {sql_ym('month')} AS month, CAST(year(month)*12+month(month)-1 AS INTEGER) AS idx,
      {sql_day('month - INTERVAL 1 MONTH')} AS previous, {sql_day('month + INTERVAL 13 MONTH')} AS ahead,
      {sql_day('last_day(month)')} AS month_end, {sql_day('CAST(last_day(month) AS DATE) + 9')} AS end_plus_9,
      {sql_day('month')} AS parsed FROM panel""",
)
def month_arithmetic(s):
    m = F.col("month")
    text_form = F.date_format(m, "yyyy-MM-dd")
    return s.panel.select(
        "entity",
        months.month_index(m).alias("idx"),
        F.date_format(months.add_month(m, -1), "yyyy-MM-dd").alias("previous"),
        F.date_format(months.add_month(m, 13), "yyyy-MM-dd").alias("ahead"),
        F.date_format(months.month_end(m), "yyyy-MM-dd").alias("month_end"),
        F.date_format(F.date_add(months.month_end(m), 9), "yyyy-MM-dd").alias("end_plus_9"),
        F.date_format(months.month_of_index(months.month_index(months.parse_month(text_form))), "yyyy-MM-dd").alias("parsed"),
        months.month_label(m).alias("month"),
    )


@query(
    "month_from_names",
    f"SELECT o_orderkey AS id, {sql_day('date_trunc(' + chr(39) + 'month' + chr(39) + ', o_orderdate)')} AS month FROM orders",
)
def month_from_names(s):
    d = F.col("o_orderdate").cast("date")
    name = F.concat(F.lit(" "), F.upper(F.date_format(d, "MMMM")), F.lit(" "))
    month = months.month_from_name(name, F.date_format(d, "yyyy"))
    return s.table("orders").select(F.col("o_orderkey").alias("id"), F.date_format(month, "yyyy-MM-dd").alias("month"))


@query(
    "release_offsets",
    f"""SELECT entity, {sql_ym('month')} AS month,
      CAST(date_diff('day', CAST(last_day(month) AS DATE), reported_date) AS INTEGER) AS offset_days,
      date_diff('day', CAST(last_day(month) AS DATE), reported_date) BETWEEN 0 AND 45 AS publishable,
      date_diff('day', CAST(last_day(month) AS DATE), reported_date) BETWEEN 3 AND 5 AS narrow
    FROM report_dates""",
)
def release_offsets(s):
    return s.report_dates.select(
        "entity",
        ym("month"),
        months.days_after_month_end("reported_date", "month").alias("offset_days"),
        months.in_window("reported_date", "month", 0, 45).alias("publishable"),
        months.in_window("reported_date", "month", 3, 5).alias("narrow"),
    )


@query(
    "local_utc_times",
    f"""SELECT record_id, {sql_day('published_date')} AS local_date, published_time AS local_time,
      {sql_stamp('published_at')} AS back_to_utc,
      {sql_day("CAST(date_trunc('month', published_date) - INTERVAL 1 MONTH AS DATE)")} AS target_month,
      {sql_stamp("CAST(date_trunc('month', published_date) AS TIMESTAMP) - INTERVAL 8 HOUR")} AS month_opens,
      {sql_stamp("CAST(date_trunc('month', published_date) AS TIMESTAMP) + INTERVAL 1 MONTH - INTERVAL 8 HOUR")} AS month_closes
    FROM records""",
)
def local_utc_times(s):
    at = F.col("published_at")
    opens, closes = months.month_bounds_utc(F.trunc(months.local_date(at), "MM"))
    return s.records.select(
        "record_id",
        F.date_format(months.local_date(at), "yyyy-MM-dd").alias("local_date"),
        months.local_time(at).alias("local_time"),
        F.date_format(months.local_to_utc(months.local_date(at), months.local_time(at)), "yyyy-MM-dd HH:mm:ss").alias("back_to_utc"),
        F.date_format(months.target_month(at), "yyyy-MM-dd").alias("target_month"),
        F.date_format(opens, "yyyy-MM-dd HH:mm:ss").alias("month_opens"),
        F.date_format(closes, "yyyy-MM-dd HH:mm:ss").alias("month_closes"),
    )


@query(
    "rolling_month_lists",
    f"""SELECT entity, {sql_ym('last_month')} AS last_month,
      {sql_ym('CAST(last_month - to_months(k) AS DATE)')} AS month
    FROM (SELECT entity, CAST(date_trunc('month', max(published_date)) - INTERVAL 1 MONTH AS DATE) AS last_month
          FROM records GROUP BY 1), (SELECT CAST(unnest(generate_series(0, 11)) AS INTEGER) AS k)""",
)
def rolling_month_lists(s):
    latest = s.records.groupBy("entity").agg(F.max("published_at").alias("at"))
    return latest.select(
        "entity",
        F.date_format(months.target_month("at"), "yyyy-MM").alias("last_month"),
        F.explode(months.rolling_months("at", 12)).alias("m"),
    ).select("entity", "last_month", F.date_format("m", "yyyy-MM").alias("month"))


@query(
    "roc_calendar",
    f"""SELECT o_orderkey AS id, {sql_day("date_trunc('month', o_orderdate)")} AS month,
      {sql_day('o_orderdate')} AS slashed, {sql_day('o_orderdate')} AS compact, {sql_day('o_orderdate')} AS feed,
      {sql_day('o_orderdate')} AS iso, {sql_day('o_orderdate')} AS us, {sql_day('o_orderdate')} AS digits FROM orders""",
)
def roc_calendar(s):
    d = F.col("o_orderdate").cast("date")
    roc = (F.year(d) - 1911).cast("string")
    month, dom = F.month(d).cast("string"), F.dayofmonth(d).cast("string")
    slashed = F.concat_ws("/", roc, month, F.lpad(dom, 2, "0"))
    compact = F.concat(F.lpad(roc, 3, "0"), F.lpad(month, 2, "0"), F.lpad(dom, 2, "0"))
    out = {
        "month": months.roc_month(F.concat_ws("/", roc, month)),
        "slashed": months.roc_date(slashed),
        "compact": months.roc_date(compact),
        "feed": months.feed_date(F.concat(slashed, F.lit(" 02:57:43")), F.lit(None).cast("date")),
        "iso": months.iso_date(F.concat_ws("/", F.year(d).cast("string"), month, dom)),
        "us": months.us_date(F.concat(F.concat_ws("/", month, dom, F.year(d).cast("string")), F.lit("(Thu)*"))),
        "digits": months.compact_date(F.date_format(d, "yyyyMMdd")),
    }
    return s.table("orders").select(
        F.col("o_orderkey").alias("id"), *[F.date_format(v, "yyyy-MM-dd").alias(k) for k, v in out.items()]
    )


@query(
    "minute_of_day",
    """SELECT record_id, CAST(substr(published_time,1,2) AS INTEGER)*60 + CAST(substr(published_time,4,2) AS INTEGER)
        AS minute, substr(published_time,1,5) || ':00' AS clock,
      CASE WHEN revenue/100.0 + 0.5 >= 1440 THEN '23:59:00'
        ELSE lpad(CAST(CAST(floor(revenue/100.0+0.5) AS INTEGER) // 60 AS VARCHAR),2,'0') || ':' ||
             lpad(CAST(CAST(floor(revenue/100.0+0.5) AS INTEGER) % 60 AS VARCHAR),2,'0') || ':00' END AS rounded,
      substr(published_time,1,5) || ':00' AS suffix
    FROM records""",
)
def minute_of_day(s):
    minute = months.time_to_minute("published_time")
    return s.records.select(
        "record_id",
        minute.alias("minute"),
        months.minute_to_time(minute).alias("clock"),
        months.minute_to_time(F.col("revenue") / 100).alias("rounded"),
        months.suffix_time(F.concat(F.lit("2026-08-10T"), F.substring("published_time", 1, 5))).alias("suffix"),
    )


DEADLINE_SQL = f"""
    SELECT month, max(d) AS deadline FROM (
      SELECT month, CAST(unnest(generate_series(CAST(month + INTERVAL 1 MONTH AS DATE) - 356,
               CAST(month + INTERVAL 1 MONTH AS DATE) + 9, INTERVAL 1 DAY)) AS DATE) AS d
      FROM (SELECT DISTINCT month FROM panel))
    WHERE isodow(d) < 6 AND d NOT IN (SELECT holiday FROM holidays) GROUP BY 1"""


@query("release_deadlines", f"SELECT {sql_ym('month')} AS month, {sql_day('deadline')} AS deadline FROM ({DEADLINE_SQL})")
def release_deadlines(s):
    return months.release_deadlines(s.panel, s.holidays).select(ym("month"), day("deadline"))


@query(
    "growth_and_direction",
    f"""SELECT entity, {sql_ym('month')} AS month, {jr('mom - yoy')} AS gap,
      {jr(growth('revenue', 'ytd'), 3)} AS vs_total,
      CASE WHEN {jr('mom - yoy')} > 0 THEN 'accelerating' WHEN {jr('mom - yoy')} < 0 THEN 'decelerating'
        WHEN {jr('mom - yoy')} = 0 THEN 'unchanged' ELSE 'unavailable' END AS direction,
      {jr('-CAST(revenue AS DOUBLE)/1000', 0)} AS negative_half FROM facts""",
)
def growth_and_direction(s):
    gap = numbers.js_round(F.col("mom") - F.col("yoy"), 2)
    return s.facts.select(
        "entity",
        ym("month"),
        gap.alias("gap"),
        numbers.js_round(numbers.growth_pct("revenue", "ytd"), 3).alias("vs_total"),
        numbers.direction(gap).alias("direction"),
        numbers.js_round(-F.col("revenue") / 1000, 0).alias("negative_half"),
    )


@query(
    "money_text",
    """SELECT l_orderkey AS k, l_linenumber AS n, l_partkey AS p, l_suppkey AS u,
      CAST(l_partkey AS BIGINT) * 1000 AS thousands, FALSE AS bad, TRUE AS bad_text, TRUE AS bad_empty,
      CAST(NULL AS BIGINT) AS dash, -l_discount AS percent, CAST(round(l_extendedprice*1000000) AS BIGINT) AS in_millions,
      CASE WHEN l_returnflag = 'A' THEN -l_tax ELSE l_tax END AS signed
    FROM lineitem""",
)
def money_text(s):
    grouped = F.format_number("l_partkey", 0)
    empty = F.when(F.col("l_returnflag") == "A", "--").otherwise("")
    wrong = F.concat(grouped, F.lit("x"))
    word = F.when(F.col("l_returnflag") == "A", "Decrease").otherwise("increase")
    return s.table("lineitem").select(
        F.col("l_orderkey").alias("k"),
        F.col("l_linenumber").alias("n"),
        F.col("l_partkey").alias("p"),
        F.col("l_suppkey").alias("u"),
        numbers.parse_thousands(grouped).alias("thousands"),
        numbers.bad_cell(grouped, numbers.parse_thousands(grouped), required=True).alias("bad"),
        numbers.bad_cell(wrong, numbers.parse_thousands(wrong)).alias("bad_text"),
        numbers.bad_cell(empty, numbers.parse_thousands(empty), required=True).alias("bad_empty"),
        numbers.parse_thousands(F.lit("-")).alias("dash"),
        numbers.parse_percent(F.concat(F.lit("-"), F.col("l_discount").cast("string"), F.lit("%"))).alias("percent"),
        numbers.millions(F.format_number("l_extendedprice", 2)).alias("in_millions"),
        numbers.signed_percent(word, F.col("l_tax").cast("string")).alias("signed"),
    )


@query(
    "unit_amounts",
    """SELECT o_orderkey AS id, CAST(round(o_totalprice*100) AS BIGINT)*CAST(scale AS BIGINT) // 100 AS value,
      greatest(1, CAST(ceil(0.5 * scale * 0.01) AS BIGINT) + 1) AS tolerance, CAST(scale AS DOUBLE) AS scale
    FROM (SELECT *, CASE o_orderkey % 3 WHEN 0 THEN 100000000.0 WHEN 1 THEN 10000.0 ELSE 100.0 END AS scale FROM orders)
    WHERE scale > 100
    UNION ALL
    SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT), 2, CAST(100 AS DOUBLE) FROM orders WHERE o_orderkey % 3 = 2""",
)
def unit_amounts(s):
    unit = F.when(F.col("o_orderkey") % 3 == 0, "億元").when(F.col("o_orderkey") % 3 == 1, "萬元").otherwise("元")
    number = F.when(F.col("o_orderkey") % 3 == 2, F.format_number(F.floor("o_totalprice"), 0)).otherwise(
        F.format_number("o_totalprice", 2)
    )
    amount = numbers.unit_amount(number, unit)
    scale = F.when(F.col("o_orderkey") % 3 == 0, 1e8).when(F.col("o_orderkey") % 3 == 1, 1e4).otherwise(100.0)
    return s.table("orders").select(
        F.col("o_orderkey").alias("id"),
        amount["value"].alias("value"),
        amount["tolerance"].alias("tolerance"),
        scale.alias("scale"),
    )


@query(
    "labelled_percents",
    """SELECT event_id AS id, CAST(round(value*100) AS DOUBLE)/100 AS mom, -CAST(round(value*100) AS DOUBLE)/100 AS yoy,
      CAST(NULL AS DOUBLE) AS none FROM events""",
)
def labelled_percents(s):
    number = F.round("value", 2).cast("string")
    line = F.concat(F.lit("x，年增率-"), number, F.lit("％，月增率高達"), number, F.lit(" %。"))
    return s.table("events").select(
        F.col("event_id").alias("id"),
        numbers.percent_after(line, "月增率").alias("mom"),
        numbers.percent_after(line, "年增率").alias("yoy"),
        numbers.percent_after(line, "季增率").alias("none"),
    )


@query(
    "correction_texts",
    """SELECT doc_id, regexp_matches(text, '(?i)更正|重新公告|修正|重編|correct|restat|revis') AS archive,
      regexp_matches(text, '(?i)更正|重編|修正|correct|restat') AS article,
      regexp_matches(text, '[㐀-鿿]') AS han,
      regexp_matches(text, '(?i)monthly\\s+(?:sales|revenue|operating\\s+revenue)') AS revenue FROM documents""",
)
def correction_texts(s):
    return s.table("documents").select(
        "doc_id",
        text.is_correction("text").alias("archive"),
        text.is_correction("text", text.CORRECTION_ARTICLE).alias("article"),
        text.has_han("text").alias("han"),
        text.is_revenue_subject("text").alias("revenue"),
    )


@query(
    "decoded_pages",
    r"""SELECT page_id, trim(regexp_replace(regexp_replace(
      replace(replace(replace(replace(replace(html, '&amp;', '&'), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''),
      '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS body FROM pages""",
)
def decoded_pages(s):
    return s.table("pages").select("page_id", text.decode_text("html").alias("body"))


@query(
    "subject_months",
    f"""SELECT o_orderkey AS id, {sql_day("CASE WHEN o_orderkey % 3 = 0 OR (o_orderkey % 3 = 1 AND year(o_orderdate) >= 2000) THEN date_trunc('month', o_orderdate) ELSE DATE '2026-07-01' END")} AS month
    FROM orders""",
)
def subject_months(s):
    d = F.col("o_orderdate").cast("date")
    roc = F.concat(F.lit("公告本公司"), (F.year(d) - 1911).cast("string"), F.lit("年"), F.date_format(d, "MM"), F.lit("月營收"))
    iso = F.concat(F.lit("Monthly revenue "), F.date_format(d, "yyyy-MM"), F.lit(" notice"))
    subject = F.when(F.col("o_orderkey") % 3 == 0, roc).when(F.col("o_orderkey") % 3 == 1, iso).otherwise("no month here")
    month = text.month_from_subject(subject, F.lit("2026-07-01").cast("date"))
    return s.table("orders").select(F.col("o_orderkey").alias("id"), F.date_format(month, "yyyy-MM-dd").alias("month"))


@query(
    "resolved_tickers",
    """SELECT c_custkey AS id, CASE c_custkey % 3 WHEN 0 THEN lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0')
        WHEN 1 THEN lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') END AS ticker FROM customer""",
)
def resolved_tickers(s):
    code = F.lpad((F.col("c_custkey") % 10000).cast("string"), 4, "0")
    other = F.lpad(((F.col("c_custkey") + 1) % 10000).cast("string"), 4, "0")
    kind = F.col("c_custkey") % 3
    line = F.concat(F.lit("("), code, F.lit("-TW)今天公告"))
    # Listed with others; not listed among several; a single listed one the text does not carry.
    listed = F.when(kind == 0, F.array(other, code)).when(kind == 1, F.array(other, F.lit("99999"))).otherwise(F.array(other))
    rows = s.table("customer").select(F.col("c_custkey").alias("id"), line.alias("line"), text.listed_tickers(listed).alias("listed"))
    rows = rows.withColumn("ticker", text.resolve_ticker(text.printed_ticker("line"), "listed"))
    return rows.select("id", F.when(text.carries_ticker("line", "ticker"), F.col("ticker")).alias("ticker"))


@query(
    "name_keys",
    r"SELECT doc_id, lower(regexp_replace(text, '[\s\x{00A0}\x{3000}]+', '', 'g')) AS name_key FROM documents",
)
def name_keys(s):
    return s.table("documents").select("doc_id", text.name_key("text", fold=False).alias("name_key"))


@query("folded_notes")
def folded_notes(s):
    """Compatibility folding and note clean-up over all documents (no SQL form).

    A worker holds a batch of whole texts, so batches are set to 1,000 rows at
    most; the session keeps them, as the result is computed when it is used.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(s.spark.conf.get(key)) <= 1000:
        s.spark.conf.set(key, "1000")
    return s.table("documents").select(
        "doc_id",
        text.ascii_clean("text").alias("ascii"),
        text.name_key("text").alias("name_key"),
        text.finished_note("text", "text")["status"].alias("status"),
    )


@query(
    "note_years",
    """SELECT o_orderkey AS id, CAST(year(o_orderdate) AS VARCHAR) || ' 資料; 1234年 ' ||
      CAST(1911 + o_orderkey % 99 + 1 + 0 AS VARCHAR) || ' x' AS note
    FROM (SELECT * FROM orders) WHERE o_orderkey % 99 + 1 >= 10
    UNION ALL
    SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) || ' 資料; 1234年 ' || CAST(o_orderkey % 99 + 1 AS VARCHAR) || '年x'
    FROM orders WHERE o_orderkey % 99 + 1 < 10""",
)
def note_years(s):
    roc = (F.year(F.col("o_orderdate").cast("date")) - 1911).cast("string")
    small = (F.col("o_orderkey") % 99 + 1).cast("string")
    raw = F.concat(roc, F.lit("年資料; 1234年 "), small, F.lit("年x"))
    return s.table("orders").select(F.col("o_orderkey").alias("id"), text.expand_roc_years(raw).alias("note"))


@query(
    "row_hashes",
    """SELECT entity, obs_id, sha256('["' || CAST(revenue AS VARCHAR) || '","' || flag || '/",' ||
      CASE WHEN note IS NULL THEN 'null' ELSE '"' || note || '"' END || ']') AS row_hash FROM obs""",
)
def row_hashes(s):
    return s.observations.select(
        "entity", "obs_id", text.row_hash("revenue", F.concat("flag", F.lit("/")), "note").alias("row_hash")
    )


@query(
    "basis_labels",
    """SELECT entity, basis, CASE basis WHEN 'mops_current_feed' THEN 'Exact MOPS time'
        WHEN 'mops_revenue_announcement' THEN 'Exact MOPS announcement'
        WHEN 'company_ir_monthly_revenue' THEN 'Exact company IR time'
        WHEN 'cnyes_revenue_news' THEN 'Cnyes public-web proxy'
        WHEN 'mops_first_observed' THEN 'Not available' END AS label,
      CASE basis WHEN 'mops_first_observed' THEN 2 WHEN 'company_ir_monthly_revenue' THEN 2
        WHEN 'cnyes_revenue_news' THEN 4 ELSE 1 END AS source_priority,
      CASE WHEN basis IN ('mops_current_feed','mops_revenue_announcement','company_ir_monthly_revenue') THEN 1 ELSE 0 END AS exact,
      CASE WHEN basis = 'cnyes_revenue_news' THEN 'proxy' ELSE 'actual' END AS kind,
      CASE entity % 5 WHEN 0 THEN 'Historical estimate' WHEN 1 THEN 'Blended estimate' WHEN 2 THEN 'Market fallback'
        WHEN 3 THEN 'Regulatory deadline' ELSE 'some other source' END AS schedule
    FROM order_dates""",
)
def basis_labels(s):
    code = labels.choose("basis", {k: v for k, v in labels.PUBLICATION_BASIS.items() if k != "mops_first_observed"})
    kind = F.col("entity") % 5
    source = F.when(kind < 3, "company_history").when(kind == 3, "regulatory_prior").otherwise("some_other_source")
    samples = F.when(kind == 0, 3).when(kind == 1, 1).otherwise(0)
    return s.order_dates.select(
        "entity",
        "basis",
        labels.label_publication(code).alias("label"),
        labels.basis_priority("basis").alias("source_priority"),
        labels.exact_flag("basis").alias("exact"),
        labels.history_kind("basis").alias("kind"),
        labels.label_schedule(source, samples).alias("schedule"),
    )


@query(
    "period_windows",
    f"""SELECT entity, {sql_ym('month')} AS month,
      {sql_ym('CAST(month - INTERVAL 2 MONTH AS DATE)')} AS q_current, {sql_ym('CAST(month - INTERVAL 5 MONTH AS DATE)')} AS q_start,
      {sql_ym('CAST(month - INTERVAL 3 MONTH AS DATE)')} AS q_end, {sql_ym('CAST(month - INTERVAL 12 MONTH AS DATE)')} AS y_start,
      {sql_ym('CAST(month - INTERVAL 12 MONTH AS DATE)')} AS y_end FROM panel""",
)
def period_windows(s):
    q, y = months.period_bounds("month", 3), months.period_bounds("month", 1, year_over_year=True)
    form = lambda c: F.date_format(c, "yyyy-MM")
    return s.panel.select(
        "entity",
        form(q["current_start"]).alias("q_current"),
        form(q["prior_start"]).alias("q_start"),
        form(q["prior_end"]).alias("q_end"),
        form(y["prior_start"]).alias("y_start"),
        form(y["prior_end"]).alias("y_end"),
        ym("month"),
    )


@query(
    "release_buckets",
    f"""SELECT entity, {sql_day('reported_date')} AS reported_date,
      CASE WHEN day(reported_date) > 20 THEN NULL WHEN day(reported_date) <= 4 THEN '1-4' WHEN day(reported_date) <= 7 THEN '5-7'
        WHEN day(reported_date) <= 10 THEN '8-10' WHEN day(reported_date) <= 15 THEN '11-15' ELSE '16-20' END AS capped,
      CASE WHEN day(reported_date) <= 4 THEN '1-4' WHEN day(reported_date) <= 7 THEN '5-7'
        WHEN day(reported_date) <= 10 THEN '8-10' WHEN day(reported_date) <= 15 THEN '11-15'
        ELSE '16-' || CAST(day(last_day(reported_date)) AS VARCHAR) END AS bucket FROM order_dates""",
)
def release_buckets(s):
    return s.order_dates.select(
        "entity",
        months.release_bucket("reported_date", F.lit(20)).alias("capped"),
        months.release_bucket("reported_date").alias("bucket"),
        day("reported_date"),
    )
