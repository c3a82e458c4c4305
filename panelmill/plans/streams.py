"""Queries: incremental reads and streaming jobs over the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import row_hash
from ..operators import maintain, pick, quality
from ..operators.pick import new_folder
from ..streaming import jobs, polls
from .registry import query
from .star import CTES, day, sql_day, sql_stamp, stamp

# Stored: the records before this instant; now is a few days later.
STORED_UNTIL = "2024-01-25 00:00:00"
POLL_NOW = "2024-01-29 00:00:00"


def job_folder(s) -> str:
    """New folder for one run, inside the session's shared checkpoint folder."""
    return new_folder(s.spark)


def event_stream(s):
    return jobs.read_stream(s.spark, s.path("events"))


@query(
    "high_water_mark",
    f"""SELECT {sql_stamp(f"greatest(max(published_at) - INTERVAL 2 MINUTE, TIMESTAMP '{POLL_NOW}' - INTERVAL 7 DAY)")} AS start FROM records
    WHERE kind = 'view' AND published_at < TIMESTAMP '{STORED_UNTIL}'""",
)
def high_water_mark(s):
    stored = s.records.where(F.col("published_at") < STORED_UNTIL).withColumn("basis", F.col("kind"))
    start = jobs.high_water(stored, POLL_NOW, basis="view")
    return s.records.agg(F.count("*")).select(start.alias("start")).withColumn("start", stamp("start"))


@query(
    "incremental_slice",
    f"""SELECT record_id FROM records WHERE published_at >= (SELECT greatest(max(published_at) - INTERVAL 2 MINUTE,
      TIMESTAMP '{POLL_NOW}' - INTERVAL 7 DAY) FROM records WHERE published_at < TIMESTAMP '{STORED_UNTIL}')""",
)
def incremental_slice(s):
    stored = s.records.where(F.col("published_at") < STORED_UNTIL)
    return jobs.incremental_slice(s.records, stored, POLL_NOW).select("record_id")


@query("deduped_records", "SELECT event_id, count(*) AS copies FROM events GROUP BY 1")
def deduped_records(s):
    """Each record delivered three times, kept once."""
    again = s.records.select("record_id", "published_at", F.explode(F.sequence(F.lit(1), F.lit(3))).alias("n"))
    late = again.withColumn("published_at", F.col("published_at") + F.make_dt_interval(hours=F.col("n")))
    kept = jobs.dedupe(late, ["record_id"], "published_at", "n")
    return kept.groupBy(F.col("record_id").alias("event_id")).agg(F.count("*").alias("copies"))


@query("deduped_stream", "SELECT event_id, user_id, event_type FROM events")
def deduped_stream(s):
    """The stream with every record delivered three times, de-duplicated."""
    stream = event_stream(s).withColumn("ts", F.col("ts").cast("timestamp"))
    again = stream.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(3)))).drop("copy")
    return jobs.dedupe_job(again, ["event_id"], "ts", job_folder(s)).select("event_id", "user_id", "event_type")


@query("first_seen", f"SELECT user_id, event_type, {sql_stamp('min(ts)')} AS first_seen FROM events GROUP BY 1, 2")
def first_seen(s):
    rows = s.table("events").withColumn("ts", F.col("ts").cast("timestamp"))
    return jobs.first_seen_state(rows, ["user_id", "event_type"], "ts").withColumn("first_seen", stamp("first_seen"))


@query("first_seen_stream", f"SELECT user_id, event_type, {sql_stamp('min(ts)')} AS first_seen FROM events GROUP BY 1, 2")
def first_seen_stream(s):
    stream = event_stream(s).withColumn("ts", F.col("ts").cast("timestamp"))
    rows = jobs.first_seen_job(stream, ["user_id", "event_type"], "ts", job_folder(s))
    return rows.withColumn("first_seen", stamp("first_seen"))


@query(
    "versioned_stream",
    """SELECT user_id, event_type, 1 AS version, arg_max(CAST(round(value*100) AS BIGINT), event_id) AS revenue, TRUE AS is_current
    FROM events GROUP BY 1, 2""",
)
def versioned_stream(s):
    """Versioned facts fed by the event stream; the folder comes in one batch."""
    keys = ["user_id", "event_type"]

    def prepare(batch):
        money = F.round(F.col("value") * 100).cast("long")
        last = pick.last_wins(batch, keys, "event_id").withColumn("revenue", money)
        return last.select(*keys, "revenue", row_hash("event_id", "revenue").alias("row_hash"))

    empty = s.spark.createDataFrame(
        [], "user_id bigint, event_type string, version int, revenue bigint, row_hash string, is_current boolean"
    )
    table = jobs.stream_apply(event_stream(s), empty, prepare, keys, "row_hash", ["revenue"], job_folder(s))
    return table.drop("row_hash")


@query(
    "late_months",
    f"""SELECT entity, {sql_day('day')} AS day, count(*) AS on_time, count(*) FILTER (WHERE kind = 'error') AS late FROM records GROUP BY 1, 2""",
)
def late_months(s):
    """Records that arrive days after their own day still count under that day."""
    arrival = F.when(F.col("kind") == "error", F.date_add("day", 3)).otherwise(F.col("day"))
    rows = s.records.withColumn("arrived", arrival)
    return rows.groupBy("entity", day("day")).agg(
        F.count("*").alias("on_time"), F.count_if(F.col("arrived") > F.col("day")).alias("late")
    )


CTES["fetches"] = """
    SELECT user_id AS source, event_type = 'view' AS ok,
      CASE event_type WHEN 'error' THEN 403 WHEN 'click' THEN 401 WHEN 'view' THEN 200 ELSE 503 END AS status,
      event_type IN ('purchase', 'signup') AS transient, user_id % 2 = 0 AS fallback_on_denied,
      CAST(date_trunc('hour', ts) AS VARCHAR) AS poll FROM events"""


def fetches(s):
    """Every event as a fetch attempt of its user within an hour's poll."""
    kind = F.col("event_type")
    status = F.when(kind == "error", 403).when(kind == "click", 401).when(kind == "view", 200).otherwise(503)
    hour = F.date_format(F.date_trunc("hour", "ts"), "yyyy-MM-dd HH")
    return s.table("events").select(
        F.concat_ws("@", F.col("user_id").cast("string"), hour).alias("source"),
        (kind == "view").alias("ok"),
        status.alias("status"),
        kind.isin("purchase", "signup").alias("transient"),
        (F.col("user_id") % 2 == 0).alias("fallback_on_denied"),
    )


@query(
    "poll_outcomes",
    """SELECT CAST(source AS VARCHAR) || '@' || substr(poll, 1, 13) AS source, count(*) AS attempts,
      CASE WHEN bool_or(ok) THEN 'ok' WHEN bool_and(status IN (401, 403) AND fallback_on_denied) THEN 'unavailable'
        WHEN bool_and(transient) THEN 'deferred' ELSE 'error' END AS outcome FROM fetches GROUP BY 1""",
)
def poll_outcomes(s):
    return jobs.poll_outcome(fetches(s))


@query(
    "poll_gate",
    """SELECT count(DISTINCT (source, poll)) AS sources, CASE WHEN bool_or(ok) THEN 'ok' ELSE 'other' END AS decision FROM fetches""",
)
def poll_gate(s):
    return jobs.gate_outcome(jobs.poll_outcome(fetches(s)))


@query(
    "source_health",
    f"""SELECT user_id AS source, {sql_stamp('max(ts)')} AS last_attempt_at, {sql_stamp("max(ts) FILTER (WHERE event_type = 'view')")} AS last_success_at,
      CASE WHEN arg_max(event_type, (ts, event_id)) <> 'view' THEN arg_max(event_type, (ts, event_id)) END AS standing_error FROM events GROUP BY 1""",
)
def source_health(s):
    attempts = s.table("events").select(
        F.col("user_id").alias("source"), F.col("ts").alias("at"), (F.col("event_type") == "view").alias("ok"),
        F.col("event_type").alias("message"), F.col("event_id").alias("attempt_id"),
    )
    rows = jobs.source_health(attempts)
    return rows.withColumns({"last_attempt_at": stamp("last_attempt_at"), "last_success_at": stamp("last_success_at")})


@query("source_files_first_seen", f"SELECT entity, {sql_stamp('min(published_at)')} AS first_seen FROM records GROUP BY 1")
def source_files_first_seen(s):
    seen = jobs.first_seen_state(s.records, ["entity"], "published_at")
    dates = maintain.first_seen_dates(seen.withColumn("month", F.lit("2024-01-01").cast("date")), POLL_NOW)
    return dates.select("entity", stamp("reported_at")).withColumnRenamed("reported_at", "first_seen")


#: Polls collect what arrived in so many days; errors arrive three days late. In one poll every source is down.
POLL_DAYS, DOWN = 10, 1
CTES["polled"] = f"""
    SELECT *, (day(CAST(ts AS DATE) + CASE WHEN event_type = 'error' THEN 3 ELSE 0 END) - 1
      + CASE WHEN month(CAST(ts AS DATE) + CASE WHEN event_type = 'error' THEN 3 ELSE 0 END) > 1 THEN 31 ELSE 0 END) // {POLL_DAYS} AS poll,
      CAST(ts AS DATE) AS day, CAST(round(value * 100) AS BIGINT) AS cents FROM events"""
CTES["poll_values"] = f"""
    SELECT user_id, day, poll, arg_max(cents, event_id) AS revenue, min(ts) AS seen FROM polled WHERE poll <> {DOWN} GROUP BY 1, 2, 3"""
CTES["poll_versions"] = """
    SELECT user_id, day, poll, revenue, min(seen) OVER (PARTITION BY user_id, day) AS seen,
      revenue IS DISTINCT FROM lag(revenue) OVER (PARTITION BY user_id, day ORDER BY poll) AS new FROM poll_values"""

_POLLED = {
    "facts": polls.Table("user_id bigint, day date, version int, revenue bigint, row_hash string, is_current boolean", "day"),
    "first_seen": polls.Table("user_id bigint, day date, first_seen timestamp", "day"),
}


def _outage(batch):
    """Refuses a poll whose sources all failed for the moment."""
    poll = F.col("poll")
    failed = poll == DOWN
    status = F.when(failed, 503).otherwise(200)
    fetched = batch.select((F.col("user_id") % 4).alias("source"), (~failed).alias("ok"), status.alias("status"), failed.alias("transient"), F.lit(False).alias("fallback_on_denied"))
    decision = jobs.gate_outcome(jobs.poll_outcome(fetched)).first()["decision"]
    if decision != "ok":
        raise polls.Refused(decision)


def _unique_current(written):
    """Refuses facts with two current rows of one key."""
    if quality.duplicate_keys(written["facts"].where("is_current"), ["user_id", "day"]).head(1):
        raise polls.Refused("two current rows of a key")


def _apply_poll(batch, current):
    keys = ["user_id", "day"]
    last = pick.last_wins(batch, keys, "event_id").select(*keys, "revenue", row_hash("event_id", "revenue").alias("row_hash"))
    facts = maintain.next_rows(maintain.apply_versions(current("facts"), last, keys, "row_hash", ["revenue"])).drop("restated")
    seen = current("first_seen").unionByName(batch.select(*keys, F.col("ts").alias("first_seen")))
    return {"facts": facts, "first_seen": seen.groupBy(*keys).agg(F.min("first_seen").alias("first_seen"))}


def polled_tables(s):
    """All events as polls in the order of arrival, each poll in a run of its own that goes on from the last."""
    folder = job_folder(s)
    ts = F.col("ts").cast("timestamp")
    arrival = F.date_add(ts.cast("date"), F.when(F.col("event_type") == "error", 3).otherwise(0))
    since = F.datediff(arrival, F.lit("2024-01-01").cast("date"))
    events = s.table("events").select(
        "event_id", "user_id", ts.alias("ts"), ts.cast("date").alias("day"), F.round(F.col("value") * 100).cast("long").alias("revenue"),
        F.floor(since / POLL_DAYS).cast("int").alias("poll"),
    )
    events = pick.stored(events)
    target = polls.Published(s.spark, f"{folder}/tables", _POLLED)
    for row in events.select("poll").distinct().orderBy("poll").collect():
        events.where(F.col("poll") == row["poll"]).write.mode("append").parquet(f"{folder}/arrived")
        stream = s.spark.readStream.schema(events.schema).parquet(f"{folder}/arrived")
        polls.apply_polls(stream, target, F.col("day"), _apply_poll, f"{folder}/checkpoint", _outage, _unique_current)
    return target


@query(
    "polled_facts",
    f"""SELECT user_id, {sql_day('day')} AS day, CAST(row_number() OVER w AS INTEGER) AS version, revenue,
      row_number() OVER (PARTITION BY user_id, day ORDER BY poll DESC) = 1 AS is_current, {sql_stamp('seen')} AS first_seen
    FROM poll_versions WHERE new WINDOW w AS (PARTITION BY user_id, day ORDER BY poll)""",
)
def polled_facts(s):
    """Facts and first sightings as the polls left them; a late day is restated, the poll without sources is not applied."""
    target = polled_tables(s)
    got = target.read("facts").join(target.read("first_seen"), ["user_id", "day"])
    return got.select("user_id", day("day"), "version", "revenue", "is_current", stamp("first_seen"))


@query(
    "poll_log",
    f"""SELECT poll AS batch, CASE WHEN poll = {DOWN} THEN 'refused' ELSE 'published' END AS decision,
      CASE WHEN poll = {DOWN} THEN 'deferred' END AS reason, CASE WHEN poll = {DOWN} THEN 0 ELSE count(DISTINCT day) END AS days FROM polled GROUP BY 1""",
)
def poll_log(s):
    return polled_tables(s).log().select("batch", "decision", "reason", F.size("touched").cast("long").alias("days"))
