"""Operators on small frames: fixtures, brute force, and busy keys."""

import random

import pytest
from conftest import SMALL, rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from panelmill.functions import js_round, roc_date, roc_month, rolling_months, target_month
from panelmill.functions.months import clock_text, iso_date, us_date
from panelmill.operators import forecast, groups, maintain, match, panel, pick, quality
from panelmill.streaming import jobs

NOW = "2026-07-29 12:00:00"


def dated(df, *columns):
    return df.withColumns({c: F.col(c).cast("date") for c in columns})


def history(spark, items):
    schema = "entity int, kind string, month string, release_date string, release_minute int"
    return dated(spark.createDataFrame(items, schema), "month", "release_date")


def months(first_year, first_month, n):
    out = []
    for i in range(n):
        k = first_year * 12 + first_month - 1 + i
        out.append(f"{k // 12}-{k % 12 + 1:02d}-01")
    return out


def offset_items(spark, kind, names, offsets):
    frame = history(spark, [(1, kind, m, "2000-01-01", 900) for m in names])
    pairs = spark.createDataFrame(list(zip(names, offsets)), "m string, o int")
    joined = frame.join(pairs, F.col("month") == F.col("m").cast("date"))
    return joined.withColumn("release_date", F.date_add(F.last_day("month"), F.col("o"))).drop("m", "o")


def test_profiles(spark):
    steady = offset_items(spark, "actual", months(2026, 1, 6), [5] * 6)
    assert rows(forecast.release_profile(steady), "samples", "median_offset", "mad_days", "confidence") == [(6, 5.0, 0.0, "high")]
    year = offset_items(spark, "actual", months(2025, 6, 13), [1] + [8] * 12)
    assert rows(forecast.release_profile(year), "samples", "median_offset", "as_of_month") == [(12, 8.0, "2026-06-01")]
    proxy = offset_items(spark, "proxy", months(2026, 1, 6), [6] * 6)
    assert rows(forecast.release_profile(proxy), "samples", "actual_samples", "confidence") == [(6, 0, "medium")]
    both = history(spark, [(1, "proxy", "2026-06-01", "2026-07-08", 900), (1, "actual", "2026-06-01", "2026-07-05", 840)])
    assert rows(forecast.release_profile(both), "samples", "actual_samples", "median_offset") == [(1, 1, 5.0)]


def schedule_row(spark, month, deadline, **given):
    base = {
        "entity": 1, "month": month, "deadline": deadline, "samples": 0, "median_offset": None, "median_minute": None,
        "mad_days": None, "method": "regulatory_prior", "confidence": "low", "is_fallback": False, "announced_date": None,
        "announced_time": None, "actual_date": None, "actual_time": None, "actual_at": None, "has_revenue": False,
    }
    base.update(given)
    schema = (
        "entity int, month string, deadline string, samples int, median_offset double, median_minute double, mad_days double, "
        "method string, confidence string, is_fallback boolean, announced_date string, announced_time string, actual_date string, "
        "actual_time string, actual_at string, has_revenue boolean"
    )
    frame = dated(spark.createDataFrame([tuple(base.values())], schema), "month", "deadline", "announced_date", "actual_date")
    return forecast.schedule_rows(frame.withColumn("actual_at", F.col("actual_at").cast("timestamp")), NOW)


def test_blend_and_schedule(spark):
    early = history(spark, [(1, "actual", "2026-05-01", "2026-06-05", 1020), (2, "actual", "2026-05-01", "2026-06-11", 1020)])
    fallback = forecast.fallback_profile(forecast.release_profile(early))
    assert rows(fallback, "median_offset", "mad_days", "entities") == [(8.0, 3.0, 2)]
    own = forecast.release_profile(history(spark, [(9, "actual", "2026-06-01", "2026-07-02", 1020)]))
    blended = forecast.blend(own, fallback).collect()[0]
    assert round(blended.median_offset) == 6 and blended.mad_days == 3.0 and blended.method == "historical_estimate"
    row = schedule_row(spark, "2026-07-01", "2026-08-10", samples=1, median_offset=blended.median_offset, mad_days=3.0)
    assert rows(row, "expected_date", "schedule_source") == [("2026-08-06", "company_history")]
    thick = forecast.release_profile(offset_items(spark, "actual", months(2026, 1, 3), [5] * 3))
    assert rows(forecast.blend(thick, fallback), "median_offset", "method") == [(5.0, "company_history")]
    none = forecast.complete_profiles(spark.createDataFrame([(7,)], "entity int"), thick)
    assert rows(forecast.blend(none, fallback), "median_offset", "is_fallback") == [(8.0, True)]
    assert rows(forecast.blend(none, fallback.limit(0)), "median_offset", "method") == [(None, "regulatory_prior")]


def test_schedule_cases(spark):
    early = schedule_row(spark, "2026-09-01", "2026-10-08", samples=12, median_offset=10.0, mad_days=0.0, method="company_history", announced_date="2026-10-08", announced_time="17:00:00")
    assert rows(early, "effective_date", "schedule_source", "status", "unusual", "unusual_reason", "announced_at") == [
        ("2026-10-08", "ir_calendar", "announced", 1, "EARLY", "2026-10-08 09:00:00")
    ]
    overdue = schedule_row(spark, "2026-06-01", "2026-07-10", samples=10, median_offset=5.0, mad_days=0.0, method="company_history")
    assert rows(overdue, "status", "effective_date", "unusual_reason", "deviation_days") == [("overdue", "2026-07-05", "LATE_NOT_YET_REPORTED", 24)]
    prior = schedule_row(spark, "2026-07-01", "2026-08-10")
    assert rows(prior, "expected_date", "window_start", "window_end", "status", "schedule_source") == [("2026-08-10", "2026-08-01", "2026-08-10", "forecast", "regulatory_prior")]
    late = schedule_row(spark, "2026-06-01", "2026-07-10", samples=4, median_offset=5.0, mad_days=1.0, actual_date="2026-07-11", has_revenue=True)
    assert rows(late, "status", "unusual_reason", "deviation_days") == [("reported", "AFTER_REGULATORY_DEADLINE", 6)]
    filled = schedule_row(spark, "2026-06-01", "2026-07-10", samples=4, median_offset=5.0, mad_days=1.0, has_revenue=True)
    assert rows(filled, "status", "unusual") == [("historical_backfill", 0)]
    clamped = schedule_row(spark, "2026-07-01", "2026-08-10", median_offset=9.0, mad_days=4.0, is_fallback=True)
    assert rows(clamped, "window_end") == [("2026-08-10",)]


def test_deadline_moves_before_holidays(spark):
    from panelmill.functions import release_deadlines

    m = dated(spark.createDataFrame([("2026-09-01",)], "month string"), "month")
    h = dated(spark.createDataFrame([("2026-10-09",)], "holiday string"), "holiday")
    assert rows(release_deadlines(m, h)) == [("2026-09-01", "2026-10-08")]
    assert rows(release_deadlines(m, h.limit(0))) == [("2026-09-01", "2026-10-09")]


def test_months(spark):
    at = spark.createDataFrame([("2026-08-01 00:30:00",), ("2026-07-31 15:30:00",), ("2026-07-31 16:30:00",)], "t string")
    got = at.select(target_month(F.col("t").cast("timestamp")).alias("m"), F.element_at(rolling_months(F.col("t").cast("timestamp")), 1).alias("f"))
    assert [tuple(str(v) for v in r) for r in got.collect()] == [("2026-07-01", "2025-08-01"), ("2026-06-01", "2025-07-01"), ("2026-07-01", "2025-08-01")]
    texts = spark.createDataFrame([("115/7", "1150231", "2026-02-31", "13/1/2026", "9:05")], "a string, b string, c string, d string, e string")
    got = texts.select(roc_month("a"), roc_date("b"), iso_date("c"), us_date("d"), clock_text("e")).collect()[0]
    assert [str(v) for v in got] == ["2026-07-01", "None", "None", "None", "09:05:00"]
    assert rows(spark.createDataFrame([(-2.5,), (2.5,), (None,), (float("nan"),), (float("inf"),)], "x double").select(js_round("x", 0))) == [(-2.0,), (3.0,), (None,), (None,), (None,)]


def test_translation(spark):
    facts = dated(spark.createDataFrame([(1, "2026-01-01", 3200, 10.0), (1, "2026-02-01", 3400, 20.0), (1, "2026-03-01", None, 5.0), (1, "2026-04-01", 3200, 5.0), (1, "2027-01-01", 3600, 30.0)], "entity int, month string, revenue long, yoy double"), "month")
    rates = dated(spark.createDataFrame([("2026-01-01", 32.0), ("2026-02-01", 34.0), ("2026-03-01", 34.0), ("2026-04-01", 32.0), ("2027-01-01", 36.0)], "month string, average_rate double"), "month")
    rates = rates.withColumns({"observations": F.lit(1).cast("long"), "last_date": F.col("month")})
    got = panel.translate_checked(facts, rates).orderBy("month")
    assert [(r.revenue_usd, r.ytd_usd, r.yoy) for r in got.collect()] == [(100.0, 100.0, 10.0), (100.0, 200.0, 20.0), (None, None, 5.0), (100.0, 300.0, 5.0), (100.0, 100.0, 30.0)]
    with pytest.raises(PySparkException, match="Missing exchange rate for 2027-01"):
        panel.translate_checked(facts, rates.where("month < '2027-01-01'")).collect()


def random_panel(spark, seed=3):
    rng = random.Random(seed)
    data = {(e, 24000 + k): rng.choice([None, 0, rng.randrange(1, 1000)]) for e in range(6) for k in range(40) if rng.random() < 0.8}
    names = [(e, f"{i // 12}-{i % 12 + 1:02d}-01", v) for (e, i), v in data.items()]
    return data, dated(spark.createDataFrame(names, "entity int, month string, revenue long"), "month")


def test_window_momentum_against_brute_force(spark):
    data, frame = random_panel(spark)
    lo, hi = min(i for _, i in data), max(i for _, i in data)

    def total(e, end, n):
        values = [data.get((e, end - k)) for k in range(n)]
        return None if any(v is None for v in values) else sum(values)

    def grow(a, b):
        return None if a is None or not b else (a / b - 1) * 100

    def rounded(x):
        import math

        return None if x is None else math.floor(x * 100 + 0.5) / 100

    want = []
    for e in range(6):
        for i in range(lo, hi + 1):
            for period, n, *_ in panel.PERIODS:
                if period == "yoy":
                    cur, prior, before, base = total(e, i, 1), total(e, i - 12, 1), total(e, i - 1, 1), total(e, i - 13, 1)
                else:
                    cur, prior = total(e, i, n), total(e, i - n, n)
                    before, base = prior, total(e, i - 2 * n, n)
                now, then = grow(cur, prior), grow(before, base)
                acc = None if now is None or then is None else rounded(now - then)
                want.append((e, f"{i // 12}-{i % 12 + 1:02d}-01", period, cur, prior, rounded(now), rounded(then), acc))
    got = rows(panel.window_momentum(frame), "entity", "month", "period", "current_revenue", "prior_revenue", "current_growth", "previous_growth", "acceleration")
    assert got == sorted(want, key=repr)

    dim = spark.createDataFrame([(e, "x") for e in range(7)], "entity int, classification string")
    facts = frame.withColumns({c: F.lit(None).cast("double") for c in ("mom", "yoy", "ytd_yoy")})
    snap = panel.momentum(dim, facts).where("analysis_month IS NOT NULL")
    by_key = {(e, m, p): t for e, m, p, *t in got}
    for r in snap.collect():
        expected = by_key.get((r.entity, str(r.analysis_month), r.period), [None] * 5)
        assert [r.current_revenue, r.prior_revenue, r.current_growth, r.previous_growth, r.acceleration] == list(expected)
    assert rows(panel.momentum(dim, facts).where("entity = 6 AND key = 'mix'").select("direction").distinct()) == [("unavailable",)]


def test_ascending_gate(spark):
    rng = random.Random(1)
    data = [(e, s, f"{2000 + rng.randrange(20)}-01-01") for e in range(3) for s in range(200)]
    frame = dated(spark.createDataFrame(data, "entity int, seq int, month string"), "month")
    want = [(e, s) for (e, s, m), (f, _, p) in zip(data[1:], data) if e == f and m <= p]
    for segment in (1, 7, 1000):
        assert rows(panel.check_ascending(frame, segment=segment), "entity", "seq") == sorted(want, key=repr)


def test_global_rank_with_ties_and_nulls(spark):
    rng = random.Random(5)
    data = [(i, rng.choice([None, 1.0, 1.0, 1.0, rng.random()])) for i in range(3000)]
    frame = spark.createDataFrame(data, "id int, v double").repartition(7)
    got = pick.global_rank(frame, [F.desc_nulls_last("v"), F.asc("id")])
    order = sorted(data, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert sorted((r["rank"], r["id"]) for r in got.collect()) == [(n + 1, i) for n, (i, _) in enumerate(order)]


def test_tolerance_match_against_brute_force(spark):
    rng = random.Random(9)
    key = lambda: 1 if rng.random() < 0.4 else rng.randrange(2, 9)  # one busy key
    claims = [(i, key(), rng.randrange(-3000, 3000), rng.choice([0, 1, 50, 500, 501]), rng.choice([None, 0.0, 0.05, 1.0])) for i in range(400)]
    claims += [(1000 + i, 1, 77, 50, None) for i in range(200)]  # copies
    seen = [(i, key(), rng.randrange(-3000, 3000), rng.random() < 0.3, rng.choice([None, 0.0, 0.1])) for i in range(400)]
    seen += [(1000 + i, 1, 80, False, 0.1) for i in range(200)]
    want = []
    for r, e, v, t, p in claims:
        good = [(not c, o) for o, f, w, c, q in seen if f == e and abs(v - w) <= t and (p is None or q is None or abs(p - q) <= 0.06)]
        if good:
            want.append((r, min(good)[1]))
    c = spark.createDataFrame(claims, "record_id int, entity int, revenue long, tolerance long, mom double")
    o = spark.createDataFrame(seen, "obs_id int, entity int, revenue long, is_current boolean, mom double")
    got = match.tolerance_match(c, o, keys=["entity"], percents=["mom"])
    assert rows(got, "record_id", "obs_id") == sorted(want, key=repr)
    assert "CartesianProduct" not in got._jdf.queryExecution().toString()


def join_rows(frame):
    """Most rows that a join of the executed plan gave."""
    frame.collect()
    most, todo = 0, [frame._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            todo.append(node.plan())
        elif "Join" in name and node.metrics().contains("numOutputRows"):
            most = max(most, node.metrics().apply("numOutputRows").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return most


def test_tolerance_match_of_one_dense_key(spark):
    rng = random.Random(4)
    n = 4000
    claims = [(i, 1, rng.randrange(20_000), rng.choice([0, 700, 5000, -1]), rng.choice([None, 0.0, 0.1, 0.2])) for i in range(n)]
    seen = [(i, 1, rng.randrange(20_000), rng.random() < 0.001, rng.choice([None, 0.0, 0.05, 0.1])) for i in range(n)]
    want, best_first = [], sorted(seen, key=lambda o: (not o[3], o[0]))
    for r, _, v, t, p in claims:
        for o, _, w, c, q in best_first:
            if abs(v - w) <= t and (p is None or q is None or abs(p - q) <= 0.06):
                want.append((r, o, c, w, q))
                break
    c = spark.createDataFrame(claims, "record_id int, entity int, revenue long, tolerance long, mom double")
    o = spark.createDataFrame(seen, "obs_id int, entity int, revenue long, is_current boolean, mom double")
    got = match.tolerance_match(c, o, keys=["entity"], percents=["mom"])
    assert rows(got, "record_id", "obs_id", "is_current", "matched_revenue", "matched_mom") == sorted(want, key=repr)
    assert join_rows(got) <= 12 * n
    empty = o.where("obs_id < 0")
    assert match.tolerance_match(c, empty, keys=["entity"], percents=["mom"]).count() == 0
    odd = spark.createDataFrame([(1, None, 5, 5, None), (2, 1, None, 5, None), (3, 1, 5, None, None)], c.schema)
    assert match.tolerance_match(odd, o, keys=["entity"], percents=["mom"]).count() == 0


def test_tolerance_match_of_few_observations_reads_claims_once(spark, tmp_path):
    rng = random.Random(11)
    sizes = {1: 1, 2: 2, 3: match.FEW, 4: match.FEW + 1}
    claims = [(i, rng.randrange(1, 6), rng.randrange(300), rng.choice([0, 20, 90, -1, None]), rng.choice([None, 0.0, 0.1])) for i in range(300)]
    seen = [(10 * e + k, e, rng.randrange(300), rng.choice([None, False, True]), rng.choice([None, 0.0, 0.1])) for e, n in sizes.items() for k in range(n)]
    rank = {True: 0, False: 1, None: 2}

    def want(most):
        best = []
        for r, e, v, t, p in claims:
            near = lambda w, q: t is not None and abs(v - w) <= t and (p is None or q is None or abs(p - q) <= 0.06)
            good = [(rank[c], o, c, w, q) for o, f, w, c, q in seen if f == e and sizes[e] <= most and near(w, q)]
            if good:
                best.append((r, *min(good, key=lambda g: g[:2])[1:]))
        return sorted(best, key=repr)

    folder = str(tmp_path / "claims")
    spark.createDataFrame(claims, "record_id int, entity int, revenue long, tolerance long, mom double").write.parquet(folder)
    c = spark.read.parquet(folder)
    o = spark.createDataFrame(seen, "obs_id int, entity int, revenue long, is_current boolean, mom double")
    columns = ["record_id", "obs_id", "is_current", "matched_revenue", "matched_mom"]
    few = match.tolerance_match(c, o.where("entity < 4"), keys=["entity"], percents=["mom"])
    assert rows(few, *columns) == want(match.FEW)
    assert few._jdf.queryExecution().optimizedPlan().toString().count("Relation [record_id") == 1
    mixed = match.tolerance_match(c, o, keys=["entity"], percents=["mom"])
    assert rows(mixed, *columns) == want(match.FEW + 1)


def test_retention_of_distinct_months(spark):
    data = [(1, f"{2000 + k % 15}-01-01", k) for k in range(60)] + [(2, "2000-01-01", 1)]
    frame = dated(spark.createDataFrame(data, "entity int, month string, n int"), "month")
    kept = pick.retain_latest_distinct(frame)
    assert quality.over_retention(frame).count() == 1 and quality.over_retention(kept).count() == 0
    assert kept.count() == sum(1 for _, m, _ in data if m >= "2003-01-01") + 1


def test_bridge_and_groups(spark):
    universe = spark.createDataFrame([(1, "1", "a", " x ; y;"), (2, "2", "b", "x")], "entity int, ticker string, name string, labels string")
    bridge = groups.build_bridge(universe)
    assert rows(bridge) == [(1, "x", 1), (1, "y", 2), (2, "x", 1)]
    assert rows(groups.unknown_labels(bridge, spark.createDataFrame([("x",)], "classification string")), "classification") == [("y",)]
    facts = dated(spark.createDataFrame([(1, "2026-01-01", 100, 10.0), (2, "2026-01-01", 300, 30.0), (1, "2026-02-01", -50, 5.0)], "entity int, month string, revenue long, yoy double"), "month")
    assert rows(groups.group_growth(facts, bridge)) == [
        ("x", "2026-01-01", 400, 2, 20.0, 25.0), ("x", "2026-02-01", -50, 1, 5.0, None),
        ("y", "2026-01-01", 100, 1, 10.0, 10.0), ("y", "2026-02-01", -50, 1, 5.0, None),
    ]
    members = groups.snapshot_members(universe.drop("labels"), facts, bridge)
    snapshot = groups.group_snapshot(members)
    assert rows(snapshot.where("key = '2025-12'"), "classification", "aggregate_revenue", "reporting") == [("x", 0, 0), ("y", 0, 0)]
    assert rows(snapshot.where("key = 'mix' AND classification = 'x'"), "aggregate_revenue", "simple_yoy", "weighted_yoy") == [(250, 17.5, 30.0)]
    assert quality.reconcile_groups(snapshot, members).count() == 0
    parts = groups.constituents(members).where("key = '2026-01' AND classification = 'x'")
    assert rows(parts, "ticker", "revenue_weight", "simple_contribution", "weighted_contribution") == [("1", 25.0, 5.0, 2.5), ("2", 75.0, 15.0, 22.5)]


def test_gates(spark):
    frame = spark.createDataFrame([(1, "a", 5), (1, "b", -1), (2, None, None)], "k int, s string, v int")
    assert rows(quality.duplicate_keys(frame, ["k"])) == [(1, 2)]
    assert rows(quality.domain(frame, {"v": F.col("v") >= 0, "s": F.col("s") == "a"}), F.array_join("broken", ",")) == [("v,s",)]
    assert rows(quality.foreign_key(frame, "s", frame.where("s = 'a'"), "s"), "s") == [("b",)]
    with pytest.raises(quality.GateError):
        quality.require_empty(frame, "rows")
    quality.require_empty(frame.limit(0), "rows")


def test_sources_and_events(spark):
    schema = "source_id string, entity int, source_type string, source_url string, parser_name string, source_priority int, enabled boolean, content_hash string, last_success_at timestamp, last_error_at timestamp, last_error_message string"
    stored = spark.createDataFrame([("s1", 1, "t", "old", "umc", 1, True, "h", None, None, "denied")], schema)
    poll = lambda url, denied, error, h: spark.createDataFrame([(1, "t", url, "umc", 1, True, denied, error, h)], "entity int, source_type string, source_url string, parser_name string, source_priority int, enabled boolean, unavailable boolean, error string, content_hash string")
    moved = maintain.apply_sources(stored, poll("new", False, None, "h2"), NOW)
    assert rows(moved, "source_id", "source_url", "last_error_message", "content_changed", "action") == [("s1", "new", None, True, "update")]
    turns = poll("a-new", False, None, "h3").withColumn("poll_order", F.lit(2)).unionByName(poll("z-new", False, None, "h2").withColumn("poll_order", F.lit(1)))
    turns = turns.unionByName(poll("z-new", False, "broken", None).withColumn("poll_order", F.lit(0)))
    assert rows(maintain.apply_sources(stored, turns, NOW), "source_id", "source_url", "content_hash", "action") == [("s1", "a-new", "h3", "update")]
    denied = maintain.apply_sources(stored, poll("old", True, None, None), NOW)
    assert rows(denied, "last_error_message", "content_hash", "action") == [(None, "h", "update")]
    failed = maintain.apply_sources(stored, poll("old", False, "found no events", None), NOW)
    assert rows(failed, "last_error_message", "action") == [("found no events", "update")]
    again = maintain.apply_sources(maintain.next_rows(failed).drop("content_changed"), poll("old", False, "found no events", None), NOW)
    assert rows(again, "action") == [("keep",)]


def test_poll_gate(spark):
    attempts = lambda items: spark.createDataFrame(items, "source string, status int, ok boolean, transient boolean, fallback_on_denied boolean")
    deferred = jobs.poll_outcome(attempts([(m, 307, False, True, False) for m in ("sii", "otc", "rotc", "pub")]))
    assert rows(jobs.gate_outcome(deferred)) == [(4, "deferred")]
    failed = jobs.poll_outcome(attempts([("sii", 404, False, False, False), ("otc", 307, False, True, False)]))
    assert rows(jobs.gate_outcome(failed)) == [(2, "error")]
    denied = jobs.poll_outcome(attempts([("a", 403, False, False, True), ("a", 401, False, False, True), ("b", 403, False, False, False)]))
    assert rows(denied, "source", "outcome") == [("a", "unavailable"), ("b", "error")]


def test_stream_batches_replay_and_gate(spark, tmp_path):
    keys = ["user_id", "event_type"]
    from panelmill.functions import row_hash

    def prepare(batch):
        last = pick.last_wins(batch, keys, "event_id").withColumn("revenue", F.round(F.col("value") * 100).cast("long"))
        return last.select(*keys, "revenue", row_hash("event_id", "revenue").alias("row_hash"))

    events = spark.read.parquet(f"{SMALL}/events.parquet")
    folder = str(tmp_path / "in")
    for part in range(3):
        events.where(F.col("event_id") % 3 == part).coalesce(1).write.mode("append").parquet(folder)
    empty = spark.createDataFrame([], "user_id bigint, event_type string, version int, revenue bigint, row_hash string, is_current boolean")
    stream = jobs.read_stream(spark, folder, files_per_batch=1)
    got = jobs.stream_apply(stream, empty, prepare, keys, "row_hash", ["revenue"], str(tmp_path / "out"))
    assert quality.duplicate_keys(got.where("is_current"), keys).count() == 0
    assert got.where("is_current").count() == events.select(*keys).distinct().count()
    assert got.agg(F.max("version")).collect()[0][0] > 1
    again = jobs.stream_apply(jobs.read_stream(spark, folder), empty, prepare, keys, "row_hash", ["revenue"], str(tmp_path / "out"))
    assert rows(again) == rows(got)  # a restart without new input keeps every row
    held = jobs.stream_apply(jobs.read_stream(spark, folder), empty, prepare, keys, "row_hash", ["revenue"], str(tmp_path / "held"), gate=lambda b: False)
    assert held.count() == 0


def test_exact_group_figures_do_not_depend_on_row_order(spark):
    yoys = [70.1751, -76.7656, -36.5082, -65.2413]  # their average lies on the edge of two roundings
    schema = "classification string, key string, revenue long, yoy double"
    rows_of = lambda order: spark.createDataFrame([("c", "2001-05", 10, y) for y in order], schema).coalesce(1)
    figures = lambda order: groups.group_snapshot(rows_of(order), exact=True)
    assert figures(yoys).collect()[0].simple_yoy == figures(yoys[::-1]).collect()[0].simple_yoy
    odd = figures([0.1234567, 0.2])  # not six digits: averaged as doubles
    assert odd.collect()[0].simple_yoy == 0.16


def test_window_momentum_needs_no_frame_per_window(spark):
    from panelmill.operators import panel

    facts = spark.sql("SELECT 1L AS entity, add_months(DATE'2000-01-01', CAST(id AS INT)) AS month, id * id + 7 AS revenue FROM range(60) WHERE id NOT IN (3, 30)")
    dense = panel.densify(facts)
    windows = {f"w{n}_{lag}": (n, lag) for n, lag in [(1, 0), (1, 13), (3, 3), (6, 12), (12, 0), (12, 24), (5, 2)]}
    frames = dense.withColumns({k: panel.period_sum("revenue", *w) for k, w in windows.items()})
    assert rows(panel.complete_sums(dense, windows), "month", *windows) == rows(frames, "month", *windows)
    assert "rangeframe" not in panel.window_momentum(facts)._jdf.queryExecution().optimizedPlan().toString().lower()


def test_versions_meet_in_one_shuffle(spark):
    from panelmill.operators import maintain

    cur = spark.createDataFrame(
        [(1, 1, "a", 5, False), (1, 2, "b", 6, True), (2, 1, "a", 5, True), (3, 1, "a", 5, True), (None, 4, "n", 1, True), (5, 2, "x", 1, False)],
        "k int, version int, row_hash string, v int, is_current boolean",
    )
    inc = spark.createDataFrame([(1, "a", 5), (2, "z", 5), (3, "q", 9), (None, "n", 1), (None, "m", 2), (4, "f", 3), (5, "y", 2)], "k int, row_hash string, v int")
    got = maintain.apply_versions(cur, inc, ["k"], "row_hash", ["v"])
    assert rows(got) == sorted(
        [
            (1, 1, "a", 5, True, "reactivate", True), (1, 2, "b", 6, False, "deactivate", False), (2, 1, "a", 5, True, "keep", False),
            (3, 1, "a", 5, False, "deactivate", False), (3, 2, "q", 9, True, "insert", True), (4, 1, "f", 3, True, "insert", False),
            (5, 2, "x", 1, False, "keep", False), (5, 3, "y", 2, True, "insert", False),
            (None, 4, "n", 1, True, "keep", False), (None, 1, "n", 1, True, "insert", False), (None, 1, "m", 2, True, "insert", False),
        ],
        key=repr,
    )
    assert got.select("*")._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1


def test_folded_notes_bounds_its_batches(spark):
    from conftest import SMALL

    from panelmill import plans

    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    try:
        for asked, used in (("10000", "1000"), ("0", "1000"), ("50", "50")):
            spark.conf.set(key, asked)
            assert plans.queries()["folded_notes"](spark, SMALL).count() == 200 and spark.conf.get(key) == used
    finally:
        spark.conf.set(key, before)
