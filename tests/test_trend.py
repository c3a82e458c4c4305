"""Trend operators on small panels with known answers, gaps and ties."""

import datetime
import math

import pytest

from panelmill.operators import trend


@pytest.fixture(scope="module")
def panel(spark):
    def make(figures):
        """(entity, idx, revenue) as facts."""
        rows, sums = [], {}
        for e, idx, revenue in sorted(figures):
            sums[e, idx // 12] = sums.get((e, idx // 12), 0) + revenue
            rows.append((e, datetime.date(idx // 12, idx % 12 + 1, 1), idx, revenue, sums[e, idx // 12]))
        return spark.createDataFrame(rows, "entity long, month date, idx int, revenue long, ytd long")

    return make


def bridge(spark, *pairs):
    return spark.createDataFrame(list(pairs), "entity long, classification string")


START = 2020 * 12


def test_a_seasonal_panel_is_flat_once_adjusted(panel):
    season = [100, 80, 120, 100, 100, 140, 60, 100, 100, 100, 90, 110]
    facts = panel([(1, START + k, 1000 * season[k % 12]) for k in range(48)] + [(2, START + k, 7) for k in range(10)])
    got = {(r.entity, r.month): r for r in trend.seasonal_growth(facts).collect()}
    assert len(got) == 58
    assert all(abs(r.adjusted_growth) < 1e-6 and abs(r.adjusted - 100_000) < 0.5 for (e, _), r in got.items() if e == 1 and r.adjusted_growth is not None)
    assert got[1, datetime.date(2020, 2, 1)].factor == pytest.approx(0.8)
    assert all(r.factor is None and r.adjusted_growth is None for (e, _), r in got.items() if e == 2)


def test_a_missing_month_leaves_no_centred_average_over_it(panel):
    facts = panel([(1, START + k, 100 + k % 12) for k in range(60) if k != 20])
    got = {r.month: r for r in trend.seasonal_growth(facts).collect()}
    after = datetime.date(2021, 10, 1)
    assert got[after].adjusted_growth is None and got[datetime.date(2021, 11, 1)].adjusted_growth is not None


def test_inflections(panel):
    rise = [(1, START + k, 1000 + 10 * k + (k * 7) % 5) for k in range(24)]
    turn = [(2, START + k, 1000 + 10 * k + (k * 7) % 5 if k < 18 else 1180 - 200 * (k - 17)) for k in range(24)]
    got = {(r.entity, r.month.year * 12 + r.month.month - 1 - START): r for r in trend.inflections(panel(rise + turn)).collect()}
    assert got[1, 23].inflection == "none" and got[2, 23].inflection == "down"
    assert got[2, 23].recent == pytest.approx(-200, abs=1) and got[2, 23].trend == pytest.approx(10, abs=1)
    flat = trend.inflections(panel([(1, START + k, 5) for k in range(24)])).collect()
    assert all(r.score is None and r.inflection is None for r in flat)
    assert (1, 8) not in got and trend.inflections(panel([(1, START, 1)])).collect() == []


def test_concentration_without_the_largest(spark, panel):
    facts = panel([(1, START, 100), (1, START + 12, 400), (2, START, 50), (2, START + 12, 55), (3, START + 12, 400), (4, START, 10)])
    got = {r.month.year: r for r in trend.concentration(facts, bridge(spark, (1, "a"), (2, "a"), (3, "a"), (4, "a"), (9, "b")), top=2).collect()}
    r = got[2021]
    assert (r.members, r.revenue, r.yoy) == (3, 855, pytest.approx((455 / 150 - 1) * 100))
    assert r.yoy_ex_largest == pytest.approx(10) and r.top_share == pytest.approx(80000 / 855)
    assert r.herfindahl == pytest.approx((400**2 * 2 + 55**2) / 855**2 * 10000, abs=1e-3)
    assert got[2020].yoy is None and got[2020].yoy_ex_largest is None


def test_joining_and_leaving_members_change_no_link(spark, panel):
    facts = panel([(1, START + k, 100 * 2**k) for k in range(3)] + [(2, START + 1, 10**6), (2, START + 2, 2 * 10**6), (3, START + 5, 1), (3, START + 6, 3)])
    got = trend.chained_index(facts, bridge(spark, (1, "a"), (2, "a"), (3, "a"))).orderBy("month").collect()
    assert [(r.matched, r.link, r.chain, r["index"]) for r in got] == [
        (0, None, 1, 100.0), (1, 2.0, 1, 200.0), (2, 2.0, 1, 400.0), (0, None, 2, 100.0), (1, 3.0, 2, pytest.approx(300.0)),
    ]
    assert all(math.isfinite(r["index"]) for r in got)


def test_quarters(panel):
    facts = panel([(1, START + k, 10 + k) for k in range(6)] + [(2, START + 4, 5), (2, START + 5, 6)])
    got = {(r.entity, r.quarter.month): r for r in trend.quarter_totals(facts).collect()}
    assert [(got[1, m].months, got[1, m].revenue, got[1, m].by_ytd, got[1, m].difference) for m in (1, 4)] == [(3, 33, 33, 0), (3, 42, 42, 0)]
    assert got[2, 4].by_ytd is None and got[2, 4].difference is None
