"""As-of lookups against brute force, with one key holding a third of the rows."""

import datetime as dt
import random

import pytest

from pulseboard.operators.common import first_on_or_after, last_before

D0 = dt.date(1998, 5, 1)


def _data(seed):
    rnd = random.Random(seed)
    orgs = [0] * 60 + list(range(1, 121))          # org 0 is hot: a third of the rows
    events = [(rnd.choice(orgs), D0 + dt.timedelta(days=rnd.randrange(60))) for _ in range(180)]
    probes = [(rnd.choice(orgs), D0 + dt.timedelta(days=rnd.randrange(60))) for _ in range(180)]
    return events, probes


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_asof_matches_brute_force(spark, seed):
    events, probes = _data(seed)
    ev = spark.createDataFrame(events, "org long, day date")
    pr = spark.createDataFrame(probes, "org long, from_day date")
    got_f = {(r.org, r.from_day): r.first_day for r in first_on_or_after(ev, pr, ["org"]).collect()}
    pr2 = pr.withColumnRenamed("from_day", "before_day")
    got_l = {(r.org, r.before_day): r.last_day for r in last_before(ev, pr2, ["org"]).collect()}
    assert set(got_f) == set(probes) and set(got_l) == set(probes)   # one row per distinct probe
    for org, d in set(probes):
        days = [e for o, e in events if o == org]
        assert got_f[(org, d)] == min((e for e in days if e >= d), default=None)
        assert got_l[(org, d)] == max((e for e in days if e < d), default=None)


@pytest.mark.parametrize("start,end,incl", [(-30, 0, False), (-60, -30, False), (-30, 0, True)])
def test_in_window(spark, start, end, incl):
    from pulseboard.functions.dates import Anchors
    from pulseboard.operators.common import in_window

    rnd = random.Random(start)
    rows = [(i, D0 + dt.timedelta(days=rnd.randrange(150))) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, day date")
    anchors = Anchors.of(*[D0 + dt.timedelta(days=40 + 2 * k) for k in range(40)])
    want = {(i, a) for i, day in rows for a in anchors.dates
            if day >= a + dt.timedelta(days=start) and (day <= a + dt.timedelta(days=end) if incl
                                                         else day < a + dt.timedelta(days=end))}
    got = {(r.id, r.anchor) for r in in_window(df, anchors, "day", start, end, incl).collect()}
    assert got == want


SIGNALS = "rep string, analysis_date date, risk_level string, cancel_intent boolean"


@pytest.mark.parametrize("offsets", [(0, 3, 9, 40), (-400, -200, 50), (2, 80), (100,), ()], ids=str)
def test_signals_as_of(spark, offsets):
    """Dates near, far before and after the anchors, and none; the hot date holds most rows, some have no date."""
    from pulseboard.functions.dates import Anchors
    from pulseboard.operators.score import interaction_signals_asof

    rows = [(f"r{k % 3}", D0 + dt.timedelta(days=o), ("high", "low", None)[k % 3], k % 2 == 0) for o in offsets for k in range(7)]
    rows += [("r0", None, "high", True)]
    anchors = Anchors.of(*[D0 + dt.timedelta(days=k) for k in (0, 1, 8, 60)])
    want = {}
    for a in anchors.dates:
        last = max((r[1] for r in rows if r[1] and r[1] <= a), default=None)
        for r in (r for r in rows if last and r[1] == last):
            n = want.setdefault((a, r[0]), [0, 0])
            n[0] += r[2] == "high"
            n[1] += r[3]
    got = interaction_signals_asof(spark.createDataFrame(rows, SIGNALS), anchors).collect()
    assert {(r[0], r[1]): [r[2], r[3]] for r in got} == want and len(got) == len(want)


def test_signal_dates_reach_the_scan(spark, capsys):
    from pulseboard.functions.dates import Anchors
    from pulseboard.operators.score import interaction_signals_asof
    from pulseboard.sources.materialize import fixture_sources

    from .conftest import SF001

    interaction_signals_asof(fixture_sources(spark, SF001).signals, Anchors.of(dt.date(1998, 6, 16))).explain("formatted")
    pushed = [x for x in capsys.readouterr().out.splitlines() if "PushedFilters" in x]
    assert len(pushed) == 1 and ("EqualTo(analysis_date" in pushed[0] or "In(analysis_date" in pushed[0]), pushed
