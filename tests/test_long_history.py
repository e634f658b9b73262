"""Windowed metrics over many anchors: the plans without row copies against those that copy, and no explode of windows."""

import datetime as dt

import pytest

from pulseboard.config import fixture_rules
from pulseboard.functions.dates import Anchors
from pulseboard.operators import calls as C
from pulseboard.operators import touches as T
from pulseboard.operators.common import MANY_ANCHORS
from pulseboard.plans.job import MetricsJob
from pulseboard.sources import load_fixture_sources

from .conftest import SF001

YEAR = Anchors.between(dt.date(1997, 6, 17), dt.date(1998, 6, 17))
GAPS = Anchors.of(*[dt.date(1998, 1, 1) + dt.timedelta(days=k * k) for k in range(12)])


def figures(job, anchors):
    return {
        "touch": T.touch_rate_from_days(job.rep_days, anchors, job.rules.touch_window_days),
        "calls": C.call_metrics(job.src, job.allow, anchors, 30, daily=job.call_days),
        "calls before": C.call_metrics(job.src, job.allow, anchors, 30, include_anchor_day=False, daily=job.call_days),
        "previous": C.call_metrics_prev(job.src, job.allow, anchors, 30, 60, daily=job.call_days),
    }


@pytest.mark.parametrize("anchors", [YEAR, GAPS], ids=["a year", "gaps"])
def test_equal_to_copied_rows(spark, monkeypatch, anchors):
    assert len(anchors.dates) >= MANY_ANCHORS
    job = MetricsJob(load_fixture_sources(spark, SF001), fixture_rules(), anchors)
    try:
        new = figures(job, anchors)
        with monkeypatch.context() as m:
            for module in (C, T):
                m.setattr(module, "MANY_ANCHORS", 10**6)
            old = figures(job, anchors)
        for name, df in new.items():
            a, b = (sorted(map(str, x.select(*sorted(x.columns)).collect())) for x in (df, old[name]))
            assert a == b and len(a) > 0, name
    finally:
        job.release()


def test_rows_are_not_copied_to_the_days_of_their_windows(spark, capsys):
    job = MetricsJob(load_fixture_sources(spark, SF001), fixture_rules(), YEAR)
    try:
        for name, df in figures(job, YEAR).items():
            capsys.readouterr()
            df.explain("formatted")
            text = capsys.readouterr().out
            assert "sequence(" not in text, name
    finally:
        job.release()
