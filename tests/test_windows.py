"""Every window of the rules is a real parameter: each changes the oracle's hub, and the
hub and the history rows for other values equal the oracle built from the same values."""

import dataclasses
import datetime as dt

import pytest

from pulseboard.config import fixture_rules
from pulseboard.functions.dates import Anchors
from pulseboard.operators import score as S
from pulseboard.oracle import sql
from pulseboard.oracle.compare import compare, duckdb_connection
from pulseboard.plans import history as HS
from pulseboard.plans import hub as H
from pulseboard.plans.job import MetricsJob
from pulseboard.sources.materialize import fixture_sources

from .conftest import SF01

DATES = (dt.date(1998, 6, 10), dt.date(1998, 6, 16))
OTHER = {
    "touch_window_days": 10, "sla_window_days": 45, "churn_window_days": 12, "call_window_days": 7, "call_history_days": 90,
    "renewal_lookback_days": 60,
}


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF01)


@pytest.mark.parametrize("name", sorted(OTHER))
def test_each_window_changes_the_hub(con, name):
    rows = [sorted(map(str, con.execute(sql.build(list(DATES), rules, "select * from hub")).fetchall()))
            for rules in (fixture_rules(), dataclasses.replace(fixture_rules(), **{name: OTHER[name]}))]
    assert rows[0] != rows[1] and rows[0]


def test_hub_with_other_windows(spark, con):
    rules = dataclasses.replace(fixture_rules(), **OTHER)
    got = H.hub(MetricsJob(fixture_sources(spark, SF01), rules, Anchors.of(*DATES)))
    res = compare(got, con, sql.build(list(DATES), rules, "select * from hub"))
    assert res["ok"], res


def test_history_with_other_windows(spark, con):
    rules = dataclasses.replace(fixture_rules(), **OTHER, backfill_call_window_days=20)
    src, a = fixture_sources(spark, SF01), Anchors.of(*DATES)
    res = compare(HS.backfill_rows(src, rules, a), con, sql.build(list(DATES), rules, "select * from backfill_rows"))
    assert res["ok"], res


def test_a_name_listed_twice_counts_per_listing_unless_deduped(spark):
    from .helpers import make_sources, rep_row

    day = dt.date(1998, 6, 16)
    src = make_sources(spark, roster=[rep_row(1, "a"), rep_row(2, "a"), rep_row(3, "b")])
    assert MetricsJob(src, fixture_rules(), Anchors.of(day)).allow.count() == 3
    once = MetricsJob(src, fixture_rules(), Anchors.of(day), dedupe=True).allow.collect()
    assert sorted((r.rep, r.user_id) for r in once) == [("a", 1), ("b", 3)]


def test_as_of_signals_read_only_the_needed_dates(spark):
    rows = [("r", k, dt.date(1998, 6, d), True, 1.0, "high", True, 0.5) for k, d in enumerate((1, 1, 5, 9, 20))]
    df = spark.createDataFrame(rows, "rep string, org long, analysis_date date, is_latest boolean, risk_score double, "
                                     "risk_level string, cancel_intent boolean, sentiment double")
    got = S.interaction_signals_asof(df, Anchors.of(dt.date(1998, 5, 1), dt.date(1998, 6, 4), dt.date(1998, 6, 9))).collect()
    assert sorted((r.anchor.day, r.high_risk_org_count) for r in got) == [(4, 2), (9, 1)]
