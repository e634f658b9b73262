"""Touch counts kept between runs: equal to the full reduction on every day, and only changed days are written."""

import datetime as dt
import os
import tempfile
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from pulseboard.config import fixture_rules
from pulseboard.functions.dates import Anchors
from pulseboard.operators import touches as TC
from pulseboard.plans import history as HS
from pulseboard.plans import hub as H
from pulseboard.plans.job import MetricsJob
from pulseboard.plans.touch_state import TouchState
from pulseboard.sources.materialize import fixture_sources

from .conftest import SF001
from .helpers import make_sources, ts

RULES = fixture_rules()
LO, D0 = dt.date(1998, 2, 1), dt.date(1998, 6, 3)


@pytest.fixture()
def path():
    return os.path.join(tempfile.mkdtemp(prefix="pb-touch-"), "touches")


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def full(src, lo, hi):
    return TC.touch_days(TC.touch_sources(src, RULES, lo, hi))


def arrived(src, day):
    """What a run of ``day`` finds: every row reaches the tables up to four days after it happened."""
    def cut(df, key, at):
        return df.where(F.date_add(F.to_date(at), F.pmod(F.xxhash64(key), F.lit(5)).cast("int")) < F.lit(day))

    return replace(src, actions=cut(src.actions, "action_id", "closed_at"), calls_a=cut(src.calls_a, "call_id", "start_at"),
                   calls_b=cut(src.calls_b, "call_id", "inserted_at"))


def test_fourteen_daily_runs_equal_fourteen_full_reductions(spark, path):
    src, state = fixture_sources(spark, SF001), TouchState(spark, path)
    written = []
    for k in range(14):
        day = D0 + dt.timedelta(days=k)
        seen = arrived(src, day)
        written.append(state.update(seen, RULES, LO, day))
        assert rows(state.read(src, RULES, LO, day)) == rows(full(seen, LO, day)), day
    # after the first run: the day before, and the four that late rows can still belong to
    for k, days in enumerate(written[1:], 1):
        assert all(d >= D0 + dt.timedelta(days=k - 6) for d in days), (k, days)
    assert any(len(days) > 1 for days in written[1:])


def test_refresh_over_the_state_equals_the_full_one(spark, path):
    src, day, folder = fixture_sources(spark, SF001), dt.date(1998, 6, 16), os.path.dirname(path)
    state = TouchState(spark, path)
    out = {}
    for name, touches in (("state", state), ("full", None)):
        hubs, snaps = f"{folder}/hub-{name}", f"{folder}/snaps-{name}"
        for k in (1, 0):
            d = day - dt.timedelta(days=k)
            hub = HS.refresh(spark, arrived(src, d), RULES, d, hubs, snaps, touches)
        out[name] = rows(hub.drop("last_refreshed_at")), rows(HS.read_snapshots(spark, snaps))
    assert out["state"] == out["full"] and out["full"][1]


def act(i, rep, org, d, status="Closed"):
    return (i, rep, org, RULES.action_record_type, status, ts(d, 9))


def test_late_corrected_and_deleted_rows_and_the_days_left_alone(spark, path):
    days = [dt.date(1998, 6, d) for d in range(1, 7)]
    one = [act(1, "a", 1, days[0]), act(2, "a", 1, days[1]), act(3, "b", None, days[2]), act(4, None, 2, days[3])]
    state = TouchState(spark, path)
    up = lambda actions, hi=days[5], **more: state.update(make_sources(spark, actions=actions, **more), RULES, days[0], hi)
    assert up(one) == days[:4]
    before = state.table.version()
    assert up(one) == [] and state.table.version() == before
    # a repeated row, a row of another rep in place of one, a deleted day, a day that was empty
    two = [one[0], one[0], act(2, "b", 1, days[1]), one[2], act(5, "a", 1, days[4])]
    assert up(two) == [days[0], days[1], days[3], days[4]]
    after = state.table.version()
    assert after.days[str(days[2])] == before.days[str(days[2])]
    src = make_sources(spark, actions=two)
    assert rows(state.read(src, RULES, days[0], days[5])) == rows(full(src, days[0], days[5]))
    # a call that now lasts long enough counts as another thing
    call = lambda minutes: [(1, "a", 3, "completed", minutes, ts(days[1]))]
    assert up(two, calls_a=call(1.0)) == [days[1]]
    assert up(two, calls_a=call(20.0)) == [days[1]]
    assert up(two, calls_a=call(30.0)) == []
    # a changed rule
    assert state.update(src, replace(RULES, action_record_type="OTHER"), days[0], days[5]) == [days[0], days[1], days[2], days[4]]
    assert state.read(src, RULES, days[0], days[5]).count() == 0


def test_settled_days_are_not_looked_at_again(spark, path):
    days = [dt.date(1998, 6, d) for d in range(1, 9)]
    state = TouchState(spark, path, settled_days=3)
    up = lambda actions: state.update(make_sources(spark, actions=actions), RULES, days[0], days[7])
    rows_ = [act(1, "a", 1, days[0]), act(2, "a", 1, days[6])]
    assert up(rows_) == [days[0], days[6]]
    late = rows_ + [act(3, "b", 1, d) for d in (days[0], days[2], days[6])]
    assert up(late) == [days[2], days[6]]  # the third day held nothing yet, so it was not final


def test_no_touches_at_all(spark, path):
    state, src = TouchState(spark, path), make_sources(spark)
    assert state.update(src, RULES, LO, D0) == []
    assert state.read(src, RULES, LO, D0).count() == 0


def test_the_hub_reads_no_touch_table(spark, path):
    from .scans import table_scans

    src, anchors = fixture_sources(spark, SF001), Anchors.of(D0)
    job = MetricsJob(src, RULES, anchors, touch_state=TouchState(spark, path))
    try:
        scans = table_scans(H.hub(job))
        assert not {"actions", "calls_a", "calls_b"} & set(scans), scans
    finally:
        job.release()
