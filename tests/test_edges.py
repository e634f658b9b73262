"""Edge rows of FIXTURES.md section C, built by hand."""

import datetime as dt

from pyspark.sql import functions as F

from pulseboard.config import Rules
from pulseboard.functions.dates import Anchors, business_deadline
from pulseboard.functions.numeric import round_half_up
from pulseboard.functions.text import title_case
from pulseboard.operators import roster as R
from pulseboard.operators import score as S
from pulseboard.operators import sla as SL
from pulseboard.operators import touches as T
from pulseboard.plans.job import MetricsJob

from .helpers import make_sources, rep_row, ts

A = dt.date(1998, 6, 16)  # a Tuesday
RULES = Rules()


def test_business_deadline_by_weekday(spark):
    # 1998-06-14 is a Sunday; offsets Sun..Sat = 2,2,2,2,4,4,3
    days = [dt.date(1998, 6, 14) + dt.timedelta(days=i) for i in range(7)]
    df = spark.createDataFrame([(d,) for d in days], "d date").select("d", business_deadline("d").alias("x"))
    got = {r.d: (r.x - r.d).days for r in df.collect()}
    assert [got[d] for d in days] == [2, 2, 2, 2, 4, 4, 3]


def test_round_half_up_and_title_case(spark):
    r = spark.range(1).select(
        round_half_up(F.lit(0.285), 2).alias("a"), round_half_up(F.lit(-0.125), 2).alias("b"),
        title_case(F.lit("home-decor us/can")).alias("t"), title_case(F.lit(None).cast("string")).alias("n"),
    ).first()
    assert (r.a, r.b, r.t, r.n) == (0.29, -0.13, "Home-Decor Us/Can", None)


def test_allowlist_nulls_and_bag(spark):
    src = make_sources(spark, roster=[
        rep_row(1, "a"), rep_row(2, "b", role=None), rep_row(3, "c", loc="Perth, Australia"),
        rep_row(4, "d", title="Senior Customer Success Manager"), rep_row(5, "e", title="csm lead"),
        rep_row(6, "f", role="manager x"), rep_row(7, "g", title="AE"), rep_row(8, "a"),
        rep_row(9, "x", title="AE"),
    ])
    rules = Rules(exception_names=("x", "a"))
    names = sorted(r.rep for r in R.rep_allowlist(src.roster, rules).collect())
    # null role dropped, Australia dropped, manager role dropped, "a" twice in the
    # roster and once more as an exception -> three rows (UNION ALL)
    assert names == ["a", "a", "a", "a", "d", "e", "x"]


def _touch_sources(spark, actions=(), calls_a=(), calls_b=(), roster=None):
    return make_sources(spark, roster=roster or [rep_row(1, "r")], actions=list(actions),
                        calls_a=list(calls_a), calls_b=list(calls_b))


def test_window_is_half_open_and_null_org_counts(spark):
    lo = A - dt.timedelta(days=30)
    src = _touch_sources(spark, actions=[
        (1, "r", 10, "REVIEW", "Closed", ts(lo)),               # first day of the window
        (2, "r", None, "REVIEW", "CLOSED", ts(A - dt.timedelta(days=1), 23)),  # null org still counts
        (3, "r", 10, "REVIEW", "Closed", ts(A)),                # anchor day: outside
        (4, "r", 10, "REVIEW", "Open", ts(A - dt.timedelta(days=2))),  # not closed
    ])
    job = MetricsJob(src, RULES, Anchors.of(A))
    rate = {r.rep: r for r in T.touch_rate_from_days(job.rep_days, job.anchors).collect()}
    # lo = 1998-05-17 (Sunday), A-1 = Monday: one active weekday, two touches
    assert rate["r"].total_ars_l30 == 2 and rate["r"].ars_per_day == 2.0
    assert T.touch_rate(job.base, job.anchors).collect()[0].total_ars_l30 == 2


def test_weekend_only_rep_has_no_rate(spark):
    sat = dt.date(1998, 6, 13)
    src = _touch_sources(spark, actions=[(1, "r", 10, "REVIEW", "closed", ts(sat, 9))])
    job = MetricsJob(src, RULES, Anchors.of(A))
    assert T.touch_rate_from_days(job.rep_days, job.anchors).count() == 0
    assert T.touch_rate(job.base, job.anchors).count() == 0


def test_call_thresholds_and_unlogged(spark):
    d = dt.date(1998, 6, 10)  # Wednesday
    src = _touch_sources(
        spark,
        actions=[(1, "r", 20, "REVIEW", "closed", ts(d, 8))],
        calls_a=[(11, "r", 10, "completed", 14.99, ts(d, 9)), (12, "r", 10, "Completed", 15.0, ts(d, 10)),
                 (13, "r", 20, "completed", 30.0, ts(d, 11))],          # logged: same rep, org, day as action 1
        calls_b=[(21, "r", 30, 899.0, ts(d, 9)), (22, "r", 31, 900.0, ts(d, 9))],
    )
    job = MetricsJob(src, RULES, Anchors.of(A))
    ids = sorted(r.source_id for r in T.qualified_touches(job.base).collect())
    assert ids == [1, 12, 22]
    assert T.touch_rate_from_days(job.rep_days, job.anchors).first().total_ars_l30 == 3


def test_task_on_anchor_day_is_unattempted(spark):
    src = make_sources(
        spark, roster=[rep_row(1, "r")],
        actions=[(1, "r", 7, "REVIEW", "closed", ts(A - dt.timedelta(days=3)))],
        tasks=[(100, 7, "r", "churn_risk", ts(A, 8), False),
               (101, 7, "r", "churn_risk", ts(A - dt.timedelta(days=5)), False)],
    )
    job = MetricsJob(src, RULES, Anchors.of(A))
    r = SL.churn_task_compliance(src.tasks, job.allow, job.outreach_keys, job.anchors, RULES).first()
    assert (r.total_churn_tasks, r.churn_tasks_reached, r.has_unattempted_churn) == (2, 1, 1)


def test_retention_sla_deadline(spark):
    thu = dt.date(1998, 6, 4)  # deadline Monday 06-08
    src = make_sources(
        spark, roster=[rep_row(1, "r"), rep_row(2, "s")],
        cases=[(1, 5, "r", 1, None, "Retention", ts(thu, 9), False),
               (2, 6, "r", 1, 1, "Retention", ts(thu, 9), False),       # self-created: excluded
               (3, 7, "r", 1, 2, "Retention", ts(thu, 9), False)],
        calls_b=[(1, "s", 5, 10.0, ts(dt.date(1998, 6, 8), 17)),        # other rep, same org, on deadline
                 (2, "s", 7, 10.0, ts(dt.date(1998, 6, 9), 9))],        # after the deadline
    )
    job = MetricsJob(src, RULES, Anchors.of(A))
    r = SL.retention_sla(src.cases, job.allow, job.outreach_keys, job.anchors).first()
    assert (r.total_ret_cases, r.sla_met_count, r.ret_sla_pct) == (2, 1, 0.5)
    o = SL.retention_sla(src.cases, job.allow, job.outreach_keys, job.anchors, rule="open").first()
    assert (o.total_ret_cases, o.sla_met_count) == (2, 2)


def test_book_null_contract_end_sorts_last(spark):
    m0 = dt.date(1998, 6, 1)
    src = make_sources(
        spark, roster=[rep_row(1, "r")], accounts=[(5, 1, "M")],
        book=[(5, m0, "r", 10.0, "V1", "Mid", "x", False, None, 1, None),
              (5, m0, "r", 20.0, "V2", "Mid", "x", False, dt.date(1998, 9, 15), 1, None)],
    )
    job = MetricsJob(src, RULES, Anchors.of(A))
    row = job.book_current.first()
    assert row.vertical == "V2" and row.contract_end == dt.date(1998, 9, 15)


def test_composite_null_segment_and_band(spark):
    df = spark.createDataFrame([(2.0, None, 0.8, None, 0.5, 3), (4.0, "Phones", None, 1.0, 1.0, 3)],
                               "rate double, seg string, call double, sla double, ren double, tot int")
    counted = S.renewal_pillar_allowed("seg") & (F.col("tot") > 0)
    c = S.composite_columns("rate", "seg", "call", "sla", "ren", counted)
    rows = df.select(c["composite_score"].alias("c"), S.score_band(c["composite_score"]).alias("b")).collect()
    # null segment: target 4.0 -> 0.5; renewal pillar not counted -> (0.5 + 0.8) / 2
    assert rows[0].c == 0.65 and rows[0].b == "yellow"
    # phone segment: target 2.5 -> capped at 1; renewal never counted -> (1 + 1) / 2
    assert rows[1].c == 1.0 and rows[1].b == "green"


def test_display_vertical_labels(spark):
    rows = [("MEDSPA", None), ("platform partnerships", None), ("home-decor", "Healthcare"),
            (None, "Healthcare"), (None, "Home Services"), (None, "Auto Services"), (None, "Retail"), (None, None)]
    df = spark.createDataFrame(rows, "hr string, pv string")
    got = [r.v for r in df.select(R.display_vertical("hr", "pv").alias("v")).collect()]
    assert got == ["MedSpa", "Platform Partnerships", "Home-Decor", "MedSpa", "HVAC", "Auto", "Retail", "Unknown"]


def test_touch_status_bands(spark):
    rows = [(2.0, "Phones"), (1.0, "Platform"), (2.4, "Mid Market"), (1.2, "Strategic"), (0.69, "strategic"),
            (3.3, "SMB"), (1.99, None)]
    df = spark.createDataFrame(rows, "r double, s string")
    got = [(x.st, x.t) for x in df.select(T.touch_status("r", "s").alias("st"), T.touch_target("s").alias("t")).collect()]
    assert got == [("green", 2.5), ("yellow", 2.5), ("yellow", 3.0), ("green", 1.5), ("red", 1.5),
                   ("green", 4.0), ("red", 4.0)]


def test_anchor_bound_and_rules_file(tmp_path):
    import json

    import pytest

    from pulseboard.__main__ import _rules
    a = Anchors.of("1998-06-16", dt.date(1998, 6, 1), "1998-06-16")
    assert a.dates == (dt.date(1998, 6, 1), dt.date(1998, 6, 16))
    assert len(Anchors.between(dt.date(1990, 1, 1), dt.date(2005, 1, 1)).dates) == 5480
    with pytest.raises(ValueError):
        Anchors.of()
    f = tmp_path / "rules.json"
    f.write_text(json.dumps({"exclude_names": ["x"], "director_by_manager": [["m", "d"]], "touch_window_days": 30}))
    r = _rules(str(f), fixtures=False)
    assert r.exclude_names == ("x",) and r.director_by_manager == (("m", "d"),) and r.touch_window_days == 30
