"""Registry: every operator as a query over the fixture tables, plus its oracle.

Each entry is ``name -> (spark_fn(spark, sf_dir) -> DataFrame, oracle_select,
anchor_set)``; the oracle select runs on top of the CTEs of
``pulseboard.oracle.sql`` built for the same anchor set.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .config import fixture_rules
from .functions.dates import Anchors, business_deadline
from .operators import calls as C
from .operators import daily as D
from .operators import renewal as RN
from .operators import roster as R
from .operators import score as S
from .operators import sla as SL
from .operators import touches as T
from .operators.common import per_anchor, ts_bounds
from .plans import history as HS
from .plans import hub as H
from .plans.job import MetricsJob
from .plans.touch_state import TouchState
from .session import ensure_checkpoint_dir
from .sources import Sources, load_table_sources
from .sources.materialize import fixture_sources as load_fixture_sources

ANCHOR = dt.date(1998, 6, 16)
HISTORY = tuple(dt.date(1998, 6, 3) + dt.timedelta(days=i) for i in range(14))

QUERIES: dict[str, tuple[Callable, str, tuple]] = {}


def query(name: str, oracle: str, dates: tuple = (ANCHOR,)):
    def deco(fn):
        QUERIES[name] = (fn, oracle, dates)
        return fn
    return deco


_LAST: list[tuple[tuple, MetricsJob]] = []


def job_for(spark: SparkSession, sf_dir: str, dates=(ANCHOR,), variant: str = "current", **options) -> MetricsJob:
    """The job of (tables, anchor set, allowlist form). Only the last one is kept:
    queries in a row that share it reuse its persisted relations, and another
    one releases them."""
    src = load_fixture_sources(spark, sf_dir)
    key = (id(src), tuple(dates), variant, tuple(sorted(options.items())))
    if not _LAST or _LAST[0][0] != key:
        release_jobs()
        _LAST.append((key, MetricsJob(src, fixture_rules(), Anchors.of(*dates), variant, **options)))
    return _LAST[0][1]


def release_jobs() -> None:
    """Unpersist what the last job keeps."""
    while _LAST:
        _LAST.pop()[1].release()


def _at_anchor(job: MetricsJob, df: DataFrame) -> DataFrame:
    return df.join(job.anchors.df(job.spark).select("anchor", "m0"), "m0").drop("m0")


def _book_parts(job: MetricsJob):
    cur = job.book_current
    pv, ps = R.primary_vertical(cur), R.primary_segment(cur, job.rules)
    return cur, pv, ps, R.rep_book_rollup(cur, pv, ps, job.rules)


# ---------------------------------------------------------------- 2.1 roster/book
@query("rep_allowlist", "select * from allow")
def q_rep_allowlist(spark, sf):
    return job_for(spark, sf).allow


@query("book_current", "select * from book_current")
def q_book_current(spark, sf):
    j = job_for(spark, sf)
    return _at_anchor(j, _book_parts(j)[0])


@query("primary_vertical", "select * from pv")
def q_primary_vertical(spark, sf):
    j = job_for(spark, sf)
    return _at_anchor(j, _book_parts(j)[1])


@query("primary_segment", "select * from ps")
def q_primary_segment(spark, sf):
    j = job_for(spark, sf)
    return _at_anchor(j, _book_parts(j)[2])


@query("owner_segment", "select * from owner_seg")
def q_owner_segment(spark, sf):
    j = job_for(spark, sf, variant="names")
    return _at_anchor(j, R.owner_segment(j.src.book, j.allow, j.anchors))


@query("rep_book_rollup", "select * from rollup")
def q_rollup(spark, sf):
    j = job_for(spark, sf)
    return _at_anchor(j, _book_parts(j)[3])


@query("org_hierarchy", "select * from hier")
def q_hier(spark, sf):
    j = job_for(spark, sf)
    return _at_anchor(j, R.org_hierarchy(_book_parts(j)[3], j.rules))


@query("display_vertical", "select * from disp_vert")
def q_display_vertical(spark, sf):
    j = job_for(spark, sf)
    ru = _at_anchor(j, _book_parts(j)[3]).select("anchor", "rep", "primary_vertical")
    rows = per_anchor(j.allow, j.anchors).join(ru, ["anchor", "rep"], "left")
    return rows.select("anchor", "rep", R.display_vertical("hr_vertical", "primary_vertical").alias("display_vertical"))


# ---------------------------------------------------------------- 2.2 touches
def _win(job, df):
    return T.windowed(df, job.anchors, job.rules.touch_window_days)


@query("action_touches", "select anchor, day, rep, org, source_id from acts_l30")
def q_action_touches(spark, sf):
    j = job_for(spark, sf)
    return _win(j, j.base.where(F.col("channel") == "action")).select("anchor", "day", "rep", "org", "source_id")


@query("call_a_touches", """select an.anchor, c.day, c.rep, c.org, c.source_id, c.minutes
from ca_al c join anchors an on c.day >= an.anchor - 30 and c.day < an.anchor""")
def q_call_a(spark, sf):
    j = job_for(spark, sf)
    return _win(j, T.call_touches(j.src, j.allow, "a")).select("anchor", "day", "rep", "org", "source_id", "minutes")


@query("call_b_touches", """select an.anchor, c.day, c.rep, c.org, c.source_id, c.seconds
from cb_al c join anchors an on c.day >= an.anchor - 30 and c.day < an.anchor""")
def q_call_b(spark, sf):
    j = job_for(spark, sf)
    return _win(j, T.call_touches(j.src, j.allow, "b")).select("anchor", "day", "rep", "org", "source_id", "seconds")


@query("unlogged_calls", "select * from unlogged_a union all select * from unlogged_b")
def q_unlogged(spark, sf):
    j = job_for(spark, sf)
    return _win(j, T.unlogged_calls(j.base)).select("anchor", "day", "rep", "org", "source_id", "channel")


@query("qualified_touches", "select * from ar_events")
def q_qualified(spark, sf):
    j = job_for(spark, sf)
    return _win(j, T.qualified_touches(j.base)).select("anchor", "day", "rep", "org", "source_id", "channel")


@query("all_outreach", "select * from outreach")
def q_outreach(spark, sf):
    j = job_for(spark, sf)
    return _win(j, j.base).select("anchor", "day", "rep", "org", "channel")


@query("distinct_touches", "select distinct anchor, day, rep, org from ar_events")
def q_distinct_touches(spark, sf):
    j = job_for(spark, sf)
    return _win(j, T.qualified_touches(j.base)).select("anchor", "day", "rep", "org").distinct()


@query("active_days", "select * from active_days_cur")
def q_active_days(spark, sf):
    j = job_for(spark, sf)
    return T.active_days(j.base, j.anchors)


@query("touch_rate", "select * from touch_rate_cur")
def q_touch_rate(spark, sf):
    j = job_for(spark, sf)
    return T.touch_rate_from_days(j.rep_days, j.anchors)


@query("touch_rate_history", "select * from touch_rate_cur", HISTORY)
def q_touch_rate_history(spark, sf):
    j = job_for(spark, sf, HISTORY)
    return T.touch_rate_from_days(j.rep_days, j.anchors)


@query("touch_rate_rows", "select * from touch_rate_cur")
def q_touch_rate_rows(spark, sf):
    """Same metric from the row-level plan (anti-join + distinct days)."""
    j = job_for(spark, sf)
    return T.touch_rate(j.base, j.anchors)


@query("touch_target_status", "select * from touch_status")
def q_touch_status(spark, sf):
    j = job_for(spark, sf)
    ru = _at_anchor(j, _book_parts(j)[3]).select("anchor", "rep", "primary_segment")
    rows = (per_anchor(j.allow.select("rep"), j.anchors)
            .join(T.touch_rate(j.base, j.anchors), ["anchor", "rep"], "left").join(ru, ["anchor", "rep"], "left"))
    return rows.select(
        "anchor", "rep", "primary_segment", F.coalesce("ars_per_day", F.lit(0.0)).alias("ars_per_day"),
        T.touch_target("primary_segment").alias("touch_target"),
        T.touch_norm("ars_per_day", "primary_segment").alias("ar_score_norm"),
        T.touch_status("ars_per_day", "primary_segment").alias("ar_status"))


# ---------------------------------------------------------------- 2.3 calls
@query("scored_calls", "select * from scored_calls")
def q_scored_calls(spark, sf):
    j = job_for(spark, sf)
    return C.scored_calls(j.src, j.allow, j.anchors)


@query("call_metrics", "select * from call_metrics")
def q_call_metrics(spark, sf):
    j = job_for(spark, sf)
    return C.call_metrics(j.src, j.allow, j.anchors)


@query("call_metrics_prev", "select * from call_prev")
def q_call_prev(spark, sf):
    j = job_for(spark, sf)
    return C.call_metrics_prev(j.src, j.allow, j.anchors)


@query("call_delta", f"""select c.anchor, c.rep, c.avg_call_score, p.prev_avg_call_score,
  case when c.avg_call_score is not null and p.prev_avg_call_score is not null
       then cast(round(cast(c.avg_call_score - p.prev_avg_call_score as decimal(38,12)), 1) as double) end as call_score_delta
from call_metrics c left join call_prev p on c.anchor = p.anchor and c.rep = p.rep""")
def q_call_delta(spark, sf):
    j = job_for(spark, sf)
    c = C.call_metrics(j.src, j.allow, j.anchors).select("anchor", "rep", "avg_call_score")
    p = C.call_metrics_prev(j.src, j.allow, j.anchors)
    return c.join(p, ["anchor", "rep"], "left").withColumn(
        "call_score_delta", C.call_delta("avg_call_score", "prev_avg_call_score"))


# ---------------------------------------------------------------- 2.4 SLA
@query("business_deadline", """select case_id, cast(created_at as date) as day,
  cast(cast(created_at as date) + (case dayofweek(cast(created_at as date)) when 0 then 2 when 4 then 4
       when 5 then 4 when 6 then 3 else 2 end) as date) as deadline from cases""")
def q_business_deadline(spark, sf):
    c = load_fixture_sources(spark, sf).cases
    day = F.to_date("created_at")
    return c.select("case_id", day.alias("day"), business_deadline(day).alias("deadline"))


@query("retention_cases", "select * from retention_cases")
def q_retention_cases(spark, sf):
    j = job_for(spark, sf)
    return SL.retention_cases(j.src.cases, j.allow, j.anchors)


@query("retention_sla", "select * from ret_sla_cur")
def q_retention_sla(spark, sf):
    j = job_for(spark, sf)
    return SL.retention_sla(j.src.cases, j.allow, j.outreach_keys, j.anchors)


@query("retention_sla_open", "select * from ret_sla_open_lg")
def q_retention_sla_open(spark, sf):
    j = job_for(spark, sf, variant="legacy")
    return SL.retention_sla(j.src.cases, j.allow, j.outreach_keys, j.anchors, rule="open")


@query("churn_task_compliance", "select * from churn_cur")
def q_churn(spark, sf):
    j = job_for(spark, sf)
    return SL.churn_task_compliance(j.src.tasks, j.allow, j.outreach_keys, j.anchors, j.rules)


@query("open_case_counts", "select * from open_cases")
def q_open_cases(spark, sf):
    return SL.open_case_counts(load_fixture_sources(spark, sf).cases, fixture_rules())


# ---------------------------------------------------------------- 2.5 renewal
@query("renewal_cohort", "select * from cohort_cur")
def q_cohort(spark, sf):
    j = job_for(spark, sf)
    return RN.at_anchors(j.cohort("current"), j.anchors).select(*RN.COHORT_COLS)


@query("renewal_cohort_nocheck", "select * from cohort_nocheck")
def q_cohort_nc(spark, sf):
    j = job_for(spark, sf)
    return RN.at_anchors(j.cohort("nocheck"), j.anchors).select(*RN.COHORT_COLS)


@query("renewal_cohort_legacy", "select * from cohort_legacy")
def q_cohort_legacy(spark, sf):
    j = job_for(spark, sf, variant="names")
    return RN.at_anchors(j.cohort("legacy"), j.anchors).select(*RN.COHORT_COLS)


@query("renewal_touches", "select * from renewal_touches")
def q_renewal_touches(spark, sf):
    j = job_for(spark, sf)
    return RN.renewal_touches(j.base, RN.at_anchors(j.cohort(), j.anchors), j.anchors)


@query("renewal_contacted_legacy", "select * from contacted_legacy")
def q_contacted_legacy(spark, sf):
    j = job_for(spark, sf, variant="names")
    return RN.renewal_contacted(j.cohort("legacy"), j.renewal_keys_by_rep, j.anchors)


@query("renewal_coverage", "select * from coverage_cur")
def q_coverage(spark, sf):
    j = job_for(spark, sf)
    return j.coverage()


@query("renewal_coverage_nocheck", "select * from coverage_nocheck")
def q_coverage_nc(spark, sf):
    j = job_for(spark, sf)
    return j.coverage("nocheck")


@query("renewal_coverage_legacy", "select * from coverage_legacy")
def q_coverage_legacy(spark, sf):
    j = job_for(spark, sf, variant="names")
    return j.coverage("legacy")


@query("renewal_pivot", "select * from pivot_cur")
def q_pivot(spark, sf):
    j = job_for(spark, sf)
    return RN.renewal_pivot(j.coverage(), j.anchors)


# ---------------------------------------------------------------- 2.6 score / hub / daily
@query("interaction_signals", "select * from signals_latest")
def q_signals(spark, sf):
    return S.interaction_signals(load_fixture_sources(spark, sf).signals)


@query("interaction_signals_asof", "select * from signals_asof", HISTORY)
def q_signals_asof(spark, sf):
    j = job_for(spark, sf, HISTORY)
    return S.interaction_signals_asof(j.src.signals, j.anchors)


@query("composite_score", "select * from composite")
def q_composite(spark, sf):
    return H.composite_frame(job_for(spark, sf))


@query("score_band", """select anchor, rep, composite_score,
  case when composite_score >= 0.80 then 'green' when composite_score >= 0.50 then 'yellow' else 'red' end as overall_status
from composite""")
def q_band(spark, sf):
    c = H.composite_frame(job_for(spark, sf))
    return c.select("anchor", "rep", "composite_score", S.score_band("composite_score").alias("overall_status"))


@query("churn_gate", """select c.anchor, c.rep, c.composite_score, coalesce(ch.has_unattempted_churn, 0) as has_unattempted_churn,
  case when coalesce(ch.has_unattempted_churn, 0) = 1 and c.composite_score >= 0.80 then true else false end as gated_by_churn
from composite c left join churn_cur ch on ch.anchor = c.anchor and ch.rep = c.rep""")
def q_gate(spark, sf):
    j = job_for(spark, sf)
    ch = SL.churn_task_compliance(j.src.tasks, j.allow, j.outreach_keys, j.anchors, j.rules, rows=j.churn_rows)
    c = H.composite_frame(j).join(ch, ["anchor", "rep"], "left")
    return c.select("anchor", "rep", "composite_score",
                    F.coalesce("has_unattempted_churn", F.lit(0)).alias("has_unattempted_churn"),
                    S.churn_gate("has_unattempted_churn", "composite_score").alias("gated_by_churn"))


@query("score_delta_7d", """select c.anchor, c.rep, c.composite_score, s.composite_score_7d_ago,
  cast(round(cast((c.composite_score - s.composite_score_7d_ago) * 100 as decimal(38,12)), 1) as double) as composite_delta_7d
from composite c left join snap7 s on s.anchor = c.anchor and s.rep = c.rep""")
def q_delta(spark, sf):
    j = job_for(spark, sf)
    c = H.composite_frame(j).join(S.score_7d_ago(j.src.snapshots, j.anchors), ["anchor", "rep"], "left")
    return c.select("anchor", "rep", "composite_score", "composite_score_7d_ago",
                    S.score_delta("composite_score", "composite_score_7d_ago").alias("composite_delta_7d"))


@query("hub", "select * from hub")
def q_hub(spark, sf):
    return H.hub(job_for(spark, sf))


@query("hub_history", "select * from hub", HISTORY)
def q_hub_history(spark, sf):
    return H.hub(job_for(spark, sf, HISTORY))


@query("hub_top", """select anchor, rep, director_name, location_count, open_onboarding_cases, open_retention_cases,
  avg_risk_score, high_risk_org_count, cancellation_intent_count, avg_sentiment_score, composite_score, overall_status
from hub order by composite_score desc nulls last, rep limit 10""")
def q_hub_top(spark, sf):
    return H.hub_top(H.hub(job_for(spark, sf)), 10)


@query("daily_touch_count", "select * from daily_ar_cur")
def q_daily_ar(spark, sf):
    j = job_for(spark, sf)
    return D.daily_touch_count(D.touch_day_counts(j.src, j.rules), j.allow)


@query("daily_active_flag", "select * from daily_active_cur")
def q_daily_active(spark, sf):
    j = job_for(spark, sf)
    return D.daily_active_flag(D.touch_day_counts(j.src, j.rules), j.allow)


@query("daily_call_score", "select * from daily_calls_cur")
def q_daily_calls(spark, sf):
    j = job_for(spark, sf)
    return D.daily_call_score(j.src, j.allow)


@query("daily_sla_closed", "select * from daily_ret_cur")
def q_daily_ret(spark, sf):
    j = job_for(spark, sf)
    return D.daily_sla_closed(j.src, D.touch_day_counts(j.src, j.rules), j.allow)


@query("daily_columns", "select * from daily_cols")
def q_daily_columns(spark, sf):
    j = job_for(spark, sf)
    return D.daily_columns(j.src.snapshots.select("snapshot_date", "rep"), j.src, j.allow, j.rules,
                           days=list(HISTORY))


# ---------------------------------------------------------------- 2.7 history jobs
@query("ensure_columns", "select * from snap_c")
def q_ensure_columns(spark, sf):
    return HS.conform(load_fixture_sources(spark, sf).snapshots)


@query("backfill_snapshots", "select * from backfill_rows", HISTORY)
def q_backfill(spark, sf):
    j = job_for(spark, sf, HISTORY, "legacy")
    return HS.backfill_rows(j.src, j.rules, j.anchors, j)


def _merged(spark, sf, updates_fn, cols, variant, dates=HISTORY):
    j = job_for(spark, sf, dates, variant)
    current = HS.conform(j.src.snapshots.where(F.col("snapshot_date").isin(*j.anchors.dates)))
    upd = updates_fn(j.src, j.rules, j.anchors, j.src.snapshots, j)
    return HS.merge_updates(current, upd, cols).drop("_matched")


# ---------------------------------------------------------------- storage: write to the shared folder, read back
def _store(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/query-{name}-{uuid.uuid4().hex}"


def _stored_snapshots(spark, sf, name) -> tuple[DataFrame, str]:
    snaps, path = HS.conform(load_fixture_sources(spark, sf).snapshots), _store(spark, name)
    HS.write_partitions(snaps, path)
    return snaps, path


D0, D1, D2 = (d.isoformat() for d in HISTORY[:3])


@query("snapshot_replace", f"""select * replace (case when snapshot_date = date '{D0}' then composite_score + 1
  else composite_score end as composite_score) from snap_c where snapshot_date <> date '{D1}'""")
def q_snapshot_replace(spark, sf):
    """One date replaced by changed rows, one emptied."""
    snaps, path = _stored_snapshots(spark, sf, "replace")
    rows = snaps.where(F.col("snapshot_date") == HISTORY[0]).withColumn("composite_score", F.col("composite_score") + 1)
    HS.snapshot_replace(rows, path, HISTORY[:2])
    return HS.read_snapshots(spark, path)


@query("snapshot_upsert", f"""select * replace (
  case when snapshot_date = date '{D2}' and composite_score > 0.5 then null else ars_per_day end as ars_per_day,
  case when snapshot_date = date '{D2}' and composite_score > 0.5 then 7 else ret_sla_done end as ret_sla_done) from snap_c""")
def q_snapshot_upsert(spark, sf):
    """Two columns of one date's matched rows (a null overwrites); an unknown rep is not inserted."""
    snaps, path = _stored_snapshots(spark, sf, "upsert")
    upd = snaps.where((F.col("snapshot_date") == HISTORY[2]) & (F.col("composite_score") > 0.5)).select("snapshot_date", "rep")
    upd = upd.unionByName(upd.withColumn("rep", F.concat(F.lit("nobody "), "rep")))
    upd = upd.withColumn("ars_per_day", F.lit(None).cast("double")).withColumn("ret_sla_done", F.lit(7))
    HS.snapshot_upsert(spark, path, upd, ["ars_per_day", "ret_sla_done"], [HISTORY[2]])
    return HS.read_snapshots(spark, path)


@query("hub_overwrite", f"select * from hub where anchor = date '{D0}' or overall_status = 'green'", HISTORY[:2])
def q_hub_overwrite(spark, sf):
    """Two builds; the second is built again, without its red and yellow rows."""
    path, h = _store(spark, "hub"), H.hub(job_for(spark, sf, HISTORY[:2]))
    HS.write_partitions(h, path, "anchor")
    hubs = HS.hub_table(spark, path)
    hubs.replace(hubs.read(h.schema, HISTORY[1:2]).where(F.col("overall_status") == "green"))
    return hubs.read(h.schema)


@query("export_hub_json", "select * from hub")
def q_export_hub_json(spark, sf):
    path, h = _store(spark, "json"), H.hub(job_for(spark, sf))
    HS.export_hub_json(h, path)
    return spark.read.schema(h.schema).json(path)


_GIVEN = ("snapshot_date", "rep", "composite_score", "ars_per_day", "avg_call_score", "ret_sla_pct", "renewal_m2_pct", "daily_ar_count")
_LACKING = [c for c in HS.SNAPSHOT_COLUMNS if c not in _GIVEN]


@query("check_columns", "select column_name, n as rows_to_fill from (select count(*) as n from snapshots), "
       f"(select unnest({_LACKING}) as column_name)")
def q_check_columns(spark, sf):
    """Columns that the stored snapshots lack, and the rows that get a typed null in each."""
    snaps = load_fixture_sources(spark, sf).snapshots
    missing = HS.check_columns(snaps, HS.SNAPSHOT_COLUMNS)
    n = snaps.agg(F.count(F.lit(1)).alias("rows_to_fill"))
    return n.select(F.explode(F.array(*map(F.lit, missing))).alias("column_name"), "rows_to_fill")


@query("ensure_columns_table", "select * from snap_c")
def q_ensure_columns_table(spark, sf):
    """The given snapshots as a catalog table: its missing columns are added there, and it is read back by name."""
    snaps, name = load_fixture_sources(spark, sf).snapshots, f"pb_snapshots_{uuid.uuid4().hex}"
    # outside the warehouse, so that dropping the name leaves the files to the returned rows
    snaps.write.option("path", _store(spark, "table")).saveAsTable(name)
    try:
        HS.ensure_table_columns(spark, name)
        return spark.table(name).select(*[F.col(n).cast(t).alias(n) for n, t in HS.SNAPSHOT_SPEC])
    finally:
        spark.sql(f"DROP TABLE {name}")


_TABLES = ("roster", "actions", "calls_a", "calls_b", "book", "accounts", "contracts", "cases", "scores_1", "scores_2",
           "scores_3", "scores_4", "tasks", "signals")


@query("load_sources", " union all ".join(f"select '{t}' as source, count(*) as n from {t}" for t in _TABLES))
def q_load_sources(spark, sf):
    """Rows of every source, loaded by catalog name."""
    given = load_fixture_sources(spark, sf)
    frames = {t: getattr(given, t) for t in _TABLES if not t.startswith("scores_")}
    frames |= {f"scores_{k}": df for k, df in enumerate(given.scores, 1)}
    names = {t: f"pb_load_{t}" for t in _TABLES}
    for t, df in frames.items():
        df.createOrReplaceTempView(names[t])
    src = load_table_sources(spark, names)
    loaded = {t: getattr(src, t) for t in _TABLES if not t.startswith("scores_")}
    loaded |= {f"scores_{k}": df for k, df in enumerate(src.scores, 1)}
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("source"), "n") for t, df in loaded.items()]
    return reduce(DataFrame.unionByName, counts)


@query("refresh", "select * from snapshot_from_prev_hub", (ANCHOR - dt.timedelta(days=1),))
def q_refresh(spark, sf):
    """Two daily refreshes: the second stores the first one's build as its snapshot."""
    src, hub_path, snap_path = load_fixture_sources(spark, sf), _store(spark, "hub"), _store(spark, "snaps")
    HS.refresh(spark, src, fixture_rules(), ANCHOR - dt.timedelta(days=1), hub_path, snap_path)
    HS.refresh(spark, src, fixture_rules(), ANCHOR, hub_path, snap_path)
    return HS.read_snapshots(spark, snap_path)


def _behind(src: Sources, day: dt.date) -> Sources:
    """The sources as a run of ``day`` finds them if the second call system lags ten days."""
    cut = lambda df, ts, before: df.where(ts_bounds(ts, dt.date(1, 1, 1), before))
    return replace(src, actions=cut(src.actions, "closed_at", day), calls_a=cut(src.calls_a, "start_at", day),
                   calls_b=cut(src.calls_b, "inserted_at", day - dt.timedelta(days=10)))


STATE_LO = ANCHOR - dt.timedelta(days=120)


@query("touch_state", f"""select rep, org, day, count(*) filter (where channel = 'action') as n_act,
  count(*) filter (where channel <> 'action' and long) as n_long, count(*) as n_any
from touches where day >= date '{STATE_LO}' and day < date '{ANCHOR}' group by all""")
def q_touch_state(spark, sf):
    """Touch counts kept between runs: one run without late calls, then one that finds them."""
    src, rules = load_fixture_sources(spark, sf), fixture_rules()
    state = TouchState(spark, _store(spark, "touches"))
    state.update(_behind(src, HISTORY[0]), rules, STATE_LO, HISTORY[0])
    state.update(src, rules, STATE_LO, ANCHOR)
    return state.read(src, rules, STATE_LO, ANCHOR)


@query("refresh_touch_state", "select * from hub")
def q_refresh_touch_state(spark, sf):
    """A daily refresh over touch counts that an earlier run left behind, late calls included."""
    src, rules = load_fixture_sources(spark, sf), fixture_rules()
    _, snap_path = _stored_snapshots(spark, sf, "state-snaps")
    state, before = TouchState(spark, _store(spark, "touches")), ANCHOR - dt.timedelta(days=1)
    job = MetricsJob(src, rules, Anchors.of(before))
    state.update(_behind(src, before), rules, job.touch_lo, job.touch_hi)
    return HS.refresh(spark, src, rules, ANCHOR, _store(spark, "hub"), snap_path, state).drop("last_refreshed_at")


@query("rep_allowlist_names", "select * from allow_names")
def q_allow_names(spark, sf):
    return job_for(spark, sf, variant="names").allow


@query("rep_allowlist_legacy", "select * from allow_legacy")
def q_allow_legacy(spark, sf):
    return job_for(spark, sf, variant="legacy").allow


@query("outreach_org_days", "select distinct anchor, day, org from touch_lg, anchors "
       "where org is not null and day between anchor - 30 and anchor - 1", HISTORY)
def q_outreach_org_days(spark, sf):
    """Set form of the outreach: which orgs were reached on which days (older allowlist)."""
    j = job_for(spark, sf, HISTORY, "legacy")
    return T.windowed(j.outreach_keys, j.anchors, j.rules.touch_window_days).select("anchor", "day", "org")


@query("hub_deduped", "select distinct * from hub")
def q_hub_deduped(spark, sf):
    """The hub with every name listed once."""
    return H.hub(job_for(spark, sf, dedupe=True))


@query("enrich_counts", "select * from enrich_merged", HISTORY)
def q_enrich(spark, sf):
    return _merged(spark, sf, HS.enrich_updates, HS.ENRICH_COLS, "legacy")


@query("recompute_scores", "select * from recompute_scores_merged", HISTORY)
def q_recompute_scores(spark, sf):
    return _merged(spark, sf, HS.recompute_score_updates, HS.SCORE_COLS, "names")


@query("recompute_renewals", "select * from recompute_renewals_merged", HISTORY)
def q_recompute_renewals(spark, sf):
    return _merged(spark, sf, HS.recompute_renewal_updates, HS.RENEWAL_COLS, "names")


@query("missing_dates", "select * from missing_dates")
def q_missing_dates(spark, sf):
    return HS.missing_dates(load_fixture_sources(spark, sf).snapshots)


# snapshot dates whose daily count is null in the fixture (i % 3 == 0)
MISSING = tuple(d for i, d in enumerate(HISTORY) if i % 3 == 0)


@query("backfill_daily", "select * from backfill_daily_merged", MISSING)
def q_backfill_daily(spark, sf):
    def upd(src, rules, a, snaps, job):
        return HS.backfill_daily_updates(src, rules, list(a.dates), HS.conform(snaps), job)

    return _merged(spark, sf, upd, HS.DAILY_COLS, "names", MISSING)


@query("coverage_report", "select * from coverage_report")
def q_coverage_report(spark, sf):
    return HS.coverage_report(load_fixture_sources(spark, sf).snapshots)


def _stored_in_steps(spark: SparkSession, sf: str, name: str) -> str:
    """The given snapshots, stored by a replace without one date, an upsert that clears its counts, and a second replace."""
    snaps, path = HS.conform(load_fixture_sources(spark, sf).snapshots), _store(spark, name)
    HS.snapshot_replace(snaps.where(F.col("snapshot_date") != HISTORY[0]), path)
    cleared = snaps.where(F.col("snapshot_date") == HISTORY[1]).select("snapshot_date", "rep", F.lit(None).cast("long").alias("daily_ar_count"))
    HS.snapshot_upsert(spark, path, cleared, ["daily_ar_count"], [HISTORY[1]])
    HS.snapshot_replace(snaps.where(F.col("snapshot_date") == HISTORY[0]), path)
    return path


@query("stored_missing_dates", f"""select distinct snapshot_date from snap_c
where daily_ar_count is null or snapshot_date = date '{D1}'""")
def q_stored_missing_dates(spark, sf):
    """From the stored table's log, after three writers."""
    return HS.stored_missing_dates(spark, _stored_in_steps(spark, sf, "missing"))


@query("stored_coverage_report", "select * from coverage_report")
def q_stored_coverage_report(spark, sf):
    """From the stored table's log, after three writers."""
    return HS.stored_coverage_report(spark, _stored_in_steps(spark, sf, "coverage"))


@query("refresh_snapshot", "select * from snapshot_from_hub")
def q_refresh_snapshot(spark, sf):
    j = job_for(spark, sf)
    return HS.refresh_rows(j.src, j.rules, ANCHOR, H.hub(j).drop("anchor"), j)
