"""The hub: one row per allowlisted rep with a book, per anchor (83 columns).

All windowed metrics are mergeable partials per (anchor, rep). Their rows are
put under each other and reduced together (``partials.together``): one shuffle
brings all metrics of a key to one place, whatever their number, and one join
adds them to the reps that have a book.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import month_after, month_label
from ..operators import calls as C
from ..operators import roster as R
from ..operators import score as S
from ..operators import sla as SL
from ..operators import touches as T
from ..operators.common import per_anchor
from ..operators.partials import together
from .job import MetricsJob

SUB_COLS = [f"{k}_sub_{i}" for i in range(1, 5) for k in ("avg", "min", "max")]
RENEWAL_FIELDS = ("total", "called", "pct", "m2m", "m2m_called", "annual")

HUB_COLUMNS = (
    ["anchor", "rep", "manager_name", "director_name", "primary_vertical", "display_vertical", "is_offshore",
     "primary_segment", "org_count", "book_mrr", "book_arr", "is_partner_rep", "partner_org_count",
     "has_ai_accounts", "location_count",
     "total_ars_l30", "ars_per_day", "ar_status",
     "total_calls_l30", "avg_call_score", "prev_avg_call_score", "call_score_delta"]
    + SUB_COLS
    + ["min_call_score", "max_call_score",
       "total_ret_cases", "sla_met_count", "ret_sla_pct",
       "total_churn_tasks", "churn_tasks_reached", "churn_reach_pct", "has_unattempted_churn",
       "renewal_cohort_total", "renewal_cohort_called", "renewal_coverage_pct", "renewal_cohort_month"]
    + [f"renewal_m{k}_{f}" for k in (1, 2, 3) for f in RENEWAL_FIELDS]
    + [f"renewal_m{k}_label" for k in (1, 2, 3)]
    + ["ar_score_norm", "call_score_norm", "sla_score_norm", "renewal_score_norm", "composite_score",
       "composite_score_7d_ago", "composite_delta_7d", "overall_status", "gated_by_churn",
       "open_onboarding_cases", "open_retention_cases", "avg_risk_score", "high_risk_org_count",
       "cancellation_intent_count", "avg_sentiment_score"]
)

TOP_COLUMNS = ("anchor", "rep", "director_name", "location_count", "open_onboarding_cases", "open_retention_cases",
               "avg_risk_score", "high_risk_org_count", "cancellation_intent_count", "avg_sentiment_score",
               "composite_score", "overall_status")


def rollup(job: MetricsJob) -> DataFrame:
    """Book rollup keyed (anchor, rep), from the job's persisted month book."""
    cur, rules = job.book_current, job.rules
    ru = R.rep_book_rollup(cur, R.primary_vertical(cur), R.primary_segment(cur, rules), rules)
    return ru.join(job.anchors.df(job.spark).select("anchor", "m0"), "m0").drop("m0")


def composite_frame(job: MetricsJob) -> DataFrame:
    """Composite over allowlist rows x anchors (bag), current definitions."""
    k = ["anchor", "rep"]
    parts = together(job.touch_partials(), job.call_partials(), job.retention_partials(), job.renewal_partials()).select(
        *k, "ars_per_day", "call_score_norm", "ret_sla_pct", "renewal_m2_total", "renewal_m2_pct")
    j = per_anchor(job.allow.select("rep"), job.anchors).join(parts, k, "left").join(
        rollup(job).select(*k, "primary_segment"), k, "left")
    counted = S.renewal_pillar_allowed("primary_segment") & (F.coalesce(F.col("renewal_m2_total"), F.lit(0)) > 0)
    cols = S.composite_columns("ars_per_day", "primary_segment", "call_score_norm", "ret_sla_pct",
                               "renewal_m2_pct", counted)
    return j.select("anchor", "rep", *[c.alias(n) for n, c in cols.items()])


def hub(job: MetricsJob, include_refresh_time: bool = False) -> DataFrame:
    src, rules, anchors = job.src, job.rules, job.anchors
    ru = rollup(job)
    metrics = together(job.touch_partials(), job.call_partials(), job.call_prev_partials(), job.retention_partials(),
                       job.churn_partials(), job.renewal_partials())
    oc = SL.open_case_counts(src.cases, rules)
    ii = S.interaction_signals(src.signals)

    # rows: allowlist rows (bag) of reps with a book at the anchor; the rollup
    # has one row per (anchor, rep), so the inner join keeps the bag as is.
    # What is known per rep only joins on the same key before the anchors do.
    rows = job.allow.join(ru, "rep").join(oc, "rep", "left").join(ii, "rep", "left")
    k = ["anchor", "rep"]
    j = rows.join(metrics, k, "left").withColumns({f"m{n}": month_after("anchor", n) for n in (1, 2, 3)})
    if src.snapshots is not None:  # not reduced: a name stored twice that day stays two rows
        j = j.join(S.score_7d_ago(src.snapshots, anchors), k, "left")
    else:
        j = j.withColumn("composite_score_7d_ago", F.lit(None).cast("double"))
    j = j.withColumn("director_name", R.hierarchy_columns(rules)[1])
    over = F.col("rep").isin(list(rules.manager_override_reps)) if rules.manager_override_reps else F.lit(False)
    counted = S.renewal_pillar_allowed("primary_segment") & (F.coalesce(F.col("renewal_m2_total"), F.lit(0)) > 0)
    comp = S.composite_columns("ars_per_day", "primary_segment", "call_score_norm", "ret_sla_pct",
                               "renewal_m2_pct", counted)
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    out = {
        "anchor": F.col("anchor"), "rep": F.col("rep"),
        "manager_name": F.when(over, F.lit(rules.manager_override_label)).otherwise(F.col("manager_name")),
        "director_name": F.col("director_name"),
        "primary_vertical": F.col("primary_vertical"),
        "display_vertical": R.display_vertical("hr_vertical", "primary_vertical"),
        "is_offshore": F.col("is_offshore"), "primary_segment": F.col("primary_segment"),
        "org_count": z("org_count"), "book_mrr": F.coalesce(F.col("book_mrr"), F.lit(0.0)),
        "book_arr": F.coalesce(F.col("book_arr"), F.lit(0.0)), "is_partner_rep": z("is_partner_rep"),
        "partner_org_count": z("partner_org_count"), "has_ai_accounts": z("has_ai_accounts"),
        "location_count": z("location_count"),
        "total_ars_l30": z("total_ars_l30"), "ars_per_day": F.coalesce(F.col("ars_per_day"), F.lit(0.0)),
        "ar_status": T.touch_status("ars_per_day", "primary_segment"),
        "total_calls_l30": z("total_calls_l30"), "avg_call_score": F.col("avg_call_score"),
        "prev_avg_call_score": F.col("prev_avg_call_score"),
        "call_score_delta": C.call_delta("avg_call_score", "prev_avg_call_score"),
    }
    out.update({c: F.col(c) for c in SUB_COLS})
    out.update({
        "min_call_score": F.col("min_call_score"), "max_call_score": F.col("max_call_score"),
        "total_ret_cases": z("total_ret_cases"), "sla_met_count": z("sla_met_count"), "ret_sla_pct": F.col("ret_sla_pct"),
        "total_churn_tasks": z("total_churn_tasks"), "churn_tasks_reached": z("churn_tasks_reached"),
        "churn_reach_pct": F.col("churn_reach_pct"), "has_unattempted_churn": z("has_unattempted_churn"),
        "renewal_cohort_total": z("renewal_m2_total"), "renewal_cohort_called": z("renewal_m2_called"),
        "renewal_coverage_pct": F.col("renewal_m2_pct"), "renewal_cohort_month": F.col("m2"),
    })
    for kk in (1, 2, 3):
        for f in RENEWAL_FIELDS:
            c = f"renewal_m{kk}_{f}"
            out[c] = F.col(c) if f == "pct" else z(c)
    for kk in (1, 2, 3):
        out[f"renewal_m{kk}_label"] = month_label(F.col(f"m{kk}"))
    out.update({
        "ar_score_norm": comp["ar_score_norm"], "call_score_norm": comp["call_score_norm"],
        "sla_score_norm": comp["sla_score_norm"], "renewal_score_norm": comp["renewal_score_norm"],
        "composite_score": comp["composite_score"],
        "composite_score_7d_ago": F.col("composite_score_7d_ago"),
        "composite_delta_7d": S.score_delta(comp["composite_score"], F.col("composite_score_7d_ago")),
        "overall_status": S.score_band(comp["composite_score"]),
        "gated_by_churn": S.churn_gate("has_unattempted_churn", comp["composite_score"]),
        "open_onboarding_cases": z("open_onboarding_cases"), "open_retention_cases": z("open_retention_cases"),
        "avg_risk_score": F.col("avg_risk_score"), "high_risk_org_count": z("high_risk_org_count"),
        "cancellation_intent_count": z("cancellation_intent_count"),
        "avg_sentiment_score": F.col("avg_sentiment_score"),
    })
    cols = [out[c].alias(c) for c in HUB_COLUMNS]
    if include_refresh_time:
        cols.append(F.current_timestamp().alias("last_refreshed_at"))
    return j.select(*cols)


def hub_top(hub_df: DataFrame, n: int = 10) -> DataFrame:
    """Top ``n`` of each anchor by composite (nulls last), 12 columns: a row_number
    filter, which Spark evaluates as a partial group limit before the shuffle."""
    w = Window.partitionBy("anchor").orderBy(F.col("composite_score").desc_nulls_last(), F.col("rep").asc())
    top = hub_df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n)
    return top.select(*[c for c in TOP_COLUMNS if c in hub_df.columns])
