"""SLA and compliance operators.

"Was the org contacted between day d and a later day?" is answered with an
as-of lookup (``first_on_or_after``) over distinct (org, day) outreach keys,
never by joining every case with every touch of its org.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import RETENTION_CASE_TYPE, Rules
from ..functions.dates import Anchors, business_deadline
from ..functions.numeric import flag, safe_ratio
from .common import first_on_or_after, in_window
from .partials import Partials


def outreach_keys(base: DataFrame) -> DataFrame:
    """Distinct (org, day) with any allowlisted outreach (any rep, any length)."""
    return base.where(F.col("org").isNotNull()).select("org", "day").distinct()


def retention_case_rows(cases: DataFrame, allow: DataFrame) -> DataFrame:
    """All retention cases with an org, not self-created, owner allowlisted (bag)."""
    c = cases.where(
        (F.col("record_type") == F.lit(RETENTION_CASE_TYPE))
        & F.col("org").isNotNull()
        & (F.col("created_by_id").isNull() | (F.col("created_by_id") != F.col("owner_id")))
    )
    c = c.join(allow.select(F.col("rep").alias("owner")), "owner")
    day = F.to_date("created_at")
    return c.select("case_id", "org", F.col("owner").alias("rep"), day.alias("day"),
                    business_deadline(day).alias("deadline"))


def retention_cases(cases: DataFrame, allow: DataFrame, anchors: Anchors, days: int = 30) -> DataFrame:
    """Cases created in [anchor - days, anchor] with their SLA deadline."""
    rows = retention_case_rows(cases, allow)
    return in_window(rows, anchors, "day", -days, 0, end_inclusive=True).select(
        "anchor", "case_id", "org", "rep", "day", "deadline")


def _with_first_contact(rows: DataFrame, outreach: DataFrame) -> DataFrame:
    probes = rows.select("org", F.col("day").alias("from_day")).distinct()
    firsts = first_on_or_after(outreach, probes, ["org"])
    return rows.join(firsts.withColumnRenamed("from_day", "day"), ["org", "day"], "left")


def _per_rep(rows: DataFrame, id_col: str, met: F.Column, names: tuple[str, str, str]) -> Partials:
    # one row per (anchor, rep, item): duplicates come only from a name listed twice
    total, done, pct = names
    one = rows.select("anchor", "rep", id_col, flag(met).alias(f"_{done}")).distinct().withColumn(f"_{total}", F.lit(1))
    return Partials(one, {f"_{total}": "sum", f"_{done}": "sum"}, {
        total: F.col(f"_{total}").cast("long"), done: F.col(f"_{done}").cast("long"), pct: safe_ratio(f"_{done}", f"_{total}", 3)})


def retention_partials(cases: DataFrame, allow: DataFrame, outreach: DataFrame, anchors: Anchors,
                       rule: str = "deadline", days: int = 30, rows: DataFrame | None = None) -> Partials:
    """Per (anchor, rep): retention cases, cases contacted in time, ratio (3 dp).

    rule="deadline": cases whose 2-business-day deadline is before the anchor;
      met if any allowlisted outreach to the org in [created, deadline].
    rule="open": every case created in [anchor - days, anchor); met if any
      outreach to the org on/after creation and before the anchor.
    """
    rows = rows if rows is not None else retention_case_rows(cases, allow)
    if rule == "deadline":
        rows = in_window(rows, anchors, "day", -days, 0).where(F.col("deadline") < F.col("anchor"))
        rows = _with_first_contact(rows, outreach)
        met = F.col("first_day") <= F.col("deadline")
    elif rule == "open":
        rows = _with_first_contact(in_window(rows, anchors, "day", -days, 0), outreach)
        met = F.col("first_day") < F.col("anchor")
    else:
        raise ValueError(rule)
    return _per_rep(rows, "case_id", met, ("total_ret_cases", "sla_met_count", "ret_sla_pct"))


def retention_sla(cases: DataFrame, allow: DataFrame, outreach: DataFrame, anchors: Anchors,
                  rule: str = "deadline", days: int = 30, rows: DataFrame | None = None) -> DataFrame:
    """``retention_partials`` reduced: one row per (anchor, rep)."""
    return retention_partials(cases, allow, outreach, anchors, rule, days, rows).table()


def churn_task_rows(tasks: DataFrame, allow: DataFrame, rules: Rules) -> DataFrame:
    """Unarchived churn-risk tasks with an org, owner allowlisted (bag)."""
    t = tasks.where(
        (F.col("slug") == F.lit(rules.churn_task_slug))
        & (F.col("is_archived") == F.lit(False))
        & F.col("org").isNotNull()
    ).join(allow.select(F.col("rep").alias("owner")), "owner")
    return t.select("task_id", "org", F.col("owner").alias("rep"), F.to_date("inserted_at").alias("day"))


def churn_partials(tasks: DataFrame, allow: DataFrame, outreach: DataFrame, anchors: Anchors,
                   rules: Rules, days: int = 30, rows: DataFrame | None = None) -> Partials:
    """Per (anchor, rep): churn-risk tasks of the window, tasks with outreach to
    the org on/after the task day (before the anchor), ratio, any-unattempted."""
    t = rows if rows is not None else churn_task_rows(tasks, allow, rules)
    t = _with_first_contact(in_window(t, anchors, "day", -days, 0, end_inclusive=True), outreach)
    reached = F.col("first_day") < F.col("anchor")
    out = _per_rep(t, "task_id", reached, ("total_churn_tasks", "churn_tasks_reached", "churn_reach_pct"))
    missed = F.col("_churn_tasks_reached") < F.col("_total_churn_tasks")
    return replace(out, finish=out.finish | {"has_unattempted_churn": missed.cast("int").cast("long")})


def churn_task_compliance(tasks: DataFrame, allow: DataFrame, outreach: DataFrame, anchors: Anchors,
                          rules: Rules, days: int = 30, rows: DataFrame | None = None) -> DataFrame:
    """``churn_partials`` reduced: one row per (anchor, rep)."""
    return churn_partials(tasks, allow, outreach, anchors, rules, days, rows).table()


def open_case_counts(cases: DataFrame, rules: Rules) -> DataFrame:
    """Open onboarding and open retention cases per owner (one pass)."""
    open_ = F.col("is_closed") == F.lit(False)
    onb = F.col("record_type").isin(list(rules.onboarding_case_types)) & open_
    ret = (F.col("record_type") == F.lit(RETENTION_CASE_TYPE)) & open_
    c = cases.where(onb | ret)
    return c.groupBy(F.col("owner").alias("rep")).agg(
        F.count_if(onb).alias("open_onboarding_cases"), F.count_if(ret).alias("open_retention_cases"))


def daily_sla_closed(cases: DataFrame, allow: DataFrame, outreach_all_days: DataFrame) -> DataFrame:
    """Per (deadline day, rep): retention cases of any age whose deadline is that
    day, and those with outreach to the org in [created, deadline]."""
    rows = _with_first_contact(retention_case_rows(cases, allow), outreach_all_days)
    met = flag(F.col("first_day") <= F.col("deadline"))
    one = rows.select(F.col("deadline").alias("day"), "rep", "case_id", met.alias("_met")).distinct()
    return one.groupBy("day", "rep").agg(
        F.count(F.lit(1)).alias("daily_ret_created"), F.sum("_met").cast("long").alias("daily_ret_met"))
