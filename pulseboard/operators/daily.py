"""Daily operators: one value per (day, rep).

All of them run over every day in one job (group by day), or over a given
list of days, in which case the day filter reaches the scans.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Rules
from ..functions.dates import is_business_day
from ..functions.numeric import exact_sum
from ..session import written
from ..sources import Sources
from . import sla as SL
from . import touches as T
from .calls import all_scores
from .common import ts_bounds


def _bounds(days):
    if not days:
        return None, None
    return min(days), max(days) + dt.timedelta(days=1)


def _only(df: DataFrame, days, col: str = "day") -> DataFrame:
    return df.where(F.col(col).isin(*days)) if days else df


def touch_day_counts(src: Sources, rules: Rules, days=None, before: int = 0) -> DataFrame:
    """(rep, org, day) touch counts of every rep (``touches.touch_days``) over ``days``
    and the ``before`` days ahead of each. All daily touch metrics are projections of it."""
    wanted = sorted({d - dt.timedelta(days=k) for d in days for k in range(before + 1)}) if days else None
    lo, hi = _bounds(wanted)
    return T.touch_days(_only(T.touch_sources(src, rules, lo, hi, days=wanted), wanted))


def daily_touch_count(touch_days: DataFrame, allow: DataFrame, days=None) -> DataFrame:
    """Qualified touches per (day, rep): actions + calls of >= 15 min / 900 s
    with no action for the same rep and org that day."""
    rd = T.rep_days(_only(touch_days, days).join(allow.select("rep"), "rep"))
    return rd.where(F.col("n_q") > 0).select("day", "rep", F.col("n_q").cast("long").alias("daily_ar_count"))


def daily_active_flag(touch_days: DataFrame, allow: DataFrame, days=None) -> DataFrame:
    """(day, rep, 1) for Mon-Fri days with any outreach of an allowlisted rep."""
    t = _only(touch_days, days).join(allow.select("rep").distinct(), "rep", "left_semi").where(is_business_day("day"))
    return t.select("day", "rep").distinct().withColumn("daily_active", F.lit(1).cast("long"))


def daily_call_score(src: Sources, allow: DataFrame, days=None) -> DataFrame:
    """Sum and count of valid call scores per (day, rep) (allowlist as a filter)."""
    s = _only(all_scores(src), days, "conv_date").join(allow.select("rep").distinct(), "rep", "left_semi")
    return s.groupBy(F.col("conv_date").alias("day"), "rep").agg(
        exact_sum("score").alias("daily_call_score_sum"), F.count(F.lit(1)).alias("daily_call_count"))


#: A retention case's deadline is two to this many days after its creation.
LONGEST_DEADLINE = 4


def daily_sla_closed(src: Sources, touch_days: DataFrame, allow: DataFrame, days=None) -> DataFrame:
    """Retention cases whose SLA deadline is the day, and those met in time.
    ``touch_days`` must reach back ``LONGEST_DEADLINE`` days before ``days``."""
    cases = src.cases
    if days:  # bound the creation time at the scan
        cases = cases.where(ts_bounds("created_at", min(days) - dt.timedelta(days=LONGEST_DEADLINE),
                                      max(days) + dt.timedelta(days=1)))
    outreach = SL.outreach_keys(touch_days.join(allow.select("rep").distinct(), "rep", "left_semi"))
    return _only(SL.daily_sla_closed(cases, allow, outreach), days)


DAILY_COLUMNS = ("daily_ar_count", "daily_active", "daily_call_score_sum", "daily_call_count",
                 "daily_ret_created", "daily_ret_met")


def daily_columns(base: DataFrame, src: Sources, allow: DataFrame, rules: Rules, date_col: str = "snapshot_date",
                  days=None, offset_days: int = 1, touch_days: DataFrame | None = None) -> DataFrame:
    """``base`` rows (rep, date) + the six daily columns of day = date - offset.

    Counts default to 0, the score sum stays null. ``days`` (the distinct
    dates of ``base``, known to the caller) restricts every source scan.
    ``touch_days``: the caller's (rep, org, day) counts of every rep, if it has
    them for those days and ``LONGEST_DEADLINE`` days before."""
    metric_days = [d - dt.timedelta(days=offset_days) for d in days] if days else None
    b = base.withColumn("_day", F.date_sub(F.col(date_col), offset_days))
    if touch_days is None:  # one read of each touch table for all four metrics
        touch_days = written(touch_day_counts(src, rules, metric_days, LONGEST_DEADLINE), "daily-touches")
    parts = [
        daily_touch_count(touch_days, allow, metric_days),
        daily_active_flag(touch_days, allow, metric_days),
        daily_call_score(src, allow, metric_days),
        daily_sla_closed(src, touch_days, allow, metric_days),
    ]
    for p in parts:
        b = b.join(p.withColumnRenamed("day", "_day"), ["_day", "rep"], "left")
    z = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    return b.select(
        *[c for c in base.columns if c not in DAILY_COLUMNS],
        z("daily_ar_count").alias("daily_ar_count"), z("daily_active").alias("daily_active"),
        F.col("daily_call_score_sum"), z("daily_call_count").alias("daily_call_count"),
        z("daily_ret_created").alias("daily_ret_created"), z("daily_ret_met").alias("daily_ret_met"),
    )
