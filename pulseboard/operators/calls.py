"""Call-quality operators.

Scores are first reduced to one row per (rep, day) of decomposable partials
(count, exact sums, min, max) and only then fanned out to anchors, so a
multi-day history costs reps x days, not calls x days.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import INCOMPLETE_QUALITY
from ..functions.dates import Anchors
from ..functions.numeric import round_half_up
from ..sources import Sources
from .common import MANY_ANCHORS, difference_events, frame_figures, in_window, running_sums
from .partials import Partials

SUBS = ("sub_1", "sub_2", "sub_3", "sub_4")
METRICS = ("score",) + SUBS


def all_scores(src: Sources) -> DataFrame:
    """Bag union of the four scored-call tables; quality 'incomplete' or null dropped."""
    u = reduce(lambda a, b: a.unionByName(b), src.scores)
    return u.where(F.col("quality") != F.lit(INCOMPLETE_QUALITY))


def scored_calls(src: Sources, allow: DataFrame, anchors: Anchors, days: int = 60,
                 include_anchor_day: bool = True) -> DataFrame:
    """Allowlisted scored calls of the last ``days`` days (anchor day included
    by default: the current definition has no upper bound but 'today')."""
    s = all_scores(src).join(allow.select("rep"), "rep")
    s = in_window(s, anchors, "conv_date", -days, 0, end_inclusive=include_anchor_day)
    return s.select("anchor", "rep", "conv_date", "score", *SUBS)


def daily_partials(src: Sources, allow: DataFrame, lo: dt.date, hi: dt.date) -> DataFrame:
    s = all_scores(src).where((F.col("conv_date") >= F.lit(lo)) & (F.col("conv_date") <= F.lit(hi)))
    s = s.join(allow.select("rep"), "rep")
    aggs = [F.count(F.lit(1)).alias("n")]
    for m in METRICS:
        aggs += [
            F.sum(F.col(m).cast("decimal(38,9)")).alias(f"s_{m}"),
            F.min(m).alias(f"lo_{m}"),
            F.max(m).alias(f"hi_{m}"),
        ]
    return s.groupBy("rep", "conv_date").agg(*aggs)


def call_metrics(src: Sources, allow: DataFrame, anchors: Anchors, days: int = 30,
                 include_anchor_day: bool = True, daily: DataFrame | None = None) -> DataFrame:
    """Per (anchor, rep) over the last ``days`` days: count, avg/min/max of the
    score and of four sub-scores (1 dp), and avg / 100 (4 dp)."""
    if daily is None:
        daily = daily_partials(src, allow, anchors.lo - dt.timedelta(days=days), anchors.hi)
    return call_partials(daily, anchors, days, include_anchor_day).table()


def call_partials(daily: DataFrame, anchors: Anchors, days: int = 30, include_anchor_day: bool = True) -> Partials:
    """``call_metrics`` from ``daily_partials``."""
    merge, finish = {"_call_n": "sum"}, {}
    columns = [F.col("n").alias("_call_n")]
    for m in METRICS:
        avg = F.col(f"_call_s_{m}").cast("double") / F.col("_call_n")
        low, high = F.col(f"_call_lo_{m}"), F.col(f"_call_hi_{m}")
        if m == "score":
            finish |= {"total_calls_l30": F.col("_call_n").cast("long"), "avg_call_score": round_half_up(avg, 1),
                       "min_call_score": round_half_up(low, 1), "max_call_score": round_half_up(high, 1),
                       "call_score_norm": round_half_up(avg / 100.0, 4)}
        else:
            finish |= {f"avg_{m}": round_half_up(avg, 1), f"min_{m}": round_half_up(low, 1), f"max_{m}": round_half_up(high, 1)}
        for part, how in (("s", "sum"), ("lo", "min"), ("hi", "max")):
            columns.append(F.col(f"{part}_{m}").alias(f"_call_{part}_{m}"))
            merge[f"_call_{part}_{m}"] = how
    if len(anchors.dates) < MANY_ANCHORS:
        w = in_window(daily, anchors, "conv_date", -days, 0, end_inclusive=include_anchor_day)
        return Partials(w.select("anchor", "rep", *columns), merge, finish)
    rows = frame_figures(daily.select("rep", "conv_date", *columns), anchors, "rep", "conv_date", -days, 0 if include_anchor_day else -1, merge)
    return Partials(rows.where(F.col("_call_n") > 0), merge, finish)


def call_metrics_prev(src: Sources, allow: DataFrame, anchors: Anchors, days: int = 30,
                      history_days: int = 60, daily: DataFrame | None = None) -> DataFrame:
    """Per (anchor, rep): average score of days -history_days .. -(days+1)."""
    if daily is None:
        daily = daily_partials(src, allow, anchors.lo - dt.timedelta(days=history_days), anchors.hi)
    return call_prev_partials(daily, anchors, days, history_days).table()


def call_prev_partials(daily: DataFrame, anchors: Anchors, days: int = 30, history_days: int = 60) -> Partials:
    """``call_metrics_prev`` from ``daily_partials``."""
    figures = ["_prev_n", "_prev_s"]
    daily = daily.select("rep", "conv_date", F.col("n").alias("_prev_n"), F.col("s_score").alias("_prev_s"))
    if len(anchors.dates) < MANY_ANCHORS:
        rows = in_window(daily, anchors, "conv_date", -history_days, -days).select("anchor", "rep", *figures)
    else:
        events = difference_events(daily, anchors, "conv_date", -history_days, -days, ["rep"], figures)
        rows = running_sums(events, anchors, "rep", "_at", figures).where(F.col("_prev_n") > 0)
    return Partials(rows, {"_prev_n": "sum", "_prev_s": "sum"}, {
        "prev_avg_call_score": round_half_up(F.col("_prev_s").cast("double") / F.col("_prev_n"), 1)})


def call_delta(avg_col, prev_col) -> F.Column:
    a = F.col(avg_col) if isinstance(avg_col, str) else avg_col
    p = F.col(prev_col) if isinstance(prev_col, str) else prev_col
    return F.when(a.isNotNull() & p.isNotNull(), round_half_up(a - p, 1))
