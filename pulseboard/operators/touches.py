"""Touch operators: contacts from CRM actions and two call sources.

The three sources are read once per job into one tagged relation
(``touch_base``: day, rep, org, source_id, channel, qualifies), restricted to
allowlisted reps (inner join: a name listed twice counts twice, as in the
source system). Every other touch metric is a filter or reduction of it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import (
    DEFAULT_CUTOFFS, DEFAULT_TARGET, MIN_CALL_MINUTES, MIN_CALL_SECONDS, SEGMENT_TARGETS,
    STATUS_CUTOFFS, Rules,
)
from ..functions.dates import Anchors, is_business_day
from ..functions.numeric import round_half_up
from ..functions.text import ilike_any
from ..sources import Sources
from .common import MANY_ANCHORS, difference_events, in_window, running_sums, runs_of_days, ts_bounds
from .partials import Partials

TOUCH_COLS = ("day", "rep", "org", "source_id", "channel", "qualifies")


def touch_sources(src: Sources, rules: Rules, lo: dt.date | None, hi: dt.date | None,
                  org_required_for_actions: bool = False, days=None) -> DataFrame:
    """Union of the three touch sources with ``lo <= day < hi`` (None = open),
    or, with ``days``, only those calendar days: an OR of timestamp ranges (one
    per run of days), which the Parquet scan can push down.

    actions: closed CRM actions of the configured record type (org may be null);
    call_a: completed calls with an org, qualifying at >= 15 minutes;
    call_b: calls with an org (no status), qualifying at >= 900 seconds.
    """
    def bounded(df, ts):
        if days:
            cond = None
            for first, last in runs_of_days(days):
                term = ts_bounds(ts, first, last + dt.timedelta(days=1))
                cond = term if cond is None else (cond | term)
            return df.where(cond)
        if lo is None and hi is None:
            return df
        lo_ = lo or dt.date(1, 1, 1)
        hi_ = hi or dt.date(9999, 12, 31)
        return df.where(ts_bounds(ts, lo_, hi_))

    acts = bounded(src.actions, "closed_at").where(
        (F.col("record_type") == F.lit(rules.action_record_type))
        & (F.lower("status") == F.lit("closed"))
        & F.col("closed_at").isNotNull()
    )
    if org_required_for_actions:
        acts = acts.where(F.col("org").isNotNull())
    acts = acts.select(
        F.to_date("closed_at").alias("day"), "rep", "org", F.col("action_id").alias("source_id"),
        F.lit("action").alias("channel"), F.lit(True).alias("qualifies"),
    )
    ca = bounded(src.calls_a, "start_at").where(
        (F.lower("status") == F.lit("completed")) & F.col("org").isNotNull()
    ).select(
        F.to_date("start_at").alias("day"), "rep", "org", F.col("call_id").alias("source_id"),
        F.lit("call_a").alias("channel"), (F.col("minutes") >= MIN_CALL_MINUTES).alias("qualifies"),
    )
    cb = bounded(src.calls_b, "inserted_at").where(F.col("org").isNotNull()).select(
        F.to_date("inserted_at").alias("day"), "rep", "org", F.col("call_id").alias("source_id"),
        F.lit("call_b").alias("channel"), (F.col("seconds") >= MIN_CALL_SECONDS).alias("qualifies"),
    )
    return acts.unionByName(ca).unionByName(cb)


def touch_base(src: Sources, allow: DataFrame, rules: Rules, lo: dt.date | None,
               hi: dt.date | None, days=None) -> DataFrame:
    """Allowlisted touches (bag join to the allowlist's names)."""
    return touch_sources(src, rules, lo, hi, days=days).join(allow.select("rep"), "rep").select(*TOUCH_COLS)


def call_touches(src: Sources, allow: DataFrame, which: str) -> DataFrame:
    """Allowlisted calls of one source with their length (whole table)."""
    if which == "a":
        c = src.calls_a.where((F.lower("status") == F.lit("completed")) & F.col("org").isNotNull())
        c = c.select(F.to_date("start_at").alias("day"), "rep", "org", F.col("call_id").alias("source_id"), "minutes")
    else:
        c = src.calls_b.where(F.col("org").isNotNull())
        c = c.select(F.to_date("inserted_at").alias("day"), "rep", "org", F.col("call_id").alias("source_id"),
                     "seconds")
    return c.join(allow.select("rep"), "rep")


def unlogged_calls(base: DataFrame) -> DataFrame:
    """Qualifying calls with no CRM action for the same rep, org and day.

    The match is per day, so it does not depend on the anchor: any window
    holding the call's day also holds the same-day actions. Null orgs never
    match (SQL equality)."""
    acts = base.where(F.col("channel") == "action").select("rep", "org", "day")
    calls = base.where((F.col("channel") != "action") & F.col("qualifies"))
    return calls.join(acts, ["rep", "org", "day"], "left_anti").select(*TOUCH_COLS)


def qualified_touches(base: DataFrame) -> DataFrame:
    """Actions plus unlogged qualifying calls (bag union)."""
    return base.where(F.col("channel") == "action").unionByName(unlogged_calls(base))


def touch_days(base: DataFrame) -> DataFrame:
    """One row per (rep, org, day): CRM actions, qualifying calls, any touches.

    The same-day "unlogged call" rule becomes a per-key count rule here
    (calls count only where the key has no action), so every touch metric
    of a job reads this compact relation instead of the raw sources; the
    map-side partial aggregation also absorbs hot keys before the shuffle."""
    is_act = F.col("channel") == "action"
    return base.groupBy("rep", "org", "day").agg(
        F.count_if(is_act).alias("n_act"),
        F.count_if(~is_act & F.col("qualifies")).alias("n_long"),
        F.count(F.lit(1)).alias("n_any"),
    )


def qualified_count(td: DataFrame) -> F.Column:
    """Qualified touches of a (rep, org, day) key: actions, or else long calls."""
    return F.col("n_act") + F.when(F.col("n_act") == 0, F.col("n_long")).otherwise(F.lit(0))


def rep_days(td: DataFrame) -> DataFrame:
    """(rep, day, n_qualified) for every day with any touch."""
    return td.groupBy("rep", "day").agg(F.sum(qualified_count(td)).alias("n_q"))


def touch_rate_partials(rd: DataFrame, anchors: Anchors, days: int = 30) -> Partials:
    """``touch_rate`` from ``rep_days``; null without a touch or an active weekday."""
    figures = ["_touch_n", "_touch_days"]
    rd = rd.select("rep", "day", F.col("n_q").alias("_touch_n"), is_business_day("day").cast("int").alias("_touch_days"))
    if len(anchors.dates) < MANY_ANCHORS:
        rows = windowed(rd, anchors, days).select("anchor", "rep", *figures)
    else:
        rows = running_sums(difference_events(rd, anchors, "day", -days, 0, ["rep"], figures), anchors, "rep", "_at", figures)
        rows = rows.where((F.col("_touch_n") != 0) | (F.col("_touch_days") != 0))
    n, active = F.col("_touch_n").cast("long"), F.col("_touch_days").cast("double")
    counted = (n > 0) & (active > 0)
    return Partials(rows, {"_touch_n": "sum", "_touch_days": "sum"}, {
        "total_ars_l30": F.when(counted, n), "ars_per_day": F.when(counted, round_half_up(n / F.when(active > 0, active), 2))})


def touch_rate_from_days(rd: DataFrame, anchors: Anchors, days: int = 30) -> DataFrame:
    """``touch_rate`` from ``rep_days`` in one windowed aggregation."""
    return touch_rate_partials(rd, anchors, days).table().where(F.col("total_ars_l30").isNotNull())


def windowed(df: DataFrame, anchors: Anchors, days: int) -> DataFrame:
    """Rows of the last ``days`` days before each anchor: [anchor - days, anchor)."""
    return in_window(df, anchors, "day", -days, 0)


def active_days(base: DataFrame, anchors: Anchors, days: int = 30) -> DataFrame:
    """Per (anchor, rep): distinct Mon-Fri days with any outreach, as double."""
    rep_days = base.where(is_business_day("day")).select("rep", "day").distinct()
    return windowed(rep_days, anchors, days).groupBy("anchor", "rep").agg(
        F.count(F.lit(1)).cast("double").alias("n_days"))


def touch_rate(base: DataFrame, anchors: Anchors, days: int = 30) -> DataFrame:
    """Per (anchor, rep): qualified touches in the window and that / active days.

    Reduced to (rep, day) counts before the anchor expansion, so the work per
    anchor is bounded by reps x days, not by touches. Reps without an active
    weekday or without a qualified touch are absent (inner join)."""
    per_day = qualified_touches(base).groupBy("rep", "day").agg(F.count(F.lit(1)).alias("n"))
    totals = windowed(per_day, anchors, days).groupBy("anchor", "rep").agg(
        F.sum("n").cast("long").alias("total_ars_l30"))
    ad = active_days(base, anchors, days)
    return totals.join(ad, ["anchor", "rep"]).select(
        "anchor", "rep", "total_ars_l30",
        round_half_up(F.col("total_ars_l30") / F.col("n_days"), 2).alias("ars_per_day"),
    )


def touch_target(segment) -> F.Column:
    seg = F.col(segment) if isinstance(segment, str) else segment
    out = None
    for pat, tgt in SEGMENT_TARGETS:
        cond = seg.ilike(pat)
        out = F.when(cond, F.lit(tgt)) if out is None else out.when(cond, F.lit(tgt))
    return out.otherwise(F.lit(DEFAULT_TARGET))


def touch_norm(rate, segment) -> F.Column:
    r = F.col(rate) if isinstance(rate, str) else rate
    return F.least(F.lit(1.0), F.coalesce(r, F.lit(0.0)) / touch_target(segment))


def touch_status(rate, segment) -> F.Column:
    r = F.coalesce(F.col(rate) if isinstance(rate, str) else rate, F.lit(0.0))
    seg = F.col(segment) if isinstance(segment, str) else segment

    def band(g, y):
        return F.when(r >= g, "green").when(r >= y, "yellow").otherwise("red")

    out = None
    for pats, g, y in STATUS_CUTOFFS:
        cond = ilike_any(seg, pats)
        out = F.when(cond, band(g, y)) if out is None else out.when(cond, band(g, y))
    return out.otherwise(band(*DEFAULT_CUTOFFS))
