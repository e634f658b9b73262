"""Score, signal and band operators."""

from __future__ import annotations

import bisect
import datetime as dt
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import GREEN_AT, HIGH_RISK_LEVELS, NO_RENEWAL_PILLAR_PATTERNS, YELLOW_AT
from ..functions.dates import Anchors
from ..functions.numeric import round_half_up
from .touches import touch_norm


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def interaction_signals(signals: DataFrame) -> DataFrame:
    """Per rep over rows flagged latest: mean risk (2 dp), high/critical count,
    cancellation-intent count, mean sentiment (2 dp)."""
    s = signals.where(F.col("is_latest") == F.lit(True))
    return s.groupBy("rep").agg(
        round_half_up(F.avg("risk_score"), 2).alias("avg_risk_score"),
        F.count_if(F.col("risk_level").isin(*HIGH_RISK_LEVELS)).alias("high_risk_org_count"),
        F.count_if(F.col("cancel_intent") == F.lit(True)).alias("cancellation_intent_count"),
        round_half_up(F.avg("sentiment"), 2).alias("avg_sentiment_score"),
    )


#: Days before the first anchor in which its latest analysis date is looked for first.
ASOF_LOOK_BACK = 31


def latest_dates(signals: DataFrame, anchors: Anchors) -> dict[dt.date, dt.date]:
    """Latest analysis date on or before each anchor; anchors without one are absent.

    Only the dates from ``ASOF_LOOK_BACK`` days before the first anchor on are read, by a pushed-down range;
    if none of them precedes it, the one latest date further back is looked up too. One value per day."""
    day, lo = F.col("analysis_date"), anchors.lo - dt.timedelta(days=ASOF_LOOK_BACK)
    near = signals.where((day >= F.lit(lo)) & (day <= F.lit(anchors.hi))).select("analysis_date").distinct()
    dates = sorted(r[0] for r in near.collect())
    if not dates or dates[0] > anchors.lo:
        before = signals.where(day < F.lit(lo)).agg(F.max(day)).first()[0]
        dates = ([before] if before else []) + dates
    at = {a: bisect.bisect_right(dates, a) for a in anchors.dates}
    return {a: dates[k - 1] for a, k in at.items() if k}


def interaction_signals_asof(signals: DataFrame, anchors: Anchors) -> DataFrame:
    """Per (anchor, rep): the two counts over rows of the single latest analysis
    date on or before the anchor (one date for all reps). The dates are found
    first; they reach the scan as literals, and only their rows are counted per
    (date, rep) before they meet the anchors."""
    latest = latest_dates(signals, anchors)
    per_day = signals.where(F.col("analysis_date").isin(*sorted(set(latest.values())))).groupBy("analysis_date", "rep").agg(
        F.count_if(F.col("risk_level").isin(*HIGH_RISK_LEVELS)).alias("high_risk_org_count"),
        F.count_if(F.col("cancel_intent") == F.lit(True)).alias("cancellation_intent_count"),
    )
    pairs = json.dumps([{"anchor": str(a), "analysis_date": str(d)} for a, d in latest.items()])
    pairs = F.from_json(F.lit(pairs), "array<struct<anchor:date,analysis_date:date>>")
    days = signals.sparkSession.range(1).select(F.inline(pairs))
    return per_day.join(days, "analysis_date").select("anchor", "rep", "high_risk_org_count", "cancellation_intent_count")


def renewal_pillar_allowed(segment) -> Column:
    seg = _c(segment)
    out = None
    for p in NO_RENEWAL_PILLAR_PATTERNS:
        t = ~seg.ilike(p)
        out = t if out is None else (out & t)
    return out


def composite_columns(ar_rate, segment, call_norm, sla_pct, renewal_pct, renewal_counted: Column) -> dict:
    """The four pillar norms and the composite (mean of counted pillars, 4 dp).

    touch pillar always counts; call and SLA count when not null; renewal
    counts when ``renewal_counted`` is true (null -> not counted)."""
    ar = touch_norm(ar_rate, segment)
    call, sla, ren = _c(call_norm), _c(sla_pct), _c(renewal_pct)
    counted = F.when(renewal_counted, F.lit(True)).otherwise(F.lit(False))
    num = (ar + F.coalesce(call, F.lit(0.0)) + F.coalesce(sla, F.lit(0.0))
           + F.when(counted, F.coalesce(ren, F.lit(0.0))).otherwise(F.lit(0.0)))
    den = (F.lit(1.0) + F.when(call.isNotNull(), 1.0).otherwise(0.0)
           + F.when(sla.isNotNull(), 1.0).otherwise(0.0) + F.when(counted, 1.0).otherwise(0.0))
    return {
        "ar_score_norm": ar,
        "call_score_norm": call,
        "sla_score_norm": sla,
        "renewal_score_norm": F.coalesce(ren, F.lit(0.0)),
        "composite_score": round_half_up(num / den, 4),
    }


def score_band(composite) -> Column:
    c = _c(composite)
    return F.when(c >= GREEN_AT, "green").when(c >= YELLOW_AT, "yellow").otherwise("red")


def churn_gate(has_unattempted, composite) -> Column:
    return F.when((F.coalesce(_c(has_unattempted), F.lit(0)) == 1) & (_c(composite) >= GREEN_AT),
                  F.lit(True)).otherwise(F.lit(False))


def score_7d_ago(snapshots: DataFrame, anchors: Anchors, days: int = 7) -> DataFrame:
    """(anchor, rep, composite_score_7d_ago) from the snapshot dated anchor - 7."""
    wanted = [d - dt.timedelta(days=days) for d in anchors.dates]
    a = anchors.df(snapshots.sparkSession).select("anchor", F.date_sub("anchor", days).alias("snapshot_date"))
    # literal IN list first: prunes snapshot partitions at the scan
    return snapshots.where(F.col("snapshot_date").isin(*wanted)).join(a, "snapshot_date").select(
        "anchor", "rep", F.col("composite_score").alias("composite_score_7d_ago"))


def score_delta(now, then) -> Column:
    return round_half_up((_c(now) - _c(then)) * 100, 1)
