"""Renewal operators.

Cohorts depend only on the anchor's month, so they are built per distinct
month (``cohort_months``). Coverage asks "was this org touched in [earliest
renewal month of the org - look-back, anchor)?", that is "is its first
qualifying touch on or after that day before the anchor?": one as-of lookup per
(month, org), counts per (month, rep, renewal month, first day), and only these
counts meet the anchors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CONTRACT_ACTIVE, MONTH_TO_MONTH
from ..functions.dates import Anchors
from ..functions.numeric import flag, safe_ratio
from ..sources import Sources
from .common import first_on_or_after, in_window
from .partials import Partials

COHORT_COLS = ("anchor", "rep", "org", "renewal_month", "contract_type")


def _months(anchors: Anchors, spark) -> DataFrame:
    return anchors.df(spark).select("m0", "m1", "m2", "m3").distinct()


def cohort_months(src: Sources, allow: DataFrame, anchors: Anchors, mode: str = "current") -> DataFrame:
    """Distinct (m0, rep, org, renewal_month, contract_type) renewing in M1..M3 of the anchor month m0.

    current: the book row of the renewal month itself with revenue, live
      account owner allowlisted, an activated contract ending in that month,
      and revenue in the anchor's month as well ("existing customer").
    nocheck: current without the anchor-month existence test.
    legacy: the anchor month's book rows, month-start owner allowlisted,
      contract end month in M1..M3; no account or contract check.
    """
    spark = src.book.sparkSession
    months = _months(anchors, spark)
    names = allow.select("rep").distinct()
    rm_trunc = F.trunc("contract_end", "month")
    if mode in ("current", "nocheck"):
        targets = months.select("m0", F.explode(F.array("m1", "m2", "m3")).alias("rm"))
        b = src.book.where((F.col("mrr") > 0) & F.col("month").isin(*anchors.months(1, 2, 3))
                           & (rm_trunc == F.col("month")))
        b = b.join(targets, F.col("month") == F.col("rm"))
        owners = src.roster.select(F.col("user_id").alias("owner_id"), F.col("user_name").alias("rep"))
        b = (
            b.drop("owner").join(src.accounts.select("org", "owner_id"), "org")
            .join(owners, "owner_id")
            .join(names, "rep", "left_semi")
        )
        c = src.contracts.where(F.col("status") == F.lit(CONTRACT_ACTIVE)).select(
            F.col("org").alias("c_org"), "end_date")
        b = b.join(
            c,
            (F.col("org") == F.col("c_org")) & (F.col("end_date") >= F.col("rm"))
            & (F.col("end_date") < F.add_months(F.col("rm"), 1)),
            "left_semi",
        )
        if mode == "current":
            existing = src.book.where((F.col("mrr") > 0) & F.col("month").isin(*anchors.months(0))).select(
                "org", F.col("month").alias("m0"))
            b = b.join(existing, ["org", "m0"], "left_semi")
        out = b.select("m0", "rep", "org", F.col("rm").alias("renewal_month"), "contract_type")
    elif mode == "legacy":
        b = src.book.where((F.col("mrr") > 0) & F.col("month").isin(*anchors.months(0))).join(
            months, F.col("month") == F.col("m0"))
        b = b.where(rm_trunc.isin(F.col("m1"), F.col("m2"), F.col("m3")))
        b = b.join(names.select(F.col("rep").alias("owner")), "owner", "left_semi")
        out = b.select("m0", F.col("owner").alias("rep"), "org", rm_trunc.alias("renewal_month"), "contract_type")
    else:
        raise ValueError(mode)
    return out.distinct()


def renewal_cohort(src: Sources, allow: DataFrame, anchors: Anchors, mode: str = "current") -> DataFrame:
    """``cohort_months`` of every anchor: (anchor, rep, org, renewal_month, contract_type)."""
    return at_anchors(cohort_months(src, allow, anchors, mode), anchors).select(*COHORT_COLS)


def at_anchors(by_month: DataFrame, anchors: Anchors) -> DataFrame:
    """Rows keyed by anchor month m0, once per anchor of that month."""
    return by_month.join(anchors.df(by_month.sparkSession).select("anchor", "m0"), "m0")


def qualifying(base: DataFrame) -> DataFrame:
    return base.where(F.col("qualifies") & F.col("org").isNotNull())


def renewal_touches(base: DataFrame, cohort: DataFrame, anchors: Anchors, lookback: int = 120) -> DataFrame:
    """Qualifying allowlisted touches (no unlogged test) in the base window
    [M1 - lookback, anchor), matched to cohort rows of the same org whose
    [renewal month - lookback, renewal month) holds the touch day. Bag rows:
    counted per (day, rep, org) before they meet the cohort, and repeated at the end."""
    per_day = qualifying(base).groupBy("day", "rep", "org").agg(F.count(F.lit(1)).alias("_n"))
    t = in_window(per_day, anchors, "day", -lookback, 0)
    m1 = anchors.df(base.sparkSession).select("anchor", "m1")
    t = t.join(m1, "anchor").where(F.col("day") >= F.date_sub("m1", lookback))
    rc = cohort.groupBy("anchor", "org", "renewal_month").agg(F.count(F.lit(1)).alias("_c"))
    j = t.join(rc, ["anchor", "org"]).where(
        (F.col("day") >= F.date_sub("renewal_month", lookback)) & (F.col("day") < F.col("renewal_month")))
    j = j.groupBy("anchor", "day", "rep", "org").agg(F.sum(F.col("_n") * F.col("_c")).alias("_n"))
    return j.select("anchor", "day", "rep", "org", F.explode(F.sequence(F.lit(1), F.col("_n").cast("int")))).drop("col")


def _first_touch(cohort: DataFrame, touch_keys: DataFrame, keys: list[str], lookback: int) -> DataFrame:
    """(m0, *keys, first_day): first qualifying touch on or after the earliest
    renewal month of the org less the look-back."""
    since = cohort.groupBy("m0", "org").agg(F.date_sub(F.min("renewal_month"), lookback).alias("from_day"))
    probes = since if keys == ["org"] else touch_keys.select(*keys).distinct().join(since, "org")
    return probes.join(first_on_or_after(touch_keys, probes, keys), [*keys, "from_day"]).select("m0", *keys, "first_day")


def renewal_coverage(cohort: DataFrame, touch_keys: DataFrame, anchors: Anchors, match_on: tuple[str, ...] = ("org",),
                     lookback: int = 120) -> DataFrame:
    """Per (anchor, rep, renewal_month): cohort orgs, orgs touched, ratio (3 dp),
    month-to-month orgs, month-to-month touched, other-type ("annual") orgs.

    ``cohort`` is keyed by anchor month (``cohort_months``); ``touch_keys`` holds
    distinct (org, day) [+ rep when matching on rep]. A touch valid for one
    renewal month of an org credits its other months too, as in the source
    definition."""
    called = F.col("first_day") < F.col("anchor")
    counts = coverage_counts(cohort, touch_keys, match_on, lookback)
    return at_anchors(counts, anchors).groupBy("anchor", "rep", "renewal_month").agg(
        F.sum("_n").cast("long").alias("cohort_total"),
        F.sum(F.when(called, F.col("_n")).otherwise(0)).cast("long").alias("cohort_called"),
        F.sum("_m2m").cast("long").alias("m2m_orgs"),
        F.sum(F.when(called, F.col("_m2m")).otherwise(0)).cast("long").alias("m2m_called"),
        F.sum("_annual").cast("long").alias("annual_orgs"),
    ).withColumn("coverage_pct", safe_ratio("cohort_called", "cohort_total", 3))


def coverage_counts(cohort: DataFrame, touch_keys: DataFrame, match_on: tuple[str, ...] = ("org",), lookback: int = 120) -> DataFrame:
    """(m0, rep, renewal_month, first_day): cohort orgs first touched that day, and their contract types."""
    keys = list(match_on)
    first = _first_touch(cohort, touch_keys, keys, lookback)
    ct = F.col("contract_type")
    per_org = cohort.join(first, ["m0", *keys], "left").groupBy("m0", "rep", "renewal_month", "org").agg(
        F.max(flag(ct == F.lit(MONTH_TO_MONTH))).alias("_m2m"),
        F.max(flag((ct != F.lit(MONTH_TO_MONTH)) | ct.isNull())).alias("_annual"),
        F.min("first_day").alias("first_day"),
    )
    return per_org.groupBy("m0", "rep", "renewal_month", "first_day").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_m2m").alias("_m2m"), F.sum("_annual").alias("_annual"))


def renewal_contacted(cohort: DataFrame, touch_keys_by_rep: DataFrame, anchors: Anchors, lookback: int = 120) -> DataFrame:
    """Distinct (anchor, rep, org): reps with a qualifying touch to a cohort org
    in [earliest renewal month of the org - lookback, anchor)."""
    first = _first_touch(cohort, touch_keys_by_rep, ["org", "rep"], lookback)
    return at_anchors(first, anchors).where(F.col("first_day") < F.col("anchor")).select("anchor", "rep", "org")


PIVOT_FIELDS = (("total", "cohort_total"), ("called", "cohort_called"), ("pct", "coverage_pct"),
                ("m2m", "m2m_orgs"), ("m2m_called", "m2m_called"), ("annual", "annual_orgs"))


def renewal_pivot(coverage: DataFrame, anchors: Anchors) -> DataFrame:
    """One row per (anchor, rep) with M1/M2/M3 side by side (one conditional
    aggregate instead of three filtered joins)."""
    a = anchors.df(coverage.sparkSession)
    j = coverage.join(a, "anchor")
    aggs = []
    for k in (1, 2, 3):
        is_k = F.col("renewal_month") == F.col(f"m{k}")
        aggs += [F.max(F.when(is_k, F.col(src))).alias(f"renewal_m{k}_{name}") for name, src in PIVOT_FIELDS]
    return j.groupBy("anchor", "rep").agg(*aggs)


def renewal_partials(counts: DataFrame, anchors: Anchors) -> Partials:
    """The columns of ``renewal_pivot`` from ``coverage_counts``."""
    j = at_anchors(counts, anchors).join(anchors.df(counts.sparkSession).select("anchor", "m1", "m2", "m3"), "anchor")
    called = F.col("first_day") < F.col("anchor")
    figures = {"total": F.col("_n"), "called": F.when(called, F.col("_n")).otherwise(0), "m2m": F.col("_m2m"),
               "m2m_called": F.when(called, F.col("_m2m")).otherwise(0), "annual": F.col("_annual")}
    columns, finish = [], {}
    for k in (1, 2, 3):
        is_k = F.col("renewal_month") == F.col(f"m{k}")
        columns += [F.when(is_k, c).alias(f"_ren{k}_{name}") for name, c in figures.items()]
        finish |= {f"renewal_m{k}_{name}": F.col(f"_ren{k}_{name}").cast("long") for name in figures}
        finish[f"renewal_m{k}_pct"] = safe_ratio(f"_ren{k}_called", f"_ren{k}_total", 3)
    return Partials(j.select("anchor", "rep", *columns), {f"_ren{k}_{name}": "sum" for k in (1, 2, 3) for name in figures}, finish)
