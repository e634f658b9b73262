"""Roster and book operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import (
    BOOK_VERTICAL_LABELS, HR_VERTICAL_LABELS, LOCATION_EXCLUDE_PATTERN, ROLE_EXCLUDE_PATTERNS,
    TITLE_EXACT, TITLE_PATTERNS, Rules,
)
from ..functions.dates import Anchors
from ..functions.numeric import flag
from ..functions.text import ilike_any, title_case
from .common import lookup

def rep_allowlist(roster: DataFrame, rules: Rules, *, with_exceptions: bool = True,
                  distinct_rule_arm: bool = False, name_only: bool = False, dedupe: bool = False) -> DataFrame:
    """Reps in scope: the title/role/location rule, minus exclusions, plus the
    exception names (UNION ALL: a name may appear twice -> bag semantics).
    ``dedupe`` keeps one row per name, that of the smallest user id."""
    title, role = F.col("title"), F.col("role_name")
    loc = F.col("working_location")
    rule = (
        (F.col("is_active") == F.lit(True))
        & (ilike_any(title, TITLE_PATTERNS) | (title == F.lit(TITLE_EXACT)))
        & ~ilike_any(role, ROLE_EXCLUDE_PATTERNS)
        & F.col("user_name").isNotNull()
        & (loc.isNull() | ~loc.ilike(LOCATION_EXCLUDE_PATTERN))
    )
    if rules.exclude_names:
        rule = rule & ~F.col("user_name").isin(list(rules.exclude_names))
    cols = [
        F.col("user_id"), F.col("user_name").alias("rep"), F.col("email"), title, role,
        F.coalesce(F.col("is_offshore"), F.lit(False)).alias("is_offshore"), F.col("hr_vertical"),
    ]
    if name_only:
        cols = [F.col("user_name").alias("rep")]
    arm = roster.where(rule).select(*cols)
    if distinct_rule_arm:
        arm = arm.distinct()
    if with_exceptions and rules.exception_names:
        exc = roster.where(
            F.col("user_name").isin(list(rules.exception_names)) & (F.col("is_active") == F.lit(True))
        ).select(*cols)
        arm = arm.unionByName(exc)
    if dedupe:
        arm = arm.groupBy("rep").agg(F.min(F.struct(*arm.columns)).alias("_r")).select("_r.*")
    return arm


def _month_keys(anchors: Anchors, spark) -> DataFrame:
    return anchors.df(spark).select("m0", "m1", "m2", "m3").distinct()


def book_current(book: DataFrame, accounts: DataFrame, roster: DataFrame, allow: DataFrame,
                 anchors: Anchors) -> DataFrame:
    """Per (anchor month ``m0``, org): the book row of that month with revenue,
    earliest contract end first, re-owned by the live account owner, who must
    be allowlisted. One row per (m0, org)."""
    months = _month_keys(anchors, book.sparkSession).select(F.col("m0"))
    b = book.where((F.col("mrr") > 0) & F.col("month").isin(*anchors.months(0)))  # pushed to the scan
    b = b.join(months, F.col("month") == F.col("m0"))
    w1 = Window.partitionBy("m0", "org").orderBy(
        F.col("contract_end").asc_nulls_last(), F.col("mrr").desc(), F.col("owner").asc_nulls_last(),
        F.col("segment").asc_nulls_last(), F.col("vertical").asc_nulls_last(),
        F.col("contract_type").asc_nulls_last(),
    )
    b = b.withColumn("_rn", F.row_number().over(w1)).where(F.col("_rn") == 1)
    owners = roster.select(F.col("user_id").alias("owner_id"), F.col("user_name").alias("rep"))
    j = (
        b.join(accounts.select("org", "owner_id", "manager_name"), "org")
        .join(owners, "owner_id")
        .join(allow.select("rep"), "rep")
    )
    w2 = Window.partitionBy("m0", "org").orderBy(F.col("mrr").desc(), F.col("rep").asc())
    return (
        j.withColumn("_rn", F.row_number().over(w2)).where(F.col("_rn") == 1)
        .select("m0", "org", "rep", "manager_name", "vertical", "segment", "mrr", "dealer_type",
                "has_ai", "contract_end", "location_count", "contract_type")
    )


def primary_vertical(current: DataFrame) -> DataFrame:
    """Per (m0, rep): the vertical with the highest summed revenue."""
    g = current.groupBy("m0", "rep", "vertical").agg(F.sum(F.col("mrr").cast("decimal(38,9)")).alias("_v"))
    w = Window.partitionBy("m0", "rep").orderBy(F.col("_v").desc(), F.col("vertical").asc_nulls_last())
    return g.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).select(
        "m0", "rep", F.col("vertical").alias("primary_vertical"))


def _top_segment(rows: DataFrame) -> DataFrame:
    g = rows.groupBy("m0", "rep", "segment").agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy("m0", "rep").orderBy(F.col("_n").desc(), F.col("segment").asc_nulls_last())
    return g.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1)


def primary_segment(current: DataFrame, rules: Rules) -> DataFrame:
    """Per (m0, rep): the segment with most rows; name-keyed override wins."""
    top = _top_segment(current)
    seg = lookup(F.col("rep"), rules.segment_override, F.col("segment"))
    return top.select("m0", "rep", seg.alias("primary_segment"))


def owner_segment(book: DataFrame, allow: DataFrame, anchors: Anchors) -> DataFrame:
    """Older rule: segment by rows of the month-start owner's book, no override."""
    months = _month_keys(anchors, book.sparkSession).select("m0")
    rows = (
        book.where((F.col("mrr") > 0) & F.col("month").isin(*anchors.months(0)))
        .join(months, F.col("month") == F.col("m0"))
        .join(allow.select(F.col("rep").alias("owner")), "owner")
        .select("m0", F.col("owner").alias("rep"), "segment")
    )
    return _top_segment(rows).select("m0", "rep", "segment")


def rep_book_rollup(current: DataFrame, pvert: DataFrame, pseg: DataFrame, rules: Rules) -> DataFrame:
    j = current.join(pvert, ["m0", "rep"]).join(pseg, ["m0", "rep"])
    partner = F.col("dealer_type") == F.lit(rules.partner_dealer_type)
    mrr_sum = F.sum(F.col("mrr").cast("decimal(38,9)"))
    return j.groupBy("m0", "rep", "primary_vertical", "primary_segment").agg(
        F.max("manager_name").alias("manager_name"),
        F.count("org").alias("org_count"),
        mrr_sum.cast("double").alias("book_mrr"),
        (mrr_sum * 12).cast("double").alias("book_arr"),
        F.max(flag(partner)).cast("long").alias("is_partner_rep"),
        F.sum(flag(partner)).cast("long").alias("partner_org_count"),
        F.max(flag(F.col("has_ai") == F.lit(True))).cast("long").alias("has_ai_accounts"),
        F.sum("location_count").cast("long").alias("location_count"),
    )


def hierarchy_columns(rules: Rules, rep: str = "rep", manager: str = "manager_name"):
    """(manager, director) label columns: rep override, then manager->director map."""
    over = F.col(rep).isin(list(rules.manager_override_reps)) if rules.manager_override_reps else F.lit(False)
    label = F.lit(rules.manager_override_label)
    mgr = F.col(manager)
    director = lookup(mgr, rules.director_by_manager, mgr)
    return F.when(over, label).otherwise(mgr), F.when(over, label).otherwise(director)


def org_hierarchy(rollup: DataFrame, rules: Rules) -> DataFrame:
    """Manager and director labels per rep of the rollup."""
    mgr, director = hierarchy_columns(rules)
    return rollup.select("m0", "rep", mgr.alias("manager_name"), director.alias("director_name"))


def display_vertical(hr_vertical, primary_vertical):
    """Column: HR vertical label if present, else mapped book vertical."""
    hr = F.col(hr_vertical) if isinstance(hr_vertical, str) else hr_vertical
    pv = F.col(primary_vertical) if isinstance(primary_vertical, str) else primary_vertical
    hr_label = lookup(F.upper(hr), HR_VERTICAL_LABELS, title_case(hr))
    book_label = lookup(pv, BOOK_VERTICAL_LABELS, F.coalesce(pv, F.lit("Unknown")))
    return F.when(hr.isNotNull(), hr_label).otherwise(book_label)
