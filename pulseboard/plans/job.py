"""``MetricsJob``: one set of sources, rules and anchor dates.

Holds the shared intermediates of a run (allowlist, touch base, outreach
keys) so every metric is derived from the same DataFrames; Spark plans the
whole job lazily. The few relations many metrics read (the touch counts
per (rep, org, day), the anchor-month book, the per-(rep, day) call
partials) are persisted per job so each big source is scanned once;
``release()`` unpersists them.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Rules
from ..functions.dates import Anchors, add_months_py
from ..operators import calls as C
from ..operators import renewal as RN
from ..operators import roster as R
from ..operators import sla as SL
from ..operators import touches as T
from ..operators.common import ts_bounds
from ..operators.partials import Partials
from ..sources import Sources
from .touch_state import TouchState


class MetricsJob:
    def __init__(self, src: Sources, rules: Rules, anchors: Anchors, variant: str = "current",
                 dedupe: bool = False, every_rep: bool = False, touch_state: TouchState | None = None):
        """``variant`` picks the allowlist form: "current" (full columns, UNION
        ALL with exceptions), "names" (DISTINCT names + exceptions, recompute
        scripts) or "legacy" (DISTINCT names, no exceptions, older backfills).
        ``dedupe`` lists a name once where the source counts it per listing.
        ``every_rep``: the job also needs touches of reps outside the allowlist
        (always so for "legacy"), so one reduction of all reps serves both.
        ``touch_state``: touch counts kept between runs; the job brings its days up
        to date on first use and reads them instead of reducing the sources."""
        if variant not in ("current", "names", "legacy"):
            raise ValueError(variant)
        self.variant = variant
        self.dedupe = dedupe
        self.touch_state = touch_state
        self.every_rep = every_rep or variant == "legacy" or touch_state is not None
        self.src = src
        self.rules = rules
        self.anchors = anchors
        self.spark = src.roster.sparkSession
        self._persisted: list[DataFrame] = []

    # ---- bounds -------------------------------------------------------
    @property
    def touch_lo(self) -> dt.date:
        """Earliest day any windowed touch metric needs (renewal look-back)."""
        first_m1 = add_months_py(self.anchors.lo, 1)
        r = self.rules
        window = max(r.touch_window_days, r.sla_window_days, r.churn_window_days)
        return min(first_m1 - dt.timedelta(days=r.renewal_lookback_days), self.anchors.lo - dt.timedelta(days=window))

    @property
    def daily_touch_days(self) -> DataFrame:
        """Touch counts of every rep for the daily columns of the anchors; the job's
        window holds the day before each and the days its deadlines look back to."""
        return self.all_touch_days

    @property
    def touch_hi(self) -> dt.date:
        return self.anchors.hi  # exclusive: touches end the day before the anchor

    # ---- allowlists ---------------------------------------------------
    @cached_property
    def allow(self) -> DataFrame:
        if self.variant == "names":
            return self.allow_names
        if self.variant == "legacy":
            return self.allow_legacy
        return self._keep(R.rep_allowlist(self.src.roster, self.rules, dedupe=self.dedupe))

    def _keep(self, df: DataFrame) -> DataFrame:
        """Persist a small relation many metrics of the job read."""
        df = df.persist()
        self._persisted.append(df)
        return df

    @cached_property
    def allow_legacy(self) -> DataFrame:
        """Older scripts: DISTINCT names, no exceptions arm."""
        return self._keep(R.rep_allowlist(self.src.roster, self.rules, with_exceptions=False,
                                          distinct_rule_arm=True, name_only=True, dedupe=self.dedupe))

    @cached_property
    def allow_names(self) -> DataFrame:
        """Recompute scripts: DISTINCT names of the rule, plus exceptions."""
        return self._keep(R.rep_allowlist(self.src.roster, self.rules, distinct_rule_arm=True, name_only=True,
                                          dedupe=self.dedupe))

    # ---- touches ------------------------------------------------------
    @cached_property
    def base(self) -> DataFrame:
        """Allowlisted touches over the widest window the job needs."""
        return T.touch_base(self.src, self.allow, self.rules, self.touch_lo, self.touch_hi)

    @cached_property
    def touches_all(self) -> DataFrame:
        """Touches of every rep (older renewal definitions do not allowlist)."""
        return T.touch_sources(self.src, self.rules, self.touch_lo, self.touch_hi)

    @cached_property
    def touch_days(self) -> DataFrame:
        """The touch base reduced to (rep, org, day) counts, computed once per
        job (persisted: each source is scanned once however many metrics
        read it; a lost block is recomputed from its lineage).

        Jobs that also need every rep's touches join the reduction of all reps
        with the allowlist names (bag join: a name listed
        k times carries k copies of its counts, as the row-level join would)."""
        if self.every_rep:
            return self.all_touch_days.join(self.allow.select("rep"), "rep")
        return self._keep(T.touch_days(self.base))

    @cached_property
    def all_touch_days(self) -> DataFrame:
        """(rep, org, day) counts over every rep's touches (persisted)."""
        if self.touch_state is not None:
            self.touch_state.update(self.src, self.rules, self.touch_lo, self.touch_hi)
            return self._keep(self.touch_state.read(self.src, self.rules, self.touch_lo, self.touch_hi))
        return self._keep(T.touch_days(self.touches_all))

    @cached_property
    def rep_days(self) -> DataFrame:
        return T.rep_days(self.touch_days)

    @cached_property
    def outreach_keys(self) -> DataFrame:
        """Distinct (org, day) with any allowlisted outreach."""
        return self.touch_days.where(F.col("org").isNotNull()).select("org", "day").distinct()

    @cached_property
    def renewal_keys(self) -> DataFrame:
        """Distinct (org, day) of qualifying allowlisted touches."""
        td = self.touch_days
        return td.where(F.col("org").isNotNull() & ((F.col("n_act") > 0) | (F.col("n_long") > 0))).select(
            "org", "day").distinct()

    @cached_property
    def call_days(self) -> DataFrame:
        """Per (rep, day) call-score partials over the longest call window."""
        r = self.rules
        days = r.backfill_call_window_days if self.variant == "legacy" else max(r.call_window_days, r.call_history_days)
        lo = self.anchors.lo - dt.timedelta(days=days)
        df = C.daily_partials(self.src, self.allow, lo, self.anchors.hi).persist()
        self._persisted.append(df)
        return df

    @cached_property
    def retention_rows(self) -> DataFrame:
        """Retention cases created in the job's widest window (read once)."""
        cases = self.src.cases.where(ts_bounds(
            "created_at", self.anchors.lo - dt.timedelta(days=self.rules.sla_window_days),
            self.anchors.hi + dt.timedelta(days=1)))
        return self._keep(SL.retention_case_rows(cases, self.allow))

    @cached_property
    def churn_rows(self) -> DataFrame:
        """Churn-risk tasks inserted in the job's widest window (read once)."""
        tasks = self.src.tasks.where(ts_bounds(
            "inserted_at", self.anchors.lo - dt.timedelta(days=self.rules.churn_window_days),
            self.anchors.hi + dt.timedelta(days=1)))
        return self._keep(SL.churn_task_rows(tasks, self.allow, self.rules))

    def cohort(self, mode: str = "current") -> DataFrame:
        """Renewal cohort of the anchors' months (persisted: coverage reads it twice)."""
        cache = self.__dict__.setdefault("_cohorts", {})
        if mode not in cache:
            cache[mode] = self._keep(RN.cohort_months(self.src, self.allow, self.anchors, mode))
        return cache[mode]

    def coverage(self, mode: str = "current") -> DataFrame:
        """Renewal coverage of a cohort form; the legacy one matches on org and rep."""
        keys, on = (self.renewal_keys_by_rep, ("org", "rep")) if mode == "legacy" else (self.renewal_keys, ("org",))
        return RN.renewal_coverage(self.cohort(mode), keys, self.anchors, on, self.rules.renewal_lookback_days)

    # ---- mergeable metrics of the current definitions -----------------
    def touch_partials(self) -> Partials:
        return T.touch_rate_partials(self.rep_days, self.anchors, self.rules.touch_window_days)

    def call_partials(self) -> Partials:
        return C.call_partials(self.call_days, self.anchors, self.rules.call_window_days)

    def call_prev_partials(self) -> Partials:
        return C.call_prev_partials(self.call_days, self.anchors, self.rules.call_window_days, self.rules.call_history_days)

    def retention_partials(self) -> Partials:
        return SL.retention_partials(self.src.cases, self.allow, self.outreach_keys, self.anchors,
                                     days=self.rules.sla_window_days, rows=self.retention_rows)

    def churn_partials(self) -> Partials:
        return SL.churn_partials(self.src.tasks, self.allow, self.outreach_keys, self.anchors, self.rules,
                                 self.rules.churn_window_days, rows=self.churn_rows)

    def renewal_partials(self) -> Partials:
        counts = RN.coverage_counts(self.cohort(), self.renewal_keys, lookback=self.rules.renewal_lookback_days)
        return RN.renewal_partials(counts, self.anchors)

    @cached_property
    def book_current(self) -> DataFrame:
        """Book rows of each anchor month (persisted: read by several rollups)."""
        df = R.book_current(self.src.book, self.src.accounts, self.src.roster, self.allow, self.anchors).persist()
        self._persisted.append(df)
        return df

    @cached_property
    def renewal_keys_by_rep(self) -> DataFrame:
        """Distinct (org, rep, day) of qualifying touches of any rep."""
        td = self.all_touch_days
        return td.where(F.col("org").isNotNull() & ((F.col("n_act") > 0) | (F.col("n_long") > 0))).select(
            "org", "rep", "day").distinct()

    def release(self) -> None:
        for df in self._persisted:
            df.unpersist()
        self._persisted.clear()

