"""Snapshot history jobs: set-based over a table of anchor dates.

The source scripts loop over days (one query + one MERGE per day). Here every
job computes all requested days in one Spark job (metrics keyed by
(anchor, rep)) and then rewrites only the touched days. Plain Parquet has no
row-level MERGE or DELETE, so an upsert joins the stored rows of the days with
the updates and writes those days anew; ``sources.daytable`` publishes all days
of a job as one version, so a job that is lost changes nothing and one that
ends is seen whole. A day's summary is kept with the version, so the coverage
report and the list of days to fill read no rows.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import Rules
from ..functions.dates import Anchors
from ..functions.numeric import round_half_up
from ..operators import calls as C
from ..operators import daily as D
from ..operators import renewal as RN
from ..operators import roster as R
from ..operators import score as S
from ..operators import sla as SL
from ..operators import touches as TC
from ..operators.common import per_anchor
from ..session import written
from ..sources import Sources
from ..sources.daytable import FILES_PER_DAY, Day, DayTable, Version
from . import hub as H
from .job import MetricsJob
from .touch_state import TouchState

L, D_, S_ = T.LongType(), T.DoubleType(), T.StringType()
SNAPSHOT_SPEC: list[tuple[str, T.DataType]] = [
    ("snapshot_date", T.DateType()), ("rep", S_), ("composite_score", D_),
    ("ars_per_day", D_), ("avg_call_score", T.DecimalType(38, 0)), ("ret_sla_pct", D_),
    ("renewal_coverage_pct", D_), ("overall_status", S_),
    ("renewal_m1_pct", D_), ("renewal_m2_pct", D_), ("renewal_m3_pct", D_),
    ("high_risk_org_count", L), ("cancellation_intent_count", L),
    ("ret_sla_done", L), ("ret_sla_total", L),
    ("renewal_m1_called", L), ("renewal_m1_total", L), ("renewal_m2_called", L), ("renewal_m2_total", L),
    ("renewal_m3_called", L), ("renewal_m3_total", L),
    ("renewal_m1_m2m", L), ("renewal_m1_m2m_called", L), ("renewal_m2_m2m", L), ("renewal_m2_m2m_called", L),
    ("renewal_m3_m2m", L), ("renewal_m3_m2m_called", L),
    ("daily_ar_count", L), ("daily_active", L), ("daily_call_score_sum", D_), ("daily_call_count", L),
    ("daily_ret_created", L), ("daily_ret_met", L),
]
SNAPSHOT_COLUMNS = [n for n, _ in SNAPSHOT_SPEC]
SNAPSHOT_SCHEMA = T.StructType([T.StructField(n, t) for n, t in SNAPSHOT_SPEC])
KEY = ["snapshot_date", "rep"]
#: Dates that one history job takes at a time.
CHUNK_DAYS = 366
#: Files that a date's rows are spread over when written.
FILES_PER_DATE = FILES_PER_DAY
#: What the snapshot table keeps of each date beside its rows.
SNAPSHOT_SUMMARY = {
    "missing": "count_if(daily_ar_count is null)",
    "rates": "count(ars_per_day)",
    "rate_sum": "sum(ars_per_day)",
}
#: Versions whose files are kept; more than one lets long reads of an older version end.
KEEP_VERSIONS = 1


# ---------------------------------------------------------------- schema
def check_columns(df: DataFrame, cols) -> list[str]:
    """Columns of ``cols`` missing from ``df`` (case-insensitive), in order."""
    have = {c.lower() for c in df.columns}
    return [c for c in cols if c.lower() not in have]


def ensure_columns(df: DataFrame, spec=SNAPSHOT_SPEC) -> DataFrame:
    """Add the missing columns of ``spec`` as typed nulls; existing ones stay."""
    for name in check_columns(df, [n for n, _ in spec]):
        df = df.withColumn(name, F.lit(None).cast(dict(spec)[name]))
    return df


def check_table_columns(spark: SparkSession, table: str, cols) -> list[str]:
    """Columns of ``cols`` missing from a catalog table (case-insensitive), in order."""
    have = {c.name.lower() for c in spark.catalog.listColumns(table)}
    return [c for c in cols if c.lower() not in have]


def ensure_table_columns(spark: SparkSession, table: str, spec=SNAPSHOT_SPEC) -> list[str]:
    """ALTER TABLE ADD COLUMNS for the missing columns of ``spec``; returns them. Stored rows
    read as null there, nothing is rewritten; a second run finds nothing to add."""
    types, missing = dict(spec), check_table_columns(spark, table, [n for n, _ in spec])
    if missing:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'`{n}` {types[n].simpleString()}' for n in missing)})")
    return missing


def conform(df: DataFrame, spec=SNAPSHOT_SPEC) -> DataFrame:
    """Exactly the ``spec`` columns, in order, cast to their stored types
    (the average call score column has scale 0, so it is rounded on store)."""
    df = ensure_columns(df, spec)
    return df.select(*[F.col(n).cast(t).alias(n) for n, t in spec])


# ---------------------------------------------------------------- storage
def snapshot_table(spark: SparkSession, path: str) -> DayTable:
    return DayTable(spark, path, "snapshot_date", "rep", SNAPSHOT_SUMMARY, KEEP_VERSIONS)


def hub_table(spark: SparkSession, path: str) -> DayTable:
    return DayTable(spark, path, "anchor", "rep", keep=KEEP_VERSIONS)


def read_snapshots(spark: SparkSession, path: str, dates=None, version: Version | None = None) -> DataFrame:
    """The snapshot table (all of it, or the given dates) with the full column set: read with the known
    schema, so columns added after a partition was written come back as typed nulls."""
    return conform(snapshot_table(spark, path).read(SNAPSHOT_SCHEMA, dates, version))


def write_partitions(df: DataFrame, path: str, partition_col: str = "snapshot_date", key: str = "rep") -> None:
    """Replace exactly the days present in ``df``, in a few files per day whatever the number of tasks."""
    table = snapshot_table(df.sparkSession, path) if partition_col == "snapshot_date" else DayTable(
        df.sparkSession, path, partition_col, key, keep=KEEP_VERSIONS)
    table.replace(df)


def snapshot_replace(rows: DataFrame, path: str, dates=None) -> None:
    """Delete-then-insert of whole snapshot dates: ``dates`` (default: those present
    in ``rows``) are replaced, every other date is left as it is. A date of
    ``dates`` without rows is emptied."""
    snapshot_table(rows.sparkSession, path).replace(conform(rows), dates)


def merge_updates(current: DataFrame, updates: DataFrame, cols) -> DataFrame:
    """MERGE ... WHEN MATCHED UPDATE as a DataFrame: rows of ``current`` matched
    on (snapshot_date, rep) take the listed columns from ``updates`` (nulls
    included); unmatched update rows are ignored; nothing is inserted."""
    cols = list(cols)
    u = updates.select(*KEY, *[F.col(c).alias(f"_u_{c}") for c in cols]).withColumn("_matched", F.lit(True))
    j = current.join(u, KEY, "left")
    types = dict(SNAPSHOT_SPEC)
    out = []
    for c in current.columns:
        if c in cols:
            new = F.col(f"_u_{c}").cast(types.get(c, current.schema[c].dataType))
            out.append(F.when(F.col("_matched"), new).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out, F.coalesce(F.col("_matched"), F.lit(False)).alias("_matched"))


def assert_unique_keys(updates: DataFrame) -> None:
    dup = updates.groupBy(*KEY).count().where(F.col("count") > 1).limit(1).count()
    if dup:
        raise ValueError("updates hold the same (snapshot_date, rep) twice")


def _stage_upsert(table: DayTable, base: Version | None, updates: DataFrame, cols, dates) -> tuple[dict[str, Day], int]:
    """Write the merged rows of ``dates``, unpublished; returns them and the number of matched rows."""
    updates = written(updates.select(*KEY, *cols), "updates")  # one narrow row per key: computed once, used three times
    assert_unique_keys(updates)
    current = conform(table.read(SNAPSHOT_SCHEMA, dates, base))
    matched = current.select(*KEY).join(updates.select(*KEY), KEY, "left_semi").count()
    return table.stage(conform(merge_updates(current, updates, cols).drop("_matched"))), matched


def snapshot_upsert(spark: SparkSession, path: str, updates: DataFrame, cols, dates) -> int:
    """Apply ``merge_updates`` to the stored rows of ``dates``; returns the number of matched rows."""
    table = snapshot_table(spark, path)
    base = table.version()
    staged, matched = _stage_upsert(table, base, updates, list(cols), dates)
    table.publish(staged, base=base)
    return matched


# ---------------------------------------------------------------- hub -> snapshot
def snapshot_from_hub(hub_df: DataFrame, snapshot_date: dt.date | None = None) -> DataFrame:
    """Snapshot columns of hub rows (before the daily columns)."""
    date = F.lit(snapshot_date) if snapshot_date else F.col("anchor")
    cols = [
        date.alias("snapshot_date"), F.col("rep"), F.col("composite_score"), F.col("ars_per_day"),
        F.col("avg_call_score"), F.col("ret_sla_pct"), F.col("renewal_coverage_pct"), F.col("overall_status"),
        F.col("renewal_m1_pct"), F.col("renewal_m2_pct"), F.col("renewal_m3_pct"),
        F.col("high_risk_org_count"), F.col("cancellation_intent_count"),
        F.col("sla_met_count").alias("ret_sla_done"), F.col("total_ret_cases").alias("ret_sla_total"),
    ]
    for k in (1, 2, 3):
        cols += [F.col(f"renewal_m{k}_called"), F.col(f"renewal_m{k}_total"),
                 F.col(f"renewal_m{k}_m2m"), F.col(f"renewal_m{k}_m2m_called")]
    return hub_df.select(*cols)


def refresh_rows(src: Sources, rules: Rules, anchor: dt.date, hub_df: DataFrame,
                 job: MetricsJob | None = None) -> DataFrame:
    """Step 1 of ``refresh``: the given hub rows as the snapshot of ``anchor``,
    with the daily columns of the day before."""
    job = job or MetricsJob(src, rules, Anchors.of(anchor), every_rep=True)
    base = snapshot_from_hub(hub_df, anchor)
    touch_days = job.daily_touch_days if job.every_rep else None
    return conform(D.daily_columns(base, src, job.allow, rules, days=[anchor], touch_days=touch_days))


def latest_hub(spark: SparkSession, hub_path: str, anchor: dt.date) -> DataFrame:
    """Hub rows of the most recent build on or before ``anchor``; only that build's files are read."""
    table = hub_table(spark, hub_path)
    version = table.version()
    builds = [d for d in version.days if d <= anchor.isoformat()] if version else []
    return table.read(None, [max(builds)] if builds else [], version)


def refresh(spark: SparkSession, src: Sources, rules: Rules, anchor, hub_path: str,
            snapshots_path: str, touches: TouchState | None = None) -> DataFrame:
    """Daily refresh. (1) replace the snapshot of ``anchor`` with the hub as it
    stands (the previous build: a second run on the same day stores that
    day's rebuild) plus yesterday's daily columns; (2) rebuild the hub.

    ``touches``: touch counts kept from run to run; only days that are new or
    changed are reduced from the sources again.

    The hub is stored by ``anchor``, so each build replaces only its own
    day and older builds stay readable. Each table changes in one step;
    a refresh lost between the two is completed by running it again."""
    from ..functions.dates import as_date

    anchor = as_date(anchor)
    hubs, snapshots = hub_table(spark, hub_path), snapshot_table(spark, snapshots_path)
    job = MetricsJob(src, rules, Anchors.of(anchor), every_rep=True, touch_state=touches)  # both steps read each source once
    try:
        if hubs.exists():
            prev = latest_hub(spark, hub_path, anchor).drop("anchor")
            snapshot_replace(refresh_rows(src, rules, anchor, prev, job), snapshots_path, [anchor])
        if snapshots.exists():
            job.src = src.with_snapshots(read_snapshots(spark, snapshots_path))
        hubs.replace(H.hub(job, include_refresh_time=True))
    finally:
        job.release()
    return hubs.read(days=[anchor])


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a snapshot table was written at ``path``."""
    return snapshot_table(spark, path).exists()


# ---------------------------------------------------------------- set-based jobs
def backfill_rows(src: Sources, rules: Rules, anchors: Anchors, job: MetricsJob | None = None) -> DataFrame:
    """Older full definition for every anchor at once: 30-day touch rate,
    90-day call score (before the anchor), open-rule SLA, month-start-owner
    segment, legacy renewal coverage (org + rep), as-of signal counts.
    Keeps reps with a touch rate, a call score or an SLA ratio."""
    job = job or MetricsJob(src, rules, anchors, "legacy")
    rate = TC.touch_rate_from_days(job.rep_days, anchors, rules.touch_window_days)
    cm = C.call_metrics(src, job.allow, anchors, days=rules.backfill_call_window_days, include_anchor_day=False, daily=job.call_days)
    sla = SL.retention_sla(src.cases, job.allow, job.outreach_keys, anchors, rule="open",
                           days=rules.sla_window_days, rows=job.retention_rows)
    seg = _at(job, R.owner_segment(src.book, job.allow, anchors))
    piv = RN.renewal_pivot(job.coverage("legacy"), anchors)
    ii = S.interaction_signals_asof(src.signals, anchors)
    k = ["anchor", "rep"]
    rows = (per_anchor(job.allow.select("rep"), anchors).join(rate, k, "left").join(cm, k, "left")
            .join(sla, k, "left").join(seg, k, "left").join(piv, k, "left").join(ii, k, "left"))
    counted = S.renewal_pillar_allowed("segment") & (F.coalesce(F.col("renewal_m2_total"), F.lit(0)) > 0)
    comp = S.composite_columns("ars_per_day", "segment", "call_score_norm", "ret_sla_pct", "renewal_m2_pct", counted)
    out = rows.select(
        F.col("anchor").alias("snapshot_date"), "rep", comp["composite_score"].alias("composite_score"),
        "ars_per_day", "avg_call_score", "ret_sla_pct", F.col("renewal_m2_pct").alias("renewal_coverage_pct"),
        S.score_band(comp["composite_score"]).alias("overall_status"),
        "renewal_m1_pct", "renewal_m2_pct", "renewal_m3_pct", "high_risk_org_count", "cancellation_intent_count",
    ).where(F.col("ars_per_day").isNotNull() | F.col("avg_call_score").isNotNull() | F.col("ret_sla_pct").isNotNull())
    return conform(out)


def _at(job: MetricsJob, df: DataFrame) -> DataFrame:
    return df.join(job.anchors.df(job.spark).select("anchor", "m0"), "m0").drop("m0")


def _stored(snapshots: DataFrame, anchors: Anchors) -> DataFrame:
    return conform(snapshots.where(F.col("snapshot_date").isin(*anchors.dates)))


ENRICH_COLS = ["ret_sla_done", "ret_sla_total"] + [f"renewal_m{k}_{f}" for k in (1, 2, 3) for f in ("called", "total")]


def enrich_updates(src: Sources, rules: Rules, anchors: Anchors, snapshots: DataFrame,
                   job: MetricsJob | None = None) -> DataFrame:
    """SLA done/total (open rule) and M1-M3 called/total (legacy cohort, org +
    rep match) for every stored row of the dates; absent -> 0."""
    job = job or MetricsJob(src, rules, anchors, "legacy")
    sla = SL.retention_sla(src.cases, job.allow, job.outreach_keys, anchors, rule="open",
                           days=rules.sla_window_days, rows=job.retention_rows)
    piv = RN.renewal_pivot(job.coverage("legacy"), anchors)
    rows = _stored(snapshots, anchors).select(*KEY).withColumn("anchor", F.col("snapshot_date"))
    j = rows.join(sla, ["anchor", "rep"], "left").join(piv, ["anchor", "rep"], "left")
    z = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    cols = [z("sla_met_count").alias("ret_sla_done"), z("total_ret_cases").alias("ret_sla_total")]
    cols += [z(f"renewal_m{k}_{f}").alias(f"renewal_m{k}_{f}") for k in (1, 2, 3) for f in ("called", "total")]
    return j.select(*KEY, *cols)


SCORE_COLS = ["avg_call_score", "ret_sla_pct", "ret_sla_done", "ret_sla_total", "composite_score", "overall_status"]


def recompute_score_updates(src: Sources, rules: Rules, anchors: Anchors, snapshots: DataFrame,
                            job: MetricsJob | None = None) -> DataFrame:
    """30-day call score (before the anchor), 2-business-day SLA, and the
    composite from the stored touch rate and stored M2 ratio (counted when
    the ratio is > 0)."""
    job = job or MetricsJob(src, rules, anchors, "names")
    cm = C.call_metrics(src, job.allow, anchors, days=rules.call_window_days, include_anchor_day=False, daily=job.call_days)
    sla = SL.retention_sla(src.cases, job.allow, job.outreach_keys, anchors, rule="deadline",
                           days=rules.sla_window_days, rows=job.retention_rows)
    seg = _at(job, R.owner_segment(src.book, job.allow, anchors))
    rows = _stored(snapshots, anchors).select(*KEY, F.col("ars_per_day").alias("_ars"),
                                              F.col("renewal_m2_pct").alias("_m2")).withColumn(
        "anchor", F.col("snapshot_date"))
    k = ["anchor", "rep"]
    j = rows.join(cm.select(*k, "avg_call_score", "call_score_norm"), k, "left").join(sla, k, "left").join(seg, k, "left")
    counted = S.renewal_pillar_allowed("segment") & (F.coalesce(F.col("_m2"), F.lit(0.0)) > 0)
    comp = S.composite_columns("_ars", "segment", "call_score_norm", "ret_sla_pct", "_m2", counted)["composite_score"]
    return j.select(*KEY, "avg_call_score", "ret_sla_pct",
                    F.coalesce("sla_met_count", F.lit(0)).cast("long").alias("ret_sla_done"),
                    F.coalesce("total_ret_cases", F.lit(0)).cast("long").alias("ret_sla_total"),
                    comp.alias("composite_score"), S.score_band(comp).alias("overall_status"))


RENEWAL_COLS = ([f"renewal_m{k}_{f}" for k in (1, 2, 3) for f in ("pct", "called", "total", "m2m", "m2m_called")]
                + ["renewal_coverage_pct", "composite_score", "overall_status"])


def recompute_renewal_updates(src: Sources, rules: Rules, anchors: Anchors, snapshots: DataFrame,
                              job: MetricsJob | None = None) -> DataFrame:
    """Current cohort rule without the existence test, org-matched coverage,
    and the composite from stored touch rate, call score / 100 and SLA."""
    job = job or MetricsJob(src, rules, anchors, "names")
    piv = RN.renewal_pivot(job.coverage("nocheck"), anchors)
    seg = _at(job, R.owner_segment(src.book, job.allow, anchors))
    rows = _stored(snapshots, anchors).select(
        *KEY, F.col("ars_per_day").alias("_ars"), (F.col("avg_call_score").cast("double") / 100.0).alias("_call"),
        F.col("ret_sla_pct").alias("_sla")).withColumn("anchor", F.col("snapshot_date"))
    k = ["anchor", "rep"]
    j = rows.join(piv, k, "left").join(seg, k, "left")
    counted = S.renewal_pillar_allowed("segment") & (F.coalesce(F.col("renewal_m2_total"), F.lit(0)) > 0)
    comp = S.composite_columns("_ars", "segment", "_call", "_sla", "renewal_m2_pct", counted)["composite_score"]
    z = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    cols = []
    for kk in (1, 2, 3):
        cols += [F.col(f"renewal_m{kk}_pct"), z(f"renewal_m{kk}_called"), z(f"renewal_m{kk}_total"),
                 z(f"renewal_m{kk}_m2m"), z(f"renewal_m{kk}_m2m_called")]
    return j.select(*KEY, *cols, F.col("renewal_m2_pct").alias("renewal_coverage_pct"),
                    comp.alias("composite_score"), S.score_band(comp).alias("overall_status"))


DAILY_COLS = list(D.DAILY_COLUMNS) + [f"renewal_m{k}_{f}" for k in (1, 2, 3) for f in ("m2m", "m2m_called")]


def missing_dates(snapshots: DataFrame) -> DataFrame:
    """Distinct snapshot dates with a null daily touch count, ordered."""
    return (snapshots.where(F.col("daily_ar_count").isNull()).select("snapshot_date").distinct()
            .orderBy("snapshot_date"))


def stored_missing_dates(spark: SparkSession, path: str) -> DataFrame:
    """``missing_dates`` of the stored table, from its log."""
    table = snapshot_table(spark, path)
    if table.version() is None:
        return missing_dates(read_snapshots(spark, path))
    dates = sorted(d for d, s in table.summaries().items() if s["missing"])
    return spark.createDataFrame([(dt.date.fromisoformat(d),) for d in dates], "snapshot_date date").orderBy("snapshot_date")


def stored_coverage_report(spark: SparkSession, path: str) -> DataFrame:
    """``coverage_report`` of the stored table, from its log."""
    table = snapshot_table(spark, path)
    if table.version() is None:
        return coverage_report(read_snapshots(spark, path))
    rows = [(dt.date.fromisoformat(d), s["rows"], s["rate_sum"], s["rates"]) for d, s in table.summaries().items()]
    days = spark.createDataFrame(rows, "snapshot_date date, reps long, rate_sum double, rates long")
    mean = F.when(F.col("rates") > 0, F.col("rate_sum") / F.col("rates"))
    return days.select("snapshot_date", "reps", round_half_up(mean, 2).alias("avg_ars_per_day")).orderBy("snapshot_date")


def backfill_daily_updates(src: Sources, rules: Rules, dates, snapshots: DataFrame,
                           job: MetricsJob | None = None) -> DataFrame:
    """For every stored row of each date: daily columns of the day before and
    legacy month-to-month counts (org + rep match)."""
    anchors = Anchors.of(*dates)
    job = job or MetricsJob(src, rules, anchors, "names")
    rows = _stored(snapshots, anchors).select(*KEY)
    daily = D.daily_columns(rows, src, job.allow, rules, days=list(anchors.dates), touch_days=job.daily_touch_days)
    piv = RN.renewal_pivot(job.coverage("legacy"), anchors).withColumnRenamed("anchor", "snapshot_date")
    j = daily.join(piv, KEY, "left")
    z = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    m2m = [z(f"renewal_m{k}_{f}") for k in (1, 2, 3) for f in ("m2m", "m2m_called")]
    return j.select(*KEY, *D.DAILY_COLUMNS, *m2m)


def coverage_report(snapshots: DataFrame) -> DataFrame:
    """Rows and mean touch rate (2 dp) per snapshot date, ordered."""
    return snapshots.groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("reps"), round_half_up(F.avg("ars_per_day"), 2).alias("avg_ars_per_day"),
    ).orderBy("snapshot_date")


# ---------------------------------------------------------------- job wrappers (write)
def backfill_snapshots(spark: SparkSession, src: Sources, rules: Rules, start, end, path: str,
                       touches: TouchState | None = None) -> None:
    """Replace the snapshots of [start, end] (delete the range, insert the
    recomputed rows) in one version: dates that produced no rows are emptied."""
    table, staged, dates = snapshot_table(spark, path), {}, Anchors.between(start, end).dates
    for a in _chunks(dates):
        job = MetricsJob(src, rules, a, "legacy", touch_state=touches)
        try:
            staged |= table.stage(conform(backfill_rows(src, rules, a, job)))
        finally:
            job.release()
    table.publish(staged, {str(d) for d in dates} - set(staged))


def _chunks(dates) -> list[Anchors]:
    """Long date lists are worked off a year at a time, so that one job's scans stay bounded."""
    return [Anchors.of(*dates[k:k + CHUNK_DAYS]) for k in range(0, len(dates), CHUNK_DAYS)]


def _upsert_job(spark, src, rules, dates, path, variant, build, cols, touches=None) -> int:
    """All dates of the job in one version, computed from the version that it started with."""
    table, staged, matched = snapshot_table(spark, path), {}, 0
    base = table.version()
    for a in _chunks(list(dates)):
        job = MetricsJob(src, rules, a, variant, touch_state=touches)
        try:
            snaps = read_snapshots(spark, path, a.dates, base)
            made, n = _stage_upsert(table, base, build(src, rules, a, snaps, job), cols, a.dates)
        finally:
            job.release()
        staged, matched = staged | made, matched + n
    table.publish(staged, base=base)
    return matched


def enrich_counts(spark, src, rules, start, end, path, touches=None) -> int:
    return _upsert_job(spark, src, rules, Anchors.between(start, end).dates, path, "legacy",
                       enrich_updates, ENRICH_COLS, touches)


def recompute_scores(spark, src, rules, start, end, path, touches=None) -> int:
    return _upsert_job(spark, src, rules, Anchors.between(start, end).dates, path, "names",
                       recompute_score_updates, SCORE_COLS, touches)


def recompute_renewals(spark, src, rules, start, end, path, touches=None) -> int:
    return _upsert_job(spark, src, rules, Anchors.between(start, end).dates, path, "names",
                       recompute_renewal_updates, RENEWAL_COLS, touches)


def backfill_daily(spark, src, rules, path, touches=None) -> int:
    # the list of dates is bounded by the calendar (one value per day)
    dates = [r[0] for r in stored_missing_dates(spark, path).collect()]
    if not dates:
        return 0

    def build(src_, rules_, a, stored, job):
        return backfill_daily_updates(src_, rules_, list(a.dates), conform(stored), job)

    return _upsert_job(spark, src, rules, dates, path, "names", build, DAILY_COLS, touches)


def export_hub_json(hub_df: DataFrame, path: str) -> None:
    """Dashboard export: hub rows as JSON lines (one file per task)."""
    hub_df.write.mode("overwrite").json(path)
