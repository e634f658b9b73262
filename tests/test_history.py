"""History jobs: partition replace, upsert semantics, refresh, and the
multi-anchor job agreeing with one-anchor jobs."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from pulseboard.config import fixture_rules
from pulseboard.functions.dates import Anchors
from pulseboard.operators import touches as T
from pulseboard.plans import history as HS
from pulseboard.plans import hub as H
from pulseboard.plans.job import MetricsJob
from pulseboard.sources import load_fixture_sources

from .conftest import SF001

D1, D2 = dt.date(1998, 6, 15), dt.date(1998, 6, 16)


@pytest.fixture()
def folder():
    return tempfile.mkdtemp(prefix="pb-hist-")


def _rows(spark, date, reps, score):
    return spark.createDataFrame([(date, r, score) for r in reps], "snapshot_date date, rep string, composite_score double")


def test_check_and_ensure_columns(spark):
    df = spark.createDataFrame([(D1, "a")], "snapshot_date date, rep string")
    assert "composite_score" in HS.check_columns(df, HS.SNAPSHOT_COLUMNS)
    out = HS.conform(df)
    assert out.columns == HS.SNAPSHOT_COLUMNS
    assert dict(out.dtypes)["avg_call_score"] == "decimal(38,0)"
    assert HS.check_columns(out, ["RET_SLA_DONE"]) == []


def test_replace_touches_only_its_dates(spark, folder):
    path = os.path.join(folder, "snaps")
    HS.snapshot_replace(_rows(spark, D1, ["a", "b"], 0.1).unionByName(_rows(spark, D2, ["a"], 0.2)), path)
    HS.snapshot_replace(_rows(spark, D2, ["c", "d", "e"], 0.3), path)
    got = {(r.snapshot_date, r.rep) for r in spark.read.parquet(path).collect()}
    assert got == {(D1, "a"), (D1, "b"), (D2, "c"), (D2, "d"), (D2, "e")}


def test_upsert_updates_listed_columns_only(spark, folder):
    path = os.path.join(folder, "snaps")
    base = HS.conform(_rows(spark, D1, ["a", "b"], 0.1).unionByName(_rows(spark, D2, ["a"], 0.2))
                      .withColumn("ars_per_day", F.lit(1.5)))
    HS.snapshot_replace(base, path)
    upd = spark.createDataFrame([(D1, "a", None, 7), (D1, "zz", 0.9, 9)],
                                "snapshot_date date, rep string, composite_score double, ret_sla_done long")
    matched = HS.snapshot_upsert(spark, path, upd, ["composite_score", "ret_sla_done"], [D1])
    assert matched == 1
    got = {(r.snapshot_date, r.rep): r for r in spark.read.parquet(path).collect()}
    assert set(got) == {(D1, "a"), (D1, "b"), (D2, "a")}            # nothing inserted
    assert got[(D1, "a")].composite_score is None                    # null overwrites
    assert got[(D1, "a")].ret_sla_done == 7 and got[(D1, "a")].ars_per_day == 1.5
    assert got[(D1, "b")].composite_score == 0.1 and got[(D2, "a")].composite_score == 0.2
    dup = upd.unionByName(upd)
    with pytest.raises(ValueError):
        HS.snapshot_upsert(spark, path, dup, ["composite_score"], [D1])


def test_refresh_twice_keeps_one_snapshot_per_rep(spark, folder):
    src = load_fixture_sources(spark, SF001)
    rules = fixture_rules()
    hub_path, snap_path = os.path.join(folder, "hub"), os.path.join(folder, "snaps")
    first = HS.refresh(spark, src, rules, D2, hub_path, snap_path)
    n = first.count()
    assert n > 0 and "last_refreshed_at" in first.columns
    HS.refresh(spark, src, rules, D2, hub_path, snap_path)   # second run: stores the rebuilt hub
    snaps = spark.read.parquet(snap_path)
    assert snaps.where(F.col("snapshot_date") == D2).count() == n
    assert spark.read.parquet(hub_path).where(F.col("anchor") == D2).count() == n
    out = os.path.join(folder, "json")
    HS.export_hub_json(spark.read.parquet(hub_path), out)
    assert spark.read.json(out).count() == n


def test_history_jobs_write_path(spark, folder):
    src = load_fixture_sources(spark, SF001)
    rules = fixture_rules()
    path = os.path.join(folder, "snaps")
    HS.snapshot_replace(src.snapshots, path)
    before = spark.read.parquet(path).count()
    start, end = dt.date(1998, 6, 10), dt.date(1998, 6, 12)
    assert HS.enrich_counts(spark, src, rules, start, end, path) > 0
    assert HS.recompute_scores(spark, src, rules, start, end, path) > 0
    assert HS.recompute_renewals(spark, src, rules, start, end, path) > 0
    assert HS.backfill_daily(spark, src, rules, path) > 0
    after = spark.read.parquet(path)
    assert after.count() == before
    assert after.where(F.col("daily_ar_count").isNull()).count() == 0
    HS.backfill_snapshots(spark, src, rules, start, end, path)
    assert spark.read.parquet(path).where(F.col("snapshot_date").between(start, end)).count() > 0


def test_multi_anchor_equals_single_anchor(spark):
    src = load_fixture_sources(spark, SF001)
    rules = fixture_rules()
    days = [dt.date(1998, 6, 10) + dt.timedelta(days=i) for i in range(7)]
    multi = H.hub(MetricsJob(src, rules, Anchors.of(*days)))
    for d in (days[0], days[-1]):
        one = H.hub(MetricsJob(src, rules, Anchors.of(d)))
        a = sorted(map(tuple, multi.where(F.col("anchor") == d).collect()))
        b = sorted(map(tuple, one.collect()))
        assert a == b
    m = T.touch_rate_from_days(MetricsJob(src, rules, Anchors.of(*days)).rep_days, Anchors.of(*days))
    for d in days:
        j = MetricsJob(src, rules, Anchors.of(d))
        assert sorted(map(tuple, m.where(F.col("anchor") == d).collect())) == sorted(
            map(tuple, T.touch_rate(j.base, j.anchors).collect()))


def test_cli_jobs(spark, folder, capsys):
    from pulseboard.__main__ import main

    hub, snaps = os.path.join(folder, "hub"), os.path.join(folder, "snaps")
    common = ["--fixtures", SF001, "--snapshots", snaps]
    main(["refresh", "--anchor", "1998-06-15", "--hub", hub] + common)
    main(["refresh", "--anchor", "1998-06-16", "--hub", hub] + common)   # stores the 06-15 build as 06-16
    main(["backfill", "--start", "1998-06-10", "--end", "1998-06-12"] + common)
    main(["backfill-daily"] + common)
    main(["coverage-report"] + common)
    out = capsys.readouterr().out
    assert "1998-06-10" in out and "1998-06-16" in out
    s = spark.read.parquet(snaps)
    assert s.where(F.col("daily_ar_count").isNull()).count() == 0
    assert {r[0] for r in s.select("snapshot_date").distinct().collect()} == {
        dt.date(1998, 6, 10), dt.date(1998, 6, 11), dt.date(1998, 6, 12), dt.date(1998, 6, 16)}


def test_backfill_clears_dates_without_rows(spark, folder):
    from .helpers import make_sources, rep_row

    path = os.path.join(folder, "snaps")
    old = spark.createDataFrame([(dt.date(1998, 6, d), "a", 0.5) for d in (9, 10, 11, 12)],
                                "snapshot_date date, rep string, composite_score double")
    HS.snapshot_replace(old, path)
    quiet = make_sources(spark, roster=[rep_row(1, "a")])      # no activity at all: no rows to insert
    HS.backfill_snapshots(spark, quiet, fixture_rules(), dt.date(1998, 6, 10), dt.date(1998, 6, 11), path)
    left = sorted(r[0].day for r in spark.read.parquet(path).select("snapshot_date").collect())
    assert left == [9, 12]


def test_snapshots_with_older_partitions(spark, folder):
    path = os.path.join(folder, "snaps")
    old = spark.createDataFrame([(D1, "a", 0.4)], "snapshot_date date, rep string, composite_score double")
    old.write.partitionBy("snapshot_date").parquet(path)                 # written before the new columns
    HS.snapshot_replace(_rows(spark, D2, ["b"], 0.5).withColumn("ret_sla_done", F.lit(3)), path)
    s = HS.read_snapshots(spark, path)
    got = {r.rep: (r.composite_score, r.ret_sla_done) for r in s.collect()}
    assert s.columns == HS.SNAPSHOT_COLUMNS and got == {"a": (0.4, None), "b": (0.5, 3)}
    assert HS.snapshot_upsert(spark, path, spark.createDataFrame([(D1, "a", 9)],
                              "snapshot_date date, rep string, ret_sla_done long"), ["ret_sla_done"], [D1]) == 1
    assert {r.rep: r.ret_sla_done for r in HS.read_snapshots(spark, path).collect()} == {"a": 9, "b": 3}


def test_replace_can_empty_a_date(spark, folder):
    path = os.path.join(folder, "snaps")
    HS.snapshot_replace(_rows(spark, D1, ["a"], 0.1).unionByName(_rows(spark, D2, ["a"], 0.2)), path)
    HS.snapshot_replace(_rows(spark, D1, [], 0.0), path, [D1])
    assert {r.snapshot_date for r in HS.read_snapshots(spark, path).collect()} == {D2}


def test_only_a_missing_table_counts_as_missing(spark, folder):
    assert not HS.exists(spark, os.path.join(folder, "nothing"))
    os.makedirs(os.path.join(folder, "empty"))
    assert not HS.exists(spark, os.path.join(folder, "empty"))
    broken = os.path.join(folder, "broken")
    os.makedirs(broken)
    with open(os.path.join(broken, "part-0.parquet"), "wb") as f:
        f.write(b"not a parquet file")
    with pytest.raises(Exception) as e:
        HS.exists(spark, broken)
    assert "PATH_NOT_FOUND" not in str(e.value)


def test_files_per_date_are_bounded(spark, folder):
    path = os.path.join(folder, "snaps")
    days = [dt.date(1998, 6, 1) + dt.timedelta(days=k) for k in range(10)]
    rows = spark.createDataFrame([(d, f"r{k}", 0.5) for d in days for k in range(40)],
                                 "snapshot_date date, rep string, composite_score double").repartition(16)
    HS.snapshot_replace(rows, path)
    for d in days:
        files = [f for f in os.listdir(os.path.join(path, f"snapshot_date={d}")) if f.endswith(".parquet")]
        assert len(files) <= HS.FILES_PER_DATE
    assert HS.read_snapshots(spark, path).count() == 400


def test_long_ranges_run_in_chunks(spark, folder, monkeypatch):
    src, rules = load_fixture_sources(spark, SF001), fixture_rules()
    whole, parts = os.path.join(folder, "whole"), os.path.join(folder, "parts")
    start, end = dt.date(1998, 6, 8), dt.date(1998, 6, 12)
    HS.backfill_snapshots(spark, src, rules, start, end, whole)
    monkeypatch.setattr(HS, "CHUNK_DAYS", 2)
    HS.backfill_snapshots(spark, src, rules, start, end, parts)
    a, b = (sorted(map(str, HS.read_snapshots(spark, p).collect())) for p in (whole, parts))
    assert a == b and len(a) > 0


def test_coverage_report_prints_every_date(spark, folder, capsys):
    from pulseboard.__main__ import main

    path = os.path.join(folder, "snaps")
    days = [dt.date(1995, 1, 1) + dt.timedelta(days=k) for k in range(1200)]
    spark.createDataFrame([(d, "a", 0.5) for d in days], "snapshot_date date, rep string, composite_score double").write.parquet(path)
    main(["coverage-report", "--snapshots", path, "--fixtures", SF001])
    assert sum(line.startswith("199") for line in capsys.readouterr().out.splitlines()) == 1200


def test_a_shared_folder_is_needed_off_local_masters(monkeypatch):
    from types import SimpleNamespace

    from pulseboard.session import ensure_checkpoint_dir

    conf = SimpleNamespace(get=lambda *_: None)
    cluster = SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(cluster)
