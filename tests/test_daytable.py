"""The versioned day table: writers stopped at any step, two writers, adopted folders, summaries."""

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from pulseboard.plans import history as HS
from pulseboard.sources.daytable import ConcurrentWrite
from pulseboard.sources.files import Files

DAYS = [dt.date(1998, 6, d) for d in (14, 15, 16)]
SCHEMA = "snapshot_date date, rep string, composite_score double, ars_per_day double, daily_ar_count long"


class Lost(BaseException):
    """The driver is gone: nothing after this runs, no handler either."""


@pytest.fixture()
def path():
    return os.path.join(tempfile.mkdtemp(prefix="pb-day-"), "snaps")


def frame(spark, days, score, reps=("a", "b"), count=1):
    return spark.createDataFrame([(d, r, score, score * 2, count) for d in days for r in reps], SCHEMA)


def content(spark, path):
    rows = HS.read_snapshots(spark, path).select("snapshot_date", "rep", "composite_score", "ret_sla_done").collect()
    return sorted((r[0].day, r[1], r[2], r[3]) for r in rows)


def fresh(spark, path):
    HS.snapshot_replace(frame(spark, DAYS, 0.1), path)


def upsert(spark, path):
    updates = spark.createDataFrame([(d, "a", 9) for d in DAYS[1:]], "snapshot_date date, rep string, ret_sla_done long")
    return HS.snapshot_upsert(spark, path, updates, ["ret_sla_done"], DAYS[1:])


WRITERS = {
    "replace and empty": lambda spark, path: HS.snapshot_replace(frame(spark, DAYS[:1], 0.7, ("c",)), path, DAYS[:2]),
    "upsert": upsert,
}


@pytest.mark.parametrize("writer", WRITERS)
def test_a_writer_lost_at_any_step(spark, path, writer, monkeypatch):
    """Each file operation of the write is the one that is not reached in turn."""
    write, steps = WRITERS[writer], {"n": 0, "stop": None}
    real = {name: getattr(Files, name) for name in ("move", "publish", "delete")}

    def step(name):
        def run(self, *args):
            steps["n"] += 1
            if steps["n"] == steps["stop"]:
                raise Lost
            return real[name](self, *args)
        return run

    def reset():
        steps.update(n=0, stop=None)
        HS.snapshot_replace(frame(spark, DAYS, 0.1, ("a",)), path, DAYS)

    reset()
    old = content(spark, path)
    write(spark, path)
    new = content(spark, path)
    assert old != new
    for name in real:
        monkeypatch.setattr(Files, name, step(name))
    seen = []
    while True:  # ends when a write gets through
        reset()
        steps.update(n=0, stop=len(seen) + 1)
        try:
            write(spark, path)
            break
        except Lost:
            steps.update(stop=None)
            now = content(spark, path)
            assert now in (old, new), seen
            seen.append(now == new)
            write(spark, path)
            assert content(spark, path) == new  # a rerun heals it
    assert not seen[0] and seen[-1] and seen == sorted(seen) and len(seen) > 4  # old up to the publication, new from there on
    steps.update(stop=None)
    table = HS.snapshot_table(spark, path)
    assert table.vacuum() > 0 and table.vacuum() == 0 and content(spark, path) == new
    assert spark.read.parquet(path).count() == len(new)  # and the folder as such holds no other rows


def test_a_lost_data_write_changes_nothing(spark, path):
    fresh(spark, path)
    old = content(spark, path)
    bad = frame(spark, DAYS[1:], 0.5).withColumn("composite_score", F.raise_error(F.lit("executor lost")).cast("double"))
    with pytest.raises(Exception, match="executor lost"):
        HS.snapshot_replace(bad, path)
    assert content(spark, path) == old and spark.read.parquet(path).count() == len(old)


def test_two_writers(spark, path):
    fresh(spark, path)
    table = HS.snapshot_table(spark, path)
    base = table.version()
    mine = table.stage(HS.conform(frame(spark, DAYS[:1], 0.5)))
    HS.snapshot_replace(frame(spark, DAYS[2:], 0.9), path)  # another day: both count
    table.publish(mine, base=base)
    assert {(d, s) for d, _, s, _ in content(spark, path)} == {(14, 0.5), (15, 0.1), (16, 0.9)}
    base = table.version()
    mine = table.stage(HS.conform(frame(spark, DAYS[:1], 0.6)))
    HS.snapshot_replace(frame(spark, DAYS[:1], 0.7), path)
    with pytest.raises(ConcurrentWrite):
        table.publish(mine, base=base)
    assert {(d, s) for d, _, s, _ in content(spark, path)} == {(14, 0.7), (15, 0.1), (16, 0.9)}


def test_a_version_number_is_given_once(spark, path):
    fresh(spark, path)
    files = HS.snapshot_table(spark, path).files
    assert not files.publish("_log/000000000001.json", "{}")
    assert files.names("_log") == ["000000000001.json"]


def test_older_versions_can_be_kept(spark, path, monkeypatch):
    monkeypatch.setattr(HS, "KEEP_VERSIONS", 2)
    fresh(spark, path)
    before = HS.snapshot_table(spark, path).version()
    reader = HS.read_snapshots(spark, path, version=before)
    HS.snapshot_replace(frame(spark, DAYS[1:], 0.5), path)
    assert {r.composite_score for r in reader.collect()} == {0.1}
    assert {s for _, _, s, _ in content(spark, path)} == {0.1, 0.5}


def test_summary_follows_every_writer(spark, path):
    def same():
        stored = HS.stored_coverage_report(spark, path).collect(), HS.stored_missing_dates(spark, path).collect()
        snaps = HS.read_snapshots(spark, path)
        assert stored == (HS.coverage_report(snaps).collect(), HS.missing_dates(snaps).collect())
        return [r[0].day for r in stored[1]]

    frame(spark, DAYS[:1], 0.3, count=None).write.partitionBy("snapshot_date").parquet(path)  # a folder from before the log
    assert same() == [14]
    HS.snapshot_replace(frame(spark, DAYS[1:], 0.2, count=None), path)
    assert same() == [14, 15, 16]
    filled = spark.createDataFrame([(DAYS[1], r, 4) for r in "ab"], "snapshot_date date, rep string, daily_ar_count long")
    HS.snapshot_upsert(spark, path, filled, ["daily_ar_count"], [DAYS[1]])
    assert same() == [14, 16]
    HS.snapshot_replace(frame(spark, [], 0.0), path, DAYS[2:])
    assert same() == [14]


def test_questions_about_days_read_no_rows(spark, path):
    fresh(spark, path)
    for folder in os.listdir(path):  # the rows are gone, the log is there
        if folder.startswith("snapshot_date="):
            for f in os.listdir(os.path.join(path, folder)):
                os.remove(os.path.join(path, folder, f))
    assert HS.stored_missing_dates(spark, path).collect() == []
    assert [r.reps for r in HS.stored_coverage_report(spark, path).collect()] == [2, 2, 2]


def test_latest_hub_reads_one_build(spark, path):
    rows = spark.createDataFrame([(d, "a", float(d.day)) for d in DAYS], "anchor date, rep string, composite_score double")
    HS.hub_table(spark, path).replace(rows)
    got = HS.latest_hub(spark, path, DAYS[1])
    assert [r.composite_score for r in got.collect()] == [15.0] and len(got.inputFiles()) == 1
    assert HS.latest_hub(spark, path, dt.date(1990, 1, 1)).collect() == []


def test_rows_without_a_day(spark, path):
    HS.snapshot_replace(frame(spark, [None, DAYS[0]], 0.1), path)
    assert sorted(str(r[0]) for r in HS.read_snapshots(spark, path).select("snapshot_date").distinct().collect()) == ["1998-06-14", "None"]
