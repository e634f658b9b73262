"""Sources read by table name give the same metrics as the fixture path."""

import datetime as dt

from pulseboard.config import fixture_rules
from pulseboard.functions.dates import Anchors
from pulseboard.plans import hub as H
from pulseboard.plans.job import MetricsJob
from pulseboard.sources import load_fixture_sources, load_table_sources

from .conftest import SF001


def test_table_sources_match_fixture_sources(spark):
    fx = load_fixture_sources(spark, SF001)
    views = {"roster": fx.roster, "actions": fx.actions, "calls_a": fx.calls_a, "calls_b": fx.calls_b,
             "book": fx.book, "accounts": fx.accounts, "contracts": fx.contracts, "cases": fx.cases,
             "tasks": fx.tasks, "signals": fx.signals, "snaps": fx.snapshots}
    views.update({f"scores_{i + 1}": s for i, s in enumerate(fx.scores)})
    names = {}
    for k, df in views.items():
        df.createOrReplaceTempView(f"pb_{k}")
        names[k] = f"pb_{k}"
    tb = load_table_sources(spark, names, snapshots="pb_snaps")
    a = Anchors.of(dt.date(1998, 6, 16))
    got = sorted(map(tuple, H.hub(MetricsJob(tb, fixture_rules(), a)).collect()))
    want = sorted(map(tuple, H.hub(MetricsJob(fx, fixture_rules(), a)).collect()))
    assert got == want and len(got) > 0


def test_check_sources_reports_missing_columns(spark):
    import pytest

    from pulseboard.sources.catalog import check_sources

    fx = load_fixture_sources(spark, SF001)
    check_sources(fx)
    broken = fx.__class__(**{**fx.__dict__, "actions": fx.actions.drop("closed_at"), "tasks": fx.tasks.drop("slug")})
    with pytest.raises(ValueError, match="actions: missing closed_at; tasks: missing slug"):
        check_sources(broken)


def test_columns_of_a_catalog_table(spark):
    import tempfile

    from pulseboard.plans import history as HS

    spark.sql("DROP TABLE IF EXISTS pb_old_snapshots")
    rows = spark.createDataFrame([("1998-06-16", "a", 0.5)], "snapshot_date string, REP string, composite_score double")
    rows.selectExpr("cast(snapshot_date as date) as snapshot_date", "REP", "composite_score").write.option(
        "path", tempfile.mkdtemp(prefix="pb-table-") + "/t").saveAsTable("pb_old_snapshots")
    try:
        names = [n for n, _ in HS.SNAPSHOT_SPEC]
        missing = HS.check_table_columns(spark, "pb_old_snapshots", names)
        assert missing == [n for n in names if n not in ("snapshot_date", "rep", "composite_score")]
        assert HS.ensure_table_columns(spark, "pb_old_snapshots") == missing
        assert HS.ensure_table_columns(spark, "pb_old_snapshots") == []
        row = spark.table("pb_old_snapshots").first()
        assert row.composite_score == 0.5 and row.daily_ar_count is None
        HS.conform(spark.table("pb_old_snapshots")).write.insertInto("pb_old_snapshots")  # takes rows in the new form
        assert spark.table("pb_old_snapshots").count() == 2
    finally:
        spark.sql("DROP TABLE pb_old_snapshots")
