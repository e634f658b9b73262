"""Plan guards for every registered query: no Cartesian product, and every
nested-loop join broadcasts only the bounded anchor list (no table scan on
its build side)."""

import pytest

from pulseboard.queries import QUERIES

from .scans import join_report, table_scans

from .conftest import SF001


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_guards(spark, name):
    rep = join_report(QUERIES[name][0](spark, SF001))
    assert rep["joins"].get("CartesianProductExec", 0) == 0, rep
    assert not any(rep["nested_loop_build_reads_files"]), rep


@pytest.mark.parametrize("name", ["daily_columns", "backfill_daily", "refresh_snapshot", "hub", "hub_history"])
def test_touch_tables_are_read_once(spark, name):
    from pulseboard.queries import release_jobs

    release_jobs()
    scans = table_scans(QUERIES[name][0](spark, SF001))
    assert all(scans.get(t, 0) <= 1 for t in ("actions", "calls_a", "calls_b")), scans


@pytest.mark.parametrize("name", ["hub_history", "renewal_coverage", "renewal_coverage_legacy", "backfill_snapshots"])
def test_no_nested_loops_over_anchors(spark, name):
    assert join_report(QUERIES[name][0](spark, SF001))["joins"].get("BroadcastNestedLoopJoinExec", 0) == 0


def test_hub_brings_all_metrics_together_in_one_shuffle(spark):
    """Without broadcasts: from the result down to the union of the metrics' partials there are one shuffle and two joins
    (the reps with a book, the snapshots of a week ago), whose other sides shuffle once to meet it."""
    from pulseboard.queries import release_jobs

    release_jobs()
    keep = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        for k, v in zip(keep, ("-1", "false")):
            spark.conf.set(k, v)
        root = QUERIES["hub"][0](spark, SF001)._jdf.queryExecution().executedPlan()
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)

    def children(node):
        return [node.children().apply(i) for i in range(node.children().size())]

    def path(node):
        """Kinds of nodes from ``node`` down to the union of the metrics."""
        kind = node.getClass().getSimpleName()
        if kind == "UnionExec" and "_touch_n" in node.output().mkString() and "_ren3_total" in node.output().mkString():
            return [kind]
        return next(([kind, *p] for p in map(path, children(node)) if p), None)

    kinds = path(root)
    assert kinds is not None
    assert sum("ShuffleExchange" in k for k in kinds) == 1, kinds
    assert sum("Join" in k for k in kinds) == 2, kinds
