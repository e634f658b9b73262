"""Count source-table scans in a physical plan (bench diagnostics only).

A persisted relation appears under every operator that reads it but is
computed once, so each cached plan is visited once (by cache identity).
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame


def table_scans(df: DataFrame) -> dict[str, int]:
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    ident = jvm.java.lang.System.identityHashCode
    prev = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # static plan: every scan is a node
    try:
        root = df._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", prev)
    counts: Counter = Counter()
    seen: set[int] = set()
    stack = [root]
    while stack:
        node = stack.pop()
        kind = node.getClass().getSimpleName()
        if kind == "FileSourceScanExec":
            paths = node.relation().location().rootPaths()
            name = str(paths.head().getName()) if paths.nonEmpty() else "?"
            counts[name.removesuffix(".parquet")] += 1
        elif kind == "AdaptiveSparkPlanExec":  # cached with adaptive execution on
            stack.append(node.inputPlan())
        elif kind == "InMemoryTableScanExec":
            builder = node.relation().cacheBuilder()
            key = ident(builder)
            if key not in seen:
                seen.add(key)
                stack.append(builder.cachedPlan())
        if kind == "ReusedExchangeExec":  # output of an exchange computed elsewhere
            continue
        subs = node.subqueries()
        for i in range(subs.size()):
            stack.append(subs.apply(i))
        children = node.children()
        for i in range(children.size()):
            stack.append(children.apply(i))
    return dict(counts)


def _walk(root, spark):
    ident = spark.sparkContext._jvm.java.lang.System.identityHashCode
    seen: set[int] = set()
    stack = [root]
    while stack:
        node = stack.pop()
        yield node
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            stack.append(node.inputPlan())
        elif kind == "InMemoryTableScanExec":
            b = node.relation().cacheBuilder()
            if ident(b) not in seen:
                seen.add(ident(b))
                stack.append(b.cachedPlan())
        if kind == "ReusedExchangeExec":
            continue
        subs = node.subqueries()
        for i in range(subs.size()):
            stack.append(subs.apply(i))
        ch = node.children()
        for i in range(ch.size()):
            stack.append(ch.apply(i))


def join_report(df: DataFrame) -> dict:
    """Join strategies of the static plan; for each nested-loop join, whether
    its broadcast (build) side reads any table file."""
    spark = df.sparkSession
    prev = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        root = df._jdf.queryExecution().executedPlan()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", prev)
    out: Counter = Counter()
    build_reads_files = []
    for node in _walk(root, spark):
        kind = node.getClass().getSimpleName()
        if kind in ("SortMergeJoinExec", "BroadcastHashJoinExec", "ShuffledHashJoinExec",
                    "BroadcastNestedLoopJoinExec", "CartesianProductExec"):
            out[kind] += 1
        if kind == "BroadcastNestedLoopJoinExec":
            side = node.right() if "Right" in node.buildSide().toString() else node.left()
            build_reads_files.append(any(
                n.getClass().getSimpleName() == "FileSourceScanExec" for n in _walk(side, spark)))
    return {"joins": dict(out), "nested_loop_build_reads_files": build_reads_files}
