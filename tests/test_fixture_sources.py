"""The derivation of the source tables spreads what it multiplies."""

from pyspark.sql import functions as F

from pulseboard.sources.fixtures import load_fixture_sources

CUSTOMERS, SUPPLIERS = 50_000, 45_000


def _tables(spark, root):
    n = F.col("id")
    tables = {
        "customer": spark.range(CUSTOMERS).selectExpr(
            "id as c_custkey", "cast(0 as int) as c_nationkey", "1.5D as c_acctbal", "'BUILDING' as c_mktsegment"),
        "supplier": spark.range(SUPPLIERS).select(
            n.alias("s_suppkey"), F.concat(F.lit("Supplier#"), n).alias("s_name"), F.lit(0).alias("s_nationkey")),
        "nation": spark.sql("select 0 as n_nationkey, 'N' as n_name, 0 as n_regionkey"),
        "region": spark.sql("select 0 as r_regionkey, 'R' as r_name"),
        "orders": spark.createDataFrame([], "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
                                            "o_orderdate timestamp_ntz, o_orderpriority string"),
        "lineitem": spark.createDataFrame([], "l_orderkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, "
                                              "l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
        "events": spark.createDataFrame([], "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"),
    }
    for name, df in tables.items():
        df.coalesce(1).write.parquet(f"{root}/{name}.parquet")


def test_rows_are_dealt_before_they_are_multiplied(spark, tmp_path):
    _tables(spark, tmp_path)
    src = load_fixture_sources(spark, str(tmp_path))
    doubled = len(range(3, CUSTOMERS, 10))  # customers of two contracts
    new = sum(1 + (c % 10 == 3) for c in range(8, CUSTOMERS, 9))  # contracts that lack the first two of eight months
    for df, rows in ((src.book, 8 * (CUSTOMERS + doubled) - 2 * new), (src.snapshots, 14 * SUPPLIERS)):
        tasks = [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(tasks) == rows
        assert max(tasks) < rows / 2  # each file is read by one task
