"""Canonical source tables derived from the driver's TPC-H-style Parquet.

The derivation is the one documented in FIXTURES.md section B, written with
DataFrame calls; the DuckDB form of the same views lives in
``pulseboard.oracle`` and must stay in step with this file. Everything is
lazy: nothing is read until an operator's result is acted on, so Catalyst
prunes the columns and pushes the filters each operator needs.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import Sources

SNAPSHOT_FIRST_DAY = dt.date(1998, 6, 3)
SNAPSHOT_DAYS = 14
SIGNAL_DAY_SHIFT = 9345  # 2024-01-01 -> 1998-06-01
DEALT_ROWS = 20_000  # rows in a task whose rows are then multiplied by months or days


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df`` (of about ``rows`` rows) in tasks of bounded size. Small files are read by few tasks whatever the
    number of their rows, and what a row is multiplied into would all be made, and sorted, in the task that read it."""
    return df.repartition(max(1, -(-rows // DEALT_ROWS)), *keys)


def load_fixture_sources(spark: SparkSession, sf_dir: str) -> Sources:
    rd = lambda n: _read(spark, sf_dir, n)
    supplier, customer, orders, lineitem = rd("supplier"), rd("customer"), rd("orders"), rd("lineitem")
    nation, region, events = rd("nation"), rd("region"), rd("events")
    # Number of suppliers: one number, computed once and inlined as a literal
    # (no cross join, and no scalar subquery inside relations a job persists).
    n_suppliers = supplier.count()
    k = F.lit(n_suppliers)
    sk = F.col("s_suppkey")

    roster = supplier.select(
        sk.alias("user_id"),
        F.col("s_name").alias("user_name"),
        F.concat(F.lower(F.regexp_replace("s_name", "#", ".")), F.lit("@example.com")).alias("email"),
        (sk % 20 != 19).alias("is_active"),
        F.when(sk % 10 == 9, "Account Executive")
        .when(sk % 4 == 0, "Senior Customer Success Manager")
        .when(sk % 4 == 1, "csm ii")
        .otherwise("CSM")
        .alias("title"),
        F.when(sk % 23 == 1, F.lit(None).cast("string"))
        .when(sk % 13 == 12, "Manager CS")
        .when(sk % 17 == 16, "VP CS")
        .otherwise("Rep")
        .alias("role_name"),
        F.when(sk % 11 == 10, "Sydney, Australia")
        .when(sk % 3 == 0, F.lit(None).cast("string"))
        .otherwise("Remote")
        .alias("working_location"),
        F.when(sk % 4 == 2, F.lit(None).cast("boolean")).otherwise(sk % 4 == 0).alias("is_offshore"),
        F.when(sk % 6 == 0, "MEDSPA")
        .when(sk % 6 == 1, "auto")
        .when(sk % 6 == 2, "home decor")
        .alias("hr_vertical"),
    )

    li, o = lineitem.alias("l"), orders.alias("o")
    touch = (
        li.join(o, F.col("l.l_orderkey") == F.col("o.o_orderkey"))
        .join(
            supplier.select("s_suppkey", "s_name"),
            F.col("s_suppkey")
            == F.when(F.col("l.l_linenumber") == 3, F.col("l.l_suppkey")).otherwise(F.col("o.o_custkey") % k),
        )
        .select(
            (F.col("l.l_orderkey") * 10 + F.col("l.l_linenumber")).alias("touch_id"),
            F.col("s_name").alias("rep"),
            F.when(F.col("l.l_orderkey") % 40 == 11, F.lit(None).cast("long"))
            .otherwise(F.col("o.o_custkey"))
            .alias("org"),
            F.col("l.l_returnflag").alias("channel"),
            F.col("l.l_linestatus").alias("st"),
            F.col("l.l_quantity").alias("qty"),
            (
                F.col("o.o_orderdate")
                + F.make_dt_interval(
                    days=(F.col("o.o_orderkey") % 6).cast("int"),
                    hours=(F.col("l.l_linenumber") * 3).cast("int"),
                )
            ).alias("ts"),
        )
    )
    actions = touch.where(F.col("channel") == "N").select(
        F.col("touch_id").alias("action_id"), "rep", "org",
        F.lit("REVIEW").alias("record_type"),
        F.when(F.col("st") == "F", "Closed").otherwise("Open").alias("status"),
        F.col("ts").alias("closed_at"),
    )
    calls_a = touch.where(F.col("channel") == "A").select(
        F.col("touch_id").alias("call_id"), "rep", "org",
        F.when(F.col("st") == "F", "COMPLETED").otherwise("missed").alias("status"),
        F.col("qty").alias("minutes"),
        F.col("ts").alias("start_at"),
    )
    calls_b = touch.where(F.col("channel") == "R").select(
        F.col("touch_id").alias("call_id"), "rep", "org",
        (F.col("qty") * 60).alias("seconds"),
        F.col("ts").alias("inserted_at"),
    )

    ck = F.col("c_custkey")
    contract_d = F.explode(F.when(ck % 10 == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    contract_end = F.add_months(F.lit(dt.date(1998, 6, 15)), ((ck + 2 * F.col("d")) % 7).cast("int"))
    months = F.explode(
        F.sequence(F.lit(dt.date(1998, 5, 1)), F.lit(dt.date(1998, 12, 1)), F.expr("interval 1 month"))
    )
    nat = nation.select("n_nationkey", "n_name", "n_regionkey")
    owned = (
        customer.select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
        .join(supplier.select("s_suppkey", "s_name"), F.col("s_suppkey") == ck % k)
        .join(nat, F.col("n_nationkey") == F.col("c_nationkey"))
        .join(region.select("r_regionkey", "r_name"), F.col("r_regionkey") == F.col("n_regionkey"))
    )
    book = (
        _dealt(owned, customer.count(), "c_custkey")
        .select("*", contract_d.alias("d"))
        .select("*", months.alias("month"))
        .where(~((ck % 9 == 8) & (F.col("month") < F.lit(dt.date(1998, 7, 1)))))
        .select(
            ck.alias("org"),
            F.col("month").cast("date").alias("month"),
            F.col("s_name").alias("owner"),
            F.col("c_acctbal").alias("mrr"),
            F.col("r_name").alias("vertical"),
            F.when(F.col("c_mktsegment") == "BUILDING", "Mid Market")
            .when(F.col("c_mktsegment") == "MACHINERY", "Phones")
            .when(F.col("c_mktsegment") == "FURNITURE", "Strategic")
            .when(F.col("c_mktsegment") == "HOUSEHOLD", "SMB")
            .alias("segment"),
            F.when(ck % 15 == 0, "Partner").otherwise("Other").alias("dealer_type"),
            (ck % 12 == 0).alias("has_ai"),
            contract_end.alias("contract_end"),
            (1 + ck % 5).cast("int").alias("location_count"),
            F.when(ck % 3 == 0, "Month-to-Month").when(ck % 3 == 1, "Annual").alias("contract_type"),
        )
    )

    accounts = (
        customer.select("c_custkey")
        .join(supplier.select("s_suppkey", "s_nationkey"), F.col("s_suppkey") == ck % k)
        .join(nat, F.col("n_nationkey") == F.col("s_nationkey"))
        .select(
            ck.alias("org"),
            ((ck + F.when(ck % 25 == 4, 1).otherwise(0)) % k).alias("owner_id"),
            F.col("n_name").alias("manager_name"),
        )
    )

    contracts = customer.select("c_custkey", contract_d.alias("d")).select(
        ck.alias("org"),
        F.when(ck % 8 == 5, "Expired").otherwise("Activated").alias("status"),
        contract_end.alias("end_date"),
    )

    ok = F.col("o_orderkey")
    sup_by_cust = supplier.select("s_suppkey", "s_name")
    orders_owned = orders.join(sup_by_cust, F.col("s_suppkey") == F.col("o_custkey") % k)
    cases = orders_owned.select(
        ok.alias("case_id"),
        F.when(ok % 50 == 7, F.lit(None).cast("long")).otherwise(F.col("o_custkey")).alias("org"),
        F.col("s_name").alias("owner"),
        F.col("s_suppkey").alias("owner_id"),
        F.when(ok % 5 == 0, F.lit(None).cast("long"))
        .when(ok % 5 == 1, F.col("s_suppkey"))
        .otherwise(F.lit(-1).cast("long"))
        .alias("created_by_id"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "Retention")
        .when(F.col("o_orderpriority") == "2-HIGH", "Onboarding A")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "Onboarding B")
        .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "Onboarding C")
        .otherwise("Other")
        .alias("record_type"),
        (F.col("o_orderdate") + F.make_dt_interval(hours=(ok % 24).cast("int"))).alias("created_at"),
        (F.col("o_orderstatus") == "F").alias("is_closed"),
    )

    scored = (
        lineitem
        .join(supplier.select("s_suppkey", "s_name"), F.col("s_suppkey") == F.col("l_suppkey"))
        .select(
            ((F.col("l_linenumber") - 1) % 4 + 1).alias("k"),
            F.col("s_name").alias("rep"),
            F.col("l_shipdate").cast("date").alias("conv_date"),
            F.when((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O"), "incomplete")
            .when(F.col("l_orderkey") % 30 == 0, F.lit(None).cast("string"))
            .otherwise("complete")
            .alias("quality"),
            (F.lit(50.0) + F.col("l_quantity")).alias("score"),
            (F.col("l_quantity") * 2).alias("sub_1"),
            (100 - F.col("l_quantity")).alias("sub_2"),
            (F.col("l_discount") * 1000).alias("sub_3"),
            (F.col("l_tax") * 1000).alias("sub_4"),
        )
    )
    scores = tuple(scored.where(F.col("k") == i).drop("k") for i in (1, 2, 3, 4))

    tasks = orders_owned.select(
        ok.alias("task_id"),
        F.col("o_custkey").alias("org"),
        F.col("s_name").alias("owner"),
        F.when(F.col("o_orderstatus") == "P", "churn_risk").otherwise("other").alias("slug"),
        F.col("o_orderdate").alias("inserted_at"),
        (ok % 4 == 0).alias("is_archived"),
    )

    # Latest row per org: max of (ts, event_id) by partial aggregation, then an
    # equi-join back (skew-safe, unlike a window over a hot org).
    latest = events.groupBy("user_id").agg(F.max(F.struct("ts", "event_id")).alias("mx"))
    signals = (
        events.join(latest, "user_id", "left")
        .join(supplier.select("s_suppkey", "s_name"), F.col("s_suppkey") == F.col("user_id") % k)
        .select(
            F.col("s_name").alias("rep"),
            F.col("user_id").alias("org"),
            F.date_sub(F.col("ts").cast("date"), SIGNAL_DAY_SHIFT).alias("analysis_date"),
            ((F.col("mx.ts") == F.col("ts")) & (F.col("mx.event_id") == F.col("event_id"))).alias("is_latest"),
            F.col("value").alias("risk_score"),
            F.when(F.col("value") > 200, "critical").when(F.col("value") > 100, "high").otherwise("low").alias(
                "risk_level"
            ),
            (F.col("event_type") == "error").alias("cancel_intent"),
            (F.col("value") / 500).alias("sentiment"),
        )
    )

    i = F.col("i")
    snapshots = (
        _dealt(supplier.select("s_suppkey", "s_name"), n_suppliers, "s_suppkey")
        .select("*", F.explode(F.sequence(F.lit(0), F.lit(SNAPSHOT_DAYS - 1))).alias("i"))
        .select(
            F.date_add(F.lit(SNAPSHOT_FIRST_DAY), i).alias("snapshot_date"),
            F.col("s_name").alias("rep"),
            ((sk * 7 + i * 3) % 101 / F.lit(100.0)).alias("composite_score"),
            ((sk + i) % 50 / F.lit(10.0)).alias("ars_per_day"),
            F.when(sk % 5 == 0, F.lit(None).cast("decimal(38,0)"))
            .otherwise((50 + (sk + i) % 50).cast("decimal(38,0)"))
            .alias("avg_call_score"),
            F.when(sk % 4 == 0, F.lit(None).cast("double")).otherwise((sk + i) % 11 / F.lit(10.0)).alias(
                "ret_sla_pct"
            ),
            F.when(sk % 3 == 0, F.lit(None).cast("double")).otherwise((sk + i) % 6 / F.lit(5.0)).alias(
                "renewal_m2_pct"
            ),
            F.when(i % 3 == 0, F.lit(None).cast("long")).otherwise((sk + i) % 7).alias("daily_ar_count"),
        )
    )

    return Sources(
        roster=roster, actions=actions, calls_a=calls_a, calls_b=calls_b, book=book,
        accounts=accounts, contracts=contracts, cases=cases, scores=scores, tasks=tasks,
        signals=signals, snapshots=snapshots,
    )
