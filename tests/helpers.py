"""Hand-made source tables for edge-case tests (schemas of FIXTURES.md A)."""

import datetime as dt

from pulseboard.sources import Sources

SCHEMAS = {
    "roster": "user_id long, user_name string, email string, title string, role_name string, is_active boolean, "
              "working_location string, is_offshore boolean, hr_vertical string",
    "actions": "action_id long, rep string, org long, record_type string, status string, closed_at timestamp_ntz",
    "calls_a": "call_id long, rep string, org long, status string, minutes double, start_at timestamp_ntz",
    "calls_b": "call_id long, rep string, org long, seconds double, inserted_at timestamp_ntz",
    "book": "org long, month date, owner string, mrr double, vertical string, segment string, dealer_type string, "
            "has_ai boolean, contract_end date, location_count int, contract_type string",
    "accounts": "org long, owner_id long, manager_name string",
    "contracts": "org long, status string, end_date date",
    "cases": "case_id long, org long, owner string, owner_id long, created_by_id long, record_type string, "
             "created_at timestamp_ntz, is_closed boolean",
    "scores": "rep string, conv_date date, quality string, score double, sub_1 double, sub_2 double, "
              "sub_3 double, sub_4 double",
    "tasks": "task_id long, org long, owner string, slug string, inserted_at timestamp_ntz, is_archived boolean",
    "signals": "rep string, org long, analysis_date date, is_latest boolean, risk_score double, risk_level string, "
               "cancel_intent boolean, sentiment double",
    "snapshots": "snapshot_date date, rep string, composite_score double",
}


def rep_row(uid, name, title="CSM", role="Rep", active=True, loc=None, hr=None):
    return (uid, name, f"{name}@x", title, role, active, loc, None, hr)


def ts(d: dt.date, h: int = 0) -> dt.datetime:
    return dt.datetime(d.year, d.month, d.day, h)


def make_sources(spark, **tables) -> Sources:
    def df(name, key=None):
        return spark.createDataFrame(tables.get(key or name, []), SCHEMAS[name])

    scores = tables.get("scores", [])
    return Sources(
        roster=df("roster"), actions=df("actions"), calls_a=df("calls_a"), calls_b=df("calls_b"),
        book=df("book"), accounts=df("accounts"), contracts=df("contracts"), cases=df("cases"),
        scores=(spark.createDataFrame(scores, SCHEMAS["scores"]),) + tuple(
            spark.createDataFrame([], SCHEMAS["scores"]) for _ in range(3)),
        tasks=df("tasks"), signals=df("signals"), snapshots=df("snapshots"),
    )
