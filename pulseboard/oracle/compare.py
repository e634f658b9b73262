"""Compare a Spark result with a DuckDB query on the same Parquet tables.

Used by the tests: row count, column names and an order-insensitive hash
of the values (columns sorted by name) must all agree.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math

BASE_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def duckdb_connection(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 9)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 9)
    if isinstance(v, bool):
        return bool(v)
    if isinstance(v, int):
        return int(v)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    return str(v)


def rows_digest(columns: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def compare(df, con, sql: str) -> dict:
    """Return a dict with the three checks and a few sample differences."""
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    o_cols = [d[0] for d in cur.description]
    o_rows = cur.fetchall()
    res = {
        "rows_spark": len(s_rows),
        "rows_oracle": len(o_rows),
        "columns_match": sorted(s_cols) == sorted(o_cols),
    }
    res["hash_match"] = res["columns_match"] and rows_digest(s_cols, s_rows) == rows_digest(o_cols, o_rows)
    res["ok"] = res["rows_spark"] == res["rows_oracle"] and res["hash_match"]
    if not res["columns_match"]:
        res["only_spark"] = sorted(set(s_cols) - set(o_cols))
        res["only_oracle"] = sorted(set(o_cols) - set(s_cols))
    elif not res["ok"]:
        order_s = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
        order_o = sorted(range(len(o_cols)), key=lambda i: o_cols[i])
        a = {repr(tuple(_norm(r[i]) for i in order_s)) for r in s_rows}
        b = {repr(tuple(_norm(r[i]) for i in order_o)) for r in o_rows}
        res["cols"] = sorted(s_cols)
        res["spark_only_rows"] = sorted(a - b)[:5]
        res["oracle_only_rows"] = sorted(b - a)[:5]
    return res
