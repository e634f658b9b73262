"""Write the derived fixture tables once, then read them like source tables.

The fixture sources are views over TPC-H-style tables (lineitem x orders x
supplier joins). A real deployment reads source *tables*; re-deriving the
views inside every metric would repeat those joins many times per job. So
the views are written once per session to the shared folder the session
names in ``spark.checkpoint.dir`` (a written table cuts the lineage, and a
lost executor only recomputes its own write tasks), each sorted by its
event time so Parquet row-group statistics can skip data for date windows.
"""

from __future__ import annotations

import hashlib
import inspect
import os
import uuid

from pyspark.sql import SparkSession

from ..session import ensure_checkpoint_dir
from .catalog import Sources
from .fixtures import load_fixture_sources

_SORT = {
    "actions": "closed_at", "calls_a": "start_at", "calls_b": "inserted_at", "cases": "created_at",
    "tasks": "inserted_at", "book": "month", "signals": "analysis_date", "snapshots": "snapshot_date",
    "scores_1": "conv_date", "scores_2": "conv_date", "scores_3": "conv_date", "scores_4": "conv_date",
}
_MEMO: dict[tuple, tuple[SparkSession, Sources]] = {}


def _readable(spark: SparkSession, path: str) -> bool:
    """True only for a completed write (the committer's _SUCCESS marker)."""
    try:
        spark.read.text(f"{path}/_SUCCESS")
        return True
    except Exception:  # noqa: BLE001 - missing or unfinished output
        return False


INPUTS = ("region", "nation", "customer", "supplier", "orders", "lineitem", "events")


def _tag(sf_dir: str) -> str:
    """Folder key: input path and file stats plus the derivation's own source,
    so changed inputs or a changed derivation never reuse stale tables. Where
    the stats cannot be read (remote storage) nothing is reused."""
    from . import fixtures

    h = hashlib.sha1(sf_dir.encode())
    h.update(inspect.getsource(fixtures).encode())
    for name in INPUTS:
        try:
            st = os.stat(f"{sf_dir}/{name}.parquet")
            h.update(f"{name}:{st.st_size}:{st.st_mtime_ns}".encode())
        except OSError:
            h.update(uuid.uuid4().bytes)
    return h.hexdigest()[:16]


def fixture_sources(spark: SparkSession, sf_dir: str) -> Sources:
    """``load_fixture_sources`` backed by tables written once per folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    key = (sf_dir, root, id(spark))
    hit = _MEMO.get(key)
    if hit is not None and hit[0] is spark and spark.sparkContext._jsc is not None:
        return hit[1]
    tag = _tag(sf_dir)
    base = f"{root}/fixtures-{tag}"
    names = ["roster", "actions", "calls_a", "calls_b", "book", "accounts", "contracts", "cases",
             "scores_1", "scores_2", "scores_3", "scores_4", "tasks", "signals", "snapshots"]
    missing = [n for n in names if not _readable(spark, f"{base}/{n}")]
    if missing:  # derive (and write) only what is not there yet
        lazy = load_fixture_sources(spark, sf_dir)
        views = {"roster": lazy.roster, "actions": lazy.actions, "calls_a": lazy.calls_a, "calls_b": lazy.calls_b,
                 "book": lazy.book, "accounts": lazy.accounts, "contracts": lazy.contracts, "cases": lazy.cases,
                 "tasks": lazy.tasks, "signals": lazy.signals, "snapshots": lazy.snapshots}
        views.update({f"scores_{i + 1}": df for i, df in enumerate(lazy.scores)})
        for n in missing:
            out = views[n].sortWithinPartitions(_SORT[n]) if n in _SORT else views[n]
            out.write.mode("overwrite").parquet(f"{base}/{n}")
    t = {n: spark.read.parquet(f"{base}/{n}") for n in names}
    src = Sources(
        roster=t["roster"], actions=t["actions"], calls_a=t["calls_a"], calls_b=t["calls_b"], book=t["book"],
        accounts=t["accounts"], contracts=t["contracts"], cases=t["cases"],
        scores=tuple(t[f"scores_{i}"] for i in (1, 2, 3, 4)), tasks=t["tasks"], signals=t["signals"],
        snapshots=t["snapshots"],
    )
    _MEMO[key] = (spark, src)
    return src
