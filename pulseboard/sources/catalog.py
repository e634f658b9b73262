"""The ``Sources`` mapping handed to every operator, and table loaders."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Sources:
    roster: DataFrame
    actions: DataFrame
    calls_a: DataFrame
    calls_b: DataFrame
    book: DataFrame
    accounts: DataFrame
    contracts: DataFrame
    cases: DataFrame
    scores: tuple[DataFrame, ...]
    tasks: DataFrame
    signals: DataFrame
    snapshots: DataFrame | None = None

    def with_snapshots(self, snapshots: DataFrame) -> "Sources":
        return replace(self, snapshots=snapshots)


REQUIRED_COLUMNS: dict[str, tuple[str, ...]] = {
    "roster": ("user_id", "user_name", "email", "title", "role_name", "is_active", "working_location",
               "is_offshore", "hr_vertical"),
    "actions": ("action_id", "rep", "org", "record_type", "status", "closed_at"),
    "calls_a": ("call_id", "rep", "org", "status", "minutes", "start_at"),
    "calls_b": ("call_id", "rep", "org", "seconds", "inserted_at"),
    "book": ("org", "month", "owner", "mrr", "vertical", "segment", "dealer_type", "has_ai", "contract_end",
             "location_count", "contract_type"),
    "accounts": ("org", "owner_id", "manager_name"),
    "contracts": ("org", "status", "end_date"),
    "cases": ("case_id", "org", "owner", "owner_id", "created_by_id", "record_type", "created_at", "is_closed"),
    "scores": ("rep", "conv_date", "quality", "score", "sub_1", "sub_2", "sub_3", "sub_4"),
    "tasks": ("task_id", "org", "owner", "slug", "inserted_at", "is_archived"),
    "signals": ("rep", "analysis_date", "is_latest", "risk_score", "risk_level", "cancel_intent", "sentiment"),
}


def check_sources(src: "Sources") -> None:
    """Raise with every missing column of every source table (schema only, no job)."""
    problems = []
    for name, cols in REQUIRED_COLUMNS.items():
        frames = src.scores if name == "scores" else (getattr(src, name),)
        for i, df in enumerate(frames):
            have = {c.lower() for c in df.columns}
            missing = [c for c in cols if c.lower() not in have]
            if missing:
                label = f"scores_{i + 1}" if name == "scores" else name
                problems.append(f"{label}: missing {', '.join(missing)}")
    if problems:
        raise ValueError("source tables do not match the expected columns: " + "; ".join(problems))


SOURCE_TABLES = (
    "roster", "actions", "calls_a", "calls_b", "book", "accounts", "contracts", "cases",
    "scores_1", "scores_2", "scores_3", "scores_4", "tasks", "signals",
)


def load_table_sources(spark: SparkSession, names: dict[str, str] | None = None,
                       snapshots: str | None = None) -> Sources:
    """Read the 14 source tables by catalog name (or ``parquet.`path``` form).

    ``names`` maps the canonical name to a table identifier; missing entries
    default to the canonical name itself.
    """
    names = names or {}
    t = lambda n: spark.table(names.get(n, n))
    src = Sources(
        roster=t("roster"), actions=t("actions"), calls_a=t("calls_a"), calls_b=t("calls_b"),
        book=t("book"), accounts=t("accounts"), contracts=t("contracts"), cases=t("cases"),
        scores=tuple(t(f"scores_{i}") for i in (1, 2, 3, 4)), tasks=t("tasks"), signals=t("signals"),
        snapshots=spark.table(snapshots) if snapshots else None,
    )
    check_sources(src)
    return src
