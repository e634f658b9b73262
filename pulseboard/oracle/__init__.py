"""DuckDB reference SQL for every registered query (the correctness gate).

The SQL here is a brute-force, set-at-a-time restatement of each metric
(range joins against an ``anchors`` relation); the Spark operators use
different, scale-oriented plans, so agreement is a real check.
"""

from .fixtures_sql import FIXTURE_CTES


def with_ctes(ctes: list[tuple[str, str]], select: str) -> str:
    body = ",\n".join(f"{name} as ({sql.strip()})" for name, sql in ctes)
    return f"with {body}\n{select.strip()}"


__all__ = ["FIXTURE_CTES", "with_ctes"]
