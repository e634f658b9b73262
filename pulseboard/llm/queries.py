"""Registry of the training-data queries and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    decontaminate, fill_middle, html_text, license_scan, line_dedup, quality, sharding, simhash, source_mix, token_count, url_filter,
    vector_code, vector_dedup,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": quality.query,
    "op2_virtual_slots": sharding.query,
    "op3_license_scan": license_scan.query,
    "op4_simhash_bktree": simhash.query,
    "op5_token_counts": token_count.query,
    "op6_url_filter": url_filter.query,
    "op7_source_mix": source_mix.query,
    "op8_decontaminate": decontaminate.query,
    "op9_html_text": html_text.query,
    "op10_line_dedup": line_dedup.query,
    "op11_fill_middle": fill_middle.query,
    "op12_vector_codes": vector_code.query,
    "op13_embedding_dedup": vector_dedup.query,
}

#: The others rest on hashes, trees, merges or a parser that DuckDB has no form for; tests/llm holds brute-force versions.
ORACLES: dict[str, str] = {
    "op6_url_filter": url_filter.ORACLE,
    "op10_line_dedup": line_dedup.ORACLE,
    "op11_fill_middle": fill_middle.ORACLE,
}
