"""Small helpers shared by the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a maximal run of characters other than these: tab to carriage return, and space.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(col, UPPER, LOWER)


def n_words(text: Column) -> Column:
    """Number of words of a text (null: 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text (null: 0)."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")
