"""String helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import TITLE_CASE_DELIMITERS


def title_case(c) -> Column:
    """Upper-case the first letter of each word, lower-case the rest.

    Words break at blanks *and* punctuation (``home-decor`` -> ``Home-Decor``),
    which Spark's ``initcap`` does not do. Runs JVM-side over the characters.
    """
    col = F.col(c) if isinstance(c, str) else c
    chars = F.split(F.lower(col), "")
    delims = F.lit(TITLE_CASE_DELIMITERS)

    def one(ch, i):
        prev = F.when(i > 0, F.element_at(chars, i))  # element_at is 1-based: i == previous char
        starts = (i == 0) | (F.instr(delims, prev) > 0)
        return F.when(starts, F.upper(ch)).otherwise(ch)

    return F.when(col.isNull(), F.lit(None)).otherwise(F.array_join(F.transform(chars, one), ""))


def ilike_any(c, patterns) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    out = None
    for p in patterns:
        term = col.ilike(p)
        out = term if out is None else (out | term)
    return out
