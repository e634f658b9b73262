"""Numeric helpers shared by every operator."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c, scale: int) -> Column:
    """Round a double half away from zero at ``scale`` digits.

    The value passes through DECIMAL(38,12) first so binary noise of the
    double (0.285 stored as 0.28499999...) does not decide the rounding.
    """
    return F.round(_c(c).cast("decimal(38,12)"), scale).cast("double")


def safe_ratio(num, den, scale: int) -> Column:
    """round(num / den) with den = 0 -> null (ANSI mode would raise)."""
    n, d = _c(num).cast("double"), _c(den).cast("double")
    return round_half_up(F.when(d != 0, n / d), scale)


def exact_sum(c) -> Column:
    """Order-independent sum of a double column (exact in decimal)."""
    return F.sum(_c(c).cast("decimal(38,9)")).cast("double")


def flag(cond: Column) -> Column:
    """1 when ``cond`` is true, else 0 (null -> 0)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))
