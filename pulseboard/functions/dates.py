"""Date helpers as Column expressions, plus the ``Anchors`` value.

``Anchors`` is the set of "as of" dates one job computes, one small row per
calendar day. Joins with it carry no broadcast hint: Spark knows its size and
chooses.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SLA_OFFSET_BY_WEEKDAY

def as_date(d) -> dt.date:
    if isinstance(d, dt.datetime):
        return d.date()
    if isinstance(d, dt.date):
        return d
    return dt.date.fromisoformat(str(d))


def add_months_py(d: dt.date, k: int) -> dt.date:
    """First day of the month ``k`` months after ``d``'s month."""
    m = d.year * 12 + (d.month - 1) + k
    return dt.date(m // 12, m % 12 + 1, 1)


@dataclass(frozen=True)
class Anchors:
    dates: tuple[dt.date, ...]

    @classmethod
    def of(cls, *dates) -> "Anchors":
        ds = tuple(sorted({as_date(d) for d in dates}))
        if not ds:
            raise ValueError("at least one anchor date is required")
        return cls(ds)

    @classmethod
    def between(cls, start, end) -> "Anchors":
        s, e = as_date(start), as_date(end)
        return cls.of(*(s + dt.timedelta(days=i) for i in range((e - s).days + 1)))

    @classmethod
    def from_iter(cls, dates: Iterable) -> "Anchors":
        return cls.of(*list(dates))

    @property
    def lo(self) -> dt.date:
        return self.dates[0]

    @property
    def hi(self) -> dt.date:
        return self.dates[-1]

    def months(self, *ks: int) -> list[dt.date]:
        """Distinct first-of-month dates k months after the anchors' months
        (k = 0: the anchors' own months); literals for scan pushdown."""
        return sorted({add_months_py(d, k) for d in self.dates for k in ks})

    def df(self, spark: SparkSession) -> DataFrame:
        """One row per anchor with its month keys."""
        days = F.from_json(F.lit(json.dumps([d.isoformat() for d in self.dates])), "array<date>")
        return spark.range(1).select(F.explode(days).alias("anchor")).select(
            "anchor",
            F.trunc("anchor", "month").alias("m0"),
            month_after("anchor", 1).alias("m1"),
            month_after("anchor", 2).alias("m2"),
            month_after("anchor", 3).alias("m3"),
        )


def month_after(c, k: int) -> Column:
    """First day of the k-th month after the month of date column ``c``."""
    return F.trunc(F.add_months(F.col(c) if isinstance(c, str) else c, k), "month")


def weekday0(c) -> Column:
    """Day of week with 0 = Sunday .. 6 = Saturday."""
    return F.dayofweek(F.col(c) if isinstance(c, str) else c) - 1


def is_business_day(c) -> Column:
    return ~weekday0(c).isin(0, 6)


def business_deadline(c) -> Column:
    """Date + 2 business days (holidays ignored), by weekday of ``c``."""
    col = F.col(c) if isinstance(c, str) else c
    offsets = F.array(*[F.lit(x) for x in SLA_OFFSET_BY_WEEKDAY])
    return F.date_add(col, F.element_at(offsets, weekday0(col) + 1))


def month_label(c) -> Column:
    """'Jul 1998' style label of a month date."""
    return F.date_format(F.col(c) if isinstance(c, str) else c, "MMM yyyy")
