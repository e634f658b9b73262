"""Building blocks shared by the operators.

* ``in_window``: attach the anchors whose window contains a row's day, by
  enumerating the row's few candidate days and an equi-join.
* ``first_on_or_after`` / ``last_before``: as-of lookups ("first event day
  >= d", "last event day < d") per key, written as one window pass over the
  union of events and probes. Both inputs are reduced to distinct
  (key, day) first, so a hot key holds at most one row per calendar day and
  no pairs are ever formed.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import Anchors


def _days(n: int) -> dt.timedelta:
    return dt.timedelta(days=n)


def in_window(df: DataFrame, anchors: Anchors, day_col: str, start: int, end: int = 0,
              end_inclusive: bool = False) -> DataFrame:
    """Rows with ``anchor + start <= day < anchor + end`` (``<=`` if inclusive),
    tagged with ``anchor``. ``start``/``end`` are day offsets (negative = past).

    A row belongs to at most ``end - start`` (+ 1) anchors, those of a run of
    days: it enumerates the part of that run within the anchors' range (one
    day if there is one anchor) and meets the anchors on equality."""
    d = F.col(day_col)
    lo = anchors.lo + _days(start)
    hi = anchors.hi + _days(end)
    df = df.where((d >= F.lit(lo)) & ((d <= F.lit(hi)) if end_inclusive else (d < F.lit(hi))))
    first = F.greatest(F.date_sub(d, end if end_inclusive else end - 1), F.lit(anchors.lo))
    last = F.least(F.date_sub(d, start), F.lit(anchors.hi))
    a = anchors.df(df.sparkSession).select("anchor")
    return df.withColumn("anchor", F.explode(F.sequence(first, last))).join(a, "anchor")


#: Anchors from which a windowed metric is no longer computed by copying each row to the days of its window.
MANY_ANCHORS = 8


def running_sums(events: DataFrame, anchors: Anchors, key: str, at: str, sums: list[str]) -> DataFrame:
    """(anchor, ``key``, *sums): what the events up to and on each anchor add up to.

    A row that counts in a window of days is two events, +n on the first anchor that
    sees it and -n after the last, whatever the window's length; one pass per key in
    date order sums them up. A key holds its events and one row per anchor."""
    probes = per_anchor(events.select(key).distinct(), anchors).select(key, F.col("anchor").alias("_at"), F.lit(True).alias("_probe"))
    rows = events.select(key, F.col(at).alias("_at"), F.lit(False).alias("_probe"), *sums).unionByName(probes, allowMissingColumns=True)
    w = Window.partitionBy(key).orderBy("_at", "_probe").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = rows.select(key, "_at", "_probe", *[F.sum(c).over(w).alias(c) for c in sums]).where("_probe")
    return summed.select(F.col("_at").alias("anchor"), key, *sums)


def difference_events(df: DataFrame, anchors: Anchors, day_col: str, start: int, end: int, keep: list[str], sums: list[str]) -> DataFrame:
    """The events (*keep, _at, *sums) of rows that count for anchors with ``anchor + start <= day < anchor + end``."""
    d = F.col(day_col)
    df = df.where((d >= F.lit(anchors.lo + _days(start))) & (d < F.lit(anchors.hi + _days(end))))
    enter = F.struct(F.greatest(F.date_sub(d, end - 1), F.lit(anchors.lo)).alias("_at"), *[F.col(c) for c in sums])
    leave = F.struct(F.date_add(d, 1 - start).alias("_at"), *[(-F.col(c)).alias(c) for c in sums])
    return df.select(*keep, F.inline(F.array(enter, leave))).where(F.col("_at") <= F.lit(anchors.hi))


def frame_figures(df: DataFrame, anchors: Anchors, key: str, day_col: str, start: int, end: int, figures: dict[str, str]) -> DataFrame:
    """(anchor, ``key``, *figures) over ``anchor + start <= day <= anchor + end``, for figures that cannot be subtracted (min, max):
    one range frame per anchor over the rows of its key in date order, instead of a copy of each row for every anchor."""
    d = F.col(day_col)
    df = df.where((d >= F.lit(anchors.lo + _days(start))) & (d <= F.lit(anchors.hi + _days(end))))
    probes = per_anchor(df.select(key).distinct(), anchors).select(key, F.col("anchor").alias("_at"), F.lit(True).alias("_probe"))
    rows = df.select(key, d.alias("_at"), F.lit(False).alias("_probe"), *figures).unionByName(probes, allowMissingColumns=True)
    w = Window.partitionBy(key).orderBy(F.unix_date("_at")).rangeBetween(start, end)
    merge = {"sum": F.sum, "min": F.min, "max": F.max}
    out = rows.select(key, "_at", "_probe", *[merge[how](c).over(w).alias(c) for c, how in figures.items()]).where("_probe")
    return out.select(F.col("_at").alias("anchor"), key, *figures)


def ts_bounds(ts_col: str, lo: dt.date, hi: dt.date) -> Column:
    """``lo <= ts < hi`` on a timestamp column with date bounds at midnight.

    Comparing the raw column (not ``to_date(ts)``) keeps the predicate
    pushable to the Parquet scan.
    """
    c = F.col(ts_col)
    # built from text: a timestamp_ntz literal does not depend on any time zone
    lo_ts = F.lit(f"{lo.isoformat()} 00:00:00").cast("timestamp_ntz")
    hi_ts = F.lit(f"{hi.isoformat()} 00:00:00").cast("timestamp_ntz")
    return (c >= lo_ts) & (c < hi_ts)


def runs_of_days(days) -> list[tuple[dt.date, dt.date]]:
    """First and last day of each run of consecutive days."""
    out: list[tuple[dt.date, dt.date]] = []
    for d in sorted(set(days)):
        if out and d - out[-1][1] == dt.timedelta(days=1):
            out[-1] = (out[-1][0], d)
        else:
            out.append((d, d))
    return out


def _asof(events: DataFrame, probes: DataFrame, keys: list[str], ev_day: str, probe_day: str,
          out: str, forward: bool) -> DataFrame:
    ev = events.select(*keys, F.col(ev_day).alias("_t")).distinct().withColumn("_k", F.lit(0))
    pr = probes.select(*keys, F.col(probe_day).alias("_t")).distinct().withColumn("_k", F.lit(1))
    u = ev.unionByName(pr)
    if forward:
        # descending time; an event on the probe day counts (events sort first)
        w = Window.partitionBy(*keys).orderBy(F.col("_t").desc(), F.col("_k").asc())
        agg = F.min(F.when(F.col("_k") == 0, F.col("_t")))
    else:
        # ascending time; an event on the probe day does not count (probes first)
        w = Window.partitionBy(*keys).orderBy(F.col("_t").asc(), F.col("_k").desc())
        agg = F.max(F.when(F.col("_k") == 0, F.col("_t")))
    w = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return u.withColumn(out, agg.over(w)).where(F.col("_k") == 1).select(
        *keys, F.col("_t").alias(probe_day), out
    )


def first_on_or_after(events: DataFrame, probes: DataFrame, keys: list[str], ev_day: str = "day",
                      probe_day: str = "from_day", out: str = "first_day") -> DataFrame:
    """Distinct (keys, ``probe_day``) of ``probes`` with the first event day
    >= ``probe_day`` for the same keys (null if none); join it back by keys."""
    return _asof(events, probes, keys, ev_day, probe_day, out, forward=True)


def last_before(events: DataFrame, probes: DataFrame, keys: list[str], ev_day: str = "day",
                probe_day: str = "before_day", out: str = "last_day") -> DataFrame:
    """Distinct (keys, ``probe_day``) of ``probes`` with the last event day
    < ``probe_day`` for the same keys (null if none)."""
    return _asof(events, probes, keys, ev_day, probe_day, out, forward=False)


def lookup(col: Column, pairs, default: Column | None = None) -> Column:
    """Map ``col`` through literal pairs (a handful of rule rows)."""
    out = None
    for k, v in pairs:
        out = (F.when(col == F.lit(k), F.lit(v))) if out is None else out.when(col == F.lit(k), F.lit(v))
    if out is None:
        return default if default is not None else F.lit(None)
    return out.otherwise(default) if default is not None else out


def per_anchor(df: DataFrame, anchors: Anchors) -> DataFrame:
    """Each row once per anchor, by exploding the date list; no join is planned."""
    days = F.from_json(F.lit(json.dumps([d.isoformat() for d in anchors.dates])), "array<date>")
    return df.withColumn("anchor", F.explode(days))
