"""Touch counts per (rep, org, day), kept between the runs of daily jobs.

A refresh needs the touches of about 120 days. The state holds them reduced
(``touches.touch_days`` of every rep, a folder per day), so a run reduces the
days that are new and those whose touches changed since, and reads the rest.

What changed is found by a mark per day: each touch weighs a hash of its (rep,
org, day) and of what it counts as, and the weights of a day are summed. The
sum over the source rows equals the sum over the stored counts, each times its
weight, exactly if the counts are those of the rows; rows that came late, were
corrected or were deleted, and a changed rule, show in it alike. Marks of the
stored days come from the files themselves, with the version that names them
(``sources.daytable``); marks of the source are one pass over its days with a
few rows per task to exchange, no shuffle of touches.

``settled_days``: stored days that lie further back are final and are not
looked at again, which bounds the pass; rows that come later than that are not
seen. None (the default) looks at every day asked for.

Cases: a day whose touches all went is emptied; touches without a rep or an org
are kept as such (the jobs' own joins drop them); two runs at once: the second
raises ``ConcurrentWrite`` if it wrote the same days.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Rules
from ..operators import touches as TC
from ..sources import Sources
from ..sources.daytable import DayTable

COUNTS = ("n_act", "n_long", "n_any")
#: Sum of count x weight over rows (rep, org, day, *COUNTS); as text, for the version's file.
MARK = "cast(sum(%s) as string)" % " + ".join(
    f"cast({c} as decimal(12,0)) * cast(xxhash64(rep, org, day, '{c}') as decimal(20,0))" for c in COUNTS)
#: Versions whose files are kept, so that a run can end while the next one writes.
KEEP_VERSIONS = 2


def counted(touches: DataFrame) -> DataFrame:
    """Each touch as the row of counts that it alone would be reduced to."""
    act = F.col("channel") == "action"
    long_call = F.coalesce(~act & F.col("qualifies"), F.lit(False))
    return touches.select("rep", "org", "day", act.cast("long").alias("n_act"), long_call.cast("long").alias("n_long"),
                          F.lit(1).cast("long").alias("n_any"))


class TouchState:
    def __init__(self, spark: SparkSession, path: str, settled_days: int | None = None) -> None:
        self.spark, self.settled_days = spark, settled_days
        self.table = DayTable(spark, path, "day", "org", {"mark": MARK}, KEEP_VERSIONS)

    def update(self, src: Sources, rules: Rules, lo: dt.date, hi: dt.date) -> list[dt.date]:
        """Bring ``lo <= day < hi`` up to date with the sources; returns the days that were written or emptied."""
        base = self.table.version()
        stored = {dt.date.fromisoformat(d): x.summary["mark"] for d, x in base.days.items()} if base else {}
        days = [lo + dt.timedelta(days=k) for k in range((hi - lo).days)]
        if self.settled_days is not None:
            final = hi - dt.timedelta(days=self.settled_days)
            days = [d for d in days if d >= final or d not in stored]
        # days after all stored ones are new: they are written without a look at their marks
        new = [d for d in days if not stored or d > max(stored)]
        seen = [d for d in days if d not in set(new)]
        marks = self._source_marks(src, rules, seen) if seen else {}
        changed = [d for d in seen if marks.get(d) != stored.get(d)]
        filled = new + [d for d in changed if d in marks]
        staged = self.table.stage(self._reduced(src, rules, filled)) if filled else {}
        gone = {str(d) for d in changed} - set(staged)
        if staged or gone:
            self.table.publish(staged, gone, base)
        return sorted({dt.date.fromisoformat(d) for d in staged} | {dt.date.fromisoformat(d) for d in gone})

    def read(self, src: Sources, rules: Rules, lo: dt.date, hi: dt.date) -> DataFrame:
        """(rep, org, day, *COUNTS) of ``lo <= day < hi`` as last updated; the sources give the types only."""
        schema = self._reduced(src, rules, [lo]).schema
        version = self.table.version()
        if version is None:
            return self.spark.createDataFrame([], schema)
        days = [lo + dt.timedelta(days=k) for k in range((hi - lo).days)]
        return self.table.read(schema, days, version).select(*schema.names)

    def _source_marks(self, src: Sources, rules: Rules, days: list[dt.date]) -> dict[dt.date, str]:
        rows = counted(TC.touch_sources(src, rules, None, None, days=days))
        return {r.day: r.mark for r in rows.groupBy("day").agg(F.expr(MARK).alias("mark")).collect()}  # one row per day

    def _reduced(self, src: Sources, rules: Rules, days: list[dt.date]) -> DataFrame:
        return TC.touch_days(TC.touch_sources(src, rules, None, None, days=days))
