"""Metrics as mergeable partials per (anchor, rep).

A metric is given by rows that hold its partial figures, how each figure is
merged, and the columns made of the merged ones. ``table`` reduces one metric;
``together`` puts the rows of several metrics under each other and reduces them
all at once, so that a report over many metrics shuffles once, whatever their
number, and needs no join to bring them side by side.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = ["anchor", "rep"]
MERGE = {"sum": F.sum, "min": F.min, "max": F.max}


@dataclass(frozen=True)
class Partials:
    """``rows`` (anchor, rep, one column per figure), ``merge`` (figure -> sum, min or max) and ``finish`` (output -> Column over figures).
    Figures have names of their own in every metric; a key without rows has null figures."""

    rows: DataFrame
    merge: dict[str, str]
    finish: dict[str, Column]

    def table(self) -> DataFrame:
        return together(self)


def together(*metrics: Partials) -> DataFrame:
    """(anchor, rep) and the outputs of all metrics, for every key that any of them has.

    The rows of several metrics are shuffled as they are, then reduced. Their figures are mostly null and take little
    there, but a reduced key holds them all: reduced before the shuffle, each task of each metric would hold nearly
    every key at that width, since few bytes of narrow rows make a task. After it, a task holds its own keys only."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [m.rows.select(*KEY, *m.merge) for m in metrics])
    if len(metrics) > 1:
        rows = rows.repartition(*KEY)
    figures = {c: how for m in metrics for c, how in m.merge.items()}
    merged = rows.groupBy(*KEY).agg(*[MERGE[how](c).alias(c) for c, how in figures.items()])
    return merged.select(*KEY, *[c.alias(n) for m in metrics for n, c in m.finish.items()])
