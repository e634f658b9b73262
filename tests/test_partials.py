"""Several metrics are reduced after their rows are shuffled, not in every task of every metric at the width of all."""

import datetime as dt

from pyspark.sql import functions as F

from pulseboard.operators.partials import Partials, together

DAY = dt.date(1998, 6, 16)
DAYS = [DAY, DAY + dt.timedelta(days=1)]


def _metrics(spark):
    def rows(name, *given):
        return spark.createDataFrame([(d, r, n) for d in DAYS for r, n in given], f"anchor date, rep string, {name} long")

    a = Partials(rows("_a", ("x", 1), ("x", 2), ("y", None), (None, 5)), {"_a": "sum"}, {"a": F.col("_a")})
    b = Partials(rows("_b", ("x", 7), ("x", 4), ("z", 3)), {"_b": "min"}, {"b": F.col("_b")})
    return a, b


def test_metrics_are_reduced_after_the_shuffle(spark):
    df = together(*_metrics(spark))
    want = {("x", 3, 4), ("y", None, None), (None, 5, None), ("z", None, 3)}
    assert sorted(map(repr, df.collect())) == sorted(
        repr(r) for r in spark.createDataFrame([(d, *w) for d in DAYS for w in want], df.schema).collect())
    prepared = together(*_metrics(spark))._jdf.queryExecution().executedPlan().toString()
    below = prepared[prepared.rindex("Exchange"):]
    assert prepared.count("Exchange") == 1 and "Union" in below, prepared
    assert "Aggregate" not in below and "Aggregate" in prepared, prepared


def test_one_metric_is_reduced_before_its_shuffle(spark):
    prepared = _metrics(spark)[0].table()._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" in prepared[prepared.rindex("Exchange"):], prepared
