"""Mixing sources to target weights by hash-threshold histograms.

Sizes are word counts. A source's target is its share of all words by weight;
it stops at ``max_copies`` times the source's own words, and the excess is
reshared by weight until no source is above. A source takes every document
``q`` times, ``q = floor(target / words)``, and once more the documents whose
hash lies below a threshold. The threshold comes from nested histograms: words
are summed by (source, hash bucket), the bucket where the running sum meets
the rest of the target is the boundary, and only the rows of that bucket get
the next, finer histogram, until the boundary is one document. The choice is
then a filter; no row is sorted.

A histogram has at most ``2 ** BITS`` rows per source whatever the data hold,
and is summed map-side, so a source with a third of all rows is no hot group.
The order is by hash of (id, text), so reruns agree; copies of one row (same id
and text) are told apart by a second hash of their place in the input, which
cannot change what the result holds, as they are alike. (``mix`` reads its input
twice; where one row fills a boundary by its copies, the input must give the
same order both times, as a stored table does.) Source tables (one
row per source) are small by nature.

Cases: a null text has size 0; a null source is a source and ranks last; empty
tables give no rows; sources with no words get target 0 and take nothing. Where
``mix`` drops or repeats documents, a document without words follows its
source's ``q`` and threshold like any other. Extra columns stay.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import written
from .common import n_words, table

#: Weights of the sources in code point order (null last), repeating.
WEIGHTS = (5, 2, 1)
MAX_COPIES = 3
#: Bits of one histogram level.
BITS = 12


def _digit(level: int) -> Column:
    """Bucket of a row at a level: ``BITS`` bits of ``_h``, then of ``_s``, from the top."""
    per = math.ceil(64 / BITS)
    col, k = (F.col("_h"), level) if level < per else (F.col("_s"), level - per)
    shift = max(0, 64 - BITS * (k + 1))
    if k == 0:  # the sign bit counts as an ordinary order: negative hashes first
        return F.shiftright(col, shift)
    return F.shiftrightunsigned(col, shift).bitwiseAND((1 << min(BITS, 64 - BITS * k)) - 1)


LEVELS = 2 * math.ceil(64 / BITS)


def targets(sizes: DataFrame, weights=WEIGHTS, max_copies: int = MAX_COPIES) -> DataFrame:
    """(_src, source_size, target) of a table (_src, _size)."""
    src = sizes.groupBy("_src").agg(F.sum("_size").alias("source_size"))
    rank = F.row_number().over(W.orderBy(F.col("_src").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int")).cast("double")
    src = written(src.withColumn("weight", weight), "mix-sources")
    cap = F.col("source_size") * float(max_copies)
    total, weight_sum = src.agg(F.sum("source_size"), F.sum("weight")).first()
    level = (total or 0) / weight_sum if weight_sum else 0.0
    while True:
        above = F.col("weight") * level > cap
        capped, free = src.agg(F.sum(F.when(above, cap)), F.sum(F.when(~above, F.col("weight")))).first()
        new = ((total or 0) - (capped or 0.0)) / free if free else level
        if not new > level:
            break
        level = new
    return src.withColumn("target", F.least(cap, F.col("weight") * level))


def thresholds(rows: DataFrame, budget: DataFrame) -> DataFrame:
    """Boundary (_th, _ts, _in) of each source of ``budget`` (_src, _rest > 0) over ``rows`` (_src, _size, _h, _s)."""
    done, state = None, budget
    for level in range(LEVELS):
        buckets = rows.groupBy("_src", _digit(level).alias("_d")).agg(
            F.sum("_size").alias("_b"), F.count("*").alias("_n"), F.max("_h").alias("_th"), F.max("_s").alias("_ts"))
        running = F.sum("_b").over(W.partitionBy("_src").orderBy("_d"))
        met = (
            buckets.withColumn("_cum", running)
            .join(state.withColumnRenamed("_src", "_k"), F.col("_src").eqNullSafe(F.col("_k"))).drop("_k")
            .where(F.col("_cum") >= F.col("_rest"))
        )
        edge = met.groupBy("_src").agg(F.min_by(F.struct("_d", "_b", "_n", "_th", "_ts", "_cum", "_rest"), "_d").alias("e"))
        edge = written(edge.select("_src", "e.*").withColumn("_rest", F.col("_rest") - (F.col("_cum") - F.col("_b"))), f"mix-level{level}")
        last = level == LEVELS - 1
        alone = F.lit(2 * level < LEVELS)  # one row by its first hash: the second takes no part
        settled = edge.where(F.lit(last) | (F.col("_n") == 1)).select(
            "_src", "_th", F.when(~alone, F.col("_ts")).alias("_ts"), (F.col("_rest") * 2 >= F.col("_b")).alias("_in"))
        done = settled if done is None else done.unionByName(settled)
        open_ = edge.where(F.col("_n") > 1)
        if last or open_.isEmpty():
            break
        bound = open_.select(F.col("_src").alias("_k"), F.col("_d").alias("_kd"))
        rows = written(
            rows.join(bound, F.col("_src").eqNullSafe(F.col("_k")) & (_digit(level) == F.col("_kd"))).select("_src", "_size", "_h", "_s"),
            f"mix-rows{level}")
        state = open_.select("_src", "_rest")
    return done


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` under the prefix _doc_, with source, size and the two hashes."""
    return docs.select(*[F.col(c).alias(f"_doc_{c}") for c in docs.columns]).withColumns({
        "_src": F.col("_doc_source"), "_size": n_words(F.col("_doc_text")),
        "_h": F.xxhash64("_doc_doc_id", "_doc_text"), "_s": F.xxhash64(F.monotonically_increasing_id())})


def _copies(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """``rows`` with source_size, target and _copies, the copies that the mix takes of each."""
    plan = targets(sizes)
    q = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = plan.withColumn("_q", q.cast("long")).withColumn("_rest", F.col("target") - F.col("_q") * F.col("source_size"))
    edge = thresholds(sizes, plan.where("_rest > 0").select("_src", "_rest"))
    plan = plan.join(edge.withColumnRenamed("_src", "_k"), F.col("_src").eqNullSafe(F.col("_k")), "left").drop("_k")
    # one row per source: as a stored table its size is known, so texts need no shuffle to meet it
    plan = written(plan.select(F.col("_src").alias("_k"), "source_size", "target", "_q", "_th", "_ts", "_in"), "mix-plan")
    below = (F.col("_h") < F.col("_th")) | ((F.col("_h") == F.col("_th")) & (
        F.when(F.col("_ts").isNull(), F.col("_in")).otherwise((F.col("_s") < F.col("_ts")) | ((F.col("_s") == F.col("_ts")) & F.col("_in")))))
    out = rows.join(plan, F.col("_src").eqNullSafe(F.col("_k")))
    return out.withColumn("_copies", F.col("_q") + F.coalesce(below, F.lit(False)).cast("long"))


def mix_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken of every document."""
    keyed = _keyed(docs.select("doc_id", "source", "text"))
    sizes = written(keyed.select(F.col("_doc_doc_id").alias("doc_id"), "_src", "_size", "_h", "_s"), "mix-sizes")
    return _copies(sizes, sizes).select(
        "doc_id", F.col("_size").alias("size"), "source_size", "target", (F.col("_size") * F.col("_copies")).alias("taken"))


def mix(docs: DataFrame) -> DataFrame:
    """The mixed corpus: the rows of ``docs``, each as often as the mix takes it."""
    keyed = _keyed(docs)
    sizes = written(keyed.select("_src", "_size", "_h", "_s"), "mix-sizes")
    out = _copies(keyed, sizes).where("_copies > 0")
    out = out.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
    return out.select(*[F.col(f"_doc_{c}").alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sizes(table(spark, sf_dir, "documents"))
