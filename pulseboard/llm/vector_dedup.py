"""Embedding near-duplicates: cross-polytope hashing after fast Hadamard rotations.

A unit vector, padded to a power of two, is turned by three rounds of random
signs and a fast Hadamard transform; its hash is the nearest of the 2 D signed
axes. A table joins ``depth`` such hashes, so that buckets stay at some ``PER``
vectors whatever the number of vectors; a vector lies in its own bucket of each
table and also looks into the ``2 ** depth - 1`` buckets that are nearest by
the gaps to the next axes (multiprobe). The number of tables follows from
simulated pairs at exactly the threshold, for a recall of ``RECALL`` there.
Candidates must also agree in most of 128 random hyperplane signs (of pairs at the
threshold, one in ten thousand does not). The rest are verified by their cosines in doubles.

Near copies are not compared in pairs. Equal vectors are one (with a count), and
vectors that share a bucket are gathered into balls of angles up to half the
threshold's, whose members all link by the triangle inequality. Vectors are
hashed one by one, but buckets hold balls; a candidate pair of balls links
wholly, or not at all, by the angle of the centres and the two radii, or its
members are compared block by block. Links are counted, not listed, and the
components are those of the balls. A bucket over ``HOT`` vectors is dealt to
several tasks and costs a few balls in each.

Cases: vectors that are null, empty or zero, or hold null, NaN or infinite
components, link with nothing and stand for themselves; vectors link with those of the same
number of components only; repeated rows and ids count each (both are kept); a
null vec_id is no candidate for the smallest, and a component without any id has
a null one, which its rows keep; empty tables give no rows; extra columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written
from .common import table
from .simhash import components

THRESHOLD, RECALL = 0.9, 0.995
#: Vectors that a bucket holds on average at most; with more vectors, tables join one more hash.
PER = 16
#: Vectors of a bucket that one task makes balls of, and members of a ball in one row.
HOT, BLOCK = 65_536, 256
SEED, ROUNDS, AXES, SIGNS = 42, 3, 4, 128
#: Angles within this of the threshold's are left to the cosines themselves.
MARGIN = 1e-6


def usable(vector: Column) -> Column:
    """Whether a vector is not null, empty or zero, and all its components are finite."""
    x = F.transform(vector, lambda c: c.cast("double"))
    odd = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~odd & F.exists(x, lambda c: c != 0), F.lit(False))


def units(x: np.ndarray) -> np.ndarray:
    """Rows as unit vectors in doubles."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x**2).sum(axis=1, keepdims=True))


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of the rows."""
    n, d = x.shape
    h = 1
    while h < d:
        x = x.reshape(n, d // (2 * h), 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], axis=2)
        h *= 2
    return x.reshape(n, d) / math.sqrt(d)


def sketch_limit(angle: float, loss: float = 1e-4) -> int:
    """Fewest differing signs that all but ``loss`` of the pairs at the angle stay within."""
    p, tail = min(angle / math.pi, 1.0), 1.0
    for k in range(SIGNS + 1):
        tail -= math.comb(SIGNS, k) * p**k * (1 - p) ** (SIGNS - k)
        if tail < loss:
            return k
    return SIGNS


class Hasher:
    """Tables of ``depth`` cross-polytope hashes for vectors of ``d`` components."""

    def __init__(self, d: int, n: int, threshold: float = THRESHOLD, recall: float = RECALL) -> None:
        self.d, self.padded, self.threshold = d, max(16, 1 << (d - 1).bit_length()), threshold
        self.depth = max(1, math.ceil(math.log(max(n, PER) / PER) / math.log(2 * self.padded)))
        self.probes = 2**self.depth - 1
        self.ways = np.array(list(product(range(AXES), repeat=self.depth)))
        self.signs = np.random.default_rng([SEED, d]).choice([-1.0, 1.0], size=(1, self.depth, ROUNDS, self.padded))
        self.planes = np.random.default_rng([SEED + 1, d]).normal(size=(d, SIGNS))
        p = self._sharing()
        self.tables = max(1, math.ceil(math.log(1 - recall) / math.log(1 - p))) if p < 1 else 1
        self.signs = np.random.default_rng([SEED, d]).choice([-1.0, 1.0], size=(self.tables, self.depth, ROUNDS, self.padded))

    def _sharing(self, pairs: int = 2000) -> float:
        """Share of simulated pairs at the threshold that meet in one table."""
        if self.d < 2:
            return 1.0
        rng = np.random.default_rng([SEED + 2, self.d])
        a = units(rng.normal(size=(pairs, self.d)))
        z = rng.normal(size=(pairs, self.d))
        z = units(z - (z * a).sum(axis=1, keepdims=True) * a)
        b = self.threshold * a + math.sqrt(1 - self.threshold**2) * z
        (ha, pa_), (hb, pb) = self.codes(a, 0), self.codes(b, 0)
        met = (ha == hb) | (pa_ == hb[:, None]).any(axis=1) | (pb == ha[:, None]).any(axis=1)
        return float(min(max(met.mean(), 1e-3), 1 - 1e-9))

    def codes(self, x: np.ndarray, t: int, probe: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Own bucket of each unit vector in table ``t``, and the nearest others (n x probes)."""
        axis, gap = [], []
        for signs in self.signs[t]:
            y = np.pad(x, ((0, 0), (0, self.padded - self.d)))
            for s in signs:
                y = hadamard(y * s)
            if probe:
                near = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :AXES]
            else:
                near = np.abs(y).argmax(axis=1)[:, None]
            v = np.take_along_axis(y, near, axis=1)
            axis.append((2 * near + (v < 0)).astype(np.uint64))
            gap.append((np.abs(v[:, :1]) - np.abs(v)) ** 2)
        if not probe:
            return self._join([a[:, 0] for a in axis], t), np.empty((len(x), 0), np.int64)
        cost = sum(g[:, self.ways[:, k]] for k, g in enumerate(gap))
        best = np.argsort(cost, axis=1, kind="stable")[:, 1:self.probes + 1]  # the first is the own bucket
        others = self._join([np.take_along_axis(a, self.ways[best, k], axis=1) for k, a in enumerate(axis)], t)
        return self._join([a[:, 0] for a in axis], t), others

    def _join(self, axes: list[np.ndarray], t: int) -> np.ndarray:
        """One 64-bit bucket number of the axes, the table and the width (SplitMix64 steps)."""
        out = np.full(axes[0].shape, (self.d << 20) + t, np.uint64)
        for a in axes:
            out = (out ^ a) + np.uint64(0x9E3779B97F4A7C15)
            out = (out ^ (out >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            out = (out ^ (out >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            out = out ^ (out >> np.uint64(31))
        return out.view(np.int64)

    def sketch(self, x: np.ndarray) -> np.ndarray:
        """Signs of the unit vectors' products with random planes, in two longs."""
        return np.packbits(x @ self.planes >= 0, axis=1).view(np.int64)


@lru_cache(maxsize=16)
def hasher(d: int, n: int, threshold: float) -> Hasher:
    return Hasher(d, n, threshold)


def by_width(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix) of the vectors of each length."""
    size = column.value_lengths().to_numpy(zero_copy_only=False)
    for d in np.unique(size):
        at = np.flatnonzero(size == d)
        yield at, column.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).reshape(len(at), d)


def _bucketed(n: int, threshold: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bucket = np.zeros(b.num_rows, np.int64)
            for at, x in by_width(b.column("_v")):
                bucket[at] = hasher(x.shape[1], n, threshold).codes(units(x), 0, probe=False)[0]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(bucket)], names=[*b.schema.names, "_bucket"])
    return run


def balls(x: np.ndarray, threshold: float) -> list[tuple[np.ndarray, np.ndarray, float]]:
    """(members, centre, radius) of unit vectors: all members of a ball link. Singles have no radius."""
    most = (math.acos(threshold) - MARGIN) / 2
    left, out = np.arange(len(x)), []
    while len(left):
        near = left[x[left] @ x[left[0]] >= math.cos(most)]
        if len(near) > 1:
            centre = x[near].mean(axis=0)
            centre /= math.sqrt(centre @ centre)
            near = left[x[left] @ centre >= math.cos(most)]  # a second look from the middle finds more
            radius = float(np.arccos(np.clip(x[near] @ centre, -1, 1)).max(initial=0)) + 1e-7
        if len(near) > 1 and radius <= most and left[0] in near:
            out.append((near, centre, radius))
        else:
            near = left[:1]
            out.append((near, x[left[0]], 0.0))
        left = np.setdiff1d(left, near, assume_unique=True)
    return out


def _cells(kinds: dict, threshold: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by bucket. A row per ball, or per BLOCK members of one."""
        task, made = TaskContext.get().partitionId(), 0
        for b in batches:
            key, count, least = (b.column(c) for c in ("_key", "_n", "_least"))
            weight, bucket = count.to_numpy(), b.column("_bucket").to_numpy()
            rows: list[tuple] = []
            for at, raw in by_width(b.column("_v")):
                x = units(raw)
                cuts = np.flatnonzero(np.diff(bucket[at])) + 1
                for group in np.split(np.arange(len(at)), cuts):
                    for near, centre, radius in balls(x[group], threshold):
                        members = group[near]
                        ball = (task << 33) + made
                        made += 1
                        for k in range(0, len(members), BLOCK):
                            part = members[k:k + BLOCK]
                            rows.append((ball, k // BLOCK, int(weight[at[members]].sum()), radius, raw.shape[1],
                                         centre.tobytes() if radius else None, raw[part].tobytes(), at[part]))
            if rows:
                ends = pa.array(np.cumsum([0, *[len(r[-1]) for r in rows]]), pa.int32())
                order = pa.array(np.concatenate([r[-1] for r in rows]))
                lists = [pa.ListArray.from_arrays(ends, c.take(order)) for c in (key, count, least)]
                columns = [pa.array(c, kind) for c, kind in zip(zip(*[r[:-1] for r in rows]), kinds.values())]
                yield pa.RecordBatch.from_arrays([*columns, *lists], names=[*kinds, "keys", "counts", "leasts"])
    return run


KINDS = {"ball": pa.int64(), "block": pa.int32(), "size": pa.int64(), "radius": pa.float64(), "width": pa.int32(), "centre": pa.binary(), "raw": pa.binary()}


def cells(distinct: DataFrame, n: int, threshold: float) -> DataFrame:
    """Balls of the distinct vectors (_key, _v, _n, _least), written once: ball numbers hold from there on."""
    kinds = {f.name: f.dataType for f in distinct.schema}
    sides = [T.StructField(c, T.ArrayType(kinds[k])) for c, k in (("keys", "_key"), ("counts", "_n"), ("leasts", "_least"))]
    plain = {"ball": "long", "block": "int", "size": "long", "radius": "double", "width": "int", "centre": "binary", "raw": "binary"}
    schema = T.StructType([*[T.StructField(c, T._parse_datatype_string(t)) for c, t in plain.items()], *sides])
    known = distinct.mapInArrow(_bucketed(n, threshold), T.StructType([*distinct.schema.fields, T.StructField("_bucket", T.LongType())]))
    # a row per hot bucket; as a stored table its size is known, so vectors need no shuffle to meet it
    hot = written(known.groupBy("_bucket").agg(F.ceil(F.count(F.lit(1)) / HOT).alias("_deal")).where("_deal > 1"), "vectors-hot")
    salt = F.pmod(F.xxhash64("_key"), F.coalesce("_deal", F.lit(1)))
    dealt = known.join(hot, "_bucket", "left").withColumn("_salt", salt).drop("_deal").repartition("_bucket", "_salt")
    return written(dealt.sortWithinPartitions("_bucket", "_key").mapInArrow(_cells(KINDS, threshold), schema), "vectors-balls")


def matrix(raw: bytes, width: int, real: str) -> np.ndarray:
    return units(np.frombuffer(raw, real).reshape(-1, width))


def middles(centres: list[bytes | None], singles: list[bytes | None], width: int, real: str) -> np.ndarray:
    """Centres of balls; a single is its own."""
    out, ball = np.empty((len(centres), width)), np.array([c is not None for c in centres])
    if ball.any():
        out[ball] = np.frombuffer(b"".join(c for c in centres if c is not None), float).reshape(-1, width)
    if not ball.all():
        out[~ball] = matrix(b"".join(r for r, c in zip(singles, centres) if c is None), width, real)
    return out


def _entries(n: int, threshold: float, real: str, probe: bool) -> Callable:
    base = sketch_limit(math.acos(threshold))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            width = b.column("width").to_numpy()
            radius, ball = b.column("radius").to_numpy(), b.column("ball").to_numpy()
            slack = np.array([sketch_limit(math.acos(threshold) + r) - base if r else 0 for r in radius], np.int32)
            for d in np.unique(width):
                at = np.flatnonzero(width == d)
                h = hasher(int(d), n, threshold)
                raw, centre = (b.column(c).take(pa.array(at)).to_pylist() for c in ("raw", "centre"))
                x = matrix(b"".join(raw), d, real)
                row = np.repeat(at, [len(r) // (d * np.dtype(real).itemsize) for r in raw])
                sketch = np.zeros((b.num_rows, 2), np.int64)
                sketch[at] = h.sketch(middles(centre, raw, d, real))
                for t in range(h.tables):
                    own, others = h.codes(x, t, probe)
                    code = np.concatenate([own[:, None], others], axis=1)
                    home = np.zeros(code.shape, bool)
                    home[:, 0] = True
                    # members of a ball that meet in a bucket are one entry there
                    e = np.stack([np.repeat(row, code.shape[1]), ~home.ravel(), code.ravel()], axis=1)
                    e = e[np.lexsort((e[:, 1], e[:, 2], e[:, 0]))]
                    e = e[np.r_[True, (e[1:, 0] != e[:-1, 0]) | (e[1:, 2] != e[:-1, 2])]]
                    i = e[:, 0]
                    yield pa.RecordBatch.from_arrays([pa.array(e[:, 2]), pa.array(ball[i]), pa.array(e[:, 1] == 0),
                                                      *[pa.array(sketch[i, k]) for k in (0, 1)], pa.array(slack[i])],
                                                     names=["bucket", "ball", "home", "signs", "more", "slack"])
    return run


def candidates(packed: DataFrame, n: int, threshold: float, real: str) -> DataFrame:
    """Distinct pairs of balls (a < b) that meet: the own bucket of one is an own or probed bucket of the other."""
    rows = packed.select("ball", "radius", "width", "centre", "raw")
    schema = "bucket long, ball long, home boolean, signs long, more long, slack int"
    own = rows.mapInArrow(_entries(n, threshold, real, False), schema).alias("h")
    all_ = rows.mapInArrow(_entries(n, threshold, real, True), schema).alias("e")
    once = (F.col("h.ball") < F.col("e.ball")) | (~F.col("e.home") & (F.col("h.ball") > F.col("e.ball")))
    apart = sum(F.bit_count(F.col(f"h.{c}").bitwiseXOR(F.col(f"e.{c}"))) for c in ("signs", "more"))
    close = apart <= sketch_limit(math.acos(threshold)) + F.col("h.slack") + F.col("e.slack")
    met = own.join(all_, (F.col("h.bucket") == F.col("e.bucket")) & once & close)
    return met.select(F.least("h.ball", "e.ball").alias("a"), F.greatest("h.ball", "e.ball").alias("b")).distinct()


def _judge(threshold: float, real: str) -> Callable:
    angle = math.acos(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs of balls that link wholly, or may link in part."""
        for b in batches:
            width = b.column("width").to_numpy()
            verdict = np.zeros(b.num_rows, np.int8)
            for d in np.unique(width):
                at = np.flatnonzero(width == d)
                x, y = (middles(*[b.column(f"{c}_{s}").take(pa.array(at)).to_pylist() for c in ("centre", "single")], d, real) for s in "ab")
                cos = (x * y).sum(axis=1)
                reach = b.column("radius_a").to_numpy()[at] + b.column("radius_b").to_numpy()[at]
                between = np.arccos(np.clip(cos, -1, 1))
                whole = between + reach <= angle - MARGIN
                part = ~whole & (between - reach <= angle + MARGIN)
                single = reach == 0
                verdict[at] = np.where(single, cos >= threshold, np.where(whole, 1, np.where(part, 2, 0)))
            at = pa.array(np.flatnonzero(verdict))
            yield pa.RecordBatch.from_arrays([*[b.column(c).take(at) for c in ("a", "b", "size_a", "size_b")], pa.array(verdict == 2).take(at)],
                                             names=["a", "b", "size_a", "size_b", "part"])
    return run


def _members(threshold: float, real: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Links of the members of one block with those of another: how many vectors each member links with."""
        for b in batches:
            pairs: list[tuple] = []
            for i in range(b.num_rows):
                a_, b_, d = b.column("a")[i].as_py(), b.column("b")[i].as_py(), b.column("width")[i].as_py()
                x, y = (matrix(b.column(f"raw_{s}")[i].as_py(), d, real) for s in "ab")
                hit = x @ y.T >= threshold
                for s, m in (("a", hit), ("b", hit.T)):
                    weight = np.array(b.column(f"counts_{'b' if s == 'a' else 'a'}")[i].as_py())
                    keys = b.column(f"keys_{s}")[i].as_py()
                    pairs += [(a_, b_, keys[k], int(weight[m[k]].sum())) for k in np.flatnonzero(m.any(axis=1))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*pairs)) or [()] * 4, (pa.int64(), pa.int64(), pa.string(), pa.int64()))],
                                             names=["a", "b", "_key", "n"])
    return run


def _side(packed: DataFrame, side: str, *columns: str) -> DataFrame:
    return packed.select(F.col("ball").alias(side), *[F.col(c).alias(c if c == "width" else f"{c}_{side}") for c in columns])


def links(packed: DataFrame, n: int, threshold: float, real: str) -> tuple[DataFrame, DataFrame]:
    """Pairs of balls that link wholly (a, b, size_a, size_b), and the members' links where only some do (a, b, _key, n)."""
    pairs = candidates(packed, n, threshold, real)
    heads = packed.where("block = 0").withColumn("single", F.when(F.col("centre").isNull(), F.col("raw")))
    facts = "size", "radius", "centre", "single"
    given = pairs.join(_side(heads, "a", "width", *facts), "a").join(_side(heads, "b", *facts), "b")
    judged = written(given.mapInArrow(_judge(threshold, real), "a long, b long, size_a long, size_b long, part boolean"), "vectors-links")
    blocks = "raw", "keys", "counts"
    some = judged.where("part").select("a", "b").join(_side(packed, "a", "width", *blocks), "a").join(_side(packed, "b", *blocks), "b")
    return judged.where("not part"), written(some.mapInArrow(_members(threshold, real), "a long, b long, _key string, n long"), "vectors-part")


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    real = vectors.schema[vector].dataType.elementType
    v = F.col(vector) if isinstance(real, (T.FloatType, T.DoubleType)) else F.col(vector).cast("array<double>")
    dtype = "f4" if isinstance(real, T.FloatType) else "f8"
    rows = vectors.select(F.col(vec_id).alias("_vid"), v.alias("_v"), usable(v).alias("_ok"))
    key = F.concat(*[F.lpad(F.hex(F.xxhash64(F.lit(k), "_v")), 16, "0") for k in (1, 2)])  # 128 bits
    distinct = rows.where("_ok").groupBy("_v").agg(F.count(F.lit(1)).alias("_n"), F.min("_vid").alias("_least"))
    distinct = written(distinct.withColumn("_key", key), "vectors-distinct")
    n = distinct.count()
    packed = cells(distinct, n, threshold)
    whole, part = links(packed, n, threshold, dtype)

    edges = whole.select("a", "b").unionByName(part.select("a", "b").distinct())
    roots = components(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))).withColumnsRenamed({"u": "ball", "v": "root"})
    bulk = whole.select(F.col("a").alias("ball"), F.col("size_b").alias("n")).unionByName(whole.select(F.col("b").alias("ball"), F.col("size_a").alias("n")))
    bulk = bulk.groupBy("ball").agg(F.sum("n").alias("bulk"))
    of_ball = packed.groupBy("ball").agg(F.first("size").alias("size"), F.min(F.array_min("leasts")).alias("least"))
    of_ball = of_ball.join(bulk, "ball", "left").join(roots, "ball", "left").withColumn("root", F.coalesce("root", "ball"))
    of_ball = written(of_ball, "vectors-of-ball")
    least = of_ball.groupBy("root").agg(F.min("least").alias("component_id"))
    judged = of_ball.join(least, "root").select("ball", (F.col("size") - 1 + F.coalesce("bulk", F.lit(0))).alias("base"), "component_id")

    more = part.groupBy("_key").agg(F.sum("n").alias("more"))
    of_key = packed.select("ball", F.explode("keys").alias("_key")).join(judged, "ball").join(more, "_key", "left")
    of_key = of_key.select("_key", (F.col("base") + F.coalesce("more", F.lit(0))).alias("n_links"), "component_id")
    named = rows.select("_vid", F.when(F.col("_ok"), key).alias("_key"))
    out = named.join(of_key, "_key", "left")
    component = F.when(F.col("n_links").isNull(), F.col("_vid")).otherwise(F.col("component_id"))
    return out.select(F.col("_vid").alias(vec_id), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("_vid").eqNullSafe(component).alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
