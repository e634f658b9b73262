"""Embedding near-duplicates against all pairs."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulseboard.llm import vector_dedup as vd

from ..conftest import SF01

SCHEMA = "vec_id long, embedding array<float>"


def good(v):
    return v is not None and len(v) > 0 and all(x is not None and math.isfinite(x) for x in v) and any(v)


def brute(rows, threshold=0.9):
    """(id, n_links, component_id, kept) of every row."""
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        if good(r[1]):
            groups[len(r[1])].append(i)
    out = [(r[0], 0, r[0], True) for r in rows]
    for at in groups.values():
        x = vd.units(np.array([[np.float32(c) for c in rows[i][1]] for i in at], float))
        link = x @ x.T >= threshold
        seen = set()
        for k in range(len(at)):
            if k in seen:
                continue
            todo, group = [k], {k}
            while todo:
                for j in np.flatnonzero(link[todo.pop()]):
                    if j not in group:
                        group.add(int(j))
                        todo.append(int(j))
            seen |= group
            least = min((rows[at[j]][0] for j in group if rows[at[j]][0] is not None), default=None)
            for j in group:
                i = at[j]
                out[i] = (rows[i][0], int(link[j].sum()) - 1, least, rows[i][0] == least)
    return out


def result(df, **kw):
    return [(r.vec_id, r.n_links, r.component_id, r.kept) for r in vd.near_duplicates(df, **kw).collect()]


def around(rng, base, cos):
    """A vector at the given cosine to the unit vector ``base``."""
    z = rng.normal(size=len(base))
    z -= (z @ base) * base
    return cos * base + math.sqrt(1 - cos**2) * z / np.linalg.norm(z)


def test_against_all_pairs(spark):
    rng = np.random.default_rng(1)
    x = vd.units(rng.normal(size=(300, 32)))
    rows = [(i, list(v)) for i, v in enumerate(x)]
    n = len(rows)
    # tight groups, loose ones whose pairs lie about the threshold, chains
    for g, (size, cos) in enumerate([(120, 0.99), (60, 0.96), (80, 0.945)]):
        base = vd.units(rng.normal(size=(1, 32)))[0]
        rows += [(n + 1000 * (g + 1) + k, list(around(rng, base, cos) * rng.uniform(0.1, 50))) for k in range(size)]
    rows += [(5000 + k, list(x[3])) for k in range(200)] + [(5300, list(x[3] * 7)), (5301, list(-x[3]))]
    rows += [rows[4], rows[4], (None, list(x[5])), (None, list(vd.units(rng.normal(size=(1, 32)))[0]))]
    rows += [(6000, None), (6001, []), (6002, [None] * 32), (6003, [0.0] * 32), (6004, [float("nan")] * 32), (6005, [float("inf")] + [1.0] * 31), (None, None)]
    rows += [(6100, list(x[6][:31])), (6101, list(x[6][:31] * 2)), (6102, [1.0]), (6103, [2.0]), (6104, [-1.0]), (6105, [3e38] * 32), (6106, [1e-44] * 32)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v]) for i, v in rows], SCHEMA).repartition(5)
    df = df.withColumn("n_links", F.lit("extra")).withColumn("_v", F.lit("extra")).withColumn("ball", F.lit("extra"))
    got, want = result(df), brute(rows)
    # pairs of the loose group are searched by hash; a ball's pairs and the verified ones may never be wrong
    differ = Counter(got) - Counter(want)
    assert sum(differ.values()) <= 0.02 * len(rows), differ
    links = {k: sum(r[1] for r in x) for k, x in (("got", got), ("want", want))}
    assert 0.99 * links["want"] <= links["got"] <= links["want"]
    assert len(got) == len(want)


@pytest.mark.parametrize("d", [8, 64, 100])
def test_recall_at_the_threshold(spark, d):
    rng = np.random.default_rng(d)
    a = vd.units(rng.normal(size=(1500, d)))
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(a)] + [
        (10_000 + i, [float(c) for c in around(rng, v, 0.9 + 0.02 * rng.random())]) for i, v in enumerate(a)]
    got, want = result(spark.createDataFrame(rows, "vec_id long, embedding array<double>")), brute64(rows)
    assert sum(r[1] for r in want) >= 3000
    assert 0.985 * sum(r[1] for r in want) <= sum(r[1] for r in got)
    assert all(g[1] <= w[1] for g, w in zip(sorted(got), sorted(want)))


def brute64(rows):
    x = vd.units(np.array([r[1] for r in rows]))
    return [(r[0], int(n)) for r, n in zip(rows, (x @ x.T >= 0.9).sum(axis=1) - 1)]


def test_balls_link_wholly():
    rng = np.random.default_rng(2)
    base = vd.units(rng.normal(size=(4, 24)))
    x = vd.units(np.array([around(rng, base[k % 4], c) for k, c in enumerate(rng.uniform(0.9, 1, 400))]))
    made = vd.balls(x, 0.9)
    assert sorted(i for m, _, _ in made for i in m) == list(range(400))
    for members, centre, radius in made:
        y = x[members]
        assert (y @ y.T).min() >= 0.9
        assert np.arccos(np.clip(y @ centre, -1, 1)).max() <= radius + 1e-7
    assert max(len(m) for m, _, _ in made) > 20


def test_hadamard_keeps_lengths_and_angles():
    x = np.random.default_rng(3).normal(size=(20, 32))
    y = vd.hadamard(x)
    assert np.allclose(x @ x.T, y @ y.T) and np.allclose(vd.hadamard(y), x)


def test_probes_are_the_nearest_other_buckets():
    h = vd.Hasher(16, 5000)
    x = vd.units(np.random.default_rng(5).normal(size=(200, 16)))
    own, others = h.codes(x, 0)
    assert h.depth == 2 and others.shape == (200, 3)
    assert all(o not in row and len(set(row)) == 3 for o, row in zip(own, others.tolist()))
    assert (own == h.codes(x, 0, probe=False)[0]).all()


def test_more_vectors_make_deeper_tables():
    depths = [vd.Hasher(64, n).depth for n in (10, 10**4, 10**6, 10**8)]
    assert depths == sorted(depths) and depths[0] == 1 and depths[-1] >= 3


def test_sketch_loses_one_in_ten_thousand():
    angle = math.acos(0.9)
    limit = vd.sketch_limit(angle)
    p = angle / math.pi
    n = vd.SIGNS
    assert sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(limit + 1, n + 1)) < 1e-4


def test_other_threshold(spark):
    rng = np.random.default_rng(8)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(vd.units(rng.normal(size=(300, 4))))]
    df = spark.createDataFrame(rows, SCHEMA)
    got, want = result(df, threshold=0.95), brute(rows, 0.95)
    assert sum(r[1] for r in got) >= 0.985 * sum(r[1] for r in want) > 0
    assert all(g[1] <= w[1] for g, w in zip(sorted(got), sorted(want)))


def test_given_table_with_copies(spark):
    given = spark.read.parquet(f"{SF01}/embeddings.parquet").select("vec_id", "embedding")
    noisy = given.where("vec_id < 40").select((F.col("vec_id") + 1000).alias("vec_id"), F.transform("embedding", lambda c: c * 2 + F.lit(0.01)).alias("embedding"))
    df = given.unionByName(noisy)
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert sorted(result(df)) == sorted(brute(rows))


def test_empty_tables(spark):
    assert result(spark.createDataFrame([], SCHEMA)) == []
    assert result(spark.createDataFrame([(1, None), (2, [0.0])], SCHEMA)) == [(1, 0, 1, True), (2, 0, 2, True)]
