"""Vector codes against a k-means in plain Python integers."""

import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from pulseboard.llm import vector_code as vc

from ..conftest import SF001

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, rounds=6):
    """{(id, vector): (code, error)}, error by label, digest."""
    rows = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    rows = sorted((r for r in rows if len(r[1]) and len(r[1]) % 8 == 0), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    rows = [r for r in rows if len(r[1]) == len(rows[0][1])]
    w = len(rows[0][1]) // 8
    ints = [[math.floor(4096 * float(np.float32(x))) if abs(x) < 1e30 else 4096 * int(float(np.float32(x))) for x in r[1]] for r in rows]
    parts = [[v[k * w:(k + 1) * w] for v in ints] for k in range(8)]
    books = [p[:16] for p in parts]

    def near(p, book):
        d = [sum((a - b) ** 2 for a, b in zip(p, c)) for c in book]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        for k, part in enumerate(parts):
            got = defaultdict(list)
            for p in part:
                got[near(p, books[k])[0]].append(p)
            books[k] = [[sum(c) // len(got[e]) for c in zip(*got[e])] if e in got else entry for e, entry in enumerate(books[k])]
    out, by_label = [], defaultdict(int)
    for i, r in enumerate(rows):
        found = [near(parts[k][i], books[k]) for k in range(8)]
        error = min(sum(d for _, d in found), 2**63 - 1)
        by_label[r[2]] += error
        out.append((r[0], "".join(f"{e:02x}" for e, _ in found), error, r[2]))
    digest = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    return [(*o, min(by_label[o[3]], 2**63 - 1)) for o in out], digest


def vectors(n, seed, d=16, spread=0.2):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.3) for _ in range(d)] for _ in range(6)]
    return [(i, [float(np.float32(rng.gauss(c, spread))) for c in rng.choice(centres)], rng.choice([None, 1, 2, 3])) for i in range(n)]


def check(spark, rows, schema=SCHEMA, parts=3):
    df = spark.createDataFrame(rows, schema).repartition(parts).withColumn("code", F.lit("extra")).withColumn("_id", F.lit("extra"))
    got, books = vc.compress(df)
    want, digest = brute(rows)
    assert vc.books_digest(books) == digest
    assert sorted(map(repr, ((r.vec_id, r.code, r.error, r.label) for r in got.collect()))) == sorted(repr(w[:4]) for w in want)


def test_against_plain_integers(spark):
    rng = random.Random(9)
    rows = vectors(700, 1)
    rows += [(i, rows[3][1], 2) for i in range(700, 900)]  # a hot vector
    rows += [rows[5], rows[5], (None, rows[7][1], None), (7, rows[9][1], 1)]  # repeated rows and ids, a null id
    rows += [(901, None, 1), (902, [None] * 16, 1), (903, [float("nan")] * 16, 1), (904, [float("inf")] + [0.0] * 15, 2), (905, [0.1] * 15, 2), (906, [], 2)]
    rows += [(907, [-1e-40] * 16, 2), (908, [0.0] * 16, 2), (-5, [-0.0] * 16, 2)]
    rng.shuffle(rows)
    check(spark, rows)


def test_tight_balls_are_owned():
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(12, 4)) * 2000)[rng.integers(0, 12, 3000)] + rng.integers(-3, 4, (3000, 4))
    tree, book = vc.Tree.build(x), x[:16]
    owned, (points, _) = tree.owners(x, book)
    assert sum(len(a) for a, _ in owned) > 5 and len(points) < 2400
    assert (tree.codes(x, book) == ((x[:, None] - book[None]) ** 2).sum(axis=2).argmin(axis=1)).all()


def test_balls_hold_their_points_and_caches():
    x = np.floor(np.random.default_rng(4).normal(size=(2000, 3)) * 500)
    tree = vc.Tree.build(x)
    for k in range(len(tree.lo)):
        p = x[tree.order[tree.lo[k]:tree.hi[k]]]
        assert (p.sum(axis=0) == tree.total[k]).all()
        assert ((p - tree.centre[k]) ** 2).sum(axis=1).max() <= tree.radius[k] ** 2
        if tree.left[k] >= 0:
            a, b = tree.left[k], tree.right[k]
            assert (tree.lo[a], tree.hi[a], tree.hi[b]) == (tree.lo[k], tree.lo[b], tree.hi[k])


def test_ties_go_to_the_lower_entry():
    x = np.array([[0.0, 0.0], [2.0, 0.0], [1.0, 0.0], [1.0, 0.0]] * 50)
    for book in (x[:2], x[[1, 0, 1, 0]]):
        want = ((x[:, None] - book[None]) ** 2).sum(axis=2).argmin(axis=1)
        assert (vc.Tree.build(x).codes(x, book) == want).all()


@pytest.mark.parametrize("n", [1, 3, 16])
def test_few_rows(spark, n):
    check(spark, vectors(n, n))


def test_large_values(spark):
    rows = vectors(40, 2)
    rows += [(100 + k, [(-1) ** k * 3e38] * 8 + [1e9 + k] * 8, 1) for k in range(6)] + [(-1, [1e20] * 16, 1)]
    check(spark, rows)


def test_limbs():
    for n in (0, 1, -1, 2**40, -(2**40), 2**200 + 5, -(3**150)):
        assert sum(v << vc.LIMB * k for k, v in enumerate(vc._limbs(n))) == n


def test_empty_tables(spark):
    assert vc.compress(spark.createDataFrame([], SCHEMA))[0].collect() == []
    assert vc.compress(spark.createDataFrame([(1, None, 2)], SCHEMA))[0].collect() == []


def test_query_on_the_given_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    want, digest = brute(rows)
    got = vc.query(spark, SF001).collect()
    assert sorted((r.vec_id, r.code, r.error, r.label_error) for r in got) == sorted((w[0], w[1], w[2], w[4]) for w in want)
    assert {r.codebooks_sha256 for r in got} == {digest}
