"""SimHash components against all pairs, the tree against a scan."""

import random
from collections import Counter, defaultdict

import xxhash

from pulseboard.llm import simhash

from . import data


def brute_fp(text):
    w = data.words(data.lower(text or ""))
    if not w:
        return 0
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(fps, radius=2):
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    fps = sorted(fps)
    for i, a in enumerate(fps):
        for b in fps[:i]:
            if (a ^ b).bit_count() <= radius:
                root[find(a)] = find(b)
    return {f: find(f) for f in fps}


def test_components_against_all_pairs(spark):
    rows = data.rows(80)
    for k in range(12):  # one long text with a few words changed: fingerprints a few bits apart
        w = data.sentence(random.Random(0), 900).split()
        w[k * 7] = f"changed{k}"
        rows.append((500 + k, " ".join(w), "en", "s", 1))
    df = data.clashing(data.frame(spark, rows))
    got = simhash.linked(df).collect()
    fp = {r[1]: brute_fp(r[1]) for r in rows}
    roots = components(set(fp.values()))
    least = defaultdict(list)
    for r in rows:
        least[roots[fp[r[1]]]].append(r[0])
    first = {k: min((i for i in v if i is not None), default=None) for k, v in least.items()}
    want = Counter((r[0], fp[r[1]], first[roots[fp[r[1]]]]) for r in rows)
    assert Counter((r.doc_id, r._fp % 2**64, r.component_id) for r in got) == want
    assert len(least) < len({f for f in fp.values()})  # some link is by distance, not by equality

    kept = simhash.dedup(df)
    assert kept.columns == df.columns
    out = kept.collect()
    assert len(out) == len(least)
    assert {roots[fp[r.text]] for r in out} == set(least)
    assert all(r.doc_id == first[roots[fp[r.text]]] for r in out)


def test_empty_table(spark):
    assert simhash.linked(data.frame(spark, [])).count() == 0 and simhash.dedup(data.frame(spark, [])).count() == 0


def test_links_of_a_large_group_of_near_fingerprints(spark):
    rng = random.Random(1)
    fps = {rng.getrandbits(64) for _ in range(300)}
    base = rng.getrandbits(64)
    fps |= {base ^ (1 << a) ^ (1 << b) for a in range(0, 64, 2) for b in range(1, 64, 3)}
    fps |= {f ^ 1 << rng.randrange(64) for f in list(fps)[:50]}
    signed = [(f - 2**64 if f >= 2**63 else f,) for f in fps]
    for split in (16, simhash.SPLIT):
        edges = simhash.components(simhash.links(spark.createDataFrame(signed, "_fp long"), split=split)).collect()
        root = {e.u % 2**64: e.v % 2**64 for e in edges}
        got, want = defaultdict(set), defaultdict(set)
        for f in fps:
            got[root.get(f, f)].add(f)
        for f, r in components(fps).items():
            want[r].add(f)
        assert {frozenset(v) for v in got.values()} == {frozenset(v) for v in want.values()}


def test_large_shards_are_split_by_their_free_bits(spark):
    """Fingerprints that agree on half of their bits: two of three strips of all bits would not tell them apart."""
    rng = random.Random(7)
    for fixed in (range(32), range(16, 48), [*range(16), *range(48, 64)]):
        mask = sum(1 << b for b in fixed)
        fps = {rng.getrandbits(64) & ~mask | 0x5A5A5A5A5A5A5A5A & mask for _ in range(3000)}
        df = spark.createDataFrame([(f - 2**64 if f >= 2**63 else f,) for f in fps], "_fp long")
        largest = simhash.shards(df, split=200).groupBy("_key").count().agg({"count": "max"}).first()[0]
        assert largest is None or largest <= 200


def test_tree_finds_all_within_the_radius():
    rng = random.Random(4)
    fps = [rng.getrandbits(12) for _ in range(400)]
    tree = simhash.BKTree()
    for f in fps:
        tree.add(f)
    for q in fps[::7]:
        assert sorted(tree.near(q, 2)) == sorted({f for f in fps if (f ^ q).bit_count() <= 2})
