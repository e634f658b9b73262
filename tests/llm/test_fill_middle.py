"""Fill-in-the-middle: the learned index against a scan, outputs against a plain rewriting."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from pulseboard.llm import fill_middle as fm

from . import data

TEXTS = ["", "\n", "a", "a\n", "\n\n", "a\nb", "\na", "é\n🙂🙂\n日本", "has <S> inside\nb", "<P\n>", "x<\nS>\n<M"]


def offsets(text):
    return [0] + [m.end() for m in re.finditer(r"[^\n]*\n|[^\n]+", text)]


def lines(rng, n, spread):
    return "\n".join("x" * int(rng.paretovariate(spread)) for _ in range(n))


def brute(doc_id, text):
    text = text or ""
    ends, d = offsets(text), hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(d[k:k + 8], 16) for k in (0, 8, 16, 24)]
    n = len(ends) - 1
    if not text or re.search("<[PSM]>", text):
        return doc_id, n, "plain", None, None, text
    a, b = sorted(ends[x % (n + 1)] for x in h[:2])
    p, m, s = text[:a], text[a:b], text[b:]
    form = "spm" if h[3] % 100 < 50 else "psm"
    return doc_id, n, form, len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("epsilon", [1, 10, fm.EPSILON])
def test_index_is_exact(epsilon):
    rng = random.Random(3)
    for t in TEXTS + [lines(rng, rng.randrange(1, 400), rng.choice([0.5, 1, 3])) for _ in range(150)]:
        assert fm.boundaries(t) == offsets(t)
        x = fm.RankIndex.fit(offsets(t), epsilon)
        assert [x[k] for k in range(x.units + 1)] == offsets(t)
        assert max(abs(x.predict(k) - o) for k, o in enumerate(offsets(t))) <= epsilon + 1


def test_index_is_small_and_its_residuals_decide():
    rng = random.Random(4)
    ends = offsets("\n".join("w" * rng.randrange(20, 80) for _ in range(20_000)))
    x = fm.RankIndex.fit(ends)
    assert len(x.starts) < 600 and x.residuals.nbytes == len(ends)
    assert sum(x.predict(k) != o for k, o in enumerate(ends)) > len(ends) / 2


def test_index_rejects_wider_residuals():
    with pytest.raises(ValueError):
        fm.RankIndex.fit([0, 1], 1000)


def test_against_plain_rewriting(spark):
    rng = random.Random(5)
    rows = data.rows(60) + [(900 + k, t, None, None, None) for k, t in enumerate(TEXTS)]
    rows.append((990, lines(rng, 30_000, 1.2), "en", "s", 1))  # a long text
    df = data.clashing(data.frame(spark, rows)).withColumn("output", F.lit("extra")).withColumn("n", F.lit("extra"))
    made = fm.fill_in_middle(df)
    assert made.columns[-5:] == ["n", "form", "prefix_chars", "middle_chars", "output"] and made.columns.count("n") == 1
    made = made.withColumn("back", fm.restore(F.col("output"), F.col("form")))
    got = sorted(map(repr, ((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in made.collect())))
    assert got == sorted(repr(brute(r[0], r[1])) for r in rows)
    assert {r.form for r in made.collect()} == {"plain", "psm", "spm"}
    assert sorted(r.back for r in made.collect()) == sorted(r[1] or "" for r in rows)


def test_stored_index_gives_the_same_cuts(spark):
    df = data.frame(spark, [r for r in data.rows(40) if r[0] is not None])
    cols = ["doc_id", "n", "form", "prefix_chars", "middle_chars"]
    for seed in (7, 8):
        direct = fm.fill_in_middle(df, seed=seed).select(*cols)
        again = fm.stored_cuts(fm.rank_index(df), seed=seed)
        assert sorted(map(repr, direct.collect())) == sorted(map(repr, again.collect()))


def test_rates_and_sentinels(spark):
    df = data.frame(spark, [(k, "a\nb\nc\n", None, None, None) for k in range(400)])
    rows = fm.fill_in_middle(df, fim_percent=50, spm_percent=0, sentinels=("[p]", "[s]", "[m]")).collect()
    plain = sum(r.form == "plain" for r in rows)
    assert 150 < plain < 250 and all(r.form != "spm" for r in rows)
    assert all(r.output.startswith("[p]") for r in rows if r.form == "psm")


def test_empty_table(spark):
    assert fm.fill_in_middle(spark.createDataFrame([], data.DOCS)).collect() == []
