"""Rule statistics and the isolation forest."""

import random

import numpy as np

from pulseboard.llm import quality

from . import data


def brute(text):
    w, size = data.words(text), 8
    lines = [x for x in (text or "").split("\n") if data.words(x)]
    windows = [tuple(w[i:i + size]) for i in range(len(w) - size + 1)]
    seen = {x for x in windows if windows.count(x) > 1} if len(windows) < 400 else {x for x in set(windows) if windows.count(x) > 1}
    marked = {i + k for i, x in enumerate(windows) if x in seen for k in range(size)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""),
            sum(x in lines[:k] for k, x in enumerate(lines)), len(marked))


def test_counts_against_brute_force():
    rng = random.Random(5)
    texts = [r[1] for r in data.rows(60)] + [data.sentence(rng, 60, vocab=3) for _ in range(40)]
    texts += ["a b c d e f g h " * 2, "a b c d e f g h a b c d e f g h", "# * <b>|x|\n\n# * <b>|x|\n", "w " * 40]
    for t in texts:
        if len(t or "") < 9000:
            assert quality.statistics((t or "").encode(), len(t or ""))[0] == brute(t), repr(t)[:80]


def corpus(n=900):
    rng, rows, labels = random.Random(2), [], []
    for i in range(n):
        w = [f"word{rng.randrange(900)}" for _ in range(rng.randrange(30, 200))]
        bad = i % 8 == 0
        if bad:
            w = [x + rng.choice(("***", "$$$")) for x in w] if i % 16 else [x.upper() for x in w]
        rows.append((i, " ".join(w), "en", "s", 1))
        if i % 2 == 0:
            labels.append((i, int(not bad), 0))
    return rows, labels


LABELS = "doc_id long, quality int, toxic int"


def test_forest_on_held_out_rows(spark):
    rows, labels = corpus()
    out = quality.judge_all(data.frame(spark, rows), spark.createDataFrame(labels, LABELS)).collect()
    held = [r for r in out if r.doc_id % 2]
    assert all(r.kept for r in held)  # odd ids are all clean
    bad = [r for r in out if r.doc_id % 8 == 0]
    assert sum(not r.kept for r in bad) >= 0.97 * len(bad)
    assert not any(r.base_failed for r in out)
    kept = quality.keep_good(data.frame(spark, rows), spark.createDataFrame(labels, LABELS))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(r.doc_id for r in out if r.kept)


def test_odd_rows_and_missing_labels(spark):
    rows = data.rows(30)
    df = data.clashing(data.frame(spark, rows))
    none = spark.createDataFrame([], LABELS)
    got = quality.judge_all(df, none).collect()
    assert sorted(map(str, ((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got))) == sorted(
        map(str, ((r[0], *((3000, 12000, 0, 0, 3000) if (r[1] or "").startswith("word word") else brute(r[1]))) for r in rows)))
    assert all(r.kept == (not r.base_failed) == (r.n_words >= 20 and 100 * r.n_repeat_words <= 30 * r.n_words) for r in got)
    kept = quality.keep_good(df, none)
    assert kept.columns == df.columns and kept.count() == sum(r.kept for r in got)
    odd = spark.createDataFrame([(None, 1, 0), (1, None, 0), (1, 0, 0), (1, 1, 0), (99999, 1, 0)], LABELS)
    assert quality.judge_all(df, odd).count() == len(rows)
    assert quality.judge_all(data.frame(spark, []), odd).count() == 0 and quality.keep_good(data.frame(spark, []), none).count() == 0


def test_forest_isolates_what_good_rows_lack():
    rng = np.random.default_rng(0)
    good, far = rng.normal(0.5, 0.02, (500, 4)), rng.normal(0.9, 0.02, (50, 4))
    both = np.r_[good, far]
    forest = quality.grow(good, both.min(axis=0), both.max(axis=0))
    assert quality.score(forest, far).min() > quality.score(forest, good).max()
    assert quality.score(quality.grow(good[:1], good[0], good[0]), good).shape == (500,)
