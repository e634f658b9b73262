"""Small document tables for the training-data tests."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SPACE = " \t\n\r\x0b\x0c"

#: Texts that every operator must stand.
ODD = [None, "", " ", "\n\n\t", "one", "naïve café 日本語 🙂", "a b c", "É é A a", "x" * 5000, "word " * 3000, "\x00 \x1c \u00a0 z", "tail\r\nof lines\r\n"]


def sentence(rng, n, vocab=400):
    return " ".join(f"w{rng.randrange(vocab)}q" for _ in range(n))


def rows(n=120, seed=1):
    """Documents with copies, near copies, repeated lines, odd texts, null ids and sources, repeated rows."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        text = "\n".join(sentence(rng, rng.randrange(3, 40)) for _ in range(rng.randrange(1, 6)))
        out.append((i, text, "en", f"s{i % 5}" if i % 3 else "hot", len(text)))
    for k in range(10):  # copies and near copies
        out.append((n + k, out[k][1], "en", "s1", 1))
        out.append((n + 20 + k, out[k][1] + " extra", "en", None, 1))
    out += [(n + 50 + k, t, None, "odd", None) for k, t in enumerate(ODD)]
    out += [(None, "no id here but text enough to matter for all", "en", "s2", 1), out[3], out[3], (None, None, None, None, None)]
    return out


def frame(spark, data, parts=3):
    return spark.createDataFrame(data, DOCS).repartition(parts)


def clashing(df):
    """Extra columns named like those that operators add."""
    from pyspark.sql import functions as F

    for name in ("size", "kept", "shard", "_fp", "_key", "_src", "_size", "_rec", "id", "drop", "u", "v", "rule", "_best"):
        df = df.withColumn(name, F.lit("extra"))
    return df


def words(text):
    out, cur = [], ""
    for c in text or "":
        if c in SPACE:
            if cur:
                out.append(cur)
            cur = ""
        else:
            cur += c
    return out + ([cur] if cur else [])


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
