"""Quality rules: isolation forest on rule statistics, calibrated on labelled rows.

Each text gives a row of rule statistics (words, symbols, repeated lines and
word windows, letter case, ...). Two base rules reject on their own. Beyond
them an isolation forest judges the row: trees of random splits are grown on
samples of the labelled good rows, and a row that few splits isolate is
anomalous (short mean path, score near 1). The score above which a document is
rejected comes from the scores of all labelled rows: of the cuts that keep at
least ``KEEP`` of the good rows, the one that rejects most bad rows.

Rows that fail a base rule take no part in the forest or its calibration. The
forest is fitted on at most ``FIT_ROWS`` distinct labelled good rows, those
whose hash is below a threshold; this bound is the only sample. Statistics, scores and the
calibration histogram (``BINS`` rows per label) cover all rows. The fitted
trees are ``TREES`` x 1023 nodes whatever the input, and go to the tasks with
the function that uses them.

Cases: a null text has no words; an empty text fails the base rule on words;
labels of one id that disagree count as good; labels without a document and
null ids are ignored; without labelled good rows there is no forest and the
base rules decide; repeated rows, empty tables and extra columns are ordinary
(columns named like the operator's own are replaced).
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import written
from .common import table

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
#: Most labelled rows that the forest is fitted on; trees, rows per tree, seed.
FIT_ROWS, TREES, SAMPLE, SEED = 20_000, 100, 256, 42
#: Splits on a path at most.
DEPTH = 9
#: Share of labelled good rows that the cut keeps; bins of the calibration histogram.
KEEP, BINS = 0.995, 1000

_SPACE, _SYMBOLS = b" \t\n\r\x0b\x0c", b"#*$%&|<>"
_LETTERS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = ("mean_word", "symbols", "dup_lines", "distinct", "capitals")
OWN = (*COUNTS, "base_failed", "anomaly", "kept")


def repeated_words(words: list[bytes], size: int = WINDOW) -> int:
    """Words inside windows of ``size`` words that occur twice or more in the text."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    ids: dict[bytes, int] = {}
    seq = np.fromiter((ids.setdefault(w, len(ids)) for w in words), dtype=np.uint64, count=len(words))
    if len(ids) == len(words):
        return 0
    mixed = (seq + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    h = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        h = h * np.uint64(0x100000001B3) + mixed[k:k + n]
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    if not same.any():
        return 0
    at = np.unique(np.r_[order[1:][same], order[:-1][same]])  # equal hashes: compare the windows themselves
    rows = seq[at[:, None] + np.arange(size)]
    _, group, count = np.unique(rows, axis=0, return_inverse=True, return_counts=True)
    at = at[count[group.ravel()] > 1]
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + size, -1)
    return int(np.count_nonzero(np.cumsum(edge[:-1])))


def _without(text: bytes, drop: bytes) -> int:
    return len(text) - len(text.translate(None, drop))


def statistics(text: bytes, chars: int) -> tuple[tuple[int, ...], tuple[float, ...]]:
    """Counts and forest features of a UTF-8 text of so many code points."""
    words = text.split()
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    n, distinct = len(words), len(set(words))
    word_chars = chars - _without(text, _SPACE)
    dup = len(lines) - len(set(lines))
    repeat = repeated_words(words)
    symbols = _without(text, _SYMBOLS)
    return (n, word_chars, symbols, dup, repeat), (
        word_chars / max(1, n), math.sqrt(symbols / max(1, word_chars)), dup / max(1, len(lines)),
        distinct / max(1, n) ** 0.8, math.sqrt(_without(text, _LETTERS) / max(1, word_chars)))


def _measure(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    rows = [statistics(t.as_py() or b"", c.as_py() or 0) for t, c in zip(batch.column("_text"), batch.column("_chars"))]
    counts = np.array([r[0] for r in rows], dtype=np.int64).reshape(-1, len(COUNTS))
    return counts, np.array([r[1] for r in rows], dtype=np.float64).reshape(-1, len(FEATURES))


def _base_failed(counts: np.ndarray) -> np.ndarray:
    return (counts[:, 0] < MIN_WORDS) | (100 * counts[:, 4] > MAX_REPEAT_PERCENT * counts[:, 0])


# ------------------------------------------------------------------ forest
def _mean_path(n: float) -> float:
    """Mean path length of an unsuccessful search in a binary tree of n rows."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (math.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def grow(x: np.ndarray, low: np.ndarray, high: np.ndarray, trees: int = TREES, sample: int = SAMPLE, seed: int = SEED) -> dict[str, np.ndarray]:
    """Trees as arrays (tree, node) of a complete binary tree: feature (-1: leaf), split, path length at a leaf.

    Splits are drawn from the node's box within ``low`` to ``high``, the range of all labelled rows, so that
    a value no good row has is cut off even where all good rows are alike.
    """
    rng = np.random.default_rng(seed)
    size = min(sample, len(x))
    nodes = 2 ** (DEPTH + 1) - 1
    feature = np.full((trees, nodes), -1, dtype=np.int8)
    split, path = np.zeros((trees, nodes), dtype=np.float32), np.zeros((trees, nodes), dtype=np.float32)
    for t in range(trees):
        todo = [(0, 0, x[rng.choice(len(x), size, replace=False)], low, high)]
        while todo:
            node, level, rows, lo, hi = todo.pop()
            free = np.flatnonzero(hi > lo)
            if level == DEPTH or len(rows) < 2 or not len(free):
                path[t, node] = level + _mean_path(len(rows))
                continue
            f = int(rng.choice(free))
            cut = np.float32(rng.uniform(lo[f], hi[f]))
            feature[t, node], split[t, node] = f, cut
            right = rows[:, f] >= cut
            below, above = hi.copy(), lo.copy()
            below[f] = above[f] = cut
            todo += [(2 * node + 1, level + 1, rows[~right], lo, below), (2 * node + 2, level + 1, rows[right], above, hi)]
    return {"feature": feature, "split": split, "path": path, "norm": np.array(max(1.0, _mean_path(size)))}


def score(forest: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """Anomaly score in (0, 1); rows beyond the range that the trees know end at its edge."""
    total, rows = np.zeros(len(x)), np.arange(len(x))
    for feature, split, path in zip(forest["feature"], forest["split"], forest["path"]):
        node = np.zeros(len(x), dtype=np.int64)
        for _ in range(DEPTH):
            f = feature[node].astype(np.int64)
            node = np.where(f < 0, node, 2 * node + 1 + (x[rows, f] >= split[node]))
        total += path[node]
    return 2.0 ** (-total / len(forest["feature"]) / float(forest["norm"]))


def fit(stats: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> tuple[dict[str, np.ndarray] | None, float]:
    """Forest and cut from a table of statistics (doc_id, FEATURES) and labels (doc_id, quality)."""
    truth = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    passed = (F.col("n_words") >= MIN_WORDS) & (100 * F.col("n_repeat_words") <= MAX_REPEAT_PERCENT * F.col("n_words"))
    known = written(stats.where(passed).join(truth, "doc_id").select("doc_id", "quality", *FEATURES), "quality-labelled")
    good = written(known.where("quality = 1").select("doc_id", *FEATURES).distinct().withColumn(
        "_at", F.shiftrightunsigned(F.xxhash64("doc_id", *FEATURES), 11) / F.lit(2.0 ** 53)), "quality-good")
    n = good.count()
    if not n:
        return None, 1.0
    # a hash threshold picks the sample where the rows are: no sort, and no more than the sample leaves the tasks
    good = sorted(tuple(r) for r in good.where(F.col("_at") * n < 0.95 * fit_rows if n > fit_rows else F.lit(True)).select("_at", *FEATURES).collect())
    good = [r[1:] for r in good[:fit_rows]]
    edges = known.agg(*[F.min(f) for f in FEATURES], *[F.max(f) for f in FEATURES]).first()
    low, high = np.array(edges, dtype=np.float64).reshape(2, -1)
    forest = grow(np.array(good, dtype=np.float64), low, high)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.column_stack([b.column(f).to_numpy() for f in FEATURES])
            at = np.minimum(BINS - 1, (score(forest, x) * BINS).astype(np.int32)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([b.column("quality"), pa.array(at)], names=["quality", "bin"])

    quality = known.schema["quality"].dataType.simpleString()
    hist = known.mapInArrow(scored, f"quality {quality}, bin int").groupBy("bin").agg(
        F.sum((F.col("quality") == 1).cast("long")).alias("good"), F.sum((F.col("quality") != 1).cast("long")).alias("bad")).collect()
    good_at, bad_at = np.zeros(BINS + 1), np.zeros(BINS + 1)
    for r in hist:
        good_at[r["bin"]], bad_at[r["bin"]] = r["good"], r["bad"]
    lost, caught = good_at[::-1].cumsum()[::-1], bad_at[::-1].cumsum()[::-1]  # rejected if the bin is k or above
    fits = np.flatnonzero((lost <= (1 - KEEP) * good_at.sum()) & (caught > 0))
    if not len(fits):
        return forest, 1.0
    best = max(fits, key=lambda k: (caught[k], k))  # most bad rows, then the mildest cut
    return forest, float(best / BINS)


def _judge(forest: dict[str, np.ndarray] | None, cut: float, counts: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, ...]:
    failed = _base_failed(counts)
    anomaly = np.zeros(len(x)) if forest is None else score(forest, x)
    return failed, anomaly, ~failed & ((forest is None) | (anomaly < cut))


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, counts and features of every row, written once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts, x = _measure(b)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *map(pa.array, counts.T), *map(pa.array, x.T)], names=["doc_id", *COUNTS, *FEATURES])

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, " + ", ".join(
        [f"{c} long" for c in COUNTS] + [f"{f} double" for f in FEATURES])
    rows = docs.select("doc_id", F.col("text").cast("binary").alias("_text"), F.length("text").alias("_chars"))
    return written(rows.mapInArrow(run, schema), "quality-stats")


def judge_all(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Statistics and verdict of every row of ``docs`` (no texts)."""
    stats = measured(docs)
    forest, cut = fit(stats, labels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts = np.column_stack([b.column(c).to_numpy() for c in COUNTS])
            verdict = _judge(forest, cut, counts, np.column_stack([b.column(f).to_numpy() for f in FEATURES]))
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in ("doc_id", *COUNTS)] + [pa.array(verdict[k]) for k in (0, 2, 1)],
                names=["doc_id", *COUNTS, "base_failed", "kept", "anomaly"])

    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, " + ", ".join(f"{c} long" for c in COUNTS)
    return stats.mapInArrow(run, schema + ", base_failed boolean, kept boolean, anomaly double")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep. Texts are read twice and never shuffled."""
    forest, cut = fit(measured(docs), labels)
    cols = [F.col(c).alias(f"_doc_{c}") for c in docs.columns]
    rows = docs.select(*cols, F.col("text").cast("binary").alias("_text"), F.length("text").alias("_chars"))
    out = StructType([f for f in rows.schema if f.name.startswith("_doc_")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept = _judge(forest, cut, *_measure(b))[2]
            yield b.select(out.names).filter(pa.array(kept))

    return rows.mapInArrow(run, out).select(*[F.col(f"_doc_{c}").alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge_all(docs, table(spark, sf_dir, "labels"))
