"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit verification.

Texts and benchmark items are sequences of words (lower case, ASCII marks and Unicode
punctuation as white space). Items mostly in scripts written without spaces, and items of
under ``MIN_WORDS`` words but many code points, are sequences of characters
instead; they have an index of their own, for which documents are read by character too
(item_words, distance and end_word then count characters). Items that are shorter
still are matched exactly, as a run of whole words (of characters in scripts
without spaces). A document holds an item if some passage of it is within
``1 - SIMILARITY`` of the item's length in word edits (insertions, deletions,
replacements). To find such passages, items are classed by length; a class has
a window a little shorter than its items and a stride, so that any passage of
an item contains a whole document window, and items are indexed at every offset.

A window is embedded by CGK random walks: at each step the walk emits the word
it stands on and moves on or stays by a random bit of (step, word). Windows
within few edits fall back into step and agree on most emitted words, so edit
distance becomes Hamming distance. Each of ``WALKS`` walks is bit-sampled
``SAMPLES`` times at ``TAKE`` steps; windows that agree on one sample are
candidates, and a bit-parallel edit distance over the whole item decides. An
unchanged passage is always found; the recall for edited ones is measured in
the tests.

Two counts spare most windows the walks without losing a match: within a match
of at most k edits, a window of w words has at least w - k words and w - 1 - 2k
adjacent pairs that occur in the benchmark. Words outside the benchmark's
vocabulary are one symbol, which no item has, so distances stay exact.

The benchmark is cut into blocks of about ``BLOCK_WORDS`` words; a block's index
is what goes to the tasks. A larger benchmark takes more passes over the
documents, one per block. Texts never move: each is judged where it is read.

Cases: a null or empty text holds nothing; items without a word are in no text,
null items too; items that repeat are
each reported; repeated rows and ids, empty tables and extra columns are
ordinary.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

SIMILARITY, MIN_WORDS = 0.8, 5
#: Least characters of an item that is searched by character.
MIN_CHARS, MIN_UNSPACED = 20, 10
#: Ratio of item lengths within a class; walks, samples of a walk, steps of a sample, seed.
GROWTH, WALKS, SAMPLES, TAKE, SEED = 1.2, 4, 6, 4, 42
#: Benchmark words in a block; document words handled at once in a task.
BLOCK_WORDS, CHUNK_WORDS = 500_000, 400_000
_PAIRS = 1 << 22

_MARKS = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


#: Code points beyond ASCII that separate words: punctuation and separators.
_SPACED = np.array([128 <= c < 0x20000 and unicodedata.category(chr(c))[0] in "PZ" for c in range(0x110000)])
#: Thai, Lao, Myanmar, Khmer, kana, Han.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


def words_of(text: str) -> list[bytes]:
    if not text.isascii():
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
        if (marks := _SPACED[points]).any():
            text = np.where(marks, np.uint32(32), points).astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
    return text.lower().encode().translate(_MARKS).split()


def chars_of(text: str) -> list[str]:
    return list(b"".join(words_of(text)).decode())


def by_character(text: str) -> bool:
    """Is an item searched by character: few words, or mostly in a script without spaces."""
    n = len(chars_of(text))
    if unspaced(text):
        return n >= MIN_UNSPACED
    return n >= MIN_CHARS and len(words_of(text)) < MIN_WORDS


def unspaced(text: str) -> bool:
    return 2 * len(_UNSPACED.findall(text)) > len(chars_of(text))


def edits_allowed(n: int) -> int:
    return math.floor((1 - SIMILARITY) * n + 1e-9)


def infix_distance(masks: dict[int, int], n: int, text: list[int]) -> tuple[int, int]:
    """Least edit distance of an item to any stretch of ``text`` and where that ends (bit-parallel columns)."""
    full, top = (1 << n) - 1, 1 << (n - 1)
    plus, minus, score, best = full, 0, n, (n, 0)
    for at, sym in enumerate(text, 1):
        eq = masks.get(sym, 0)
        down = eq | minus
        flat = (((eq & plus) + plus) ^ plus) | eq
        up, low = minus | (full & ~(flat | plus)), plus & flat
        if up & top:
            score += 1
        elif low & top:
            score -= 1
        up, low = (up << 1) & full, (low << 1) & full
        plus, minus = low | (full & ~(down | up)), up & down
        if score < best[0]:
            best = (score, at)
    return best


class _Class:
    """Items of nearly one length: window, stride, most edits and the LSH index."""

    def __init__(self, shortest: int, longest: int):
        self.stride = max(1, shortest // 5)
        self.window = shortest - self.stride + 1
        self.edits = edits_allowed(longest)
        self.steps = 2 * self.window
        self.keys: list[np.ndarray] = []  # of each sample, ascending
        self.owner: list[np.ndarray] = []  # (item, offset) rows beside them


class Index:
    """Vocabulary, items and length classes of one block of the benchmark."""

    def __init__(self, rows: list[tuple[int, str]], chars: bool = False):
        self.units = chars_of if chars else words_of
        self.vocab: dict[bytes | str, int] = {}
        self.items: list[tuple[int, np.ndarray, dict[int, int]]] = []
        for item_id, text in rows:
            w = self.units(text or "")
            if by_character(text or "") == chars and len(w) >= MIN_WORDS:
                seq = np.array([self.vocab.setdefault(x, len(self.vocab) + 1) for x in w], dtype=np.int64)
                masks: dict[int, int] = {}
                for k, sym in enumerate(seq.tolist()):
                    masks[sym] = masks.get(sym, 0) | 1 << k
                self.items.append((item_id, seq, masks))
        rng = np.random.default_rng(SEED)
        self.hash = rng.integers(0, 2**64, len(self.vocab) + 1, dtype=np.uint64)
        self.pairs = np.zeros(_PAIRS, dtype=bool)
        for _, seq, _ in self.items:
            self.pairs[self._pair(seq)] = True
        self.classes: list[_Class] = []
        by_length = sorted(range(len(self.items)), key=lambda i: (len(self.items[i][1]), i))
        while by_length:
            shortest = len(self.items[by_length[0]][1])
            own = [i for i in by_length if len(self.items[i][1]) <= max(shortest, int(shortest * GROWTH))]
            by_length = by_length[len(own):]
            cls = _Class(shortest, len(self.items[own[-1]][1]))
            cls.factors = rng.integers(0, 2**63, (WALKS, cls.steps), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
            cls.picks = np.stack([np.sort(rng.choice(cls.steps, min(TAKE, cls.steps), replace=False)) for _ in range(WALKS * SAMPLES)])
            self.classes.append(cls)
            seq = np.concatenate([self.items[i][1] for i in own])
            base = np.cumsum([0, *(len(self.items[i][1]) for i in own)])
            starts = np.concatenate([np.arange(base[k], base[k + 1] - cls.window + 1) for k in range(len(own))])
            where = np.searchsorted(base, starts, side="right") - 1
            owner = np.column_stack([np.array(own)[where], starts - base[where]])
            for keys in self._sampled(cls, seq, starts, starts + cls.window):
                order = np.argsort(keys, kind="stable")
                cls.keys.append(keys[order])
                cls.owner.append(owner[order])

    @staticmethod
    def _pair(seq: np.ndarray) -> np.ndarray:
        a, b = seq[:-1].astype(np.uint64), seq[1:].astype(np.uint64)
        return ((a * np.uint64(0x9E3779B97F4A7C15) + b * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(42)).astype(np.int64)

    def _sampled(self, cls: _Class, seq: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Iterator[np.ndarray]:
        """Keys of the windows for each sample of each walk."""
        hashes, last = self.hash[seq], len(seq) - 1
        for walk in range(WALKS):
            at, emitted = starts.copy(), np.empty((cls.steps, len(starts)), dtype=np.uint64)
            for step in range(cls.steps):
                inside = at < ends
                h = np.where(inside, hashes[np.minimum(at, last)], np.uint64(1))
                emitted[step] = h
                at += ((h * cls.factors[walk, step]) >> np.uint64(63)).astype(np.int64) & inside
            for pick in cls.picks[walk * SAMPLES:(walk + 1) * SAMPLES]:
                key = np.zeros(len(starts), dtype=np.uint64)
                for step in pick:
                    key = (key ^ emitted[step]) * np.uint64(0x9E3779B97F4A7C15)
                    key ^= key >> np.uint64(31)
                yield key

    def hits(self, seqs: list[np.ndarray]) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, distance, end) of every item that a text holds."""
        seq = np.concatenate(seqs) if seqs else np.empty(0, np.int64)
        if not len(seq) or not self.items:
            return
        base = np.cumsum([0, *map(len, seqs)])
        known = np.r_[0, np.cumsum(seq > 0)]
        pair = np.zeros(len(seq), dtype=bool)
        pair[:-1] = (seq[:-1] > 0) & (seq[1:] > 0) & self.pairs[self._pair(seq)]
        paired = np.r_[0, np.cumsum(pair)]
        seen: set[tuple[int, int, int]] = set()
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for cls in self.classes:
            # windows at every stride; the last ones of a text may be cut short
            lengths = np.diff(base)
            per = np.maximum(0, (lengths - (cls.window + 1) // 2) // cls.stride + 1) * (lengths >= (cls.window + 1) // 2)
            text = np.repeat(np.arange(len(seqs)), per)
            starts = base[text] + (np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)) * cls.stride
            ends = np.minimum(starts + cls.window, base[text + 1])
            size = ends - starts
            ok = (known[ends] - known[starts] >= size - cls.edits) & (paired[ends - 1] - paired[starts] >= size - 1 - 2 * cls.edits)
            text, starts, ends = text[ok], starts[ok], ends[ok]
            if not len(starts):
                continue
            for sample, keys in enumerate(self._sampled(cls, seq, starts, ends)):
                table_, owner = cls.keys[sample], cls.owner[sample]
                lo, hi = np.searchsorted(table_, keys, "left"), np.searchsorted(table_, keys, "right")
                for k in np.flatnonzero(hi > lo):
                    for item, offset in owner[lo[k]:hi[k]].tolist():
                        t, first = int(text[k]), int(starts[k]) - offset
                        mark = (t, item, first)
                        if mark in seen or (t, item) in best and best[t, item][0] == 0:
                            continue
                        seen.add(mark)
                        _, own, masks = self.items[item]
                        slack = edits_allowed(len(own))
                        a, b = max(int(base[t]), first - slack), min(int(base[t + 1]), first + len(own) + slack)
                        if b - a < len(own) - slack:
                            continue
                        distance, end = infix_distance(masks, len(own), seq[a:b].tolist())
                        if distance <= slack:
                            found = (distance, a - int(base[t]) + end)
                            best[t, item] = min(best.get((t, item), found), found)
        for (t, item), (distance, end) in sorted(best.items()):
            yield t, item, distance, end

    def encode(self, text: str) -> np.ndarray:
        w = self.units(text)
        return np.fromiter(map(self.vocab.get, w, repeat(0)), dtype=np.int64, count=len(w))


def short(text: str) -> bool:
    """Is an item too short for either index: it is matched exactly."""
    return 0 < len(words_of(text)) < MIN_WORDS and not by_character(text)


class Short:
    """Short items of one block, matched as runs of whole words (or of characters)."""

    def __init__(self, rows: list[tuple[int, str]], chars: bool = False):
        self.units = chars_of if chars else words_of
        self.vocab: dict[bytes | str, int] = {}
        self.items: list[tuple[int, list[int], None]] = []
        self.by_first: dict[int, list[int]] = {}
        for item_id, text in rows:
            if short(text) and unspaced(text) == chars:
                seq = [self.vocab.setdefault(x, len(self.vocab) + 1) for x in self.units(text)]
                self.by_first.setdefault(seq[0], []).append(len(self.items))
                self.items.append((item_id, seq, None))
        self.firsts = np.zeros(len(self.vocab) + 1, dtype=bool)
        self.firsts[list(self.by_first)] = True

    encode = Index.encode

    def hits(self, seqs: list[np.ndarray]) -> Iterator[tuple[int, int, int, int]]:
        """(text, item, 0, end) of every item that a text holds, at its first place."""
        for t, seq in enumerate(seqs):
            seen: set[int] = set()
            for at in np.flatnonzero(self.firsts[seq]).tolist():
                for item in self.by_first[int(seq[at])]:
                    own = self.items[item][1]
                    if item not in seen and seq[at:at + len(own)].tolist() == own:
                        seen.add(item)
                        yield t, item, 0, at + len(own)


def _chunks(texts: pa.Array, index: Index | Short) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(row of the first text, texts) of about ``CHUNK_WORDS`` words."""
    first, held, n = 0, [], 0
    for t in texts:
        held.append(index.encode(t.as_py() or ""))
        n += len(held[-1])
        if n >= CHUNK_WORDS:
            yield first, held
            first, held, n = first + len(held), [], 0
    if held:
        yield first, held


def blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> Iterator[Index | Short]:
    """Indexes of the benchmark's blocks, one at a time."""
    items = benchmark.select("item_id", "text").where("text is not null")
    total = items.agg(F.sum(F.greatest(F.size(F.split("text", " ")), (F.length("text") / 6).cast("int")))).first()[0] or 0
    n = max(1, math.ceil(total / block_words))
    for k in range(n):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k)
        rows = sorted(map(tuple, part.collect()), key=lambda r: (r[0] is None, 0 if r[0] is None else r[0], r[1]))
        yield Index(rows)
        if any(by_character(text) for _, text in rows):
            yield Index(rows, chars=True)
        for chars in (False, True):
            if any(short(text) and unspaced(text) == chars for _, text in rows):
                yield Short(rows, chars)


def contaminated(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per document row and item that it holds: doc_id, item_id, item_words, distance, end_word."""
    id_type, item_type = (d.schema[c].dataType.simpleString() for d, c in ((docs, "doc_id"), (benchmark, "item_id")))
    rows, out = docs.select("doc_id", F.col("text").alias("_text")), None
    for index in blocks(benchmark, block_words):
        found = rows.mapInArrow(_report(docs.sparkSession.sparkContext.broadcast(index)), (
            f"doc_id {id_type}, item_id {item_type}, item_words int, distance int, end_word int"))
        out = found if out is None else out.unionByName(found)
    return out


def _report(shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = shared.value
        for b in batches:
            got = [(first + t, item, d, end) for first, seqs in _chunks(b.column("_text"), index) for t, item, d, end in index.hits(seqs)]
            if got:
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(pa.array([g[0] for g in got])), pa.array([index.items[g[1]][0] for g in got]),
                     pa.array([len(index.items[g[1]][1]) for g in got], pa.int32()), pa.array([g[2] for g in got], pa.int32()),
                     pa.array([g[3] for g in got], pa.int32())],
                    names=["doc_id", "item_id", "item_words", "distance", "end_word"])
    return run


def _clean(shared) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = shared.value
        for b in batches:
            keep = np.ones(b.num_rows, dtype=bool)
            for first, seqs in _chunks(b.column("text"), index):
                keep[[first + t for t, *_ in index.hits(seqs)]] = False
            yield b.filter(pa.array(keep))
    return run


def decontaminate(docs: DataFrame, benchmark: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item."""
    out, context = docs, docs.sparkSession.sparkContext
    for index in blocks(benchmark, block_words):
        out = out.mapInArrow(_clean(context.broadcast(index)), docs.schema)
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
