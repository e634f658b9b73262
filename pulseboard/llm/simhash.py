"""SimHash near-duplicates: BK-trees over shards of the distinct fingerprints.

Every text gets a 64-bit fingerprint of its word shingles (per-text numpy, no
shuffle). Distinct fingerprints are then sharded so that a tree only ever holds
fingerprints that can match: with ``radius + 2`` equal segments, two
fingerprints at ``radius`` or fewer differing bits agree on at least two whole
segments, so each goes to one shard per pair of segments, keyed by their bits.
A shard's BK-tree hangs children under the integer Hamming distance to their
parent; a search follows only the edges from ``d - radius`` to ``d + radius``.

The shard trees reach their queries by a shuffle, not by a broadcast: sending
all trees through the driver would gather the fingerprints of all documents
there. The members of a shard agree on its bits, so matches differ in the other
bits only: a shard over ``SPLIT`` fingerprints is cut by ``radius + 1`` strips of
the bits that it leaves free (a match agrees on one of them at least), and this is
repeated while a part is too large, so a group of near copies spreads over many trees. A
tree yields the links that join its members into components (a star each), not
all pairs; stars of all shards are merged by alternating large-star and
small-star steps, each written to the shared folder.

Cases: a null or empty text, or one of white space, has fingerprint zero, which
links like any other; null ids are ignored when the smallest id is taken (a
component of null ids has a null component_id); repeated rows and ids, empty
tables and extra columns are ordinary.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import written
from .common import table

SHINGLE, RADIUS, SEED = 3, 2, 42
#: Fingerprints in a shard beyond which it is split by the bits that it leaves free.
SPLIT = 2048


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Unsigned SimHash of a UTF-8 text (bytes.lower and bytes.split treat ASCII only, as wanted)."""
    words = text.lower().split()
    if not words:
        return 0
    grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    h = np.fromiter((xxhash.xxh64_intdigest(g, SEED) for g in grams), dtype="<u8")
    ones = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.fromiter((fingerprint(t or b"", shingle) for t in (x.as_py() for x in b.column("_text"))),
                              dtype=np.uint64, count=b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("_th"), pa.array(fps.view(np.int64))],
                                             names=["doc_id", "_th", "_fp"])
    return run


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, _th: hash of the text, _fp: signed fingerprint) of every row, written once."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.xxhash64("text").alias("_th"), F.col("text").cast("binary").alias("_text"))
    return written(rows.mapInArrow(_fingerprints(shingle), f"doc_id {id_type}, _th long, _fp long"), "simhash-fp")


class BKTree:
    """Children keyed by their integer Hamming distance to the parent."""

    def __init__(self) -> None:
        self.root: tuple[int, dict] | None = None

    def near(self, fp: int, radius: int) -> list[int]:
        out, todo = [], [self.root] if self.root else []
        while todo:
            at, children = todo.pop()
            d = (at ^ fp).bit_count()
            if d <= radius:
                out.append(at)
            todo += [children[k] for k in range(max(1, d - radius), d + radius + 1) if k in children]
        return out

    def add(self, fp: int) -> None:
        if self.root is None:
            self.root = (fp, {})
            return
        at = self.root
        while (d := (at[0] ^ fp).bit_count()):
            if d not in at[1]:
                at[1][d] = (fp, {})
                return
            at = at[1][d]


def star_links(fps: list[int], radius: int) -> list[tuple[int, int]]:
    """(fingerprint, smallest of its component) within one shard, by its tree."""
    tree, parent = BKTree(), {}

    def find(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for fp in fps:
        parent[fp] = fp
        for other in tree.near(fp, radius):
            a, b = find(fp), find(other)
            parent[max(a, b)] = min(a, b)
        tree.add(fp)
    return [(x, r) for x in fps if (r := find(x)) != x]


def _search(radius: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by shard; a shard may go on in the next batch."""
        key, fp = np.empty(0, np.int64), np.empty(0, np.uint64)
        for b in _with_end(batches):
            if b is not None:
                key = np.concatenate([key, b.column("_key").to_numpy()])
                fp = np.concatenate([fp, b.column("_fp").to_numpy().view(np.uint64)])
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.empty(0, int)
            ends = np.r_[starts[1:], len(key)].astype(int)
            if b is not None:  # the last shard may not be whole yet
                starts, ends, tail = starts[:-1], ends[:-1], int(starts[-1]) if len(starts) else 0
            else:
                tail = len(key)
            pairs: list[tuple[int, int]] = []
            for k in np.flatnonzero(ends - starts > 1):
                pairs += star_links(fp[starts[k]:ends[k]].tolist(), radius)
            key, fp = key[tail:], fp[tail:]
            if pairs:
                a = np.array(pairs, dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(a[:, 0]), pa.array(a[:, 1])], names=["u", "v"])
    return run


def _with_end(batches: Iterator) -> Iterator:
    yield from batches
    yield None


def _signed(mask: int) -> int:
    return mask - 2**64 if mask >= 2**63 else mask


def _cut(bits: list[int], n: int) -> list[int]:
    """Masks of ``n`` nearly equal runs of ``bits``."""
    at = [len(bits) * i // n for i in range(n + 1)]
    return [sum(1 << x for x in bits[p:q]) for p, q in zip(at, at[1:])]


def _parts(parts: list[tuple[int, int]], key: list[Column]) -> Column:
    """A (key, fixed bits) struct for each (mask of the bits in the key, mask of all bits that its members agree on)."""
    fp = F.col("_fp")
    return F.array(*[F.struct(F.xxhash64(*key, F.lit(i), fp.bitwiseAND(F.lit(_signed(m)).cast("long"))).alias("_key"),
                              F.lit(_signed(fixed)).cast("long").alias("_fixed")) for i, (m, fixed) in enumerate(parts)])


def shards(fps: DataFrame, radius: int = RADIUS, split: int = SPLIT) -> DataFrame:
    """(_fp, _key): each of the distinct ``fps`` in every shard that may hold a match of it; shards of one are left out."""
    segments = _cut(list(range(64)), radius + 2)
    masks = [a | b for a, b in combinations(segments, 2)]
    out = fps.select("_fp", F.inline(_parts([(m, m) for m in masks], [])))
    while True:
        sizes = written(out.groupBy("_key").count().where("count > 1"), "simhash-sizes")  # a fingerprint alone in its shard has no link there
        out = out.join(sizes, "_key")
        if sizes.where(F.col("count") > split).isEmpty():
            return out.select("_fp", "_key")
        strips = {m: _cut([b for b in range(64) if not m >> b & 1], radius + 1) for m in masks}
        whole = F.array(F.struct("_key", "_fixed"))
        finer = whole
        for m, own in strips.items():
            if m != 2**64 - 1:
                finer = F.when(F.col("_fixed") == F.lit(_signed(m)).cast("long"), _parts([(x, m | x) for x in own], [F.col("_key")])).otherwise(finer)
        again = F.when(F.col("count") > split, finer).otherwise(whole)
        out = written(out.select("_fp", F.inline(again)), "simhash-shards")
        masks = sorted({m | x for m, own in strips.items() for x in own} | set(masks))


def links(fps: DataFrame, radius: int = RADIUS, split: int = SPLIT) -> DataFrame:
    """Star links (u, v) that join all of the distinct ``fps`` (_fp) at ``radius`` or fewer differing bits."""
    dealt = shards(fps, radius, split)
    found = dealt.repartition("_key").sortWithinPartitions("_key", "_fp").mapInArrow(_search(radius), "u long, v long")
    return written(found.distinct(), "simhash-links")


def components(edges: DataFrame) -> DataFrame:
    """(u, v): every linked node u but the smallest of its component, with that smallest node v."""
    def smallest(e: DataFrame) -> DataFrame:
        return e.groupBy("u").agg(F.min("v").alias("m"))

    e = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        m = smallest(both).withColumn("m", F.least("u", "m"))
        large = both.join(m, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        j = large.join(smallest(large), "u")
        small = j.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            j.select("u", F.col("m").alias("v"))).distinct()
        e = written(small, "simhash-stars")
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
        if now == before:
            return e
        before = now


def linked(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, _th, _fp, _root, component_id) of every row; _root names the component."""
    rows = fingerprints(docs, shingle)
    fps = written(rows.groupBy("_fp").agg(F.min("doc_id").alias("_first")), "simhash-distinct")
    roots = components(links(fps.select("_fp"), radius))
    fps = fps.join(roots.withColumnsRenamed({"u": "_fp", "v": "_root"}), "_fp", "left").withColumn("_root", F.coalesce("_root", "_fp"))
    smallest = fps.groupBy("_root").agg(F.min("_first").alias("component_id"))
    return rows.join(fps.select("_fp", "_root").join(smallest, "_root"), "_fp")


def dedup(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row of ``docs`` of every component: that of the smallest id (null last), then of the smallest text hash.

    Rows that share id and text are told apart by their other columns; the smallest stays.
    """
    rows = written(linked(docs, shingle, radius), "simhash-linked")
    order = F.struct(F.col("doc_id").isNull().alias("n"), "doc_id", "_th")
    keys = rows.groupBy("doc_id", "_th").count()
    keeper = rows.groupBy("_root").agg(F.min(order).alias("k")).select(F.col("k.doc_id").alias("_kid"), F.col("k._th").alias("_kth"))
    # id and text hash name the component too, so no join has to bring a large component together
    judged = keys.join(keeper, F.col("doc_id").eqNullSafe(F.col("_kid")) & (F.col("_th") == F.col("_kth")), "left")
    judged = written(judged.select(
        F.col("doc_id").alias("_jid"), F.col("_th").alias("_jth"), F.col("_kth").isNotNull().alias("_stays"), "count"), "simhash-judged")

    named = docs.select(*[F.col(c).alias(f"_doc_{c}") for c in docs.columns]).withColumn("_th", F.xxhash64("_doc_text"))
    match = F.col("_doc_doc_id").eqNullSafe(F.col("_jid")) & (F.col("_th") == F.col("_jth"))
    kept = named.join(judged.where(~F.col("_stays")), match, "left_anti")
    again = judged.where(F.col("_stays") & (F.col("count") > 1))
    if not again.isEmpty():
        whole = F.min(F.struct(*[f"_doc_{c}" for c in docs.columns])).alias("w")
        one = named.join(again, match, "left_semi").groupBy("_doc_doc_id", "_th").agg(whole).select("w.*")
        kept = kept.join(again, match, "left_anti").drop("_th").unionByName(one)
    return kept.select(*[F.col(f"_doc_{c}").alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = linked(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", F.lpad(F.lower(F.hex("_fp")), 16, "0").alias("fingerprint"), "component_id")
