"""License scan: MinHash bands over overlapping windows retrieve templates, exact shingle containment verifies.

Texts and license templates are words (lower case, anything but letters and
digits as white space) and their five-word shingles. A template of m shingles
is looked for in windows of ``c`` shingles, the power of two from ``2 m`` up,
at every multiple of ``c / 2``: any place where the template stands lies wholly
in one of them. A template contained to ``CONTAINMENT`` has a Jaccard
similarity of at least 0.8 / 4.2 with its window, so with ``BANDS`` bands of
one MinHash value each the chance that no band collides is at most
(1 - 0.8 / 4.2) ** 32 < 0.2 %.

A band collides if a window's smallest value under the band's hash is the
template's. That value belongs to one shingle of the template, so only windows
that hold such a shingle need to be looked at. The templates are compiled once, on the driver,
into these shingles (a bounded table); the scan keeps the places of a text that
hold one, cuts the windows around them out of the same row, and compares their
smallest values: no text is shuffled and no window is built that could not collide. Windows
that collide are verified: the share of the template's shingles, as text, that
the window has, must reach ``CONTAINMENT``. Phrases under five words, such as
SPDX tags, have no shingle and are matched whole. All steps are built-in functions.

The query scans for the table of ``license_table``: whole license texts,
headers, titles, notices and tags, with naming words. ``report`` asks that each naming word stand in a
matched shingle, and where templates of several licenses match the same
shingles of a text, they go to the one with most matched shingles, then the
best containment; a match is reported if it has over half of its shingles.

Cases: a null text has no license; one under five words can only hold a short
phrase; rows that repeat an id are one document; a license found many times in
a document is one row, with the best containment, its windows counted and its
first word; empty tables give no rows; extra columns are ignored. A text is
handled whole: a row holds its words.
"""

from __future__ import annotations

import json
import struct
from collections import defaultdict
from dataclasses import dataclass, field

import regex
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table
from .license_table import license_templates

SHINGLE, CONTAINMENT, BANDS = 5, 0.8, 32
#: Rows that the compiled templates may have to be sent to every task.
MOST_ROWS = 500_000


def _signed(h: int) -> int:
    return h - 2**64 if h >= 2**63 else h


def _hash(*values: str) -> int:
    """``F.xxhash64`` of strings."""
    h = 42
    for v in values:
        h = xxhash.xxh64_intdigest(v.encode(), h)
    return _signed(h)


def _in_band(h: int, band: int) -> int:
    """``F.xxhash64(F.lit(band), h)`` of a shingle's hash."""
    return _signed(xxhash.xxh64_intdigest(struct.pack("<q", h), xxhash.xxh64_intdigest(struct.pack("<i", band), 42)))


def plain_words(text: str) -> list[str]:
    return regex.sub(r"[^\p{L}\p{N}]+", " ", text.lower()).split()


@dataclass
class Compiled:
    """Templates as rows: ``spots`` (shingle hash, window size), ``bands`` (shingle hash, size, template, band),
    ``templates`` (template, license, size, shingles, naming shingles) and ``phrases`` (hash, words, license)."""

    spots: list[tuple] = field(default_factory=list)
    bands: list[tuple] = field(default_factory=list)
    templates: list[tuple] = field(default_factory=list)
    phrases: list[tuple] = field(default_factory=list)
    first_words: list[str] = field(default_factory=list)


def compile_templates(templates) -> Compiled:
    """From (license, text[, naming words])."""
    out, spots = Compiled(), set()
    for tid, (license_, text, *names) in enumerate(dict.fromkeys((n, t, *map(tuple, rest)) for n, t, *rest in templates)):
        w = plain_words(text)
        if not w:
            continue
        if len(w) < SHINGLE:
            out.phrases.append((_hash(*w), len(w), license_))
            out.first_words.append(w[0])
            continue
        grams = {_hash(*w[k:k + SHINGLE]): " ".join(w[k:k + SHINGLE]) for k in range(len(w) - SHINGLE + 1)}
        size = 1 << (2 * len(grams) - 1).bit_length()
        named = [[g for g in grams.values() if f" {name} " in f" {g} "] for name in (names[0] if names else ())]
        out.templates.append((tid, license_, size, list(grams.values()), named))
        by_spot = defaultdict(list)
        for band in range(BANDS):
            by_spot[min(grams, key=lambda h: _in_band(h, band))].append(band)
        spots |= {(h, size) for h in by_spot}
        out.bands += [(h, size, tid, bands) for h, bands in by_spot.items()]
    out.spots = sorted(spots)
    out.phrases = sorted(set(out.phrases))
    out.first_words = sorted(set(out.first_words))
    if len(out.bands) > MOST_ROWS:
        raise ValueError(f"{len(out.bands)} rows of compiled templates are too many to send to every task; scan for fewer at a time")
    return out


def _literal(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """Rows of a small table, from one literal."""
    names = [c.split()[0] for c in schema.split(", ")]
    text = json.dumps([dict(zip(names, r)) for r in rows])
    fields = ",".join(c.replace(" ", ":", 1) for c in schema.split(", "))
    return spark.range(1).select(F.inline(F.from_json(F.lit(text), f"array<struct<{fields}>>")))


def words(text: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), " ")


def _gram_hash(w: str, n: int) -> str:
    return f"xxhash64({', '.join(f'get({w}, i + {k})' for k in range(n))})"


def _spots(w: str, n: int, wanted: list[int]) -> Column:
    """(at, h) of the places of the words ``w`` whose n-word hash is wanted."""
    listed = ", ".join(f"{h}L" if h != -(2**63) else "(-9223372036854775807L - 1L)" for h in wanted)
    every = f"transform(sequence(0, size({w}) - {n}), i -> struct(i as at, {_gram_hash(w, n)} as h))"
    return F.expr(f"case when size({w}) >= {n} then filter({every}, x -> {f'x.h in ({listed})' if wanted else 'false'}) else array() end")


def candidates(docs: DataFrame, compiled: Compiled) -> DataFrame:
    """Windows that collide with a template in a band: doc_id, _row (hash of the text), tid, _start, _window (its words)."""
    spark = docs.sparkSession
    d = docs.select("doc_id", F.xxhash64("text").alias("_row"), words(F.col("text")).alias("_words"))
    at = d.select("doc_id", "_row", "_words", F.inline(_spots("_words", SHINGLE, sorted({h for h, _ in compiled.spots})))).withColumnsRenamed(
        {"at": "_pos", "h": "_h"})
    sizes = F.broadcast(_literal(spark, compiled.spots, "spot bigint, size int"))  # bounded by MOST_ROWS
    at = at.join(sizes, F.col("_h") == F.col("spot")).withColumn("_half", (F.col("size") / 2).cast("int"))
    last = F.floor(F.col("_pos") / F.col("_half")).cast("int") * F.col("_half")
    at = at.withColumn("_start", F.explode(F.when(last > 0, F.array(last - F.col("_half"), last)).otherwise(F.array(last))))
    windows = at.select("doc_id", "_row", "_h", F.col("size").alias("_size"), "_start",
                        F.slice("_words", F.col("_start") + 1, F.col("size") + SHINGLE - 1).alias("_window"))
    bands = F.broadcast(_literal(spark, compiled.bands, "spot bigint, size int, tid int, bands array<int>"))
    met = windows.join(bands, (F.col("_h") == F.col("spot")) & (F.col("_size") == F.col("size")))
    hashes = f"transform(sequence(0, size(_window) - {SHINGLE}), i -> {_gram_hash('_window', SHINGLE)})"
    smallest = f"exists(bands, b -> forall({hashes}, x -> xxhash64(b, x) >= xxhash64(b, _h)))"
    return met.where(F.expr(smallest)).select("doc_id", "_row", "tid", "_start", "_window")


def _found(docs: DataFrame, compiled: Compiled, containment: float) -> DataFrame:
    """Verified windows: doc_id, _row, license, _tid, _size, _start, _at (places of the matched shingles), containment."""
    spark = docs.sparkSession
    facts = F.broadcast(_literal(spark, compiled.templates, "tid int, license string, size int, own array<string>, named array<array<string>>"))
    grams = f"transform(sequence(0, size(_window) - {SHINGLE}), i -> struct(i as i, concat_ws(' ', slice(_window, i + 1, {SHINGLE})) as g))"
    seen = candidates(docs, compiled).join(facts, "tid").withColumn("_grams", F.expr(grams))
    seen = seen.withColumn("_both", F.array_intersect("own", F.expr("transform(_grams, x -> x.g)")))
    share = F.size("_both") / F.size("own")
    at = F.expr("transform(filter(_grams, x -> array_contains(_both, x.g)), x -> x.i + _start)")
    verified = seen.where((share >= containment - 1e-9) & F.expr("forall(named, n -> arrays_overlap(n, _both))")).select(
        "doc_id", "_row", "license", F.col("tid").alias("_tid"), F.col("size").alias("_size"), "_start", at.alias("_at"), share.alias("containment"))
    # a window that collides by several shingles is one
    key = [c for c in verified.columns if c not in ("_at", "containment")]
    found = verified.groupBy(*key).agg(F.first("_at").alias("_at"), F.first("containment").alias("containment"))
    if compiled.phrases:
        found = found.unionByName(_phrases(docs, compiled))
    return found


def _phrases(docs: DataFrame, compiled: Compiled) -> DataFrame:
    """Phrases of fewer words than a shingle, matched whole; only texts that hold a first word are looked at."""
    spark = docs.sparkSession
    d = docs.where(F.lower("text").rlike("|".join(compiled.first_words))).select(
        "doc_id", F.xxhash64("text").alias("_row"), words(F.col("text")).alias("_words"))
    lengths = sorted({n for _, n, _ in compiled.phrases})

    def of_length(n: int) -> Column:
        return F.transform(_spots("_words", n, [h for h, m, _ in compiled.phrases if m == n]), lambda x: F.struct(x["at"], x["h"], F.lit(n).alias("n")))

    every = F.concat(*[of_length(n) for n in lengths])
    known = F.broadcast(_literal(spark, compiled.phrases, "phrase bigint, length int, license string"))
    at = d.select("doc_id", "_row", F.inline(every)).join(known, (F.col("h") == F.col("phrase")) & (F.col("n") == F.col("length")))
    return at.select("doc_id", "_row", "license", (-F.col("length")).alias("_tid"), F.col("length").alias("_size"), F.col("at").alias("_start"),
                     F.array("at").alias("_at"), F.lit(1.0).alias("containment")).distinct()


def _licenses(found: DataFrame) -> DataFrame:
    return found.groupBy("doc_id", "license").agg(
        F.max("containment").alias("containment"), F.countDistinct("_start", "_size").alias("n_windows"),
        F.min("_start").cast("long").alias("first_word"))


def scan(docs: DataFrame, templates, containment: float = CONTAINMENT) -> DataFrame:
    """(doc_id, license, containment, n_windows, first_word) of every template found; ``templates``: (license, text[, naming words])."""
    return _licenses(_found(docs, compile_templates(templates), containment))


def report(docs: DataFrame, templates, containment: float = CONTAINMENT) -> DataFrame:
    """As ``scan``, but each place goes to the license that fits it best."""
    at = _found(docs, compile_templates(templates), containment).withColumn("_n", F.size("_at")).withColumn("_pos", F.explode("_at"))
    best = Window.partitionBy("doc_id", "_row", "_pos").orderBy(F.desc("_n"), F.desc("containment"), "license")
    won = at.withColumn("_won", (F.first("license").over(best) == F.col("license")).cast("int"))
    held = won.groupBy("doc_id", "_row", "license", "_tid", "_size", "_start", "containment").agg(F.avg("_won").alias("_share"))
    return _licenses(held.where("_share > 0.5"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report(table(spark, sf_dir, "documents"), license_templates())
