"""Fill-in-the-middle rewriting: a learned rank index finds the cuts.

A text is cut into units (lines with their newline). The end offsets of its
units, in code points, grow with their rank, so a few straight segments
describe them: a segment starts at a boundary and goes on as long as one slope
passes all its boundaries by at most ``EPSILON`` code points (the cone of
slopes that still fit is narrowed with each boundary; when it is empty, the
next segment starts). Each boundary keeps its residual, one signed byte. A cut
is looked up by rank: find the segment, predict, add the residual; the result
is exact for every boundary.

``fill_in_middle`` deals prefix, middle and suffix by a hash of the id, so a
rerun, a lost executor or another order of rows gives the same cuts.
``rank_index`` returns the index itself, to be stored and used again by
``cut`` with other seeds without reading the texts for their lines.
``restore`` undoes the rewriting with built-in functions.

Cases: a null text is an empty one; an empty text, and one that holds a
sentinel, stays plain; a text without newline is one unit, so a cut can only
fall at its ends; a null id hashes as no digits; repeated rows and ids are
rewritten alike; empty tables give no rows; columns of the input that clash
with those returned give way. A text is handled whole; a task holds one Arrow
batch.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import table

SEED, FIM_PERCENT, SPM_PERCENT = 7, 100, 50
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Largest distance of a boundary from its segment, before rounding; residuals are signed bytes.
EPSILON = 120


def boundaries(text: str) -> list[int]:
    """Offsets 0, and after each unit ``[^\\n]*\\n|[^\\n]+``, in code points."""
    out = [0, *accumulate(len(line) + 1 for line in text.split("\n"))]
    out[-1] -= 1
    return out if len(out) == 2 and out[-1] or out[-1] > out[-2] else out[:-1]


@dataclass
class RankIndex:
    """Rank of a boundary -> its offset: segments (first rank, offset there, slope) and residuals."""

    starts: list[int]
    bases: list[int]
    slopes: list[float]
    residuals: np.ndarray

    @classmethod
    def fit(cls, offsets: list[int], epsilon: int = EPSILON) -> RankIndex:
        if not 0 < epsilon <= EPSILON:
            raise ValueError(f"residuals of one byte hold 1 to {EPSILON} code points, not {epsilon}")
        starts, bases, slopes = [0], [offsets[0]], []
        k0, y0, low, high = 0, offsets[0], 0.0, float("inf")
        for k in range(1, len(offsets)):
            dy, dx = offsets[k] - y0, k - k0
            under, over = (dy - epsilon) / dx, (dy + epsilon) / dx
            if under > high or over < low:  # no slope fits all of the segment any more
                slopes.append(_slope(low, high))
                k0, y0, low, high = k, offsets[k], 0.0, float("inf")
                starts.append(k)
                bases.append(y0)
            else:
                low, high = max(low, under), min(high, over)
        slopes.append(_slope(low, high))
        index = cls(starts, bases, slopes, np.empty(0, np.int8))
        rank = np.arange(len(offsets))
        at = np.searchsorted(starts, rank, "right") - 1
        guess = np.array(bases)[at] + np.floor(np.array(slopes)[at] * (rank - np.array(starts)[at])).astype(np.int64)
        index.residuals = (np.array(offsets) - guess).astype(np.int8)
        return index

    def predict(self, rank: int) -> int:
        s = bisect_right(self.starts, rank) - 1
        return self.bases[s] + int(np.floor(self.slopes[s] * (rank - self.starts[s])))

    def __getitem__(self, rank: int) -> int:
        return self.predict(rank) + int(self.residuals[rank])

    @classmethod
    def load(cls, segments: list[dict], residuals: bytes) -> RankIndex:
        """An index stored by ``rank_index``."""
        starts, bases, slopes = ([x[k] for x in segments] for k in ("start", "base", "slope"))
        return cls(starts, bases, slopes, np.frombuffer(residuals, np.int8))

    @property
    def units(self) -> int:
        return len(self.residuals) - 1


def _slope(low: float, high: float) -> float:
    return low if high == float("inf") else (low + high) / 2


def draws(doc_id: object, seed: int = SEED) -> list[int]:
    """Four numbers of 32 bits that depend on the id and the seed only."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]


def cut(index: RankIndex, doc_id: object, seed: int = SEED, fim_percent: int = FIM_PERCENT,
        spm_percent: int = SPM_PERCENT) -> tuple[str, int, int]:
    """(form, end of prefix, end of middle) of a text without sentinels."""
    h1, h2, h3, h4 = draws(doc_id, seed)
    if index.units == 0 or h3 % 100 >= fim_percent:
        return "plain", 0, 0
    first, second = sorted((h1 % (index.units + 1), h2 % (index.units + 1)))
    return "spm" if h4 % 100 < spm_percent else "psm", index[first], index[second]


def _kept(docs: DataFrame, text: str, own: tuple[str, ...]) -> list[T.StructField]:
    return [f for f in docs.schema if f.name.lower() not in (text.lower(), *own)]


def rank_index(docs: DataFrame, text: str = "text", epsilon: int = EPSILON) -> DataFrame:
    """``docs`` without the text, with its index: segments (start, base, slope) and residuals (a signed byte each)."""
    segment = T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("base", T.LongType()), T.StructField("slope", T.DoubleType())]))
    keep = _kept(docs, text, ("segments", "residuals"))
    schema = T.StructType([*keep, T.StructField("segments", segment), T.StructField("residuals", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("base", pa.int64()), ("slope", pa.float64())]))
        for b in batches:
            made = [RankIndex.fit(boundaries(t.as_py() or ""), epsilon) for t in b.column("_text")]
            segments = [[{"start": s, "base": o, "slope": m} for s, o, m in zip(x.starts, x.bases, x.slopes)] for x in made]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(f.name) for f in keep], pa.array(segments, kind), pa.array([x.residuals.tobytes() for x in made], pa.binary())],
                names=schema.names)

    return docs.select(*[f.name for f in keep], F.col(text).alias("_text")).mapInArrow(run, schema)


def stored_cuts(indexed: DataFrame, doc_id: str = "doc_id", seed: int = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars) from a stored ``rank_index`` for another seed: no text is read.

    Sentinels stand in the texts, so this does not look for them."""
    schema = T.StructType([indexed.schema[doc_id], *[T.StructField(n, t) for n, t in (
        ("n", T.LongType()), ("form", T.StringType()), ("prefix_chars", T.LongType()), ("middle_chars", T.LongType()))]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            indexes = [RankIndex.load(g.as_py(), r.as_py()) for g, r in zip(batch.column("segments"), batch.column("residuals"))]
            made = [cut(x, k.as_py(), seed, fim_percent, spm_percent) for x, k in zip(indexes, batch.column("_id"))]
            ends = [(None, None) if f == "plain" else (a, b - a) for f, a, b in made]
            yield pa.RecordBatch.from_arrays([
                batch.column("_id"), pa.array([x.units for x in indexes], pa.int64()), pa.array([f for f, _, _ in made], pa.string()),
                pa.array([a for a, _ in ends], pa.int64()), pa.array([m for _, m in ends], pa.int64())], names=schema.names)

    return indexed.select(F.col(doc_id).alias("_id"), "segments", "residuals").mapInArrow(run, schema)


def fill_in_middle(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", seed: int = SEED, fim_percent: int = FIM_PERCENT,
                   spm_percent: int = SPM_PERCENT, sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> DataFrame:
    """``docs`` without the text, with n (units), form, prefix_chars and middle_chars (null if plain), and the rewritten output."""
    long = T.LongType()
    own = [("n", long), ("form", T.StringType()), ("prefix_chars", long), ("middle_chars", long), ("output", T.StringType())]
    keep = _kept(docs, text, tuple(n for n, _ in own))
    schema = T.StructType([*keep, *[T.StructField(n, t) for n, t in own]])
    p, s, m = sentinels

    def rewrite(key: object, body: str) -> tuple:
        index = RankIndex.fit(boundaries(body))
        form, a, b = cut(index, key, seed, fim_percent, spm_percent)
        if form == "plain" or any(x in body for x in sentinels):
            return index.units, "plain", None, None, body
        parts = (s, body[b:], p, body[:a]) if form == "spm" else (p, body[:a], s, body[b:])
        return index.units, form, a, b - a, "".join((*parts, m, body[a:b]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [rewrite(k.as_py(), t.as_py() or "") for k, t in zip(batch.column("_id"), batch.column("_text"))]
            columns = [pa.array(c, pa.int64() if t is long else pa.string()) for c, (_, t) in zip(list(zip(*rows)) or [()] * len(own), own)]
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in keep], *columns], names=schema.names)

    given = docs.select(*[f.name for f in keep], F.col(doc_id).alias("_id"), F.col(text).alias("_text"))
    return given.mapInArrow(run, schema)


def restore(output: Column, form: Column, sentinels: tuple[str, str, str] = (PREFIX, SUFFIX, MIDDLE)) -> Column:
    """The text that was rewritten: a text without sentinels falls apart at them in one way only."""
    part = F.split(output, "|".join(re.escape(x) for x in sentinels))
    whole = F.when(form == "psm", F.concat(part[1], part[3], part[2])).when(form == "spm", F.concat(part[2], part[3], part[1]))
    return whole.otherwise(output)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = F.sha2("output", 256).alias("output_sha256"), F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256")
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digest)


ORACLE = r"""
with docs as (
  select doc_id, coalesce(text, '') as t, sha256('7:' || coalesce(doc_id::varchar, '')) as h from documents),
units as (
  select *, string_split(t, chr(10)) as pieces,
         len(string_split(t, chr(10))) - (t = '' or t[-1] = chr(10))::int as n,
         ('0x' || h[1:8])::ubigint as h1, ('0x' || h[9:16])::ubigint as h2, ('0x' || h[25:32])::ubigint as h4
  from docs),
ranks as (
  select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
         t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') as plain
  from units),
cuts as (
  select *, case when a = 0 then '' else array_to_string(pieces[1:a::int], chr(10)) || (case when a < len(pieces) then chr(10) else '' end) end as p,
         case when b = 0 then '' else array_to_string(pieces[1:b::int], chr(10)) || (case when b < len(pieces) then chr(10) else '' end) end as pm
  from ranks),
forms as (
  select *, case when plain then 'plain' when h4 % 100 < 50 then 'spm' else 'psm' end as form,
         t[length(p) + 1:length(pm)] as m, t[length(pm) + 1:] as s
  from cuts)
select doc_id, n::bigint as n, form, case when not plain then length(p) end as prefix_chars, case when not plain then length(m) end as middle_chars,
       sha256(case form when 'plain' then t when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
       sha256(case form when 'plain' then t else p || m || s end) as restored_sha256
from forms
"""
