"""Line deduplication over levelled sorted runs of line hashes.

Lines are read once into references (key hash, id): a line's key is the line
without white space at its ends, A-Z lower-cased; only keys of at least
``MIN_CHARS`` code points matter. References are cut into batches by id, from
the largest ids down, and written batch by batch, so that each reads its own
only. The index is a set of runs, tables bucketed and sorted by hash in the
shared folder, all of the same number of buckets. A batch is reduced to one row
per hash, which brings it into the same buckets, and merge-anti-joined with the
runs, bucket with bucket: hashes that no run holds are new, and the largest id
of the batch is the line's keeper; known hashes only add to their count. The
batch's rows become a run of level 0; ``FANOUT`` runs of a level are merged into
one run of the next, again bucket with bucket. So only a batch's own rows are
shuffled, runs never. At the end the runs are merged, and hashes of at least
``MIN_DOCS`` documents lose their lines outside the keeper.

A line that a third of all documents hold is one row per hash after the
map-side sums. The texts are then joined with their own few hashes to drop, by
id and text: a list never holds more than one text's lines, whatever the number
of rows that share an id or have none.

Cases: a null text is one empty line; documents are told apart by id, so rows
that repeat an id count as one document and all keep or lose the line together;
a null id counts as one document, smaller than all others; ties cannot arise
between ids; empty tables and extra columns are ordinary.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..session import ensure_checkpoint_dir, written
from .common import table

MIN_CHARS, MIN_DOCS = 40, 5
#: Batches of ids, and runs of a level that are merged into one of the next.
BATCHES, FANOUT = 4, 2
#: Ids that set the batches' bounds where ids are not numbers.
SAMPLE = 10_000

_SPACE = b" \t\n\r\x0b\x0c"


def line_hash(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """128-bit hash of a line's key; None if the key is too short."""
    key = line.strip(_SPACE).lower()
    if len(key) < min_chars or (len(key) < 4 * min_chars and len(key.decode("utf-8", "replace")) < min_chars):
        return None
    return xxhash.xxh3_128_digest(key)


class LineRuns:
    """Levelled sorted runs (key, docs, keeper) in the shared folder."""

    def __init__(self, spark: SparkSession, id_type: str, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.schema = f"key binary, docs long, keeper struct<id:{id_type}>"
        self.levels: list[list[DataFrame]] = []

    def _merged(self, runs: list[DataFrame]) -> DataFrame:
        """Runs with equal keys summed; a key has its keeper in the one run that brought it in. Two at a time, smallest
        first, by outer joins of buckets: a union would be shuffled again."""
        out = runs[0]
        for k, r in enumerate(runs[1:], 1):
            if k > 1:
                out = self._sorted(out, "line_merge")
            docs = F.coalesce("docs", F.lit(0)) + F.coalesce("_docs", F.lit(0))
            out = out.join(r.select("key", F.col("docs").alias("_docs"), F.col("keeper").alias("_keeper")), "key", "full_outer").select(
                "key", docs.alias("docs"), F.coalesce("keeper", "_keeper").alias("keeper"))
        return out

    def _sorted(self, run: DataFrame, label: str) -> DataFrame:
        """``run`` written in sorted buckets. Buckets need a table name while they are written; the
        files stay when the name is dropped, and what is returned reads them."""
        name = f"{label}_{uuid.uuid4().hex}"
        path = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/{name}"
        run.write.format("parquet").bucketBy(self.buckets, "key").sortBy("key").option("path", path).saveAsTable(name)
        try:
            return self.spark.table(name)
        finally:
            self.spark.sql(f"DROP TABLE {name}")

    def runs(self) -> list[DataFrame]:
        return [r for level in self.levels for r in level]

    def rows(self) -> DataFrame:
        runs = self.runs()
        return self._merged(runs) if runs else self.spark.createDataFrame([], self.schema)

    def add(self, batch: DataFrame) -> None:
        """Add a batch (key, id), one row per document and key; its ids are smaller than those of earlier batches."""
        mine = batch.groupBy("key").agg(F.count("*").alias("docs"), F.max(F.struct(F.col("id").isNotNull(), "id")).alias("top"))
        mine = mine.select("key", "docs", F.struct(F.col("top.id").alias("id")).alias("keeper"))
        fresh = F.lit(True)
        for k, run in enumerate(self.runs()):  # a run holds a key once
            mine = mine.join(run.select("key", F.lit(True).alias(f"_in{k}")), "key", "left")
            fresh = fresh & F.col(f"_in{k}").isNull()
        mine = mine.select("key", "docs", F.when(fresh, F.col("keeper")).alias("keeper"))
        self._push(0, self._sorted(mine, "line_run0"))

    def _push(self, level: int, run: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            full, self.levels[level] = self.levels[level], []
            self._push(level + 1, self._sorted(self._merged(full), f"line_run{level + 1}"))


def references(docs: DataFrame, min_chars: int) -> DataFrame:
    """(key, id, th: hash of the text), one row per document row and distinct key."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, at = [], []
            for i, t in enumerate(b.column("_text")):
                own = {h for line in (t.as_py() or b"").split(b"\n") if len(line) >= min_chars and (h := line_hash(line, min_chars))}
                keys += own
                at += [i] * len(own)
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), b.column("id").take(rows), b.column("th").take(rows)], names=["key", "id", "th"])

    rows = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("th"), F.col("text").cast("binary").alias("_text"))
    return rows.mapInArrow(run, f"key binary, id {id_type}, th long")


def _cuts(ids: DataFrame, batches: int) -> list:
    """Ids, descending, that cut the documents into batches of about equal size; from a bounded sample if ids are not
    numbers. Any cuts give the same lines."""
    shares = [k / batches for k in range(batches - 1, 0, -1)]
    if isinstance(ids.schema["id"].dataType, NumericType):
        return list(dict.fromkeys(ids.approxQuantile("id", shares, 0.01))) if shares else []
    sample = sorted(r.id for r in ids.where("id is not null").orderBy(F.rand(0)).limit(SAMPLE).collect())
    return list(dict.fromkeys(sample[int(len(sample) * s)] for s in shares)) if sample else []


def _in_batches(refs: DataFrame, cuts: list) -> DataFrame:
    """``refs`` written in a folder per batch: 0 holds the largest ids, the last one the smallest and null."""
    batch = F.lit(0)
    for c in cuts:
        batch = batch + F.coalesce(F.col("id") < F.lit(c), F.lit(True)).cast("int")
    rows = refs.withColumn("batch", batch)
    path = f"{ensure_checkpoint_dir(refs.sparkSession).rstrip('/')}/line-refs-{uuid.uuid4().hex}"
    rows.write.partitionBy("batch").parquet(path)
    return refs.sparkSession.read.schema(rows.schema).parquet(path)


def drop_lists(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int | None = None) -> DataFrame:
    """(id, th, drop): the hashes whose lines the rows of an id and text lose, at most those that the text has."""
    cuts = _cuts(docs.select(F.col("doc_id").alias("id")), batches or BATCHES)
    refs = _in_batches(references(docs, min_chars), cuts)
    runs = LineRuns(docs.sparkSession, refs.schema["id"].dataType.simpleString())
    for k in range(len(cuts) + 1):
        runs.add(refs.where(F.col("batch") == k).select("key", "id").distinct())  # rows that repeat an id are one document
    frequent = written(runs.rows().where(F.col("docs") >= min_docs), "line-frequent")
    lost = refs.join(frequent, "key").where(~F.col("id").eqNullSafe(F.col("keeper.id")))
    return lost.groupBy("id", "th").agg(F.collect_set("key").alias("drop"))


def _split(text: bytes, drop: set[bytes], min_chars: int) -> tuple[int, list[bytes]]:
    lines = text.split(b"\n")
    if not drop:
        return len(lines), lines
    return len(lines), [x for x in lines if len(x) < min_chars or line_hash(x, min_chars) not in drop]


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, digest: bool = False) -> DataFrame:
    """``docs`` without the repeated lines, or with ``digest`` doc_id, n_lines, n_dropped and kept_sha256 per row."""
    drops = drop_lists(docs, min_chars, min_docs)
    cols = ["doc_id"] if digest else docs.columns
    named = docs.select(*[F.col(c).alias(f"_doc_{c}") for c in cols], F.xxhash64("text").alias("_th"), F.col("text").cast("binary").alias("_text"))
    rows = named.join(drops, F.col("_doc_doc_id").eqNullSafe(F.col("id")) & (F.col("_th") == F.col("th")), "left").drop("id", "th", "_th")
    out = "_doc_doc_id " + docs.schema["doc_id"].dataType.simpleString() + ", n_lines long, n_dropped long, kept_sha256 string"
    if not digest:
        out = docs.select(*[F.col(c).alias(f"_doc_{c}") for c in cols]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            kept, n = [], []
            for t, d in zip(b.column("_text"), b.column("drop")):
                total, lines = _split(t.as_py() or b"", set(d.as_py() or ()), min_chars)
                n.append((total, total - len(lines)))
                text = b"\n".join(lines)
                kept.append(hashlib.sha256(text).hexdigest() if digest else text if t.is_valid else None)
            if digest:
                yield pa.RecordBatch.from_arrays(
                    [b.column("_doc_doc_id"), pa.array([x[0] for x in n], pa.int64()), pa.array([x[1] for x in n], pa.int64()), pa.array(kept, pa.string())],
                    names=["_doc_doc_id", "n_lines", "n_dropped", "kept_sha256"])
            else:
                text = pa.array(kept, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays([text if c == "text" else b.column(f"_doc_{c}") for c in cols], names=[f"_doc_{c}" for c in cols])

    made = rows.mapInArrow(run, out)
    if digest:
        return made.withColumnRenamed("_doc_doc_id", "doc_id")
    return made.select(*[F.col(f"_doc_{c}").alias(c) for c in cols])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), digest=True)


#: DuckDB: keys, then documents per key, then the text put together again.
ORACLE = f"""
with l as (
  select doc_id, rid, k, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key
  from (select doc_id, rid, unnest(lines) as line, generate_subscripts(lines, 1) as k
        from (select doc_id, row_number() over () as rid, string_split(coalesce(text, ''), chr(10)) as lines from documents))),
f as (
  select key, max(doc_id) as keeper from l where length(key) >= {MIN_CHARS}
  group by key having count(distinct doc_id) >= {MIN_DOCS}),
j as (select l.*, f.key is not null and l.doc_id <> f.keeper as gone from l left join f on l.key = f.key)
select doc_id, count(*) as n_lines, count(*) filter (where gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by k) filter (where not gone), '')) as kept_sha256
from j group by rid, doc_id
"""
