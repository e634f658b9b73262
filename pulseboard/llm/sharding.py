"""Sharding over fixed virtual slots (law: ``bytes``, near-equal shard sizes).

A record's hash puts it into one of ``SLOTS`` virtual slots; the slots never
change. Bytes are summed per slot, and a small table maps slots to shards.
Version 1 of the map deals slots out in turn; rebalancing writes the next
version, which differs only by the slots moved or swapped from the fullest to
the emptiest shard while that brings the two closer. With ``map_path`` the
versions are kept there and the next run, over more documents or another number of shards,
edits the latest one (``load_map``, ``latest_map``); without it the map of the run is an
intermediate table.

The map is built on the driver from one row per slot, ``SLOTS`` rows whatever
the input. A record that is repeated often enough to fill a slot by itself
(over one ``SLOTS``-th of all rows, so fewer than ``SLOTS`` such keys) is dealt
over slots by its place in the input; its copies are alike, so the result does
not depend on that. The place in a shard (``slot``) is the row's number within
its virtual slot plus the rows of the shard's earlier slots: windows hold one
virtual slot each, never a shard.

Cases: a null text has size 1 and checksum 0; null or repeated ids, repeated
rows and empty tables are ordinary; extra columns stay (columns named like the
operator's own are replaced).
"""

from __future__ import annotations

import bisect
import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import written
from .common import table, text_bytes

SLOTS = 4096
SHARDS = 16


def rebalance(slot_bytes: list[int], shard_of: list[int], shards: int) -> list[int]:
    """The next version of a slot-to-shard map: moves and swaps between the fullest and the emptiest shard."""
    out, load = list(shard_of), [0] * shards
    held: list[list[tuple[int, int]]] = [[] for _ in range(shards)]  # (bytes, slot), ascending
    for slot, s in enumerate(out):
        load[s] += slot_bytes[slot]
        if slot_bytes[slot]:
            bisect.insort(held[s], (slot_bytes[slot], slot))
    while True:
        hi, lo = max(range(shards), key=lambda s: load[s]), min(range(shards), key=lambda s: load[s])
        gap = load[hi] - load[lo]
        best = None  # (distance of the shift from half the gap, slot that leaves, slot that comes back)
        for back in [(0, -1), *held[lo]]:
            k = bisect.bisect_left(held[hi], (back[0] + gap / 2, -1))
            for item in held[hi][max(0, k - 1):k + 1]:
                shift = item[0] - back[0]
                if 0 < shift < gap and (best is None or abs(shift - gap / 2) < best[0]):
                    best = (abs(shift - gap / 2), item, back)
        if best is None:
            return out
        _, item, back = best
        held[hi].remove(item)
        bisect.insort(held[lo], item)
        out[item[1]] = lo
        if back[1] >= 0:
            held[lo].remove(back)
            bisect.insort(held[hi], back)
            out[back[1]] = hi
        load[hi] -= item[0] - back[0]
        load[lo] += item[0] - back[0]


def _keyed(docs: DataFrame) -> DataFrame:
    """``docs`` under the prefix _doc_, with size, checksum, hash and place in the input."""
    return docs.select(*[F.col(c).alias(f"_doc_{c}") for c in docs.columns]).withColumns({
        "size": text_bytes(F.col("_doc_text")) + 1, "text_crc32": F.crc32(F.coalesce(F.col("_doc_text"), F.lit("")).cast("binary")),
        "_rec": F.xxhash64("_doc_doc_id", "_doc_text"), "_at": F.monotonically_increasing_id()})


def _slotted(rows: DataFrame, hot: DataFrame, slots: int) -> DataFrame:
    """``rows`` with their virtual slot."""
    salted = rows.join(hot.select(F.col("_rec").alias("_hot")), F.col("_rec") == F.col("_hot"), "left")
    salt = F.when(F.col("_hot").isNotNull(), F.col("_at"))
    return salted.withColumn("virtual_slot", F.pmod(F.xxhash64("_rec", salt), F.lit(slots)).cast("int")).drop("_hot")


def load_map(spark: SparkSession, path: str) -> DataFrame | None:
    """All stored versions, as ``slot_map`` gives them; None if there is none."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def latest_map(spark: SparkSession, path: str) -> tuple[int, list[int]] | None:
    """Number and shards (by virtual slot) of the latest stored version."""
    stored = load_map(spark, path)
    if stored is None:
        return None
    number = stored.agg(F.max("version")).first()[0]
    return number, [r.shard for r in stored.where(F.col("version") == number).orderBy("virtual_slot").collect()]  # one row per slot


def store_map(slot_of: DataFrame, path: str, versions: list[int]) -> None:
    """Add versions to the stored map; one that is there already is an error."""
    for v in versions:
        slot_of.where(F.col("version") == v).drop("version").coalesce(1).write.parquet(f"{path.rstrip('/')}/version={v}")


def slot_map(numbers: DataFrame, hot: DataFrame, shards: int = SHARDS, slots: int = SLOTS, before: tuple[int, list[int]] | None = None) -> DataFrame:
    """One row per (version, virtual_slot): shard, bytes, rows and first_place; the version ``before`` (1: the slots
    dealt out in turn) and the next one, which is edited from it. Slots of shards that are no more are dealt out in turn."""
    per = {r["virtual_slot"]: (r["b"], r["n"]) for r in
           _slotted(numbers, hot, slots).groupBy("virtual_slot").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()}
    size, count = [[per.get(v, (0, 0))[k] for v in range(slots)] for k in (0, 1)]
    number, given = before or (1, [v % shards for v in range(slots)])
    if len(given) != slots:
        raise ValueError(f"the stored map has {len(given)} slots, not {slots}")
    versions = [given, rebalance(size, [s if s < shards else v % shards for v, s in enumerate(given)], shards)]
    spark, out = numbers.sparkSession, None
    for version, shard_of in enumerate(versions, number):
        first, seen = [0] * slots, [0] * (max(shard_of) + 1)
        for v, s in enumerate(shard_of):
            first[v], seen[s] = seen[s], seen[s] + count[v]
        values = json.dumps([list(v) for v in zip(shard_of, size, count, first)])
        part = spark.range(1).select(
            F.lit(version).alias("version"), F.posexplode(F.from_json(F.lit(values), "array<array<bigint>>")).alias("virtual_slot", "_v"))
        part = part.select("version", "virtual_slot", *[F.col("_v")[k].alias(n) for k, n in enumerate(("shard", "bytes", "rows", "first_place"))])
        out = part if out is None else out.unionByName(part)
    return written(out, "slot-map")


def assign_shards(docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, digest_only: bool = False, map_path: str | None = None) -> DataFrame:
    """Rows of ``docs`` with size, text_crc32, law, shard, slot, grown_shard, virtual_slot and map_version.

    ``map_path``: folder of the stored map, which this run edits and adds its version to. ``digest_only`` keeps doc_id and these columns; texts are then read once and never shuffled.
    """
    own = ["size", "text_crc32", "law", "shard", "slot", "grown_shard", "virtual_slot", "map_version"]
    keep = ["doc_id"] if digest_only else [c for c in docs.columns if c.lower() not in own]
    keyed = _keyed(docs)
    numbers = written(keyed.select("_doc_doc_id", "size", "text_crc32", "_rec", "_at"), "shard-sizes")
    n = numbers.count()
    hot = written(numbers.groupBy("_rec").count().where(F.col("count") * slots > n).where("count > 1"), "shard-hot")
    before = latest_map(docs.sparkSession, map_path) if map_path else None
    slot_of, version = slot_map(numbers, hot, shards, slots, before), (before[0] if before else 1) + 1
    if map_path:
        store_map(slot_of, map_path, [version] if before else [1, version])
    current = slot_of.where(F.col("version") == version).select("virtual_slot", F.col("shard").cast("int").alias("shard"), "first_place")
    rows = numbers if digest_only else keyed
    placed = _slotted(rows, hot, slots).withColumn(
        "_row", F.row_number().over(W.partitionBy("virtual_slot").orderBy("_doc_doc_id", "_rec", "_at")) - 1)
    return placed.join(current, "virtual_slot").select(
        *[F.col(f"_doc_{c}").alias(c) for c in keep], "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("first_place") + F.col("_row")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot", F.lit(version).alias("map_version"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(table(spark, sf_dir, "documents").select("doc_id", "text"), digest_only=True)
