"""Vector code compression: k-means over vector parts on anchors-hierarchy metric trees.

Vectors become integers, floor(SCALE * x), and are cut into PARTS consecutive
parts; each part position has a codebook of ENTRIES entries. A task packs its
vectors into blocks and builds one metric tree per part position and block,
written once to the shared folder. A tree is built middle-out by the anchors
hierarchy: about sqrt(n) anchors, each new one the point farthest from its
anchor, steal the points nearer to them (those within half the distance of two
anchors are skipped by the triangle inequality); each anchor's points are split
again the same way, and the anchors are then merged in pairs, smallest joint
ball first, up to the root. Each ball caches its centre, radius, sum and count.

A round walks all balls of a tree level by level. A ball inherits the candidate
entries of its parent and drops an entry c against the nearest one c* when
``|p - c|^2 - |p - c*|^2 > 2 r |c - c*|`` (centre p, radius r): then every point
of the ball is strictly nearer to c*. A ball left with one candidate is wholly
owned, and its cached sum and count are used; what is not owned at the leaves
is compared with the leaf's own candidates. All figures are integers
that a double holds exactly, and r is rounded up, so the result equals that of
comparing all points with all entries, ties to the lower index. Blocks whose
values are too large for that are compared in Python integers.

A task sends one sum per part, entry and position, so the driver gets a few
thousand numbers a round, whatever the input.

Cases: vectors that are null or hold null, NaN or infinite components are
dropped; so are those that have not as many components as the smallest kept
vec_id, or a number that PARTS does not divide. Repeated rows and ids count
each; equal ids are ordered by their vectors, null ids come last. Fewer kept
rows than ENTRIES give fewer entries. Null labels are one label. An error
beyond a long is given as the largest long. An empty table gives no rows. Extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
import io
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import written
from .common import table

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
#: Vectors in a block, and points of a tree's leaf.
BLOCK, LEAF = 4096, 64
#: Doubles hold integers up to here.
EXACT = 2.0**53
LIMB = 40
LONG_MAX = 2**63 - 1

#: Codebooks by part, entry, position.
Books = list[list[list[int]]]


def usable(vector: Column) -> Column:
    """Whether a vector is not null and all its components are finite."""
    x = F.transform(vector, lambda c: c.cast("double"))
    return F.coalesce(vector.isNotNull() & ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))), F.lit(False))


def integers(vectors: np.ndarray) -> np.ndarray:
    """floor(SCALE * x): as doubles where they hold that, else as Python integers."""
    with np.errstate(over="ignore"):
        scaled = np.floor(vectors * float(SCALE))
    if vectors.size == 0 or np.abs(scaled).max() < EXACT:
        return scaled + 0.0
    whole = np.frompyfunc(lambda x: math.floor(x * SCALE) if abs(x) < 1e300 else int(x) * SCALE, 1, 1)
    return whole(vectors)


def exact(points: np.ndarray, book: list[list[int]]) -> bool:
    """Whether squared distances of the points to the entries stay integers in doubles."""
    if points.dtype == object:
        return False
    most = max([float(np.abs(points).max(initial=0)), *(abs(float(x)) for e in book for x in e)])
    return max(points.shape[1], 1) * (2 * most) ** 2 < EXACT


class Tree:
    """Balls of one block and part. Node 0 is the root; ``order`` lists the points so that each ball is a run [lo, hi) of it."""

    FIELDS = ("order", "lo", "hi", "left", "right", "centre", "radius", "total")

    def __init__(self, *fields: np.ndarray) -> None:
        self.order, self.lo, self.hi, self.left, self.right, self.centre, self.radius, self.total = fields

    @classmethod
    def build(cls, x: np.ndarray) -> Tree:
        kids: list[tuple[int, int]] = []  # of each ball, in order of creation; -1: a leaf
        members: list[np.ndarray] = []

        def ball(points: np.ndarray, children: tuple[int, int] = (-1, -1)) -> int:
            kids.append(children)
            members.append(points)
            return len(kids) - 1

        def grow(points: np.ndarray) -> int:
            groups = anchors(x, points) if len(points) > LEAF else [points]
            if len(groups) == 1:
                return ball(points)
            return merge([grow(g) for g in groups])

        def merge(balls: list[int]) -> int:
            """Joins the two balls with the smallest joint ball until one is left."""
            c = np.array([x[members[b]].mean(axis=0) for b in balls])
            r = np.array([np.sqrt(((x[members[b]] - m) ** 2).sum(axis=1).max()) for b, m in zip(balls, c)])
            joint = np.sqrt(((c[:, None] - c[None]) ** 2).sum(axis=2)) + r[:, None] + r[None]
            np.fill_diagonal(joint, np.inf)
            live = list(balls)
            for _ in range(len(balls) - 1):
                i, j = sorted(divmod(int(joint.argmin()), len(live)))
                both = np.concatenate([members[live[i]], members[live[j]]])
                size = len(members[live[i]]), len(members[live[j]])
                live[i] = ball(both, (live[i], live[j]))
                c[i] = (c[i] * size[0] + c[j] * size[1]) / sum(size)
                r[i] = np.sqrt(((x[both] - c[i]) ** 2).sum(axis=1).max())
                joint[j] = joint[:, j] = np.inf
                alive = np.isfinite(joint[i])
                row = np.sqrt(((c - c[i]) ** 2).sum(axis=1)) + r + r[i]
                joint[i, alive] = row[alive]
                joint[alive, i] = row[alive]
            return live[i]

        root = grow(np.arange(len(x)))
        ids, lo, todo = [], [], [(root, 0)]
        while todo:  # numbers the balls from the root down, each child within its parent's run
            b, at = todo.pop()
            ids.append(b)
            lo.append(at)
            first, second = kids[b]
            if first >= 0:
                todo += [(second, at + len(members[first])), (first, at)]
        order = members[root]  # the runs of both children follow each other at every merge
        number = {b: k for k, b in enumerate(ids)}
        centre = np.array([np.floor(x[members[b]].mean(axis=0)) for b in ids])
        radius = np.array([math.sqrt(((x[members[b]] - c) ** 2).sum(axis=1).max()) for b, c in zip(ids, centre)]) * (1 + 1e-12)
        left, right = (np.array([number.get(kids[b][s], -1) for b in ids], np.int32) for s in (0, 1))
        start = np.array(lo, np.int32)
        return cls(order.astype(np.uint16), start, start + np.array([len(members[b]) for b in ids], np.int32), left, right, centre, radius,
                   np.array([x[members[b]].sum(axis=0) for b in ids]))

    def owners(self, x: np.ndarray, book: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], tuple[np.ndarray, np.ndarray]]:
        """(ball, its owner) by level, and (point, its entry) of the points in no owned ball."""
        first = [k == next(i for i, e in enumerate(book) if (e == c).all()) for k, c in enumerate(book)]  # a repeated entry never wins
        apart = np.sqrt(((book[:, None] - book[None]) ** 2).sum(axis=2)) * (1 + 1e-12)
        d = squared(self.centre, book)
        at, lists = np.array([0]), np.array([first])
        owned: list[tuple[np.ndarray, np.ndarray]] = []
        open_: list[tuple[np.ndarray, np.ndarray]] = []
        while len(at):
            near = np.where(lists, d[at], np.inf)
            best = near.argmin(axis=1)
            gap = near - near[np.arange(len(at)), best][:, None]
            lists = lists & ~(gap > 2 * self.radius[at][:, None] * apart[best] * (1 + 1e-12))
            own = lists.sum(axis=1) == 1
            owned.append((at[own], best[own]))
            leaf = ~own & (self.left[at] < 0)
            open_.append((at[leaf], lists[leaf]))
            down = ~own & ~leaf
            at, lists = np.concatenate([self.left[at[down]], self.right[at[down]]]), np.concatenate([lists[down]] * 2)
        leaves, lists = (np.concatenate(z) for z in zip(*open_))
        size = self.hi[leaves] - self.lo[leaves]
        points = self.order[np.concatenate([np.arange(a, b) for a, b in zip(self.lo[leaves], self.hi[leaves])] or [np.empty(0, int)])]
        d = np.where(np.repeat(lists, size, axis=0), squared(x[points], book), np.inf)
        return owned, (points, d.argmin(axis=1) if len(points) else np.empty(0, int))

    def sums(self, x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(entries x width) sums and the counts of the points of each entry."""
        total, count = np.zeros(book.shape), np.zeros(len(book))
        owned, (points, entry) = self.owners(x, book)
        for at, best in owned:
            np.add.at(total, best, self.total[at])
            np.add.at(count, best, self.hi[at] - self.lo[at])
        np.add.at(total, entry, x[points])
        return total, count + np.bincount(entry, minlength=len(book))

    def codes(self, x: np.ndarray, book: np.ndarray) -> np.ndarray:
        out = np.empty(len(x), int)
        owned, (points, entry) = self.owners(x, book)
        for at, best in owned:
            for b, e in zip(at, best):
                out[self.order[self.lo[b]:self.hi[b]]] = e
        out[points] = entry
        return out


def squared(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    return (x**2).sum(axis=1)[:, None] - 2 * (x @ book.T) + (book**2).sum(axis=1)[None]


def anchors(x: np.ndarray, points: np.ndarray) -> list[np.ndarray]:
    """The points dealt to about sqrt(n) anchors (one group if they are all equal)."""
    p = x[points]
    chosen, owner = [0], np.zeros(len(points), int)
    d = ((p - p[0]) ** 2).sum(axis=1)
    for k in range(1, math.isqrt(len(points)) + 1):
        new = int(d.argmax())
        if d[new] == 0:
            break
        between = ((p[chosen] - p[new]) ** 2).sum(axis=1)
        may = np.flatnonzero(4 * d > between[owner])
        dn = ((p[may] - p[new]) ** 2).sum(axis=1)
        steal = dn < d[may]
        owner[may[steal]], d[may[steal]] = k, dn[steal]
        chosen.append(new)
    return [g for g in (points[owner == k] for k in range(len(chosen))) if len(g)]


def brute(x: np.ndarray, book: list[list[int]]) -> np.ndarray:
    """Nearest entries in Python integers."""
    c = np.array([[int(v) for v in e] for e in book], dtype=object)
    return np.array([min(range(len(c)), key=lambda k: sum((a - b) ** 2 for a, b in zip(row, c[k]))) for row in whole(x)], int)


def whole(x: np.ndarray) -> np.ndarray:
    return np.frompyfunc(int, 1, 1)(x).astype(object) if x.size else x.astype(object)


def pack(arrays: dict[str, np.ndarray]) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def unpack(blob: bytes) -> dict[str, np.ndarray]:
    with np.load(io.BytesIO(blob), allow_pickle=False) as z:
        return {k: z[k] for k in z.files}


def slimmer(a: np.ndarray) -> np.ndarray:
    """Whole numbers in four bytes where they fit."""
    return a.astype(np.int32) if a.dtype == np.float64 and np.abs(a).max(initial=0) < 2**31 else a


def block_of(vectors: np.ndarray) -> bytes:
    """A block's vectors and the trees of its parts; large values stay as they came and get no tree."""
    x = integers(vectors)
    width = x.shape[1] // PARTS
    if not all(exact(x[:, k * width:(k + 1) * width], []) for k in range(PARTS)):
        return pack({"vectors": vectors})
    out = {"x": slimmer(x)}
    for k in range(PARTS):
        tree = Tree.build(x[:, k * width:(k + 1) * width])
        out |= {f"{f}{k}": slimmer(getattr(tree, f)) if f in ("centre", "total") else getattr(tree, f) for f in Tree.FIELDS}
    return pack(out)


def parts_of(blob: bytes) -> Iterator[tuple[np.ndarray, Tree | None]]:
    """(points, tree) by part."""
    z = unpack(blob)
    x = integers(z["vectors"]) if "vectors" in z else z["x"].astype(np.float64)
    width = x.shape[1] // PARTS
    for k in range(PARTS):
        part = x[:, k * width:(k + 1) * width]
        yield part, None if "vectors" in z else Tree(*[z[f"{f}{k}"].astype(np.float64) if f in ("centre", "total") else z[f"{f}{k}"] for f in Tree.FIELDS])


def nearest(part: np.ndarray, tree: Tree | None, book: list[list[int]]) -> np.ndarray:
    if tree is None or not exact(part, book):
        return brute(part, book)
    return tree.codes(part, np.array(book, float))


def blocks(vectors: DataFrame) -> DataFrame:
    """One row per block of ``vectors`` (_id, _label, _v: arrays of equal length): ids, labels and packed trees, written once."""
    schema = T.StructType([T.StructField("ids", T.ArrayType(vectors.schema["_id"].dataType)),
                           T.StructField("labels", T.ArrayType(vectors.schema["_label"].dataType)), T.StructField("packed", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made(rows: pa.Table) -> pa.RecordBatch:
            v = rows.column("_v").combine_chunks()
            x = v.flatten().to_numpy(zero_copy_only=False).reshape(len(v), -1).astype(np.float64)
            ends = pa.array([0, len(v)], pa.int32())
            lists = [pa.ListArray.from_arrays(ends, rows.column(c).combine_chunks()) for c in ("_id", "_label")]
            return pa.RecordBatch.from_arrays([*lists, pa.array([block_of(x)], pa.binary())], names=schema.names)

        held: list[pa.RecordBatch] = []
        for b in batches:
            held.append(b)
            if sum(x.num_rows for x in held) >= BLOCK:
                rows = pa.Table.from_batches(held)
                whole_ = rows.num_rows // BLOCK * BLOCK
                for k in range(0, whole_, BLOCK):
                    yield made(rows.slice(k, BLOCK))
                held = rows.slice(whole_).to_batches()
        if rest := sum(x.num_rows for x in held):
            yield made(pa.Table.from_batches(held).slice(0, rest))

    return written(vectors.select("_id", "_label", "_v").mapInArrow(run, schema), "codes-blocks")


def _limbs(n: int) -> list[int]:
    """Digits of base 2**LIMB from the lowest; the last has the sign."""
    out = []
    while abs(n) >= 2**LIMB:
        out.append(n % 2**LIMB)
        n >>= LIMB
    return [*out, n]


def _sums(books: Books) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int, int], int] = {}
        for b in batches:
            for blob in b.column("packed"):
                for k, (part, tree) in enumerate(parts_of(blob.as_py())):
                    if tree is not None and exact(part, books[k]):
                        s, n = tree.sums(part, np.array(books[k], float))
                    else:
                        code = brute(part, books[k])
                        s = np.array([whole(part)[code == e].sum(axis=0) if (code == e).any() else [0] * part.shape[1] for e in range(len(books[k]))], object)
                        n = np.bincount(code, minlength=len(books[k]))
                    for e in np.flatnonzero(n):
                        for pos, v in enumerate([int(n[e]), *s[e]]):
                            total[k, int(e), pos] = total.get((k, int(e), pos), 0) + int(v)
        rows = [(*key, limb, v) for key, n in total.items() for limb, v in enumerate(_limbs(n))]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=["part", "entry", "pos", "limb", "value"])
    return run


def next_books(packed: DataFrame, books: Books) -> Books:
    """One round: every entry becomes the floor of the mean of its parts; unused entries stay."""
    sums = packed.select("packed").mapInArrow(_sums(books), "part long, entry long, pos long, limb long, value long")
    rows = sums.groupBy("part", "entry", "pos", "limb").agg(F.sum("value").alias("value")).collect()  # parts x entries x (width + 1), a few limbs
    total: dict[tuple[int, int, int], int] = {}
    for r in rows:
        total[r.part, r.entry, r.pos] = total.get((r.part, r.entry, r.pos), 0) + (r.value << LIMB * r.limb)
    return [[[total[k, e, pos + 1] // total[k, e, 0] for pos in range(len(entry))] if total.get((k, e, 0)) else entry
             for e, entry in enumerate(book)] for k, book in enumerate(books)]


def encode(packed: DataFrame, books: Books) -> DataFrame:
    """(_id, _label, code, error) of every vector of the blocks."""
    kinds = [packed.schema[c].dataType.elementType for c in ("ids", "labels")]
    schema = T.StructType([T.StructField("_id", kinds[0]), T.StructField("_label", kinds[1]),
                           T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(b.num_rows):
                codes, error = [], 0
                for part, tree, book in ((*p, books[k]) for k, p in enumerate(parts_of(b.column("packed")[row].as_py()))):
                    code = nearest(part, tree, book)
                    codes.append(code)
                    if exact(part, book):
                        error = error + ((part - np.array(book, float)[code]) ** 2).sum(axis=1).astype(np.int64)
                    else:
                        error = error + ((whole(part) - np.array(book, dtype=object)[code]) ** 2).sum(axis=1)
                text = [bytes(c).hex() for c in np.stack(codes, axis=1).astype(np.uint8)]
                yield pa.RecordBatch.from_arrays([
                    b.column("ids")[row].values, b.column("labels")[row].values, pa.array(text, pa.string()),
                    pa.array([min(int(e), LONG_MAX) for e in error], pa.int64())], names=schema.names)

    return packed.mapInArrow(run, schema)


def first_books(vectors: DataFrame) -> tuple[int, Books]:
    """Number of components, and the codebooks of the parts of the ENTRIES smallest ids (one bounded top-k)."""
    even = vectors.where((F.size("_v") > 0) & (F.size("_v") % PARTS == 0))
    order = F.col("_id").asc_nulls_last(), "_v"
    rows = even.orderBy(*order).limit(ENTRIES).collect()
    if not rows:
        return 0, []
    n = len(rows[0]._v)
    if any(len(r._v) != n for r in rows):
        rows = even.where(F.size("_v") == n).orderBy(*order).limit(ENTRIES).collect()
    x = integers(np.array([r._v for r in rows], float))
    width = n // PARTS
    return n, [[[int(v) for v in row[k * width:(k + 1) * width]] for row in x] for k in range(PARTS)]


def books_digest(books: Books) -> str:
    return hashlib.sha256(",".join(str(v) for book in books for entry in book for v in entry).encode()).hexdigest()


def compress(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", rounds: int = ROUNDS) -> tuple[DataFrame, Books]:
    """(vec_id, label, code, error) of every kept vector, and the codebooks."""
    kept = vectors.where(usable(F.col(vector))).select(
        F.col(vec_id).alias("_id"), F.col(label).alias("_label"), F.col(vector).cast("array<double>").alias("_v"))
    n, books = first_books(kept)
    packed = blocks(kept.where(F.size("_v") == n) if n else kept.limit(0))
    for _ in range(rounds if n else 0):
        books = next_books(packed, books)
    return encode(packed, books).withColumnsRenamed({"_id": vec_id, "_label": label}), books


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, books = compress(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    rows = written(rows, "codes")
    largest = F.lit(LONG_MAX).cast("decimal(38,0)")
    totals = rows.groupBy("label").agg(F.least(F.sum(F.col("error").cast("decimal(28,0)")), largest).cast("long").alias("label_error"))
    totals = totals.withColumnRenamed("label", "_of")
    out = rows.join(totals, F.col("label").eqNullSafe(F.col("_of")))
    return out.select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))
