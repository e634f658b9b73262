"""Token counts by a compiled byte-level BPE: a state machine over characters, merged chunk by chunk.

A deterministic transducer is compiled from the tokenizer file. It
reads character classes and says where pieces (the stretches that merges never
cross) begin; its transitions are annotated with the pieces they end, at the
character itself or one before it. Token counts are not on its transitions: how a
piece merges depends on the piece as a whole. They come from a table from piece
to count, which starts empty and is filled, when a piece is first met, by the
file's merges (a heap of neighbouring pairs).

Texts of a batch are laid end to end (an end-of-text class between them resets
the machine) and cut into chunks of ``CHUNK`` characters, which are read side
by side: each chunk yields its state map (start state -> end state). The maps
compose, which is associative, so a parallel prefix scan over them gives every
chunk its true start state, and a second reading emits the piece boundaries.
Special strings in a text are split off first and count as one token each.

Cases: a null or empty text has no tokens and no bytes; any text has a count,
whatever its length or characters; repeated rows and ids, empty tables and
extra columns are ordinary (columns named like the operator's own are replaced).
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

from .common import table

LIMIT = 1024
#: Characters in a chunk, and laid end to end at once.
CHUNK, BATCH_CHARS = 256, 2_000_000
#: Pieces that a worker remembers before it starts anew, and their characters at most (both cost time only).
REMEMBERED, REMEMBERED_CHARS = 1_000_000, 64

# ---------------------------------------------------------------- pieces
#: Character classes; the letters of English contractions have their own.
STMD, R, V, LL, E, LETTER, NUMBER, SPACE, BLANK, QUOTE, OTHER, END = range(12)
#: States: fresh start; in letters, numbers, others; a quote that starts a piece, then r, v or l;
#: one space, one other blank; several blanks that end in a space, in another blank.
FRESH, IN_L, IN_N, IN_O, IN_Q, Q_R, Q_V, Q_L, ONE_S, ONE_B, MORE_S, MORE_B = range(12)
#: Annotations: a piece begins at this character, at the one before it.
HERE, BEFORE = 1, 2
#: Code points with the White_Space property.
WHITE_SPACE = (9, 10, 11, 12, 13, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)


def character_classes() -> np.ndarray:
    out = np.full(0x110000, OTHER, dtype=np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind in "LN":
            out[c] = LETTER if kind == "L" else NUMBER
    out[list(WHITE_SPACE)] = BLANK
    out[ord(" ")], out[ord("'")] = SPACE, QUOTE
    out[[ord(c) for c in "stmd"]] = STMD
    out[ord("r")], out[ord("v")], out[ord("l")], out[ord("e")] = R, V, LL, E
    return out


def machine() -> tuple[np.ndarray, np.ndarray]:
    """Transition and annotation tables, indexed by state * 12 + class."""
    letters, blanks = (STMD, R, V, LL, E, LETTER), (SPACE, BLANK)

    def enter(c: int) -> int:
        """State after a character that begins a piece."""
        return (IN_L if c in letters else {NUMBER: IN_N, SPACE: ONE_S, BLANK: ONE_B, QUOTE: IN_Q, OTHER: IN_O, END: FRESH}[c])

    def step(s: int, c: int) -> tuple[int, int]:
        if c == END:
            return FRESH, HERE | (BEFORE if s in (Q_R, Q_V, Q_L) else 0)
        if s in (ONE_S, ONE_B, MORE_S, MORE_B):
            if c in blanks:
                return (MORE_S if c == SPACE else MORE_B), 0
            cut = BEFORE if s in (MORE_S, MORE_B) else 0
            if s in (ONE_S, MORE_S):  # the space goes with what follows, and a quote after it starts no contraction
                return (IN_O if c == QUOTE else enter(c)), cut
            return enter(c), HERE | cut
        if s in (Q_R, Q_V, Q_L):
            if c == (LL if s == Q_L else E):
                return FRESH, 0
            return step(IN_L, c)[0], BEFORE | step(IN_L, c)[1]
        if s == IN_Q:
            if c == STMD:
                return FRESH, 0
            if c in (R, V, LL):
                return {R: Q_R, V: Q_V, LL: Q_L}[c], 0
        goes_on = (s == IN_L and c in letters) or (s == IN_N and c == NUMBER) or (s in (IN_O, IN_Q) and c in (OTHER, QUOTE))
        return ({IN_Q: IN_O}.get(s, s), 0) if goes_on else (enter(c), HERE)

    pairs = [step(s, c) for s in range(12) for c in range(12)]
    return np.array([p[0] for p in pairs], dtype=np.uint8), np.array([p[1] for p in pairs], dtype=np.uint8)


def prefix_scan(maps: np.ndarray) -> np.ndarray:
    """Inclusive scan of state maps (chunk, start) under composition, in log2 rounds."""
    out, gap = maps.copy(), 1
    while gap < len(out):
        out[gap:] = np.take_along_axis(out[gap:], out[:-gap].astype(np.int64), axis=1)
        gap *= 2
    return out


def boundaries(classes: np.ndarray, following: np.ndarray, emits: np.ndarray) -> np.ndarray:
    """Positions at which pieces begin; ``classes`` ends in ``END``."""
    n = len(classes)
    rows = -(-n // CHUNK)
    grid = np.full(rows * CHUNK, END, dtype=np.uint8)
    grid[:n] = classes
    grid = np.ascontiguousarray(grid.reshape(rows, CHUNK).T)
    maps = np.tile(np.arange(12, dtype=np.uint8), (rows, 1))
    for column in grid:
        maps = following[maps * np.uint8(12) + column[:, None]]
    state = np.full(rows, FRESH, dtype=np.uint8)
    if rows > 1:
        state[1:] = prefix_scan(maps)[:-1, FRESH]
    said = np.empty_like(grid)
    for k, column in enumerate(grid):
        at = state * np.uint8(12) + column
        said[k], state = emits[at], following[at]
    said = said.T.reshape(-1)[:n]
    begins = (said & HERE).astype(bool)
    begins[:-1] |= (said[1:] & BEFORE).astype(bool)
    begins[0] = True
    return np.flatnonzero(begins)


# ---------------------------------------------------------------- merges
def byte_alphabet() -> dict[str, int]:
    """Characters that stand for bytes in a byte-level vocabulary: visible ones for themselves, the others from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


class Tokenizer:
    """Compiled byte-level BPE of a tokenizers .json file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        as_bytes = lambda s: bytes(alphabet[c] for c in s)
        self.ranks: dict[tuple[bytes, bytes], int] = {}
        for rank, m in enumerate(spec["model"]["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.ranks.setdefault((as_bytes(a), as_bytes(b)), rank)
        self.special = [t["content"] for t in spec["added_tokens"]]
        if len(self.special) > 1 or any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError("only one plain special token is supported")
        self.classes = character_classes()
        self.following, self.emits = machine()

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "known"}

    def piece_tokens(self, piece: str) -> int:
        """Tokens of a piece: the lowest-ranked neighbours merge first, the leftmost of equals."""
        parts: list[bytes | None] = [bytes((b,)) for b in piece.encode()]
        n = left = len(parts)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        ranks = self.ranks
        heap = [(r, k, parts[k], parts[k + 1]) for k in range(n - 1) if (r := ranks.get((parts[k], parts[k + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, k, a, b = heapq.heappop(heap)
            j = after[k]
            if parts[k] is not a or j >= n or parts[j] is not b:
                continue  # one of the two has merged with another
            parts[k], parts[j] = a + b, None
            left -= 1
            after[k] = after[j]
            if after[j] < n:
                before[after[j]] = k
                if (r := ranks.get((parts[k], parts[after[k]]))) is not None:
                    heapq.heappush(heap, (r, k, parts[k], parts[after[k]]))
            if before[k] >= 0 and (r := ranks.get((parts[before[k]], parts[k]))) is not None:
                heapq.heappush(heap, (r, before[k], parts[before[k]], parts[k]))
        return left

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of each text."""
        totals = np.zeros(len(texts), dtype=np.int64)
        segments: list[str] = []
        owner: list[int] = []
        for k, t in enumerate(texts):
            cut = t.split(self.special[0]) if self.special and self.special[0] in t else [t]
            totals[k] += len(cut) - 1
            cut = [s for s in cut if s]
            segments += cut
            owner += [k] * len(cut)
        if not segments:
            return totals
        known = self.__dict__.get("known")
        if known is None or len(known) > REMEMBERED:
            known = self.known = _Known(self)
        joined = "\n".join(segments) + "\n"
        classes = self.classes[np.frombuffer(joined.encode("utf-32-le"), dtype="<u4")]
        ends = np.cumsum(np.fromiter(map(len, segments), dtype=np.int64, count=len(segments)) + 1) - 1
        classes[ends] = END
        begins = boundaries(classes, self.following, self.emits)
        stops = np.r_[begins[1:], len(joined)]
        piece = classes[begins] != END
        begins, stops = begins[piece], stops[piece]
        tokens = np.fromiter([known[joined[a:b]] for a, b in zip(begins.tolist(), stops.tolist())], dtype=np.int64, count=len(begins))
        np.add.at(totals, np.array(owner)[np.searchsorted(ends, begins)], tokens)
        return totals


class _Known(dict):
    """Tokens by piece, worked out when first met."""

    def __init__(self, tokenizer: Tokenizer):
        self.tokenizer = tokenizer

    def __missing__(self, piece: str) -> int:
        n = self.tokenizer.piece_tokens(piece)
        if len(piece) <= REMEMBERED_CHARS:
            self[piece] = n
        return n


def count_all(tokenizer: Tokenizer, texts: pa.Array) -> np.ndarray:
    out, held, n = [], [], 0
    for t in texts:
        held.append(t.as_py() or "")
        n += len(held[-1])
        if n >= BATCH_CHARS:
            out.append(tokenizer.count(held))
            held, n = [], 0
    out.append(tokenizer.count(held))
    return np.concatenate(out)


def count_tokens(docs: DataFrame, path: str, text: str = "text", limit: int = LIMIT) -> DataFrame:
    """``docs`` without the text, with n_bytes, n_tokens and over_limit."""
    own = ("n_bytes", "n_tokens", "over_limit")
    keep = [f for f in docs.schema if f.name.lower() not in (text.lower(), *own)]
    schema = StructType([*keep, StructField("n_bytes", LongType()), StructField("n_tokens", LongType()), StructField("over_limit", BooleanType())])
    shared = docs.sparkSession.sparkContext.broadcast(Tokenizer(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            tokens = count_all(shared.value, b.column("_text"))
            yield pa.RecordBatch.from_arrays(
                [*[b.column(f.name) for f in keep], b.column("n_bytes"), pa.array(tokens), pa.array(tokens > limit)], names=schema.names)

    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes")
    return docs.select(*[f.name for f in keep], size, F.col(text).alias("_text")).mapInArrow(run, schema)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))
