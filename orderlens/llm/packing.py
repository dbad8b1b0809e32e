"""Packing token sequences as a cutting-stock problem solved by column generation.

1. Every document is tokenised once. Whole sequences are cut off its front; what remains
   is a piece shorter than a sequence. Pieces are counted by length class (``unit`` tokens
   a class, rounded up): at most seq_len / unit numbers, whatever the corpus.
2. A linear program over patterns (how many pieces of each class share a sequence) is
   solved by column generation: a knapsack dynamic program prices patterns with the dual
   values, and the pattern of the largest value enters the basis, until a bound shows
   that no solution uses ``GAP`` fewer sequences.
3. Each pattern is used the rounded-down number of times. The pieces this leaves, a few
   for each class, are placed largest first into the fullest sequence that takes them.
4. Pieces are ranked within their class. The pattern counts laid end to end tell each
   rank its sequence, so assignment is arithmetic on a small table, not a search.

If the program's own optimum wastes more than ``HALVE_ABOVE``, as when few small pieces
exist, all remainders longer than half a sequence are cut there and it is solved again.

Cases: null text counts as empty; such a document is its end id alone. Every row is a
document of its own, repeated ids too. An empty table gives no rows.
"""

from __future__ import annotations

import bisect
import re
import struct
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import materialise, text_bytes

GAP = 0.0005
HALVE_ABOVE = 0.005
CACHE_WORDS = 300_000
_MARKS = b".,;:!?"

_known: dict[str, Words] = {}


def _byte_letters() -> dict[int, int]:
    """The public byte-level alphabet: printable bytes stand for themselves, the others follow from 256 on in order."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return {b: 256 + i for i, b in enumerate(others)}


_LETTERS = _byte_letters()
#: words of lower-case letters that no normalisation changes and no rule of the vocabulary splits
_PLAIN = re.compile("[a-zß-öø-ÿ]+")


class Words(dict):
    """Ids of words, as little-endian 32-bit words, that this worker has met. A word that marks follow is that word and
    the marks: the vocabulary splits there. Plain words go to the vocabulary's merges directly. When the table is full
    it becomes the older generation, from which words that are met again return."""

    def __init__(self, path: str, limit: int = CACHE_WORDS):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer, self.limit, self.older, self.misses = Tokenizer.from_file(path), limit, {}, 0
        self.merge = self.tokenizer.model.tokenize

    def __missing__(self, word: bytes) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            core = word.rstrip(_MARKS)
            if core != word and core and 97 <= core[-1] <= 122:
                ids = self[core] + self[word[len(core) :]]
            else:
                ids = self._encoded(word)
        self[word] = ids
        return ids

    def _encoded(self, word: bytes) -> bytes:
        self.misses += 1
        text = word.decode()
        if _PLAIN.fullmatch(text):
            found = [t.id for t in self.merge(text if text.isascii() else word.decode("latin-1").translate(_LETTERS))]
        else:
            found = self.tokenizer.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(found)}I", *found)

    def turn(self) -> None:
        """A new generation, where this one is full."""
        if len(self) > self.limit:
            self.older = dict(self)
            self.clear()


def token_bytes(texts: list[bytes], path: str) -> list[bytes]:
    """The ids of each text (UTF-8). The vocabulary is one of lower case and never merges across blanks, so what stands
    between blanks and line ends is tokenised once and looked up afterwards; texts that may hold a special token keep their case."""
    known = _known.get(path) or _known.setdefault(path, Words(path))
    known.turn()
    known[b""] = b""
    get = known.__getitem__
    return [b"".join(map(get, (t if b"<|" in t else t.lower()).replace(b"\n", b" ").split(b" "))) for t in texts]


PIECES = "row long, part int, doc_id long, start long, length long, ids_crc32 long, head_crc32 long, tail_crc32 long, doc_tokens long"


def _pieces(part: Iterator[pa.RecordBatch], path: str, seq_len: int, end_id: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    number, row, end, half = TaskContext.get().partitionId(), TaskContext.get().partitionId() << 40, end_id.to_bytes(4, "little"), seq_len // 2
    names = ["row", "part", "doc_id", "start", "length", "ids_crc32", "head_crc32", "tail_crc32", "doc_tokens"]
    types = [pa.int64(), pa.int32(), *[pa.int64()] * 7]
    for batch in part:
        out = []
        for doc, ids in zip(batch.column(0).to_pylist(), token_bytes(batch.column(1).to_pylist(), path), strict=True):
            ids = memoryview(ids + end)
            n = len(ids) // 4
            for start in range(0, n, seq_len):
                piece = ids[4 * start : 4 * (start + seq_len)]
                length, head, tail = len(piece) // 4, None, None
                if half < length < seq_len:
                    head, tail = zlib.crc32(piece[: 4 * half]), zlib.crc32(piece[4 * half :])
                out.append((row, number, doc, start, length, zlib.crc32(piece), head, tail, n))
                row += 1
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 9, types, strict=True)], names=names)


# --- the linear program -----------------------------------------------------------------------------------------------


def _best_pattern(value: np.ndarray, sizes: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack: the pattern of the highest total value within room."""
    best, last = np.zeros(room + 1), np.full(room + 1, -1)
    for r in range(1, room + 1):
        fits = np.searchsorted(sizes, r, "right")
        best[r], last[r] = best[r - 1], -2
        if fits:
            worth = best[r - sizes[:fits]] + value[:fits]
            k = int(worth.argmax())
            if worth[k] > best[r] + 1e-12:
                best[r], last[r] = worth[k], k
    pattern, r = np.zeros(len(sizes)), room
    while r > 0 and last[r] != -1:
        if last[r] == -2:
            r -= 1
        else:
            pattern[last[r]] += 1
            r -= sizes[last[r]]
    return best[room], pattern


def solve_patterns(sizes: np.ndarray, demand: np.ndarray, room: int, gap: float = GAP) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (rows) and how often each is used, fractional; the revised simplex method, one column priced at a time."""
    m = len(sizes)
    start = room // sizes
    basis, inverse, x = np.diag(start.astype(float)), np.diag(1.0 / start), demand / start
    for _ in range(40 * m + 100):
        duals = inverse.sum(axis=0)
        worth, column = _best_pattern(np.maximum(duals, 0), sizes, room)
        if worth <= 1 + 1e-9 or duals @ demand / worth >= x.sum() * (1 - gap):
            break
        move = inverse @ column
        ratios = np.where(move > 1e-9, x / np.where(move > 1e-9, move, 1), np.inf)
        leave = int(ratios.argmin())
        step = max(ratios[leave], 0.0)
        x = x - step * move
        x[leave] = step
        pivot = inverse[leave] / move[leave]
        inverse = inverse - np.outer(move, pivot)
        inverse[leave] = pivot
        basis[:, leave] = column
    return basis.T, np.maximum(x, 0)


def _fill(sizes: list[int], room: int) -> list[list[int]]:
    """Largest piece first, into the fullest sequence that takes it."""
    bins: list[list[int]] = []
    left: list[tuple[int, int]] = []
    for s in sorted(sizes, reverse=True):
        at = bisect.bisect_left(left, (s, -1))
        if at < len(left):
            space, b = left.pop(at)
        else:
            space, b = room, len(bins)
            bins.append([])
        bins[b].append(s)
        bisect.insort(left, (space - s, b))
    return bins


def plan_patterns(counts: dict[int, int], room: int) -> tuple[list[tuple[dict[int, int], int]], float]:
    """Whole patterns with their number of uses, which together take every piece; and the program's optimum."""
    if not counts:
        return [], 0.0
    sizes = np.array(sorted(counts))
    demand = np.array([counts[s] for s in sizes.tolist()], float)
    patterns, x = solve_patterns(sizes, demand, room)
    uses: Counter = Counter()
    rest = demand.astype(int)
    for row, times in zip(patterns.astype(int), np.floor(x + 1e-7).astype(int).tolist(), strict=True):
        held = row > 0
        times = min([times, *(rest[held] // row[held]).tolist()])
        if times > 0 and held.any():
            uses[tuple(zip(sizes[held].tolist(), row[held].tolist(), strict=True))] += times
            rest = rest - times * row
    for b in _fill(np.repeat(sizes, rest).tolist(), room):
        uses[tuple(sorted(Counter(b).items()))] += 1
    return [(dict(p), n) for p, n in sorted(uses.items())], float(x.sum())


class Slots:
    """For each class, where its ranks go: pattern counts laid end to end."""

    def __init__(self, patterns: list[tuple[dict[int, int], int]]):
        self.of: dict[int, dict[str, list]] = {}
        first = 0
        for pattern, times in patterns:
            order = 0
            for size in sorted(pattern, reverse=True):
                mine = self.of.setdefault(size, {"end": [], "first": [], "copies": [], "order": []})
                mine["end"].append((mine["end"][-1] if mine["end"] else 0) + pattern[size] * times)
                mine["first"].append(first)
                mine["copies"].append(pattern[size])
                mine["order"].append(order)
                order += pattern[size]
            first += times
        self.sequences = first
        self.of = {k: {n: np.array(a, np.int64) for n, a in v.items()} for k, v in self.of.items()}

    def place(self, size: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and order in it for each (class, rank)."""
        sequence, order = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
        for s in np.unique(size):
            t, at = self.of[int(s)], np.flatnonzero(size == s)
            entry = np.searchsorted(t["end"], rank[at], "right")
            inside = rank[at] - np.where(entry > 0, t["end"][entry - 1], 0)
            sequence[at] = t["first"][entry] + inside // t["copies"][entry]
            order[at] = t["order"][entry] + inside % t["copies"][entry]
        return sequence, order


# --- over the table ---------------------------------------------------------------------------------------------------


def pack(docs: DataFrame, tokenizer: str, seq_len: int = 2048, end_id: int = 1, unit: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. ``tokenizer`` is the path
    of a vocabulary file that every executor has; seq_len is a multiple of 2 * unit."""
    narrow = docs.select(F.col(id_col).cast("long"), text_bytes(text_col))
    pieces = materialise(narrow.mapInArrow(partial(_pieces, path=tokenizer, seq_len=seq_len, end_id=end_id), PIECES))
    size = F.ceil(F.col("length") / unit).cast("int")
    short = pieces.where(F.col("length") < seq_len).withColumn("size", size)
    counts = {r["size"]: r["n"] for r in short.groupBy("size").agg(F.count("*").alias("n")).collect()}  # at most seq_len / unit rows
    room, half = seq_len // unit, seq_len // 2 // unit
    patterns, optimum = plan_patterns(counts, room)
    used = sum(s * n for s, n in counts.items())
    if optimum * room > used * (1 + HALVE_ABOVE) + room:
        halved: Counter = Counter()
        for s, n in counts.items():
            for cut in ([half, s - half] if s > half else [s]):  # half is a whole number of units
                halved[cut] += n
        pieces, counts = _halve(pieces, seq_len), dict(halved)
        short = pieces.where(F.col("length") < seq_len).withColumn("size", size)
        patterns, _ = plan_patterns(counts, room)
    slots = Slots(patterns)
    # dense rank of a piece in its class: pieces of earlier parts first, then by row
    by_part = short.groupBy("size", "part").agg(F.count("*").alias("n"))
    before = by_part.withColumn("before", F.sum("n").over(Window.partitionBy("size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)))
    local = F.row_number().over(Window.partitionBy("size", "part").orderBy("row", "start")) - 1
    ranked = short.withColumn("local", local).join(before.select("size", "part", F.coalesce("before", F.lit(0)).alias("before")), ["size", "part"])
    ranked = ranked.withColumn("rank", F.col("local") + F.col("before"))

    def place(part: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in part:
            sequence, order = slots.place(*(np.asarray(batch.column(i), np.int64) for i in (5, 6)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(order)], names=[*batch.schema.names[:5], "sequence_id", "ord"])

    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    placed = ranked.select(*columns, "size", "rank").mapInArrow(place, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, ord long")
    inside = Window.partitionBy("sequence_id").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)  # at most seq_len pieces
    placed = placed.withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0).cast("long"))).drop("ord")
    whole = pieces.where(F.col("length") == seq_len).select(*columns, (F.col("row") + F.lit(slots.sequences)).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return placed.unionByName(whole)


def _halve(pieces: DataFrame, seq_len: int) -> DataFrame:
    """Cut each remainder longer than half a sequence there."""
    half = seq_len // 2
    cut = F.col("head_crc32").isNotNull()
    head = F.struct(F.col("start"), F.lit(half).cast("long").alias("length"), F.col("head_crc32").alias("ids_crc32"))
    tail = F.struct((F.col("start") + half).alias("start"), (F.col("length") - half).alias("length"), F.col("tail_crc32").alias("ids_crc32"))
    whole = F.struct("start", "length", "ids_crc32")
    each = pieces.select("row", "part", "doc_id", "doc_tokens", F.explode(F.when(cut, F.array(head, tail)).otherwise(F.array(whole))).alias("p"))
    return each.select("row", "part", "doc_id", "doc_tokens", "p.*")
