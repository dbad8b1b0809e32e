"""Vector codes by parts, with codebooks trained on exact integers; LAESA pivots save distance evaluations.

Vectors are cut into equal consecutive parts; each part position has a codebook. The distances of every part to a few
fixed pivots are computed once and stored beside the vector. In each round the driver knows the distances of the pivots
to the codebook entries, so |d(part, pivot) - d(pivot, entry)| is a lower bound of d(part, entry) by the triangle
inequality. Entries are taken in the order of their largest bound, in waves of growing width, and a part is done when
the next bound is beyond its best exact distance. Only integers decide: the bounds are lowered by more than their
rounding error, and a bound equal to the best distance is evaluated, so ties go to the lower index as in a full scan.

A task returns sums and counts of its parts by entry, never rows; a codebook and the pivots are all that the driver
holds (parts x entries x part length numbers). The initial entries come from the smallest ids, found in two steps of
bounded lists.

Cases: rows whose vector is null or holds null or non-finite components take no part. Codebooks are made for the length
that most vectors have (ties: the shorter) among those that the parts divide; other vectors keep their row with null
code and error. A null id takes part, but is no initial entry. Rows that repeat an id are rows of their own, ordered by
their components among the initial entries. With fewer rows than entries the codebook is shorter. Components beyond
64-bit arithmetic are computed with Python's integers; an error that no long can hold is null.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.llm.common import materialise

#: parts of the first exchange of small ids
ID_PARTS = 64
#: bits of a limb when sums travel
LIMB = 56
#: bounds are floats: lowered by (a + b) * SLACK, which is four times the rounding error of both
SLACK = 2.0**-22


@dataclass
class Codebooks:
    """entries: (parts, entries, part length) integers; pivots: (parts, pivots, part length)."""

    entries: np.ndarray
    pivots: np.ndarray

    def sha256(self) -> str:
        return hashlib.sha256(",".join(str(int(c)) for c in self.entries.reshape(-1)).encode()).hexdigest()


def finite(vec: str) -> Column:
    sound = ~F.exists(vec, lambda x: F.coalesce(F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")), F.lit(True)))
    return F.col(vec).isNotNull() & sound


def scaled(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x) as 64-bit integers, or as Python's integers where squares or sums could leave 64 bits."""
    if x.size == 0 or np.abs(x).max() * scale < 2**24:
        return np.floor(x * scale).astype(np.int64)
    flat = [math.floor(Fraction(float(v)) * scale) for v in x.reshape(-1)]
    return np.array(flat, dtype=object).reshape(x.shape)


def squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances along the last axis, by broadcasting."""
    if a.dtype == object or b.dtype == object:
        a, b = a.astype(object), b.astype(object)
    d = a - b
    return (d * d).sum(axis=-1)


def _root(d: np.ndarray) -> np.ndarray:
    if d.dtype == object:
        d = np.array([float(v) if v < 10**300 else math.inf for v in d.reshape(-1)]).reshape(d.shape)
    return np.sqrt(d.astype(np.float64))


def _roots(d: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _root(d).astype(np.float32)


def pick_pivots(entries: np.ndarray, n: int) -> np.ndarray:
    """Far points among the entries of one part: each pivot is the entry farthest from those before it."""
    if len(entries) == 0:
        return entries
    chosen = [0]
    far = squares(entries, entries[0])
    while len(chosen) < min(n, len(entries)) and far.max() > 0:
        chosen.append(int(np.argmax(far)))
        far = np.minimum(far, squares(entries, entries[chosen[-1]]))
    return entries[chosen]


def nearest(x: np.ndarray, to_pivots: np.ndarray, entries: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Index and squared distance of each row's nearest entry, and how many distances were evaluated."""
    n, k = len(x), len(entries)
    from_pivots = _roots(squares(pivots[:, None, :], entries[None, :, :]))  # pivots x entries
    bound = np.zeros((n, k), np.float32)
    with np.errstate(invalid="ignore", over="ignore"):
        for p in range(len(pivots)):
            a, b = to_pivots[:, p, None], from_pivots[p][None, :]
            np.fmax(bound, np.abs(a - b) - (a + b) * np.float32(SLACK), out=bound)
    bound[~np.isfinite(bound)] = 0  # distances beyond the range of floats bound nothing
    order = np.argsort(bound, axis=1)
    best_at = order[:, 0].copy()
    best = squares(x, entries[best_at])
    evaluated, at, width = n, 1, 3
    rows = np.arange(n)
    while len(rows) and at < k:
        which = order[rows, at : at + width]
        low = np.take_along_axis(bound[rows], which, axis=1).astype(np.float64)
        open_ = low * (1 - 1e-6) <= _root(best[rows])[:, None] * (1 + 1e-12)
        live = open_[:, 0]
        rows, which, open_ = rows[live], which[live], open_[live]
        if not len(rows):
            break
        d = squares(x[rows][:, None, :], entries[which])
        evaluated += int(open_.sum())
        d = np.where(open_, d, d.max() + 1)
        least = d.min(axis=1)
        index = np.where(d == least[:, None], which, k).min(axis=1)
        better = (least < best[rows]) | ((least == best[rows]) & (index < best_at[rows]))
        best[rows[better]], best_at[rows[better]] = least[better], index[better]
        at, width = at + width, min(64, width * 2)
    return best_at, best, evaluated


def _rows(batch: pa.RecordBatch, name: str, length: int) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index(name))
    return np.asarray(column.flatten(), np.float64).reshape(batch.num_rows, length)


def _by_part(x: np.ndarray, parts: int) -> np.ndarray:
    return x.reshape(len(x), parts, x.shape[1] // parts)


def _small_ids(n: int):
    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(0, np.int64)
        for b in batches:
            held = np.sort(np.concatenate([held, np.asarray(b.column(0), np.int64)]))[:n]
        yield pa.RecordBatch.from_arrays([pa.array(held)], names=["id"])

    return keep


def _first_rows(rows: DataFrame, n: int) -> list:
    """Vectors of the n smallest ids: the ids first, so that few tasks send vectors."""
    ids = rows.where("id is not null").select("id").mapInArrow(_small_ids(n), "id long").repartition(ID_PARTS)
    small = ids.mapInArrow(_small_ids(n), "id long").orderBy("id").limit(n).agg(F.max("id")).first()[0]
    return [] if small is None else rows.where(F.col("id") <= F.lit(small)).orderBy("id", "v").limit(n).select("v").collect()


def _pivot_distances(length: int, parts: int, scale: int, pivots: np.ndarray):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = _by_part(scaled(_rows(b, "v", length), scale), parts)
                d = np.concatenate([_roots(squares(x[:, p, None, :], pivots[p][None])) for p in range(parts)], axis=1)
                flat = np.ascontiguousarray(d, np.float32)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array([r.tobytes() for r in flat], pa.binary())], names=[*b.schema.names, "to_pivots"])

    return add


def _assigned(b: pa.RecordBatch, length: int, parts: int, scale: int, books: Codebooks):
    x = _by_part(scaled(_rows(b, "v", length), scale), parts)
    raw = b"".join(b.column(b.schema.get_field_index("to_pivots")).to_pylist())
    d = np.frombuffer(raw, np.float32).reshape(len(x), -1)
    start = 0
    for p in range(parts):
        n = len(books.pivots[p])
        yield p, x[:, p], *nearest(x[:, p], d[:, start : start + n], books.entries[p], books.pivots[p])
        start += n


def _limbs(value: int) -> Iterator[tuple[int, int]]:
    """value = sum of limb * 2^(LIMB * number); the last limb has the sign."""
    number = 0
    while not -(1 << LIMB) < value < (1 << LIMB):
        value, low = value >> LIMB, value & ((1 << LIMB) - 1)
        yield number, low
        number += 1
    yield number, value


def _sums(length: int, parts: int, scale: int, books: Codebooks):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = length // parts
        total = np.zeros((parts, len(books.entries[0]), width + 1), object)  # the last place counts
        for b in batches:
            if not b.num_rows:
                continue
            for p, x, index, _, _ in _assigned(b, length, parts, scale, books):
                order = np.argsort(index, kind="stable")
                used, first = np.unique(index[order], return_index=True)
                total[p, used, :width] += np.add.reduceat(x[order], first, axis=0).astype(object)
                total[p, used, width] += np.diff([*first.tolist(), len(index)]).astype(object)
        p, e = np.nonzero((total[:, :, width] != 0))
        rows = [(int(i), int(j), at, k, v) for i, j in zip(p, e, strict=True) for at in range(width + 1) for k, v in _limbs(int(total[i, j, at]))]
        columns = list(zip(*rows, strict=True)) or [()] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["part", "entry", "at", "limb", "value"])

    return add


def _moved(rows: DataFrame, books: Codebooks, length: int, scale: int) -> Codebooks:
    parts = len(books.entries)
    width = length // parts
    sums = rows.mapInArrow(_sums(length, parts, scale, books), "part long, entry long, at long, limb long, value long")
    totals: dict[tuple[int, int], list[int]] = {}
    for r in sums.groupBy("part", "entry", "at", "limb").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value")).collect():  # size of a codebook
        t = totals.setdefault((r["part"], r["entry"]), [0] * (width + 1))
        t[r["at"]] += int(r["value"]) << (LIMB * r["limb"])
    entries = books.entries.astype(object)
    for (p, e), t in totals.items():
        entries[p, e] = [s // t[width] for s in t[:width]]  # floor, also below zero
    return Codebooks(_tight(entries), books.pivots)


def _tight(entries: np.ndarray) -> np.ndarray:
    """64-bit integers where they are safe for squares."""
    small = all(abs(int(c)) < 2**25 for c in entries.reshape(-1))
    return entries.astype(np.int64 if small else object)


def _codes(length: int, parts: int, scale: int, books: Codebooks):
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            index, error = np.zeros((b.num_rows, parts), np.int64), np.zeros(b.num_rows, object)
            for p, _, i, d, _ in _assigned(b, length, parts, scale, books):
                index[:, p] = i
                error += d.astype(object)
            code = ["".join(f"{v:02x}" for v in r) for r in index.tolist()]
            errors = [int(e) if e < 2**63 else None for e in error]
            kept = [b.column(b.schema.get_field_index(c)) for c in ("id", "label")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(code, pa.string()), pa.array(errors, pa.int64())], names=["vec_id", "label", "code", "error"])

    return code


def compress(
    vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024, pivots: int = 8,
    id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
) -> tuple[DataFrame, Codebooks]:
    """(vec_id, label, code, error) of every sound vector, stored, and the codebooks. ``entries`` is at most 256."""
    sound = vectors.where(finite(vec_col)).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vec_col).alias("v"))
    sizes = sound.groupBy(F.size("v").alias("n")).count().where(f"n > 0 and n % {parts} = 0").orderBy(F.desc("count"), "n").first()
    out = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("label", sound.schema["label"].dataType), T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    uncoded = sound.select(F.col("id").alias("vec_id"), "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"), F.size("v").alias("n"))
    if sizes is None:
        return uncoded.drop("n"), Codebooks(np.zeros((parts, 0, 0), np.int64), np.zeros((parts, 0, 0), np.int64))
    length = sizes["n"]
    rows = sound.where(F.size("v") == length)
    first = np.array([r["v"] for r in _first_rows(rows, entries)], np.float64).reshape(-1, length)
    if not len(first):  # no row has an id: nothing to start from
        return uncoded.drop("n"), Codebooks(np.zeros((parts, 0, 0), np.int64), np.zeros((parts, 0, 0), np.int64))
    start = _tight(np.swapaxes(_by_part(scaled(first, scale), parts), 0, 1).astype(object))
    # parts may find different numbers of distinct pivots: all take the least
    found = [pick_pivots(start[p], pivots) for p in range(parts)]
    books = Codebooks(start, np.stack([f[: min(map(len, found))] for f in found]))
    schema = T.StructType([*rows.schema.fields, T.StructField("to_pivots", T.BinaryType())])
    stored = materialise(rows.mapInArrow(_pivot_distances(length, parts, scale, books.pivots), schema))
    for _ in range(rounds):
        books = _moved(stored, books, length, scale)
    coded = stored.mapInArrow(_codes(length, parts, scale, books), out)
    return materialise(coded.unionByName(uncoded.where(F.col("n") != length).drop("n"))), books


def with_label_errors(codes: DataFrame) -> DataFrame:
    """Adds label_error: the errors of all rows of the label, nulls as one label; null where no long can hold it."""
    total = codes.groupBy(F.col("label").alias("of_label")).agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("sum_error"))
    joined = codes.join(total, F.col("label").eqNullSafe(F.col("of_label")))
    return joined.drop("of_label").withColumn("label_error", F.expr("try_cast(sum_error as bigint)")).drop("sum_error")
