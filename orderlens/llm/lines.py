"""Repeated lines, found through sharded minimal perfect hashes.

The distinct hashes of lines that more than one document holds are dealt into shards.
Each shard gets a minimal perfect hash (levels of collision-free bits, as in the
published bit-array constructions) that indexes flat arrays: a 64-bit fingerprint,
the number of documents (32 bits, larger numbers held at the largest) and the smallest
document id. Documents probe the arrays, and the count found there decides; no line
is joined with another. A line is known by 128 bits: 64 find its place, 64 are the
fingerprint. A line of one document needs no place where two are asked for: a probe
that finds nothing says the same.

Arrays of at most ``broadcast_bytes`` travel to every task. Larger ones stay in
their shards: the distinct hashes of a bucket of documents go to the shards, split
over several copies of a shard, and what they find goes back to the bucket.

Cases: null text is one empty line, as is empty text. An empty key is never counted
(a key has at least ``min_chars`` code points and ``min_words`` words). Each row is a document, repeated rows
too. Columns of the input other than the two named ones are carried as they are.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.llm.common import column_names, materialise, mix64, release, text_bytes

BLANKS = b" \t\n\x0b\x0c\r"
SHARD_KEYS = 200_000
SHARD = "shard int, n long, seed long, levels array<long>, bits binary, prints binary, counts binary, firsts binary"


def line_keys(text: bytes, min_chars: int, min_words: int = 0) -> tuple[list[bytes], list[bytes]]:
    """The lines and, for each, 16 bytes of its key, empty for a key that is too short."""
    lines = text.split(b"\n")
    digest, keys = xxhash.xxh3_128_digest, [x.strip(BLANKS) for x in text.lower().split(b"\n")]
    if min_words:  # a word and the blank behind it take two bytes
        keys = [k if len(k) >= 2 * min_words - 1 and len(k.split()) >= min_words else b"" for k in keys]
        min_chars = max(min_chars, 1)
    if min_chars <= 1:
        return lines, [digest(k) if len(k) >= min_chars else b"" for k in keys]
    return lines, [digest(k) if len(k) >= min_chars and len(k.decode()) >= min_chars else b"" for k in keys]


def _count_batch(part: Iterator[pa.RecordBatch], min_chars: int, min_words: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("n", pa.int64()), ("first", pa.int64())])
    for batch in part:
        found: dict[bytes, list] = {}
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for key in set(line_keys(text, min_chars, min_words)[1]):
                if not key:
                    continue
                seen = found.setdefault(key, [0, None])
                seen[0] += 1
                if doc is not None and (seen[1] is None or doc < seen[1]):
                    seen[1] = doc
        if found:
            h = np.frombuffer(b"".join(found), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array([v[0] for v in found.values()], pa.int64()), pa.array([v[1] for v in found.values()], pa.int64())],
                schema=schema,
            )


def line_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 1, min_words: int = 0) -> DataFrame:
    """(h1, h2, n, first): documents with each line; counted per batch, then per task, before the exchange."""
    pairs = docs.select(F.col(id_col).cast("long").alias("d"), text_bytes(text_col).alias("t"))
    each = pairs.mapInArrow(partial(_count_batch, min_chars=min_chars, min_words=min_words), "h1 long, h2 long, n long, first long")
    return each.groupBy("h1", "h2").agg(F.sum("n").alias("n"), F.min("first").alias("first"))


class PerfectHash:
    """Level bitmaps over n distinct 64-bit keys: place(key) is in 0..n-1, and different for each key."""

    GAMMA = 2.0

    def __init__(self, levels: list[int], words: np.ndarray):
        self.levels, self.words = levels, words
        ones = np.bitwise_count(words).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(ones)])[:-1]

    @staticmethod
    def _at(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix64(keys + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))) % np.uint64(size)).astype(np.int64)

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, words, left = [], [], keys
        while len(left):
            size = max(64, math.ceil(len(left) * cls.GAMMA / 64) * 64)
            at = cls._at(left, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            words.append(np.packbits(alone, bitorder="little").view(np.uint64))
            levels.append(size)
            left = left[~alone[at]]
        return cls(levels, np.concatenate(words) if words else np.zeros(0, np.uint64))

    def place(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key; -1 or any place for keys that were not built in."""
        out, open_, start = np.full(len(keys), -1, np.int64), np.arange(len(keys)), 0
        for level, size in enumerate(self.levels):
            at = self._at(keys[open_], level, size)
            word, bit = start + (at >> 6), (at & 63).astype(np.uint64)
            hit = (self.words[word] >> bit) & np.uint64(1) == 1
            below = self.words[word[hit]] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            out[open_[hit]] = self.before[word[hit]] + np.bitwise_count(below)
            open_, start = open_[~hit], start + size // 64
        return out


def _mixed(h1: np.ndarray, h2: np.ndarray, seed: int) -> np.ndarray:
    return mix64(h1.view(np.uint64) ^ mix64(h2.view(np.uint64) + np.uint64(seed)))


class Shard:
    def __init__(self, row):
        self.seed, self.hash = row["seed"], PerfectHash(list(row["levels"]), np.frombuffer(row["bits"], np.uint64))
        self.prints, self.counts, self.firsts = (np.frombuffer(row[k], t) for k, t in ARRAYS.items())

    def probe(self, h1: np.ndarray, h2: np.ndarray, min_docs: int) -> tuple[np.ndarray, np.ndarray]:
        """Whether at least min_docs documents hold the line, and the first of them, for each hash."""
        at = self.hash.place(_mixed(h1, h2, self.seed))
        found = at >= 0
        found[found] = (self.prints[at[found]] == h2[found]) & (self.counts[at[found]] >= min_docs)
        return found, self.firsts[np.where(found, at, 0)]


NO_ID = np.iinfo(np.int64).min
MOST = np.iinfo(np.uint32).max
ARRAYS = {"prints": np.int64, "counts": np.uint32, "firsts": np.int64}


def _build(rows: pd.DataFrame) -> pd.DataFrame:
    h1, h2, seed = rows["h1"].to_numpy(np.int64), rows["h2"].to_numpy(np.int64), 0
    while len(np.unique(keys := _mixed(h1, h2, seed))) < len(keys):
        seed += 1
    ph = PerfectHash.build(keys)
    at, arrays = ph.place(keys), {}
    for name, kind in ARRAYS.items():
        arrays[name] = np.zeros(len(rows), kind)
    arrays["prints"][at], arrays["counts"][at], arrays["firsts"][at] = h2, np.minimum(rows["n"], MOST), rows["first"]
    flat = {k: v.tobytes() for k, v in arrays.items()}
    return pd.DataFrame([{"shard": rows["shard"].iloc[0], "n": len(rows), "seed": seed, "levels": ph.levels, "bits": ph.words.tobytes(), **flat}])


def _shard_of(n: int):
    return F.pmod(F.col("h1"), F.lit(n)).cast("int")


def build_shards(counts: DataFrame, least: int = 1) -> tuple[DataFrame, int, int]:
    """The stored shards over the lines of ``least`` documents, their number and their bytes."""
    keep = materialise(counts.where(F.col("n") >= least).withColumn("first", F.coalesce("first", F.lit(NO_ID))))
    n = max(1, math.ceil(keep.count() / SHARD_KEYS))
    shards = materialise(keep.withColumn("shard", _shard_of(n)).groupBy("shard").applyInPandas(_build, SHARD))
    release(keep)
    size = shards.select(F.sum(F.length("bits") + F.length("prints") + F.length("counts") + F.length("firsts"))).first()[0] or 0
    return shards, n, size


def _split(doc, text: bytes, min_chars: int, min_words: int, gone) -> tuple[int, int, str]:
    """Lines, lines dropped, what stays. gone(doc, keys) says which keys lose their lines."""
    lines, keys = line_keys(text, min_chars, min_words)
    drop = gone(doc, keys)
    return len(lines), sum(drop), b"\n".join([x for x, d in zip(lines, drop, strict=True) if not d]).decode() if any(drop) else text.decode()


def _probe_batch(keys: list[bytes], shards: dict[int, Shard], n: int, min_docs: int) -> dict[bytes, int]:
    """The first document of each key that the arrays count in enough documents."""
    unique = list({k for k in keys if k})
    if not unique or not shards:
        return {}
    h = np.frombuffer(b"".join(unique), "<i8").reshape(-1, 2)
    shard, out = h[:, 0] % n, {}
    for s in np.unique(shard):
        if int(s) in shards:
            at = np.flatnonzero(shard == s)
            found, first = shards[int(s)].probe(np.ascontiguousarray(h[at, 0]), np.ascontiguousarray(h[at, 1]), min_docs)
            out.update((unique[i], f) for i, f in zip(at[found].tolist(), first[found].tolist(), strict=True))
    return out


def _result(batch: pa.RecordBatch, id_name: str, text_name: str, held: dict[bytes, int], min_chars: int, min_words: int, keep_first: bool) -> pa.RecordBatch:
    def gone(doc, keys):
        return [k in held and not (keep_first and doc is not None and held[k] == doc) for k in keys]

    docs = batch.column(batch.schema.get_field_index(id_name)).to_pylist()
    texts = batch.column(batch.schema.get_field_index(text_name)).to_pylist()
    n, dropped, kept = zip(*(_split(d, t or b"", min_chars, min_words, gone) for d, t in zip(docs, texts, strict=True)), strict=True)
    rest = [batch.column(i) for i, f in enumerate(batch.schema) if f.name != text_name]
    return pa.RecordBatch.from_arrays(
        [*rest, pa.array(n, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.string())],
        names=[*(f.name for f in batch.schema if f.name != text_name), "n_lines", "n_dropped", "kept"],
    )


def _apply_local(part: Iterator[pa.RecordBatch], id_name, text_name, rows, n, min_docs, min_chars, min_words, keep_first) -> Iterator[pa.RecordBatch]:
    shards = {r["shard"]: Shard(r) for r in rows}
    for batch in part:
        if batch.num_rows:
            texts = batch.column(batch.schema.get_field_index(text_name)).to_pylist()
            held = _probe_batch([k for t in texts for k in line_keys(t or b"", min_chars, min_words)[1]], shards, n, min_docs)
            yield _result(batch, id_name, text_name, held, min_chars, min_words, keep_first)


def _bucket_keys(part: Iterator[pa.RecordBatch], bucket: str, text_name: str, min_chars: int, min_words: int) -> Iterator[pa.RecordBatch]:
    for batch in part:
        found = set()
        for b, t in zip(batch.column(batch.schema.get_field_index(bucket)).to_pylist(), batch.column(batch.schema.get_field_index(text_name)).to_pylist(), strict=True):
            found.update((b, k) for k in line_keys(t or b"", min_chars, min_words)[1] if k)
        if found:
            found = list(found)
            h = np.frombuffer(b"".join(k for _, k in found), "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array([b for b, _ in found], pa.int64()), pa.array(h[:, 0]), pa.array(h[:, 1])], names=["b", "h1", "h2"])


def _ask(probes: pd.DataFrame, shard: pd.DataFrame, min_docs: int) -> pd.DataFrame:
    if probes.empty or shard.empty:
        return pd.DataFrame({"b": pd.Series(dtype="int64"), "h1": pd.Series(dtype="int64"), "h2": pd.Series(dtype="int64"), "first": pd.Series(dtype="int64")})
    found, first = Shard(shard.iloc[0]).probe(probes["h1"].to_numpy(np.int64), probes["h2"].to_numpy(np.int64), min_docs)
    out = probes.loc[found, ["b", "h1", "h2"]].copy()
    out["first"] = first[found]
    return out


def _apply_bucket(docs: pa.Table, hits: pa.Table, id_name, text_name, bucket, min_chars, min_words, keep_first) -> pa.Table:
    h = np.column_stack([hits.column("h1").to_numpy(), hits.column("h2").to_numpy()]).astype("<i8").tobytes()
    held = {h[16 * i : 16 * i + 16]: f for i, f in enumerate(hits.column("first").to_pylist())}
    done = [_result(b, id_name, text_name, held, min_chars, min_words, keep_first) for b in docs.drop_columns([bucket]).to_batches() if b.num_rows]
    return pa.Table.from_batches(done)


def drop_repeated_lines(
    docs: DataFrame, min_docs: int = 10, min_chars: int = 1, keep_first: bool = False, id_col: str = "doc_id", text_col: str = "text",
    broadcast_bytes: int = 32 << 20, bucket_bytes: int = 16 << 20, min_words: int = 0,
) -> DataFrame:
    """The input without its text column, and n_lines, n_dropped and kept, the text that stays. Lines found in at
    least min_docs rows go everywhere, or, with keep_first, everywhere but in the document of the smallest id. With min_words, lines of fewer words stay, and so do those that only rows
    without an id hold."""
    counts = line_counts(docs, id_col, text_col, min_chars, min_words)
    shards, n, size = build_shards(counts.where("first is not null") if min_words else counts, min(2, min_docs))
    names = column_names(docs, ["n_lines", "n_dropped", "kept", "bucket", "text_utf8"])
    if any(names[k] != k for k in ("n_lines", "n_dropped", "kept")):
        docs = docs.drop(*(k for k in ("n_lines", "n_dropped", "kept") if k != text_col))
    text = names["text_utf8"]
    given = docs.withColumn(text, text_bytes(text_col)).drop(text_col)
    out = T.StructType([*(f for f in given.schema if f.name != text), T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()), T.StructField("kept", T.StringType())])
    if size <= broadcast_bytes:
        rows = [r.asDict() for r in shards.collect()]  # at most broadcast_bytes
        return given.mapInArrow(partial(_apply_local, id_name=id_col, text_name=text, rows=rows, n=n, min_docs=min_docs, min_chars=min_chars, min_words=min_words, keep_first=keep_first), out)
    total = given.select(F.sum(F.length(text))).first()[0] or 0
    buckets, b = max(1, math.ceil(total / bucket_bytes)), names["bucket"]
    given = given.withColumn(b, F.pmod(F.xxhash64(F.col(id_col), F.col(text)), F.lit(buckets)))
    probes = given.select(b, text).mapInArrow(partial(_bucket_keys, bucket=b, text_name=text, min_chars=min_chars, min_words=min_words), "b long, h1 long, h2 long").distinct()
    copies = max(1, math.ceil(buckets * bucket_bytes / (64 * SHARD_KEYS * n)))
    probes = probes.withColumn("shard", _shard_of(n)).withColumn("copy", F.pmod("b", F.lit(copies)))
    copied = shards.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(copies - 1).cast("long"))))
    hits = probes.groupBy("shard", "copy").cogroup(copied.groupBy("shard", "copy")).applyInPandas(lambda left, right: _ask(left, right, min_docs), "b long, h1 long, h2 long, first long")
    apply = partial(_apply_bucket, id_name=id_col, text_name=text, bucket=b, min_chars=min_chars, min_words=min_words, keep_first=keep_first)
    return given.groupBy(b).cogroup(hits.groupBy("b")).applyInArrow(lambda left, right: apply(left, right), out)
