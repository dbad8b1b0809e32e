"""How the sources of a language differ in their words: single-pass in-memory indexing, then pair corrections.

**Index.** A task reads its documents once and keeps postings in memory: for each language the documents of each term,
for each (language, source) the occurrences. When the block is full it is spilled as a run: its terms are sorted by
hash shard, language and term, and each shard's part travels as one packed row. Runs are merged by a heap, shard by
shard. Where more tasks than ``FAN`` wrote runs, neighbouring ones are merged first and their shards are split further,
so that a merge never holds much more than a block. What comes out is one row for each kept term with its counts by source.

**Corrections.** A source that lacks a term gives it the same share, whatever the term, so the difference of two sources
is V times the difference of these two base shares, plus a correction for each term that one of both holds. Shards of the
merged index are streamed past a block of sources; the work is postings times sources, memory is bounded by the block
times the sources of the language. The ``TOP`` terms of each shard and group are taken in the same pass.

Shares are p = 1 + floor(10^9 (count + 5) / (N + 5 V)), by long division in 64-bit integers, exact for any count below 9 * 10^15.

Cases: null text, language and source count as empty strings. A group without terms takes part in all pairs of its
language; where a language keeps no term, its pair values are 0. Rows that repeat an id are documents of their own.
"""

from __future__ import annotations

import heapq
import json
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import materialise, text_bytes

#: terms and postings of a block in memory
BLOCK_TERMS, BLOCK_POSTINGS = 400_000, 2_000_000
#: bytes of one text looked at at a time
PIECE = 1 << 20
#: hash shards of a run, and tasks whose runs are merged in one step
SHARDS, FAN = 64, 64
#: numbers of one matrix in the pass of corrections
MATRIX = 2_000_000
#: terms of a group in the report
TOP = 50
SMOOTH, SCALE = 5, 1_000_000_000

# A-Z become a-z, every other ASCII character but a-z becomes a space; bytes beyond ASCII are parts of terms
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))

RUN = "shard int, run long, payload binary"
_RUN_SCHEMA = pa.schema([("shard", pa.int32()), ("run", pa.int64()), ("payload", pa.binary())])
INDEX = "shard int, lang string, term string, docs long, sources array<string>, counts array<long>"
_INDEX_SCHEMA = pa.schema([("shard", pa.int32()), ("lang", pa.string()), ("term", pa.string()), ("docs", pa.int64()), ("sources", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])
_PART_SCHEMA = pa.schema([("lang", pa.string()), ("part", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64()), ("one_sided", pa.int64())])
PART = "lang string, part string, source string, item string, value long, one_sided long"


def _table(columns: list, schema: pa.Schema) -> pa.Table:
    return pa.table([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _turned(rows: list[tuple], width: int) -> list:
    return list(zip(*rows, strict=True)) or [()] * width


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    first = np.flatnonzero(np.diff(keys, prepend=keys[:1] - 1))
    return (keys[first], np.add.reduceat(values, first)) if len(keys) else (keys, values)


class Run:
    """Sorted keys (language, a zero byte, term) with their documents and their postings: source numbers and counts."""

    def __init__(self, keys: list[bytes], docs: np.ndarray, starts: np.ndarray, codes: np.ndarray, counts: np.ndarray, sources: list[str]):
        self.keys, self.docs, self.starts, self.codes, self.counts, self.sources = keys, docs, starts, codes, counts, sources

    def part(self, start: int, end: int) -> bytes:
        a, b = self.starts[start], self.starts[end]
        lists = pa.array(self.starts[start : end + 1] - a, pa.int32())
        codes = pa.ListArray.from_arrays(lists, pa.array(self.codes[a:b], pa.int32()))
        counts = pa.ListArray.from_arrays(lists, pa.array(self.counts[a:b], pa.int64()))
        batch = pa.record_batch([pa.array(self.keys[start:end], pa.binary()), pa.array(self.docs[start:end]), codes, counts], names=["key", "docs", "codes", "counts"])
        sink = pa.BufferOutputStream()
        schema = batch.schema.with_metadata({"sources": json.dumps(self.sources)})
        with pa.ipc.new_stream(sink, schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
            out.write_batch(batch.replace_schema_metadata(schema.metadata))
        return sink.getvalue().to_pybytes()

    @staticmethod
    def read(payload: bytes) -> Run:
        table = pa.ipc.open_stream(payload).read_all()
        (batch,) = table.combine_chunks().to_batches() or [pa.RecordBatch.from_pylist([], schema=table.schema)]
        key, docs, codes, counts = batch.columns
        return Run(key.to_pylist(), np.asarray(docs), np.asarray(codes.offsets, np.int64), np.asarray(codes.values), np.asarray(counts.values), json.loads(table.schema.metadata[b"sources"]))

    def split(self, shards: int) -> Iterator[tuple[int, bytes]]:
        """Its parts by hash shard; the order of keys stays."""
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, self.keys), np.uint64, len(self.keys)) % np.uint64(shards)
        order = np.argsort(hashes, kind="stable")
        moved = self.taken(order)
        ends = np.searchsorted(hashes[order], np.arange(shards + 1, dtype=np.uint64))
        for shard in np.flatnonzero(np.diff(ends)).tolist():
            yield shard, moved.part(int(ends[shard]), int(ends[shard + 1]))

    def taken(self, order: np.ndarray) -> Run:
        lengths = np.diff(self.starts)[order]
        starts = np.concatenate([[0], np.cumsum(lengths)])
        at = np.repeat(self.starts[:-1][order] - starts[:-1], lengths) + np.arange(starts[-1])
        keys = self.keys
        return Run([keys[i] for i in order.tolist()], self.docs[order], starts, self.codes[at], self.counts[at], self.sources)


class _Language:
    def __init__(self) -> None:
        self.ids: dict[bytes, int] = defaultdict(count().__next__)
        self.docs: list[np.ndarray] = []
        self.postings: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, ids: list[int], lengths: list[int], sources: list[int]) -> None:
        """Texts by their term numbers, one after the other."""
        if not ids:
            return
        terms = np.array(ids, np.int64)
        doc = np.repeat(np.arange(len(lengths)), lengths)
        seen, n = np.unique(doc << 32 | terms, return_counts=True)
        self.docs.append(seen & 0xFFFFFFFF)
        keys = np.asarray(sources, np.int64)[seen >> 32] << 32 | seen & 0xFFFFFFFF
        self.postings.append(_summed(keys, n))

    def add_long(self, pieces: Iterator[list[bytes]], source: int) -> None:
        found = [np.unique(np.fromiter(map(self.ids.__getitem__, p), np.int64, len(p)), return_counts=True) for p in pieces]
        terms, n = _summed(np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]))
        self.docs.append(terms)
        self.postings.append((source << 32 | terms, n))


class Block:
    """Postings in memory."""

    def __init__(self) -> None:
        self.langs: dict[str, _Language] = defaultdict(_Language)
        self.sources: dict[str, int] = defaultdict(count().__next__)
        self.groups: set[tuple[str, str]] = set()

    def add(self, rows: list[tuple[str, str, bytes]]) -> None:
        short: dict[str, tuple[list, list, list]] = defaultdict(lambda: ([], [], []))
        for lang, source, raw in rows:
            self.groups.add((lang, source))
            language, number = self.langs[lang], self.sources[source]
            if len(raw) > PIECE:
                language.add_long(_pieces(raw), number)
                continue
            ids, lengths, sources = short[lang]
            before = len(ids)
            ids.extend(map(language.ids.__getitem__, raw.translate(_FOLD).split()))
            lengths.append(len(ids) - before)
            sources.append(number)
        for lang, texts in short.items():
            self.langs[lang].add(*texts)

    def full(self) -> bool:
        every = self.langs.values()
        return sum(len(x.ids) for x in every) > BLOCK_TERMS or sum(len(p[0]) for x in every for p in x.postings) > BLOCK_POSTINGS

    def run(self) -> Run:
        """The block in the order of its keys. The term '' lists the groups, with or without terms."""
        none = np.zeros(0, np.int64)
        keys: list[bytes] = []
        docs, term_of, codes, counts = [none], [none], [none], [none]
        for lang, source in self.groups:
            term_of.append(np.array([len(keys)]))
            codes.append(np.array([self.sources[source]]))
            counts.append(np.zeros(1, np.int64))
            keys.append(lang.encode() + b"\0")
            docs.append(np.zeros(1, np.int64))
        for lang, language in self.langs.items():
            first, head = len(keys), lang.encode() + b"\0"
            keys.extend(head + t for t in language.ids)
            docs.append(np.bincount(np.concatenate([none, *language.docs]), minlength=len(language.ids)).astype(np.int64))
            at, n = _summed(np.concatenate([none, *(p[0] for p in language.postings)]), np.concatenate([none, *(p[1] for p in language.postings)]))
            term_of.append((at & 0xFFFFFFFF) + first)
            codes.append(at >> 32)
            counts.append(n)
        term, order = np.concatenate(term_of), np.asarray(pc.sort_indices(pa.array(keys, pa.large_binary())), np.int64)
        by_term = np.argsort(term, kind="stable")
        starts = np.searchsorted(term[by_term], np.arange(len(keys) + 1))
        return Run(keys, np.concatenate(docs), starts, np.concatenate(codes)[by_term], np.concatenate(counts)[by_term], list(self.sources)).taken(order)


def _pieces(raw: bytes) -> Iterator[list[bytes]]:
    """Terms of a text, a megabyte at a time, never cut inside a term."""
    folded, at = raw.translate(_FOLD), 0
    while at < len(folded):
        end = folded.find(b" ", at + PIECE) if at + PIECE < len(folded) else -1
        end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end + 1


def _packed(parts: Iterator[tuple[int, bytes]], number: int) -> Iterator[pa.RecordBatch]:
    for shard, payload in parts:
        yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([number], pa.int64()), pa.array([payload], pa.binary())], schema=_RUN_SCHEMA)


def _index(part: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number, block = TaskContext.get().partitionId() << 20, Block()
    for b in part:
        block.add(list(zip(*(c.to_pylist() for c in b.columns), strict=True)))
        if block.full():
            yield from _packed(block.run().split(SHARDS), number)
            number, block = number + 1, Block()
    if block.groups:
        yield from _packed(block.run().split(SHARDS), number)


def merge_runs(runs: list[Run], min_docs: int) -> Run:
    """One run of all; keys of fewer documents go, but for those that list groups."""
    firsts = np.concatenate([[0], np.cumsum([len(r.keys) for r in runs])])
    merged = heapq.merge(*(zip(r.keys, range(a, a + len(r.keys))) for r, a in zip(runs, firsts.tolist(), strict=False)))
    keys: list[bytes] = []
    starts: list[int] = []
    last, order = None, []
    for key, at in merged:
        if key != last:
            last = key
            keys.append(key)
            starts.append(len(order))
        order.append(at)
    sources = list(dict.fromkeys(chain.from_iterable(r.sources for r in runs)))
    number = {s: i for i, s in enumerate(sources)}
    codes = np.concatenate([np.array([number[s] for s in r.sources], np.int64)[r.codes] for r in runs])
    ends = np.concatenate([[0], *(r.starts[1:] + a for r, a in zip(runs, np.cumsum([0, *(len(r.codes) for r in runs)])[:-1], strict=True))])
    together = Run([], np.concatenate([r.docs for r in runs]), ends, codes, np.concatenate([r.counts for r in runs]), sources)
    begin, placed = np.array(starts, np.int64), np.array(order, np.int64)
    docs = np.add.reduceat(together.docs[placed], begin) if len(keys) else together.docs
    stays = (docs >= min_docs) | np.fromiter((k.endswith(b"\0") for k in keys), bool, len(keys))
    which = np.repeat(np.cumsum(stays) - 1, np.diff([*starts, len(placed)]))[np.repeat(stays, np.diff([*starts, len(placed)]))]
    placed = placed[np.repeat(stays, np.diff([*starts, len(placed)]))]
    lengths = np.diff(together.starts)[placed]
    at = np.repeat(together.starts[:-1][placed] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
    pairs, counts = _summed(np.repeat(which, lengths) << 32 | together.codes[at], together.counts[at])
    kept = [k for k, stay in zip(keys, stays.tolist(), strict=True) if stay]
    return Run(kept, docs[stays], np.searchsorted(pairs >> 32, np.arange(len(kept) + 1)), pairs & 0xFFFFFFFF, counts, sources)


def _merged(min_docs: int, shards: int | None):
    """Merges the packed runs of a shard: into the index, or into runs of finer shards."""

    def merge(table: pa.Table) -> pa.Table:
        run = merge_runs([Run.read(p) for p in table.column("payload").to_pylist()], min_docs)
        if shards:
            number = (min(table.column("run").to_pylist()) >> 20) // FAN << 20
            return _table(_turned([(s, number, p) for s, p in run.split(shards)], 3), _RUN_SCHEMA)
        cut = [k.rpartition(b"\0") for k in run.keys]
        at = run.starts.tolist()
        names = [[run.sources[c] for c in run.codes[a:b]] for a, b in zip(at, at[1:])]
        counts = [run.counts[a:b].tolist() for a, b in zip(at, at[1:])]
        columns = [repeat(table.column("shard")[0].as_py(), len(cut)), [c[0].decode() for c in cut], [c[2].decode() for c in cut], run.docs.tolist(), names, counts]
        return _table([list(c) for c in columns], _INDEX_SCHEMA)

    return merge


def frequencies(docs: DataFrame, min_docs: int, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(shard, lang, term, docs, sources, counts) of the kept terms; the term '' lists the sources of a language."""
    none = F.lit("")
    read = docs.select(F.coalesce(F.col(lang_col).cast("string"), none).alias("lang"), F.coalesce(F.col(source_col).cast("string"), none).alias("source"), text_bytes(text_col).alias("text"))
    runs = materialise(read.mapInArrow(_index, RUN))
    shards = SHARDS
    while True:
        last = runs.agg(F.coalesce(F.max("run"), F.lit(0))).first()[0]
        groups = (last >> 20) // FAN + 1
        if groups == 1:
            return materialise(runs.groupBy("shard").applyInArrow(_merged(min_docs, None), INDEX))
        shards *= min(FAN, groups)
        near = runs.withColumn("group", F.floor(F.shiftright("run", 20) / FAN))
        runs = materialise(near.groupBy("shard", "group").applyInArrow(_merged(0, shards), RUN))


def share(count: np.ndarray, total: np.ndarray | int) -> np.ndarray:
    """1 + floor(10^9 * count / total) by long division, three digits at a time."""
    whole, rest = np.divmod(count, total)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + digits
    return whole + 1


def _best(old: list[tuple], values: np.ndarray, terms: list[str], top: int) -> list[tuple]:
    """The highest (value, term), ties to the smaller term."""
    if len(values) > top:
        bar = np.partition(values, len(values) - top)[len(values) - top]
        at = np.flatnonzero(values >= bar)
    else:
        at = np.arange(len(values))
    return sorted([*old, *((-int(values[i]), terms[i]) for i in at)])[:top]


def _correct(top: int):
    def correct(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _table(_turned([], 6), _PART_SCHEMA)
        lang, block, blocks, kept = (left.column(c)[0].as_py() for c in ("lang", "block", "blocks", "kept_terms"))
        right = right.sort_by("source")
        sources, n = right.column("source").to_pylist(), np.asarray(right.column("n").combine_chunks(), np.int64)
        index, size = {s: i for i, s in enumerate(sources)}, len(sources)
        total, every = n + SMOOTH * kept, int(n.sum()) + SMOOTH * kept
        base = share(np.full(size, SMOOTH, np.int64), total)
        mine = range(block * size // blocks, (block + 1) * size // blocks)
        both, one = np.zeros((len(mine), size), np.int64), np.zeros((len(mine), size), np.int64)
        best: list[list[tuple]] = [[] for _ in mine]
        for b in left.select(["term", "sources", "counts"]).to_batches(max_chunksize=max(1, MATRIX // size)):
            terms, held, counts = (c.to_pylist() for c in b.columns)
            t = np.repeat(np.arange(len(terms)), [len(h) for h in held])
            s = np.fromiter((index[x] for h in held for x in h), np.int64, len(t))
            c = np.fromiter((x for h in counts for x in h), np.int64, len(t))
            p, has = np.tile(base, (len(terms), 1)), np.zeros((len(terms), size), bool)
            p[t, s], has[t, s] = share(c + SMOOTH, total[s]), True
            in_lang = np.zeros(len(terms), np.int64)
            np.add.at(in_lang, t, c)
            q = share(in_lang + SMOOTH, every)
            for row, i in enumerate(mine):
                at = np.flatnonzero(has[:, i])
                if not len(at):
                    continue
                theirs = has[at]
                d = np.abs(p[at] - p[at, i, None]) - np.abs(base - base[i])
                held_by_both = np.where(theirs, d, 0).sum(axis=0)
                both[row] += held_by_both
                one[row] += d.sum(axis=0) - held_by_both
                gain = p[at, i] - q[at]
                up = np.flatnonzero(gain > 0)
                best[row] = _best(best[row], gain[up], [terms[at[j]] for j in up], top)
        rows = [(lang, "pair", sources[i], sources[j], int(both[r, j]), int(one[r, j])) for r, i in enumerate(mine) for j in np.flatnonzero((both[r] != 0) | (one[r] != 0)).tolist() if j != i]
        rows += [(lang, "term", sources[i], term, -value, 0) for r, i in enumerate(mine) for value, term in best[r]]
        return _table(_turned(rows, 6), _PART_SCHEMA)

    return correct


def audit(docs: DataFrame, min_docs: int = 30, top: int = TOP, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """(lang, source, part, item, value, rank): differences to all other sources, and the terms a source has more of."""
    index = frequencies(docs, min_docs, lang_col, source_col, text_col)
    terms = index.where("term <> ''")
    groups = index.where("term = ''").select("lang", F.explode("sources").alias("source"))
    counted = terms.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("x")).groupBy("lang", F.col("x.sources").alias("source")).agg(F.sum("x.counts").alias("n"))
    vocabulary = terms.groupBy("lang").agg(F.count(F.lit(1)).alias("kept_terms"))
    sizes = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("size"))
    totals = materialise(
        groups.join(counted, ["lang", "source"], "left").join(vocabulary, "lang", "left").join(sizes, "lang")
        .select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("kept_terms", F.lit(0)).alias("kept_terms"),
                F.ceil(F.col("size") * F.col("size") / F.lit(MATRIX)).cast("int").alias("blocks"))
    )
    langs = totals.select("lang", "kept_terms", "blocks").distinct()
    spread = terms.join(langs, "lang").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tasks = spread.select("lang", "shard", "block").distinct()
    keys = ["lang", "shard", "block"]
    beside = totals.select("lang", "source", "n").join(tasks, "lang").select("source", "n", *[F.col(k).alias(f"{k}_") for k in keys])
    parts = materialise(spread.groupBy(*keys).cogroup(beside.groupBy(*[f"{k}_" for k in keys])).applyInArrow(_correct(top), PART))

    pair = parts.where("part = 'pair'")
    there = pair.select("lang", "source", "item", (F.col("value") + F.col("one_sided")).alias("c"))
    back = pair.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), F.col("one_sided").alias("c"))
    corrections = there.unionByName(back).groupBy("lang", "source", "item").agg(F.sum("c").alias("c"))
    base = F.when(F.col("kept_terms") > 0, F.expr(f"1 + {SMOOTH * SCALE}L div (n + {SMOOTH} * kept_terms)"))
    a = totals.select("lang", "source", "kept_terms", base.alias("p"))
    b = totals.select("lang", F.col("source").alias("item"), base.alias("q"))
    pairs = a.join(b, "lang").where(F.col("source") != F.col("item")).join(corrections, ["lang", "source", "item"], "left")
    value = F.coalesce(F.col("kept_terms") * F.abs(F.col("p") - F.col("q")) + F.coalesce("c", F.lit(0)), F.lit(0))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    columns = ["lang", "source", "part", "item", "value", "rank"]
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", value.cast("long").alias("value")).withColumn("rank", F.row_number().over(order))
    best = parts.where("part = 'term'").withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return pairs.select(columns).unionByName(best.select(columns))
