"""Benchmark decontamination through a positional inverted index that is split by documents.

Index: a run of documents is a segment. For each term of the test set a segment stores
one posting list: the places of the term, ascending, in the numbering that runs through
all documents of the segment with a gap behind each document. Places of one list shifted
by the term's offset in a phrase can so be intersected over all documents at once, and a
phrase never reaches across a border.

Search: a term's frequency over the whole index ranks it. For a phrase the list of its
rarest term, shifted, is the first set of candidate starts; each further list, by rising
frequency, keeps those starts that it holds too. Nothing is hashed or sampled: what is
left are the exact occurrences. Proximity search takes the occurrences of the rarest term
as anchors and keeps anchors that have all other terms within the window around them.

The test set is taken in parts: items longer than ``PART`` words are cut into overlapping
pieces, pieces are dealt to blocks of at most about ``block_words`` words, and each block
is one pass over the documents, so only a block ever travels to the tasks.

Cases: null and empty texts have no words; such documents have no hits and such items no
windows. An item shorter than a window is one window. Rows of equal ids are judged each
by itself; an item id that occurs twice counts once. Null item ids are left out.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import materialise, release, text_bytes

#: a word: digits, lower-case letters and everything beyond ASCII, after A-Z became lower case (on UTF-8 bytes)
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
PART = 1000
SEGMENT_WORDS = 1_500_000
#: kinds of index rows: a document, a term's posting list, a document without an id
DOC, TERM, NO_ID = 0, 1, 2

ROWS = "segment long, kind int, term int, doc long, rid long, text_hash long, n_words long, base long, count long, places binary"


def words_of(text: bytes | None) -> list[bytes]:
    return WORD.findall(text.lower()) if text else []


def test_parts(items: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """(item, words): pieces of at most PART words that overlap by width - 1, so that each window is in one piece."""

    def cut(part: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in part:
            ids, pieces = [], []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = words_of(text)
                for at in range(0, max(1, len(words) - width + 1), PART):
                    if words:
                        ids.append(item)
                        pieces.append(words[at : at + PART + width - 1])
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.field(0).type), pa.array(pieces, pa.list_(pa.binary()))], names=["item", "words"])

    narrow = items.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("item"), text_bytes(text_col).alias("t"))
    return narrow.mapInArrow(cut, f"item {items.schema[id_col].dataType.simpleString()}, words array<binary>")


def windows_of(parts: list, width: int) -> tuple[dict[bytes, int], dict[tuple, set]]:
    """The terms of a block with numbers, and its distinct windows with the items that hold them."""
    terms: dict[bytes, int] = {}
    windows: dict[tuple, set] = defaultdict(set)
    for item, words in parts:
        ids = [terms.setdefault(bytes(w), len(terms)) for w in words]
        for at in range(max(1, len(ids) - width + 1)):
            windows[tuple(ids[at : at + width])].add(item)
    return terms, windows


def _segment(number: int, rows: list[tuple], lengths: list[int], coded: list[np.ndarray], gap: int) -> Iterator[dict]:
    """One row per document and one per term with a posting list."""
    bases = np.concatenate([[0], np.cumsum(np.array(lengths, np.int64) + gap)])
    # no nulls among the numbers: a pandas column that holds one would turn long ids into doubles
    blank = {"segment": number, "term": 0, "doc": 0, "rid": 0, "text_hash": 0, "n_words": 0, "base": 0, "count": 0, "places": None}
    for (doc, rid, text), n, base in zip(rows, lengths, bases.tolist(), strict=False):
        yield blank | {"kind": DOC if doc is not None else NO_ID, "doc": doc or 0, "rid": rid, "text_hash": text, "n_words": n, "base": base}
    codes = np.concatenate(coded)
    if not (codes >= 0).any():
        return
    places = np.concatenate([np.arange(len(c), dtype=np.int64) + b for c, b in zip(coded, bases.tolist(), strict=False)])
    held = codes >= 0
    codes, places = codes[held], places[held].astype(np.int32)
    order = np.argsort(codes, kind="stable")
    codes, places = codes[order], places[order]
    found, first = np.unique(codes, return_index=True)
    for term, a, b in zip(found.tolist(), first.tolist(), [*first.tolist()[1:], len(codes)], strict=True):
        yield blank | {"kind": TERM, "term": term, "count": b - a, "places": places[a:b].tobytes()}


def _index(part: Iterator[pa.RecordBatch], terms: dict[bytes, int], gap: int) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    schema = pa.schema([("segment", pa.int64()), ("kind", pa.int32()), ("term", pa.int32()), ("doc", pa.int64()), ("rid", pa.int64()), ("text_hash", pa.int64()), ("n_words", pa.int64()), ("base", pa.int64()), ("count", pa.int64()), ("places", pa.binary())])
    number, rows, lengths, coded, n = TaskContext.get().partitionId() << 33, [], [], [], 0
    none, get = -1, terms.get

    def flush():
        made = list(_segment(number, rows, lengths, coded, gap))
        return pa.RecordBatch.from_pylist(made, schema=schema)

    for batch in part:
        for doc, rid, text_hash, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
            words = words_of(text)
            rows.append((doc, rid, text_hash))
            lengths.append(len(words))
            coded.append(np.fromiter((get(w, none) for w in words), np.int32, len(words)))
            n += len(words) + gap
            if n >= SEGMENT_WORDS:
                yield flush()
                number, rows, lengths, coded, n = number + 1, [], [], [], 0
    if rows:
        yield flush()


def build_index(docs: DataFrame, terms: dict[bytes, int], width: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The stored index over every document for the given terms (a block's, so bounded)."""
    text_hash = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    narrow = docs.select(F.col(id_col).cast("long").alias("doc"), F.monotonically_increasing_id().alias("rid"), text_hash.alias("text_hash"), text_bytes(text_col).alias("t"))
    return materialise(narrow.mapInArrow(partial(_index, terms=terms, gap=width), ROWS))


def phrase_starts(lists: dict[int, np.ndarray], phrase: tuple, rank: dict[int, int]) -> np.ndarray:
    """Starts of a phrase in one segment: the shifted lists, rarest term first."""
    if any(t not in lists for t in phrase):
        return np.zeros(0, np.int32)
    at = None
    for offset in sorted(range(len(phrase)), key=lambda o: rank[phrase[o]]):
        held = lists[phrase[offset]]
        if at is None:
            at = held - np.int32(offset)
        else:
            want = at + np.int32(offset)
            spot = np.searchsorted(held, want)
            spot[spot == len(held)] = 0
            at = at[held[spot] == want]
        if not len(at):
            break
    return at


def near_places(lists: dict[int, np.ndarray], terms: tuple, rank: dict[int, int], within: int) -> np.ndarray:
    """Places of the rarest term that have every other term at most ``within`` words away."""
    if any(t not in lists for t in terms):
        return np.zeros(0, np.int32)
    first, *rest = sorted(set(terms), key=lambda t: rank[t])
    at = lists[first]
    for t in rest:
        held = lists[t]
        at = at[np.searchsorted(held, at - within, "left") < np.searchsorted(held, at + within, "right")]
    return at


def _search(rows: pd.DataFrame, windows: list, rank: dict[int, int], within: int | None) -> pd.DataFrame:
    docs = rows[rows["kind"] != TERM].sort_values(["base", "rid"])
    lists = {int(t): np.frombuffer(p, np.int32) for t, p in zip(*(rows.loc[rows["kind"] == TERM, c] for c in ("term", "places")), strict=True)}
    bases, n_words = docs["base"].to_numpy(np.int64), docs["n_words"].to_numpy(np.int64)
    starts, ends, owners = [], [], []
    for number, (phrase, _) in enumerate(windows):
        if within is None:
            at = phrase_starts(lists, phrase, rank)
            length = len(phrase)
        else:
            at, length = near_places(lists, phrase, rank, within), 1
        if len(at):
            starts.append(at.astype(np.int64))
            ends.append(at.astype(np.int64) + length)
            owners.append(np.full(len(at), number))
    spans, items = [None] * len(docs), [None] * len(docs)
    if starts:
        start, end, owner = (np.concatenate(x) for x in (starts, ends, owners))
        of = np.searchsorted(bases, start, "right") - 1
        order = np.lexsort((start, of))
        start, end, owner, of = start[order], end[order], owner[order], of[order]
        for chunk in np.split(np.arange(len(of)), np.flatnonzero(np.diff(of)) + 1):
            d = of[chunk[0]]
            merged: list[list[int]] = []
            for a, b in zip((start[chunk] - bases[d]).tolist(), (end[chunk] - bases[d]).tolist(), strict=True):
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(b, merged[-1][1])
                else:
                    merged.append([a, b])
            spans[d] = np.array(merged, np.int64).ravel().tolist()
            items[d] = sorted({str(i) for w in np.unique(owner[chunk]).tolist() for i in windows[w][1]})
    return pd.DataFrame({"rid": docs["rid"].to_numpy(np.int64), "doc": docs["doc"].astype("Int64").mask(docs["kind"] == NO_ID).array, "text_hash": docs["text_hash"].to_numpy(np.int64), "n_words": n_words, "spans": spans, "items": items})


def _searcher(windows: list, rank: dict[int, int], within: int | None):
    def search(rows: pd.DataFrame) -> pd.DataFrame:
        return _search(rows, windows, rank, within)

    return search


def _block_windows(parts: DataFrame, block: int, blocks: int, width: int) -> tuple[dict[bytes, int], dict[tuple, set]]:
    rows = parts.where(F.pmod(F.xxhash64("item", "words"), F.lit(blocks)) == block).collect()  # about block_words words
    return windows_of([(r["item"], r["words"]) for r in rows], width)


def find_occurrences(
    docs: DataFrame, items: DataFrame, width: int = 10, within: int | None = None, block_words: int = 500_000,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """One row per document and block: rid, doc, text_hash, n_words, spans (start, end, start, end ... of words inside occurrences,
    merged, ascending) and items (ids as strings). With ``within``, proximity matches of the windows' terms instead of
    exact phrases; the spans are then the anchors."""
    docs = docs.select(F.col(id_col), F.col(text_col))
    parts = materialise(test_parts(items.select(F.col(item_col), F.col(item_text)), width, item_col, item_text))
    total = parts.select(F.sum(F.size("words"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_words))
    return reduce(DataFrame.unionByName, [_block_spans(docs, parts, b, blocks, width, within, id_col, text_col) for b in range(blocks)])


def _block_spans(docs: DataFrame, parts: DataFrame, block: int, blocks: int, width: int, within: int | None, id_col: str, text_col: str) -> DataFrame:
    """What one block of test items finds. Of several blocks each is stored before the next is read, so that the driver
    holds the windows of one."""
    terms, windows = _block_windows(parts, block, blocks, width)
    index = build_index(docs, terms, width, id_col, text_col)
    counts = index.where(F.col("kind") == TERM).groupBy("term").agg(F.sum("count").alias("n")).orderBy("n", "term").collect()  # the block's terms
    rank = {r["term"]: i for i, r in enumerate(counts)}
    known = [(phrase, sorted(map(str, ids))) for phrase, ids in windows.items() if all(t in rank for t in phrase)]
    spans = index.groupBy("segment").applyInPandas(_searcher(known, rank, within), "rid long, doc long, text_hash long, n_words long, spans array<long>, items array<string>")
    if blocks == 1:
        return spans
    stored = materialise(spans)
    release(index)
    return stored


def _judge(part: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Merge what the blocks found in a document; columns: rid, doc, text_hash, n_words, spans, items."""
    for batch in part:
        hits, lists = [], []
        for spans, items in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True):
            pairs = sorted(p for s in spans for p in zip(s[::2], s[1::2], strict=True))
            end = hit = 0
            for a, b in pairs:
                hit += max(0, b - max(a, end))
                end = max(end, b)
            hits.append(hit)
            lists.append(sorted({x for i in items for x in i}))
        digests = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in lists]
        made = [pa.array(hits, pa.int64()), pa.array([len(x) for x in lists], pa.int64()), pa.array(digests, pa.string()), pa.array([h > 0 for h in hits], pa.bool_()), pa.array(lists, pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], *made], names=["rid", "doc_id", "text_hash", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items"])


def contamination(docs: DataFrame, items: DataFrame, **params) -> DataFrame:
    """Per document: rid (its number in this reading of the table), doc_id, text_hash, n_words, n_hit, n_items, items_sha256, contaminated, items."""
    found = find_occurrences(docs, items, **params)
    whole = found.groupBy("rid", "doc", "text_hash", "n_words").agg(F.collect_list("spans").alias("spans"), F.collect_list("items").alias("items"))
    return whole.mapInArrow(_judge, "rid long, doc_id long, text_hash long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, items array<string>")
