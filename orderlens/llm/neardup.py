"""Near-duplicate documents: banded MinHash, odd sketches, exact confirmation, connected components.

1. Each row gets the set of its word shingles (64-bit hashes), ``SAMPLES`` MinHash values for bands, and an odd sketch:
   the hash space is cut into ``BINS`` bins, the smallest value of each bin (one-permutation MinHash) flips one bit of a
   bitmap, and so the population count of the XOR of two bitmaps tells how many samples differ, and with that the
   similarity, most precisely where it is high. Sets smaller than the bins are sampled almost whole.
2. Rows of equal sets are one node from here on (their similarity is 1).
3. Bands of MinHash values give buckets. A bucket proposes a star: its pivot with each other member, so proposals grow
   with the rows and not with the square of a bucket. Proposals that fail the size bound or whose sketches lie far
   below the threshold go; the others are confirmed on the full sets.
4. Buckets that still hold several components have pairs that no star has proposed. They are compared sketch by sketch,
   in blocks of bounded size: members outside the bucket's largest component against all members of other components.
   What the sketches cannot rule out is confirmed on the full sets too. No bucket is capped.
5. Components are found by alternating star contraction on the links; all steps are joins and aggregates.

Rows per band follow from the threshold: a pair at the threshold shares no band with a probability of at most
``MISS``. A pair goes by its sketches only if they differ by ``SIGMAS`` standard deviations more than at the threshold.

Cases: null or blank text has no shingles and no links. A text of fewer words than a shingle is one shingle. A null id
takes part; it is never the smallest of a component. Repeated rows are rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import materialise, mix64, release, string_hashes, text_bytes

SAMPLES, BINS, SKETCH_WORDS, SIGMAS, MISS = 128, 2048, 32, 5.0, 1e-6
BLOCK = 256
CHUNK = 1 << 15
#: a node's number: its row, below this bound, after a rank that puts larger classes first
ROW_BITS = 56
#: stored rows (of at most 24 bytes) that may be broadcast; more of them meet the other side in an exchange
BROADCAST_ROWS = 500_000

_SEEDS = mix64(np.arange(1, 2 * SAMPLES + 1, dtype=np.uint64))
FLIPS, FACTORS = _SEEDS[:SAMPLES], _SEEDS[SAMPLES:] | np.uint64(1)
SKETCH = [f"s{i}" for i in range(SKETCH_WORDS)]


def band_rows(percent: int, samples: int = SAMPLES) -> int:
    """The longest bands that a pair at the threshold shares with a probability of at least 1 - MISS."""
    t = percent / 100
    return max(r for r in range(1, samples + 1) if r == 1 or (1 - t**r) ** (samples // r) <= MISS)


_words: dict[bytes, int] = {}


def shingles(text: bytes | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles."""
    words = text.lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    h = string_hashes(words, _words)
    n = max(1, len(h) - k + 1)
    length = min(k, len(h))
    acc = h[:n] + np.uint64(length)
    for j in range(1, length):
        acc = mix64(acc * np.uint64(0x9E3779B97F4A7C15) ^ h[j : j + n])
    return np.unique(acc)


def minhashes(sets: list[np.ndarray]) -> np.ndarray:
    """(documents, SAMPLES); the sets are not empty."""
    out, at = np.empty((len(sets), SAMPLES), np.uint64), 0
    while at < len(sets):
        end, n = at, 0
        while end < len(sets) and (end == at or n + len(sets[end]) <= CHUNK):
            n += len(sets[end])
            end += 1
        flat = np.concatenate(sets[at:end])
        starts = np.cumsum([0, *(len(s) for s in sets[at : end - 1])])
        buffer = np.empty_like(flat)
        for i in range(SAMPLES):
            np.bitwise_xor(flat, FLIPS[i], out=buffer)
            np.multiply(buffer, FACTORS[i], out=buffer)
            out[at:end, i] = np.minimum.reduceat(buffer, starts)
        at = end
    return out


def odd_sketch(sets: list[np.ndarray]) -> np.ndarray:
    """(documents, SKETCH_WORDS) bitmaps of the bins' smallest values; the sets are sorted."""
    bits, out = SKETCH_WORDS * 64, []
    shift = np.uint64(64 - BINS.bit_length() + 1)
    for start in range(0, len(sets), 500):
        part = sets[start : start + 500]
        spots = []
        for i, s in enumerate(part):
            bin_ = s >> shift
            smallest = s[np.concatenate([[True], bin_[1:] != bin_[:-1]])[: len(s)]]
            spots.append((mix64(smallest ^ FLIPS[0]) % np.uint64(bits)).astype(np.int64) + i * bits)
        flips = np.bincount(np.concatenate(spots), minlength=len(part) * bits) & 1
        out.append(np.packbits(flips.astype(np.uint8).reshape(len(part), bits), axis=1, bitorder="little").view(np.uint64))
    return np.concatenate(out)


def most_differing(n_a, n_b, percent: int, exp, sqrt):
    """XOR population count up to which two sketches may belong to sets of these sizes at the threshold; for numbers,
    arrays and columns alike, with their functions."""
    t, bits = percent / 100, SKETCH_WORDS * 64
    load = (n_a + n_b) * (1 / (1 + t) / BINS)  # of the union, per bin
    empty = exp(-1 * load)
    changed = (1 - empty) * (BINS * (1 - t))  # bins whose smallest value only one set has
    both = 1 - load * empty / (1 - empty)  # of them, those where the other set has another value
    flips = changed * (1 + both)
    hidden = 1 - (1 - empty) / load  # values that a smaller one of the same bin hides
    slope = exp(flips * (-2 / bits))
    spread = changed * (hidden * (1 + both) * (1 + both) * t + both * (1 - both)) * slope * slope + flips * flips * (2 / bits) * slope + 1
    return (1 - slope) * (bits / 2) + sqrt(spread) * SIGMAS


def _most(n_a: np.ndarray, n_b: int, percent: int) -> np.ndarray:
    return most_differing(n_a, n_b, percent, np.exp, np.sqrt)


def band_hashes(samples: np.ndarray, rows: int) -> np.ndarray:
    n = samples.shape[1] // rows
    acc = np.tile(mix64(np.arange(1, n + 1, dtype=np.uint64)), (len(samples), 1))
    grouped = samples[:, : n * rows].reshape(len(samples), n, rows)
    for j in range(rows):
        acc = mix64(acc * np.uint64(0x9E3779B97F4A7C15) ^ grouped[:, :, j])
    return acc


SIGNATURE = "rid long, doc_id long, text_hash long, n long, set1 long, set2 long, " + ", ".join(f"{s} long" for s in SKETCH) + ", bands array<long>"


def _sign(part: Iterator[pa.RecordBatch], k: int, rows: int) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in SIGNATURE.split(", ")]
    for batch in part:
        if not batch.num_rows:
            continue
        sets = [shingles(t, k) for t in batch.column(3).to_pylist()]
        n = np.array([len(s) for s in sets])
        full = np.flatnonzero(n)
        digests = np.frombuffer(b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets), "<i8").reshape(-1, 2)
        sketch, bands = np.zeros((len(sets), SKETCH_WORDS), np.uint64), [[] for _ in sets]
        if len(full):
            sketch[full] = odd_sketch([sets[i] for i in full])
            for i, row in zip(full.tolist(), band_hashes(minhashes([sets[i] for i in full]), rows).view(np.int64), strict=True):
                bands[i] = row
        columns = [*(batch.column(i) for i in range(3)), pa.array(n, pa.int64()), pa.array(digests[:, 0]), pa.array(digests[:, 1])]
        columns += [pa.array(np.ascontiguousarray(sketch[:, i]).view(np.int64)) for i in range(SKETCH_WORDS)]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(bands, pa.list_(pa.int64()))], names=names)


def text_hash(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def _likely(percent: int) -> Column:
    """The pair's sizes and sketches allow a similarity at the threshold."""
    differing = reduce(lambda x, y: x + y, [F.bit_count(F.col(f"a_{s}").bitwiseXOR(F.col(f"b_{s}"))) for s in SKETCH])
    small, large = F.least("a_n", "b_n"), F.greatest("a_n", "b_n")
    most = most_differing(F.col("a_n"), F.col("b_n"), percent, F.exp, F.sqrt)
    return (small * 100 >= large * percent) & (differing <= most)


def _side(nodes: DataFrame, side: str, columns: list[str]) -> DataFrame:
    return nodes.select(F.col("node").alias(side), *(F.col(c).alias(f"{side}_{c}") for c in columns))


def _likely_pairs(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    columns = ["n", *SKETCH]
    both = pairs.join(_side(nodes, "b", columns), "b").join(_side(nodes, "a", columns), "a")
    return both.where(_likely(percent)).select("a", "b")


def _confirm(part: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in part:
        keep = []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(100 * both >= percent * (len(x) + len(y) - both))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _sets(part: Iterator[pa.RecordBatch], k: int) -> Iterator[pa.RecordBatch]:
    for batch in part:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingles(t, k).tobytes() for t in batch.column(1).to_pylist()], pa.binary())], names=["node", "shingles"])


def _hinted(stored: DataFrame) -> DataFrame:
    """A stored table, to be broadcast if it is small."""
    return F.broadcast(stored) if stored.count() <= BROADCAST_ROWS else stored


def _sets_of(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """(node, shingles), stored: the full sets of the nodes in the pairs, from their texts. Few nodes travel to the
    documents; many meet them in a join, which moves the texts once."""
    used = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = materialise(nodes.join(used, "node", "left_semi").select("node", "doc_id", "text_hash"))
    texts = docs.withColumn("text_hash", text_hash("text")).withColumnRenamed("doc_id", "d")
    held = texts.join(_hinted(wanted), (texts["text_hash"] == wanted["text_hash"]) & texts["d"].eqNullSafe(wanted["doc_id"]))
    held = held.select("node", text_bytes("text").alias("t")).mapInArrow(partial(_sets, k=k), "node long, shingles binary")
    sets = materialise(held.groupBy("node").agg(F.first("shingles").alias("shingles")))  # a row may be there twice
    release(wanted)
    return sets


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (stored) whose full sets reach the threshold; the sets are released."""
    both = pairs.join(_side(sets, "b", ["shingles"]), "b").join(_side(sets, "a", ["shingles"]), "a")
    confirmed = materialise(both.select("a", "b", "a_shingles", "b_shingles").mapInArrow(partial(_confirm, percent=percent), "a long, b long"))
    release(sets)
    return confirmed


def _is_stars(edges: DataFrame) -> bool:
    """Every node hangs on one other, on which nothing but nodes like it hang."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(edges.select("v", F.lit(0), F.lit(1))).groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return ends.where("up > 1 or (up > 0 and down > 0)").count() == 0


def components(links: DataFrame) -> DataFrame:
    """(node, comp), stored: the smallest node that each linked node reaches, for all but those that are it themselves."""
    edges = materialise(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    while not _is_stars(edges):
        hint = F.broadcast if edges.count() <= BROADCAST_ROWS else lambda table: table  # no more rows than edges have ends
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = both.join(hint(low), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(hint(low), "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        edges = materialise(small.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp"))


def _merged(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The labels after more links: what is known enters as one link for each node to its component."""
    if links.isEmpty():
        return labels
    return components(links.select("a", "b").union(labels.select("node", "comp")))


def _label(df: DataFrame, labels: DataFrame, side: str) -> DataFrame:
    """The component of a node; a node without a label is one of its own."""
    named = labels.select(F.col("node").alias(side), F.col("comp").alias(f"{side}_comp"))
    return df.join(named, side, "left").withColumn(f"{side}_comp", F.coalesce(f"{side}_comp", side))


UNIT = ["bh", "i", "j", "outer", "node", "comp", "n", *SKETCH, "bands"]


def _compare(part: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs of a unit's outer members with its other members that sizes, sketches and components allow, each in the
    first band that they share only. The rows come in the order of their units; one unit, of at most about 2 * BLOCK rows,
    is held at a time."""
    rest = None
    for batch in part:
        if not batch.num_rows:
            continue
        bands = np.asarray(batch.column(batch.num_columns - 1).flatten(), np.int64).reshape(batch.num_rows, -1)
        rows = np.column_stack([*(np.asarray(c.cast(pa.int64()), np.int64) for c in batch.columns[:-1]), bands])
        rows = rows if rest is None else np.concatenate([rest, rows])
        cuts = np.flatnonzero((rows[1:, :3] != rows[:-1, :3]).any(axis=1)) + 1
        units = np.split(rows, cuts)
        rest = units.pop()
        yield _pairs(units, percent)
    if rest is not None:
        yield _pairs([rest], percent)


def _pairs(units: list[np.ndarray], percent: int) -> pa.RecordBatch:
    found: set[tuple[int, int]] = set()
    for unit in units:
        outer, every = unit[unit[:, 3] == 1], unit[unit[:, 3] == 0]
        node, comp, n, sketch, bands = every[:, 4], every[:, 5], every[:, 6], every[:, 7 : 7 + SKETCH_WORDS].view(np.uint64), every[:, 7 + SKETCH_WORDS :]
        earlier = int((bands[0] == every[0, 0]).argmax()) if len(every) else 0  # bands before this unit's
        for row in outer:
            near = (comp != row[5]) & (np.minimum(n, row[6]) * 100 >= np.maximum(n, row[6]) * percent)
            near = np.flatnonzero(near)
            near = near[(bands[near, :earlier] != row[7 + SKETCH_WORDS :][:earlier]).all(axis=1)]
            near = near[np.bitwise_count(sketch[near] ^ row[7 : 7 + SKETCH_WORDS].view(np.uint64)).sum(axis=1) <= _most(n[near], row[6], percent)]
            found.update((min(row[4], w), max(row[4], w)) for w in node[near].tolist())
    pairs = np.array(sorted(found), np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])


def _residual(held: DataFrame, nodes: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Likely pairs of different components that share a bucket; every bucket of several components is compared whole.
    ``held``: (bh, node, a, members) of buckets of two and more."""
    named = _label(held.where("members > 2").select("bh", "node"), labels, "node")
    per = named.groupBy("bh", "node_comp").agg(F.count("*").alias("size"))
    mixed = per.groupBy("bh").agg(F.count("*").alias("comps"), F.sum("size").alias("members"), F.max(F.struct("size", "node_comp")).alias("top"))
    mixed = mixed.where("comps > 1").select("bh", "members", F.col("top.size").alias("largest"), F.col("top.node_comp").alias("main"))
    full = named.select("bh", "node", F.col("node_comp").alias("comp")).join(mixed, "bh").join(nodes.select("node", "n", *SKETCH, "bands"), "node")
    spot = F.xxhash64("node")
    rows = F.ceil(F.col("members") / BLOCK).cast("long")
    outer = F.ceil((F.col("members") - F.col("largest")) / BLOCK).cast("long")
    every = full.withColumn("outer", F.lit(0)).withColumn("j", F.pmod(spot, rows)).withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), outer - 1)))
    rest = full.where("comp <> main").withColumn("outer", F.lit(1)).withColumn("i", F.pmod(spot, outer)).withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), rows - 1)))
    units = every.select(UNIT).union(rest.select(UNIT)).repartition("bh", "i", "j").sortWithinPartitions("bh", "i", "j")
    return units.mapInArrow(partial(_compare, percent=percent), "a long, b long")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: rid, doc_id, text_hash, n_shingles, component_id (smallest id reachable), kept (doc_id is that id), first_row (this
    row stands for its component: one row of each is so marked)."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    narrow = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", text_hash("text").alias("text_hash"), text_bytes("text").alias("t"))
    signed = materialise(narrow.mapInArrow(partial(_sign, k=k, rows=band_rows(percent)), SIGNATURE))
    # one node for each set; what belongs to the set is the same in all its rows, the text is that of the first row
    rank = F.shiftleft((63 - F.floor(F.log2(F.count("*").cast("double")))).cast("long"), ROW_BITS)
    of_set = [F.first(c).alias(c) for c in ("n", *SKETCH, "bands")]
    nodes = signed.where("n > 0").groupBy("set1", "set2").agg(
        (rank + F.min("rid")).alias("node"), F.min("doc_id").alias("low"), F.coalesce(F.min_by("rid", "doc_id"), F.min("rid")).alias("low_rid"),
        F.min_by(F.struct("doc_id", "text_hash"), "rid").alias("source"), *of_set)
    nodes = materialise(nodes.select("*", "source.*").drop("source"))
    bands = nodes.select("node", F.explode("bands").alias("bh"))
    buckets = bands.groupBy("bh").agg(F.min("node").alias("a"), F.count("*").alias("members")).where("members > 1")
    held = materialise(bands.join(buckets, "bh"))
    stars = held.where("node <> a").select("a", F.col("node").alias("b")).distinct()
    likely = materialise(_likely_pairs(stars, nodes, percent))
    labels = components(_confirmed(likely, _sets_of(likely, nodes, docs, k), percent))
    rest = materialise(_residual(held, nodes, _hinted(labels), percent).join(likely, ["a", "b"], "left_anti"))
    if not rest.isEmpty():
        labels = _merged(labels, _confirmed(rest, _sets_of(rest, nodes, docs, k), percent))
    result = materialise(_result(signed, nodes.select("set1", "set2", "node", "low", "low_rid"), _hinted(labels)))
    release(signed, nodes, held, likely, rest)
    return result


def _result(signed: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    grouped = _label(classes, labels, "node")
    lowest = grouped.groupBy("node_comp").agg(F.min("low").alias("component_id"), F.coalesce(F.min_by("low_rid", "low"), F.min("low_rid")).alias("best"))
    named = grouped.join(lowest, "node_comp").select("set1", "set2", "component_id", "best")
    rows = signed.select("rid", "doc_id", "text_hash", F.col("n").alias("n_shingles"), "set1", "set2").join(named, ["set1", "set2"], "left")
    alone = F.col("best").isNull()
    rows = rows.withColumn("component_id", F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")))
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    first_row = alone | (F.col("rid") == F.col("best"))
    return rows.select("rid", "doc_id", "text_hash", "n_shingles", "component_id", kept.alias("kept"), F.coalesce(first_row, F.lit(True)).alias("first_row"))
