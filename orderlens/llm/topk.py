"""Exact top-k by inner product: tiles of queries and shards, partial selection, a tree of merges.

A block of queries, bounded in bytes, travels to all tasks; each task multiplies it with its vectors tile by tile and
keeps, after every tile, the k best of each query. The lists of the tasks are merged in a tree: lists of neighbouring
tasks first, then those of the groups. More queries than one block are taken block after block.

Components are turned into floor(scale * x) first, so that all sums are integers and exact: products are made in
doubles while they stay below 2^53, else in 64-bit integers. Ties go to the smaller id.

Cases: vectors that are null or hold a null or non-finite component take no part, nor do null ids. Vectors meet only
vectors of their own length. A query's own id is no candidate; rows that repeat an id are candidates of others each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.llm.common import materialise

TILE = 1024
FAN = 16


def _valid(vec: str) -> Column:
    sound = ~F.exists(vec, lambda x: F.coalesce(F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")), F.lit(True)))
    return F.col(vec).isNotNull() & sound


def _matrix(column: pa.Array, scale: float) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By vector length: row numbers and scaled components."""
    lengths = np.asarray(column.value_lengths())
    flat = np.asarray(column.flatten(), np.float64)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    out = {}
    for n in np.unique(lengths):
        rows = np.flatnonzero(lengths == n)
        at = starts[rows][:, None] + np.arange(n)
        out[int(n)] = rows, np.floor(flat[at] * scale)
    return out


def _products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    bound = np.abs(queries).max(initial=0) * np.abs(vectors).max(initial=0) * max(1, queries.shape[1])
    if bound < 2**53:
        return (queries @ vectors.T).astype(np.int64)
    return queries.astype(np.int64) @ vectors.astype(np.int64).T


class Best:
    """The k best of each query so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.rows = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in range(0, len(ids), TILE)]

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        for tile, start in enumerate(range(0, len(self.ids), TILE)):
            scores = _products(self.vectors[start : start + TILE], vectors)
            lowest = np.iinfo(np.int64).min
            scores[self.ids[start : start + TILE, None] == ids[None, :]] = lowest
            k = min(self.k, scores.shape[1])
            bar = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
            q, v = np.nonzero((scores >= bar[:, None]) & (scores > lowest))  # ties at the bar too
            old = self.rows[tile]
            q, i, s = np.concatenate([old[0], q]), np.concatenate([old[1], ids[v]]), np.concatenate([old[2], scores[q, v]])
            order = np.lexsort((i, -s, q))
            q, i, s = q[order], i[order], s[order]
            first = np.searchsorted(q, q, "left")
            keep = np.arange(len(q)) - first < self.k
            self.rows[tile] = q[keep], i[keep], s[keep]

    def result(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for tile, (q, i, s) in enumerate(self.rows):
            yield q + tile * TILE, i, s


def _search(blocks: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]], k: int, scale: float):
    def search(part: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        best = {n: Best(ids, vectors, k) for n, (_, ids, vectors) in blocks.items()}
        for batch in part:
            if batch.num_rows:
                ids = np.asarray(batch.column(0), np.int64)
                for n, (rows, vectors) in _matrix(batch.column(1), scale).items():
                    if n in best:
                        best[n].add(ids[rows], vectors)
        task = TaskContext.get().partitionId()
        for n, b in best.items():
            numbers = blocks[n][0]
            for q, i, s in b.result():
                if len(q):
                    yield pa.RecordBatch.from_arrays([pa.array(numbers[q]), pa.array(b.ids[q]), pa.array(i), pa.array(s), pa.array(np.full(len(q), task, np.int64))], names=["query", "query_id", "vec_id", "score", "task"])

    return search


def _keep(df: DataFrame, group: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*group).orderBy(F.col("score").desc(), F.col("vec_id"))
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


class Block(dict):
    """By vector length: numbers, ids and scaled components of some queries."""


def _read_block(asked: DataFrame, block: int, blocks: int, scale: float) -> Block:
    rows = asked.where(F.pmod(F.xxhash64("number"), F.lit(blocks)) == block).toArrow()  # about block_bytes
    held = Block()
    if rows.num_rows:
        numbers, ids = (np.asarray(rows.column(c), np.int64) for c in ("number", "id"))
        held.update((n, (numbers[at], ids[at], m)) for n, (at, m) in _matrix(rows.column("v").combine_chunks(), scale).items())
    return held


def _block_lists(every: DataFrame, asked: DataFrame, block: int, blocks: int, k: int, scale: float) -> DataFrame:
    """The lists of one block of queries. Of several blocks each is stored before the next is read, so that the driver
    holds one."""
    search = _search(_read_block(asked, block, blocks, scale), k, scale)
    lists = every.mapInArrow(search, "query long, query_id long, vec_id long, score long, task long")
    return lists if blocks == 1 else materialise(lists)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0, block_bytes: int = 64 << 20, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) for each row that is_query names, against all rows."""
    sound = vectors.where(F.col(id_col).isNotNull() & _valid(vec_col))
    every = sound.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    asked = sound.where(is_query).select(F.monotonically_increasing_id().alias("number"), F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    asked = materialise(asked)
    size = asked.select(F.sum(F.size("v") * 8 + 16)).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    lists = reduce(DataFrame.unionByName, [_block_lists(every, asked, b, blocks, k, scale) for b in range(blocks)])
    merged = _keep(lists.withColumn("task", F.floor(F.col("task") / FAN)), ["query", "task"], k).drop("rank")
    return _keep(merged, ["query"], k).select("query_id", "rank", "vec_id", "score")
