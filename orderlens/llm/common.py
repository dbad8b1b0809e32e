"""What the corpus operators share: settings, stored tables, hashing in tasks."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.session import delete_at_end, materialise, new_folder, release, tune

__all__ = ["batches", "column_names", "delete_at_end", "materialise", "mix64", "new_folder", "ready", "release", "string_hashes", "table"]

#: rows and bytes in one Arrow batch; long texts end a batch early
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20


def ready(spark: SparkSession) -> SparkSession:
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def batches(columns: dict[str, Iterable], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


def column_names(df: DataFrame, wanted: list[str], prefix: str = "_") -> dict[str, str]:
    """A free name for each wanted helper column, whatever the table brings."""
    taken, names = {c.lower() for c in df.columns}, {}
    for name in wanted:
        free = name
        while free.lower() in taken:
            free = prefix + free
        names[name] = free
        taken.add(free.lower())
    return names


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit words that spreads every bit (public splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def string_hashes(words: list[bytes], cache: dict[bytes, int], limit: int = 100_000) -> np.ndarray:
    """64-bit hashes of the words; the cache only saves time and is emptied when full."""
    import xxhash

    if len(cache) > limit:
        cache.clear()
    for w in set(words).difference(cache):
        cache[w] = xxhash.xxh3_64_intdigest(w)
    return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))


def text_bytes(column: str = "text"):
    """UTF-8 bytes of a text column; null counts as empty."""
    return F.coalesce(F.col(column), F.lit("")).cast("binary")


def each(part: Iterator[pa.RecordBatch], name: str) -> Iterator[tuple[pa.RecordBatch, list]]:
    for batch in part:
        if batch.num_rows:
            yield batch, batch.column(batch.schema.get_field_index(name)).to_pylist()
