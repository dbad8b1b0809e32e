"""Equal rows by fingerprints: 16 bytes of a row travel instead of the row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.session import materialise

#: fingerprints that may be broadcast (24 bytes each)
BROADCAST_ROWS = 500_000


def fingerprint(columns: list[str]) -> tuple[Column, Column]:
    """Two 64-bit hashes of a row. Which columns are NULL is part of them: the hash of a NULL is that of nothing."""
    gaps = F.concat(*[F.col(c).isNull().cast("int").cast("string") for c in columns])
    return tuple(F.xxhash64(F.lit(seed), gaps, *[F.col(c) for c in columns]) for seed in (1, 2))


def count_duplicates(df: DataFrame, columns: list[str], hashes: Callable = fingerprint) -> DataFrame:
    """(rows, duplicates): rows beyond the first of each set of equal ones. Fingerprints are counted; only rows whose
    fingerprint stands several times are compared in full, so a collision does not count."""
    one, two = hashes(columns)
    counts = materialise(df.select(one.alias("_f1"), two.alias("_f2")).groupBy("_f1", "_f2").agg(F.count(F.lit(1)).alias("_n")))
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"))
    several = materialise(counts.where("_n > 1").select("_f1", "_f2"))
    few = F.broadcast(several) if several.count() <= BROADCAST_ROWS else several
    alike = df.select(*columns, one.alias("_f1"), two.alias("_f2")).join(few, ["_f1", "_f2"], "left_semi")
    same = alike.groupBy("_f1", "_f2", *columns).agg(F.count(F.lit(1)).alias("_n"))
    return total.withColumn("duplicates", same.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0))).scalar())
