"""Joins with a table beside the rows: sent to all of them, or dealt by its key with them, by its rows.

Spark's own choice goes by the bytes of files. Keys in order and values that repeat take less than a byte a row there and a
hundred in memory, so that a table of millions of rows passes for a small one and is gathered on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: rows of a dimension that may be sent to every executor (some 150 bytes each)
LOOKUP_ROWS = 500_000


def beside(stored: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """``rows`` (made of the stored table, at most as many) for a join: left to Spark while they are few, else not sent whole."""
    rows = stored if rows is None else rows
    return rows if stored.count() <= LOOKUP_ROWS else rows.hint("merge")


def lookup(dim: DataFrame) -> DataFrame:
    """A stored dimension for a join: sent to the rows while it has few rows itself, so that the rows need not move."""
    return F.broadcast(dim) if dim.count() <= LOOKUP_ROWS else dim.hint("merge")
