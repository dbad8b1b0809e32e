"""Dates written in several forms within one column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderlens.functions.text import strip


def parse_mixed_dates(c: Column, day_first: bool = True) -> Column:
    """struct(parsed, ambiguous, alternative). A slash date with both parts up to
    12 has two readings: the default one and the alternative."""
    s = strip(c)

    def read(form: str, pattern: str) -> Column:
        return F.when(s.rlike(form), F.try_to_date(s, pattern))

    slash = s.rlike(r"^\d{2}/\d{2}/\d{4}$")
    first = F.when(slash, F.substring(s, 1, 2).cast("int"))
    second = F.when(slash, F.substring(s, 4, 2).cast("int"))
    dmy = F.when(slash, F.try_to_date(s, "dd/MM/yyyy"))
    mdy = F.when(slash, F.try_to_date(s, "MM/dd/yyyy"))
    default, other = (dmy, mdy) if day_first else (mdy, dmy)
    ambiguous = F.coalesce((first <= 12) & (second <= 12), F.lit(False))
    by_slash = F.when(second > 12, mdy).when(first > 12, dmy).otherwise(default)
    parsed = F.coalesce(
        read(r"^\d{4}-\d{2}-\d{2}$", "yyyy-MM-dd"),
        read(r"^\d{4}\.\d{2}\.\d{2}$", "yyyy.MM.dd"),
        read(r"^\d{2}-\d{2}-\d{4}$", "dd-MM-yyyy"),
        read(r"^\d{1,2} [A-Za-z]{3} \d{4}$", "d MMM yyyy"),
        by_slash,
    )
    return F.struct(
        parsed.alias("parsed"), ambiguous.alias("ambiguous"), F.when(ambiguous, other).alias("alternative")
    )


def pick_closer(parsed: Column, alternative: Column, ambiguous: Column, reference: Column) -> Column:
    """True where the alternative reading is strictly closer to the reference date."""
    gap = F.abs(F.datediff(parsed, reference))
    other = F.abs(F.datediff(alternative, reference))
    return F.coalesce(ambiguous & (other < gap), F.lit(False))
