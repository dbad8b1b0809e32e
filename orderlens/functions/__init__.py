"""Small column expressions shared by the jobs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderlens.constants import COMPLETED, EARTH_RADIUS_KM


def is_completed(status="OrderStatus") -> Column:
    return F.col(status).isin(*COMPLETED)


def ratio(num: Column, den: Column) -> Column:
    """num / den as a double, NULL for a zero denominator."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def pct(num: Column, den: Column) -> Column:
    return F.round(ratio(num * F.lit(100.0), den), 2)


def rate(flag: Column) -> Column:
    """Share of rows where the flag holds."""
    return F.avg(flag.cast("double"))


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    a1, o1, a2, o2 = (F.radians(c) for c in (lat1, lon1, lat2, lon2))
    half_chord = F.pow(F.sin((a2 - a1) / 2), 2) + F.cos(a1) * F.cos(a2) * F.pow(F.sin((o2 - o1) / 2), 2)
    return F.asin(F.sqrt(half_chord)) * 2 * EARTH_RADIUS_KM


def minute_of_day(text: Column) -> Column:
    """Minutes since midnight of an HH:mm[:ss] text, NULL if it is not a time."""
    ok = text.rlike(r"^([01]\d|2[0-3]):[0-5]\d(:[0-5]\d)?$")
    return F.when(ok, F.substring(text, 1, 2).cast("int") * 60 + F.substring(text, 4, 2).cast("int"))
