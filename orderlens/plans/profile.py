"""Profiles of raw tables and the evidence behind two cleaning rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions.dates import parse_mixed_dates
from orderlens.functions.text import shape_of, to_number
from orderlens.operators.cleaning import SRC
from orderlens.operators.fingerprints import count_duplicates


def profile_table(df: DataFrame, name: str) -> DataFrame:
    """One row per column: rows, exact duplicates, NULLs. NULLs are counted where the rows are; duplicates by fingerprints."""
    data = [c for c in df.columns if c != SRC]
    found = count_duplicates(df, data)
    entries = [F.struct(F.lit(c).alias("column_name"), F.count_if(F.col(c).isNull()).alias("nulls")) for c in data]
    nulls = df.agg(F.array(*entries).alias("e")).select(F.explode("e").alias("e")).select("e.*")
    return nulls.select(
        F.lit(name).alias("table_name"), found.select("rows").scalar().alias("rows"), found.select("duplicates").scalar().alias("duplicates"), "column_name", "nulls")


def profile_tables(raw, names) -> DataFrame:
    parts = [profile_table(raw[n], n) for n in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def profile_patterns(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(shape_of(F.col(col)).alias("shape")).agg(F.count(F.lit(1)).alias("n"))


def check_sign_flip(orders: DataFrame) -> DataFrame:
    """Does |cost| + fee - discount + tax give the amount, for rows with a negative
    cost and for the others?"""
    n = {c: to_number(F.col(c)) for c in ("FoodCost", "DeliveryFee", "Discount", "GST", "FinalAmount")}
    calc = F.abs(n["FoodCost"]) + n["DeliveryFee"] - n["Discount"] + n["GST"]
    d = orders.select((n["FoodCost"] < 0).alias("negative"), (F.abs(calc - n["FinalAmount"]) < 1e-6).alias("ok"))
    return d.filter("negative is not null and ok is not null").groupBy("negative").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("ok").alias("formula_holds"))


def ambiguous_date_share(df: DataFrame, col: str) -> DataFrame:
    flag = parse_mixed_dates(F.col(col))["ambiguous"]
    return df.agg(F.count_if(flag).alias("ambiguous"), F.round(F.avg(flag.cast("double")), 6).alias("share"))
