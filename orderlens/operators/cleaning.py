"""DataFrame to DataFrame cleaning operators."""

from __future__ import annotations

import difflib
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from orderlens.constants import FUZZY_CUTOFF, PAYMENT_RANK
from orderlens.functions.dates import parse_mixed_dates, pick_closer
from orderlens.functions.text import city_alias, clean_text
from orderlens.operators.blocks import percentiles, running, sort_blocks
from orderlens.operators.joins import beside

SRC = "SourceRow"


# ------------------------------------------------------------- duplicates
def dedupe_rows(df: DataFrame, src: str = SRC) -> DataFrame:
    """Exact duplicates (apart from their place in the file) become one row; the
    earliest place and the number of dropped copies are kept."""
    data = [c for c in df.columns if c != src]
    return df.groupBy(*data).agg(F.min(src).alias(src), (F.count(F.lit(1)) - 1).alias("copies"))


def dedupe_key(df: DataFrame, key: list[str], order=SRC, count: str | None = None, sums: tuple = (), without: tuple = ()) -> DataFrame:
    """The first row per key by ``order``. A mergeable aggregate, so the copies of a
    hot key are reduced before the exchange. Columns named in ``without`` are not moved."""
    order_col = order if isinstance(order, Column) else F.col(order)
    rest = [c for c in df.columns if c not in key and c not in sums and c not in without]
    aggs = [F.min_by(F.struct(*rest), order_col).alias("_r")]
    aggs += [F.sum(c).alias(c) for c in sums]
    if count:
        aggs.append((F.count(F.lit(1)) - 1).alias(count))
    extra = [*sums, *([count] if count else [])]
    return df.groupBy(*key).agg(*aggs).select(*key, *[F.col(f"_r.{c}").alias(c) for c in rest], *extra)


def best_status_row(payments: DataFrame, count: str | None = None, sums: tuple = (), without: tuple = ()) -> DataFrame:
    """One payment per order: best status, then the highest PaymentID."""
    rank = reduce(
        lambda acc, kv: acc.when(F.col("PaymentStatus") == kv[0], kv[1]),
        list(PAYMENT_RANK.items())[1:],
        F.when(F.col("PaymentStatus") == "Success", 0),
    ).otherwise(4)
    return dedupe_key(payments, ["OrderID"], F.struct(rank, -F.col("PaymentID")), count, sums, without)


# ------------------------------------------------------------- city names
@F.pandas_udf(DoubleType())
def _similarity(known: pd.Series, key: pd.Series) -> pd.Series:
    return pd.Series([difflib.SequenceMatcher(None, a, b).ratio() for a, b in zip(known, key, strict=True)], dtype="float64")


def _pieces(c: Column) -> Column:
    """Letter pairs, for up to three letters the letters too. Two texts whose similarity reaches the cutoff share one:
    only matches of single letters would stay below it, but for the shortest texts."""
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - 1, F.lit(1))), lambda i: c.substr(i, F.lit(2)))
    letters = F.when(F.length(c) <= 3, F.split(c, "")).otherwise(F.array().cast("array<string>"))
    return F.explode(F.array_distinct(F.concat(pairs, letters)))


def city_lookup(texts: DataFrame, col: str, cities: DataFrame) -> DataFrame:
    """(city_key, canonical) for the distinct spellings found: exact, alias, then closest."""
    keys = texts.select(F.lower(clean_text(F.col(col))).alias("city_key")).distinct().filter("city_key is not null")
    names = cities.select(F.lower("City").alias("known"), F.col("City").alias("canonical"))
    exact = keys.join(names, F.col("city_key") == F.col("known"), "left").select(
        "city_key", F.coalesce("canonical", city_alias(F.col("city_key"))).alias("canonical")
    )
    # only names that share a piece and are of like length can be close enough; those are scored
    left = exact.filter("canonical is null").select("city_key", _pieces(F.col("city_key")).alias("piece"))
    pieces = names.select("known", _pieces(F.col("known")).alias("piece"))
    short, long = (f(F.length("city_key"), F.length("known")) for f in (F.least, F.greatest))
    like = (short + short).cast("double") / (short + long) >= FUZZY_CUTOFF  # no ratio is above this
    pairs = left.join(pieces, "piece").filter(like).select("city_key", "known").distinct()
    scored = pairs.withColumn("score", _similarity("known", "city_key")).filter(F.col("score") >= FUZZY_CUTOFF)
    best = scored.groupBy("city_key").agg(F.max_by("known", F.struct("score", "known")).alias("known"))
    fuzzy = best.join(names, "known").select("city_key", "canonical")
    return exact.filter("canonical is not null").unionByName(fuzzy)


def canonical_city(df: DataFrame, cities: DataFrame, col: str = "City") -> DataFrame:
    """Replace ``col`` by the canonical name, NULL where nothing is close enough."""
    look = city_lookup(df, col, cities)
    joined = df.withColumn("_ck", F.lower(clean_text(F.col(col)))).join(
        look, F.col("_ck") == F.col("city_key"), "left"
    )
    return joined.select(*[F.col("canonical").alias(col) if c == col else F.col(c) for c in df.columns])


# ------------------------------------------------------------- imputation
def impute_group_median(df: DataFrame, value: str, by: str, then_global: bool = False, bounded: bool = False, medians: DataFrame | None = None) -> DataFrame:
    """Fill by the exact group median. ``bounded`` says the column has few distinct
    values, so a plain aggregate of value counts stays small; ``medians`` (group, _med) are known ones."""
    if medians is not None:
        med = medians
    elif bounded:
        med = df.groupBy(by).agg(F.median(value).alias("_med"))
    else:
        med = percentiles(df, [by], value, {"_med": 0.5})
    out = df.join(med, by, "left")
    fills = [F.col(value), F.col("_med")]
    if then_global:
        fills.append(global_median(df, value, bounded))
    return out.withColumn(value, F.coalesce(*fills)).select(*df.columns)


def global_median(df: DataFrame, value: str, bounded: bool = False) -> Column:
    if bounded:
        return df.select(F.median(value)).scalar()
    return percentiles(df, [], value, {"m": 0.5}).scalar()


def row_mean(*cols: Column) -> Column:
    """Mean of the non-null values of a row."""
    n = reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in cols])
    s = reduce(lambda a, b: a + b, [F.coalesce(c.cast("double"), F.lit(0.0)) for c in cols])
    return F.try_divide(s, n.cast("double"))


def impute_row_mean(df: DataFrame, cols: list[str]) -> DataFrame:
    """Each column in turn takes the mean of the others, then its own median."""
    for c in cols:
        others = [F.col(o) for o in cols if o != c]
        med = global_median(df.select(c), c, bounded=True)  # ratings: a handful of values
        df = df.withColumn(c, F.bround(F.coalesce(F.col(c), row_mean(*others), med)))
    return df


# ------------------------------------------------------------------- caps
def cap_iqr(df: DataFrame, value: str, width: float = 3.0) -> DataFrame:
    q = percentiles(df, [], value, {"q1": 0.25, "q3": 0.75})
    low = q.select(F.col("q1") - width * (F.col("q3") - F.col("q1"))).scalar()
    high = q.select(F.col("q3") + width * (F.col("q3") - F.col("q1"))).scalar()
    v = F.col(value)
    return df.withColumns(
        {f"{value}_outlier": F.coalesce((v < low) | (v > high), F.lit(False)),
         value: F.when(v.isNotNull(), F.greatest(F.least(v, high), low))}
    )


def upper_percentile(df: DataFrame, value: str, p: float) -> Column:
    return percentiles(df, [], value, {"p": p}).scalar()


def cap_percentile(df: DataFrame, value: str, p: float, limit: Column | None = None) -> DataFrame:
    high = upper_percentile(df, value, p) if limit is None else limit
    v = F.col(value)
    return df.withColumns(
        {f"{value}_outlier": F.coalesce(v > high, F.lit(False)), value: F.when(v > high, high).otherwise(v)}
    )


# ------------------------------------------------- order-dependent repairs
def fill_city_blocks(df: DataFrame, order: str = "WeatherID", col: str = "City") -> DataFrame:
    """A missing city takes the last one above it; ``recovered`` marks rows whose
    neighbours above and below agree."""
    blk = sort_blocks(df, [], [order])
    out = running(blk, [], {"_above": ("last", col), "_below": ("next", col)})
    return out.withColumns(
        {"recovered": F.coalesce(F.col(col).isNull() & (F.col("_above") == F.col("_below")), F.lit(False)),
         col: F.coalesce(col, "_above")}
    ).select(*df.columns, "recovered")


def infer_nearest_class(df: DataFrame, label: str, value: str) -> DataFrame:
    """A missing label becomes the one whose median is nearest; ties go by name.

    The class medians and the values in need are put in one order; the nearest median is the last one before a value or
    the next one after it."""
    med = percentiles(df.filter(F.col(label).isNotNull()), [label], value, {"m": 0.5})
    points = med.groupBy("m").agg(F.min(label).alias("name")).select(F.col("m").alias("_v"), F.struct("m", "name").alias("_class"))
    need = df.filter(F.col(label).isNull() & F.col(value).isNotNull()).select(F.col(value).cast("double").alias("_v")).distinct()
    blk = sort_blocks(need.withColumn("_class", F.lit(None).cast(points.schema["_class"].dataType)).unionByName(points), [], ["_v"])
    near = running(blk, [], {"_low": ("last", "_class"), "_high": ("next", "_class")}).filter("_class is null")
    choices = [F.when(F.col(c).isNotNull(), F.struct(F.abs(F.col(c)["m"] - F.col("_v")).alias("gap"), F.col(c)["name"].alias("name"))) for c in ("_low", "_high")]
    nearest = near.select("_v", F.array_min(F.array_compact(F.array(*choices)))["name"].alias("_name"))
    on = F.when(F.col(label).isNull(), F.col(value).cast("double")) == F.col("_v")
    return df.join(nearest, on, "left").withColumns(
        {f"{label}_inferred": F.col(label).isNull(), label: F.coalesce(F.col(label), "_name")}
    ).drop("_v", "_name")


def swap_reversed(df: DataFrame, start: str = "StartDate", end: str = "EndDate") -> DataFrame:
    wrong = F.coalesce(F.col(end) < F.col(start), F.lit(False))
    return df.withColumns(
        {"swapped": wrong, start: F.when(wrong, F.col(end)).otherwise(F.col(start)),
         end: F.when(wrong, F.col(start)).otherwise(F.col(end))}
    )


def resolve_ambiguous_dates(df: DataFrame, col: str, key: str, refs: DataFrame) -> DataFrame:
    """``refs`` has (key, reference). Adds ambiguous and flipped marks."""
    d = df.withColumn("_d", parse_mixed_dates(F.col(col))).join(refs, key, "left")
    flip = pick_closer(F.col("_d.parsed"), F.col("_d.alternative"), F.col("_d.ambiguous"), F.col("reference"))
    return d.withColumns(
        {"flipped": flip, "ambiguous": F.col("_d.ambiguous"),
         col: F.when(flip, F.col("_d.alternative")).otherwise(F.col("_d.parsed"))}
    ).drop("_d", "reference")


def first_payment_dates(raw_payments: DataFrame) -> DataFrame:
    """(OrderID, reference): the first payment's date where it is unambiguous."""
    first = raw_payments.groupBy(F.col("OrderID").try_cast("long").alias("OrderID")).agg(
        F.min_by("PaymentDate", SRC).alias("text"))
    d = parse_mixed_dates(F.col("text"))
    return first.withColumn("_d", d).select(
        "OrderID", F.when(~F.col("_d.ambiguous"), F.col("_d.parsed")).alias("reference"))


# ------------------------------------------------------------------- keys
def mark_known(df: DataFrame, key: str, parent: DataFrame, flag: str, parent_key: str | None = None) -> DataFrame:
    """Add a boolean column: does the key exist in the parent? ``parent`` is stored, or small: its rows are counted."""
    p = parent.select(F.col(parent_key or key).alias("_pk")).filter("_pk is not null").distinct().withColumn("_hit", F.lit(True))
    return (
        df.join(beside(parent, p), F.col(key) == F.col("_pk"), "left")
        .withColumn(flag, F.coalesce("_hit", F.lit(False))).drop("_pk", "_hit")
    )


def drop_orphans(df: DataFrame, *parents: tuple[str, DataFrame]) -> DataFrame:
    for key, parent in parents:
        df = df.join(beside(parent, parent.select(key)), key, "left_semi")
    return df


def null_unknown(df: DataFrame, key: str, parent: DataFrame) -> DataFrame:
    return (
        mark_known(df, key, parent, "_known").withColumn(key, F.when(F.col("_known"), F.col(key))).select(*df.columns)
    )


def count_negative(df: DataFrame, *cols: str) -> DataFrame:
    return df.agg(*[F.count_if(F.col(c) < 0).alias(c) for c in cols])
