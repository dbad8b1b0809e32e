"""Feature matrices and reproducible splits."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.operators.blocks import percentiles, row_numbers, sort_blocks
from orderlens.session import materialise

SEED = 42
#: rows of a stored table for one task of a fit
ROWS_PER_PART = 50_000
# The model inputs.
DELIVERY_NUMERIC = [
    "TrafficScore", "AverageSpeed", "RainImpact", "Rainfall", "Temperature", "Humidity", "PeakHour", "WeekendOrder", "hour", "dow",
    "DistanceProxyKm", "DeliveryEfficiency", "PartnerRating", "CompletedDeliveries", "BasketSize", "ItemLines", "FoodCost", "DeliveryFee",
    "DiscountPct", "RestaurantRating", "AverageCost", "RestaurantPopularityRank", "CustomerTenure", "CustomerAge",
]
DELIVERY_CATEGORIES = ["VehicleType", "WeatherCondition", "Membership", "RestaurantType"]
CHURN_NUMERIC = [
    "Recency", "Frequency", "Monetary", "AvgOrderValue", "CancelRate", "LateRate", "CouponRate", "AvgDeliveryTime", "AvgRating",
    "DistinctRestaurants", "WeekendShare", "FirstOrderAgeDays", "AvgGapDays", "Tenure", "Age",
]
CHURN_CATEGORIES = ["Membership"]


def fill_medians(df: DataFrame, cols: list[str]) -> DataFrame:
    """NULLs take the exact column median. Columns without a NULL are left alone, so
    their median is never computed."""
    gaps = df.agg(*[F.max(F.col(c).isNull()).alias(c) for c in cols]).first()  # one row of flags
    fills = {c: F.coalesce(F.col(c), percentiles(df, [], c, {"m": 0.5}).scalar()) for c in cols if gaps[c]}
    return df.withColumns(fills) if fills else df


def delivery_rows(base: DataFrame) -> DataFrame:
    d = base.filter("IsDelivered and DeliveryTimeMinutes is not null")
    d = d.select("OrderID", "RCity", "OrderDate", "IsLate", F.col("DeliveryTimeMinutes").cast("double").alias("label"),
                 *[F.col(c).cast("double").alias(c) for c in DELIVERY_NUMERIC], *DELIVERY_CATEGORIES)
    return fill_medians(d, DELIVERY_NUMERIC)


def churn_rows(churn: DataFrame) -> DataFrame:
    d = churn.select("CustomerID", F.col("Churn").cast("int").alias("label"), *[F.col(c).cast("double").alias(c) for c in CHURN_NUMERIC], *CHURN_CATEGORIES)
    return fill_medians(d, CHURN_NUMERIC)


def encoder(numeric: list[str], categories: list[str], out: str = "features") -> Pipeline:
    """Numeric columns and one column per category value."""
    stages = [StringIndexer(inputCols=categories, outputCols=[f"{c}_i" for c in categories], stringOrderType="alphabetAsc", handleInvalid="keep"),
              OneHotEncoder(inputCols=[f"{c}_i" for c in categories], outputCols=[f"{c}_v" for c in categories], dropLast=True),
              VectorAssembler(inputCols=[*numeric, *[f"{c}_v" for c in categories]], outputCol=out)]
    return Pipeline(stages=stages)


def feature_names(fitted, numeric: list[str], categories: list[str]) -> list[str]:
    indexer = fitted.stages[0]
    return [*numeric, *[f"{c}_{v}" for c, vs in zip(categories, indexer.labelsArray) for v in vs]]


def split(df: DataFrame, key: str, share: float = 0.2, seed: int = SEED, stratify: str | None = None) -> DataFrame:
    """Adds Split (train or test): the first rows in hash order, per class if
    stratified. Depends on the keys only, not on partitions."""
    by = [stratify] if stratify else []
    hashed = df.select(key, *by).withColumn("_h", F.xxhash64(F.col(key), F.lit(seed)))
    rn = row_numbers(sort_blocks(hashed, by, ["_h", key]), by)
    if by:
        sizes = df.groupBy(*by).agg(F.bround(F.count(F.lit(1)) * share).alias("_test"))
        marked = rn.join(sizes, by)
    else:
        marked = rn.withColumn("_test", df.select(F.bround(F.count(F.lit(1)) * share)).scalar())
    marks = marked.select(F.col(key).alias("_k"), F.when(F.col("rn") <= F.col("_test"), "test").otherwise("train").alias("Split"))
    return df.join(marks, df[key] == marks["_k"]).drop("_k")


def folds(df: DataFrame, key: str, n: int, seed: int = 0, stratify: str | None = None) -> DataFrame:
    """Adds ``fold``: equal parts in hash order, per class if stratified."""
    by = [stratify] if stratify else []
    hashed = df.select(key, *by).withColumn("_h", F.xxhash64(F.col(key), F.lit(seed)))
    rn = row_numbers(sort_blocks(hashed, by, ["_h", key]), by)
    marks = rn.select(F.col(key).alias("_k"), (F.col("rn") % n).cast("int").alias("fold"))
    return df.join(marks, df[key] == marks["_k"]).drop("_k")


def scaling(df: DataFrame, cols: list[str]) -> DataFrame:
    """(feature, mean, scale) with the population deviation, 1 where it is zero."""
    entries = []
    for c in cols:
        sd = F.stddev_pop(c)
        entries.append(F.struct(F.lit(c).alias("feature"), F.avg(c).alias("mean"), F.when(sd == 0, 1.0).otherwise(sd).alias("scale")))
    return df.agg(F.array(*entries).alias("e")).select(F.explode("e").alias("e")).select("e.*")


def scaler() -> StandardScaler:
    return StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)


def class_weights(train: DataFrame) -> DataFrame:
    """Rows of the two classes get the same total weight; a class alone keeps weight 1."""
    n = train.select(F.count(F.lit(1))).scalar()
    ones = train.select(F.sum("label")).scalar()
    share = F.when(F.col("label") == 1, ones).otherwise(n - ones)
    w = F.when((ones > 0) & (ones < n), F.try_divide(n.cast("double"), 2.0 * share)).otherwise(1.0)
    return train.withColumn("weight", w)


def prepared(rows: DataFrame, key: str, numeric: list[str], categories: list[str], stratify: str | None = None):
    """(encoded rows with Split, feature names), stored once for all fits."""
    fitted = encoder(numeric, categories).fit(rows)
    enc = fitted.transform(rows).drop(*[f"{c}{s}" for c in categories for s in ("_i", "_v")])
    return materialise(split(enc, key, stratify=stratify)), feature_names(fitted, numeric, categories)
