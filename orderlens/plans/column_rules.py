"""Each cleaning operator on its own, over the raw tables ``r``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.functions.dates import parse_mixed_dates
from orderlens.functions.text import clean_text, digits_or_null, title_case, to_number, truncate_time, upper_code
from orderlens.operators import cleaning as op

SRC = op.SRC


def text(r) -> DataFrame:
    return r["orders"].select(SRC, clean_text(F.col("OrderStatus")).alias("OrderStatus"))


def mixed_dates(r) -> DataFrame:
    return r["orders"].select(SRC, parse_mixed_dates(F.col("OrderDate")).alias("d")).select(SRC, "d.*")


def resolved_dates(r) -> DataFrame:
    d = r["orders"].select(SRC, F.col("OrderID").cast("long").alias("OrderID"), "OrderDate")
    out = op.resolve_ambiguous_dates(d, "OrderDate", "OrderID", op.first_payment_dates(r["payments"]))
    return out.select(SRC, "OrderDate", "ambiguous", "flipped")


def numbers(r) -> DataFrame:
    return r["customers"].select(SRC, *[to_number(F.col(c)).alias(c) for c in ("Age", "TotalOrders")])


def sign_fix(r) -> DataFrame:
    cols = ("FoodCost", "DeliveryFee", "DeliveryTimeMinutes")
    d = r["orders"].select(*[to_number(F.col(c)).alias(c) for c in cols])
    entries = [
        F.struct(F.lit(c).alias("column_name"), F.count_if(F.col(c) < 0).alias("negatives"),
                 F.round(F.sum(F.abs(F.col(c))), 2).alias("total"))
        for c in cols
    ]
    return d.agg(F.array(*entries).alias("e")).select(F.explode("e").alias("e")).select("e.*")


def exact_duplicates(r) -> DataFrame:
    return op.dedupe_rows(r["orders"]).select(SRC, "OrderID", "copies")


def first_per_key(r) -> DataFrame:
    return op.dedupe_key(r["orders"], ["OrderID"], count="copies").select("OrderID", SRC, "OrderStatus", "copies")


def city_names(t) -> DataFrame:
    """Spellings with case changes, blanks and one lost letter."""
    k = F.col("CustomerID")
    lost = F.concat(F.substring("City", 1, 2), F.expr("substring(City, 4)"))
    written = F.when(k % 4 == 0, F.lower("City")).when(k % 4 == 1, F.concat(F.lit("  "), "City", F.lit(" "))).when(
        k % 4 == 2, lost).when(k % 9 == 0, "Nowhere").otherwise(F.col("City"))
    return op.canonical_city(t["customers"].select("CustomerID", written.alias("City")), t["cities"])


def group_median(r) -> DataFrame:
    d = r["weather"].select(SRC, clean_text(F.col("WeatherCondition")).alias("WeatherCondition"), to_number(F.col("Rainfall")).alias("Rainfall"))
    return op.impute_group_median(d, "Rainfall", "WeatherCondition").select(SRC, F.round("Rainfall", 6).alias("Rainfall"))


def whole_median(r) -> DataFrame:
    d = r["orders"].select(SRC, to_number(F.col("FinalAmount")).alias("FinalAmount"))
    return d.withColumn("FinalAmount", F.round(F.coalesce("FinalAmount", op.global_median(d, "FinalAmount")), 6))


def constant(r) -> DataFrame:
    return r["customers"].select(SRC, *[clean_text(F.col(c)).alias(c) for c in ("Gender", "Membership")]).fillna(
        "Unknown", ["Gender", "Membership"])


def mean_of_others(r) -> DataFrame:
    cols = ["CustomerRating", "DeliveryRating", "FoodRating"]
    d = r["customer_feedback"].select(SRC, *[to_number(F.col(c)).alias(c) for c in cols])
    d = d.withColumns({c: F.when(F.col(c) <= 5, F.col(c)) for c in cols})
    return op.impute_row_mean(d, cols)


def out_of_range(r) -> DataFrame:
    m = F.abs(to_number(F.col("DeliveryTimeMinutes")))
    return r["orders"].select(SRC, F.when((m > 0) & (m <= 180), m).alias("DeliveryTimeMinutes"))


def patterns(r) -> DataFrame:
    return r["customers"].select(
        SRC, digits_or_null(F.col("Phone"), 10).alias("Phone"), digits_or_null(F.col("Pincode"), 6, True).alias("Pincode"))


def iqr_cap(r) -> DataFrame:
    d = r["delivery_partners"].select(SRC, F.abs(to_number(F.col("AverageDeliveryTime"))).alias("AverageDeliveryTime"))
    return op.cap_iqr(d, "AverageDeliveryTime").select(
        SRC, F.round("AverageDeliveryTime", 6).alias("AverageDeliveryTime"), F.col("AverageDeliveryTime_outlier").alias("outlier"))


def percentile_cap(r) -> DataFrame:
    d = r["weather"].select(SRC, to_number(F.col("Temperature")).alias("Temperature"), to_number(F.col("Rainfall")).alias("Rainfall"))
    d = op.cap_percentile(op.cap_percentile(d, "Rainfall", 0.99), "Temperature", 0.995)
    return d.select(SRC, F.round("Rainfall", 6).alias("Rainfall"), F.round("Temperature", 6).alias("Temperature"))


def constant_clip(r) -> DataFrame:
    return r["weather"].select(SRC, F.least(F.abs(to_number(F.col("Humidity"))), F.lit(100.0)).alias("Humidity"))


def swapped_dates(r) -> DataFrame:
    d = r["promotions"].select(SRC, *[parse_mixed_dates(F.col(c))["parsed"].alias(c) for c in ("StartDate", "EndDate")])
    return op.swap_reversed(d)


def city_blocks(r) -> DataFrame:
    d = r["weather"].select(F.col("WeatherID").cast("long").alias("WeatherID"), F.upper(clean_text(F.col("City"))).alias("City"))
    return op.fill_city_blocks(d)


def nearest_class(r) -> DataFrame:
    d = r["traffic"].select(SRC, "TrafficLevel", F.abs(to_number(F.col("AverageSpeed"))).alias("AverageSpeed"))
    return op.infer_nearest_class(d, "TrafficLevel", "AverageSpeed").select(SRC, "TrafficLevel")


def amounts(r) -> DataFrame:
    n = {c: to_number(F.col(c)) for c in ("FoodCost", "DeliveryFee", "Discount", "GST", "FinalAmount")}
    calc = F.abs(n["FoodCost"]) + n["DeliveryFee"] - n["Discount"] + n["GST"]
    return r["orders"].select(SRC, F.round(F.coalesce(n["FinalAmount"], calc), 2).alias("FinalAmount"))


def without_orphans(t) -> DataFrame:
    return op.drop_orphans(t["orders_all"], ("CustomerID", t["customers"]), ("RestaurantID", t["restaurants"]),
                           ("DeliveryPartnerID", t["delivery_partners"])).select("OrderID", "RestaurantID")


def known_coupons(r) -> DataFrame:
    codes = r["promotions"].select(upper_code(F.col("CouponCode")).alias("CouponCode"))
    d = r["orders"].select(SRC, upper_code(F.col("CouponCode")).alias("CouponCode"))
    return op.null_unknown(d, "CouponCode", codes)


def best_payment(t) -> DataFrame:
    return op.best_status_row(t["payments_all"]).select("OrderID", "PaymentID", "PaymentStatus")


def coupon_case(r) -> DataFrame:
    return r["promotions"].select(SRC, upper_code(F.col("CouponCode")).alias("CouponCode"))


def city_case(r) -> DataFrame:
    return r["cities"].select(SRC, title_case(clean_text(F.col("City"))).alias("City"))


def short_times(r) -> DataFrame:
    return r["traffic"].select(SRC, truncate_time(F.col("Time"), 5).alias("Time"))
