"""The business query bank. ``t`` maps a table name to its DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderlens.constants import CANCELLED
from orderlens.functions import pct, ratio
from orderlens.operators.blocks import neighbours, ranks, row_numbers, running, sort_blocks
from orderlens.session import delete_at_end, new_folder


def _delivered():
    return F.col("OrderStatus") == "Delivered"


def _orders_by_restaurant(t, *cols) -> DataFrame:
    r = t["restaurants"].select("RestaurantID", *cols)
    return t["orders"].join(r, "RestaurantID")


def _restaurant_revenue(t, orders: DataFrame) -> DataFrame:
    """Revenue is summed per restaurant before the names are joined."""
    per = orders.groupBy("RestaurantID").agg(
        F.round(F.sum("FinalAmount"), 2).alias("total_revenue"), F.count("OrderID").alias("total_orders")
    )
    return t["restaurants"].select("RestaurantID", "RestaurantName", "City").join(per, "RestaurantID")


# ------------------------------------------------------------------ A: core
def a1_top_restaurants_revenue(t, as_of: str) -> DataFrame:
    recent = t["orders"].filter((F.col("OrderDate") >= F.add_months(F.lit(as_of).cast("date"), -6)) & _delivered())
    return _restaurant_revenue(t, recent).orderBy(F.desc("total_revenue"), "RestaurantID").limit(10)


def a2_avg_delivery_by_city(t) -> DataFrame:
    d = _orders_by_restaurant(t, "City").filter("DeliveryTimeMinutes is not null")
    return d.groupBy("City").agg(
        F.round(F.avg("DeliveryTimeMinutes"), 2).alias("avg_delivery_time"), F.count(F.lit(1)).alias("order_count")
    ).orderBy(F.desc("avg_delivery_time"), "City")


def a3_cuisine_having(t, min_orders: int = 500, min_rating: float = 4.0) -> DataFrame:
    d = _orders_by_restaurant(t, "Cuisine", "Rating").filter(_delivered())
    g = d.groupBy("Cuisine").agg(F.count("OrderID").alias("delivered_orders"), F.avg("Rating").alias("r"))
    return (
        g.filter((F.col("delivered_orders") > min_orders) & (F.col("r") > min_rating))
        .select("Cuisine", "delivered_orders", F.round("r", 2).alias("avg_cuisine_rating"))
        .orderBy(F.desc("delivered_orders"), "Cuisine")
    )


def a4_cancel_rate_by_cuisine(t) -> DataFrame:
    cancelled = F.count_if(F.col("OrderStatus") == CANCELLED)
    return _orders_by_restaurant(t, "Cuisine").groupBy("Cuisine").agg(
        cancelled.alias("cancelled_orders"), F.count(F.lit(1)).alias("total_orders"),
        pct(cancelled, F.count(F.lit(1))).alias("cancellation_rate_pct"),
    ).orderBy(F.desc("cancellation_rate_pct"), "Cuisine")


# ----------------------------------------------------------------- B: joins
def b1_order_names(t, n: int = 100) -> DataFrame:
    c = t["customers"].select("CustomerID", F.col("Name").alias("customer_name"))
    r = t["restaurants"].select("RestaurantID", "RestaurantName")
    return (
        t["orders"].join(c, "CustomerID").join(r, "RestaurantID")
        .select("OrderID", "customer_name", "RestaurantName", "FinalAmount", "OrderStatus")
        .orderBy("OrderID").limit(n)
    )


def b2_restaurant_feedback_left(t) -> DataFrame:
    rated = t["orders"].select("OrderID", "RestaurantID").join(
        t["customer_feedback"].select("OrderID", "FeedbackID", "CustomerRating"), "OrderID"
    )
    per = rated.groupBy("RestaurantID").agg(F.count("FeedbackID").alias("n"), F.avg("CustomerRating").alias("r"))
    return t["restaurants"].join(per, "RestaurantID", "left").select(
        "RestaurantID", "RestaurantName", F.coalesce("n", F.lit(0)).alias("feedback_count"),
        F.round("r", 2).alias("avg_customer_rating"),
    ).orderBy("feedback_count", "RestaurantID")


def b3_payment_right(t, n: int = 100) -> DataFrame:
    o = t["orders"].select("OrderID", "FinalAmount", "OrderStatus")
    # the first n payments are fixed by the payment side alone: cut before the join
    p = t["payments"].select("PaymentID", "OrderID", "PaymentStatus").orderBy("PaymentID").limit(n)
    return o.join(p, "OrderID", "right").select(
        "PaymentID", "OrderID", "PaymentStatus", "FinalAmount", "OrderStatus"
    ).orderBy("PaymentID")


def b4_partner_pairs_self(t, n: int = 100, gap: float = 20) -> DataFrame:
    """First n pairs by (partner_a, partner_b). Every partner_a with any match adds
    at least one pair, so the first n of those hold the answer; only they are joined."""
    p = t["delivery_partners"].select(
        "DeliveryPartnerID", "City", "AverageDeliveryTime", (-F.col("AverageDeliveryTime")).alias("neg")
    )
    blk = sort_blocks(p, ["City"], [F.col("DeliveryPartnerID").desc()])
    later = running(blk, ["City"], {"hi": ("max", "AverageDeliveryTime"), "lo": ("max", "neg")})
    first = (
        later.filter((F.col("hi") - F.col("AverageDeliveryTime") > gap) | (F.col("lo") - F.col("neg") > gap))
        .select(F.col("DeliveryPartnerID").alias("partner_a"), "City", F.col("AverageDeliveryTime").alias("a_avg_time"))
        .orderBy("partner_a").limit(n)
    )
    other = p.select(F.col("DeliveryPartnerID").alias("partner_b"), "City", F.col("AverageDeliveryTime").alias("b_avg_time"))
    return (
        other.join(F.broadcast(first), "City")  # n rows at most
        .filter((F.col("partner_a") < F.col("partner_b")) & (F.abs(F.col("a_avg_time") - F.col("b_avg_time")) > gap))
        .select("partner_a", "partner_b", "City", "a_avg_time", "b_avg_time")
        .orderBy("partner_a", "partner_b").limit(n)
    )


def b5_attention_union(t, below: float = 3.0) -> DataFrame:
    r = t["restaurants"].filter(F.col("Rating") < below).select(
        F.col("RestaurantID").alias("entity_id"), F.col("RestaurantName").alias("entity_name"),
        F.lit("Restaurant").alias("entity_type"), "Rating")
    p = t["delivery_partners"].filter(F.col("Rating") < below).select(
        F.col("DeliveryPartnerID").alias("entity_id"), F.col("Name").alias("entity_name"),
        F.lit("DeliveryPartner").alias("entity_type"), "Rating")
    return r.union(p).distinct().orderBy("Rating", "entity_type", "entity_id")


# ------------------------------------------------------------------ C: case
def c1_delivery_tier(t) -> DataFrame:
    m = F.col("DeliveryTimeMinutes")
    tier = (
        F.when(m.isNull(), "Unknown").when(m <= 20, "Fast").when(m <= 40, "On Time")
        .when(m <= 60, "Delayed").otherwise("Severely Delayed")
    )
    return t["orders"].select("OrderID", m, tier.alias("delivery_tier"))


def c2_value_segment(t, platinum=20000, gold=10000, silver=3000) -> DataFrame:
    spend = t["orders"].groupBy("CustomerID").agg(F.round(F.sum("FinalAmount"), 2).alias("lifetime_spend"))
    s = F.col("lifetime_spend")
    segment = F.when(s >= platinum, "Platinum").when(s >= gold, "Gold").when(s >= silver, "Silver").otherwise("Bronze")
    return (
        t["customers"].select("CustomerID", "Name").join(spend, "CustomerID")
        .withColumn("value_segment", segment).orderBy(F.desc("lifetime_spend"), "CustomerID")
    )


# ------------------------------------------------------------ D: subqueries
def d1_above_avg_cost(t) -> DataFrame:
    r = t["restaurants"].select("RestaurantID", "RestaurantName", "AverageCost")
    mean = r.select(F.avg("AverageCost")).scalar()
    return r.filter(F.col("AverageCost") > mean).orderBy(F.desc("AverageCost"), "RestaurantID")


def d2_last_order_cancelled(t) -> DataFrame:
    """The last status per customer is a mergeable aggregate: no per-customer sort."""
    last = t["orders"].groupBy("CustomerID").agg(
        F.max_by("OrderStatus", F.struct("OrderDate", "OrderTime", "OrderID")).alias("s")
    ).filter(F.col("s") == CANCELLED)
    return t["customers"].select("CustomerID", "Name").join(last, "CustomerID", "left_semi")


def d3_monthly_city_revenue_lag(t) -> DataFrame:
    d = _orders_by_restaurant(t, "City").filter(_delivered())
    m = d.groupBy("City", F.trunc("OrderDate", "month").alias("order_month")).agg(
        F.round(F.sum("FinalAmount"), 2).alias("revenue"))
    w = Window.partitionBy("City").orderBy("order_month")  # one row per month and city
    return m.withColumn("prev_month_revenue", F.lag("revenue").over(w)).orderBy("City", "order_month")


def d4_repeat_segment(t) -> DataFrame:
    counts = t["orders"].groupBy("CustomerID").agg(F.count(F.lit(1)).alias("n"))
    segment = F.when(F.col("n") == 1, "One-Time").otherwise("Repeat").alias("segment")
    return counts.groupBy(segment).agg(F.count(F.lit(1)).alias("num_customers"))


# --------------------------------------------------------------- E: windows
def e1_rank_in_city(t) -> DataFrame:
    rev = _restaurant_revenue(t, t["orders"].filter(_delivered())).drop("total_orders")
    return ranks(rev, ["City"], "total_revenue", "RestaurantID")


def e2_top3_per_city(t, k: int = 3) -> DataFrame:
    rev = _restaurant_revenue(t, t["orders"].filter(_delivered())).drop("total_orders")
    w = Window.partitionBy("City").orderBy(F.desc("total_revenue"))
    # rank <= k becomes a per-partition group limit before the exchange
    return rev.withColumn("city_rank", F.rank().over(w)).filter(F.col("city_rank") <= k)


def e3_order_lag_lead(t) -> DataFrame:
    d = t["orders"].filter(_delivered()).select("OrderID", "CustomerID", "OrderDate", "FinalAmount")
    out = neighbours(sort_blocks(d, ["CustomerID"], ["OrderDate", "OrderID"]), ["CustomerID"], ["FinalAmount"])
    return out.select(
        "CustomerID", "OrderDate", "FinalAmount", F.col("prev_FinalAmount").alias("previous_order_amount"),
        F.col("next_FinalAmount").alias("next_order_amount"),
        F.round(F.col("FinalAmount") - F.col("prev_FinalAmount"), 2).alias("change_vs_previous"),
    )


def e4_recency_rank(t, as_of: str) -> DataFrame:
    last = t["orders"].groupBy("CustomerID").agg(F.max("OrderDate").alias("last_order_date"))
    days = last.groupBy("last_order_date").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(F.lit(0)).orderBy("last_order_date").rowsBetween(Window.unboundedPreceding, -1)
    # one row per calendar day: the global rank needs no global sort of customers
    rank = days.select("last_order_date", (F.coalesce(F.sum("n").over(w), F.lit(0)) + 1).alias("recency_rank"))
    return last.join(rank, "last_order_date").select(
        "CustomerID", "last_order_date",
        F.datediff(F.lit(as_of).cast("date"), "last_order_date").alias("days_since_last_order"), "recency_rank")


# ----------------------------------------------------------------- F: views
def f1_order_base_view(t) -> DataFrame:
    c = t["customers"].select("CustomerID", F.col("City").alias("customer_city"))
    r = t["restaurants"].select(
        "RestaurantID", F.col("City").alias("restaurant_city"), "Cuisine", F.col("Rating").alias("restaurant_rating"))
    p = t["delivery_partners"].select("DeliveryPartnerID", "VehicleType", F.col("Rating").alias("partner_rating"))
    return (
        t["orders"].join(c, "CustomerID").join(r, "RestaurantID").join(p, "DeliveryPartnerID")
        .select("OrderID", "CustomerID", "RestaurantID", "DeliveryPartnerID", "OrderDate", "OrderTime",
                "DeliveryTimeMinutes", "FinalAmount", "OrderStatus", "customer_city", "restaurant_city", "Cuisine",
                "restaurant_rating", "VehicleType", "partner_rating")
    )


def f2_restaurant_scorecard_view(t) -> DataFrame:
    per = t["orders"].groupBy("RestaurantID").agg(
        F.count("OrderID").alias("n"), F.count_if(F.col("OrderStatus") == CANCELLED).alias("c"),
        F.round(F.avg("DeliveryTimeMinutes"), 2).alias("avg_delivery_time"))
    return t["restaurants"].join(per, "RestaurantID", "left").select(
        "RestaurantID", "RestaurantName", "City", "Rating", F.coalesce("n", F.lit(0)).alias("total_orders"),
        F.coalesce("c", F.lit(0)).alias("cancelled_orders"),
        F.round(ratio(F.col("c") * 100.0, F.col("n")), 2).alias("cancellation_rate_pct"), "avg_delivery_time")


def register_views(t) -> None:
    f1_order_base_view(t).createOrReplaceTempView("vw_order_base")
    f2_restaurant_scorecard_view(t).createOrReplaceTempView("vw_restaurant_scorecard")


# ----------------------------------------------------------------- G: dates
def g1_orders_by_weekday(t) -> DataFrame:
    g = t["orders"].groupBy(F.weekday("OrderDate").alias("iso")).agg(
        F.max(F.date_format("OrderDate", "EEEE")).alias("day_of_week"), F.count(F.lit(1)).alias("order_count"),
        F.round(F.sum("FinalAmount"), 2).alias("total_revenue"))
    return g.orderBy("iso").drop("iso")


def g2_quarter_revenue(t) -> DataFrame:
    return t["orders"].filter(_delivered()).groupBy(
        F.year("OrderDate").alias("order_year"), F.quarter("OrderDate").alias("order_quarter")
    ).agg(F.round(F.sum("FinalAmount"), 2).alias("revenue")).orderBy("order_year", "order_quarter")


def g3_tenure_days(t, as_of: str) -> DataFrame:
    return t["customers"].select(
        "CustomerID", "RegistrationDate",
        F.datediff(F.lit(as_of).cast("date"), "RegistrationDate").alias("tenure_days"))


# ------------------------------------------------------- H: several tables
def _time_by_reading(t, readings: str, label: str) -> DataFrame:
    """Orders and readings are both counted per (city, date) before they meet, so
    the fan-out of repeated readings becomes a multiplication."""
    o = _orders_by_restaurant(t, "City").groupBy("City", F.col("OrderDate").alias("Date")).agg(
        F.sum("DeliveryTimeMinutes").alias("s"), F.count("DeliveryTimeMinutes").alias("m"), F.count(F.lit(1)).alias("n"))
    r = t[readings].groupBy("City", "Date", label).agg(F.count(F.lit(1)).alias("k"))
    return o.join(r, ["City", "Date"]).groupBy(label).agg(
        F.round(ratio(F.sum(F.col("s") * F.col("k")), F.sum(F.col("m") * F.col("k"))), 2).alias("avg_delivery_time"),
        F.sum(F.col("n") * F.col("k")).alias("order_count"))


def h1_delivery_by_weather(t) -> DataFrame:
    return _time_by_reading(t, "weather", "WeatherCondition")


def h2_delivery_by_traffic(t) -> DataFrame:
    return _time_by_reading(t, "traffic", "TrafficLevel")


def h3_coupon_performance(t) -> DataFrame:
    used = t["orders"].groupBy("CouponCode").agg(
        F.count("OrderID").alias("orders_using_coupon"), F.round(F.sum("Discount"), 2).alias("total_discount_value"),
        F.round(F.sum("FinalAmount"), 2).alias("revenue_from_coupon_orders"))
    return t["promotions"].select("CampaignName", "CouponCode").join(used, "CouponCode")


def h4_partner_top_decile(t) -> DataFrame:
    p = t["delivery_partners"].select("DeliveryPartnerID", "Name", "City", "Rating", "CompletedDeliveries")
    order = [F.desc("CompletedDeliveries"), F.desc("Rating"), F.asc("DeliveryPartnerID")]
    numbered = row_numbers(sort_blocks(p, [], order), [])
    first_tile = p.select(F.ceil(F.count(F.lit(1)) / 10)).scalar()
    return numbered.filter(F.col("rn") <= first_tile).select(*p.columns, F.lit(1).alias("decile"))


# --------------------------------------------------------------- I: refresh
def city_kpis(t) -> DataFrame:
    return _orders_by_restaurant(t, "City").groupBy("City").agg(
        F.count("OrderID").alias("TotalOrders"), F.round(F.sum("FinalAmount"), 2).alias("TotalRevenue"),
        F.round(F.avg("DeliveryTimeMinutes"), 2).alias("AvgDeliveryTime"))


def i1_city_kpi_refresh(t, path: str | None = None) -> DataFrame:
    """Replace the summary table and return what was stored; without a path, a table of this run's own."""
    new = city_kpis(t).withColumn("LastRefreshed", F.current_timestamp())
    spark = new.sparkSession
    if path is None:
        path = new_folder(spark)
        delete_at_end(spark, path)
    new.write.mode("overwrite").parquet(path)
    return spark.read.schema(new.schema).parquet(path)


# -------------------------------------------------------------- load audit
def audit_orphans(t, orders: DataFrame) -> DataFrame:
    def missing(label, child, key, parent):
        n = child.join(parent.select(key), key, "left_anti").agg(F.count(F.lit(1)).alias("n"))
        return n.select(F.lit(label).alias("check_name"), "n")

    parts = [
        missing("orders without customer", orders, "CustomerID", t["customers"]),
        missing("orders without restaurant", orders, "RestaurantID", t["restaurants"]),
        missing("payments without order", t["payments"], "OrderID", orders),
        orders.agg(F.count(F.lit(1)).alias("n")).select(F.lit("rows in orders").alias("check_name"), "n"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
