"""Star schema: facts, dimensions, restaurant scorecard and report tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.constants import CLV_EDGES, CLV_LABELS
from orderlens.operators.blocks import row_numbers, sort_blocks
from orderlens.session import materialise

# The columns of the order fact table.
FACT_COLUMNS = (
    "OrderID", "OrderDate", "OrderTime", "hour", "CustomerID", "RestaurantID", "DeliveryPartnerID", "RCity", "CouponCode", "OrderStatus",
    "PaymentMethod", "PaymentStatus", "FoodCost", "DeliveryFee", "Discount", "GST", "FinalAmount", "DeliveryTimeMinutes", "BasketSize",
    "IsDelivered", "IsCancelled", "IsLate", "HasCoupon", "PeakHour", "WeekendOrder", "TrafficScore", "RainImpact", "Rainfall", "Temperature",
    "WeatherCondition", "DeliveryEfficiency", "AvgRating", "CustomerRating", "DeliveryRating", "FoodRating", "Sentiment",
)


def dim_date(base: DataFrame) -> DataFrame:
    """Whole calendar years around the orders."""
    span = base.agg(F.trunc(F.min("OrderDate"), "year").alias("a"), F.date_add(F.add_months(F.trunc(F.max("OrderDate"), "year"), 12), -1).alias("b"))
    d = span.select(F.explode(F.sequence("a", "b")).alias("Date"))
    return d.select(
        "Date", F.year("Date").alias("Year"), F.concat(F.lit("Q"), F.quarter("Date")).alias("Quarter"), F.month("Date").alias("MonthNum"),
        F.date_format("Date", "MMM").alias("MonthName"), F.date_format("Date", "yyyy-MM").alias("YearMonth"),
        F.trunc("Date", "month").alias("MonthStart"), F.date_format("Date", "E").alias("DayOfWeek"),
        (F.weekday("Date") + 1).alias("DayOfWeekNum"), (F.weekday("Date") >= 5).cast("int").alias("IsWeekend"))


def customer_segment(as_of: Column) -> Column:
    since_first, since_last = F.datediff(as_of, F.col("FirstOrderDate")), F.col("DaysSinceLastOrder")
    return (
        F.when(F.col("Orders") == 0, "No orders").when(since_first <= 60, "New").when(since_last <= 60, "Active")
        .when(since_last <= 180, "At-Risk").otherwise("Lapsed")
    )


def customer_type() -> Column:
    return F.when(F.col("Orders") >= 2, "Repeat").when(F.col("Orders") == 1, "One-time").otherwise("No orders")


def clv_band_order(v: Column) -> Column:
    steps = [F.when(v <= CLV_EDGES[0], 1)] + [(e, i + 2) for i, e in enumerate(CLV_EDGES[1:])]
    return reduce(lambda acc, s: acc.when(v <= s[0], s[1]), steps[1:], steps[0]).otherwise(len(CLV_LABELS))


def clv_band(v: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in CLV_LABELS]), clv_band_order(v))


def dim_customer(base: DataFrame, t) -> DataFrame:
    per = base.groupBy("CustomerID").agg(
        F.count("OrderID").alias("Orders"), F.count_if("IsDelivered").alias("CompletedOrders"),
        F.sum(F.when(F.col("IsDelivered"), F.col("FinalAmount")).otherwise(0.0)).alias("CLV"),
        F.min("OrderDate").alias("FirstOrderDate"), F.max("OrderDate").alias("LastOrderDate"))
    as_of = base.select(F.max("OrderDate")).scalar()
    c = t["customers"].withColumnRenamed("City", "CustomerCity").join(per, "CustomerID", "left").fillna(0, ["Orders", "CLV"])
    c = c.withColumn("DaysSinceLastOrder", F.datediff(as_of, "LastOrderDate"))
    return c.withColumns({
        "Segment": customer_segment(as_of), "CustomerType": customer_type(),
        "CLVBand": clv_band(F.col("CLV")), "CLVBandOrder": clv_band_order(F.col("CLV"))})


def scorecard(base: DataFrame, min_orders: int = 5) -> DataFrame:
    done = F.col("IsDelivered")
    g = base.groupBy("RestaurantID", "RestaurantName", "RCity", "Cuisine").agg(
        F.count("OrderID").alias("Orders"), F.sum(F.when(done, F.col("FinalAmount")).otherwise(0.0)).alias("Revenue"),
        F.max("RestaurantRating").alias("Rating"), F.avg("IsCancelled").alias("CancelRate"),
        (F.sum("IsLate") / F.greatest(F.count_if(done), F.lit(1))).alias("LateRate"),
        F.avg("DeliveryTimeMinutes").alias("AvgDeliveryTime")).filter(F.col("Orders") >= min_orders)
    g = materialise(g)

    def z(c: str) -> Column:
        # two scalar subqueries over one aggregate of the scored restaurants
        mean, sd = g.select(F.avg(c)).scalar(), g.select(F.stddev_samp(c)).scalar()
        return F.try_divide(F.col(c) - mean, sd)

    score = F.round(0.4 * z("Rating") - 0.3 * z("CancelRate") - 0.3 * z("LateRate"), 9)
    g = materialise(g.withColumn("CompositeScore", score))
    top = row_numbers(sort_blocks(g, ["RCity"], [F.desc_nulls_last("CompositeScore"), "RestaurantID"]), ["RCity"], "CityRank")
    low = row_numbers(
        sort_blocks(g.select("RestaurantID", "RCity", "CompositeScore"), ["RCity"], [F.asc_nulls_last("CompositeScore"), "RestaurantID"]),
        ["RCity"], "CityRankFromBottom")
    return top.select(*g.columns, "CityRank").join(low.select("RestaurantID", "CityRankFromBottom"), "RestaurantID")


def top_per_city(score: DataFrame, n: int = 10) -> DataFrame:
    return score.filter(F.col("CityRank") <= n)


def bottom_per_city(score: DataFrame, n: int = 10) -> DataFrame:
    return score.filter(F.col("CityRankFromBottom") <= n)


def dim_restaurant(t, score: DataFrame) -> DataFrame:
    return t["restaurants"].join(score.select("RestaurantID", "CompositeScore", "CityRank", "CityRankFromBottom"), "RestaurantID", "left")


def report_list(score: DataFrame, best: bool, min_orders: int = 15, n: int = 10) -> DataFrame:
    order = F.desc("CompositeScore") if best else F.asc("CompositeScore")
    return (
        score.filter(F.col("Orders") >= min_orders).orderBy(order, "RestaurantID").limit(n)
        .select("RestaurantID", F.concat("RestaurantName", F.lit(" ("), "RCity", F.lit(")")).alias("RestaurantLabel"), "RCity", "Cuisine",
                "Orders", "Rating", "CancelRate", "LateRate", "CompositeScore")
    )


def fact_orders(base: DataFrame) -> DataFrame:
    f = base.select(*FACT_COLUMNS).withColumnRenamed("RCity", "City").withColumn("IsDelivered", F.col("IsDelivered").cast("int"))
    return f.withColumn("Revenue", F.when(F.col("IsDelivered") == 1, F.col("FinalAmount")).otherwise(0.0))


class Tables(Mapping):
    """DataFrames by name, each planned when it is first asked for: a report that reads one does not pay for the others."""

    def __init__(self, builds: dict[str, Callable[[], DataFrame]]):
        self._builds, self._built = builds, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builds[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builds)

    def __len__(self) -> int:
        return len(self._builds)


def star_schema(base: DataFrame, t, score: Callable[[], DataFrame]) -> Tables:
    return Tables({
        "dim_date": lambda: dim_date(base), "dim_city": lambda: t["cities"], "dim_customer": lambda: dim_customer(base, t),
        "dim_restaurant": lambda: dim_restaurant(t, score()), "dim_partner": lambda: t["delivery_partners"],
        "dim_promotion": lambda: t["promotions"], "dim_menu": lambda: t["menu"], "fact_orders": lambda: fact_orders(base),
        "fact_order_items": lambda: t["order_items"], "rpt_restaurant_top10": lambda: report_list(score(), True),
        "rpt_restaurant_bottom10": lambda: report_list(score(), False),
    })


def top_features(importance: DataFrame, by: str, n: int = 12) -> DataFrame:
    """The few largest importances, as a report shows them."""
    return importance.orderBy(F.desc(by), "feature").limit(n)


