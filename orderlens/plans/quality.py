"""Integrity checks on a table set: rules are data, one aggregate per table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.operators.cleaning import mark_known

PRIMARY_KEYS = {
    "cities": "CityID", "customers": "CustomerID", "restaurants": "RestaurantID", "menu": "FoodItemID",
    "delivery_partners": "DeliveryPartnerID", "promotions": "PromotionID", "orders": "OrderID",
    "order_items": "OrderItemID", "payments": "PaymentID", "customer_feedback": "FeedbackID",
    "weather": "WeatherID", "traffic": "TrafficID",
}
FOREIGN_KEYS = (
    ("customers", "City", "cities", "City"), ("restaurants", "City", "cities", "City"),
    ("delivery_partners", "City", "cities", "City"), ("weather", "City", "cities", "City"),
    ("traffic", "City", "cities", "City"), ("menu", "RestaurantID", "restaurants", "RestaurantID"),
    ("orders", "CustomerID", "customers", "CustomerID"), ("orders", "RestaurantID", "restaurants", "RestaurantID"),
    ("orders", "DeliveryPartnerID", "delivery_partners", "DeliveryPartnerID"),
    ("order_items", "OrderID", "orders", "OrderID"), ("order_items", "FoodItemID", "menu", "FoodItemID"),
    ("payments", "OrderID", "orders", "OrderID"), ("customer_feedback", "OrderID", "orders", "OrderID"),
)
# (table, name, condition every row must meet; NULL counts as a failure)
RANGES = (
    ("orders", "orders FoodCost not negative", "FoodCost >= 0"),
    ("orders", "orders FinalAmount present", "FinalAmount IS NOT NULL"),
    ("orders", "orders DeliveryTimeMinutes 0 to 180", "DeliveryTimeMinutes IS NULL OR DeliveryTimeMinutes BETWEEN 0 AND 180"),
    ("restaurants", "restaurants Rating 1 to 5", "Rating BETWEEN 1 AND 5"),
    ("customers", "customers Age 10 to 100", "Age BETWEEN 10 AND 100"),
    ("promotions", "promotions EndDate not before StartDate", "EndDate >= StartDate"),
)
# the declared constraints; here a NULL passes a range rule, as in SQL
# The constraints of the relational schema.
CONSTRAINTS = (
    ("cities", "City IS NOT NULL"), ("cities", "Population > 0"), ("customers", "Name IS NOT NULL"),
    ("customers", "City IS NOT NULL"), ("customers", "RegistrationDate IS NOT NULL"),
    ("customers", "Age BETWEEN 0 AND 100"), ("customers", "TotalOrders >= 0"), ("restaurants", "RestaurantName IS NOT NULL"),
    ("restaurants", "City IS NOT NULL"), ("restaurants", "Rating BETWEEN 1.0 AND 5.0"), ("restaurants", "AverageCost >= 0"),
    ("menu", "RestaurantID IS NOT NULL"), ("menu", "FoodName IS NOT NULL"), ("menu", "Price >= 0"), ("menu", "PreparationTime >= 0"),
    ("delivery_partners", "Name IS NOT NULL"), ("delivery_partners", "Age BETWEEN 16 AND 70"), ("delivery_partners", "City IS NOT NULL"),
    ("delivery_partners", "Rating BETWEEN 1.0 AND 5.0"), ("delivery_partners", "CompletedDeliveries >= 0"),
    ("delivery_partners", "AverageDeliveryTime >= 0"), ("promotions", "CouponCode IS NOT NULL"),
    ("promotions", "DiscountPercentage BETWEEN 0 AND 100"), ("promotions", "StartDate IS NOT NULL"),
    ("promotions", "EndDate IS NOT NULL"), ("promotions", "EndDate >= StartDate"), ("orders", "CustomerID IS NOT NULL"),
    ("orders", "RestaurantID IS NOT NULL"), ("orders", "DeliveryPartnerID IS NOT NULL"), ("orders", "OrderDate IS NOT NULL"),
    ("orders", "OrderTime IS NOT NULL"), ("orders", "OrderStatus IS NOT NULL"), ("orders", "DeliveryTimeMinutes >= 0"),
    ("orders", "FoodCost >= 0"), ("orders", "DeliveryFee >= 0"), ("orders", "Discount >= 0"), ("orders", "GST >= 0"),
    ("orders", "FinalAmount >= 0"), ("order_items", "OrderID IS NOT NULL"), ("order_items", "FoodItemID IS NOT NULL"),
    ("order_items", "Quantity > 0"), ("order_items", "UnitPrice >= 0"), ("order_items", "TotalPrice >= 0"),
    ("payments", "OrderID IS NOT NULL"), ("customer_feedback", "OrderID IS NOT NULL"),
    ("customer_feedback", "CustomerRating BETWEEN 1 AND 5"), ("customer_feedback", "DeliveryRating BETWEEN 1 AND 5"),
    ("customer_feedback", "FoodRating BETWEEN 1 AND 5"), ("weather", "City IS NOT NULL"), ("weather", "Date IS NOT NULL"),
    ("traffic", "City IS NOT NULL"), ("traffic", "Date IS NOT NULL"), ("traffic", "Time IS NOT NULL"),
)
UNIQUE = (("cities", "City"), ("promotions", "CouponCode"))


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def _explode(df: DataFrame, entries: list) -> DataFrame:
    """One aggregate, one output row per entry."""
    return df.agg(F.array(*entries).alias("e")).select(F.explode("e").alias("e")).select("e.*")


def _check(name: str, passed) -> Column:
    return F.struct(F.lit(name).alias("check_name"), passed.alias("passed"))


def _key_unique(t, table: str) -> DataFrame:
    """Keys are counted on their own, so that nothing but a key and its count is exchanged. A NULL key fails."""
    key = PRIMARY_KEYS[table]
    per = t[table].groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return _explode(per, [_check(f"{table}.{key} unique", (F.coalesce(F.max("_n"), F.lit(0)) <= 1) & (F.count_if(F.col(key).isNull()) == 0))])


def _range_entries(table: str) -> list[Column]:
    return [_check(n, F.count_if(~F.coalesce(F.expr(cond), F.lit(False))) == 0) for tab, n, cond in RANGES if tab == table]


def pk_unique(t) -> DataFrame:
    return _union([_key_unique(t, tab) for tab in PRIMARY_KEYS])


def fk_resolve(t) -> DataFrame:
    """All references of a child table in one pass over it."""
    children: dict[str, list] = {}
    for child, *ref in FOREIGN_KEYS:
        children.setdefault(child, []).append(ref)
    parts = []
    for child, refs in children.items():
        df, entries = t[child].select(*[col for col, _, _ in refs]), []
        for i, (col, parent, pcol) in enumerate(refs):
            df = mark_known(df, col, t[parent], f"_ok{i}", pcol)
            lost = F.count_if(F.col(col).isNotNull() & ~F.col(f"_ok{i}"))
            entries.append(_check(f"{child}.{col} in {parent}.{pcol}", lost == 0))
        parts.append(_explode(df, entries))
    return _union(parts)


def ranges_hold(t) -> DataFrame:
    return _union([_explode(t[tab], _range_entries(tab)) for tab in dict.fromkeys(r[0] for r in RANGES)])


def validation_report(t) -> DataFrame:
    """Keys in an exchange of their own, ranges in an aggregate without rows to exchange, references one pass per child."""
    return _union([pk_unique(t), ranges_hold(t), fk_resolve(t)])


def ddl_constraints(t) -> DataFrame:
    def entry(table, rule):
        bad = F.coalesce(~F.expr(rule), F.lit(False))
        return F.struct(F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), F.count_if(bad).alias("violations"))

    tables = dict.fromkeys(r[0] for r in CONSTRAINTS)
    rows = _union([_explode(t[tab], [entry(tab, rule) for x, rule in CONSTRAINTS if x == tab]) for tab in tables])
    uniques = [
        t[tab].groupBy(col).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").agg(
            F.lit(tab).alias("table_name"), F.lit(f"{col} UNIQUE").alias("rule"), F.count(F.lit(1)).alias("violations"))
        for tab, col in UNIQUE
    ]
    return _union([rows, *uniques])
