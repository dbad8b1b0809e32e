"""The twelve marketplace tables, read from the TPC-H-like Parquet tables.

One SQL text per table serves both Spark and the checking engine, so the checks
compare the operators and not two readings of the data. ``t_`` tables are typed
and consistent; ``r_`` tables are their all-text, dirty counterparts: every kind
of defect is placed by key arithmetic. Column names follow the data model.
"""

from __future__ import annotations

import re
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderlens.session import DENSE, input_version, materialise

PHYSICAL = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


class SparkDialect:
    def day(self, base, n):
        return f"date_add(DATE '{base}', CAST({n} AS INT))"

    def plus(self, d, n):
        return f"date_add({d}, CAST({n} AS INT))"

    def diff(self, a, b):
        return f"datediff({a}, {b})"

    def minutes(self, ts):
        return f"(hour({ts}) * 60 + minute({ts}))"

    def hhmm(self, ts):
        return f"date_format({ts}, 'HH:mm')"

    def text(self, d, kind):
        patterns = ("yyyy-MM-dd", "yyyy.MM.dd", "dd-MM-yyyy", "d MMM yyyy", "dd/MM/yyyy", "MM/dd/yyyy")
        return f"date_format({d}, '{patterns[kind]}')"

    def copies(self, n):
        return f"LATERAL VIEW explode(sequence(0, {n - 1})) x AS k"


class DuckDialect(SparkDialect):
    def day(self, base, n):
        return f"(DATE '{base}' + CAST({n} AS INTEGER))"

    def plus(self, d, n):
        return f"({d} + CAST({n} AS INTEGER))"

    def diff(self, a, b):
        return f"date_diff('day', {b}, {a})"

    def hhmm(self, ts):
        return f"strftime({ts}, '%H:%M')"

    def text(self, d, kind):
        patterns = ("%Y-%m-%d", "%Y.%m.%d", "%d-%m-%Y", "%-d %b %Y", "%d/%m/%Y", "%m/%d/%Y")
        return f"strftime({d}, '{patterns[kind]}')"

    def copies(self, n):
        return f"CROSS JOIN unnest(generate_series(0, {n - 1})) x(k)"


def _mixed_date(q, d, key):
    arms = " ".join(f"WHEN {k} THEN {q.text(d, k)}" for k in range(6))
    return f"CASE {key} % 6 {arms} END"


def _money(x):
    return f"CAST(CAST({x} AS DECIMAL(18,2)) AS STRING)"


def _flip(x, key, every):
    """Text of a number with its sign turned on every n-th key."""
    return f"CASE WHEN ({key}) % {every} = 0 THEN {_money(f'-({x})')} ELSE {_money(x)} END"


def _blank(x, key, every):
    return f"CASE WHEN ({key}) % {every} = 0 THEN NULL ELSE {x} END"


def _messy(x, key):
    """Text with extra blanks around and inside."""
    return f"CASE WHEN {key} % 5 = 0 THEN '  ' || replace({x}, ' ', '   ') || ' ' ELSE {x} END"


def _city_text(x, key):
    return (
        f"CASE {key} % 11 WHEN 0 THEN lower({x}) WHEN 1 THEN '  ' || {x} WHEN 2 THEN {x} || ' '"
        f" WHEN 3 THEN NULL ELSE {x} END"
    )


@lru_cache(maxsize=None)
def definitions(dialect: str) -> dict[str, str]:
    q = SparkDialect() if dialect == "spark" else DuckDialect()
    nsup = "(SELECT count(*) FROM {supplier})"
    # every alias of a physical table is unlike the names of its columns
    out: dict[str, str] = {}
    out["t_cities"] = """
        SELECT r_regionkey AS CityID, r_name AS City, 1000000 + r_regionkey * 250000 AS Population,
               CASE WHEN r_regionkey % 2 = 0 THEN 'North' ELSE 'South' END AS Region,
               CAST(100000 + r_regionkey * 5000 AS DOUBLE) AS AverageIncome
        FROM {region}"""
    out["t_nations"] = """
        SELECT n.n_nationkey, n.n_name, r.r_name FROM {nation} n JOIN {region} r ON r.r_regionkey = n.n_regionkey"""
    out["t_customers"] = f"""
        SELECT c.c_custkey AS CustomerID, c.c_name AS Name, CAST(c.c_custkey % 60 + 18 AS INT) AS Age,
               CASE c.c_custkey % 3 WHEN 0 THEN 'Female' WHEN 1 THEN 'Male' ELSE 'Other' END AS Gender,
               CAST(9000000000 + c.c_custkey AS STRING) AS Phone, lower(c.c_name) || '@example.com' AS Email,
               n.r_name AS City, n.n_name AS State, CAST(400000 + c.c_custkey % 100000 AS STRING) AS Pincode,
               {q.day('1994-07-01', 'c.c_custkey % 365')} AS RegistrationDate, c.c_mktsegment AS Membership,
               CAST(0 AS INT) AS TotalOrders, 'C' || CAST(c.c_custkey % 12 AS STRING) AS PreferredCuisine
        FROM {{customer}} c JOIN t_nations n ON n.n_nationkey = c.c_nationkey"""
    out["t_restaurants"] = """
        SELECT s.s_suppkey AS RestaurantID, s.s_name AS RestaurantName, 'C' || CAST(s.s_suppkey % 12 AS STRING) AS Cuisine,
               n.r_name AS City, 'A' || CAST(s.s_suppkey % 20 AS STRING) AS Area, '10:00' AS OpeningTime, '23:00' AS ClosingTime,
               1 + (s.s_suppkey * 7 % 41) / CAST(10 AS DOUBLE) AS Rating, abs(s.s_acctbal) AS AverageCost,
               'Owner ' || CAST(s.s_suppkey AS STRING) AS OwnerName,
               CASE s.s_suppkey % 3 WHEN 0 THEN 'Cloud Kitchen' WHEN 1 THEN 'Dine-in' ELSE 'Cafe' END AS RestaurantType,
               10 + (s.s_suppkey * 37 % 1000) / CAST(50 AS DOUBLE) AS Latitude,
               70 + (s.s_suppkey * 53 % 1000) / CAST(50 AS DOUBLE) AS Longitude
        FROM {supplier} s JOIN t_nations n ON n.n_nationkey = s.s_nationkey"""
    out["t_delivery_partners"] = f"""
        SELECT s.s_suppkey AS DeliveryPartnerID, 'Partner ' || CAST(s.s_suppkey AS STRING) AS Name,
               CAST(18 + s.s_suppkey % 40 AS INT) AS Age,
               CASE s.s_suppkey % 2 WHEN 0 THEN 'Female' ELSE 'Male' END AS Gender,
               CASE s.s_suppkey % 3 WHEN 0 THEN 'Bike' WHEN 1 THEN 'Scooter' ELSE 'Car' END AS VehicleType,
               {q.day('1994-06-01', 's.s_suppkey % 300')} AS JoiningDate, n.r_name AS City,
               1 + (s.s_suppkey * 11 % 41) / CAST(10 AS DOUBLE) AS Rating,
               CAST(s.s_suppkey * 29 % 500 AS INT) AS CompletedDeliveries,
               CAST(15 + s.s_suppkey * 13 % 60 AS DOUBLE) AS AverageDeliveryTime
        FROM {{supplier}} s JOIN t_nations n ON n.n_nationkey = s.s_nationkey"""
    out["t_menu"] = f"""
        SELECT p_partkey AS FoodItemID, p_partkey % {nsup} AS RestaurantID, p_name AS FoodName, p_type AS Category,
               p_retailprice AS Price, CAST(5 + p_partkey % 40 AS INT) AS PreparationTime,
               CAST(100 + p_partkey % 900 AS INT) AS Calories,
               CASE WHEN p_partkey % 10 = 0 THEN 'No' ELSE 'Yes' END AS Availability
        FROM {{part}}"""
    out["t_promotions"] = f"""
        SELECT DISTINCT CAST(substr(o_orderpriority, 1, 1) AS INT) AS PromotionID, upper(o_orderpriority) AS CouponCode,
               CAST(substr(o_orderpriority, 1, 1) AS INT) * 5 AS DiscountPercentage,
               'Campaign ' || substr(o_orderpriority, 3) AS CampaignName,
               {q.day('1995-01-01', "CAST(substr(o_orderpriority, 1, 1) AS INT) * 30")} AS StartDate,
               {q.day('1995-01-01', "CAST(substr(o_orderpriority, 1, 1) AS INT) * 30 + 60")} AS EndDate
        FROM {{orders}}"""
    out["t_lines"] = """
        SELECT l_orderkey, min(l_suppkey) AS first_supp, min(CAST(l_shipdate AS DATE)) AS first_ship
        FROM {lineitem} GROUP BY l_orderkey"""
    # orders as they come, including those without a restaurant
    out["t_orders_all"] = f"""
        SELECT o.OrderID, o.CustomerID, l.first_supp AS RestaurantID, o.DeliveryPartnerID, o.OrderDate, o.OrderTime,
               {q.diff('l.first_ship', 'o.OrderDate')} % 200 AS RawMinutes,
               o.FinalAmount - o.DeliveryFee + o.Discount - o.GST AS FoodCost, o.DeliveryFee, o.Discount, o.CouponCode,
               o.GST, o.FinalAmount, o.OrderStatus, o.PaymentMethod
        FROM (SELECT o_orderkey AS OrderID, o_custkey AS CustomerID, (o_orderkey * 7 + 3) % {nsup} AS DeliveryPartnerID,
                     CAST(o_orderdate AS DATE) AS OrderDate,
                     lpad(CAST(o_orderkey % 24 AS STRING), 2, '0') || ':' || lpad(CAST(o_orderkey % 60 AS STRING), 2, '0') || ':00' AS OrderTime,
                     CAST(20 + o_orderkey % 30 AS DOUBLE) AS DeliveryFee,
                     CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey % 7 * 5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS Discount,
                     CASE WHEN o_orderkey % 3 = 0 THEN upper(o_orderpriority) END AS CouponCode,
                     CAST(10 + o_orderkey % 10 AS DOUBLE) AS GST, o_totalprice AS FinalAmount,
                     CASE WHEN o_orderstatus = 'F' THEN 'Delivered' WHEN o_orderstatus = 'O' THEN 'Delivered Late'
                          WHEN o_orderkey % 3 = 0 THEN 'Food Not Delivered' ELSE 'Cancelled' END AS OrderStatus,
                     CASE o_orderkey % 4 WHEN 0 THEN 'Cash' WHEN 1 THEN 'Card' WHEN 2 THEN 'UPI' ELSE 'Wallet' END AS PaymentMethod
              FROM {{orders}}) o
        LEFT JOIN t_lines l ON l.l_orderkey = o.OrderID"""
    out["t_orders"] = """
        SELECT OrderID, CustomerID, RestaurantID, DeliveryPartnerID, OrderDate, OrderTime,
               CAST(CASE WHEN abs(RawMinutes) BETWEEN 1 AND 180 THEN abs(RawMinutes) END AS INT) AS DeliveryTimeMinutes,
               FoodCost, DeliveryFee, Discount, CouponCode, GST, FinalAmount, OrderStatus, PaymentMethod
        FROM t_orders_all WHERE RestaurantID IS NOT NULL"""
    # line numbers repeat within an order, so all columns together number its lines; an order has a few lines
    out["t_items_raw"] = """
        SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_extendedprice, l_returnflag, l_shipdate,
               l_orderkey * 1000 + row_number() OVER (PARTITION BY l_orderkey
                   ORDER BY l_linenumber, l_partkey, l_quantity, l_extendedprice, l_returnflag, l_shipdate) AS line_id
        FROM {lineitem}"""
    out["t_order_items"] = """
        SELECT line_id AS OrderItemID, l_orderkey AS OrderID, l_partkey AS FoodItemID,
               CAST(l_quantity AS INT) AS Quantity, l_extendedprice / l_quantity AS UnitPrice,
               l_extendedprice AS TotalPrice
        FROM t_items_raw"""
    out["t_payments_all"] = """
        SELECT line_id AS PaymentID, l_orderkey AS OrderID,
               CASE l_orderkey % 4 WHEN 0 THEN 'Cash' WHEN 1 THEN 'Card' WHEN 2 THEN 'UPI' ELSE 'Wallet' END AS PaymentMethod,
               CASE WHEN l_linenumber = 7 THEN 'Pending' WHEN l_returnflag = 'N' THEN 'Success'
                    WHEN l_returnflag = 'R' THEN 'Refunded' ELSE 'Failed' END AS PaymentStatus,
               'TX' || CAST(line_id AS STRING) AS TransactionID, CAST(l_shipdate AS DATE) AS PaymentDate
        FROM t_items_raw"""
    rank = "CASE PaymentStatus WHEN 'Success' THEN 0 WHEN 'Refunded' THEN 1 WHEN 'Pending' THEN 2 ELSE 3 END"
    out["t_payments"] = f"""
        SELECT p.PaymentID, p.OrderID, p.PaymentMethod, p.PaymentStatus, p.TransactionID, p.PaymentDate
        FROM t_payments_all p
        JOIN (SELECT OrderID AS k_order, min({rank} * 1000 + 999 - PaymentID % 1000) AS k_best FROM t_payments_all GROUP BY OrderID) k
          ON k.k_order = p.OrderID AND k.k_best = {rank} * 1000 + 999 - p.PaymentID % 1000"""
    out["t_customer_feedback"] = """
        SELECT OrderID AS FeedbackID, OrderID, CAST(1 + OrderID % 5 AS INT) AS CustomerRating,
               CAST(1 + OrderID * 3 % 5 AS INT) AS DeliveryRating, CAST(1 + OrderID * 7 % 4 AS INT) AS FoodRating,
               'Review ' || CAST(OrderID % 50 AS STRING) AS Review,
               CASE WHEN OrderID % 5 >= 3 THEN 'Positive' WHEN OrderID % 5 = 2 THEN 'Neutral' ELSE 'Negative' END AS Sentiment
        FROM t_orders WHERE OrderID % 4 <> 0"""
    out["t_weather"] = f"""
        SELECT e.event_id AS WeatherID, r.r_name AS City, {q.day('1995-01-01', 'e.event_id * 7 % 2405')} AS Date,
               CAST(15 + e.event_id % 20 AS DOUBLE) AS Temperature, e.value / 5 AS Rainfall, CAST(e.event_id % 100 AS INT) AS Humidity,
               CASE e.event_type WHEN 'view' THEN 'Clear' WHEN 'click' THEN 'Cloudy' WHEN 'signup' THEN 'Foggy'
                    WHEN 'purchase' THEN 'Rainy' ELSE 'Stormy' END AS WeatherCondition
        FROM {{events}} e JOIN {{region}} r ON r.r_regionkey = e.user_id % 5"""
    out["t_traffic"] = f"""
        SELECT e.event_id AS TrafficID, r.r_name AS City, {q.day('1995-01-01', 'e.event_id * 7 % 2405')} AS Date,
               {q.hhmm('e.ts')} AS Time,
               CASE e.event_type WHEN 'view' THEN 'Low' WHEN 'click' THEN 'Moderate' WHEN 'purchase' THEN 'High' ELSE 'Severe' END AS TrafficLevel,
               CAST(20 + e.event_id % 40 AS DOUBLE) AS AverageSpeed
        FROM {{events}} e JOIN {{region}} r ON r.r_regionkey = e.user_id % 5"""

    # ------------------------------------------------------------ dirty text
    out["r_cities"] = f"""
        SELECT CityID AS SourceRow, CAST(CityID AS STRING) AS CityID, ' ' || lower(City) || '  ' AS City,
               CAST(Population AS STRING) AS Population, Region, {_blank(_money('AverageIncome'), 'CityID + 1', 3)} AS AverageIncome
        FROM t_cities"""
    out["r_customers"] = f"""
        SELECT CustomerID * 3 + k AS SourceRow, CAST(CustomerID AS STRING) AS CustomerID,
               {_messy('Name', 'CustomerID')} AS Name,
               CASE WHEN CustomerID % 17 = 0 THEN '-' || CAST(Age AS STRING) WHEN CustomerID % 31 = 0 THEN '140'
                    WHEN CustomerID % 23 = 0 THEN NULL ELSE CAST(Age AS STRING) END AS Age,
               {_blank('Gender', 'CustomerID', 13)} AS Gender,
               CASE WHEN CustomerID % 19 = 0 THEN 'abc' WHEN CustomerID % 7 = 0 THEN Phone || '.0' ELSE Phone END AS Phone,
               {_blank('Email', 'CustomerID', 29)} AS Email, {_city_text('City', 'CustomerID')} AS City, State,
               CASE WHEN CustomerID % 11 = 0 THEN '-' || Pincode WHEN CustomerID % 37 = 0 THEN '1234' ELSE Pincode END AS Pincode,
               {_mixed_date(q, 'RegistrationDate', 'CustomerID')} AS RegistrationDate,
               CASE WHEN CustomerID % 41 = 0 THEN 'nan' ELSE Membership END AS Membership,
               CASE WHEN CustomerID % 43 = 0 THEN '-3' WHEN CustomerID % 47 = 0 THEN NULL ELSE CAST(CustomerID % 9 AS STRING) END AS TotalOrders,
               CASE WHEN k = 2 THEN 'Changed' ELSE PreferredCuisine END AS PreferredCuisine
        FROM t_customers {q.copies(3)}
        WHERE k = 0 OR (k = 1 AND CustomerID % 50 = 0) OR (k = 2 AND CustomerID % 70 = 0)"""
    out["r_restaurants"] = f"""
        SELECT RestaurantID * 2 + k AS SourceRow, CAST(RestaurantID AS STRING) AS RestaurantID,
               {_messy('RestaurantName', 'RestaurantID')} AS RestaurantName, {_blank('Cuisine', 'RestaurantID', 13)} AS Cuisine,
               {_city_text('City', 'RestaurantID')} AS City, Area, OpeningTime, ClosingTime,
               CASE WHEN RestaurantID % 17 = 0 THEN '9.9' WHEN RestaurantID % 7 = 0 THEN NULL ELSE {_money('Rating')} END AS Rating,
               {_flip('AverageCost', 'RestaurantID', 11)} AS AverageCost, OwnerName, RestaurantType,
               {_money('Latitude')} AS Latitude, {_money('Longitude')} AS Longitude
        FROM t_restaurants {q.copies(2)} WHERE k = 0 OR RestaurantID % 9 = 0"""
    out["r_menu"] = f"""
        SELECT FoodItemID * 2 + k AS SourceRow, CAST(FoodItemID AS STRING) AS FoodItemID,
               CASE WHEN FoodItemID % 40 = 0 THEN '987654321' ELSE CAST(RestaurantID AS STRING) END AS RestaurantID,
               {_messy('FoodName', 'FoodItemID')} AS FoodName, Category, {_flip('Price', 'FoodItemID', 17)} AS Price,
               CAST(PreparationTime AS STRING) AS PreparationTime, {_blank('CAST(Calories AS STRING)', 'FoodItemID', 23)} AS Calories, Availability
        FROM t_menu {q.copies(2)} WHERE k = 0 OR FoodItemID % 60 = 0"""
    out["r_delivery_partners"] = f"""
        SELECT DeliveryPartnerID AS SourceRow, CAST(DeliveryPartnerID AS STRING) AS DeliveryPartnerID,
               {_messy('Name', 'DeliveryPartnerID')} AS Name, CAST(Age AS STRING) AS Age, Gender, VehicleType,
               {_mixed_date(q, 'JoiningDate', 'DeliveryPartnerID')} AS JoiningDate, {_city_text('City', 'DeliveryPartnerID')} AS City,
               {_blank(_money('Rating'), 'DeliveryPartnerID', 7)} AS Rating, CAST(CompletedDeliveries AS STRING) AS CompletedDeliveries,
               CASE WHEN DeliveryPartnerID % 29 = 0 THEN '900.00' WHEN DeliveryPartnerID % 17 = 0 THEN {_money('-AverageDeliveryTime')}
                    ELSE {_money('AverageDeliveryTime')} END AS AverageDeliveryTime
        FROM t_delivery_partners"""
    out["r_promotions"] = f"""
        SELECT PromotionID * 2 + k AS SourceRow, CAST(PromotionID + k * 100 AS STRING) AS PromotionID,
               CASE WHEN PromotionID % 2 = 0 THEN ' ' || lower(CouponCode) ELSE CouponCode END AS CouponCode,
               CAST(DiscountPercentage AS STRING) AS DiscountPercentage, {_messy('CampaignName', 'PromotionID')} AS CampaignName,
               CASE WHEN PromotionID % 3 = 0 THEN {q.text('EndDate', 1)} ELSE {q.text('StartDate', 0)} END AS StartDate,
               CASE WHEN PromotionID % 3 = 0 THEN {q.text('StartDate', 2)} ELSE {q.text('EndDate', 2)} END AS EndDate
        FROM t_promotions {q.copies(2)} WHERE k = 0 OR PromotionID = 4"""
    out["r_orders"] = f"""
        SELECT OrderID * 3 + k AS SourceRow, CAST(OrderID AS STRING) AS OrderID, CAST(CustomerID AS STRING) AS CustomerID,
               coalesce(CAST(RestaurantID AS STRING), '987654321') AS RestaurantID, CAST(DeliveryPartnerID AS STRING) AS DeliveryPartnerID,
               {_mixed_date(q, 'OrderDate', 'OrderID')} AS OrderDate, OrderTime || '.000' AS OrderTime,
               CAST(RawMinutes AS STRING) AS DeliveryTimeMinutes, {_flip('FoodCost', 'OrderID', 17)} AS FoodCost,
               {_flip('DeliveryFee', 'OrderID', 19)} AS DeliveryFee, {_money('Discount')} AS Discount,
               CASE WHEN OrderID % 39 = 0 THEN 'NOPE' WHEN OrderID % 6 = 0 THEN ' ' || lower(CouponCode) ELSE CouponCode END AS CouponCode,
               {_money('GST')} AS GST, {_blank(_money('FinalAmount'), 'OrderID', 23)} AS FinalAmount,
               CASE WHEN k = 2 THEN 'Cancelled' ELSE {_messy('OrderStatus', 'OrderID')} END AS OrderStatus, PaymentMethod
        FROM t_orders_all {q.copies(3)}
        WHERE k = 0 OR (k = 1 AND OrderID % 50 = 0) OR (k = 2 AND OrderID % 70 = 0)"""
    out["r_order_items"] = f"""
        SELECT OrderItemID * 2 + k AS SourceRow, CAST(OrderItemID AS STRING) AS OrderItemID, CAST(OrderID AS STRING) AS OrderID,
               CASE WHEN OrderItemID % 90 = 1 THEN '987654321' ELSE CAST(FoodItemID AS STRING) END AS FoodItemID,
               CASE WHEN OrderItemID % 17 = 0 THEN CAST(-Quantity AS STRING) ELSE CAST(Quantity AS STRING) END AS Quantity,
               CAST(CAST(UnitPrice AS DECIMAL(18,9)) AS STRING) AS UnitPrice, {_blank(_money('TotalPrice'), 'OrderItemID', 23)} AS TotalPrice
        FROM t_order_items {q.copies(2)} WHERE k = 0 OR OrderItemID % 80 = 0"""
    out["r_payments"] = f"""
        SELECT PaymentID * 2 + k AS SourceRow, CAST(PaymentID AS STRING) AS PaymentID, CAST(OrderID AS STRING) AS OrderID, PaymentMethod,
               {_messy('PaymentStatus', 'PaymentID')} AS PaymentStatus, {_blank('TransactionID', 'PaymentID', 23)} AS TransactionID,
               {_mixed_date(q, 'PaymentDate', 'PaymentID')} AS PaymentDate
        FROM t_payments_all {q.copies(2)} WHERE k = 0 OR PaymentID % 80 = 0"""
    out["r_customer_feedback"] = f"""
        SELECT FeedbackID * 2 + k AS SourceRow, CAST(FeedbackID + k * 1000000000 AS STRING) AS FeedbackID, CAST(OrderID AS STRING) AS OrderID,
               CASE WHEN OrderID % 13 = 0 THEN NULL WHEN OrderID % 17 = 0 THEN '6' ELSE CAST(CustomerRating AS STRING) END AS CustomerRating,
               CASE WHEN OrderID % 26 = 0 THEN NULL ELSE CAST(DeliveryRating AS STRING) END AS DeliveryRating,
               CASE WHEN OrderID % 39 = 0 THEN NULL ELSE CAST(FoodRating AS STRING) END AS FoodRating,
               CASE WHEN OrderID % 9 = 0 THEN '  ' ELSE Review END AS Review, Sentiment
        FROM t_customer_feedback {q.copies(2)} WHERE k = 0 OR FeedbackID % 80 = 1"""
    out["r_weather"] = f"""
        SELECT WeatherID AS SourceRow, CAST(WeatherID AS STRING) AS WeatherID, {_city_text('City', 'WeatherID')} AS City,
               {_mixed_date(q, 'Date', 'WeatherID')} AS Date, CASE WHEN WeatherID % 211 = 0 THEN '95.00' ELSE {_money('Temperature')} END AS Temperature,
               {_blank(_money('Rainfall'), 'WeatherID', 23)} AS Rainfall,
               CASE WHEN WeatherID % 17 = 0 THEN CAST(-Humidity AS STRING) ELSE CAST(Humidity + 5 AS STRING) END AS Humidity,
               {_messy('WeatherCondition', 'WeatherID')} AS WeatherCondition
        FROM t_weather"""
    out["r_traffic"] = f"""
        SELECT TrafficID AS SourceRow, CAST(TrafficID AS STRING) AS TrafficID, {_city_text('City', 'TrafficID')} AS City,
               {_mixed_date(q, 'Date', 'TrafficID')} AS Date, Time || ':30' AS Time,
               {_blank('TrafficLevel', 'TrafficID', 23)} AS TrafficLevel,
               CASE WHEN TrafficID % 211 = 0 THEN '300.00' ELSE {_flip('AverageSpeed', 'TrafficID', 17)} END AS AverageSpeed
        FROM t_traffic"""
    return out


def _needed(defs: dict[str, str], text: str) -> list[str]:
    """Names the text refers to, directly or not, in the order they must be declared."""
    wanted: set[str] = set()
    stack = [text]
    while stack:
        for name in re.findall(r"\b[trc]_[a-z_0-9]+\b", stack.pop()):
            if name in defs and name not in wanted:
                wanted.add(name)
                stack.append(defs[name])
    return [n for n in defs if n in wanted]


def with_tables(text: str, dialect: str, physical: dict[str, str], extra: dict[str, str] | None = None) -> str:
    """``text`` with the tables it names put before it as common table expressions."""
    base, extra = definitions(dialect), extra or {}
    names = _needed({**base, **extra}, text)
    parts = [f"{n} AS ({extra[n] if n in extra else base[n].format(**physical)})" for n in names]
    head = "WITH " + ",\n".join(parts) + "\n" if parts else ""
    return head + text


#: of a payment, best first
STATUSES = ("Success", "Refunded", "Pending", "Failed")


def _status_rank() -> Column:
    s = F.col("PaymentStatus")
    return F.when(s == STATUSES[0], 0).when(s == STATUSES[1], 1).when(s == STATUSES[2], 2).otherwise(3)


def best_payments(payments: DataFrame) -> DataFrame:
    """The rows that the SQL of ``t_payments`` finds by a join with each order's best: here the best is found beside the
    rows, which the numbering of an order's lines has brought together already."""
    ranked = payments.where("OrderID is not null").withColumn("_k", _status_rank() * 1000 + 999 - F.col("PaymentID") % 1000)
    return ranked.withColumn("_best", F.min("_k").over(Window.partitionBy("OrderID"))).where("_k = _best").drop("_k", "_best")


#: payments of one order whose numbers, taken by 1000, are all unlike
MOST_PAYMENTS = 1000


def payment_states(payments: DataFrame) -> DataFrame:
    """(OrderID, PaymentStatus, _payments) from statuses alone, by an aggregate that is combined before the exchange: the best
    status of an order, and how many payments it has. Up to MOST_PAYMENTS, one row of an order is the best; it has this status."""
    best = payments.where("OrderID is not null").groupBy("OrderID").agg(
        F.min(_status_rank()).alias("_k"), F.count(F.lit(1)).alias("_payments"))
    return best.select("OrderID", F.element_at(F.array(*[F.lit(x) for x in STATUSES]), F.col("_k") + 1).alias("PaymentStatus"), "_payments")


def late_orders(physical: dict[str, str]) -> str:
    """The text of ``t_orders_all`` with the columns computed behind its join: what they are computed from is narrower to move."""
    text = definitions("spark")["t_orders_all"]
    for here, there in (
        ("LEFT JOIN t_lines l ON l.l_orderkey = o.OrderID", ""), ("l.first_", "o.first_"), ("(SELECT o_orderkey", "(SELECT first_supp, first_ship, o_orderkey"),
        ("FROM {orders}) o", "FROM {orders} LEFT JOIN t_lines ON l_orderkey = o_orderkey) o"),
    ):
        text = text.replace(here, there)
    return text.format(**physical)


LINES, NUMBERED = "t_items_raw", ("t_order_items", "r_order_items", "r_payments")
_layer: dict[tuple[str, ...], DataFrame] = {}


class SampleTables:
    """DataFrames by table name, built on first use. Each is written once per
    application, as a raw or clean layer of files would be, and read from there."""

    def __init__(self, spark: SparkSession, sf_dir: str, prefix: str = "t_"):
        self.spark, self.prefix = spark, prefix
        self.sf_dir, self.version = sf_dir, input_version(spark, sf_dir)
        self.physical = {n: f"parquet.`{sf_dir}/{n}.parquet`" for n in PHYSICAL}

    def build(self, name: str) -> DataFrame:
        if self.prefix + name == "t_payments":
            return best_payments(self.build("payments_all"))
        return self.spark.sql(with_tables(f"SELECT * FROM {self.prefix}{name}", "spark", self.physical, self._stored_orders(name)))

    def _stored_orders(self, name: str) -> dict[str, str]:
        """Stored orders are read where a table is made of them, not put together again; where they are, little of them is moved."""
        orders = _layer.get((*self._key(name)[:3], "t_orders"))
        late = {"t_orders_all": late_orders(self.physical)}
        if name == "customers":  # by the product of their bytes nations and regions are large, and the customers would be sent to them
            late["t_nations"] = f"SELECT * FROM parquet.`{clean_tables(self.spark, self.sf_dir)['nations'].stored_at}`"
        if (lines := _layer.get((*self._key(name)[:3], LINES))) is not None and name != "payments_all":
            late[LINES] = f"SELECT * FROM parquet.`{lines.stored_at}`"
        return late if orders is None or self.prefix + name == "t_orders" else late | {"t_orders": f"SELECT * FROM parquet.`{orders.stored_at}`"}

    def payment_states(self) -> DataFrame:
        return payment_states(self.build("payments_all"))

    def view(self, name: str) -> DataFrame:
        """The stored table, or what it would be stored from: for a plan that reads it once."""
        return _layer[self._key(name)] if self._key(name) in _layer else self.build(name)

    def _key(self, name: str) -> tuple[str, ...]:
        return self.spark.sparkContext.applicationId, self.sf_dir, self.version, self.prefix + name

    def _number_lines(self) -> None:
        """Numbered lines are sorted within their order: once for all tables that show the number."""
        key = (*self._key("")[:3], LINES)
        if key not in _layer:
            text = with_tables(f"SELECT * FROM {LINES}", "spark", self.physical)
            _layer[key] = materialise(self.spark.sql(text), codec=DENSE)

    def __getitem__(self, name: str) -> DataFrame:
        key = self._key(name)
        if key not in _layer:
            if key[3] in NUMBERED:
                self._number_lines()
            _layer[key] = materialise(self.build(name), codec=DENSE)
        return _layer[key]


def clean_tables(spark: SparkSession, sf_dir: str) -> SampleTables:
    return SampleTables(spark, sf_dir, "t_")


def raw_tables(spark: SparkSession, sf_dir: str) -> SampleTables:
    return SampleTables(spark, sf_dir, "r_")
