"""Feature queries over the sample tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderlens.plans import features as ft

READ = ft.READINGS
BASE_ROUND = {c: 6 for c in ("DistanceProxyKm", "DeliveryEfficiency", *READ, "AvgRating", "DiscountPct", "AverageBasketValue", "OrderFrequency", "RestaurantAvgFeedback")}
BASE_ROUND |= {"CustomerLifetimeValue": 2}
CHURN_ROUND = {c: 6 for c in ("AvgOrderValue", "CancelRate", "LateRate", "CouponRate", "AvgDeliveryTime", "AvgRating", "WeekendShare", "AvgGapDays")} | {"Monetary": 2}
FEATURES = ["TrafficScore", "Rainfall", "RainImpact", "PeakHour", "WeekendOrder", "CustomerTenure", "BasketSize", "AvgRating", "PaymentStatus",
            "DeliveryTimeMinutes", "CouponCode", "DistanceProxyKm", "DeliveryEfficiency"]


def rounded(df, cols=BASE_ROUND):
    return df.withColumns({c: F.round(F.col(c), n) for c, n in cols.items() if c in df.columns})


def pick(df, *cols):
    return rounded(df.select(*cols))


def _attach_weather(t):
    w = ft.weather_daily(t).withColumnsRenamed({"City": "RCity", "Date": "OrderDate"})
    o = t["orders"].select("OrderID", "OrderDate", "RestaurantID").join(ft.restaurant_dim(t).select("RestaurantID", "RCity"), "RestaurantID", "left")
    d = o.join(w, ["RCity", "OrderDate"], "left").withColumn("HasWeather", F.col("Rainfall").isNotNull().cast("int"))
    return pick(d, "OrderID", "Rainfall", "Temperature", "Humidity", "WeatherCondition", "HasWeather")


def _placed(t):
    return ft.time_parts(t["orders"]).join(ft.restaurant_dim(t).select("RestaurantID", "RCity"), "RestaurantID", "left")


def _nearest(t):
    d = _placed(t).select("OrderID", "RCity", "OrderDate", "order_min")
    found = ft.nearest_traffic(ft.time_slots(d), t).drop("n_orders")
    return d.join(found, ["RCity", "OrderDate", "order_min"], "left").select(
        "OrderID", "TrafficScore", "AverageSpeed", F.col("TrafficScore").isNotNull().cast("int").alias("HasTraffic"))


def _filled(t):
    d = _placed(t).select("OrderID", "RCity", "OrderDate", "order_min")
    return pick(ft.with_conditions(d, t), "OrderID", *READ, "WeatherCondition", "HasWeather", "HasTraffic")


def _popularity(t):
    d = t["orders"].join(ft.restaurant_dim(t).select("RestaurantID", "RCity"), "RestaurantID", "left")
    return ft.restaurant_popularity(d)


def _rated(t):
    return t["orders"].select("OrderID", "RestaurantID").join(ft.feedback(t), "OrderID", "left")


def _base(t):
    return rounded(ft.order_base_table(t)).drop("Latitude", "Longitude", "Gender")




QUERIES = {
    "haversine_km": lambda t: pick(ft.restaurant_dim(t), "RestaurantID", "DistanceProxyKm"),
    "order_time_parts": lambda t: ft.time_parts(t["orders"]).select("OrderID", "OrderTS", "hour", "order_min", "dow", "month"),
    "order_base_joins": lambda t: ft.with_dimensions(t).select(
        "OrderID", "RestaurantName", "RCity", "RArea", "Cuisine", "RestaurantRating", "CCity", "CustomerAge", "Membership", "VehicleType", "PartnerRating", "PCity"),
    "weather_daily": lambda t: rounded(ft.weather_daily(t)),
    "attach_weather": _attach_weather,
    "attach_nearest_traffic": _nearest,
    "impute_city_median_flagged": _filled,
    "basket_size": lambda t: ft.with_basket(t["orders"].select("OrderID"), t),
    "attach_feedback": lambda t: pick(_rated(t), "OrderID", "AvgRating", "Sentiment"),
    "attach_payment": lambda t: t["orders"].select("OrderID").join(t["payments"].select("OrderID", "PaymentStatus"), "OrderID", "left"),
    "feat_peak_hour": lambda t: ft.time_parts(t["orders"]).select("OrderID", ft.peak_hour().alias("PeakHour")),
    "feat_weekend": lambda t: ft.time_parts(t["orders"]).select("OrderID", (F.col("dow") >= 5).cast("int").alias("WeekendOrder")),
    "feat_rain_impact": lambda t: ft.weather_daily(t).select("City", "Date", ft.rain_impact().alias("RainImpact")),
    "feat_tenure": lambda t: t["orders"].join(ft.customer_dim(t), "CustomerID").select(
        "OrderID", F.datediff("OrderDate", "RegistrationDate").alias("CustomerTenure")),
    "feat_status_flags": lambda t: t["orders"].select("OrderID", *[c.alias(k) for k, c in ft.status_flags().items()]),
    "feat_discount_pct": lambda t: t["orders"].select("OrderID", F.round(ft.discount_pct(), 8).alias("DiscountPct")),
    "feat_customer_aggregates": lambda t: rounded(ft.customer_aggregates(ft.time_parts(t["orders"]))),
    "feat_restaurant_popularity": _popularity,
    "feat_partner_efficiency": lambda t: pick(ft.partner_dim(t), "DeliveryPartnerID", "DeliveryEfficiency"),
    "feat_restaurant_feedback": lambda t: rounded(ft.restaurant_feedback(_rated(t))),
    "feat_distance_proxy": lambda t: pick(t["orders"].select("OrderID", "RestaurantID").join(ft.restaurant_dim(t), "RestaurantID"), "OrderID", "DistanceProxyKm"),
    "order_base_table": _base,
    "city_match_rate": lambda t: ft.city_match_rate(ft.with_dimensions(t)),
}

# these read the stored base table
FROM_BASE = {
    "churn_table": lambda s: rounded(ft.churn_table(s.base, s.t), CHURN_ROUND),
    "churn_gap_days": lambda s: rounded(ft.churn_table(s.base, s.t).select("CustomerID", "AvgGapDays"), CHURN_ROUND),
    "feature_completeness": lambda s: ft.completeness(s.base, FEATURES),
}
