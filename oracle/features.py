"""SQL counterparts of the feature tables."""

from oracle.text import rnd

R = "2 * 6371 * asin(sqrt(pow(sin((radians({2}) - radians({0})) / 2), 2) + cos(radians({0})) * cos(radians({2})) * pow(sin((radians({3}) - radians({1})) / 2), 2)))"
READ = ("Rainfall", "Temperature", "Humidity", "TrafficScore", "AverageSpeed")

TABLES = {
    "c_rdim": f"""SELECT r.RestaurantID, r.RestaurantName, r.City AS RCity, r.Area AS RArea, r.Cuisine, r.Rating AS RestaurantRating, r.AverageCost,
 r.RestaurantType, r.Latitude, r.Longitude, {R.format('r.Latitude', 'r.Longitude', 'k.la', 'k.lo')} AS DistanceProxyKm
 FROM t_restaurants r JOIN (SELECT City, avg(Latitude) AS la, avg(Longitude) AS lo FROM t_restaurants GROUP BY 1) k ON k.City = r.City""",
    "c_pdim": """SELECT DeliveryPartnerID, VehicleType, Rating AS PartnerRating, AverageDeliveryTime, CompletedDeliveries, City AS PCity,
 AverageDeliveryTime / avg(AverageDeliveryTime) OVER (PARTITION BY City) AS DeliveryEfficiency FROM t_delivery_partners""",
    "c_dims": """SELECT o.*, CAST(CAST(o.OrderDate AS VARCHAR) || ' ' || o.OrderTime AS TIMESTAMP) AS OrderTS,
 CAST(substr(o.OrderTime, 1, 2) AS INT) AS hour, CAST(substr(o.OrderTime, 1, 2) AS INT) * 60 + CAST(substr(o.OrderTime, 4, 2) AS INT) AS order_min,
 isodow(o.OrderDate) - 1 AS dow, strftime(o.OrderDate, '%Y-%m') AS month, r.* EXCLUDE (RestaurantID), c.City AS CCity, c.Age AS CustomerAge, c.Membership,
 c.RegistrationDate, c.Gender, p.* EXCLUDE (DeliveryPartnerID)
 FROM t_orders o LEFT JOIN c_rdim r ON r.RestaurantID = o.RestaurantID LEFT JOIN t_customers c ON c.CustomerID = o.CustomerID
 LEFT JOIN c_pdim p ON p.DeliveryPartnerID = o.DeliveryPartnerID""",
    "c_mode": """SELECT City, Date, WeatherCondition FROM (SELECT City, Date, WeatherCondition, count(*) AS n FROM t_weather GROUP BY 1, 2, 3)
 QUALIFY row_number() OVER (PARTITION BY City, Date ORDER BY n DESC, WeatherCondition) = 1""",
    "c_wday": """SELECT w.*, m.WeatherCondition FROM (SELECT City, Date, avg(Rainfall) AS Rainfall, avg(Temperature) AS Temperature, avg(Humidity) AS Humidity
 FROM t_weather GROUP BY 1, 2) w JOIN c_mode m ON m.City = w.City AND m.Date = w.Date""",
    "c_near": """SELECT d.OrderID, CASE t.TrafficLevel WHEN 'Low' THEN 1 WHEN 'Moderate' THEN 2 WHEN 'High' THEN 3 WHEN 'Severe' THEN 4 END AS TrafficScore,
 t.AverageSpeed FROM c_dims d JOIN t_traffic t ON t.City = d.RCity AND t.Date = d.OrderDate
 QUALIFY row_number() OVER (PARTITION BY d.OrderID ORDER BY abs(d.order_min - (CAST(substr(t.Time, 1, 2) AS INT) * 60 + CAST(substr(t.Time, 4, 2) AS INT))), t.TrafficID) = 1""",
    "c_unfilled": """SELECT d.*, w.Rainfall, w.Temperature, w.Humidity, w.WeatherCondition AS cond0, n.TrafficScore, n.AverageSpeed
 FROM c_dims d LEFT JOIN c_wday w ON w.City = d.RCity AND w.Date = d.OrderDate LEFT JOIN c_near n ON n.OrderID = d.OrderID""",
    "c_filled": "SELECT * REPLACE (" + ", ".join(f"coalesce({c}, median({c}) OVER (PARTITION BY RCity), median({c}) OVER ()) AS {c}" for c in READ)
    + """), coalesce(cond0, 'Unknown') AS WeatherCondition, CASE WHEN Rainfall IS NULL THEN 0 ELSE 1 END AS HasWeather,
 CASE WHEN TrafficScore IS NULL THEN 0 ELSE 1 END AS HasTraffic FROM c_unfilled""",
    "c_basket": "SELECT OrderID, sum(Quantity) AS BasketSize, count(OrderItemID) AS ItemLines FROM t_order_items GROUP BY 1",
    "c_fb": """SELECT OrderID, CustomerRating, DeliveryRating, FoodRating, (CustomerRating + DeliveryRating + FoodRating) / 3.0::DOUBLE AS AvgRating, Sentiment FROM t_customer_feedback""",
    "c_flags": """SELECT f.*, coalesce(b.BasketSize, 0) AS BasketSize, coalesce(b.ItemLines, 0) AS ItemLines, x.CustomerRating, x.DeliveryRating, x.FoodRating, x.AvgRating,
 x.Sentiment, y.PaymentStatus, CASE WHEN f.hour IN (12, 13, 19, 20, 21) THEN 1 ELSE 0 END AS PeakHour, CASE WHEN f.dow >= 5 THEN 1 ELSE 0 END AS WeekendOrder,
 CASE WHEN f.Rainfall <= 0.5 THEN 0 WHEN f.Rainfall <= 10 THEN 1 WHEN f.Rainfall <= 50 THEN 2 ELSE 3 END AS RainImpact,
 date_diff('day', f.RegistrationDate, f.OrderDate) AS CustomerTenure, f.OrderStatus IN ('Delivered', 'Delivered Late') AS IsDelivered,
 CASE WHEN f.OrderStatus = 'Cancelled' THEN 1 ELSE 0 END AS IsCancelled, CASE WHEN f.OrderStatus = 'Delivered Late' THEN 1 ELSE 0 END AS IsLate,
 CASE WHEN f.CouponCode IS NULL THEN 0 ELSE 1 END AS HasCoupon, CASE WHEN f.FoodCost > 0 THEN f.Discount / f.FoodCost ELSE 0 END AS DiscountPct
 FROM c_filled f LEFT JOIN c_basket b ON b.OrderID = f.OrderID LEFT JOIN c_fb x ON x.OrderID = f.OrderID LEFT JOIN t_payments y ON y.OrderID = f.OrderID""",
    "c_cust": """SELECT CustomerID, avg(FinalAmount) AS AverageBasketValue, sum(FinalAmount) AS CustomerLifetimeValue,
 count(*) / (greatest(floor(date_diff('second', min(OrderTS), max(OrderTS)) / 86400.0), 30) / 30.0) AS OrderFrequency FROM c_flags GROUP BY 1""",
    "c_pop": """SELECT RCity, RestaurantID, RestOrders, RestRevenue, rank() OVER (PARTITION BY RCity ORDER BY RestOrders DESC) AS RestaurantPopularityRank,
 rank() OVER (PARTITION BY RCity ORDER BY RestRevenue DESC) AS RestaurantRevenueRank
 FROM (SELECT RCity, RestaurantID, count(*) AS RestOrders, """ + rnd("sum(FinalAmount)", 4) + """ AS RestRevenue FROM c_flags GROUP BY 1, 2)""",
    "c_base": """SELECT f.*, c.* EXCLUDE (CustomerID), p.* EXCLUDE (RCity, RestaurantID), avg(f.AvgRating) OVER (PARTITION BY f.RestaurantID) AS RestaurantAvgFeedback
 FROM c_flags f JOIN c_cust c ON c.CustomerID = f.CustomerID LEFT JOIN c_pop p ON p.RCity = f.RCity AND p.RestaurantID = f.RestaurantID""",
    "c_cutoff": "SELECT max(OrderDate) - 60 AS cutoff FROM c_base",
    "c_hist": "SELECT * FROM c_base WHERE OrderDate <= (SELECT cutoff FROM c_cutoff)",
    "c_churn_raw": """SELECT CustomerID, date_diff('day', max(OrderDate), (SELECT cutoff FROM c_cutoff)) AS Recency, count(OrderID) AS Frequency, sum(FinalAmount) AS Monetary,
 avg(FinalAmount) AS AvgOrderValue, avg(IsCancelled) AS CancelRate, avg(IsLate) AS LateRate, avg(HasCoupon) AS CouponRate, avg(DeliveryTimeMinutes) AS AvgDeliveryTime,
 avg(AvgRating) AS AvgRating, count(DISTINCT RestaurantID) AS DistinctRestaurants, avg(WeekendOrder) AS WeekendShare,
 date_diff('day', min(OrderDate), (SELECT cutoff FROM c_cutoff)) AS FirstOrderAgeDays FROM c_hist GROUP BY 1""",
    "c_churn": """SELECT h.* REPLACE (coalesce(AvgRating, (SELECT median(AvgRating) FROM c_churn_raw)) AS AvgRating,
 coalesce(AvgDeliveryTime, (SELECT median(AvgDeliveryTime) FROM c_churn_raw)) AS AvgDeliveryTime),
 CASE WHEN Frequency > 1 THEN (FirstOrderAgeDays - Recency) / (Frequency - 1)::DOUBLE ELSE -1 END AS AvgGapDays,
 date_diff('day', c.RegistrationDate, (SELECT cutoff FROM c_cutoff)) AS Tenure, c.Age, c.Membership, c.PreferredCuisine,
 CASE WHEN h.CustomerID IN (SELECT CustomerID FROM c_base WHERE OrderDate > (SELECT cutoff FROM c_cutoff) AND OrderDate <= (SELECT cutoff + 60 FROM c_cutoff))
 THEN 0 ELSE 1 END AS Churn FROM c_churn_raw h JOIN t_customers c ON c.CustomerID = h.CustomerID""",
}

BASE_ROUND = {c: 6 for c in ("DistanceProxyKm", "DeliveryEfficiency", *READ, "AvgRating", "DiscountPct", "AverageBasketValue", "OrderFrequency", "RestaurantAvgFeedback")}
BASE_ROUND |= {"CustomerLifetimeValue": 2}
CHURN_ROUND = {c: 6 for c in ("AvgOrderValue", "CancelRate", "LateRate", "CouponRate", "AvgDeliveryTime", "AvgRating", "WeekendShare", "AvgGapDays")} | {"Monetary": 2}
FEATURES = ("TrafficScore", "Rainfall", "RainImpact", "PeakHour", "WeekendOrder", "CustomerTenure", "BasketSize", "AvgRating", "PaymentStatus",
            "DeliveryTimeMinutes", "CouponCode", "DistanceProxyKm", "DeliveryEfficiency")


def rep(cols) -> str:
    return "* REPLACE (" + ", ".join(f"{rnd(c, n)} AS {c}" for c, n in cols.items()) + ")"


def pick(*cols) -> str:
    return ", ".join(f"{rnd(c, BASE_ROUND[c])} AS {c}" if c in BASE_ROUND else c for c in cols)


SQL = {
    "haversine_km": f"SELECT RestaurantID, {pick('DistanceProxyKm')} FROM c_rdim",
    "order_time_parts": "SELECT OrderID, OrderTS, hour, order_min, dow, month FROM c_dims",
    "order_base_joins": "SELECT OrderID, RestaurantName, RCity, RArea, Cuisine, RestaurantRating, CCity, CustomerAge, Membership, VehicleType, PartnerRating, PCity FROM c_dims",
    "weather_daily": f"SELECT City, Date, {pick('Rainfall', 'Temperature', 'Humidity')}, WeatherCondition FROM c_wday",
    "attach_weather": f"""SELECT OrderID, {', '.join(f'CASE WHEN {c} IS NOT NULL THEN {rnd(c, 6)} END AS {c}' for c in ('Rainfall', 'Temperature', 'Humidity'))},
 cond0 AS WeatherCondition, CASE WHEN Rainfall IS NULL THEN 0 ELSE 1 END AS HasWeather FROM c_unfilled""",
    "attach_nearest_traffic": "SELECT OrderID, TrafficScore, AverageSpeed, CASE WHEN TrafficScore IS NULL THEN 0 ELSE 1 END AS HasTraffic FROM c_unfilled",
    "impute_city_median_flagged": f"SELECT OrderID, {pick(*READ)}, WeatherCondition, HasWeather, HasTraffic FROM c_filled",
    "basket_size": "SELECT o.OrderID, coalesce(b.BasketSize, 0) AS BasketSize, coalesce(b.ItemLines, 0) AS ItemLines FROM t_orders o LEFT JOIN c_basket b USING (OrderID)",
    "attach_feedback": f"SELECT o.OrderID, {rnd('x.AvgRating', 6)} AS AvgRating, x.Sentiment FROM t_orders o LEFT JOIN c_fb x USING (OrderID)",
    "attach_payment": "SELECT o.OrderID, y.PaymentStatus FROM t_orders o LEFT JOIN t_payments y USING (OrderID)",
    "feat_peak_hour": "SELECT OrderID, CASE WHEN hour IN (12, 13, 19, 20, 21) THEN 1 ELSE 0 END AS PeakHour FROM c_dims",
    "feat_weekend": "SELECT OrderID, CASE WHEN dow >= 5 THEN 1 ELSE 0 END AS WeekendOrder FROM c_dims",
    "feat_rain_impact": """SELECT City, Date, CASE WHEN Rainfall <= 0.5 THEN 0 WHEN Rainfall <= 10 THEN 1 WHEN Rainfall <= 50 THEN 2 ELSE 3 END AS RainImpact FROM c_wday""",
    "feat_tenure": "SELECT o.OrderID, date_diff('day', c.RegistrationDate, o.OrderDate) AS CustomerTenure FROM t_orders o JOIN t_customers c USING (CustomerID)",
    "feat_status_flags": """SELECT OrderID, OrderStatus IN ('Delivered', 'Delivered Late') AS IsDelivered, CASE WHEN OrderStatus = 'Cancelled' THEN 1 ELSE 0 END AS IsCancelled,
 CASE WHEN OrderStatus = 'Delivered Late' THEN 1 ELSE 0 END AS IsLate, CASE WHEN CouponCode IS NULL THEN 0 ELSE 1 END AS HasCoupon FROM t_orders""",
    "feat_discount_pct": f"SELECT OrderID, {rnd('CASE WHEN FoodCost > 0 THEN Discount / FoodCost ELSE 0 END', 8)} AS DiscountPct FROM t_orders",
    "feat_customer_aggregates": f"SELECT CustomerID, {pick('AverageBasketValue', 'CustomerLifetimeValue', 'OrderFrequency')} FROM c_cust",
    "feat_restaurant_popularity": "SELECT RestaurantID, RestOrders, RestRevenue, RestaurantPopularityRank, RestaurantRevenueRank FROM c_pop",
    "feat_partner_efficiency": f"SELECT DeliveryPartnerID, {pick('DeliveryEfficiency')} FROM c_pdim",
    "feat_restaurant_feedback": f"SELECT o.RestaurantID, {rnd('avg(x.AvgRating)', 6)} AS RestaurantAvgFeedback FROM t_orders o LEFT JOIN c_fb x USING (OrderID) GROUP BY 1",
    "feat_distance_proxy": f"SELECT o.OrderID, {pick('DistanceProxyKm')} FROM t_orders o JOIN c_rdim r USING (RestaurantID)",
    "order_base_table": f"SELECT {rep(BASE_ROUND)} FROM (SELECT * EXCLUDE (cond0, Latitude, Longitude, Gender) FROM c_base)",
    "churn_table": f"SELECT {rep(CHURN_ROUND)} FROM c_churn",
    "churn_gap_days": f"SELECT CustomerID, {rnd('AvgGapDays', 6)} AS AvgGapDays FROM c_churn",
    "feature_completeness": " UNION ALL ".join(f"SELECT '{c}' AS feature, count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM c_base" for c in FEATURES),
    "city_match_rate": f"SELECT {rnd('avg(CASE WHEN CCity = RCity THEN 1.0 ELSE 0.0 END)', 6)} AS match_rate FROM c_dims",
}
