"""SQL counterparts of the cleaning operators, table jobs, log and checks."""

from oracle.text import ambiguous, cint, ct, digits, first, num, other_reading, parsed, rnd, title

CITY = "(SELECT c.known FROM c_city_names c WHERE c.k = lower({}))"


def city(x: str) -> str:
    return CITY.format(ct(x))


def known(expr: str, table: str, col: str) -> str:
    return f"EXISTS (SELECT 1 FROM {table} z WHERE z.{col} = {expr})"


TABLES = {
    "c_cities": f"""SELECT {cint('TRY_CAST(CityID AS DOUBLE)')} AS CityID, {title(ct('City'))} AS City,
 {cint('TRY_CAST(Population AS DOUBLE)')} AS Population, Region,
 coalesce({num('AverageIncome')}, median({num('AverageIncome')}) OVER (PARTITION BY Region)) AS AverageIncome FROM r_cities""",
    "c_city_names": "SELECT City AS known, lower(City) AS k FROM c_cities",
    "c_customers_typed": f"""SELECT *, CASE WHEN abs({num('Age')}) BETWEEN 10 AND 100 THEN abs({num('Age')}) END AS age_ok
 FROM {first('r_customers', 'CustomerID')}""",
    "c_customers": f"""SELECT CAST(CustomerID AS BIGINT) AS CustomerID, {ct('Name')} AS Name,
 {cint('coalesce(age_ok, (SELECT median(age_ok) FROM c_customers_typed))')} AS Age, coalesce({ct('Gender')}, 'Unknown') AS Gender,
 {digits('Phone', 10)} AS Phone, {ct('Email')} AS Email, {city('City')} AS City, coalesce({ct('State')}, 'Unknown') AS State,
 {digits('Pincode', 6, True)} AS Pincode, {parsed('RegistrationDate')} AS RegistrationDate,
 coalesce({ct('Membership')}, 'Unknown') AS Membership, CAST(greatest(coalesce({num('TotalOrders')}, 0), 0) AS BIGINT) AS TotalOrders,
 coalesce({ct('PreferredCuisine')}, 'Unknown') AS PreferredCuisine FROM c_customers_typed""",
    "c_rest_typed": f"""SELECT * REPLACE (coalesce({ct('Cuisine')}, 'Unknown') AS Cuisine), CASE WHEN {num('Rating')} <= 5 THEN {num('Rating')} END AS rating_ok
 FROM {first('r_restaurants', 'RestaurantID')}""",
    "c_restaurants": f"""SELECT CAST(RestaurantID AS BIGINT) AS RestaurantID, {ct('RestaurantName')} AS RestaurantName, Cuisine, {city('City')} AS City,
 Area, OpeningTime, ClosingTime, CAST(round_even(CAST(coalesce(rating_ok, median(rating_ok) OVER (PARTITION BY Cuisine),
 (SELECT median(rating_ok) FROM c_rest_typed)) AS DECIMAL(18, 6)), 1) AS DOUBLE) AS Rating, abs({num('AverageCost')}) AS AverageCost, OwnerName, RestaurantType,
 {num('Latitude')} AS Latitude, {num('Longitude')} AS Longitude FROM c_rest_typed""",
    "c_menu_all": f"""SELECT CAST(FoodItemID AS BIGINT) AS FoodItemID, CAST(RestaurantID AS BIGINT) AS RestaurantID, {ct('FoodName')} AS FoodName,
 {ct('Category')} AS Category, abs({num('Price')}) AS Price, {cint(num('PreparationTime'))} AS PreparationTime,
 {cint(f"coalesce({num('Calories')}, median({num('Calories')}) OVER (PARTITION BY {ct('Category')}))")} AS Calories, Availability
 FROM {first('r_menu', 'FoodItemID')}""",
    "c_menu": f"SELECT * FROM c_menu_all WHERE {known('c_menu_all.RestaurantID', 'c_restaurants', 'RestaurantID')}",
    "c_part_typed": f"SELECT *, abs({num('AverageDeliveryTime')}) AS t_abs FROM {first('r_delivery_partners', 'DeliveryPartnerID')}",
    "c_part_bounds": "SELECT quantile_cont(t_abs, 0.25) AS q1, quantile_cont(t_abs, 0.75) AS q3 FROM c_part_typed",
    "c_delivery_partners": f"""SELECT CAST(DeliveryPartnerID AS BIGINT) AS DeliveryPartnerID, {ct('Name')} AS Name, {cint(num('Age'))} AS Age, Gender,
 {ct('VehicleType')} AS VehicleType, {parsed('JoiningDate')} AS JoiningDate, {city('City')} AS City,
 coalesce({num('Rating')}, (SELECT median({num('Rating')}) FROM c_part_typed)) AS Rating,
 {cint(num('CompletedDeliveries'))} AS CompletedDeliveries,
 greatest(least(t_abs, (SELECT q3 + 3 * (q3 - q1) FROM c_part_bounds)), (SELECT q1 - 3 * (q3 - q1) FROM c_part_bounds)) AS AverageDeliveryTime
 FROM c_part_typed""",
    "c_promo_all": f"""SELECT SourceRow, CAST(PromotionID AS BIGINT) AS PromotionID, upper({ct('CouponCode')}) AS CouponCode,
 CAST(DiscountPercentage AS BIGINT) AS DiscountPercentage, {ct('CampaignName')} AS CampaignName,
 least({parsed('StartDate')}, {parsed('EndDate')}) AS StartDate, greatest({parsed('StartDate')}, {parsed('EndDate')}) AS EndDate,
 coalesce({parsed('EndDate')} < {parsed('StartDate')}, FALSE) AS swapped FROM r_promotions""",
    "c_promotions": f"SELECT PromotionID, CouponCode, DiscountPercentage, CampaignName, StartDate, EndDate FROM {first('c_promo_all', 'CouponCode')}",
    "c_weather_typed": f"""SELECT CAST(WeatherID AS BIGINT) AS WeatherID, {city('City')} AS city0, {parsed('Date')} AS Date, {ambiguous('Date')} AS amb,
 {num('Temperature')} AS temp0, {num('Rainfall')} AS rain0, {num('Humidity')} AS hum0, {ct('WeatherCondition')} AS WeatherCondition, City AS city_text
 FROM r_weather""",
    "c_weather_filled": """SELECT *, last_value(city0 IGNORE NULLS) OVER (ORDER BY WeatherID ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS above,
 first_value(city0 IGNORE NULLS) OVER (ORDER BY WeatherID ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS below,
 coalesce(rain0, median(rain0) OVER (PARTITION BY WeatherCondition)) AS rain1 FROM c_weather_typed""",
    "c_weather_caps": "SELECT quantile_cont(rain0, 0.99) AS rain_hi, quantile_cont(temp0, 0.995) AS temp_hi FROM c_weather_typed",
    "c_weather": """SELECT WeatherID, coalesce(city0, above) AS City, Date, least(temp0, (SELECT temp_hi FROM c_weather_caps)) AS Temperature,
 least(rain1, (SELECT rain_hi FROM c_weather_caps)) AS Rainfall, CAST(round_even(least(abs(hum0), 100), 0) AS BIGINT) AS Humidity, WeatherCondition
 FROM c_weather_filled""",
    "c_traffic_typed": f"""SELECT CAST(TrafficID AS BIGINT) AS TrafficID, {city('City')} AS City, {parsed('Date')} AS Date, substr(Time, 1, 5) AS Time,
 {ct('TrafficLevel')} AS level0, abs({num('AverageSpeed')}) AS speed0 FROM r_traffic""",
    "c_traffic_capped": "SELECT *, least(speed0, (SELECT quantile_cont(speed0, 0.99) FROM c_traffic_typed)) AS AverageSpeed FROM c_traffic_typed",
    "c_traffic_classes": "SELECT level0 AS name, median(AverageSpeed) AS m FROM c_traffic_capped WHERE level0 IS NOT NULL GROUP BY 1",
    "c_traffic": """SELECT TrafficID, City, Date, Time, coalesce(level0, (SELECT k.name FROM c_traffic_classes k
 ORDER BY abs(k.m - t.AverageSpeed), k.name LIMIT 1)) AS TrafficLevel, AverageSpeed FROM c_traffic_capped t""",
    "c_pay_ref": f"""SELECT CAST(OrderID AS BIGINT) AS ref_order, CASE WHEN NOT {ambiguous('PaymentDate')} THEN {parsed('PaymentDate')} END AS ref_date
 FROM {first('r_payments', 'OrderID')}""",
    "c_ord_typed": f"""SELECT CAST(o.OrderID AS BIGINT) AS OrderID, CAST(o.CustomerID AS BIGINT) AS CustomerID, CAST(o.RestaurantID AS BIGINT) AS RestaurantID,
 CAST(o.DeliveryPartnerID AS BIGINT) AS DeliveryPartnerID, {parsed('o.OrderDate')} AS d0, {ambiguous('o.OrderDate')} AS amb,
 {other_reading('o.OrderDate')} AS d1, p.ref_date, substr(o.OrderTime, 1, 8) AS OrderTime, {num('o.DeliveryTimeMinutes')} AS min0,
 {num('o.FoodCost')} AS cost0, {num('o.DeliveryFee')} AS fee0, {num('o.Discount')} AS Discount, upper({ct('o.CouponCode')}) AS code0,
 {num('o.GST')} AS GST, {num('o.FinalAmount')} AS amount0, {ct('o.OrderStatus')} AS OrderStatus, {ct('o.PaymentMethod')} AS PaymentMethod
 FROM {first('r_orders', 'OrderID')} o LEFT JOIN c_pay_ref p ON p.ref_order = CAST(o.OrderID AS BIGINT)""",
    "c_ord_marked": f"""SELECT *, coalesce(amb AND abs(date_diff('day', ref_date, d1)) < abs(date_diff('day', ref_date, d0)), FALSE) AS flipped,
 {known('c_ord_typed.CustomerID', 'c_customers', 'CustomerID')} AND {known('c_ord_typed.RestaurantID', 'c_restaurants', 'RestaurantID')}
 AND {known('c_ord_typed.DeliveryPartnerID', 'c_delivery_partners', 'DeliveryPartnerID')} AS kept,
 {known('c_ord_typed.code0', 'c_promotions', 'CouponCode')} AS coupon FROM c_ord_typed""",
    "c_orders": """SELECT OrderID, CustomerID, RestaurantID, DeliveryPartnerID, CASE WHEN flipped THEN d1 ELSE d0 END AS OrderDate, OrderTime,
 CAST(CASE WHEN abs(min0) > 0 AND abs(min0) <= 180 THEN abs(min0) END AS BIGINT) AS DeliveryTimeMinutes, abs(cost0) AS FoodCost, abs(fee0) AS DeliveryFee,
 Discount, CASE WHEN coupon THEN code0 END AS CouponCode, GST, coalesce(amount0, abs(cost0) + fee0 - Discount + GST) AS FinalAmount,
 OrderStatus, PaymentMethod FROM c_ord_marked WHERE kept""",
    "c_item_typed": f"""SELECT CAST(OrderItemID AS BIGINT) AS OrderItemID, CAST(OrderID AS BIGINT) AS OrderID, CAST(FoodItemID AS BIGINT) AS FoodItemID,
 CAST(abs({num('Quantity')}) AS BIGINT) AS Quantity, {num('UnitPrice')} AS UnitPrice, {num('TotalPrice')} AS total0 FROM {first('r_order_items', 'OrderItemID')}""",
    "c_order_items": f"""SELECT OrderItemID, OrderID, FoodItemID, Quantity, UnitPrice, coalesce(total0, Quantity * UnitPrice) AS TotalPrice
 FROM c_item_typed i WHERE {known('i.OrderID', 'c_orders', 'OrderID')} AND {known('i.FoodItemID', 'c_menu', 'FoodItemID')}""",
    "c_pay_distinct": f"""SELECT DISTINCT CAST(PaymentID AS BIGINT) AS PaymentID, CAST(OrderID AS BIGINT) AS OrderID, {ct('PaymentMethod')} AS PaymentMethod,
 {ct('PaymentStatus')} AS PaymentStatus, {ct('TransactionID')} AS TransactionID, {parsed('PaymentDate')} AS PaymentDate FROM r_payments""",
    "c_pay_best": f"""SELECT * FROM {first('c_pay_distinct', 'OrderID',
        "CASE PaymentStatus WHEN 'Success' THEN 0 WHEN 'Refunded' THEN 1 WHEN 'Pending' THEN 2 WHEN 'Failed' THEN 3 ELSE 4 END, PaymentID DESC")}""",
    "c_payments": f"SELECT * FROM c_pay_best p WHERE {known('p.OrderID', 'c_orders', 'OrderID')}",
    "c_fb_zero": f"""SELECT CAST(FeedbackID AS BIGINT) AS FeedbackID, CAST(OrderID AS BIGINT) AS OrderID,
 CASE WHEN {num('CustomerRating')} <= 5 THEN {num('CustomerRating')} END AS a, CASE WHEN {num('DeliveryRating')} <= 5 THEN {num('DeliveryRating')} END AS b,
 CASE WHEN {num('FoodRating')} <= 5 THEN {num('FoodRating')} END AS c, {ct('Review')} AS Review, {ct('Sentiment')} AS Sentiment
 FROM {first('r_customer_feedback', 'OrderID')}""",
    "c_fb_one": """SELECT * REPLACE (round_even(coalesce(a, list_avg(list_filter([b, c], lambda x: x IS NOT NULL)), (SELECT median(a) FROM c_fb_zero)), 0) AS a) FROM c_fb_zero""",
    "c_fb_two": """SELECT * REPLACE (round_even(coalesce(b, list_avg(list_filter([a, c], lambda x: x IS NOT NULL)), (SELECT median(b) FROM c_fb_one)), 0) AS b) FROM c_fb_one""",
    "c_fb_three": """SELECT * REPLACE (round_even(coalesce(c, list_avg(list_filter([a, b], lambda x: x IS NOT NULL)), (SELECT median(c) FROM c_fb_two)), 0) AS c) FROM c_fb_two""",
    "c_customer_feedback": f"""SELECT FeedbackID, OrderID, CAST(a AS BIGINT) AS CustomerRating, CAST(b AS BIGINT) AS DeliveryRating,
 CAST(c AS BIGINT) AS FoodRating, Review, Sentiment FROM c_fb_three f WHERE {known('f.OrderID', 'c_orders', 'OrderID')}""",
}


def _rounded(table: str, cols: dict[str, int]) -> str:
    rep = ", ".join(f"{rnd(c, n)} AS {c}" for c, n in cols.items())
    return f"SELECT * REPLACE ({rep}) FROM {table}" if cols else f"SELECT * FROM {table}"


ROUND = {
    "cities": {}, "customers": {}, "restaurants": {}, "menu": {}, "delivery_partners": {"AverageDeliveryTime": 6, "Rating": 6},
    "promotions": {}, "weather": {"Temperature": 6, "Rainfall": 6}, "traffic": {"AverageSpeed": 6},
    "orders": {"FinalAmount": 2}, "order_items": {"TotalPrice": 2}, "payments": {}, "customer_feedback": {},
}
KEYS = {t: f"clean_{'feedback' if t == 'customer_feedback' else t}" for t in ROUND}

SQL = {KEYS[t]: _rounded(f"c_{t}", cols) for t, cols in ROUND.items()}
