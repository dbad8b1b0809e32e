"""SQL counterparts of the star schema, measures, KPIs, charts and dashboards."""

from orderlens.plans.kpis import CORR_COLUMNS, MONEY
from oracle import features
from oracle.features import BASE_ROUND
from oracle.text import rnd

BAND = "CASE WHEN {0} <= 250 THEN {1} WHEN {0} <= 500 THEN {2} WHEN {0} <= 750 THEN {3} WHEN {0} <= 1000 THEN {4} WHEN {0} <= 1500 THEN {5} WHEN {0} <= 2000 THEN {6} ELSE {7} END"
LABELS = ["'0-250'", "'250-500'", "'500-750'", "'750-1000'", "'1000-1500'", "'1500-2000'", "'2000+'"]


def band(v):
    return BAND.format(v, *LABELS)


def band_no(v):
    return BAND.format(v, *range(1, 8))


def r6(x):
    return rnd(x, 6)


Z = "({0} - avg({0}) OVER ()) / stddev_samp({0}) OVER ()"
TABLES = {
    **features.TABLES,
    "c_date": """SELECT d AS Date, CAST(year(d) AS INT) AS Year, 'Q' || quarter(d) AS Quarter, month(d) AS MonthNum, strftime(d, '%b') AS MonthName, strftime(d, '%Y-%m') AS YearMonth,
 CAST(date_trunc('month', d) AS DATE) AS MonthStart, strftime(d, '%a') AS DayOfWeek, isodow(d) AS DayOfWeekNum, CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS IsWeekend
 FROM (SELECT CAST(unnest(generate_series(date_trunc('year', min(OrderDate)), date_trunc('year', max(OrderDate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS d FROM c_base)""",
    "c_percust": """SELECT CustomerID, count(*) AS Orders, count(*) FILTER (WHERE IsDelivered) AS CompletedOrders, sum(CASE WHEN IsDelivered THEN FinalAmount ELSE 0 END) AS CLV,
 min(OrderDate) AS FirstOrderDate, max(OrderDate) AS LastOrderDate FROM c_base GROUP BY 1""",
    "c_dimcust0": """SELECT c.* RENAME (City AS CustomerCity), coalesce(p.Orders, 0) AS Orders, p.CompletedOrders, coalesce(p.CLV, 0) AS CLV, p.FirstOrderDate, p.LastOrderDate,
 date_diff('day', p.LastOrderDate, (SELECT max(OrderDate) FROM c_base)) AS DaysSinceLastOrder,
 date_diff('day', p.FirstOrderDate, (SELECT max(OrderDate) FROM c_base)) AS since_first FROM t_customers c LEFT JOIN c_percust p ON p.CustomerID = c.CustomerID""",
    "c_dimcust": f"""SELECT * EXCLUDE (since_first), CASE WHEN Orders = 0 THEN 'No orders' WHEN since_first <= 60 THEN 'New' WHEN DaysSinceLastOrder <= 60 THEN 'Active'
 WHEN DaysSinceLastOrder <= 180 THEN 'At-Risk' ELSE 'Lapsed' END AS Segment, CASE WHEN Orders >= 2 THEN 'Repeat' WHEN Orders = 1 THEN 'One-time' ELSE 'No orders' END AS CustomerType,
 {band('CLV')} AS CLVBand, {band_no('CLV')} AS CLVBandOrder FROM c_dimcust0""",
    "c_score0": """SELECT RestaurantID, RestaurantName, RCity, Cuisine, count(*) AS Orders, sum(CASE WHEN IsDelivered THEN FinalAmount ELSE 0 END) AS Revenue, max(RestaurantRating) AS Rating,
 avg(IsCancelled) AS CancelRate, sum(IsLate) / greatest(count(*) FILTER (WHERE IsDelivered), 1) AS LateRate, avg(DeliveryTimeMinutes) AS AvgDeliveryTime
 FROM c_base GROUP BY 1, 2, 3, 4 HAVING count(*) >= 5""",
    "c_score1": f"""SELECT *, {rnd('0.4 * ' + Z.format('Rating') + ' - 0.3 * ' + Z.format('CancelRate') + ' - 0.3 * ' + Z.format('LateRate'), 9)} AS CompositeScore FROM c_score0""",
    "c_score": """SELECT *, row_number() OVER (PARTITION BY RCity ORDER BY CompositeScore DESC, RestaurantID) AS CityRank,
 row_number() OVER (PARTITION BY RCity ORDER BY CompositeScore, RestaurantID) AS CityRankFromBottom FROM c_score1""",
    "c_fact": """SELECT OrderID, OrderDate, OrderTime, hour, CustomerID, RestaurantID, DeliveryPartnerID, RCity AS City, CouponCode, OrderStatus, PaymentMethod, PaymentStatus, FoodCost,
 DeliveryFee, Discount, GST, FinalAmount, DeliveryTimeMinutes, BasketSize, CAST(IsDelivered AS INT) AS IsDelivered, IsCancelled, IsLate, HasCoupon, PeakHour, WeekendOrder, TrafficScore,
 RainImpact, Rainfall, Temperature, WeatherCondition, DeliveryEfficiency, AvgRating, CustomerRating, DeliveryRating, FoodRating, Sentiment,
 CASE WHEN IsDelivered THEN FinalAmount ELSE 0.0 END AS Revenue FROM c_base""",
    "c_done": "SELECT * FROM c_base WHERE IsDelivered",
    "c_pred": """SELECT OrderID, RCity, OrderDate, CAST(DeliveryTimeMinutes AS DOUBLE) AS Actual, CAST(OrderID % 40 + 20 AS DOUBLE) AS Predicted,
 DeliveryTimeMinutes - CAST(OrderID % 40 + 20 AS DOUBLE) AS Residual FROM c_done WHERE DeliveryTimeMinutes IS NOT NULL AND OrderID % 5 = 0""",
    "c_scored": "SELECT CustomerID, Recency, Frequency, Monetary, Churn, (CustomerID * 37 % 100) / 100.0::DOUBLE AS p, CASE WHEN CustomerID % 5 = 0 THEN 'test' ELSE 'train' END AS Split FROM c_churn",
    "c_cscores": """SELECT *, CASE WHEN p >= (SELECT quantile_cont(p, 0.66) FROM c_scored) THEN 'High' WHEN p >= (SELECT quantile_cont(p, 0.33) FROM c_scored) THEN 'Medium' ELSE 'Low' END AS RiskSegment FROM c_scored""",
}
SCORE = "* REPLACE (" + ", ".join(f"{r6(c)} AS {c}" for c in ("CancelRate", "LateRate", "AvgDeliveryTime", "CompositeScore")) + f", {rnd('Revenue', 2)} AS Revenue)"
RPT = "RestaurantID, RestaurantName || ' (' || RCity || ')' AS RestaurantLabel, RCity, Cuisine, Orders, Rating, " + ", ".join(f"{r6(c)} AS {c}" for c in ("CancelRate", "LateRate", "CompositeScore"))
DONE = "FILTER (WHERE IsDelivered = 1)"
REV, NDONE, AVGT, DISC = f"sum(FinalAmount) {DONE}", f"count(*) {DONE}", f"avg(DeliveryTimeMinutes) {DONE}", f"sum(Discount) {DONE}"


def rate(cond):
    return f"avg(CASE WHEN {cond} THEN 1.0 ELSE 0.0 END)"


def long(chart, frm, label, value, tail=""):
    return f"SELECT '{chart}' AS chart, CAST(label AS VARCHAR) AS label, CAST(value AS DOUBLE) AS value FROM (SELECT {label} AS label, {value} AS value FROM {frm} GROUP BY 1 {tail})"


def top(chart, frm, label, value, n):
    return long(chart, frm, label, value, "ORDER BY value DESC, label" + (f" LIMIT {n}" if n else ""))


def panel(name, frm, label, value, digits=6, tail=""):
    return f"SELECT '{name}' AS panel, CAST(label AS VARCHAR) AS label, {rnd('value', digits)} AS value FROM (SELECT {label} AS label, {value} AS value FROM {frm} GROUP BY 1 {tail})"


def card(label, expr, frm):
    digits = 2 if label in MONEY else 6
    return f"SELECT 'card' AS panel, '{label}' AS label, {rnd(expr, digits)} AS value FROM {frm}"


def hist(chart, frm, v):
    return f"""SELECT '{chart}' AS chart, bin, {r6('lo + (hi - lo) / 40 * bin')} AS left_edge, count(*) AS n FROM (SELECT lo, hi, CAST(least(floor((v - lo) / (hi - lo) * 40), 39) AS BIGINT) AS bin
 FROM (SELECT CAST({v} AS DOUBLE) AS v, min(CAST({v} AS DOUBLE)) OVER () AS lo, max(CAST({v} AS DOUBLE)) OVER () AS hi FROM {frm} WHERE {v} IS NOT NULL)) GROUP BY ALL"""


def box(chart, label, v):
    return f"""SELECT '{chart}' AS chart, label, {r6('min(v) FILTER (WHERE v >= q1 - 1.5 * (q3 - q1))')} AS low, {r6('max(q1)')} AS q1, {r6('max(q2)')} AS median, {r6('max(q3)')} AS q3,
 {r6('max(v) FILTER (WHERE v <= q3 + 1.5 * (q3 - q1))')} AS high FROM (SELECT CAST({label} AS VARCHAR) AS label, CAST({v} AS DOUBLE) AS v, quantile_cont(CAST({v} AS DOUBLE), 0.25) OVER (PARTITION BY {label}) AS q1,
 quantile_cont(CAST({v} AS DOUBLE), 0.5) OVER (PARTITION BY {label}) AS q2, quantile_cont(CAST({v} AS DOUBLE), 0.75) OVER (PARTITION BY {label}) AS q3 FROM c_done WHERE {v} IS NOT NULL) GROUP BY 1, 2"""


def ztest(name, hi, lo):
    y = "DeliveryTimeMinutes"
    d = f"(avg({y}) FILTER (WHERE {hi}) - avg({y}) FILTER (WHERE {lo}))"
    se = f"sqrt(var_samp({y}) FILTER (WHERE {hi}) / count({y}) FILTER (WHERE {hi}) + var_samp({y}) FILTER (WHERE {lo}) / count({y}) FILTER (WHERE {lo}))"
    return f"SELECT '{name}' AS test, {r6(d)} AS diff, {r6(f'{d} / {se}')} AS z FROM c_done"


def cells(chart, nc, nq, by):
    return f"""SELECT '{chart}' AS chart, c.RCity AS "row", q.Cuisine AS col, coalesce(v.s, 0) AS value FROM
 (SELECT RCity FROM c_done GROUP BY 1 ORDER BY {rnd('sum(FinalAmount)', 2)} DESC, 1 LIMIT {nc}) c CROSS JOIN (SELECT Cuisine FROM c_done GROUP BY 1 ORDER BY {by} DESC, 1 LIMIT {nq}) q
 LEFT JOIN (SELECT RCity, Cuisine, {rnd('sum(FinalAmount)', 2)} AS s FROM c_done GROUP BY 1, 2) v ON v.RCity = c.RCity AND v.Cuisine = q.Cuisine"""


_fact_round = {c: n for c, n in BASE_ROUND.items() if c in ("Rainfall", "Temperature", "DeliveryEfficiency", "AvgRating", "TrafficScore")}
SQL = {
    "dim_date": "SELECT * FROM c_date",
    "dim_city": "SELECT * FROM t_cities",
    "dim_partner": "SELECT * FROM t_delivery_partners",
    "dim_promotion": "SELECT * FROM t_promotions",
    "dim_menu": "SELECT * FROM t_menu",
    "fact_order_items": f"SELECT * REPLACE ({r6('UnitPrice')} AS UnitPrice) FROM t_order_items",
    "dim_customer": f"SELECT * REPLACE ({rnd('CLV', 2)} AS CLV) FROM c_dimcust",
    "customer_segment": "SELECT Segment, count(*) AS n FROM c_dimcust GROUP BY 1",
    "customer_type": "SELECT CustomerType, count(*) AS n FROM c_dimcust GROUP BY 1",
    "clv_band": f"SELECT OrderID, {band('(FinalAmount / 200)')} AS band, {band_no('(FinalAmount / 200)')} AS band_order FROM t_orders",
    "dim_restaurant": f"SELECT r.*, {r6('s.CompositeScore')} AS CompositeScore, s.CityRank, s.CityRankFromBottom FROM t_restaurants r LEFT JOIN c_score s ON s.RestaurantID = r.RestaurantID",
    "rpt_restaurant_top10": f"SELECT {RPT} FROM (SELECT * FROM c_score WHERE Orders >= 15 ORDER BY CompositeScore DESC, RestaurantID LIMIT 10)",
    "rpt_restaurant_bottom10": f"SELECT {RPT} FROM (SELECT * FROM c_score WHERE Orders >= 15 ORDER BY CompositeScore, RestaurantID LIMIT 10)",
    "fact_orders": f"SELECT {features.rep(_fact_round)} FROM c_fact",
    "restaurant_scorecard": f"SELECT {SCORE} FROM c_score",
    "restaurants_top10_per_city": f"SELECT {SCORE} FROM c_score WHERE CityRank <= 10",
    "restaurants_bottom10_per_city": f"SELECT {SCORE} FROM c_score WHERE CityRankFromBottom <= 10",
    "export_star_schema": " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS n FROM {t}" for n, t in (
        ("dim_date", "c_date"), ("dim_city", "t_cities"), ("dim_customer", "c_dimcust"), ("dim_restaurant", "t_restaurants"), ("dim_partner", "t_delivery_partners"),
        ("dim_promotion", "t_promotions"), ("dim_menu", "t_menu"), ("fact_orders", "c_fact"), ("fact_order_items", "t_order_items"),
        ("rpt_restaurant_top10", "(SELECT * FROM c_score WHERE Orders >= 15 LIMIT 10)"), ("rpt_restaurant_bottom10", "(SELECT * FROM c_score WHERE Orders >= 15 LIMIT 10)"))),
    "evaluate_measures": f"""SELECT Cuisine, Membership, count(*) AS "Total Orders", {rnd('sum(FinalAmount) FILTER (WHERE IsDelivered)', 2)} AS "Total Revenue",
 {r6('sum(IsLate) / nullif(count(*) FILTER (WHERE IsDelivered), 0)')} AS "Late %" FROM c_base WHERE RCity IN ('ASIA', 'EUROPE') AND OrderDate BETWEEN DATE '1996-01-01' AND DATE '1999-12-31' GROUP BY 1, 2""",
    "measures_kpi": f"""SELECT City, count(*) AS "Total Orders", {NDONE} AS "Completed Orders", {rnd(REV, 2)} AS "Total Revenue", {r6(f'{REV} / {NDONE}')} AS "Avg Order Value",
 {r6(AVGT)} AS "Avg Delivery Time", {r6(f'quantile_cont(DeliveryTimeMinutes, 0.9) {DONE}')} AS "P90 Delivery Time", {r6('avg(AvgRating)')} AS "Avg Rating", {r6(f'sum(IsLate) / {NDONE}')} AS "Late %",
 {r6('avg(IsCancelled)')} AS "Cancellation %", {r6(rate('IsDelivered = 0'))} AS "Failure %" FROM c_fact GROUP BY 1""",
    "measures_time": f"""WITH m AS (SELECT d.MonthStart, max(d.Date) AS e FROM c_date d GROUP BY 1), v AS (SELECT CAST(date_trunc('month', OrderDate) AS DATE) AS k, {REV} AS r FROM c_fact GROUP BY 1),
 j AS (SELECT m.MonthStart, m.e, v.r, lag(v.r) OVER (ORDER BY m.MonthStart) AS p FROM m LEFT JOIN v ON v.k = m.MonthStart)
 SELECT MonthStart, {rnd('r', 2)} AS "Total Revenue", {rnd('p', 2)} AS "Revenue PM", {r6('(r - p) / p')} AS "Revenue MoM %",
 (SELECT nullif(count(DISTINCT CustomerID), 0) FROM c_fact f WHERE f.OrderDate BETWEEN j.e - 59 AND j.e) AS "Active Customers" FROM j""",
    "evaluate_months": f"""WITH f AS (SELECT c.* FROM c_fact c JOIN c_dimcust d ON d.CustomerID = c.CustomerID WHERE d.Membership IN ('BUILDING', 'MACHINERY')),
 m AS (SELECT MonthStart, max(Date) AS e FROM c_date GROUP BY 1), s AS (SELECT DISTINCT MonthStart FROM c_date WHERE Date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'),
 v AS (SELECT City, CAST(date_trunc('month', OrderDate) AS DATE) AS k, {REV} AS r FROM f GROUP BY 1, 2),
 g AS (SELECT DISTINCT City FROM f), x AS (
 SELECT g.City, s.MonthStart, v.r, p.r AS pr, v.City IS NOT NULL AS sold, (SELECT nullif(count(DISTINCT CustomerID), 0) FROM f WHERE f.City IS NOT DISTINCT FROM g.City AND f.OrderDate BETWEEN m.e - 59 AND m.e) AS a
 FROM g CROSS JOIN s JOIN m ON m.MonthStart = s.MonthStart LEFT JOIN v ON v.City IS NOT DISTINCT FROM g.City AND v.k = s.MonthStart LEFT JOIN v p ON p.City IS NOT DISTINCT FROM g.City AND p.k = CAST(s.MonthStart - INTERVAL 1 MONTH AS DATE))
 SELECT City, MonthStart, {rnd('r', 2)} AS "Total Revenue", {rnd('pr', 2)} AS "Revenue PM", {r6('(r - pr) / pr')} AS "Revenue MoM %", a AS "Active Customers" FROM x WHERE r IS NOT NULL OR pr IS NOT NULL OR a IS NOT NULL""",
    "active_customers_by_date": """WITH d AS (SELECT DISTINCT Date FROM c_date WHERE Date BETWEEN DATE '1996-01-01' AND DATE '1997-12-31'), f AS (SELECT DISTINCT City, CustomerID, OrderDate FROM c_fact)
 SELECT f.City, d.Date, count(DISTINCT f.CustomerID) AS "Active Customers" FROM d JOIN f ON f.OrderDate BETWEEN d.Date - 59 AND d.Date GROUP BY ALL""",
    "evaluate_chain": f"""SELECT b.Cuisine, {r6('avg(abs(p.Residual))')} AS "Delivery MAE", {r6('avg(p.Actual)')} AS "Avg Actual" FROM c_pred p JOIN c_base b ON b.OrderID = p.OrderID
 WHERE b.Membership = 'BUILDING' GROUP BY 1""",
    "measures_revenue_30d": f"""SELECT d.Date, {r6('avg(v.r) OVER (ORDER BY d.Date ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)')} AS "Revenue 30d Avg" FROM c_date d
 LEFT JOIN (SELECT OrderDate, {REV} AS r FROM c_fact GROUP BY 1) v ON v.OrderDate = d.Date""",
    "measures_new_customers": """SELECT d.YearMonth, count(*) AS "New Customers" FROM t_customers c JOIN c_date d ON d.Date = c.RegistrationDate GROUP BY 1""",
    "measures_customer": f"""SELECT Membership, count(*) AS "Customers", count(*) FILTER (WHERE Orders >= 1) AS "Ordering Customers", count(*) FILTER (WHERE Orders >= 2) AS "Repeat Customers",
 {r6('count(*) FILTER (WHERE Orders >= 2) / count(*) FILTER (WHERE Orders >= 1)')} AS "Retention Rate", {r6("count(*) FILTER (WHERE CustomerType = 'One-time') / count(*) FILTER (WHERE Orders >= 1)")} AS "One-time Customers %",
 {r6('avg(CLV) FILTER (WHERE Orders >= 1)')} AS "Avg CLV" FROM c_dimcust GROUP BY 1""",
    "measures_restaurant": f"""SELECT a.*, b."Restaurant Revenue", b."Restaurant Cancel %" FROM (SELECT r.Cuisine, {r6('avg(s.CompositeScore)')} AS "Avg Composite Score", {r6('avg(r.Rating)')} AS "Avg Restaurant Rating"
 FROM t_restaurants r LEFT JOIN c_score s ON s.RestaurantID = r.RestaurantID GROUP BY 1) a LEFT JOIN (SELECT Cuisine, {rnd('sum(FinalAmount) FILTER (WHERE IsDelivered)', 2)} AS "Restaurant Revenue",
 {r6('avg(IsCancelled)')} AS "Restaurant Cancel %" FROM c_base GROUP BY 1) b ON b.Cuisine = a.Cuisine""",
    "measures_report_scores": f"""SELECT {r6('sum(CompositeScore)')} AS "Top 10 Score", (SELECT {r6('sum(CompositeScore)')} FROM (SELECT * FROM c_score WHERE Orders >= 15 ORDER BY CompositeScore, RestaurantID LIMIT 10)) AS "Bottom 10 Score"
 FROM (SELECT * FROM c_score WHERE Orders >= 15 ORDER BY CompositeScore DESC, RestaurantID LIMIT 10)""",
    "measures_delivery": f"""SELECT f.DeliveryPartnerID, p.VehicleType, {NDONE} AS "Partner Deliveries", {r6(AVGT)} AS "Partner Avg Time", CASE WHEN {NDONE} >= 10 THEN {r6(AVGT)} END AS "Avg Time (10+ deliveries)"
 FROM c_fact f JOIN t_delivery_partners p ON p.DeliveryPartnerID = f.DeliveryPartnerID GROUP BY 1, 2""",
    "measures_impact": f"""SELECT TrafficScore, RainImpact, {r6(AVGT)} AS "Traffic Impact" FROM c_fact GROUP BY 1, 2""",
    "measures_sales": f"""SELECT strftime(OrderDate, '%Y-%m') AS YearMonth, {rnd(DISC, 2)} AS "Total Discount", {r6('avg(HasCoupon)')} AS "Coupon Usage %", {r6(f'{DISC} / ({REV} + {DISC})')} AS "Discount % of Revenue" FROM c_fact GROUP BY 1""",
    "measures_ml_by_key": f"""SELECT {r6('avg(abs(Residual))')} AS "Delivery MAE", {r6('sqrt(avg(Residual * Residual))')} AS "Delivery RMSE",
 {r6('1 - sum(Residual * Residual) / (var_pop(Actual) * count(*))')} AS "Delivery R2", {r6('avg(Predicted)')} AS "Avg Predicted", {r6('avg(Actual)')} AS "Avg Actual",
 (SELECT count(*) FROM c_cscores WHERE Split = 'test') AS "Test Customers", (SELECT count(*) FROM c_cscores WHERE Split = 'test' AND RiskSegment = 'High') AS "High-risk Customers",
 (SELECT {r6('avg(Churn)')} FROM c_cscores WHERE Split = 'test') AS "Actual Churn % (test)" FROM c_pred""",
    "kpi_headline": f"""SELECT count(*) AS orders_total, count(DISTINCT CustomerID) AS customers_with_orders, count(DISTINCT RestaurantID) AS restaurants_with_orders,
 {rnd('sum(FinalAmount) FILTER (WHERE IsDelivered)', 2)} AS revenue, {r6('avg(FinalAmount) FILTER (WHERE IsDelivered)')} AS avg_order_value, count(*) FILTER (WHERE IsDelivered) AS completed_orders,
 {r6('avg(IsCancelled) * 100')} AS cancelled_pct, {r6(rate("OrderStatus = 'Food Not Delivered'") + ' * 100')} AS food_not_delivered_pct, {r6('avg(IsLate) FILTER (WHERE IsDelivered) * 100')} AS late_pct_of_completed,
 {r6('avg(DeliveryTimeMinutes) FILTER (WHERE IsDelivered)')} AS avg_delivery_min, {r6('quantile_cont(DeliveryTimeMinutes, 0.5) FILTER (WHERE IsDelivered)')} AS median_delivery_min,
 {r6('quantile_cont(DeliveryTimeMinutes, 0.9) FILTER (WHERE IsDelivered)')} AS p90_delivery_min, {r6('quantile_cont(DeliveryTimeMinutes, 0.95) FILTER (WHERE IsDelivered)')} AS p95_delivery_min,
 {r6('avg(AvgRating)')} AS avg_feedback_rating, {r6('avg(WeekendOrder) * 100')} AS weekend_orders_pct, {r6('avg(HasCoupon) * 100')} AS coupon_usage_pct,
 {r6('avg(DiscountPct) FILTER (WHERE HasCoupon = 1) * 100')} AS avg_discount_pct_when_coupon, {r6(rate("PaymentStatus = 'Failed'") + ' * 100')} AS payment_failed_pct,
 (SELECT {r6(rate('n = 1') + ' * 100')} FROM (SELECT count(*) AS n FROM c_base GROUP BY CustomerID)) AS one_time_customers_pct FROM c_base""",
    "kpi_argmax": f"""(SELECT 'top_city' AS kpi, RCity AS winner, {rnd('sum(FinalAmount)', 2)} AS value FROM c_done GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 1) UNION ALL
 (SELECT 'top_cuisine', Cuisine, {rnd('sum(FinalAmount)', 2)} FROM c_done GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 1) UNION ALL
 (SELECT 'peak_hour', CAST(hour AS VARCHAR), CAST(count(*) AS DOUBLE) FROM c_base GROUP BY hour ORDER BY 3 DESC, hour LIMIT 1)""",
    "kpi_breakdowns": " UNION ALL ".join([
        long("avg_basket_by_membership", "c_done", "Membership", rnd("avg(FinalAmount)", 1)), long("delivery_time_by_traffic", "c_done", "CAST(TrafficScore AS DOUBLE)", rnd("avg(DeliveryTimeMinutes)", 2)),
        long("delivery_time_by_rain", "c_done", "RainImpact", rnd("avg(DeliveryTimeMinutes)", 2)), long("late_pct_by_traffic", "c_done", "CAST(TrafficScore AS DOUBLE)", rnd("avg(IsLate) * 100", 2)),
        long("cancel_pct_by_weather", "c_base", "WeatherCondition", rnd("avg(IsCancelled) * 100", 2)), long("cancel_pct_by_payment", "c_base", "PaymentMethod", rnd("avg(IsCancelled) * 100", 2)),
        long("cancel_pct_by_cuisine", "c_base", "Cuisine", rnd("avg(IsCancelled) * 100", 2))]),
    "kpi_join_rates": f"SELECT {r6('avg(HasWeather)')} AS weather_join_rate, {r6('avg(HasTraffic)')} AS traffic_join_rate FROM c_base",
    "kpi_top5": " UNION ALL ".join([top("revenue_by_city", "c_done", "RCity", rnd("sum(FinalAmount)", 0), 5), top("revenue_by_cuisine", "c_done", "Cuisine", rnd("sum(FinalAmount)", 0), 5)]),
    "kpi_correlation": f"SELECT {r6('corr(IsCancelled, TrafficScore)')} AS cancel_vs_traffic_corr FROM c_base",
    "two_sample_z": ztest("traffic_high_vs_low", "TrafficScore >= 3", "TrafficScore <= 2") + " UNION ALL " + ztest("rain_heavy_vs_light", "RainImpact >= 2", "RainImpact <= 1"),
    "write_kpi_json": f"""SELECT count(*) AS orders_total, count(*) FILTER (WHERE IsDelivered) AS completed_orders, {rnd('sum(FinalAmount) FILTER (WHERE IsDelivered)', 2)} AS revenue,
 {r6('avg(IsLate) FILTER (WHERE IsDelivered) * 100')} AS late_pct_of_completed FROM c_base""",
    "chart_rank_bars": " UNION ALL ".join([
        top("revenue_by_city", "c_done", "RCity", rnd("sum(FinalAmount)", 2), 12), top("orders_by_cuisine", "c_done", "Cuisine", "count(*)", 12),
        top("revenue_by_restaurant", "c_done", "RestaurantName", rnd("sum(FinalAmount)", 2), 10),
        top("discount_by_campaign", "c_base b JOIN t_promotions p ON p.CouponCode = b.CouponCode", "p.CampaignName", rnd("sum(Discount)", 2), None)]),
    "chart_monthly": f"""SELECT CAST(date_trunc('month', OrderDate) AS DATE) AS month, OrderStatus, count(*) AS orders, {rnd('sum(FinalAmount) FILTER (WHERE IsDelivered)', 2)} AS revenue,
 {r6('avg(DeliveryTimeMinutes) FILTER (WHERE IsDelivered)')} AS avg_delivery_time FROM c_base GROUP BY 1, 2""",
    "chart_cumulative_revenue": f"SELECT OrderDate, {rnd('sum(r) OVER (ORDER BY OrderDate)', 2)} AS cumulative FROM (SELECT OrderDate, sum(FinalAmount) AS r FROM c_done GROUP BY 1)",
    "chart_shares": " UNION ALL ".join(
        f"SELECT '{n}' AS chart, label, n, {r6('n / sum(n) OVER ()')} AS share FROM (SELECT {c} AS label, count(*) AS n FROM {f} GROUP BY 1)" for n, c, f in (
            ("payment_method", "PaymentMethod", "c_base"), ("order_status", "OrderStatus", "c_base"),
            ("customers", "CASE WHEN n > 1 THEN 'Repeat' ELSE 'One-time' END", "(SELECT count(*) AS n FROM c_base GROUP BY CustomerID)"))),
    "chart_counts": """SELECT 'status' AS chart, OrderStatus AS label, '' AS hue, count(*) AS n FROM c_base GROUP BY 2 UNION ALL SELECT 'payment_method', PaymentMethod, '', count(*) FROM c_base GROUP BY 2
 UNION ALL SELECT 'sentiment_by_status', OrderStatus, Sentiment, count(*) FROM c_base WHERE Sentiment IS NOT NULL GROUP BY 2, 3""",
    "chart_pivots": " UNION ALL ".join([
        cells("city_cuisine_8x6", 8, 6, "count(*)"), cells("city_cuisine_12x10", 12, 10, rnd("sum(FinalAmount)", 2)),
        "SELECT 'payment_status', PaymentMethod, PaymentStatus, CAST(count(*) AS DOUBLE) FROM c_base GROUP BY 2, 3",
        """SELECT 'weekday_hour', CAST(m.dow AS VARCHAR), 'h' || s.s, CAST(count(b.OrderID) AS DOUBLE) FROM (SELECT DISTINCT dow FROM c_base) m CROSS JOIN (SELECT unnest(range(24)) AS s) s
 LEFT JOIN c_base b ON b.dow = m.dow AND b.hour = s.s GROUP BY 2, 3"""]),
    "chart_orders_per_day_by_hour": f"""SELECT b.hour, t.day_type, {r6('count(*) / max(t.days)')} AS orders_per_day FROM c_base b JOIN (SELECT WeekendOrder, CASE WHEN WeekendOrder = 1 THEN 'Weekend' ELSE 'Weekday' END AS day_type,
 count(DISTINCT OrderDate) AS days FROM c_base GROUP BY 1) t ON t.WeekendOrder = b.WeekendOrder GROUP BY 1, 2""",
    "chart_rates": " UNION ALL ".join(f"SELECT '{n}' AS chart, {c} AS label, {r6('avg(IsCancelled)')} AS rate, {r6('1.96 * stddev_samp(IsCancelled) / sqrt(count(*))')} AS half_width FROM c_base GROUP BY 2"
                                      for n, c in (("cuisine", "Cuisine"), ("weather", "WeatherCondition"))),
    "chart_mean_sem": f"SELECT TrafficScore, {r6('avg(DeliveryTimeMinutes)')} AS mean, {r6('1.96 * stddev_samp(DeliveryTimeMinutes) / sqrt(count(DeliveryTimeMinutes))')} AS half_width FROM c_done GROUP BY 1",
    "chart_avg_basket": f"SELECT Membership, {r6('avg(FinalAmount)')} AS avg_amount FROM c_done GROUP BY 1",
    "chart_histogram": " UNION ALL ".join([hist("order_value", "c_done", "FinalAmount"), hist("delivery_time", "c_done", "DeliveryTimeMinutes"), hist("clv", "(SELECT * FROM c_dimcust WHERE Orders > 0)", "CLV")]),
    "chart_box_stats": " UNION ALL ".join([box("time_by_vehicle", "VehicleType", "DeliveryTimeMinutes"), box("amount_by_membership", "Membership", "FinalAmount"), box("time_by_rain", "RainImpact", "DeliveryTimeMinutes"), box("time_by_city", "RCity", "DeliveryTimeMinutes")]),
    "chart_letter_values": "SELECT city, " + ", ".join(f"{rnd(f'quantile_cont(clv, {p})', 6)} AS {n}" for n, p in (
        ("p50", 0.5), ("lo4", 0.25), ("hi4", 0.75), ("lo8", 0.125), ("hi8", 0.875), ("lo16", 0.0625), ("hi16", 0.9375)))
    + """ FROM (SELECT CustomerID, max(CustomerLifetimeValue) AS clv, max(CCity) AS city FROM c_base GROUP BY 1) WHERE city IN
 (SELECT CCity FROM c_base GROUP BY 1 ORDER BY count(DISTINCT CustomerID) DESC, 1 LIMIT 8) GROUP BY 1""",
    "chart_scatter_fit": " UNION ALL ".join(f"SELECT '{x}' AS x, {rnd(f'regr_slope(DeliveryTimeMinutes, {x})', 8)} AS slope, {rnd(f'regr_intercept(DeliveryTimeMinutes, {x})', 8)} AS intercept, regr_count(DeliveryTimeMinutes, {x}) AS n FROM c_done"
                                            for x in ("DistanceProxyKm", "TrafficScore")),
    "chart_corr_matrix": " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, {r6(f'corr({a}, {b})')} AS r FROM c_base" for i, a in enumerate(CORR_COLUMNS) for b in CORR_COLUMNS[i + 1:]),
    "payment_reconciliation": f"""SELECT count(*) AS failed_orders, count(*) FILTER (WHERE PaymentStatus = 'Success') AS paid_but_failed, {rnd("sum(FinalAmount) FILTER (WHERE PaymentStatus = 'Success')", 2)} AS paid_amount,
 {r6(rate("PaymentStatus = 'Refunded'") + ' * 100')} AS refunded_pct FROM c_base WHERE NOT IsDelivered""",
    "payment_reconciliation_by_status": "SELECT PaymentStatus, count(*) AS n FROM c_base WHERE NOT IsDelivered GROUP BY 1",
    "naive_forecast": f"""WITH m AS (SELECT date_trunc('month', OrderDate) AS k, sum(FinalAmount) AS v FROM c_done GROUP BY 1)
 SELECT {rnd('avg(v)', 2)} AS month_mean, {rnd('stddev_samp(v)', 2)} AS month_sd, (SELECT {rnd('avg(v) * 3', 2)} FROM (SELECT v FROM m ORDER BY k DESC LIMIT 3)) AS next_quarter FROM m""",
    "late_vs_ontime_summary": f"SELECT IsLate, {r6('avg(DeliveryTimeMinutes)')} AS mean_time, {r6('avg(DeliveryRating)')} AS mean_delivery_rating FROM c_done WHERE DeliveryTimeMinutes IS NOT NULL GROUP BY 1",
    "rating_vs_cancel_corr": f"SELECT {r6('corr(r, c)')} AS corr, count(*) AS restaurants FROM (SELECT max(RestaurantRating) AS r, avg(IsCancelled) AS c FROM c_base GROUP BY RestaurantID HAVING count(*) >= 10)",
    "coupon_aov": f"SELECT HasCoupon, {r6('avg(FinalAmount)')} AS aov FROM c_done GROUP BY 1",
    "dash_executive": " UNION ALL ".join([
        card("Active customers (60d)", "count(*) FILTER (WHERE DaysSinceLastOrder <= 60)", "c_dimcust"),
        card("Total Revenue", REV, "c_fact"), card("Total Orders", "count(*)", "c_fact"), card("Avg Delivery Time", AVGT, "c_fact"), card("Avg Rating", "avg(AvgRating)", "c_fact"),
        card("Late %", f"sum(IsLate) / {NDONE}", "c_fact"), card("Failure %", rate("IsDelivered = 0"), "c_fact"), card("P90 Delivery Time", f"quantile_cont(DeliveryTimeMinutes, 0.9) {DONE}", "c_fact"),
        panel("month", "c_fact", "CAST(date_trunc('month', OrderDate) AS DATE)", REV, 2), panel("city", "c_fact", "City", REV, 2, "ORDER BY value DESC, label LIMIT 8"), panel("status", "c_fact", "OrderStatus", "count(*)")]),
    "dash_customer": " UNION ALL ".join([
        card("repeat_share", rate("Orders >= 2"), "c_dimcust WHERE Orders > 0"), card("one_time_share", rate("Orders = 1"), "c_dimcust WHERE Orders > 0"), card("never_ordered_share", rate("Orders = 0"), "c_dimcust"),
        card("median_clv", "median(CLV)", "c_dimcust WHERE Orders > 0"), card("avg_orders", "avg(Orders)", "c_dimcust WHERE Orders > 0"),
        panel("segment", "c_dimcust", "Segment", "count(*)"), panel("type", "c_dimcust", "CustomerType", "count(*)"), panel("clv_band", "c_dimcust", "CLVBand", "count(*)"),
        f"""SELECT 'registrations_to_quarter', CAST(q AS VARCHAR), {r6('sum(n) OVER (ORDER BY q)')} FROM (SELECT CAST(date_trunc('quarter', RegistrationDate) AS DATE) AS q, count(*) AS n FROM c_dimcust GROUP BY 1)""",
        panel("new_by_month", "c_dimcust", "strftime(RegistrationDate, '%Y-%m')", "count(*)"),
        f"""SELECT 'clv_histogram', CAST(bin AS VARCHAR), CAST(n AS DOUBLE) FROM ({hist("clv", "(SELECT * FROM c_dimcust WHERE Orders > 0)", "CLV")})"""]),
    "dash_restaurant": " UNION ALL ".join([
        card("scored", "count(*)", "c_score"), card("median_orders", "median(Orders)", "c_score"), card("avg_score", "avg(CompositeScore)", "c_score"), card("avg_rating", "avg(Rating)", "t_restaurants"),
        *[f"SELECT '{n}', RestaurantName || ' (' || RCity || ')', {r6('CompositeScore')} FROM (SELECT * FROM c_score ORDER BY CompositeScore {o}, RestaurantID LIMIT 10)" for n, o in (("top10", "DESC"), ("bottom10", "ASC"))],
        panel("cuisine_revenue", "c_done", "Cuisine", "sum(FinalAmount)", 2, "ORDER BY value DESC, label LIMIT 10"), panel("cuisine_rating", "t_restaurants", "Cuisine", "avg(Rating)")]),
    "dash_delivery": " UNION ALL ".join([
        card("Avg Delivery Time", AVGT, "c_fact"), card("P90 Delivery Time", f"quantile_cont(DeliveryTimeMinutes, 0.9) {DONE}", "c_fact"), card("Late %", f"sum(IsLate) / {NDONE}", "c_fact"), card("Completed Orders", NDONE, "c_fact"),
        card("partners_10_plus", "count(*)", "(SELECT DeliveryPartnerID FROM c_done GROUP BY 1 HAVING count(*) >= 10)"),
        f"""SELECT * FROM (SELECT 'fastest', CAST(DeliveryPartnerID AS VARCHAR), {r6('m')} FROM (SELECT DeliveryPartnerID, {rnd('avg(DeliveryTimeMinutes)', 9)} AS m FROM c_done GROUP BY 1 HAVING count(DeliveryTimeMinutes) >= 10)
 ORDER BY m, DeliveryPartnerID LIMIT 10)""",
        panel("month", "c_fact", "CAST(date_trunc('month', OrderDate) AS DATE)", AVGT), panel("traffic", "c_fact", "CAST(TrafficScore AS DOUBLE)", AVGT), panel("rain", "c_fact", "RainImpact", AVGT)]),
    "dash_partner_leaderboard": f"""SELECT f.DeliveryPartnerID, p.VehicleType, p.Rating, {NDONE} AS "Partner Deliveries", CASE WHEN {NDONE} >= 10 THEN {r6(AVGT)} END AS "Avg Time (10+ deliveries)"
 FROM c_fact f JOIN t_delivery_partners p ON p.DeliveryPartnerID = f.DeliveryPartnerID GROUP BY 1, 2, 3""",
    "dash_sales": " UNION ALL ".join([
        card("Total Revenue", REV, "c_fact"), card("Avg Order Value", f"{REV} / {NDONE}", "c_fact"), card("Total Discount", DISC, "c_fact"), card("Coupon Usage %", "avg(HasCoupon)", "c_fact"),
        card("Discount % of Revenue", f"{DISC} / ({REV} + {DISC})", "c_fact"),
        f"""SELECT 'average_30', CAST(OrderDate AS VARCHAR), CASE WHEN rn >= 30 THEN {rnd('a', 4)} END FROM (SELECT OrderDate, row_number() OVER (ORDER BY OrderDate) AS rn,
 avg(r) OVER (ORDER BY OrderDate ROWS BETWEEN 29 PRECEDING AND CURRENT ROW) AS a FROM (SELECT OrderDate, sum(FinalAmount) AS r FROM c_done GROUP BY 1))""",
        panel("campaign", "c_fact f JOIN t_promotions p ON p.CouponCode = f.CouponCode", "p.CampaignName", DISC, 2, "ORDER BY value DESC, label LIMIT 8"), panel("payment", "c_fact", "PaymentMethod", "count(*)")]),
    "dash_ml_by_key": " UNION ALL ".join([
        panel("residual_mean", "c_pred", "CAST(floor(Predicted / 10) * 10 AS INT)", "avg(Residual)"), panel("residual_n", "c_pred", "CAST(floor(Predicted / 10) * 10 AS INT)", "count(*)"),
        panel("risk_customers", "c_cscores WHERE Split = 'test'", "RiskSegment", "count(*)"), panel("risk_churn_rate", "c_cscores WHERE Split = 'test'", "RiskSegment", "avg(Churn)")]),
}
