"""SQL counterparts of the query bank."""

from oracle.text import rnd

JOINED = "t_orders o JOIN t_restaurants r ON r.RestaurantID = o.RestaurantID"
REV = f"""SELECT r.RestaurantID, r.RestaurantName, r.City, {rnd('SUM(o.FinalAmount)', 2)} AS total_revenue
 FROM {JOINED} WHERE o.OrderStatus = 'Delivered' GROUP BY ALL"""

SQL = {
    "a1_top_restaurants_revenue": f"""SELECT r.RestaurantID, r.RestaurantName, r.City, {rnd('SUM(o.FinalAmount)', 2)} AS total_revenue,
 COUNT(o.OrderID) AS total_orders FROM {JOINED}
 WHERE o.OrderDate >= DATE '2001-08-01' - INTERVAL 6 MONTH AND o.OrderStatus = 'Delivered'
 GROUP BY 1, 2, 3 ORDER BY total_revenue DESC, 1 LIMIT 10""",
    "a2_avg_delivery_by_city": f"""SELECT r.City, {rnd('AVG(o.DeliveryTimeMinutes)', 2)} AS avg_delivery_time, COUNT(*) AS order_count
 FROM {JOINED} WHERE o.DeliveryTimeMinutes IS NOT NULL GROUP BY 1""",
    "a3_cuisine_having": f"""SELECT r.Cuisine, COUNT(o.OrderID) AS delivered_orders, {rnd('AVG(r.Rating)', 2)} AS avg_cuisine_rating
 FROM {JOINED} WHERE o.OrderStatus = 'Delivered' GROUP BY 1 HAVING COUNT(o.OrderID) > 100 AND AVG(r.Rating) > 3.0""",
    "a4_cancel_rate_by_cuisine": f"""SELECT r.Cuisine, COUNT(*) FILTER (WHERE o.OrderStatus = 'Cancelled') AS cancelled_orders,
 COUNT(*) AS total_orders, {rnd("100.0 * COUNT(*) FILTER (WHERE o.OrderStatus = 'Cancelled') / COUNT(*)", 2)} AS cancellation_rate_pct
 FROM {JOINED} GROUP BY 1""",
    "b1_order_names": f"""SELECT o.OrderID, c.Name AS customer_name, r.RestaurantName, o.FinalAmount, o.OrderStatus
 FROM {JOINED} JOIN t_customers c ON c.CustomerID = o.CustomerID ORDER BY 1 LIMIT 100""",
    "b2_restaurant_feedback_left": f"""SELECT r.RestaurantID, r.RestaurantName, COUNT(f.FeedbackID) AS feedback_count,
 {rnd('AVG(f.CustomerRating)', 2)} AS avg_customer_rating
 FROM t_restaurants r LEFT JOIN t_orders o ON o.RestaurantID = r.RestaurantID
 LEFT JOIN t_customer_feedback f ON f.OrderID = o.OrderID GROUP BY 1, 2""",
    "b3_payment_right": """SELECT p.PaymentID, p.OrderID, p.PaymentStatus, o.FinalAmount, o.OrderStatus
 FROM t_orders o RIGHT JOIN t_payments p ON p.OrderID = o.OrderID ORDER BY 1 LIMIT 100""",
    "b4_partner_pairs_self": """SELECT a.DeliveryPartnerID AS partner_a, b.DeliveryPartnerID AS partner_b, a.City,
 a.AverageDeliveryTime AS a_avg_time, b.AverageDeliveryTime AS b_avg_time
 FROM t_delivery_partners a JOIN t_delivery_partners b ON a.City = b.City AND a.DeliveryPartnerID < b.DeliveryPartnerID
 WHERE ABS(a.AverageDeliveryTime - b.AverageDeliveryTime) > 20 ORDER BY 1, 2 LIMIT 100""",
    "b5_attention_union": """SELECT RestaurantID AS entity_id, RestaurantName AS entity_name, 'Restaurant' AS entity_type, Rating
 FROM t_restaurants WHERE Rating < 3.0 UNION
 SELECT DeliveryPartnerID, Name, 'DeliveryPartner', Rating FROM t_delivery_partners WHERE Rating < 3.0""",
    "c1_delivery_tier": """SELECT OrderID, DeliveryTimeMinutes, CASE WHEN DeliveryTimeMinutes IS NULL THEN 'Unknown'
 WHEN DeliveryTimeMinutes <= 20 THEN 'Fast' WHEN DeliveryTimeMinutes <= 40 THEN 'On Time'
 WHEN DeliveryTimeMinutes <= 60 THEN 'Delayed' ELSE 'Severely Delayed' END AS delivery_tier FROM t_orders""",
    "c2_value_segment": f"""SELECT c.CustomerID, c.Name, {rnd('SUM(o.FinalAmount)', 2)} AS lifetime_spend,
 CASE WHEN SUM(o.FinalAmount) >= 3000000 THEN 'Platinum' WHEN SUM(o.FinalAmount) >= 2000000 THEN 'Gold'
 WHEN SUM(o.FinalAmount) >= 1000000 THEN 'Silver' ELSE 'Bronze' END AS value_segment
 FROM t_customers c JOIN t_orders o ON o.CustomerID = c.CustomerID GROUP BY 1, 2""",
    "d1_above_avg_cost": """SELECT RestaurantID, RestaurantName, AverageCost FROM t_restaurants
 WHERE AverageCost > (SELECT AVG(AverageCost) FROM t_restaurants)""",
    "d2_last_order_cancelled": """SELECT c.CustomerID, c.Name FROM t_customers c WHERE (SELECT o.OrderStatus FROM t_orders o
 WHERE o.CustomerID = c.CustomerID ORDER BY o.OrderDate DESC, o.OrderTime DESC, o.OrderID DESC LIMIT 1) = 'Cancelled'""",
    "d3_monthly_city_revenue_lag": f"""WITH m AS (SELECT r.City, CAST(DATE_TRUNC('month', o.OrderDate) AS DATE) AS order_month,
 {rnd('SUM(o.FinalAmount)', 2)} AS revenue FROM {JOINED} WHERE o.OrderStatus = 'Delivered' GROUP BY 1, 2)
 SELECT City, order_month, revenue, LAG(revenue) OVER (PARTITION BY City ORDER BY order_month) AS prev_month_revenue FROM m""",
    "d4_repeat_segment": """SELECT CASE WHEN n = 1 THEN 'One-Time' ELSE 'Repeat' END AS segment, COUNT(*) AS num_customers
 FROM (SELECT CustomerID, COUNT(*) AS n FROM t_orders GROUP BY 1) GROUP BY 1""",
    "e1_rank_in_city": f"""SELECT *, ROW_NUMBER() OVER (PARTITION BY City ORDER BY total_revenue DESC, RestaurantID) AS row_num,
 RANK() OVER (PARTITION BY City ORDER BY total_revenue DESC) AS rank_num,
 DENSE_RANK() OVER (PARTITION BY City ORDER BY total_revenue DESC) AS dense_rank_num FROM ({REV})""",
    "e2_top3_per_city": f"""SELECT * FROM (SELECT *, RANK() OVER (PARTITION BY City ORDER BY total_revenue DESC) AS city_rank
 FROM ({REV})) WHERE city_rank <= 3""",
    "e3_order_lag_lead": f"""SELECT CustomerID, OrderDate, FinalAmount, LAG(FinalAmount) OVER w AS previous_order_amount,
 LEAD(FinalAmount) OVER w AS next_order_amount, {rnd('FinalAmount - LAG(FinalAmount) OVER w', 2)} AS change_vs_previous
 FROM t_orders WHERE OrderStatus = 'Delivered' WINDOW w AS (PARTITION BY CustomerID ORDER BY OrderDate, OrderID)""",
    "e4_recency_rank": """SELECT CustomerID, MAX(OrderDate) AS last_order_date, DATE '2001-08-01' - MAX(OrderDate) AS days_since_last_order,
 RANK() OVER (ORDER BY MAX(OrderDate)) AS recency_rank FROM t_orders GROUP BY 1""",
    "f1_order_base_view": f"""SELECT o.OrderID, o.CustomerID, o.RestaurantID, o.DeliveryPartnerID, o.OrderDate, o.OrderTime,
 o.DeliveryTimeMinutes, o.FinalAmount, o.OrderStatus, c.City AS customer_city, r.City AS restaurant_city, r.Cuisine,
 r.Rating AS restaurant_rating, dp.VehicleType, dp.Rating AS partner_rating
 FROM {JOINED} JOIN t_customers c ON c.CustomerID = o.CustomerID
 JOIN t_delivery_partners dp ON dp.DeliveryPartnerID = o.DeliveryPartnerID""",
    "f2_restaurant_scorecard_view": f"""SELECT r.RestaurantID, r.RestaurantName, r.City, r.Rating, COUNT(o.OrderID) AS total_orders,
 COUNT(*) FILTER (WHERE o.OrderStatus = 'Cancelled') AS cancelled_orders,
 {rnd("100.0 * COUNT(*) FILTER (WHERE o.OrderStatus = 'Cancelled') / NULLIF(COUNT(o.OrderID), 0)", 2)} AS cancellation_rate_pct,
 {rnd('AVG(o.DeliveryTimeMinutes)', 2)} AS avg_delivery_time
 FROM t_restaurants r LEFT JOIN t_orders o ON o.RestaurantID = r.RestaurantID GROUP BY 1, 2, 3, 4""",
    "g1_orders_by_weekday": f"""SELECT dayname(OrderDate) AS day_of_week, COUNT(*) AS order_count,
 {rnd('SUM(FinalAmount)', 2)} AS total_revenue FROM t_orders GROUP BY 1""",
    "g2_quarter_revenue": f"""SELECT EXTRACT(YEAR FROM OrderDate) AS order_year, EXTRACT(QUARTER FROM OrderDate) AS order_quarter,
 {rnd('SUM(FinalAmount)', 2)} AS revenue FROM t_orders WHERE OrderStatus = 'Delivered' GROUP BY 1, 2""",
    "g3_tenure_days": """SELECT CustomerID, RegistrationDate, DATE '2001-08-01' - RegistrationDate AS tenure_days FROM t_customers""",
    "h1_delivery_by_weather": f"""SELECT w.WeatherCondition, {rnd('AVG(o.DeliveryTimeMinutes)', 2)} AS avg_delivery_time, COUNT(*) AS order_count
 FROM {JOINED} JOIN t_weather w ON w.City = r.City AND w.Date = o.OrderDate GROUP BY 1""",
    "h2_delivery_by_traffic": f"""SELECT t.TrafficLevel, {rnd('AVG(o.DeliveryTimeMinutes)', 2)} AS avg_delivery_time, COUNT(*) AS order_count
 FROM {JOINED} JOIN t_traffic t ON t.City = r.City AND t.Date = o.OrderDate GROUP BY 1""",
    "h3_coupon_performance": f"""SELECT p.CampaignName, p.CouponCode, COUNT(o.OrderID) AS orders_using_coupon,
 {rnd('SUM(o.Discount)', 2)} AS total_discount_value, {rnd('SUM(o.FinalAmount)', 2)} AS revenue_from_coupon_orders
 FROM t_promotions p JOIN t_orders o ON o.CouponCode = p.CouponCode GROUP BY 1, 2""",
    "h4_partner_top_decile": """SELECT * FROM (SELECT DeliveryPartnerID, Name, City, Rating, CompletedDeliveries,
 NTILE(10) OVER (ORDER BY CompletedDeliveries DESC, Rating DESC, DeliveryPartnerID) AS decile FROM t_delivery_partners) WHERE decile = 1""",
    "i1_city_kpi_refresh": f"""SELECT r.City, COUNT(o.OrderID) AS TotalOrders, {rnd('SUM(o.FinalAmount)', 2)} AS TotalRevenue,
 {rnd('AVG(o.DeliveryTimeMinutes)', 2)} AS AvgDeliveryTime FROM {JOINED} GROUP BY 1""",
    "audit_orphans": """SELECT 'orders without customer' AS check_name, COUNT(*) AS n FROM t_orders_all o LEFT JOIN t_customers c USING (CustomerID) WHERE c.Name IS NULL
 UNION ALL SELECT 'orders without restaurant', COUNT(*) FROM t_orders_all o LEFT JOIN t_restaurants r USING (RestaurantID) WHERE r.RestaurantName IS NULL
 UNION ALL SELECT 'payments without order', COUNT(*) FROM t_payments p LEFT JOIN t_orders_all o USING (OrderID) WHERE o.CustomerID IS NULL
 UNION ALL SELECT 'rows in orders', COUNT(*) FROM t_orders_all""",
}
