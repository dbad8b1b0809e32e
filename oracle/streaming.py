"""The state a stream ends in equals an aggregate over its whole input."""

from oracle.text import rnd

SQL = {
    "stream_customer_order_counter": """SELECT c.CustomerID, c.TotalOrders + count(o.OrderID) AS TotalOrders FROM t_customers c
 LEFT JOIN t_orders o ON o.CustomerID = c.CustomerID GROUP BY c.CustomerID, c.TotalOrders""",
    "stream_city_kpi": f"""SELECT r.City, count(*) AS TotalOrders, {rnd('sum(o.FinalAmount)', 2)} AS TotalRevenue, {rnd('avg(o.DeliveryTimeMinutes)', 6)} AS AvgDeliveryTime
 FROM t_orders o JOIN t_restaurants r ON r.RestaurantID = o.RestaurantID GROUP BY 1""",
    "stream_event_counter": "SELECT user_id, count(*) AS n FROM events GROUP BY 1",
}
