"""SQL counterparts of the single cleaning operators, checks and profiles."""

from orderlens.plans import quality
from oracle.text import ambiguous, cint, ct, digits, first, num, other_reading, parsed, rnd, title
from oracle.cleaning import known

CALC = f"abs({num('FoodCost')}) + {num('DeliveryFee')} - {num('Discount')} + {num('GST')}"

EXTRA = {
    "c_fb_zero": f"""SELECT SourceRow, CASE WHEN {num('CustomerRating')} <= 5 THEN {num('CustomerRating')} END AS a,
 CASE WHEN {num('DeliveryRating')} <= 5 THEN {num('DeliveryRating')} END AS b,
 CASE WHEN {num('FoodRating')} <= 5 THEN {num('FoodRating')} END AS c FROM r_customer_feedback""",
}
for src, dst, col, others in (("zero", "one", "a", "b, c"), ("one", "two", "b", "a, c"), ("two", "three", "c", "a, b")):
    EXTRA[f"c_fb_{dst}"] = (
        f"SELECT * REPLACE (round_even(coalesce({col}, list_avg(list_filter([{others}], lambda x: x IS NOT NULL)),"
        f" (SELECT median({col}) FROM c_fb_{src})), 0) AS {col}) FROM c_fb_{src}")


def _sign(c: str) -> str:
    return (
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {num(c)} < 0) AS negatives, {rnd(f'sum(abs({num(c)}))', 2)} AS total FROM r_orders")


SQL = {
    "clean_text": f"SELECT SourceRow, {ct('OrderStatus')} AS OrderStatus FROM r_orders",
    "parse_mixed_dates": f"""SELECT SourceRow, {parsed('OrderDate')} AS parsed, {ambiguous('OrderDate')} AS ambiguous,
 {other_reading('OrderDate')} AS alternative FROM r_orders""",
    "resolve_ambiguous_dates": f"""SELECT SourceRow, CASE WHEN flipped THEN d1 ELSE d0 END AS OrderDate, amb AS ambiguous, flipped FROM (
 SELECT *, coalesce(amb AND abs(date_diff('day', ref_date, d1)) < abs(date_diff('day', ref_date, d0)), FALSE) AS flipped FROM (
 SELECT o.SourceRow, {parsed('o.OrderDate')} AS d0, {ambiguous('o.OrderDate')} AS amb, {other_reading('o.OrderDate')} AS d1, p.ref_date
 FROM r_orders o LEFT JOIN (SELECT OrderID AS ref_order, CASE WHEN NOT {ambiguous('PaymentDate')} THEN {parsed('PaymentDate')} END AS ref_date
 FROM {first('r_payments', 'OrderID')}) p ON p.ref_order = o.OrderID))""",
    "to_number": f"SELECT SourceRow, {num('Age')} AS Age, {num('TotalOrders')} AS TotalOrders FROM r_customers",
    "abs_sign_fix": " UNION ALL ".join(_sign(c) for c in ("FoodCost", "DeliveryFee", "DeliveryTimeMinutes")),
    "dedupe_rows": "SELECT min(SourceRow) AS SourceRow, OrderID, count(*) - 1 AS copies FROM r_orders GROUP BY ALL"
    .replace("GROUP BY ALL", "GROUP BY OrderID, CustomerID, RestaurantID, DeliveryPartnerID, OrderDate, OrderTime, DeliveryTimeMinutes, FoodCost, "
             "DeliveryFee, Discount, CouponCode, GST, FinalAmount, OrderStatus, PaymentMethod"),
    "dedupe_key_keep_first": """SELECT OrderID, SourceRow, OrderStatus, copies FROM (SELECT *, count(*) OVER (PARTITION BY OrderID) - 1 AS copies,
 row_number() OVER (PARTITION BY OrderID ORDER BY SourceRow) AS rn FROM r_orders) WHERE rn = 1""",
    "canonical_city": "SELECT CustomerID, CASE WHEN CustomerID % 4 = 3 AND CustomerID % 9 = 0 THEN NULL ELSE City END AS City FROM t_customers",
    "impute_group_median": f"""SELECT SourceRow, {rnd(f"coalesce({num('Rainfall')}, median({num('Rainfall')}) OVER (PARTITION BY {ct('WeatherCondition')}))", 6)} AS Rainfall FROM r_weather""",
    "impute_global_median": f"SELECT SourceRow, {rnd(f'''coalesce({num('FinalAmount')}, median({num('FinalAmount')}) OVER ())''', 6)} AS FinalAmount FROM r_orders",
    "impute_constant": f"SELECT SourceRow, coalesce({ct('Gender')}, 'Unknown') AS Gender, coalesce({ct('Membership')}, 'Unknown') AS Membership FROM r_customers",
    "impute_row_mean": "SELECT SourceRow, a AS CustomerRating, b AS DeliveryRating, c AS FoodRating FROM c_fb_three",
    "invalidate_range": f"""SELECT SourceRow, CASE WHEN abs({num('DeliveryTimeMinutes')}) > 0 AND abs({num('DeliveryTimeMinutes')}) <= 180
 THEN abs({num('DeliveryTimeMinutes')}) END AS DeliveryTimeMinutes FROM r_orders""",
    "validate_pattern": f"SELECT SourceRow, {digits('Phone', 10)} AS Phone, {digits('Pincode', 6, True)} AS Pincode FROM r_customers",
    "cap_iqr": f"""WITH v AS (SELECT SourceRow, abs({num('AverageDeliveryTime')}) AS x FROM r_delivery_partners),
 q AS (SELECT quantile_cont(x, 0.25) AS q1, quantile_cont(x, 0.75) AS q3 FROM v)
 SELECT SourceRow, {rnd('greatest(least(x, (SELECT q3 + 3 * (q3 - q1) FROM q)), (SELECT q1 - 3 * (q3 - q1) FROM q))', 6)} AS AverageDeliveryTime,
 x > (SELECT q3 + 3 * (q3 - q1) FROM q) OR x < (SELECT q1 - 3 * (q3 - q1) FROM q) AS outlier FROM v""",
    "cap_percentile": f"""WITH v AS (SELECT SourceRow, {num('Rainfall')} AS x, {num('Temperature')} AS y FROM r_weather),
 q AS (SELECT quantile_cont(x, 0.99) AS qx, quantile_cont(y, 0.995) AS qy FROM v)
 SELECT SourceRow, CASE WHEN x IS NOT NULL THEN {rnd('least(x, (SELECT qx FROM q))', 6)} END AS Rainfall,
 {rnd('least(y, (SELECT qy FROM q))', 6)} AS Temperature FROM v""",
    "clip_constant": f"SELECT SourceRow, least(abs({num('Humidity')}), 100.0::DOUBLE) AS Humidity FROM r_weather",
    "swap_reversed_dates": f"""SELECT SourceRow, least({parsed('StartDate')}, {parsed('EndDate')}) AS StartDate,
 greatest({parsed('StartDate')}, {parsed('EndDate')}) AS EndDate, {parsed('EndDate')} < {parsed('StartDate')} AS swapped FROM r_promotions""",
    "fill_city_blocks": f"""SELECT WeatherID, coalesce(city0, above) AS City, coalesce(city0 IS NULL AND above = below, FALSE) AS recovered FROM (
 SELECT *, last_value(city0 IGNORE NULLS) OVER (ORDER BY WeatherID ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS above,
 first_value(city0 IGNORE NULLS) OVER (ORDER BY WeatherID ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS below
 FROM (SELECT CAST(WeatherID AS BIGINT) AS WeatherID, upper({ct('City')}) AS city0 FROM r_weather))""",
    "infer_nearest_class": f"""WITH v AS (SELECT SourceRow, TrafficLevel AS l, abs({num('AverageSpeed')}) AS x FROM r_traffic),
 k AS (SELECT l AS name, median(x) AS m FROM v WHERE l IS NOT NULL GROUP BY 1)
 SELECT SourceRow, coalesce(l, (SELECT k.name FROM k ORDER BY abs(k.m - v.x), k.name LIMIT 1)) AS TrafficLevel FROM v""",
    "recompute_amount": f"SELECT SourceRow, {rnd(f'''coalesce({num('FinalAmount')}, {CALC})''', 2)} AS FinalAmount FROM r_orders",
    "drop_orphans": """SELECT o.OrderID, o.RestaurantID FROM t_orders_all o JOIN t_customers c USING (CustomerID)
 JOIN t_restaurants r ON r.RestaurantID = o.RestaurantID JOIN t_delivery_partners p USING (DeliveryPartnerID)""",
    "null_unknown_fk": f"""SELECT SourceRow, CASE WHEN upper({ct('CouponCode')}) IN (SELECT upper({ct('CouponCode')}) FROM r_promotions)
 THEN upper({ct('CouponCode')}) END AS CouponCode FROM r_orders""",
    "best_status_row": """SELECT OrderID, PaymentID, PaymentStatus FROM t_payments_all QUALIFY row_number() OVER (PARTITION BY OrderID ORDER BY
 CASE PaymentStatus WHEN 'Success' THEN 0 WHEN 'Refunded' THEN 1 WHEN 'Pending' THEN 2 WHEN 'Failed' THEN 3 ELSE 4 END, PaymentID DESC) = 1""",
    "upper_code": f"SELECT SourceRow, upper({ct('CouponCode')}) AS CouponCode FROM r_promotions",
    "title_case": f"SELECT SourceRow, {title(ct('City'))} AS City FROM r_cities",
    "truncate_time": "SELECT SourceRow, substr(Time, 1, 5) AS Time FROM r_traffic",
    "profile_patterns": """SELECT regexp_replace(regexp_replace(OrderDate, '\\d', '9', 'g'), '[A-Za-z]', 'a', 'g') AS shape, count(*) AS n FROM r_orders GROUP BY 1""",
    "check_sign_flip": f"""SELECT {num('FoodCost')} < 0 AS negative, count(*) AS n, count(*) FILTER (WHERE abs({CALC} - {num('FinalAmount')}) < 1e-6) AS formula_holds
 FROM r_orders WHERE {num('FinalAmount')} IS NOT NULL GROUP BY 1""",
    "ambiguous_date_share": f"""SELECT count(*) FILTER (WHERE {ambiguous('OrderDate')}) AS ambiguous,
 {rnd(f"avg(CASE WHEN {ambiguous('OrderDate')} THEN 1.0 ELSE 0.0 END)", 6)} AS share FROM r_orders""",
}

# ------------------------------------------------------------ checks
_pk = [f"SELECT '{t}.{k} unique' AS check_name, count(*) = count(DISTINCT {k}) AS passed FROM t_{t}" for t, k in quality.PRIMARY_KEYS.items()]
_fk = [
    f"""SELECT '{c}.{cc} in {p}.{pc}' AS check_name, count(*) = 0 AS passed FROM t_{c} x
 WHERE x.{cc} IS NOT NULL AND x.{cc} NOT IN (SELECT {pc} FROM t_{p})""" for c, cc, p, pc in quality.FOREIGN_KEYS]
_rg = [f"SELECT '{n}' AS check_name, count(*) FILTER (WHERE NOT coalesce({cond}, FALSE)) = 0 AS passed FROM t_{t}" for t, n, cond in quality.RANGES]
SQL["check_pk_unique"] = " UNION ALL ".join(_pk)
SQL["check_fk"] = " UNION ALL ".join(_fk)
SQL["check_ranges"] = " UNION ALL ".join(_rg)
SQL["validation_report"] = " UNION ALL ".join(_pk + _fk + _rg)
SQL["check_ddl_constraints"] = " UNION ALL ".join(
    [f"SELECT '{t}' AS table_name, '{r}' AS rule, count(*) FILTER (WHERE NOT ({r})) AS violations FROM t_{t}" for t, r in quality.CONSTRAINTS]
    + [f"SELECT '{t}', '{c} UNIQUE', (SELECT count(*) FROM (SELECT {c} FROM t_{t} GROUP BY 1 HAVING count(*) > 1))" for t, c in quality.UNIQUE])

# ------------------------------------------------------------ files
from orderlens.plans.cleaning import COLUMNS  # noqa: E402

_NA = "('', 'nan', 'NaN', 'None', 'NULL', 'null', 'NA', 'N/A')"


def _read(c: str) -> str:
    return f"CASE WHEN ltrim({c}) IN {_NA} THEN NULL ELSE ltrim({c}) END AS {c}"


SQL["read_raw_text"] = "SELECT " + ", ".join(_read(c) for c in COLUMNS["customers"]) + " FROM r_customers"
SQL["read_raw_all"] = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM r_{t}" for t in COLUMNS)
SQL["read_clean"] = "SELECT OrderID, OrderDate, DeliveryTimeMinutes, FinalAmount, CouponCode FROM t_orders"
SQL["bulk_load_relational"] = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS n FROM t_{t}" for t in COLUMNS)


def _profile(t: str) -> str:
    cols = COLUMNS[t]
    dup = f"(SELECT count(*) FROM r_{t}) - (SELECT count(*) FROM (SELECT DISTINCT {', '.join(cols)} FROM r_{t}))"
    return " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, (SELECT count(*) FROM r_{t}) AS rows, {dup} AS duplicates, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM r_{t}"
        for c in cols)


SQL["profile_tables"] = " UNION ALL ".join(_profile(t) for t in COLUMNS)
