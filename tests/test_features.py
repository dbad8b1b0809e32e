import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from orderlens.plans import features as ft
from orderlens.plans import kpis, star

D = dt.date


def test_nearest_traffic_equals_brute_force(spark):
    rnd = random.Random(3)
    days = [D(2024, 1, d) for d in (1, 2, 3)]
    level = ["Low", "Moderate", "High", "Severe"]
    readings = [(i, rnd.choice("AB"), rnd.choice(days), rnd.choice([f"{rnd.randrange(24):02d}:{rnd.randrange(0, 60, 20):02d}", "bad"]), rnd.choice(level), float(i))
                for i in range(60)]
    readings += [(100, "C", days[0], "bad", "Low", 1.0), (99, "C", days[0], None, "High", 2.0)]
    slots = [(rnd.choice("ABC"), rnd.choice(days), rnd.choice([None, *range(0, 1440, 10)])) for _ in range(150)]
    slots = list(dict.fromkeys(slots))
    t = {"traffic": spark.createDataFrame(readings, "TrafficID int, City string, Date date, Time string, TrafficLevel string, AverageSpeed double")}
    s = spark.createDataFrame([(*x, 1) for x in slots], "RCity string, OrderDate date, order_min int, n_orders int")

    def minute(x):
        return None if x in (None, "bad") else int(x[:2]) * 60 + int(x[3:])

    def best(city, day, m):
        c = [((99999 if m is None or minute(r[3]) is None else abs(m - minute(r[3]))), r[0], r[5]) for r in readings if r[1] == city and r[2] == day]
        return min(c)[2] if c else None

    got = {(r.RCity, r.OrderDate, r.order_min): r.AverageSpeed for r in ft.nearest_traffic(s, t).collect()}
    assert got == {k: best(*k) for k in slots}


def test_weather_ties_take_the_smallest_text(spark):
    rows = [("A", D(2024, 1, 1), 1.0, 1.0, 1, "Rainy"), ("A", D(2024, 1, 1), 3.0, 1.0, 3, "Clear")]
    t = {"weather": spark.createDataFrame(rows, "City string, Date date, Rainfall double, Temperature double, Humidity int, WeatherCondition string")}
    r = ft.weather_daily(t).first()
    assert (r.WeatherCondition, r.Rainfall, r.Humidity) == ("Clear", 2.0, 2.0)


def test_rain_bins(spark):
    df = spark.createDataFrame([(v,) for v in [0.0, 0.5, 0.51, 10.0, 50.0, 50.1]], "Rainfall double")
    assert [r.x for r in df.select(ft.rain_impact().alias("x")).collect()] == [0, 0, 1, 1, 2, 3]


def test_haversine(spark):
    from orderlens.functions import haversine_km

    r = spark.range(1).select(haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(90.0)).alias("q")).first()
    assert r.q == pytest.approx(6371 * 3.141592653589793 / 2)


def _churn_input(spark, rows):
    full = [(i, c, d, 100.0 + i, 0, 0, 0, None if i % 2 else 30, 3.0 if i else None, 7, 0) for i, (c, d) in enumerate(rows)]
    return spark.createDataFrame(full, "OrderID int, CustomerID int, OrderDate date, FinalAmount double, IsCancelled int, IsLate int, HasCoupon int, "
                                       "DeliveryTimeMinutes int, AvgRating double, RestaurantID int, WeekendOrder int")


def test_churn_windows(spark):
    cut = D(2024, 1, 31)
    day = dt.timedelta(days=1)
    base = _churn_input(spark, [(1, cut), (2, cut), (2, cut + day), (3, cut), (3, cut + 60 * day), (4, cut), (4, cut + 61 * day), (5, cut + day), (6, cut - 10 * day), (6, cut)])
    people = [(c, cut - 100 * day, 30, "Gold", "X") for c in range(1, 7)]
    t = {"customers": spark.createDataFrame(people, "CustomerID int, RegistrationDate date, Age int, Membership string, PreferredCuisine string")}
    got = {r.CustomerID: r for r in ft.churn_table(base, t, cutoff="2024-01-31").collect()}
    assert set(got) == {1, 2, 3, 4, 6}  # customer 5 has no history
    assert {c: got[c].Churn for c in got} == {1: 1, 2: 0, 3: 0, 4: 1, 6: 1}
    assert got[1].AvgGapDays == -1 and got[6].AvgGapDays == 10 and got[6].Recency == 0 and got[1].Tenure == 100
    assert all(got[c].AvgRating is not None for c in got)


def test_clv_bands(spark):
    df = spark.createDataFrame([(v,) for v in [0.0, 250.0, 250.01, 2000.0, 2000.01]], "v double")
    assert [r.x for r in df.select(star.clv_band_order(F.col("v")).alias("x")).collect()] == [1, 1, 2, 6, 7]
    assert [r.x for r in df.select(star.clv_band(F.col("v")).alias("x")).collect()] == ["0-250", "0-250", "250-500", "1500-2000", "2000+"]


def test_segments(spark):
    as_of = D(2024, 12, 31)
    ago = lambda n: as_of - dt.timedelta(days=n)
    rows = [(0, None, None), (1, ago(60), 60), (2, ago(61), 60), (2, ago(300), 180), (2, ago(300), 181)]
    df = spark.createDataFrame(rows, "Orders int, FirstOrderDate date, DaysSinceLastOrder int")
    got = [r.s for r in df.select(star.customer_segment(F.lit(as_of)).alias("s")).collect()]
    assert got == ["No orders", "New", "Active", "At-Risk", "Lapsed"]


def test_moving_average_waits_for_thirty_rows(spark):
    rows = [(D(2024, 1, 1) + dt.timedelta(days=i), float(i)) for i in range(31)]
    got = [r.avg_revenue for r in kpis.moving_average(spark.createDataFrame(rows, "OrderDate date, revenue double")).orderBy("OrderDate").collect()]
    assert got[:29] == [None] * 29 and got[29] == pytest.approx(14.5) and got[30] == pytest.approx(15.5)


def test_measures_need_a_relationship(spark):
    from orderlens.plans.measures import evaluate

    s = {"dim_customer": spark.createDataFrame([(1,)], "Orders int")}
    with pytest.raises(ValueError):
        evaluate(s, ["Customers"], ["dim_partner.City"])
    with pytest.raises(ValueError):
        evaluate(s, ["Customers", "Total Orders"])
