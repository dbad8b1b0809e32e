"""KPI tables, chart data and dashboard data over the order base table ``b``."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.constants import NOT_DELIVERED
from orderlens.functions import rate, ratio
from orderlens.operators import selection
from orderlens.operators.blocks import percentiles
from orderlens.plans.measures import evaluate
from orderlens.session import materialise

# The columns of the correlation chart.
CORR_COLUMNS = (
    "FinalAmount", "FoodCost", "DeliveryFee", "Discount", "DeliveryTimeMinutes", "TrafficScore", "RainImpact", "Rainfall", "Temperature",
    "BasketSize", "DistanceProxyKm", "DeliveryEfficiency", "PartnerRating", "RestaurantRating", "CustomerTenure", "PeakHour", "WeekendOrder",
)

# sums of money, shown with two decimals
MONEY = ("Total Revenue", "Revenue PM", "Restaurant Revenue", "Total Discount", "revenue")


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def _shown(name: str) -> Column:
    return F.round(F.col(f"`{name}`").cast("double"), 2 if name in MONEY else 6).alias(name)


def completed(b: DataFrame) -> DataFrame:
    return b.filter("IsDelivered")


def _pct(flag: Column) -> Column:
    return rate(flag) * 100


def _long(df: DataFrame, chart: str, label, value) -> DataFrame:
    return df.select(F.lit(chart).alias("chart"), F.col(label).cast("string").alias("label"), F.col(value).cast("double").alias("value"))


# ------------------------------------------------------------------- KPIs
def orders_per_customer(b: DataFrame) -> DataFrame:
    return b.groupBy("CustomerID").agg(F.count("OrderID").alias("n"))


def kpi_headline(b: DataFrame) -> DataFrame:
    done, m = F.col("IsDelivered"), F.when(F.col("IsDelivered"), F.col("DeliveryTimeMinutes"))
    people = orders_per_customer(b)
    # minutes are whole numbers up to 180, so exact percentiles keep small buffers
    return b.agg(
        F.count(F.lit(1)).alias("orders_total"), F.count_distinct("RestaurantID").alias("restaurants_with_orders"),
        F.sum(F.when(done, F.col("FinalAmount"))).alias("revenue"), F.avg(F.when(done, F.col("FinalAmount"))).alias("avg_order_value"),
        F.count_if(done).alias("completed_orders"), (F.avg("IsCancelled") * 100).alias("cancelled_pct"),
        _pct(F.col("OrderStatus") == NOT_DELIVERED).alias("food_not_delivered_pct"),
        (F.avg(F.when(done, F.col("IsLate"))) * 100).alias("late_pct_of_completed"), F.avg(m).alias("avg_delivery_min"),
        F.percentile(m, 0.5).alias("median_delivery_min"), F.percentile(m, 0.9).alias("p90_delivery_min"),
        F.percentile(m, 0.95).alias("p95_delivery_min"), F.avg("AvgRating").alias("avg_feedback_rating"),
        (F.avg("WeekendOrder") * 100).alias("weekend_orders_pct"), (F.avg("HasCoupon") * 100).alias("coupon_usage_pct"),
        (F.avg(F.when(F.col("HasCoupon") == 1, F.col("DiscountPct"))) * 100).alias("avg_discount_pct_when_coupon"),
        _pct(F.coalesce(F.col("PaymentStatus") == "Failed", F.lit(False))).alias("payment_failed_pct"),
    ).withColumns({
        "customers_with_orders": people.select(F.count(F.lit(1))).scalar(),
        "one_time_customers_pct": people.select(_pct(F.col("n") == 1)).scalar()})


def _best(df: DataFrame, by: str, value: Column) -> DataFrame:
    return df.filter(F.col(by).isNotNull()).groupBy(by).agg(value.alias("v")).orderBy(F.desc("v"), by).limit(1)


def kpi_argmax(b: DataFrame) -> DataFrame:
    money = F.round(F.sum("FinalAmount"), 2)
    parts = [("top_city", _best(completed(b), "RCity", money), "RCity"), ("top_cuisine", _best(completed(b), "Cuisine", money), "Cuisine"),
             ("peak_hour", _best(b, "hour", F.count(F.lit(1))), "hour")]
    return union([d.select(F.lit(k).alias("kpi"), F.col(c).cast("string").alias("winner"), F.col("v").cast("double").alias("value")) for k, d, c in parts])


def kpi_breakdowns(b: DataFrame) -> DataFrame:
    c = completed(b)

    def by(d, name, key, value, digits):
        g = d.filter(F.col(key).isNotNull()).groupBy(key).agg(F.round(value, digits).alias("v"))
        return _long(g, name, key, "v")

    return union([
        by(c, "avg_basket_by_membership", "Membership", F.avg("FinalAmount"), 1),
        by(c, "delivery_time_by_traffic", "TrafficScore", F.avg("DeliveryTimeMinutes"), 2),
        by(c, "delivery_time_by_rain", "RainImpact", F.avg("DeliveryTimeMinutes"), 2),
        by(c, "late_pct_by_traffic", "TrafficScore", F.avg("IsLate") * 100, 2),
        by(b, "cancel_pct_by_weather", "WeatherCondition", F.avg("IsCancelled") * 100, 2),
        by(b, "cancel_pct_by_payment", "PaymentMethod", F.avg("IsCancelled") * 100, 2),
        by(b, "cancel_pct_by_cuisine", "Cuisine", F.avg("IsCancelled") * 100, 2),
    ])


def kpi_join_rates(b: DataFrame) -> DataFrame:
    return b.agg(F.avg("HasWeather").alias("weather_join_rate"), F.avg("HasTraffic").alias("traffic_join_rate"))


def _top(d: DataFrame, chart: str, label: str, value: Column, n: int | None) -> DataFrame:
    g = d.groupBy(label).agg(value.alias("v")).orderBy(F.desc("v"), label)
    return _long(g.limit(n) if n else g, chart, label, "v")


def kpi_top5(b: DataFrame) -> DataFrame:
    money = F.round(F.sum("FinalAmount"), 0)
    return union([_top(completed(b), f"revenue_by_{k}", c, money, 5) for k, c in (("city", "RCity"), ("cuisine", "Cuisine"))])


def kpi_correlation(b: DataFrame) -> DataFrame:
    return b.agg(F.corr("IsCancelled", "TrafficScore").alias("cancel_vs_traffic_corr"))


def two_sample_z(b: DataFrame) -> DataFrame:
    """Difference of two means over its standard error (unequal variances)."""
    d = completed(b).filter("DeliveryTimeMinutes is not null")

    def one(name, high, low):
        y = F.col("DeliveryTimeMinutes")
        hi, lo = F.when(high, y), F.when(low, y)
        g = d.agg(F.avg(hi).alias("ma"), F.var_samp(hi).alias("va"), F.count(hi).alias("na"),
                  F.avg(lo).alias("mb"), F.var_samp(lo).alias("vb"), F.count(lo).alias("nb"))
        diff = F.col("ma") - F.col("mb")
        return g.select(F.lit(name).alias("test"), diff.alias("diff"),
                        F.try_divide(diff, F.sqrt(F.col("va") / F.col("na") + F.col("vb") / F.col("nb"))).alias("z"))

    t, r = F.col("TrafficScore"), F.col("RainImpact")
    return union([one("traffic_high_vs_low", t >= 3, t <= 2), one("rain_heavy_vs_light", r >= 2, r <= 1)])


def kpi_document(b: DataFrame) -> DataFrame:
    """One row: the headline numbers, and each breakdown as a map."""
    maps = union([kpi_breakdowns(b), kpi_top5(b)]).groupBy("chart").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct("label", "value")))).alias("m"))
    all_maps = maps.agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("chart", F.to_json("m").alias("j"))))).alias("b"))
    return kpi_headline(b).withColumn("breakdowns", all_maps.scalar())


# ------------------------------------------------------------ chart data
def chart_rank_bars(b: DataFrame, t) -> DataFrame:
    c, money = completed(b), F.round(F.sum("FinalAmount"), 2)
    used = b.filter("HasCoupon = 1").join(t["promotions"].select("CouponCode", "CampaignName"), "CouponCode")
    return union([
        _top(c, "revenue_by_city", "RCity", money, 12), _top(c, "orders_by_cuisine", "Cuisine", F.count("OrderID"), 12),
        _top(c, "revenue_by_restaurant", "RestaurantName", money, 10),
        _top(used, "discount_by_campaign", "CampaignName", F.round(F.sum("Discount"), 2), None),
    ])


def chart_monthly(b: DataFrame) -> DataFrame:
    month = F.trunc("OrderDate", "month").alias("month")
    done = F.col("IsDelivered")
    return b.groupBy(month, "OrderStatus").agg(
        F.count(F.lit(1)).alias("orders"), F.round(F.sum(F.when(done, F.col("FinalAmount"))), 2).alias("revenue"),
        F.round(F.avg(F.when(done, F.col("DeliveryTimeMinutes"))), 6).alias("avg_delivery_time"))


def daily_revenue(b: DataFrame) -> DataFrame:
    return completed(b).groupBy("OrderDate").agg(F.sum("FinalAmount").alias("revenue"))


def chart_cumulative_revenue(b: DataFrame) -> DataFrame:
    w = Window.partitionBy(F.lit(0)).orderBy("OrderDate").rowsBetween(Window.unboundedPreceding, 0)  # one row per day
    return daily_revenue(b).select("OrderDate", F.round(F.sum("revenue").over(w), 2).alias("cumulative"))


def _share(d: DataFrame, chart: str, label: str) -> DataFrame:
    g = d.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(F.lit(0))  # one row per category
    return g.select(F.lit(chart).alias("chart"), F.col(label).alias("label"), "n", F.round(ratio(F.col("n"), F.sum("n").over(w)), 6).alias("share"))


def chart_shares(b: DataFrame) -> DataFrame:
    kind = orders_per_customer(b).select(F.when(F.col("n") > 1, "Repeat").otherwise("One-time").alias("kind"))
    return union([_share(b, "payment_method", "PaymentMethod"), _share(b, "order_status", "OrderStatus"), _share(kind, "customers", "kind")])


def chart_counts(b: DataFrame) -> DataFrame:
    def n(name, key, extra=F.lit("")):
        g = b.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("label"), extra.alias("hue")).agg(F.count(F.lit(1)).alias("n"))
        return g.select(F.lit(name).alias("chart"), "label", "hue", "n")

    by_sentiment = n("sentiment_by_status", "OrderStatus", F.col("Sentiment")).filter("hue is not null")
    return union([n("status", "OrderStatus"), n("payment_method", "PaymentMethod"), by_sentiment])


def _names(d: DataFrame, key: str, value: Column, n: int) -> list[str]:
    """The n largest categories: at most n short names reach the driver."""
    return [r[0] for r in d.filter(F.col(key).isNotNull()).groupBy(key).agg(value.alias("v")).orderBy(F.desc("v"), key).limit(n).collect()]


def city_by_cuisine(b: DataFrame, cities: int, cuisines: int, cuisine_by: str = "count") -> DataFrame:
    """Revenue of the top cities by the top cuisines, one row per cell."""
    c, money = completed(b), F.round(F.sum("FinalAmount"), 2)
    top_c = _names(c, "RCity", money, cities)
    top_q = _names(c, "Cuisine", F.count(F.lit(1)) if cuisine_by == "count" else money, cuisines)
    wide = c.filter(F.col("RCity").isin(top_c)).groupBy("RCity").pivot("Cuisine", top_q).agg(money).fillna(0.0)
    return wide.unpivot("RCity", top_q, "Cuisine", "revenue")


def payment_by_status(b: DataFrame) -> DataFrame:
    """Orders by method and status, every status that occurs; NULL is a status of its own."""
    return b.groupBy("PaymentMethod", "PaymentStatus").agg(F.count(F.lit(1)).alias("orders"))


def weekday_by_hour(b: DataFrame) -> DataFrame:
    wide = b.groupBy("dow").pivot("hour", list(range(24))).agg(F.count(F.lit(1))).fillna(0)
    return wide.select("dow", *[F.col(str(h)).alias(f"h{h}") for h in range(24)])


def chart_pivots(b: DataFrame) -> DataFrame:
    """All four pivots in long form."""
    def long(d, chart, row):
        cols = [c for c in d.columns if c != row]
        u = d.withColumns({c: F.col(c).cast("double") for c in cols}).unpivot(row, cols, "col", "value")
        return u.select(F.lit(chart).alias("chart"), F.col(row).cast("string").alias("row"), "col", "value")

    cells = [city_by_cuisine(b, 8, 6).select(F.lit("city_cuisine_8x6").alias("chart"), F.col("RCity").alias("row"), F.col("Cuisine").alias("col"), F.col("revenue").alias("value")),
             city_by_cuisine(b, 12, 10, "revenue").select(F.lit("city_cuisine_12x10").alias("chart"), F.col("RCity").alias("row"), F.col("Cuisine").alias("col"), F.col("revenue").alias("value"))]
    paid = payment_by_status(b).select(F.lit("payment_status").alias("chart"), F.col("PaymentMethod").alias("row"), F.col("PaymentStatus").alias("col"), F.col("orders").cast("double").alias("value"))
    return union([*cells, paid, long(weekday_by_hour(b), "weekday_hour", "dow")])


def chart_orders_per_day_by_hour(b: DataFrame) -> DataFrame:
    d = b.withColumn("day_type", F.when(F.col("WeekendOrder") == 1, "Weekend").otherwise("Weekday"))
    n = d.groupBy("hour", "day_type").agg(F.count(F.lit(1)).alias("n"))
    days = d.groupBy("day_type").agg(F.count_distinct("OrderDate").alias("days"))
    return n.join(days, "day_type").select("hour", "day_type", F.round(ratio(F.col("n"), F.col("days")), 6).alias("orders_per_day"))


def chart_rates(b: DataFrame) -> DataFrame:
    """Cancel rate with a normal 95 % interval."""
    def by(name, key):
        half = 1.96 * F.stddev_samp("IsCancelled") / F.sqrt(F.count(F.lit(1)))
        g = b.filter(F.col(key).isNotNull()).groupBy(F.col(key).alias("label")).agg(F.avg("IsCancelled").alias("rate"), half.alias("half_width"))
        return g.select(F.lit(name).alias("chart"), "label", F.round("rate", 6).alias("rate"), F.round("half_width", 6).alias("half_width"))

    return union([by("cuisine", "Cuisine"), by("weather", "WeatherCondition")])


def chart_mean_sem(b: DataFrame) -> DataFrame:
    y = "DeliveryTimeMinutes"
    return completed(b).groupBy("TrafficScore").agg(
        F.round(F.avg(y), 6).alias("mean"), F.round(1.96 * F.stddev_samp(y) / F.sqrt(F.count(y)), 6).alias("half_width"))


def chart_avg_basket(b: DataFrame) -> DataFrame:
    return completed(b).groupBy("Membership").agg(F.round(F.avg("FinalAmount"), 6).alias("avg_amount"))


def histogram(d: DataFrame, col: str, chart: str, bins: int = 40) -> DataFrame:
    v = d.select(F.col(col).cast("double").alias("v")).filter("v is not null")
    lo, hi = v.select(F.min("v")).scalar(), v.select(F.max("v")).scalar()
    # a constant column fills one bin
    place = F.coalesce(F.floor(F.try_divide(F.col("v") - lo, hi - lo) * bins), F.lit(0))
    n = v.groupBy(F.least(place, F.lit(bins - 1)).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return n.select(F.lit(chart).alias("chart"), "bin", F.round(lo + (hi - lo) / bins * F.col("bin"), 6).alias("left_edge"), "n")


def chart_histogram(b: DataFrame, customers: DataFrame) -> DataFrame:
    c = completed(b)
    return union([histogram(c, "FinalAmount", "order_value"), histogram(c, "DeliveryTimeMinutes", "delivery_time"),
                  histogram(customers.filter("Orders > 0"), "CLV", "clv")])


# Chart, group and value of each box plot
BOXES = {
    "time_by_vehicle": ("VehicleType", "DeliveryTimeMinutes"), "amount_by_membership": ("Membership", "FinalAmount"),
    "time_by_rain": ("RainImpact", "DeliveryTimeMinutes"), "time_by_city": ("RCity", "DeliveryTimeMinutes"),
}


def box_stats(d: DataFrame, boxes: dict[str, tuple[str, str]]) -> DataFrame:
    """Quartiles and the outermost values within 1.5 interquartile ranges; all charts from one stack of values."""
    entries = [F.struct(F.lit(chart).alias("chart"), F.col(key).cast("string").alias("label"), F.col(col).cast("double").alias("v")) for chart, (key, col) in boxes.items()]
    v = d.select(F.explode(F.array(*entries)).alias("e")).select("e.*").where("v is not null and label is not null")
    v = materialise(v.groupBy("chart", "label", "v").agg(F.count(F.lit(1)).alias("n")))
    by = ["chart", "label"]
    q = selection.percentiles(v, {"v": [0.25, 0.5, 0.75]}, [by], weight="n").table(by, {"q1": ("v", 0.25), "median": ("v", 0.5), "q3": ("v", 0.75)})
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = v.join(q, by).where(F.col("v").between(F.col("q1") - reach, F.col("q3") + reach))
    ends = inside.groupBy(*by).agg(F.min("v").alias("low"), F.max("v").alias("high"))
    return q.join(ends, by).select(*by, *[F.round(c, 6).alias(c) for c in ("low", "q1", "median", "q3", "high")])


def chart_box_stats(b: DataFrame) -> DataFrame:
    return box_stats(completed(b), BOXES)


def letter_values(b: DataFrame, top: int = 8) -> DataFrame:
    """Median, fourths, eighths and sixteenths of customer value by customer city."""
    clv = b.groupBy("CustomerID").agg(F.max("CustomerLifetimeValue").alias("clv"), F.max("CCity").alias("city"))
    big = clv.groupBy("city").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "city").limit(top)
    points = {"p50": 0.5}
    for k in (2, 3, 4):
        points |= {f"lo{2 ** k}": 0.5**k, f"hi{2 ** k}": 1 - 0.5**k}
    q = percentiles(clv.join(big, "city", "left_semi"), ["city"], "clv", points)
    return q.select("city", *[F.round(c, 6).alias(c) for c in points])


def density(d: DataFrame, col: str, group: str | None, grid: int = 100, cells_per_bandwidth: int = 16) -> DataFrame:
    """Gaussian density on a fixed grid. The values are first counted in cells that are a fixed part of the group's
    bandwidth, so that the curve is as smooth with many rows as with few; their number grows with the rows to the power
    0.2. A group without spread has no density (NULL)."""
    g = F.col(group) if group else F.lit("all")
    v = d.select(g.alias("g"), F.col(col).cast("double").alias("v")).filter("v is not null")
    lo, hi = v.select(F.min("v")).scalar(), v.select(F.max("v")).scalar()
    stats = v.groupBy("g").agg(F.count(F.lit(1)).alias("total"), F.stddev_samp("v").alias("sd"))
    h = F.col("sd") * F.pow(F.col("total").cast("double"), F.lit(-0.2))
    stats = stats.withColumn("h", F.when(h > 0, h))
    cell = F.coalesce(F.floor((F.col("v") - lo) / F.col("h") * cells_per_bandwidth), F.lit(0))
    counts = v.join(stats.select("g", "h"), "g").groupBy("g", cell.alias("cell")).agg(F.count(F.lit(1)).alias("n"), F.avg("v").alias("x"))
    at = counts.join(stats, "g").withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
    at = at.withColumn("y", lo + (hi - lo) / (grid - 1) * F.col("i"))
    u = (F.col("y") - F.col("x")) / F.col("h")
    kernel = F.exp(-0.5 * u * u) / (F.sqrt(2 * F.pi()) * F.col("h"))
    return at.groupBy("g", "i").agg(F.max("y").alias("x"), F.sum(kernel * F.col("n") / F.col("total")).alias("density"))


def chart_density(b: DataFrame) -> DataFrame:
    a = density(completed(b), "DeliveryTimeMinutes", "OrderStatus").withColumn("chart", F.lit("delivery_time_by_status"))
    return a.unionByName(density(b, "FoodCost", None).withColumn("chart", F.lit("food_cost")))


def hash_sample(d: DataFrame, key: str, n: int, seed: int = 1) -> DataFrame:
    """n rows in an order that depends only on key and seed."""
    return d.orderBy(F.xxhash64(F.col(key), F.lit(seed)), key).limit(n)


def chart_scatter_fit(b: DataFrame) -> DataFrame:
    y = "DeliveryTimeMinutes"
    d = completed(b).filter(f"{y} is not null")
    return union([
        d.agg(F.lit(x).alias("x"), F.round(F.regr_slope(y, x), 8).alias("slope"), F.round(F.regr_intercept(y, x), 8).alias("intercept"),
              F.regr_count(y, x).alias("n")) for x in ("DistanceProxyKm", "TrafficScore")])


def chart_scatter_sample(b: DataFrame, n: int = 2500) -> DataFrame:
    d = completed(b).filter("DeliveryTimeMinutes is not null").select("OrderID", "DistanceProxyKm", "TrafficScore", "DeliveryTimeMinutes")
    return hash_sample(d, "OrderID", n)


def chart_corr_matrix(b: DataFrame, cols=CORR_COLUMNS) -> DataFrame:
    """(a, b, r) for every pair. Complete columns go through one matrix product;
    a pair with missing values counts the rows where both are present."""
    d = b.select(*[F.col(c).cast("double").alias(c) for c in cols])
    gaps = d.agg(*[F.max(F.col(c).isNull()).alias(c) for c in cols]).first()  # one row of flags
    full, partial = [c for c in cols if not gaps[c]], [c for c in cols if gaps[c]]
    rows = d.select(array_to_vector(F.array(*full)).alias("v"))
    m = Correlation.corr(rows, "v").first()[0].toArray()  # columns x columns
    whole = [(x, y, float(m[i][j])) for i, x in enumerate(full) for j, y in enumerate(full) if i < j]
    parts = [d.sparkSession.createDataFrame(whole, "a string, b string, r double")]
    mixed = [(x, y) for x, y in combinations(cols, 2) if x in partial or y in partial]
    for i in range(0, len(mixed), 16):  # few enough buffers per aggregate for generated code
        e = [F.struct(F.lit(x).alias("a"), F.lit(y).alias("b"), F.corr(x, y).alias("r")) for x, y in mixed[i:i + 16]]
        parts.append(d.agg(F.array(*e).alias("e")).select(F.explode("e").alias("e")).select("e.*"))
    return union(parts).withColumn("r", F.round("r", 6))


def chart_pair_sample(b: DataFrame, n: int = 800) -> DataFrame:
    cols = ["DeliveryTimeMinutes", "FinalAmount", "TrafficScore", "DistanceProxyKm", "BasketSize"]
    return hash_sample(completed(b).select("OrderID", *cols).dropna(), "OrderID", n)


def restaurant_sample(t, n: int = 600) -> DataFrame:
    return hash_sample(t["restaurants"].select("RestaurantID", "Cuisine", "Rating"), "RestaurantID", n)


# -------------------------------------------------------------- reports
def payment_reconciliation(b: DataFrame) -> DataFrame:
    failed = b.filter(~F.col("IsDelivered"))
    paid = F.coalesce(F.col("PaymentStatus") == "Success", F.lit(False))
    return failed.agg(
        F.count(F.lit(1)).alias("failed_orders"), F.count_if(paid).alias("paid_but_failed"),
        F.round(F.sum(F.when(paid, F.col("FinalAmount"))), 2).alias("paid_amount"),
        F.round(_pct(F.coalesce(F.col("PaymentStatus") == "Refunded", F.lit(False))), 6).alias("refunded_pct"))


def failed_by_payment(b: DataFrame) -> DataFrame:
    return b.filter(~F.col("IsDelivered")).groupBy("PaymentStatus").agg(F.count(F.lit(1)).alias("n"))


def naive_forecast(b: DataFrame) -> DataFrame:
    m = completed(b).groupBy(F.trunc("OrderDate", "month").alias("month")).agg(F.sum("FinalAmount").alias("v"))
    last = m.orderBy(F.desc("month")).limit(3).agg((F.avg("v") * 3).alias("f"))
    return m.agg(F.round(F.avg("v"), 2).alias("month_mean"), F.round(F.stddev_samp("v"), 2).alias("month_sd")).withColumn(
        "next_quarter", F.round(last.scalar(), 2))


def late_vs_ontime(b: DataFrame) -> DataFrame:
    d = completed(b).filter("DeliveryTimeMinutes is not null")
    return d.groupBy("IsLate").agg(F.round(F.avg("DeliveryTimeMinutes"), 6).alias("mean_time"), F.round(F.avg("DeliveryRating"), 6).alias("mean_delivery_rating"))


def rating_vs_cancel(b: DataFrame, min_orders: int = 10) -> DataFrame:
    g = b.groupBy("RestaurantID").agg(F.max("RestaurantRating").alias("r"), F.avg("IsCancelled").alias("c"), F.count("OrderID").alias("n"))
    return g.filter(F.col("n") >= min_orders).agg(F.round(F.corr("r", "c"), 6).alias("corr"), F.count(F.lit(1)).alias("restaurants"))


def coupon_aov(b: DataFrame) -> DataFrame:
    return completed(b).groupBy("HasCoupon").agg(F.round(F.avg("FinalAmount"), 6).alias("aov"))


# ----------------------------------------------------------- dashboards
def cards(values: dict[str, DataFrame]) -> DataFrame:
    """(card, value) from one-row one-column frames."""
    return union([d.toDF("value").select(F.lit(k).alias("card"), F.round(F.col("value").cast("double"), 6).alias("value")) for k, d in values.items()])


def _card_rows(d: DataFrame) -> DataFrame:
    return d.select(F.lit("card").alias("panel"), F.col("card").alias("label"), "value")


def _panel(d: DataFrame, panel: str, label: str, value: str, digits: int = 6) -> DataFrame:
    return d.select(F.lit(panel).alias("panel"), F.col(label).cast("string").alias("label"), F.round(F.col(value).cast("double"), digits).alias("value"))


def dash_executive(s) -> DataFrame:
    names = ["Total Revenue", "Total Orders", "Avg Delivery Time", "Avg Rating", "Late %", "Failure %", "P90 Delivery Time"]
    one = evaluate(s, names)
    top = one.select(*[_shown(n) for n in names]).unpivot([], names, "label", "value")
    month = evaluate(s, ["Total Revenue"], ["dim_date.MonthStart"]).filter("MonthStart is not null")
    city = evaluate(s, ["Total Revenue"], ["dim_city.City"]).filter("City is not null").orderBy(F.desc("Total Revenue"), "City").limit(8)
    status = evaluate(s, ["Total Orders"], ["fact_orders.OrderStatus"])
    active = s["dim_customer"].agg(F.count_if(F.col("DaysSinceLastOrder") <= 60).alias("value"))
    return union([
        _card_rows(cards({"Active customers (60d)": active})),
        top.select(F.lit("card").alias("panel"), "label", "value"), _panel(month, "month", "MonthStart", "Total Revenue", 2),
        _panel(city, "city", "City", "Total Revenue", 2), _panel(status, "status", "OrderStatus", "Total Orders")])


def dash_customer(s) -> DataFrame:
    c = s["dim_customer"]
    on = c.filter("Orders > 0")
    quarter = c.groupBy(F.trunc("RegistrationDate", "quarter").alias("q")).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(F.lit(0)).orderBy("q").rowsBetween(Window.unboundedPreceding, 0)  # one row per quarter
    month = c.groupBy(F.date_format("RegistrationDate", "yyyy-MM").alias("m")).agg(F.count(F.lit(1)).alias("n"))
    top = cards({
        "repeat_share": on.select(rate(F.col("Orders") >= 2)), "one_time_share": on.select(rate(F.col("Orders") == 1)),
        "never_ordered_share": c.select(rate(F.col("Orders") == 0)), "median_clv": percentiles(on, [], "CLV", {"m": 0.5}),
        "avg_orders": on.select(F.avg("Orders"))})
    return union([
        _card_rows(top),
        _panel(c.groupBy("Segment").agg(F.count(F.lit(1)).alias("n")), "segment", "Segment", "n"),
        _panel(c.groupBy("CustomerType").agg(F.count(F.lit(1)).alias("n")), "type", "CustomerType", "n"),
        _panel(c.groupBy("CLVBand").agg(F.count(F.lit(1)).alias("n")), "clv_band", "CLVBand", "n"),
        _panel(quarter.select("q", F.sum("n").over(w).alias("n")), "registrations_to_quarter", "q", "n"),
        _panel(month, "new_by_month", "m", "n"),
        _panel(histogram(on, "CLV", "clv"), "clv_histogram", "bin", "n")])


def dash_restaurant(s, score: DataFrame) -> DataFrame:
    top = cards({
        "scored": score.select(F.count(F.lit(1))), "median_orders": percentiles(score, [], "Orders", {"m": 0.5}),
        "avg_score": score.select(F.avg("CompositeScore")), "avg_rating": s["dim_restaurant"].select(F.avg("Rating"))})

    def ten(order):
        return score.orderBy(order, "RestaurantID").limit(10).withColumn("l", F.concat("RestaurantName", F.lit(" ("), "RCity", F.lit(")")))

    cuisine = evaluate(s, ["Total Revenue"], ["dim_restaurant.Cuisine"]).orderBy(F.desc("Total Revenue"), "Cuisine").limit(10)
    rating = evaluate(s, ["Avg Restaurant Rating"], ["dim_restaurant.Cuisine"])
    return union([
        _card_rows(top), _panel(ten(F.desc("CompositeScore")), "top10", "l", "CompositeScore"), _panel(ten(F.asc("CompositeScore")), "bottom10", "l", "CompositeScore"),
        _panel(cuisine, "cuisine_revenue", "Cuisine", "Total Revenue", 2), _panel(rating, "cuisine_rating", "Cuisine", "Avg Restaurant Rating")])


def partner_leaderboard(s) -> DataFrame:
    by = ["dim_partner.DeliveryPartnerID", "dim_partner.VehicleType", "dim_partner.Rating"]
    out = evaluate(s, ["Partner Deliveries", "Avg Time (10+ deliveries)"], by)
    return out.withColumn("Avg Time (10+ deliveries)", F.round(F.col("`Avg Time (10+ deliveries)`"), 6))


def dash_delivery(s, top: int = 10, least: int = 10) -> DataFrame:
    f = s["fact_orders"].filter("IsDelivered = 1")
    g = f.groupBy("DeliveryPartnerID").agg(F.avg("DeliveryTimeMinutes").alias("mean"), F.count("DeliveryTimeMinutes").alias("n"), F.count(F.lit(1)).alias("all"))
    names = ["Avg Delivery Time", "P90 Delivery Time", "Late %", "Completed Orders"]
    one = evaluate(s, names).select(*[_shown(n) for n in names]).unpivot([], names, "label", "value")
    busy = g.agg(F.count_if(F.col("all") >= least).cast("double").alias("value")).select(F.lit("card").alias("panel"), F.lit("partners_10_plus").alias("label"), "value")
    fastest = g.filter(F.col("n") >= least).withColumn("mean", F.round("mean", 9)).orderBy("mean", "DeliveryPartnerID").limit(top)

    def by(panel, col):
        d = evaluate(s, ["Avg Delivery Time"], [col])
        key = col.split(".")[1]
        return _panel(d.filter(F.col(key).isNotNull()), panel, key, "Avg Delivery Time")

    return union([
        one.select(F.lit("card").alias("panel"), "label", "value"), busy, _panel(fastest, "fastest", "DeliveryPartnerID", "mean"),
        by("month", "dim_date.MonthStart"), by("traffic", "fact_orders.TrafficScore"), by("rain", "fact_orders.RainImpact")])


def moving_average(b_daily: DataFrame, days: int = 30) -> DataFrame:
    """Mean of the last n rows of daily revenue; NULL until there are n."""
    w = Window.partitionBy(F.lit(0)).orderBy("OrderDate").rowsBetween(-(days - 1), 0)  # one row per day
    return b_daily.select("OrderDate", F.when(F.count("revenue").over(w) == days, F.avg("revenue").over(w)).alias("avg_revenue"))


def dash_sales(s) -> DataFrame:
    names = ["Total Revenue", "Avg Order Value", "Total Discount", "Coupon Usage %", "Discount % of Revenue"]
    one = evaluate(s, names).select(*[_shown(n) for n in names]).unpivot([], names, "label", "value")
    daily = s["fact_orders"].filter("IsDelivered = 1").groupBy("OrderDate").agg(F.sum("Revenue").alias("revenue"))
    camp = evaluate(s, ["Total Discount"], ["dim_promotion.CampaignName"]).filter("CampaignName is not null").orderBy(F.desc("Total Discount"), "CampaignName").limit(8)
    pay = evaluate(s, ["Total Orders"], ["fact_orders.PaymentMethod"])
    return union([
        one.select(F.lit("card").alias("panel"), "label", "value"), _panel(moving_average(daily), "average_30", "OrderDate", "avg_revenue", 4),
        _panel(camp, "campaign", "CampaignName", "Total Discount", 2), _panel(pay, "payment", "PaymentMethod", "Total Orders")])


def dash_ml(predictions: DataFrame, scores: DataFrame) -> DataFrame:
    """Residual spread by predicted decade, and size and churn rate per risk segment."""
    r = predictions.groupBy((F.floor(F.col("Predicted") / 10) * 10).cast("int").alias("k")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("Residual").alias("mean"))
    risk = scores.filter("Split = 'test'").groupBy("RiskSegment").agg(F.count(F.lit(1)).alias("n"), F.avg("Churn").alias("rate"))
    return union([_panel(r, "residual_mean", "k", "mean"), _panel(r, "residual_n", "k", "n"),
                  _panel(risk, "risk_customers", "RiskSegment", "n"), _panel(risk, "risk_churn_rate", "RiskSegment", "rate")])


def dash_models(tables: dict[str, DataFrame], bins: int = 10) -> DataFrame:
    """The model page over the six model tables: cards of the chosen models, importances, predicted against actual by
    decade, residuals and risk segments."""
    def chosen(rows: DataFrame, cv: str) -> DataFrame:
        return rows.where("Stage in ('default', 'tuned')").orderBy(F.desc(cv), "Model").limit(1)

    delivery, churn = chosen(tables["ml_model_comparison_delivery"], "CV_R2_mean"), chosen(tables["ml_model_comparison_churn"], "CV_AUC")
    shown = {
        "Delivery model test R2": delivery.select("R2"), "Delivery RMSE (min)": delivery.select("RMSE"), "Delivery MAE (min)": delivery.select("MAE"),
        "Churn model test AUC": churn.select("ROC_AUC"), "Churn F1": churn.select("F1"),
    }
    predictions = tables["ml_delivery_predictions"]
    by = predictions.groupBy((F.floor(F.col("Predicted") / bins) * bins).cast("int").alias("k")).agg(F.avg("Actual").alias("actual"), F.avg("Predicted").alias("predicted"))
    parts = [_card_rows(cards(shown)), _panel(by, "actual_by_predicted", "k", "actual"), _panel(by, "mean_predicted", "k", "predicted")]
    for which, value in (("delivery", "permutation_mse_increase"), ("churn", "auc_drop_when_shuffled")):
        top = tables[f"ml_{which}_feature_importance"].orderBy(F.desc(value), "feature").limit(8)
        parts.append(_panel(top, f"importance_{which}", "feature", value))
    return union([*parts, dash_ml(predictions, tables["ml_churn_scores"])])
