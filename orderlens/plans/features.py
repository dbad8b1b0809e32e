"""The order base table (one row per order) and the customer churn table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.constants import CANCELLED, CHURN_HORIZON_DAYS, LATE, TRAFFIC_SCORE
from orderlens.functions import haversine_km, is_completed, minute_of_day, rate, ratio
from orderlens.operators.blocks import ranks
from orderlens.operators.cleaning import row_mean
from orderlens.operators.joins import beside, lookup
from orderlens.operators.selection import percentiles
from orderlens.session import materialise, side_by_side
from orderlens.sources.sample import MOST_PAYMENTS

READINGS = ("Rainfall", "Temperature", "Humidity", "TrafficScore", "AverageSpeed")


# ------------------------------------------------------------ order level
def time_parts(orders: DataFrame) -> DataFrame:
    stamp = F.try_to_timestamp(F.concat_ws(" ", F.date_format("OrderDate", "yyyy-MM-dd"), "OrderTime"))
    return orders.withColumn("OrderTS", stamp).withColumns({
        "hour": F.hour("OrderTS"), "order_min": F.hour("OrderTS") * 60 + F.minute("OrderTS"),
        "dow": F.weekday("OrderDate"), "month": F.date_format("OrderDate", "yyyy-MM"),
    })


def restaurant_dim(t) -> DataFrame:
    """Restaurants with the distance to the centre of their city's restaurants."""
    centre = t["restaurants"].groupBy("City").agg(F.avg("Latitude").alias("_la"), F.avg("Longitude").alias("_lo"))
    return t["restaurants"].join(centre, "City", "left").select(
        "RestaurantID", "RestaurantName", F.col("City").alias("RCity"), F.col("Area").alias("RArea"), "Cuisine",
        F.col("Rating").alias("RestaurantRating"), "AverageCost", "RestaurantType", "Latitude", "Longitude",
        haversine_km(F.col("Latitude"), F.col("Longitude"), F.col("_la"), F.col("_lo")).alias("DistanceProxyKm"))


def customer_dim(t) -> DataFrame:
    return t["customers"].select(
        "CustomerID", F.col("City").alias("CCity"), F.col("Age").alias("CustomerAge"), "Membership", "RegistrationDate", "Gender")


def partner_dim(t) -> DataFrame:
    """Partners with their mean time relative to the mean of their city."""
    city = t["delivery_partners"].groupBy("City").agg(F.avg("AverageDeliveryTime").alias("_m"))
    return t["delivery_partners"].join(city, "City", "left").select(
        "DeliveryPartnerID", "VehicleType", F.col("Rating").alias("PartnerRating"), "AverageDeliveryTime",
        "CompletedDeliveries", F.col("City").alias("PCity"), ratio(F.col("AverageDeliveryTime"), F.col("_m")).alias("DeliveryEfficiency"))


def with_dimensions(t) -> DataFrame:
    return (
        time_parts(t["orders"]).join(restaurant_dim(t), "RestaurantID", "left")
        .join(customer_dim(t), "CustomerID", "left").join(partner_dim(t), "DeliveryPartnerID", "left")
    )


# -------------------------------------------------------- weather, traffic
def weather_daily(t) -> DataFrame:
    return t["weather"].groupBy("City", "Date").agg(
        F.avg("Rainfall").alias("Rainfall"), F.avg("Temperature").alias("Temperature"),
        F.avg("Humidity").alias("Humidity"), F.mode("WeatherCondition", deterministic=True).alias("WeatherCondition"))


def time_slots(orders: DataFrame) -> DataFrame:
    """Orders counted per (city, date, minute): everything that depends only on place
    and time is looked up once per slot instead of once per order."""
    return orders.groupBy("RCity", "OrderDate", "order_min").agg(F.count(F.lit(1)).alias("n_orders"))


def nearest_traffic(slots: DataFrame, t) -> DataFrame:
    """Slots with the reading closest in time of day on the same city and date.

    Readings of one minute are first reduced to the one that would win. What is
    left per (city, date) is at most one slot and one reading per minute of a
    day, so the two ordered passes work on a few thousand rows each."""
    score = reduce(
        lambda acc, kv: acc.when(F.col("TrafficLevel") == kv[0], kv[1]),
        list(TRAFFIC_SCORE.items())[1:], F.when(F.col("TrafficLevel") == "Low", 1))
    best = t["traffic"].groupBy("City", "Date", minute_of_day(F.col("Time")).alias("m")).agg(
        F.min(F.struct("TrafficID", score.alias("score"), "AverageSpeed")).alias("r"))
    readings = best.select(
        F.col("City").alias("RCity"), F.col("Date").alias("OrderDate"), "m", F.struct(F.col("m"), F.col("r")).alias("hit"),
        F.lit(False).alias("is_slot"))
    wanted = slots.select(
        "RCity", "OrderDate", F.col("order_min").alias("m"), F.lit(None).cast(readings.schema["hit"].dataType).alias("hit"),
        F.lit(True).alias("is_slot"))
    whole = Window.partitionBy("RCity", "OrderDate")
    # one pass in time order and one against it, each with a frame that only grows
    forth = whole.orderBy(F.col("m").asc_nulls_last()).rangeBetween(Window.unboundedPreceding, 0)
    back = whole.orderBy(F.col("m").desc_nulls_last()).rangeBetween(Window.unboundedPreceding, 0)
    timed = F.when(F.col("m").isNotNull(), F.col("hit"))
    both = wanted.unionByName(readings).withColumns({
        "before": F.last(timed, ignorenulls=True).over(forth),
        "after": F.last(timed, ignorenulls=True).over(back),
        "any": F.min("hit.r").over(whole),  # smallest id of the day
        "untimed": F.min(F.when(F.col("m").isNull(), F.col("hit.r"))).over(whole),
    }).filter("is_slot")

    def gap(side: str) -> Column:
        return F.coalesce(F.abs(F.col("m") - F.col(f"{side}.m")), F.lit(99999))

    closest = F.least(
        F.when(F.col("before").isNotNull(), F.struct(gap("before").alias("g"), F.col("before.r").alias("r"))),
        F.when(F.col("after").isNotNull(), F.struct(gap("after").alias("g"), F.col("after.r").alias("r"))))["r"]
    pick = F.when(F.col("m").isNull(), F.col("any")).otherwise(F.coalesce(closest, F.col("untimed")))
    found = both.select("RCity", "OrderDate", F.col("m").alias("order_min"), pick.alias("r"))
    cond = ["RCity", "OrderDate"]
    f = found.select(*[F.col(c).alias(f"_{c}") for c in (*cond, "order_min")], "r")
    same = [slots[c] == f[f"_{c}"] for c in cond] + [slots["order_min"].eqNullSafe(f["_order_min"])]
    return slots.join(f, reduce(lambda a, b: a & b, same), "left").select(
        *slots.columns, F.col("r.score").alias("TrafficScore"), F.col("r.AverageSpeed").alias("AverageSpeed"))


def conditions(slots: DataFrame, t) -> DataFrame:
    """Slots with weather and traffic, match flags, and city medians where unmatched."""
    w = weather_daily(t).withColumnsRenamed({"City": "RCity", "Date": "OrderDate"})
    s = materialise(nearest_traffic(slots.join(w, ["RCity", "OrderDate"], "left"), t))
    out = s.withColumns({
        "HasWeather": F.col("Rainfall").isNotNull().cast("int"), "HasTraffic": F.col("TrafficScore").isNotNull().cast("int"),
        "WeatherCondition": F.coalesce("WeatherCondition", F.lit("Unknown"))})
    medians = percentiles(s, {c: [0.5] for c in READINGS}, [["RCity"], []], weight="n_orders")
    city = medians.table(["RCity"], {f"c_{c}": (c, 0.5) for c in READINGS})
    whole = medians.table([], {f"w_{c}": (c, 0.5) for c in READINGS})
    return out.join(city, "RCity", "left").withColumns(
        {c: F.coalesce(F.col(c), F.col(f"c_{c}"), whole.select(f"w_{c}").scalar()) for c in READINGS}
    ).drop(*[f"c_{c}" for c in READINGS])


def with_conditions(d: DataFrame, t) -> DataFrame:
    c = conditions(time_slots(d), t).drop("n_orders")
    c = c.withColumnsRenamed({k: f"_{k}" for k in ("RCity", "OrderDate", "order_min")})
    same = [d[k].eqNullSafe(F.col(f"_{k}")) for k in ("RCity", "OrderDate", "order_min")]
    return d.join(c, reduce(lambda a, b: a & b, same), "left").drop("_RCity", "_OrderDate", "_order_min")


# ------------------------------------------------------------ per order
def _view(t, name: str) -> DataFrame:
    """A table that is read once here: not stored first, where that can be saved."""
    return t.view(name) if hasattr(t, "view") else t[name]


def basket(t) -> DataFrame:
    """Lines are counted by their order: the numbering that gives a line its id is not needed for it."""
    return _view(t, "order_items").groupBy("OrderID").agg(
        F.sum("Quantity").alias("BasketSize"), F.count("OrderID").alias("ItemLines"))


def with_basket(d: DataFrame, t) -> DataFrame:
    return d.join(basket(t), "OrderID", "left").fillna(0, ["BasketSize", "ItemLines"])


def feedback(t) -> DataFrame:
    cols = ["CustomerRating", "DeliveryRating", "FoodRating"]
    return _view(t, "customer_feedback").select("OrderID", *cols, row_mean(*[F.col(c) for c in cols]).alias("AvgRating"), "Sentiment")


def with_payment(d: DataFrame, t) -> DataFrame:
    """Stored rows with the status of their order's payment."""
    if not hasattr(t, "payment_states"):
        return materialise(d.join(t["payments"].select("OrderID", "PaymentStatus"), "OrderID", "left"))
    d = materialise(d.join(t.payment_states(), "OrderID", "left"))
    few = F.coalesce(F.col("_payments") <= MOST_PAYMENTS, F.lit(True))
    if not d.where(~few).isEmpty():  # numbers of lines repeat there: read as they are
        many = d.where(~few).drop("PaymentStatus", "_payments").join(t.view("payments").select("OrderID", "PaymentStatus"), "OrderID", "left")
        d = materialise(d.where(few).drop("_payments").unionByName(many))
    return d.drop("_payments")


def peak_hour() -> Column:
    return F.coalesce((F.col("hour").between(12, 13) | F.col("hour").between(19, 21)).cast("int"), F.lit(0))


def rain_impact() -> Column:
    r = F.col("Rainfall")
    return F.when((r > -1) & (r <= 0.5), 0).when((r > 0.5) & (r <= 10), 1).when((r > 10) & (r <= 50), 2).when(r > 50, 3)


def status_flags() -> dict[str, Column]:
    s = F.col("OrderStatus")
    return {
        "IsDelivered": F.coalesce(is_completed(), F.lit(False)),
        "IsCancelled": F.coalesce((s == CANCELLED).cast("int"), F.lit(0)),
        "IsLate": F.coalesce((s == LATE).cast("int"), F.lit(0)),
        "HasCoupon": F.col("CouponCode").isNotNull().cast("int"),
    }


def discount_pct() -> Column:
    return F.when(F.col("FoodCost") > 0, F.col("Discount") / F.col("FoodCost")).otherwise(F.lit(0.0))


def order_flags(d: DataFrame) -> DataFrame:
    return d.withColumns({
        "PeakHour": peak_hour(), "WeekendOrder": (F.col("dow") >= 5).cast("int"), "RainImpact": rain_impact(),
        "CustomerTenure": F.datediff("OrderDate", "RegistrationDate"), **status_flags(), "DiscountPct": discount_pct()})


# --------------------------------------------------- aggregates joined back
def customer_aggregates(d: DataFrame) -> DataFrame:
    """Per customer over all orders. An aggregate and a join, not a window: the rows
    of a hot customer are combined before the exchange."""
    days = F.floor((F.unix_timestamp(F.max("OrderTS")) - F.unix_timestamp(F.min("OrderTS"))) / 86400)
    span = F.greatest(days, F.lit(30))
    return d.groupBy("CustomerID").agg(
        F.avg("FinalAmount").alias("AverageBasketValue"), F.sum("FinalAmount").alias("CustomerLifetimeValue"),
        (F.count("OrderID") / (span / 30.0)).alias("OrderFrequency"))


def restaurant_popularity(d: DataFrame) -> DataFrame:
    per = d.filter("RCity is not null").groupBy("RCity", "RestaurantID").agg(
        F.count("OrderID").alias("RestOrders"), F.round(F.sum("FinalAmount"), 4).alias("RestRevenue"))
    per = materialise(per)
    by_orders = ranks(per, ["RCity"], "RestOrders", "RestaurantID").select(
        "RestaurantID", "RestOrders", "RestRevenue", F.col("rank_num").alias("RestaurantPopularityRank"))
    by_revenue = ranks(per, ["RCity"], "RestRevenue", "RestaurantID").select(
        "RestaurantID", F.col("rank_num").alias("RestaurantRevenueRank"))
    return by_orders.join(by_revenue, "RestaurantID")


def restaurant_feedback(d: DataFrame) -> DataFrame:
    return d.groupBy("RestaurantID").agg(F.avg("AvgRating").alias("RestaurantAvgFeedback"))


def _repeats(rows: DataFrame, key: str) -> bool:
    return not rows.where(F.col(key).isNotNull()).groupBy(key).count().where("count > 1").isEmpty()


class Lookup:
    """A stored dimension. Rows that meet it are moved without it and meet it again where its columns are read: by its key, or,
    where a key stands for several rows, by the number of the row they met first."""

    def __init__(self, dim: DataFrame, key: str, number: str):
        self.key, self.number = key, number
        self.rows = materialise(dim.withColumn(number, F.monotonically_increasing_id()))
        self.repeats = _repeats(self.rows, key)

    def multiply(self, d: DataFrame) -> DataFrame:
        """A row for each that the key stands for."""
        return d.join(lookup(self.rows.select(self.key, self.number)), self.key, "left") if self.repeats else d

    def meet(self, d: DataFrame, *columns: str) -> DataFrame:
        """The named columns, or all, beside rows that were multiplied."""
        by, other = (self.number, self.key) if self.repeats else (self.key, self.number)
        return d.join(lookup(self.rows.select(by, *columns) if columns else self.rows.drop(other)), by, "left")


def with_average(d: DataFrame) -> DataFrame:
    """The mean of the ratings, behind them: computed anew where it is read, so that it need not be moved."""
    ratings = ["CustomerRating", "DeliveryRating", "FoodRating"]
    at = d.columns.index(ratings[-1]) + 1
    return d.select(*d.columns[:at], row_mean(*[F.col(c) for c in ratings]).alias("AvgRating"), *d.columns[at:])


def order_base_table(t) -> DataFrame:
    """Orders move twice, both times narrow: by their key, to meet basket, feedback and payment, and by their customer, to
    meet the customer and the customer's totals. Restaurants, partners, the conditions and the flags come last, when no exchange
    of the orders follows; before, their keys stand for them. Joins match the same rows in either order."""
    orders = time_parts(t["orders"])
    spark = orders.sparkSession

    def people_once() -> tuple[DataFrame, bool]:
        people = customer_dim(t)
        return people, _repeats(people, "CustomerID")

    rest, part, (people, repeats) = side_by_side(spark, lambda build: build(), [
        lambda: Lookup(restaurant_dim(t), "RestaurantID", "_rid"), lambda: Lookup(partner_dim(t), "DeliveryPartnerID", "_pid"), people_once])
    placed = part.multiply(rest.multiply(t["orders"]))
    if repeats:  # a customer that repeats multiplies the orders, which the aggregates count
        placed = placed.join(beside(people), "CustomerID", "left")

    def by_order() -> tuple[DataFrame, DataFrame]:
        """Stored orders, read by three aggregates and the final join, and the totals of the restaurants."""
        stored = with_payment(with_basket(placed, t).join(feedback(t).drop("AvgRating"), "OrderID", "left"), t)
        d = rest.meet(with_average(stored), "RCity")
        return stored, materialise(restaurant_feedback(d).join(restaurant_popularity(d), "RestaurantID", "left"))

    # the conditions read the time and place of the orders alone: short jobs that need not wait for the long ones of the other
    around, (stored, per) = side_by_side(
        spark, lambda build: build(), [lambda: conditions(time_slots(time_parts(rest.meet(placed, "RCity"))), t).drop("n_orders"), by_order])
    d = time_parts(with_average(stored))
    per = per.select("RestaurantID", *[c for c in per.columns if c not in ("RestaurantID", "RestaurantAvgFeedback")], "RestaurantAvgFeedback")
    totals = customer_aggregates(d)
    who = totals if repeats else people.join(totals, "CustomerID", "full")
    met = rest.meet(time_parts(with_average(stored.join(who.where("CustomerID is not null"), "CustomerID", "left"))))
    slot = around.withColumnsRenamed({k: f"_{k}" for k in ("RCity", "OrderDate", "order_min")})
    same = [met[k].eqNullSafe(F.col(f"_{k}")) for k in ("RCity", "OrderDate", "order_min")]
    met = met.join(slot, reduce(lambda a, b: a & b, same), "left").drop("_RCity", "_OrderDate", "_order_min")
    out = order_flags(part.meet(met).join(lookup(per), "RestaurantID", "left"))
    keys = ["RestaurantID", "CustomerID", "OrderID", "DeliveryPartnerID"]
    first = [*keys, *orders.columns, *rest.rows.columns, *people.columns, *part.rows.columns, *around.columns, *d.columns]
    last = [c for c in (*totals.columns, *per.columns) if c not in keys]
    flags = [c for c in out.columns if c not in {*first, *last}]
    return out.select([c for c in dict.fromkeys([*first, *flags, *last]) if c not in ("_rid", "_pid")])


# ------------------------------------------------------------ churn table
def last_day(base: DataFrame) -> Column:
    return base.select(F.max("OrderDate")).scalar()


def churn_features(base: DataFrame, cutoff: Column, horizon_days: int) -> DataFrame:
    """History up to the cutoff and the label after it, in one aggregate."""
    day = F.col("OrderDate")
    past, soon = day <= cutoff, (day > cutoff) & (day <= F.date_add(cutoff, horizon_days))

    def h(c) -> Column:
        return F.when(past, F.col(c))

    return base.groupBy("CustomerID").agg(
        F.datediff(cutoff, F.max(h("OrderDate"))).alias("Recency"), F.count(h("OrderID")).alias("Frequency"),
        F.sum(h("FinalAmount")).alias("Monetary"), F.avg(h("FinalAmount")).alias("AvgOrderValue"),
        F.avg(h("IsCancelled")).alias("CancelRate"), F.avg(h("IsLate")).alias("LateRate"), F.avg(h("HasCoupon")).alias("CouponRate"),
        F.avg(h("DeliveryTimeMinutes")).alias("AvgDeliveryTime"), F.avg(h("AvgRating")).alias("AvgRating"),
        F.count_distinct(h("RestaurantID")).alias("DistinctRestaurants"), F.avg(h("WeekendOrder")).alias("WeekendShare"),
        F.datediff(cutoff, F.min(h("OrderDate"))).alias("FirstOrderAgeDays"),
        (F.count_if(soon) == 0).cast("int").alias("Churn"),
    ).filter("Frequency > 0")


def gap_days() -> Column:
    """Mean days between orders; -1 where a customer has a single order."""
    gaps = F.try_divide((F.col("FirstOrderAgeDays") - F.col("Recency")).cast("double"), (F.col("Frequency") - 1).cast("double"))
    return F.coalesce(gaps, F.lit(-1.0))


def churn_table(base: DataFrame, t, horizon_days: int = CHURN_HORIZON_DAYS, cutoff: str | None = None) -> DataFrame:
    at = F.lit(cutoff).cast("date") if cutoff else F.date_sub(last_day(base), horizon_days)
    f = materialise(churn_features(base, at, horizon_days).withColumn("AvgGapDays", gap_days()).withColumn("_at", at))
    people = t["customers"].select("CustomerID", "RegistrationDate", "Age", "Membership", "PreferredCuisine")
    medians = percentiles(f, {"AvgRating": [0.5], "AvgDeliveryTime": [0.5]}, [[]])
    fills = {c: medians.scalar(c, 0.5) for c in ("AvgRating", "AvgDeliveryTime")}
    return (
        f.join(beside(people), "CustomerID", "left")
        .withColumns({c: F.coalesce(F.col(c), m) for c, m in fills.items()})
        .withColumn("Tenure", F.datediff("_at", "RegistrationDate"))
        .select("CustomerID", "Recency", "Frequency", "Monetary", "AvgOrderValue", "CancelRate", "LateRate", "CouponRate",
                "AvgDeliveryTime", "AvgRating", "DistinctRestaurants", "WeekendShare", "FirstOrderAgeDays", "AvgGapDays",
                "Tenure", "Age", "Membership", "PreferredCuisine", "Churn")
    )


# ------------------------------------------------------------ quality
def completeness(d: DataFrame, cols: list[str]) -> DataFrame:
    entries = [F.struct(F.lit(c).alias("feature"), F.count_if(F.col(c).isNull()).alias("nulls")) for c in cols]
    return d.agg(F.array(*entries).alias("e")).select(F.explode("e").alias("e")).select("e.*")


def city_match_rate(d: DataFrame) -> DataFrame:
    same = F.coalesce(F.col("CCity") == F.col("RCity"), F.lit(False))
    return d.agg(F.round(rate(same), 6).alias("match_rate"))
