"""Named measures over the star schema.

A measure is one aggregate expression with a home table. ``evaluate`` joins the
home table to the dimensions that the grouping or the filters name, over as many
relationships as it takes, filters, and aggregates: the filter context of a report
cell is its group. ``evaluate_months`` does so for measures that look back in time."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.functions import ratio

# (from table, to table) -> (key, key); all many-to-one
RELATIONS = {
    ("fact_orders", "dim_date"): ("OrderDate", "Date"), ("fact_orders", "dim_customer"): ("CustomerID", "CustomerID"),
    ("fact_orders", "dim_restaurant"): ("RestaurantID", "RestaurantID"), ("fact_orders", "dim_partner"): ("DeliveryPartnerID", "DeliveryPartnerID"),
    ("fact_orders", "dim_city"): ("City", "City"), ("fact_orders", "dim_promotion"): ("CouponCode", "CouponCode"),
    ("fact_order_items", "fact_orders"): ("OrderID", "OrderID"), ("fact_order_items", "dim_menu"): ("FoodItemID", "FoodItemID"),
    ("ml_delivery_predictions", "fact_orders"): ("OrderID", "OrderID"), ("ml_churn_scores", "dim_customer"): ("CustomerID", "CustomerID"),
}
# used only where asked for by name
INACTIVE = {("dim_customer", "dim_date"): ("RegistrationDate", "Date")}

done = lambda: F.col("IsDelivered") == 1
n_rows = lambda: F.count(F.lit(1))
n_done = lambda: F.count_if(done())
revenue = lambda: F.sum(F.when(done(), F.col("FinalAmount")))
avg_time = lambda: F.avg(F.when(done(), F.col("DeliveryTimeMinutes")))
discount = lambda: F.sum(F.when(done(), F.col("Discount")))
ordering = lambda: F.count_if(F.col("Orders") >= 1)
on_test = lambda: F.col("Split") == "test"


def _r2() -> Column:
    """1 - residual / total sum of squares, from mergeable sums."""
    a, r = F.col("Actual"), F.col("Residual")
    total = F.sum(a * a) - F.sum(a) * F.sum(a) / F.count(a)
    return F.lit(1.0) - F.try_divide(F.sum(r * r), total)


# The names of the measures. name -> (home table, expression)
MEASURES = {
    "Total Orders": ("fact_orders", n_rows),
    "Completed Orders": ("fact_orders", n_done),
    "Total Revenue": ("fact_orders", revenue),
    "Avg Order Value": ("fact_orders", lambda: ratio(revenue(), n_done())),
    "Avg Delivery Time": ("fact_orders", avg_time),
    # minutes are whole numbers up to 180: the buffer of an exact percentile is small
    "P90 Delivery Time": ("fact_orders", lambda: F.percentile(F.when(done(), F.col("DeliveryTimeMinutes")), 0.9)),
    "Avg Rating": ("fact_orders", lambda: F.avg("AvgRating")),
    "Late %": ("fact_orders", lambda: ratio(F.count_if(F.col("IsLate") == 1), n_done())),
    "Cancellation %": ("fact_orders", lambda: ratio(F.count_if(F.col("IsCancelled") == 1), n_rows())),
    "Failure %": ("fact_orders", lambda: ratio(F.count_if(F.col("IsDelivered") == 0), n_rows())),
    "Partner Deliveries": ("fact_orders", n_done),
    "Avg Time (10+ deliveries)": ("fact_orders", lambda: F.when(n_done() >= 10, avg_time())),
    "Total Discount": ("fact_orders", discount),
    "Coupon Usage %": ("fact_orders", lambda: ratio(F.sum("HasCoupon"), n_rows())),
    "Discount % of Revenue": ("fact_orders", lambda: ratio(discount(), revenue() + discount())),
    "Restaurant Revenue": ("fact_orders", revenue),
    "Restaurant Cancel %": ("fact_orders", lambda: ratio(F.sum("IsCancelled"), n_rows())),
    "Partner Avg Time": ("fact_orders", avg_time),
    "Traffic Impact": ("fact_orders", avg_time),
    "Rain Impact": ("fact_orders", avg_time),
    "Customers": ("dim_customer", n_rows),
    "Ordering Customers": ("dim_customer", ordering),
    "Repeat Customers": ("dim_customer", lambda: F.count_if(F.col("Orders") >= 2)),
    "Retention Rate": ("dim_customer", lambda: ratio(F.count_if(F.col("Orders") >= 2), ordering())),
    "One-time Customers %": ("dim_customer", lambda: ratio(F.count_if(F.col("CustomerType") == "One-time"), ordering())),
    "Avg CLV": ("dim_customer", lambda: F.avg(F.when(F.col("Orders") >= 1, F.col("CLV")))),
    "New Customers": ("dim_customer", n_rows),
    "Avg Composite Score": ("dim_restaurant", lambda: F.avg("CompositeScore")),
    "Avg Restaurant Rating": ("dim_restaurant", lambda: F.avg("Rating")),
    "Top 10 Score": ("rpt_restaurant_top10", lambda: F.sum("CompositeScore")),
    "Bottom 10 Score": ("rpt_restaurant_bottom10", lambda: F.sum("CompositeScore")),
    "Delivery MAE": ("ml_delivery_predictions", lambda: F.avg(F.abs("Residual"))),
    "Delivery RMSE": ("ml_delivery_predictions", lambda: F.sqrt(F.avg(F.col("Residual") * F.col("Residual")))),
    "Delivery R2": ("ml_delivery_predictions", _r2),
    "Avg Predicted": ("ml_delivery_predictions", lambda: F.avg("Predicted")),
    "Avg Actual": ("ml_delivery_predictions", lambda: F.avg("Actual")),
    "Delivery Importance": ("ml_delivery_feature_importance", lambda: F.sum("permutation_mse_increase")),
    "Churn Importance": ("ml_churn_feature_importance", lambda: F.sum("auc_drop_when_shuffled")),
    "Test Customers": ("ml_churn_scores", lambda: F.count_if(on_test())),
    "High-risk Customers": ("ml_churn_scores", lambda: F.count_if(on_test() & (F.col("RiskSegment") == "High"))),
    "Actual Churn % (test)": ("ml_churn_scores", lambda: F.avg(F.when(on_test(), F.col("Churn")))),
}


def _split(name: str) -> tuple[str, str]:
    table, _, col = name.partition(".")
    return table, col


def _path(home: str, table: str, inactive: bool) -> list[tuple[str, str, str, str]] | None:
    """The relationships (from, key, to, key) that lead from home to table, the shortest way; None if there is none."""
    edges = {**RELATIONS, **(INACTIVE if inactive else {})}
    ways, seen = [(home, [])], {home}
    while ways:
        at, way = ways.pop(0)
        if at == table:
            return way
        for (one, many), (key, pk) in edges.items():
            if one == at and many not in seen:
                seen.add(many)
                ways.append((many, [*way, (one, key, many, pk)]))
    return None


def _context(star, home: str, columns: list[str], inactive: bool) -> DataFrame:
    """The home table with the named foreign columns, called ``table.column``."""
    df, reached = star[home], {home: None}
    for table in dict.fromkeys(_split(c)[0] for c in columns):
        way = _path(home, table, inactive)
        if way is None:
            raise ValueError(f"{home} has no relationship to {table}")
        for one, key, many, pk in way:
            if many in reached:
                continue
            dim = star[many].select(*[F.col(c).alias(f"{many}.{c}") for c in star[many].columns])
            left = key if one == home else f"{one}.{key}"
            df = df.join(dim, df[f"`{left}`"] == dim[f"`{many}.{pk}`"], "left")
            reached[many] = None
    own = [_split(c)[1] for c in columns if _split(c)[0] == home]
    return df.withColumns({f"{home}.{c}": F.col(c) for c in own}) if own else df


def _filtered(df: DataFrame, filters: dict) -> DataFrame:
    for c, allowed in filters.items():
        v = F.col(f"`{c}`")
        df = df.filter(v.between(*allowed) if isinstance(allowed, tuple) else v.isin(*allowed))
    return df


def evaluate(star, measures: list[str], by: list[str] = (), filters: dict | None = None, inactive: bool = False) -> DataFrame:
    """One row per group of ``by`` (``table.column`` names) with the measures.

    ``filters`` maps a column to a list of values or a (from, to) tuple; a filter on a table that the home table has no
    way to leaves the measures as they are. Measures of one call share their home table."""
    homes = {MEASURES[m][0] for m in measures}
    if len(homes) != 1:
        raise ValueError("measures of one call must share a home table")
    home = homes.pop()
    filters = {c: v for c, v in (filters or {}).items() if _path(home, _split(c)[0], inactive) is not None}
    df = _filtered(_context(star, home, list(dict.fromkeys([*by, *filters])), inactive), filters)
    keys = [F.col(f"`{c}`").alias(_split(c)[1]) for c in by]
    return df.groupBy(*keys).agg(*[MEASURES[m][1]().alias(m) for m in measures])


def _facts(star, by: list[str], filters: dict) -> tuple[DataFrame, list[str]]:
    """Orders in the context of the groups and filters: the groups, OrderDate, CustomerID and revenue."""
    df = _filtered(_context(star, "fact_orders", list(dict.fromkeys([*by, *filters])), False), filters)
    keys = [_split(c)[1] for c in by]
    columns = [F.col(f"`{c}`").alias(k) for c, k in zip(by, keys, strict=True)]
    return df.select(*columns, "OrderDate", "CustomerID", F.when(done(), F.col("FinalAmount")).alias("_r")), keys


def active_intervals(orders: DataFrame, keys: list[str], days: int) -> DataFrame:
    """(keys, Date, change): where the number of active customers changes. A customer is active from each order for
    ``days`` days; overlapping days are one interval, so only the order dates next to a gap make events. The window holds
    the distinct dates of one customer, at most the days of the calendar."""
    dates = orders.where("OrderDate is not null and CustomerID is not null").select(*keys, "CustomerID", "OrderDate").distinct()
    w = Window.partitionBy(*keys, "CustomerID").orderBy("OrderDate")
    seen = dates.withColumns({"_before": F.lag("OrderDate").over(w), "_after": F.lead("OrderDate").over(w)})
    end = F.date_add("OrderDate", days)
    begins = F.col("_before").isNull() | (F.date_add("_before", days) < F.col("OrderDate"))
    ends = F.col("_after").isNull() | (F.col("_after") > end)
    event = F.array_compact(F.array(
        F.when(begins, F.struct(F.col("OrderDate").alias("Date"), F.lit(1).alias("change"))), F.when(ends, F.struct(end.alias("Date"), F.lit(-1).alias("change")))))
    events = seen.select(*keys, F.explode(event).alias("e")).select(*keys, "e.*")
    return events.groupBy(*keys, "Date").agg(F.sum("change").alias("change"))


def _running(changes: DataFrame, keys: list[str], dates: DataFrame) -> DataFrame:
    """(keys, Date, Active Customers) for every date and group with a customer active then. What changed before the
    first date counts at it, so a calendar that begins late loses nothing."""
    calendar = dates.agg(F.array_sort(F.collect_set("Date"))).scalar()  # the days of a calendar
    spine = changes.select(*keys).distinct() if keys else changes.groupBy().agg(F.count(F.lit(1)).alias("_n"))
    spine = spine.withColumn("Date", F.explode(calendar))  # one row for each cell of the report
    both = changes.select(*keys, "Date", "change", F.lit(0).alias("_shown")).unionByName(spine.select(*keys, "Date", F.lit(0).cast("long").alias("change"), F.lit(1).alias("_shown")))
    w = Window.partitionBy(*keys or [F.lit(0)]).orderBy("Date", "_shown").rowsBetween(Window.unboundedPreceding, 0)  # changes and calendar: days
    counted = both.withColumn("Active Customers", F.sum("change").over(w)).where("_shown = 1")
    return counted.where(F.col("Active Customers") > 0).select(*keys, "Date", "Active Customers")


def active_customers(star, by: list[str] = (), filters: dict | None = None, days: int = 60) -> DataFrame:
    """Distinct customers with an order in the ``days`` up to each calendar date, by group, under the filters. A filter
    on the date says which dates are shown; orders before them still count."""
    filters = {c: v for c, v in (filters or {}).items() if _path("fact_orders", _split(c)[0], False) is not None}
    dates = {c: v for c, v in filters.items() if _split(c)[0] == "dim_date"}
    orders, keys = _facts(star, list(by), {c: v for c, v in filters.items() if c not in dates})
    return _running(active_intervals(orders, keys, days), keys, _shown_dates(star, dates))


def _shown_dates(star, filters: dict) -> DataFrame:
    date = star["dim_date"].select(*[F.col(c).alias(f"dim_date.{c}") for c in star["dim_date"].columns])
    return _filtered(date, filters).select(F.col("`dim_date.Date`").alias("Date"), F.col("`dim_date.MonthStart`").alias("MonthStart"))


def evaluate_months(star, by: list[str] = (), filters: dict | None = None, days: int = 60) -> DataFrame:
    """Total Revenue, Revenue PM, Revenue MoM % and Active Customers per month and group of ``by``, under the filters.

    A filter on the date ends what is shown, but a month before it, and the days up to a month's end, still count for
    the months that are shown, as in a report. A month has a row where any of the measures has a value: a quiet month
    after a busy one shows its Revenue PM and the customers still active."""
    filters = {c: v for c, v in (filters or {}).items() if _path("fact_orders", _split(c)[0], False) is not None}
    dates = {c: v for c, v in filters.items() if _split(c)[0] == "dim_date"}
    orders, keys = _facts(star, list(by), {c: v for c, v in filters.items() if c not in dates})
    month = F.trunc("OrderDate", "month").alias("MonthStart")
    revenue_ = orders.groupBy(*keys, month).agg(F.sum("_r").alias("Total Revenue"))
    months = _shown_dates(star, dates).select("MonthStart").distinct()
    ends = month_spine(star).join(months, "MonthStart")
    active = _running(active_intervals(orders, keys, days), keys, ends.select(F.col("MonthEnd").alias("Date")))
    nothing = F.lit(None).cast("double")
    cells = [
        revenue_.select(*keys, "MonthStart", F.col("Total Revenue").alias("r"), nothing.alias("p"), F.lit(None).cast("long").alias("a")),
        revenue_.where("`Total Revenue` is not null").select(*keys, F.to_date(F.add_months("MonthStart", 1)).alias("MonthStart"), nothing.alias("r"), F.col("Total Revenue").alias("p"), F.lit(None).cast("long").alias("a")),
        active.select(*keys, F.trunc("Date", "month").alias("MonthStart"), nothing.alias("r"), nothing.alias("p"), F.col("Active Customers").alias("a")),
    ]
    every = reduce(DataFrame.unionByName, cells).groupBy(*keys, "MonthStart").agg(F.max("r").alias("Total Revenue"), F.max("p").alias("Revenue PM"), F.max("a").alias("Active Customers"))
    change = ratio(F.col("Total Revenue") - F.col("Revenue PM"), F.col("Revenue PM"))
    return every.join(months, "MonthStart").select(*keys, "MonthStart", "Total Revenue", "Revenue PM", change.alias("Revenue MoM %"), "Active Customers")


# --------------------------------------------------------- time intelligence
def month_spine(star) -> DataFrame:
    return star["dim_date"].groupBy("MonthStart").agg(F.max("Date").alias("MonthEnd"))


def revenue_by_month(star) -> DataFrame:
    """Revenue, the month before on a calendar without gaps, and the change."""
    m = star["fact_orders"].filter(done()).groupBy(F.trunc("OrderDate", "month").alias("MonthStart")).agg(
        F.sum("FinalAmount").alias("Total Revenue"))
    w = Window.partitionBy(F.lit(0)).orderBy("MonthStart")  # one row per month
    d = month_spine(star).join(m, "MonthStart", "left").withColumn("Revenue PM", F.lag("Total Revenue").over(w))
    return d.select("MonthStart", "Total Revenue", "Revenue PM",
                    ratio(F.col("Total Revenue") - F.col("Revenue PM"), F.col("Revenue PM")).alias("Revenue MoM %"))


def active_customers_by_month(star, days: int = 60) -> DataFrame:
    """Distinct customers with an order in the days up to each month's end."""
    orders, _ = _facts(star, [], {})
    at = _running(active_intervals(orders, [], days), [], month_spine(star).select(F.col("MonthEnd").alias("Date")))
    return at.select(F.trunc("Date", "month").alias("MonthStart"), "Active Customers")


def revenue_30d_avg(star, days: int = 30) -> DataFrame:
    """Mean of the daily revenues in the days up to each calendar day; days without
    revenue do not count."""
    daily = star["fact_orders"].filter(done()).groupBy(F.col("OrderDate").alias("Date")).agg(F.sum("FinalAmount").alias("r"))
    w = Window.partitionBy(F.lit(0)).orderBy("Date").rowsBetween(-(days - 1), 0)  # one row per day
    return star["dim_date"].select("Date").join(daily, "Date", "left").select("Date", F.avg("r").over(w).alias("Revenue 30d Avg"))


def new_customers_by_month(star) -> DataFrame:
    out = evaluate(star, ["New Customers"], ["dim_date.YearMonth"], inactive=True)
    return out.filter("YearMonth is not null")


def measures_time(star) -> DataFrame:
    return reduce(lambda a, b: a.join(b, "MonthStart", "left"), [revenue_by_month(star), active_customers_by_month(star)])
