"""The twelve table cleaning jobs, the log of what they changed, and their order.

A job keeps every row with marker columns (one per rule) until the end, so the
clean table and its log come from the same plan: the table drops the marked
rows, the log sums the markers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions.dates import parse_mixed_dates
from orderlens.functions.text import clean_text, digits_or_null, title_case, to_number, truncate_time, upper_code
from orderlens.operators import cleaning as op
from orderlens.operators import selection
from orderlens.session import DENSE, materialise


class Job:
    def __init__(self, table: str, df: DataFrame, unread: tuple[str, ...] = ()):
        """``unread``: columns that nothing reads behind the search for repeated keys."""
        self.table, self.df, self.unread = table, df, unread
        self.rules: list[tuple[str, str, str]] = []
        self.dropped: list[str] = []

    def note(self, issue: str, column: str, action: str, hit: Column, drop: bool = False) -> None:
        name = f"_m{len(self.rules)}"
        self.df = self.df.withColumn(name, F.coalesce(hit.cast("long"), F.lit(0)))
        self.rules.append((issue, column, action))
        if drop:
            self.dropped.append(name)

    def set(self, **cols: Column) -> None:
        self.df = self.df.withColumns(cols)

    def text(self, *cols: str) -> None:
        self.set(**{c: clean_text(F.col(c)) for c in cols})

    def number(self, *cols: str) -> None:
        self.set(**{c: to_number(F.col(c)) for c in cols})

    def ids(self, *cols: str) -> None:
        self.set(**{c: to_number(F.col(c)).cast("long") for c in cols})

    def absolute(self, col: str, log: bool = True) -> None:
        if log:
            self.note("negative value (sign flip)", col, "absolute value", F.col(col) < 0)
        self.set(**{col: F.abs(col)})

    def invalidate(self, col: str, bad: Column, issue: str) -> None:
        self.note(issue, col, "set NULL", bad)
        self.set(**{col: F.when(~F.coalesce(bad, F.lit(False)), F.col(col))})

    def missing(self, col: str, action: str) -> None:
        self.note("missing", col, action, F.col(col).isNull())

    def unknown(self, *cols: str) -> None:
        for c in cols:
            self.missing(c, "filled 'Unknown'")
        self.set(**{c: F.coalesce(F.col(c), F.lit("Unknown")) for c in cols})

    def date(self, col: str, every_row: bool = True, ambiguous: bool = True) -> None:
        self.set(_d=parse_mixed_dates(F.col(col)))
        if every_row:
            self.note("mixed date formats", col, "parsed", F.lit(1))
        if ambiguous:
            self.note("ambiguous slash date", col, "day first", F.col("_d.ambiguous"))
        self.set(**{col: F.col("_d.parsed")})
        self.df = self.df.drop("_d")

    def city(self, cities: DataFrame) -> None:
        before = F.coalesce(F.col("City"), F.lit(""))
        self.df = op.canonical_city(self.df.withColumn("_before", before), cities)
        self.note("city spelling", "City", "canonical name", F.coalesce(F.col("City"), F.lit("")) != F.col("_before"))
        self.df = self.df.drop("_before")

    def one(self, df: DataFrame, first, sums: tuple = ()) -> None:
        """One row of each key, by ``first``. Places, and columns that are not read behind it, are not moved; the latter are NULL."""
        gone = {c: F.lit(None).cast(df.schema[c].dataType) for c in self.unread}
        self.df = first(df, count="_extra", sums=sums, without=(op.SRC, *gone)).withColumns(gone)

    def unique(self, key: str, exact: bool = False) -> None:
        df = op.dedupe_rows(self.df) if exact else self.df
        self.one(df, lambda d, **how: op.dedupe_key(d, [key], **how), ("copies",) if exact else ())
        if exact:
            self.note("duplicate rows", "all", "dropped copies", F.col("copies"))
        self.note("duplicate rows", key, "kept the first", F.col("_extra"))
        self.df = self.df.drop("copies", "_extra")

    def known(self, column: str, *keys: tuple[str, DataFrame]) -> None:
        ok = F.lit(True)
        for i, (key, parent) in enumerate(keys):
            self.df = op.mark_known(self.df, key, parent, f"_k{i}")
            ok = ok & F.col(f"_k{i}")
        self.note("orphan FK", column, "dropped", ~ok, drop=True)
        self.df = self.df.drop(*[f"_k{i}" for i in range(len(keys))])

    def rows(self, *columns: str) -> DataFrame:
        out = self.df
        for d in self.dropped:
            out = out.filter(F.col(d) == 0)
        return out.select(*columns)

    def log(self) -> DataFrame:
        entries = [
            F.struct(
                F.lit(self.table).alias("table"), F.lit(issue).alias("issue"), F.lit(column).alias("column"),
                F.sum(f"_m{i}").alias("rows_affected"), F.lit(action).alias("action"))
            for i, (issue, column, action) in enumerate(self.rules)
        ]
        one = self.df.agg(F.array(*entries).alias("e"))
        return one.select(F.explode("e").alias("e")).select("e.*").filter("rows_affected > 0")



COLUMNS = {
    "cities": ("CityID", "City", "Population", "Region", "AverageIncome"),
    "customers": ("CustomerID", "Name", "Age", "Gender", "Phone", "Email", "City", "State", "Pincode",
                  "RegistrationDate", "Membership", "TotalOrders", "PreferredCuisine"),
    "restaurants": ("RestaurantID", "RestaurantName", "Cuisine", "City", "Area", "OpeningTime", "ClosingTime", "Rating",
                    "AverageCost", "OwnerName", "RestaurantType", "Latitude", "Longitude"),
    "menu": ("FoodItemID", "RestaurantID", "FoodName", "Category", "Price", "PreparationTime", "Calories", "Availability"),
    "delivery_partners": ("DeliveryPartnerID", "Name", "Age", "Gender", "VehicleType", "JoiningDate", "City", "Rating",
                          "CompletedDeliveries", "AverageDeliveryTime"),
    "promotions": ("PromotionID", "CouponCode", "DiscountPercentage", "CampaignName", "StartDate", "EndDate"),
    "orders": ("OrderID", "CustomerID", "RestaurantID", "DeliveryPartnerID", "OrderDate", "OrderTime", "DeliveryTimeMinutes",
               "FoodCost", "DeliveryFee", "Discount", "CouponCode", "GST", "FinalAmount", "OrderStatus", "PaymentMethod"),
    "order_items": ("OrderItemID", "OrderID", "FoodItemID", "Quantity", "UnitPrice", "TotalPrice"),
    "payments": ("PaymentID", "OrderID", "PaymentMethod", "PaymentStatus", "TransactionID", "PaymentDate"),
    "customer_feedback": ("FeedbackID", "OrderID", "CustomerRating", "DeliveryRating", "FoodRating", "Review", "Sentiment"),
    "weather": ("WeatherID", "City", "Date", "Temperature", "Rainfall", "Humidity", "WeatherCondition"),
    "traffic": ("TrafficID", "City", "Date", "Time", "TrafficLevel", "AverageSpeed"),
}
# columns stored as whole numbers
INTEGERS = {
    "cities": {"CityID", "Population"}, "customers": {"CustomerID", "Age", "TotalOrders"}, "restaurants": {"RestaurantID"},
    "menu": {"FoodItemID", "RestaurantID", "PreparationTime", "Calories"},
    "delivery_partners": {"DeliveryPartnerID", "Age", "CompletedDeliveries"},
    "promotions": {"PromotionID", "DiscountPercentage"},
    "orders": {"OrderID", "CustomerID", "RestaurantID", "DeliveryPartnerID", "DeliveryTimeMinutes"},
    "order_items": {"OrderItemID", "OrderID", "FoodItemID", "Quantity"}, "payments": {"PaymentID", "OrderID"},
    "customer_feedback": {"FeedbackID", "OrderID", "CustomerRating", "DeliveryRating", "FoodRating"},
    "weather": {"WeatherID", "Humidity"}, "traffic": {"TrafficID"},
}


# columns that no rule of the log reads once the copies of a key are told apart
UNREAD = {
    "customers": ("Name", "TotalOrders"), "menu": ("FoodName", "PreparationTime", "Availability"),
    "orders": ("OrderTime", "DeliveryFee", "Discount", "GST", "OrderStatus", "PaymentMethod"), "order_items": ("UnitPrice",),
    "payments": ("PaymentID", "PaymentMethod", "PaymentStatus", "PaymentDate"), "customer_feedback": ("FeedbackID", "Sentiment"),
}


def whole_numbers(table: str, df: DataFrame) -> DataFrame:
    ints = INTEGERS[table]
    return df.select(*[F.bround(F.col(c)).cast("long").alias(c) if c in ints else F.col(c) for c in df.columns])


class Cleaner:
    """Builds the jobs in key order; ``raw`` maps a table name to an all-text
    DataFrame with its SourceRow. Nothing runs before a table or log is used,
    except the statistics that need ordered blocks and the keys of orders and
    menu, which several jobs look up."""

    def __init__(self, raw):
        self.raw = raw
        self._jobs: dict[str, Job] = {}
        self._keys: dict[str, DataFrame] = {}

    def counted(self, table: str) -> Job:
        """The job as its log needs it: rows meet their copies without the columns that no rule reads."""
        return getattr(self, f"_{table}")(UNREAD[table]) if table in UNREAD else self.job(table)

    def job(self, table: str) -> Job:
        if table not in self._jobs:
            self._jobs[table] = getattr(self, f"_{table}")()
        return self._jobs[table]

    def table(self, table: str) -> DataFrame:
        return whole_numbers(table, self.job(table).rows(*COLUMNS[table]))

    def keys(self, table: str) -> DataFrame:
        """The keys that survive in a parent table, from its raw keys alone: a child
        job never needs the parent's cleaned values. Stored where finding them moves rows."""
        if table not in self._keys:
            found = self._surviving(table)
            self._keys[table] = materialise(found, codec=DENSE) if table in ("menu", "orders") else found
        return self._keys[table]

    def _surviving(self, table: str) -> DataFrame:
        if table == "cities":
            return self.raw["cities"].select(title_case(clean_text(F.col("City"))).alias("City"))
        if table == "promotions":
            return self.raw["promotions"].select(upper_code(F.col("CouponCode")).alias("CouponCode"))
        if table == "menu":
            links = (("RestaurantID", "restaurants"),)
        elif table == "orders":
            links = (("CustomerID", "customers"), ("RestaurantID", "restaurants"), ("DeliveryPartnerID", "delivery_partners"))
        else:
            links = ()
        key = COLUMNS[table][0]
        raw = self.raw[table].select(key, *[c for c, _ in links], op.SRC)
        first = op.dedupe_key(raw, [key]) if links else raw
        typed = first.select(*[to_number(F.col(c)).cast("long").alias(c) for c in (key, *[c for c, _ in links])])
        return op.drop_orphans(typed, *[(c, self.keys(t)) for c, t in links]).select(key)

    def log(self, tables=None) -> DataFrame:
        parts = [self.counted(t).log() for t in tables or COLUMNS]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def _start(self, table: str, unread: tuple[str, ...] = ()) -> Job:
        return Job(table, self.raw[table], unread)

    def _cities(self) -> Job:
        j = self._start("cities")
        j.ids("CityID", "Population")
        j.number("AverageIncome")
        j.set(City=title_case(clean_text(F.col("City"))))
        j.missing("AverageIncome", "region median")
        j.df = op.impute_group_median(j.df, "AverageIncome", "Region", bounded=True)  # one row per city
        return j

    def _customers(self, unread: tuple[str, ...] = ()) -> Job:
        j = self._start("customers", unread)
        j.unique("CustomerID", exact=True)
        j.text("Name", "Email", "Gender", "State", "Membership", "PreferredCuisine")
        j.ids("CustomerID")
        j.number("Age", "TotalOrders")
        j.absolute("Age")
        j.invalidate("Age", (F.col("Age") > 100) | (F.col("Age") < 10), "implausible")
        j.missing("Age", "median")
        j.set(Age=F.bround(F.coalesce(F.col("Age"), op.global_median(j.df, "Age", bounded=True))))
        j.set(Phone=digits_or_null(F.col("Phone"), 10), Pincode=digits_or_null(F.col("Pincode"), 6, strip_sign=True))
        j.note("invalid or missing phone", "Phone", "set NULL", F.col("Phone").isNull())
        j.note("malformed pincode", "Pincode", "set NULL", F.col("Pincode").isNull())
        j.unknown("Gender", "Membership", "PreferredCuisine", "State")
        j.missing("Email", "left NULL")
        j.date("RegistrationDate")
        j.set(TotalOrders=F.greatest(F.coalesce(F.col("TotalOrders"), F.lit(0.0)), F.lit(0.0)))
        # last, so that the statistics above are taken without the name join
        j.city(self.keys("cities"))
        return j

    def _restaurants(self) -> Job:
        j = self._start("restaurants")
        j.unique("RestaurantID")
        j.text("RestaurantName", "Cuisine", "Area", "OwnerName", "RestaurantType")
        j.ids("RestaurantID")
        j.number("Rating", "AverageCost", "Latitude", "Longitude")
        j.unknown("Cuisine")
        j.absolute("AverageCost")
        j.invalidate("Rating", F.col("Rating") > 5, "rating out of 1-5")
        j.missing("Rating", "cuisine median")
        # ratings have one decimal: a few dozen distinct values
        j.df = op.impute_group_median(j.df, "Rating", "Cuisine", then_global=True, bounded=True)
        j.set(Rating=F.bround(F.col("Rating"), 1))
        # last, so that the statistics above are taken without the name join
        j.city(self.keys("cities"))
        return j

    def _menu(self, unread: tuple[str, ...] = ()) -> Job:
        j = self._start("menu", unread)
        j.unique("FoodItemID")
        j.ids("FoodItemID", "RestaurantID")
        j.number("Price", "PreparationTime", "Calories")
        j.text("FoodName", "Category")
        j.absolute("Price")
        j.missing("Calories", "category median")
        j.df = op.impute_group_median(j.df, "Calories", "Category", bounded=True)
        j.set(Calories=F.bround(F.col("Calories")))
        j.known("RestaurantID", ("RestaurantID", self.keys("restaurants")))
        return j

    def _delivery_partners(self) -> Job:
        j = self._start("delivery_partners")
        j.unique("DeliveryPartnerID")
        j.ids("DeliveryPartnerID")
        j.number("Age", "Rating", "CompletedDeliveries", "AverageDeliveryTime")
        j.text("Name", "VehicleType")
        j.absolute("AverageDeliveryTime")
        j.missing("Rating", "median")
        j.set(Rating=F.coalesce(F.col("Rating"), op.global_median(j.df, "Rating", bounded=True)))
        j.date("JoiningDate", ambiguous=False)
        j.df = op.cap_iqr(j.df, "AverageDeliveryTime")
        j.note("extreme outlier (3 IQR)", "AverageDeliveryTime", "capped", F.col("AverageDeliveryTime_outlier"))
        # last, so that the statistics above are taken without the name join
        j.city(self.keys("cities"))
        return j

    def _promotions(self) -> Job:
        j = self._start("promotions")
        j.set(CouponCode=upper_code(F.col("CouponCode")))
        j.text("CampaignName")
        j.ids("PromotionID", "DiscountPercentage")
        j.set(StartDate=parse_mixed_dates(F.col("StartDate"))["parsed"], EndDate=parse_mixed_dates(F.col("EndDate"))["parsed"])
        j.df = op.swap_reversed(j.df)
        df = op.dedupe_key(j.df.withColumn("swapped", F.col("swapped").cast("long")), ["CouponCode"], count="_extra", sums=("swapped",))
        j.df = df
        j.note("end before start", "StartDate,EndDate", "swapped", F.col("swapped"))
        j.note("duplicate rows", "CouponCode", "kept the first", F.col("_extra"))
        return j

    def _weather(self) -> Job:
        j = self._start("weather")
        j.ids("WeatherID")
        j.number("Temperature", "Rainfall", "Humidity")
        j.city(self.keys("cities"))
        j.df = op.fill_city_blocks(j.df)
        j.note("missing", "City", "from neighbouring rows", F.col("recovered"))
        j.date("Date")
        j.text("WeatherCondition")
        j.absolute("Humidity")
        j.set(Humidity=F.least(F.col("Humidity"), F.lit(100.0)))
        # all of them before the gaps are filled
        limits = selection.percentiles(j.df, {"Rainfall": [0.5, 0.99], "Temperature": [0.995]}, [["WeatherCondition"], []])
        j.missing("Rainfall", "condition median")
        j.df = op.impute_group_median(j.df, "Rainfall", "WeatherCondition", medians=limits.table(["WeatherCondition"], {"_med": ("Rainfall", 0.5)}))
        j.df = op.cap_percentile(j.df, "Rainfall", 0.99, limits.scalar("Rainfall", 0.99))
        j.note("extreme outlier", "Rainfall", "capped at P99", F.col("Rainfall_outlier"))
        j.df = op.cap_percentile(j.df, "Temperature", 0.995, limits.scalar("Temperature", 0.995))
        j.note("extreme outlier", "Temperature", "capped at P99.5", F.col("Temperature_outlier"))
        return j

    def _traffic(self) -> Job:
        j = self._start("traffic")
        j.ids("TrafficID")
        j.number("AverageSpeed")
        j.date("Date")
        j.absolute("AverageSpeed")
        j.df = op.cap_percentile(j.df, "AverageSpeed", 0.99)
        j.note("extreme outlier", "AverageSpeed", "capped at P99", F.col("AverageSpeed_outlier"))
        j.text("TrafficLevel")
        j.df = op.infer_nearest_class(j.df, "TrafficLevel", "AverageSpeed")
        j.note("missing", "TrafficLevel", "nearest class median", F.col("TrafficLevel_inferred"))
        j.set(Time=truncate_time(F.col("Time"), 5))
        # last, so that the statistics above are taken without the name join
        j.city(self.keys("cities"))
        return j

    def _orders(self, unread: tuple[str, ...] = ()) -> Job:
        j = self._start("orders", unread)
        j.unique("OrderID", exact=True)
        j.ids("OrderID", "CustomerID", "RestaurantID", "DeliveryPartnerID")
        j.number("DeliveryTimeMinutes", "FoodCost", "DeliveryFee", "Discount", "GST", "FinalAmount")
        j.text("OrderStatus", "PaymentMethod")
        j.set(CouponCode=upper_code(F.col("CouponCode")))
        j.df = op.resolve_ambiguous_dates(j.df, "OrderDate", "OrderID", op.first_payment_dates(self.raw["payments"]))
        j.note("ambiguous slash date", "OrderDate", "by payment date, else day first", F.col("ambiguous"))
        j.note("ambiguous date flipped", "OrderDate", "month first", F.col("flipped"))
        j.set(OrderTime=truncate_time(F.col("OrderTime"), 8))
        j.absolute("FoodCost")
        j.absolute("DeliveryTimeMinutes")
        j.invalidate("DeliveryTimeMinutes", F.col("DeliveryTimeMinutes") <= 0, "zero delivery time")
        j.invalidate("DeliveryTimeMinutes", F.col("DeliveryTimeMinutes") > 180, "unrealistic delivery time")
        j.missing("FinalAmount", "recomputed")
        # the fee keeps its sign here and is corrected after
        j.set(FinalAmount=F.coalesce(
            F.col("FinalAmount"), F.col("FoodCost") + F.col("DeliveryFee") - F.col("Discount") + F.col("GST")))
        j.absolute("DeliveryFee", log=False)
        j.known("CustomerID,RestaurantID,DeliveryPartnerID", ("CustomerID", self.keys("customers")),
                ("RestaurantID", self.keys("restaurants")), ("DeliveryPartnerID", self.keys("delivery_partners")))
        j.df = op.mark_known(j.df, "CouponCode", self.keys("promotions"), "_coupon")
        kept = F.col(j.dropped[-1]) == 0
        j.note("unknown coupon", "CouponCode", "set NULL", kept & F.col("CouponCode").isNotNull() & ~F.col("_coupon"))
        j.set(CouponCode=F.when(F.col("_coupon"), F.col("CouponCode")))
        return j

    def _order_items(self, unread: tuple[str, ...] = ()) -> Job:
        j = self._start("order_items", unread)
        j.unique("OrderItemID")
        j.ids("OrderItemID", "OrderID", "FoodItemID")
        j.number("Quantity", "UnitPrice", "TotalPrice")
        j.absolute("Quantity")
        j.missing("TotalPrice", "quantity x unit price")
        j.set(TotalPrice=F.coalesce(F.col("TotalPrice"), F.col("Quantity") * F.col("UnitPrice")))
        j.known("OrderID,FoodItemID", ("OrderID", self.keys("orders")), ("FoodItemID", self.keys("menu")))
        return j

    def _payments(self, unread: tuple[str, ...] = ()) -> Job:
        j = self._start("payments", unread)
        j.df = op.dedupe_rows(j.df)
        j.ids("PaymentID", "OrderID")
        j.text("PaymentStatus")
        j.set(parsed=F.lit(1))
        j.one(j.df, op.best_status_row, ("copies", "parsed"))
        # the columns that do not choose the row are read in the chosen ones alone
        j.text("PaymentMethod", "TransactionID")
        j.set(PaymentDate=parse_mixed_dates(F.col("PaymentDate"))["parsed"])
        j.note("duplicate rows", "all", "dropped copies", F.col("copies"))
        j.note("mixed date formats", "PaymentDate", "parsed", F.col("parsed"))
        j.note("multiple payments per order", "OrderID", "kept the best status", F.col("_extra"))
        j.missing("TransactionID", "left NULL")
        j.known("OrderID", ("OrderID", self.keys("orders")))
        return j

    def _customer_feedback(self, unread: tuple[str, ...] = ()) -> Job:
        j = self._start("customer_feedback", unread)
        j.unique("OrderID", exact=True)
        j.ids("FeedbackID", "OrderID")
        ratings = ["CustomerRating", "DeliveryRating", "FoodRating"]
        j.number(*ratings)
        for c in ["DeliveryRating", "FoodRating", "CustomerRating"]:
            j.invalidate(c, F.col(c) > 5, "rating out of 1-5")
        for c in ratings:
            j.missing(c, "mean of the other two")
        j.df = op.impute_row_mean(j.df, ratings)
        j.text("Review", "Sentiment")
        j.missing("Review", "left NULL")
        j.known("OrderID", ("OrderID", self.keys("orders")))
        return j


def log_summary(log: DataFrame, n: int = 10) -> DataFrame:
    return (
        log.filter("issue <> 'mixed date formats'").groupBy("table", "issue", "column")
        .agg(F.sum("rows_affected").alias("rows")).orderBy(F.desc("rows"), "table", "issue", "column").limit(n)
    )


def log_by_table(log: DataFrame) -> DataFrame:
    return log.groupBy("table").agg(F.sum("rows_affected").alias("rows"), F.count(F.lit(1)).alias("entries"))
