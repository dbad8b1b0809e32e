"""Declared types of the twelve clean tables."""

from pyspark.sql.types import DateType, DoubleType, LongType, StringType, StructField, StructType

from orderlens.plans.cleaning import COLUMNS, INTEGERS

_DATES = {"RegistrationDate", "JoiningDate", "StartDate", "EndDate", "OrderDate", "PaymentDate", "Date"}
_DOUBLES = {
    "AverageIncome", "Rating", "AverageCost", "Latitude", "Longitude", "Price", "AverageDeliveryTime", "FoodCost",
    "DeliveryFee", "Discount", "GST", "FinalAmount", "UnitPrice", "TotalPrice", "Temperature", "Rainfall", "AverageSpeed",
}


def _type(table: str, col: str):
    if col in INTEGERS[table]:
        return LongType()
    if col in _DATES:
        return DateType()
    return DoubleType() if col in _DOUBLES else StringType()


CLEAN = {t: StructType([StructField(c, _type(t, c)) for c in cols]) for t, cols in COLUMNS.items()}
RAW = {t: StructType([StructField(c, StringType()) for c in cols]) for t, cols in COLUMNS.items()}
