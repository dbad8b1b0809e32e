"""Business definitions shared by all jobs."""

# They must equal the source definitions for equal results.
COMPLETED = ("Delivered", "Delivered Late")
CANCELLED = "Cancelled"
LATE = "Delivered Late"
NOT_DELIVERED = "Food Not Delivered"
PAYMENT_RANK = {"Success": 0, "Refunded": 1, "Pending": 2, "Failed": 3}
TRAFFIC_SCORE = {"Low": 1, "Moderate": 2, "High": 3, "Severe": 4}
CITY_ALIASES = {
    "bangalore": "Bengaluru",
    "bengaluru": "Bengaluru",
    "bombay": "Mumbai",
    "calcutta": "Kolkata",
    "baroda": "Vadodara",
    "new delhi": "Delhi",
    "vizag": "Visakhapatnam",
    "cochin": "Kochi",
    "poona": "Pune",
    "madras": "Chennai",
    "gurgaon": "Delhi",
}
FUZZY_CUTOFF = 0.8
EARTH_RADIUS_KM = 6371
CHURN_HORIZON_DAYS = 60
CLV_EDGES = (250, 500, 750, 1000, 1500, 2000)
CLV_LABELS = ("0-250", "250-500", "500-750", "750-1000", "1000-1500", "1500-2000", "2000+")
# the text tokens a CSV reader of the source takes for a missing value
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
TABLES = (
    "cities", "customers", "restaurants", "menu", "delivery_partners", "promotions",
    "orders", "order_items", "payments", "customer_feedback", "weather", "traffic",
)
