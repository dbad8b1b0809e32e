"""Streaming queries, run until their input is used up."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderlens.catalog_features import rounded
from orderlens.plans.cleaning import COLUMNS, whole_numbers
from orderlens.session import children, delete_at_end, new_folder, tune
from orderlens.sources.sample import clean_tables
from orderlens.streaming import jobs

def _landed(spark, d):
    """The orders as two drops of files in a folder, as a feed would leave them, and the files of a drop. The first holds
    an early version of most of them, with another status, amount, time and restaurant, and some orders that are only
    corrected later; the second the last version of every order, and some early versions again."""
    t, folder = clean_tables(tune(spark), d), new_folder(spark)
    delete_at_end(spark, folder)
    last = whole_numbers("orders", t["orders"].select(*COLUMNS["orders"])).withColumn("Version", F.lit(2).cast("long"))
    early = last.where("OrderID % 3 > 0").withColumns({
        "OrderStatus": F.lit("Placed"), "FinalAmount": F.col("FinalAmount") + F.col("OrderID") % 7, "DeliveryTimeMinutes": F.lit(None).cast(last.schema["DeliveryTimeMinutes"].dataType),
        "RestaurantID": F.when(F.col("OrderID") % 5 == 0, F.lit(-1)).otherwise(F.col("RestaurantID")), "Version": F.lit(1).cast("long")})
    early.write.mode("append").parquet(folder)
    files = sum(n.endswith(".parquet") for n in children(spark, folder))
    last.unionByName(early.where("OrderID % 4 = 0")).coalesce(files).write.mode("append").parquet(folder)
    return t, folder, last.schema, files


def _run(spark, signed, sums):
    out, checkpoint = new_folder(spark), new_folder(spark)
    delete_at_end(spark, out)
    delete_at_end(spark, checkpoint)
    jobs.run(signed, sums, out, checkpoint)
    return out


def customer_counter(spark, d):
    t, folder, schema, files = _landed(spark, d)
    out = _run(spark, jobs.customer_changes(jobs.order_stream(spark, folder, schema, files_per_batch=files), version="Version"), jobs.customer_sums)
    return jobs.current_totals(t["customers"], jobs.totals(spark, out, "CustomerID"))


def city_kpi(spark, d):
    t, folder, schema, files = _landed(spark, d)
    out = _run(spark, jobs.city_changes(jobs.order_stream(spark, folder, schema, files_per_batch=files), t["restaurants"], version="Version"), jobs.city_sums)
    return rounded(jobs.city_kpis(spark, out), {"TotalRevenue": 2, "AvgDeliveryTime": 6})


def event_counts(spark, d):
    """Distinct events per user from the raw event files."""
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    stream = tune(spark).readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)
    signed = jobs.changes(stream, {"CustomerID": F.col("user_id").cast("long")}, key="event_id")
    out = _run(spark, signed, jobs.customer_sums)
    return jobs.totals(spark, out, "CustomerID").select(F.col("CustomerID").cast(schema["user_id"].dataType).alias("user_id"), F.col("NewOrders").alias("n"))


def queries() -> dict:
    return {"stream_customer_order_counter": customer_counter, "stream_city_kpi": city_kpi, "stream_event_counter": event_counts}
