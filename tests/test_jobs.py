import datetime as dt
import glob
import os

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

import __spark_entry__ as entry
from orderlens.ml import prep
from orderlens.session import new_folder
from orderlens.sources import files
from orderlens.sources.schemas import CLEAN
from orderlens.streaming import jobs
from tools.check import rows_of

SF = "/root/testdata/sf0.001"
SAMPLE = [
    "a1_top_restaurants_revenue", "b4_partner_pairs_self", "d2_last_order_cancelled", "e1_rank_in_city", "e3_order_lag_lead", "e4_recency_rank",
    "h1_delivery_by_weather", "h4_partner_top_decile", "audit_orphans", "clean_orders", "clean_weather", "clean_feedback", "parse_mixed_dates",
    "profile_tables", "validation_report", "order_base_table", "churn_table", "restaurant_scorecard", "measures_time", "kpi_headline", "chart_pivots",
    "dash_customer", "classification_metrics", "chi2_statistic", "stream_city_kpi",
]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(SF + "/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


def test_entry(spark):
    assert entry.entry(spark).count() >= 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(entry.oracle_sql()[name])
    assert got == rows_of([d[0] for d in cur.description], cur.fetchall())


def _order(i, customer, day, minutes=30):
    at = dt.date(2024, 1, 1) + dt.timedelta(days=day)
    return (i, customer, 1, 1, at, "10:00:00", minutes, 100.0, 20.0, 0.0, None, 5.0, 125.0, "Delivered", "Card")


def test_stream_counts_each_order_once_over_batches(spark):
    folder, out, checkpoint = new_folder(spark), new_folder(spark), new_folder(spark)
    first = [_order(1, 7, 0), _order(2, 7, 0), _order(3, 8, 0)]
    second = [_order(2, 7, 0), _order(4, 7, 1), _order(5, 8, 1)]  # order 2 is sent again
    for rows in (first, second):
        spark.createDataFrame(rows, CLEAN["orders"]).coalesce(1).write.mode("append").parquet(folder)
        jobs.run(jobs.customer_changes(jobs.order_stream(spark, folder, files_per_batch=1)), jobs.customer_sums, out, checkpoint)  # a restart each time
    got = {r.CustomerID: r.NewOrders for r in jobs.totals(spark, out, "CustomerID").collect()}
    assert got == {7: 3, 8: 2}
    people = spark.createDataFrame([(7, 10), (9, 4)], "CustomerID long, TotalOrders long")
    totals = {r.CustomerID: r.TotalOrders for r in jobs.current_totals(people, jobs.totals(spark, out, "CustomerID")).collect()}
    assert totals == {7: 13, 9: 4}


def test_stream_totals_follow_changed_orders_over_restarts(spark):
    schema = StructType([*CLEAN["orders"].fields, StructField("Version", LongType())])
    folder, out, checkpoint = new_folder(spark), new_folder(spark), new_folder(spark)
    cities = spark.createDataFrame([(1, "A"), (2, "B")], "RestaurantID long, City string")

    def row(i, version, restaurant=1, amount=10.1, minutes=30):
        r = list(_order(i, 7, 0, minutes))
        r[2], r[12] = restaurant, amount
        return (*r, version)

    spark.conf.unset(jobs.STATE_CONF)
    batches = [
        [row(1, 1), row(2, 1, 2, 5.0), row(3, 1, 9)],  # restaurant 9 is unknown
        [row(1, 2, 2, 20.2, 50), row(2, 1, 1, 99.0), row(3, 3, 1, 1.0, None), row(3, 2, 2, 7.0)],  # order 1 moves, a repeat of version 1 is ignored
        [row(3, 1, 2), row(2, 5, 9)],  # a late version is ignored; order 2 has no city any more
    ]
    want = [{"A": (1, 10.1, 30.0), "B": (1, 5.0, 30.0)}, {"A": (1, 1.0, None), "B": (2, 25.2, 40.0)}, {"A": (1, 1.0, None), "B": (1, 20.2, 50.0)}]
    for rows, totals in zip(batches, want, strict=True):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        query = jobs.run(jobs.city_changes(jobs.order_stream(spark, folder, schema, files_per_batch=1), cities, "Version"), jobs.city_sums, out, checkpoint)
        assert {r.City: (r.TotalOrders, r.TotalRevenue, r.AvgDeliveryTime) for r in jobs.city_kpis(spark, out).collect()} == totals
        assert any("rocksdb" in k.lower() for p in query.recentProgress for op in p["stateOperators"] for k in op["customMetrics"])
    assert spark.conf.get(jobs.STATE_CONF) == jobs.DISK_STATE
    jobs.compact(spark, out, "City", number=2)
    assert os.listdir(f"{out}/batches") == [] and os.listdir(f"{out}/compacted") == ["upto=2"]
    assert {r.City: (r.TotalOrders, r.TotalRevenue, r.AvgDeliveryTime) for r in jobs.city_kpis(spark, out).collect()} == want[-1]


def test_read_raw_text(spark):
    folder = new_folder(spark)
    os.makedirs(folder)
    with open(f"{folder}/cities.csv", "w") as f:
        f.write("CityID,City,Population,Region,AverageIncome\n1,  Delhi,100,North,NA\n2,Pune ,x,,nan\n")
    rows = files.read_raw_text(spark, "cities", folder).orderBy("SourceRow").collect()
    assert [tuple(r)[1:] for r in rows] == [("1", "Delhi", "100", "North", None), ("2", "Pune ", "x", None, None)]
    with pytest.raises(FileNotFoundError):
        files.read_raw_text(spark, "orders", folder)


def test_literal_rows(spark):
    got = files.insert_rows(spark, "cities", [(1, "Delhi", 100, "North", 5.0)])
    assert got.first().City == "Delhi" and got.schema == CLEAN["cities"]


def test_facts_are_split_by_month(spark):
    folder = new_folder(spark)
    f = spark.createDataFrame([(1, dt.date(2024, 1, 3)), (2, dt.date(2024, 2, 3))], "OrderID int, OrderDate date")
    files.export_tables({"fact_orders": f}, folder, by_month=("fact_orders",))
    one = spark.read.parquet(f"{folder}/fact_orders").filter("OrderMonth = '2024-01'")
    assert one.count() == 1 and "PartitionFilters: [isnotnull(OrderMonth" in one._jdf.queryExecution().toString()


def test_split_does_not_depend_on_partitions(spark):
    df = spark.range(500).withColumn("label", (F.col("id") % 3 == 0).cast("int"))
    a = prep.split(df.repartition(3), "id", stratify="label").filter("Split = 'test'")
    b = prep.split(df.repartition(7), "id", stratify="label").filter("Split = 'test'")
    assert sorted(r.id for r in a.collect()) == sorted(r.id for r in b.collect())
    assert {r.label: r["count"] for r in a.groupBy("label").count().collect()} == {0: 67, 1: 33}


def test_no_cross_join_in_plans(spark):
    for name in ("a1_top_restaurants_revenue", "d1_above_avg_cost", "h1_delivery_by_weather", "attach_nearest_traffic", "restaurant_scorecard"):
        plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
