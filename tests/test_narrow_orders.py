"""Orders are moved and stored without what their keys stand for."""

import shutil

import pytest
from pyspark.sql import functions as F

from orderlens.plans import features as ft
from orderlens.session import CODEC, children, dense, materialise
from orderlens.sources import sample

NAMES = ("orders", "restaurants", "customers", "delivery_partners", "order_items", "customer_feedback", "payments", "weather", "traffic")


@pytest.fixture
def t(spark, tmp_path):
    folder = str(tmp_path / "in")
    shutil.copytree("/root/testdata/sf0.001", folder)
    made = sample.clean_tables(spark, folder)
    return {n: made[n] for n in NAMES}


def test_stored_orders_hold_keys_in_place_of_dimensions(spark, t, monkeypatch):
    stored = []

    def noted(df, path=None, store=ft.materialise):
        if "BasketSize" in df.columns:
            stored.append(df.columns)
        return store(df, path)

    monkeypatch.setattr(ft, "materialise", noted)
    out = ft.order_base_table(t)
    assert len(stored) == 1 and not {"RCity", "_rid", "_pid", "AvgRating"} & set(stored[0])
    assert {"RCity", "VehicleType", "AvgRating"} <= set(out.columns) and not {"_rid", "_pid"} & set(out.columns)
    assert out.where("CustomerRating is not null and AvgRating is null or AvgRating < 1").isEmpty() and out.where("AvgRating is null").count() > 0


def test_keys_that_repeat_multiply_the_orders_as_their_joins_do(spark, t):
    twice = t["restaurants"].where("RestaurantID <= 3")
    t["restaurants"] = t["restaurants"].unionByName(twice.withColumn("Area", F.lit("Z"))).unionByName(
        twice.limit(1).withColumn("RestaurantID", F.lit(None).cast("long")))
    t["delivery_partners"] = t["delivery_partners"].unionByName(t["delivery_partners"].where("DeliveryPartnerID <= 2").withColumn("VehicleType", F.lit("Boat")))
    t["orders"] = t["orders"].withColumn("RestaurantID", F.when(F.col("OrderID") % 9 > 0, F.col("RestaurantID")))
    columns = ["OrderID", "RestaurantID", "RCity", "RArea", "DistanceProxyKm", "DeliveryPartnerID", "VehicleType", "PCity", "CCity"]
    got, want = (sorted(map(str, x.select(columns).collect())) for x in (ft.order_base_table(t), ft.with_dimensions(t)))
    assert got == want and len(got) > t["orders"].count()


def test_orders_meet_their_lines_before_their_columns_are_computed(spark, t, tmp_path):
    made = sample.clean_tables(spark, str(tmp_path / "in"))
    text = sample.with_tables("SELECT * FROM t_orders_all", "spark", made.physical)
    late = made.build("orders_all")
    assert sorted(map(str, late.collect())) == sorted(map(str, spark.sql(text).collect())) and late.dtypes == spark.sql(text).dtypes
    join = late._jdf.queryExecution().optimizedPlan().toString().split("Join LeftOuter")[1]
    assert "PaymentMethod" not in join and "DeliveryFee" not in join


def test_dense_tables_leave_the_setting_as_it_was(spark):
    before = spark.conf.get(CODEC)
    with dense(spark):
        stored = materialise(spark.range(5))
    assert spark.conf.get(CODEC) == before and any(n.endswith(".zstd.parquet") for n in children(spark, stored.stored_at))
    assert stored.count() == 5 and any(".zstd" in n for n in children(spark, materialise(spark.range(3), codec="zstd").stored_at))
