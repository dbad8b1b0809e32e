"""The order table moves its rows twice and numbers no lines."""

import shutil

from pyspark.sql import functions as F

from orderlens.plans import features as ft
from orderlens.sources import sample


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


class Payments:
    def __init__(self, rows):
        self.rows = rows

    def payment_states(self):
        return sample.payment_states(self.rows)

    def view(self, name):
        assert name == "payments"
        return sample.best_payments(self.rows)


def test_statuses_by_aggregate_are_those_of_the_numbered_payments(spark):
    rows = [(1, 1, "Failed"), (2, 1, "Refunded"), (3, 1, "Refunded"), (1004, 2, "Pending"), (5, None, "Success"), (3006, 3, "Success"), (4001, 4, "?"), (4002, 4, None)]
    long = [(7000 + i, 7, "Success" if i % 1000 == 5 else "Failed") for i in range(1, 2200)]  # numbers 5, 1005 and 2005 are alike by 1000
    payments = spark.createDataFrame([*rows, *long], "PaymentID long, OrderID long, PaymentStatus string").withColumn(
        "PaymentStatus", F.when(F.col("PaymentStatus").isin(*sample.STATUSES), F.col("PaymentStatus")).otherwise("Failed"))
    orders = spark.createDataFrame([(i,) for i in (None, 1, 2, 3, 3, 4, 7, 9)], "OrderID long")
    got = sorted(map(str, ft.with_payment(orders, Payments(payments)).collect()))
    want = orders.join(sample.best_payments(payments).select("OrderID", "PaymentStatus"), "OrderID", "left")
    assert got == sorted(map(str, want.collect())) and sum("OrderID=7" in r for r in got) == 3


def test_basket_and_payments_number_no_lines_and_feedback_reads_stored_orders(spark, tmp_path):
    folder = str(tmp_path / "in")
    shutil.copytree("/root/testdata/sf0.001", folder)
    t = sample.clean_tables(spark, folder)
    assert "Window" not in _plan(ft.basket(t)) and "Window" not in _plan(t.payment_states())
    assert "Window" in _plan(t.view("payments"))
    before = t.build("customer_feedback").orderBy("OrderID").collect()
    t["orders"]
    again = t.build("customer_feedback")
    assert "Aggregate" not in _plan(again) and again.orderBy("OrderID").collect() == before


def test_orders_move_by_their_key_and_by_their_customer_alone(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "in")
    shutil.copytree("/root/testdata/sf0.001", folder)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    moved = []

    def noted(df, path=None, store=ft.materialise):
        plan = df._jdf.queryExecution().executedPlan().toString()
        if "BasketSize" in df.columns:
            moved.append(plan)
        return store(df, path)

    monkeypatch.setattr(ft, "materialise", noted)
    try:
        out = ft.order_base_table(sample.clean_tables(spark, folder))
        final = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    wide = [line for plan in (*moved, final) for line in plan.splitlines() if "Exchange hashpartitioning(CustomerID" in line]
    assert len(moved) == 1 and moved[0].count("Exchange hashpartitioning(OrderID") == 4 and "hashpartitioning(CustomerID" not in moved[0]
    assert "hashpartitioning(OrderID" not in final and len(wide) == 4  # orders, customers, totals, both of them together
    assert out.count() == sample.clean_tables(spark, folder)["orders"].count()
