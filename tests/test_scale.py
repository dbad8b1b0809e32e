"""Work that grows with the input alone: few state entries, few exchanges, no search that a report does not read."""

import shutil

from pyspark.sql import functions as F

import __spark_entry__ as entry
from orderlens import catalog_ml, store
from orderlens.ml import models
from orderlens.session import new_folder
from orderlens.sources import sample
from orderlens.streaming import jobs


def test_stream_state_has_fewer_entries_than_orders_and_keeps_large_ids(spark):
    folder, out, checkpoint = new_folder(spark), new_folder(spark), new_folder(spark)
    big, n = (1 << 53) + 1, 3 * jobs.ENTRIES
    rows = spark.range(n).select(F.col("id").alias("OrderID"), F.when(F.col("id") % 3 > 0, F.lit(big) + F.col("id") % 2).alias("CustomerID"), F.lit(1).cast("long").alias("Version"))
    rows.coalesce(1).write.parquet(folder)
    stream = jobs.order_stream(spark, folder, rows.schema, files_per_batch=1)
    query = jobs.run(jobs.customer_changes(stream, "Version"), jobs.customer_sums, out, checkpoint)
    assert sum(op["numRowsTotal"] for op in query.lastProgress["stateOperators"]) <= jobs.ENTRIES
    assert {r.CustomerID: r.NewOrders for r in jobs.totals(spark, out, "CustomerID").collect()} == {big: n // 3, big + 1: n // 3}


def test_a_report_searches_only_the_task_it_reads(spark):
    asked, fits = [], []

    class Kept:
        spark = None

        def searched(self, *which):
            asked.extend(which)
            return type("Chosen", (), {"winner": lambda _, w: "Decision Tree"})()

        def task(self, which):
            return which

        def model(self, which, label):
            fits.append((which, label))

        def keep(self, name, build):
            return spark.createDataFrame([("test", "Low", 1)], "Split string, RiskSegment string, Churn int")

    found = catalog_ml.QUERIES["risk_segment_rates"](Kept()).collect()
    assert [tuple(r) for r in found] == [("Low", 1, 1.0)]
    assert set(asked) == {"churn"} and fits == [("churn", "Decision Tree")]


def test_payments_by_window_are_those_of_the_sql(spark):
    rows = [(1, 1, "Failed"), (2, 1, "Refunded"), (3, 1, "Refunded"), (4, 2, "Pending"), (1004, 2, "Pending"), (5, None, "Success"), (6, 3, "Success"), (6, 3, "Success")]
    payments = spark.createDataFrame(rows, "PaymentID long, OrderID long, PaymentStatus string")
    got = sorted(tuple(r) for r in sample.best_payments(payments).collect())
    payments.createOrReplaceTempView("scale_payments")
    sql = sample.definitions("spark")["t_payments"].replace("t_payments_all", "scale_payments").replace("p.PaymentMethod, ", "").replace(", p.TransactionID, p.PaymentDate", "")
    assert got == sorted(tuple(r) for r in spark.sql(sql).collect()) == [(3, 1, "Refunded"), (4, 2, "Pending"), (6, 3, "Success"), (6, 3, "Success"), (1004, 2, "Pending")]


def test_order_facts_store_no_items_and_move_narrow_rows(spark, tmp_path):
    folder = str(tmp_path / "in")
    shutil.copytree("/root/testdata/sf0.001", folder)
    entry.queries()["fact_orders"](spark, folder).count()
    stored = {k[3] for k in sample._layer if k[1] == folder}
    assert "t_orders" in stored and not stored & {"t_order_items", "t_payments", "t_menu"}


def test_reports_of_one_task_leave_the_other_alone(spark, tmp_path, monkeypatch):
    folder = str(tmp_path / "in")
    shutil.copytree("/root/testdata/sf0.001", folder)

    def small(family):
        few = {"Random Forest": "numTrees", "Gradient Boosting": "maxIter"}
        return lambda: {n: m.copy({m.getParam(few[n]): 2}) if n in few else m for n, m in family().items()}

    monkeypatch.setattr(models, "classifiers", small(models.classifiers))
    monkeypatch.setattr(models, "regressors", small(models.regressors))
    for grids in ("CLASSIFICATION_GRIDS", "REGRESSION_GRIDS"):
        monkeypatch.setattr(models, grids, {n: {"maxDepth": [1, 2]} for n in ("Random Forest", "Gradient Boosting", "Decision Tree")})
    ask = {n: entry.queries()[n] for n in ("churn_scores", "cross_validate", "random_search", "measures_ml")}
    scored = ask["churn_scores"](spark, folder)
    assert {r.Split for r in scored.select("Split").distinct().collect()} == {"train", "test"}
    held = {k[3] for k in store._kept if k[1] == folder}
    assert "search/churn" in held and not any("delivery" in n for n in held)
    assert len([n for n in held if n.startswith("churn/")]) == 1  # the chosen model alone is fitted on all rows
    cv = {(r["task"], r["Model"]) for r in ask["cross_validate"](spark, folder).collect()}
    assert len(cv) == 8 and "search/delivery" not in {k[3] for k in store._kept if k[1] == folder}
    assert {(r["task"], r["points"]) for r in ask["random_search"](spark, folder).collect()} == {("delivery", 2), ("churn", 2)}
    assert ask["measures_ml"](spark, folder).first()["Test Customers"] == scored.where("Split = 'test'").count()
    assert spark.sparkContext.getCheckpointDir()
