"""Tables are sent to the rows by their rows, not by the bytes of their files: those say little of what the driver has to hold."""

import shutil

import pytest
from pyspark.sql import functions as F

from orderlens.operators import cleaning as op
from orderlens.operators import joins
from orderlens.plans import features
from orderlens.session import materialise
from orderlens.sources import sample


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def few(monkeypatch):
    monkeypatch.setattr(joins, "LOOKUP_ROWS", 50)


def test_many_small_rows_are_not_sent_whole(spark, few):
    people = materialise(spark.range(200).select(F.col("id").alias("CustomerID"), F.lit("a").alias("Membership")))
    child = spark.createDataFrame([(1,), (1,), (500,), (None,)], "CustomerID long")
    known = op.mark_known(child, "CustomerID", people, "ok")
    kept = op.drop_orphans(child, ("CustomerID", people))
    assert "BroadcastHashJoin" not in _plan(known) + _plan(kept)
    assert sorted(map(str, known.collect())) == sorted([*["Row(CustomerID=1, ok=True)"] * 2, "Row(CustomerID=500, ok=False)", "Row(CustomerID=None, ok=False)"])
    assert [r.CustomerID for r in kept.collect()] == [1, 1]
    assert "BroadcastHashJoin" in _plan(op.mark_known(child, "CustomerID", people.limit(20), "ok"))  # few rows are left to Spark


def test_churn_table_does_not_send_its_customers(spark, few, tmp_path):
    folder = str(tmp_path / "in")
    shutil.copytree("/root/testdata/sf0.001", folder)
    t = sample.clean_tables(spark, folder)
    base = t["orders"].withColumns({c: F.lit(1) for c in ("IsCancelled", "IsLate", "HasCoupon", "AvgRating", "WeekendOrder")})
    churn = features.churn_table(base, t)
    assert t["customers"].count() > 50 and "SortMergeJoin" in _plan(churn) and "BroadcastHashJoin" not in _plan(churn)
    assert churn.where("Membership is null").isEmpty()


def test_customers_are_not_sent_to_their_nations(spark, tmp_path):
    folder = str(tmp_path / "in")
    shutil.copytree("/root/testdata/sf0.001", folder)
    for layer in (sample.clean_tables, sample.raw_tables):
        plan = _plan(layer(spark, folder).build("customers"))
        sent = plan[plan.index("BroadcastExchange"):].splitlines()
        assert "n_nationkey" in " ".join(sent[:4]) and "c_custkey" not in " ".join(sent[:4]), plan
