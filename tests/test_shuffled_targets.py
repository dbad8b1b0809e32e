"""The targets of all repeats meet the inputs once, and are those that a join for each repeat gives."""

from collections import Counter

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from orderlens.ml import metrics as mt
from orderlens.ml import models as ml
from orderlens.ml.models import Task


def _task(spark, keys):
    rng = np.random.default_rng(2)
    rows = [(k, rng.normal(size=2).tolist(), float(i), "test" if i % 5 == 0 else "train") for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "id long, x array<double>, label double, Split string")
    return Task(df.withColumn("features", array_to_vector("x")).drop("x").coalesce(1).cache(), ["a", "b"], "id", False)


@pytest.mark.parametrize("keys", [list(range(40)), [None, 7, 7, *range(37)]])
def test_shuffled_targets_are_joined_once(spark, monkeypatch, keys):
    task, seen = _task(spark, keys), []

    class Noted:
        def fit(self, rows):
            seen.append(rows)
            return DecisionTreeRegressor(maxDepth=1).fit(rows)

    task.models = {"Random Forest": Noted()}
    order = mt.donors(task.train, task.key, 2, ml.SEED)
    monkeypatch.setattr(mt, "donors", lambda *_: order)
    assert {r["shuffle"] for r in ml.target_shuffle(task, 2).collect()} == {0, 1, 2}
    assert not any("Join" in df._jdf.queryExecution().optimizedPlan().toString() for df in seen[1:])
    own = task.train.select("id", F.col("label").alias("y"))
    for rep, df in enumerate(seen[1:], 1):
        given = order.where(F.col("rep") == rep).join(own.withColumnRenamed("id", "donor"), "donor").select("id", "y")
        want = task.train.select("id", "features").join(given, "id").select("id", "features", "y")
        assert Counter(map(tuple, df.select("id", "features", "label").collect())) == Counter(map(tuple, want.collect()))
