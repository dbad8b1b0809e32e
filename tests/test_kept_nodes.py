"""Forests keep the nodes of their rows where these are few, and are the same forests."""

import pytest
from pyspark.ml.linalg import Vectors

from orderlens.ml import models


@pytest.mark.parametrize("classify", [False, True])
def test_forests_of_few_rows_keep_nodes_and_are_the_same(spark, monkeypatch, classify):
    rows = [(i, float(i % 2 if classify else i % 17), Vectors.dense(i * 7 % 31, i * 5 % 13, i % 3), "test" if i % 5 == 0 else "train") for i in range(400)]
    data = spark.createDataFrame(rows, ["id", "label", "features", "Split"])
    kept = models.Task(data, ["a", "b", "c"], "id", classify)
    monkeypatch.setattr(models, "KEPT_NODES", 319)
    walked = models.Task(data, ["a", "b", "c"], "id", classify)
    assert kept.train.count() == 320
    forests = [t.models["Random Forest"] for t in (kept, walked)]
    assert [f.getCacheNodeIds() for f in forests] == [True, False]
    one, other = (f.copy({f.numTrees: 5}).fit(kept.train) for f in forests)
    assert one.toDebugString.split("\n")[1:] == other.toDebugString.split("\n")[1:] and "If" in one.toDebugString
