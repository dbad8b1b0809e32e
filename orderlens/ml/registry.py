"""Fitted models by name and input version, with what is needed to use them.

A model is fitted once and saved beside its facts: names of the inputs, scores on the test rows, the input's version. Whoever
asks again for the same name and version loads it and scores by ``transform``; a changed input has another version and is
fitted anew. The folder is one that all executors share."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.ml.models import Task
from orderlens.session import exists


class Registry:
    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def path(self, name: str, version: str) -> str:
        return f"{self.folder}/{hashlib.sha256(f'{name}|{version}'.encode()).hexdigest()[:24]}"

    def save(self, name: str, version: str, model, task: Task) -> None:
        """The facts are written last: a model without them counts as absent and is written over."""
        path = self.path(name, version)
        model.write().overwrite().save(f"{path}/model")
        scores = task.judge(task.predict(model, task.test)).select(F.to_json(F.struct("*")).alias("scores"))
        facts = scores.select(
            F.lit(name).alias("name"), F.lit(version).alias("version"), F.lit(json.dumps(task.names)).alias("features"), F.lit(task.key).alias("key"), "scores")
        facts.coalesce(1).write.mode("overwrite").json(f"{path}/facts")

    def facts(self, name: str, version: str) -> dict | None:
        path = f"{self.path(name, version)}/facts"
        if not exists(self.spark, f"{path}/_SUCCESS"):
            return None
        found = self.spark.read.schema("name string, version string, features string, key string, scores string").json(path).first()
        return {**found.asDict(), "features": json.loads(found["features"]), "scores": json.loads(found["scores"])}

    def load_or_fit(self, name: str, version: str, task: Task, fit: Callable):
        """The saved model, if its inputs are those of the task; else a new one."""
        facts = self.facts(name, version)
        if facts is None or facts["features"] != task.names:
            self.save(name, version, fit(), task)
        return self.load(name, version)

    def load(self, name: str, version: str):
        return DefaultParamsReader.loadParamsInstance(f"{self.path(name, version)}/model", self.spark)

    def score(self, name: str, version: str, task: Task, rows: DataFrame) -> DataFrame:
        return task.predict(self.load(name, version), rows)
