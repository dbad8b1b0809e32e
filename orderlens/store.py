"""Tables that several consumers share, written once per application.

The order base table is costly and read by every report, so the first consumer
stores it in the shared folder and the others read the stored Parquet."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.ml import models, search
from orderlens.ml.registry import Registry
from orderlens.plans import features, star
from orderlens.session import cut_lineage, delete_at_end, dense, input_version, materialise, new_folder, parts_for, tune
from orderlens.sources.sample import SampleTables, clean_tables

_stored: dict[tuple[str, ...], DataFrame] = {}
_kept: dict[tuple[str, ...], object] = {}


class Store:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = tune(spark), sf_dir
        self.t: SampleTables = clean_tables(spark, sf_dir)
        self._version = input_version(spark, sf_dir)  # changed input is built anew
        self._star: star.Tables | None = None

    def _once(self, name: str, build) -> DataFrame:
        key = (self.spark.sparkContext.applicationId, self.sf_dir, self._version, name)
        if key not in _stored:
            _stored[key] = materialise(build())
        return _stored[key]

    def keep(self, name: str, build):
        """A driver-side object (a task, fitted models), built once per application."""
        key = (self.spark.sparkContext.applicationId, self.sf_dir, self._version, name)
        if key not in _kept:
            _kept[key] = build()
        return _kept[key]

    @property
    def delivery(self) -> models.Task:
        return self.keep("delivery", lambda: models.delivery_task(self.base))

    @property
    def churning(self) -> models.Task:
        return self.keep("churning", lambda: models.churn_task(self.churn))

    def task(self, which: str) -> models.Task:
        cut_lineage(self.spark)
        return self.delivery if which == "delivery" else self.churning

    @property
    def registry(self) -> Registry:
        """Where models are saved: the folder that ``spark.orderlens.models`` names, else one of this application."""
        def open_folder() -> Registry:
            folder = self.spark.conf.get("spark.orderlens.models", None)
            if not folder:
                folder = new_folder(self.spark)
                delete_at_end(self.spark, folder)
            return Registry(self.spark, folder)

        return self.keep("registry", open_folder)

    def fitted(self, which: str, name: str):
        """A family at its fixed parameters, saved and loaded."""
        task = self.task(which)
        return self.keep(f"{which}/{name}", lambda: self.registry.load_or_fit(f"{which}/{name}", self._version, task, lambda: task.models[name].fit(task.train)))

    def crossed(self, *which: str, ahead: int = 0) -> search.Crossed:
        """Cross-validation of all families of one task or both, done once for each task; new ones run side by side."""
        tasks = {w: self.task(w) for w in which if (f"cross/{w}") not in self._names()}
        new = search.cross(self.spark, tasks, ahead=ahead) if tasks else None
        found = {w: self.keep(f"cross/{w}", lambda w=w: new.only(w)) for w in which}
        return search.Crossed(
            {w: c.folded[w] for w, c in found.items()}, [r for c in found.values() for r in c.rows], [r for c in found.values() for r in c.ahead])

    def searched(self, *which: str) -> search.Chosen:
        """The search over all families of one task or both, done once for each task; new ones run side by side."""
        tasks = {w: self.task(w) for w in which if (f"search/{w}") not in self._names()}
        new = search.tune_best(self.spark, tasks, self.crossed(*tasks, ahead=search.POINTS)) if tasks else None
        found = [
            self.keep(f"search/{w}", lambda w=w: search.Chosen(
                new.results.where(F.col("task") == w), {k: p for k, p in new.best_points.items() if k[0] == w}, {w: new.means[w]}))
            for w in which
        ]
        return search.Chosen(
            reduce(DataFrame.unionByName, [c.results for c in found]), {k: p for c in found for k, p in c.best_points.items()},
            {w: m for c in found for w, m in c.means.items()})

    def _names(self) -> set[str]:
        here = (self.spark.sparkContext.applicationId, self.sf_dir, self._version)
        return {k[3] for k in _kept if k[:3] == here}

    @property
    def chosen(self) -> search.Chosen:
        return self.searched("delivery", "churn")

    def _tuned(self, which: str) -> dict[str, dict]:
        return {f"{family} (tuned)": point for (_, family), point in self.searched(which).best_points.items()}

    def model(self, which: str, label: str):
        """A family, or a tuned one, fitted on all train rows; saved and loaded."""
        task, tuned = self.task(which), self._tuned(which)
        if label not in tuned:
            return self.fitted(which, label)
        family, point = label.removesuffix(" (tuned)"), tuned[label]
        name = f"{which}/{family} {point}"
        return self.keep(name, lambda: self.registry.load_or_fit(name, self._version, task, lambda: search.estimator(task, family, point).fit(task.train)))

    def every_model(self, which: str) -> dict:
        """All families and the tuned ones, fitted side by side on all train rows."""
        labels = [*self.task(which).models, *sorted(self._tuned(which))]
        self.registry  # before the threads share it
        return dict(zip(labels, search.side_by_side(self.spark, lambda label: self.model(which, label), labels), strict=True))

    @property
    def base(self) -> DataFrame:
        with parts_for(self.spark, self.t["orders"].count()), dense(self.spark):
            return self._once("order_base", lambda: features.order_base_table(self.t))

    @property
    def churn(self) -> DataFrame:
        return self._once("churn", lambda: features.churn_table(self.base, self.t))

    @property
    def score(self) -> DataFrame:
        return self._once("score", lambda: star.scorecard(self.base))

    @property
    def star(self) -> star.Tables:
        if self._star is None:
            self._star = star.star_schema(self.base, self.t, lambda: self.score)
        return self._star
