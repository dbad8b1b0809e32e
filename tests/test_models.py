"""Model search, registry and the reports over real scores."""

import json

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from orderlens.ml import models as ml
from orderlens.ml import search
from orderlens.ml.models import Task
from orderlens.ml.registry import Registry
from orderlens.plans import kpis
from orderlens.session import new_folder


@pytest.fixture(scope="module")
def tasks(spark):
    """y depends on the first input by a step that no line follows; the class on the second, linearly."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(900, 3))
    y = np.where(np.abs(x[:, 0]) < 0.7, 40.0, 10.0) + rng.normal(scale=2, size=900)
    label = (x[:, 1] + rng.normal(scale=0.5, size=900) > 0).astype(float)
    rows = [(i, x[i].tolist(), float(y[i]), float(label[i]), "test" if i % 5 == 0 else "train") for i in range(900)]
    df = spark.createDataFrame(rows, "id long, x array<double>, y double, label double, Split string").withColumn("features", array_to_vector("x")).coalesce(2).cache()
    names = ["a", "b", "c"]
    return {"delivery": Task(df.select("id", "features", F.col("y").alias("label"), "Split"), names, "id", False), "churn": Task(df.select("id", "features", "label", "Split"), names, "id", True)}


@pytest.fixture(scope="module")
def chosen(spark, tasks):
    small = {"Random Forest": {"numTrees": [5], "maxDepth": [1, 4]}, "Decision Tree": {"maxDepth": [1, 4]}, "Gradient Boosting": {"maxIter": [2], "maxDepth": [1, 2]}}
    for t in tasks.values():
        t.grids = small
        t.models = {n: (m.copy({m.maxIter: 3}) if n == "Gradient Boosting" else m.copy({m.numTrees: 5}) if n == "Random Forest" else m) for n, m in t.models.items()}
    return search.run(spark, tasks, points=2)


def test_search_scores_every_family_and_fold(chosen):
    rows = chosen.results.collect()
    cv = [r for r in rows if r["stage"] == "cv"]
    assert len(cv) == 2 * 4 * search.CV_FOLDS and {r["fold"] for r in cv} == set(range(5))
    tuned = {(r["task"], r["family"]) for r in rows if r["stage"] == "random"}
    assert len(tuned) == 4 and len([r for r in rows if r["stage"] == "random"]) == 2 * 2 * 2 * search.TUNE_FOLDS
    assert all(r["seconds"] > 0 for r in rows)


def test_search_finds_the_planted_signal(chosen):
    mean = {(r["task"], r["Model"]): r["cv_mean"] for r in search.cv_scores(chosen.results).collect()}
    assert mean["delivery", "Linear Regression"] < 0.1 < 0.8 < mean["delivery", "Decision Tree"]
    assert mean["churn", "Logistic Regression"] > 0.9
    assert chosen.winner("delivery") != "Linear Regression"
    for (task, family), point in chosen.best_points.items():
        scored = {r["point"]: r["s"] for r in chosen.results.where(f"stage = 'random' and task = '{task}' and family = '{family}'").groupBy("point").agg(F.avg("score").alias("s")).collect()}
        assert scored[json.dumps(point)] == max(scored.values())


def test_registry_loads_what_it_saved_and_fits_changed_inputs_anew(spark, tasks):
    task, registry, fits = tasks["churn"], Registry(spark, new_folder(spark)), []

    def fit():
        fits.append(1)
        return task.models["Logistic Regression"].fit(task.train)

    first = registry.load_or_fit("churn", "v1", task, fit)
    again = registry.load_or_fit("churn", "v1", task, fit)
    assert len(fits) == 1
    want = {r["id"]: r["score"] for r in task.predict(first, task.test).collect()}
    assert {r["id"]: r["score"] for r in task.predict(again, task.test).collect()} == pytest.approx(want)
    registry.load_or_fit("churn", "v2", task, fit)
    assert len(fits) == 2
    facts = registry.facts("churn", "v1")
    assert facts["features"] == task.names and facts["scores"]["ROC_AUC"] > 0.9 and registry.facts("churn", "v3") is None


def test_comparison_and_dashboard_read_real_models(spark, tasks, chosen):
    tables = {}
    for which, metric in (("delivery", "CV_R2_mean"), ("churn", "CV_AUC")):
        task = tasks[which]
        fitted = ml.fit_all(task) | {f"{f} (tuned)": search.estimator(task, f, p).fit(task.train) for (w, f), p in chosen.best_points.items() if w == which}
        rows = ml.compare(task, which, chosen, fitted)
        found = {r["Model"]: r for r in rows.collect()}
        assert set(found) == {"Baseline", *task.models, *fitted}
        assert ml.select_by_cv(rows, metric).first()["Model"] == chosen.winner(which)
        assert all(found[n][metric] == pytest.approx(chosen.means[which][n]) for n in fitted)
        tables[f"ml_model_comparison_{which}"] = rows
        importance = ml.permutation_importance(task, fitted[chosen.winner(which)])
        assert importance.first()["feature"] == {"delivery": "a", "churn": "b"}[which]
        tables[f"ml_{which}_feature_importance"] = importance
    best = ml.fit_all(tasks["delivery"], ["Decision Tree"])["Decision Tree"]
    p = tasks["delivery"].predict(best, tasks["delivery"].test)
    tables["ml_delivery_predictions"] = p.withColumn("Residual", F.col("Actual") - F.col("Predicted"))
    tables["ml_churn_scores"] = spark.createDataFrame([(1, 1, "High", "test"), (2, 0, "Low", "test"), (3, 0, "Low", "train")], "CustomerID long, Churn int, RiskSegment string, Split string")
    panels = {}
    for r in kpis.dash_models(tables).collect():
        panels.setdefault(r["panel"], {})[r["label"]] = r["value"]
    assert panels["card"]["Delivery model test R2"] > 0.8 and panels["card"]["Churn model test AUC"] > 0.9
    assert next(iter(panels["importance_delivery"])) == "a" and set(panels["risk_customers"]) == {"High", "Low"}
    low, high = min(panels["actual_by_predicted"], key=int), max(panels["actual_by_predicted"], key=int)
    assert panels["actual_by_predicted"][low] < panels["actual_by_predicted"][high]
