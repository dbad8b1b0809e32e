"""Machine-learning queries."""

from __future__ import annotations

from collections import ChainMap

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from orderlens.catalog_reports import ml_measures, over_store, sample_predictions, sample_scores, with_segments
from orderlens.ml import metrics as mt
from orderlens.ml import models as ml
from orderlens.ml import prep, search
from orderlens.ml.registry import Registry
from orderlens.ml.scores import segment_rates
from orderlens.plans import kpis as k
from orderlens.plans import measures as m
from orderlens.plans import stats as x
from orderlens.plans.kpis import union
from orderlens.plans.star import top_features
from orderlens.session import delete_at_end, materialise, new_folder
from orderlens.sources import files


def r6(df):
    return df.withColumns({f: F.round(F.col(f"`{f}`"), 6) for f, t in df.dtypes if t == "double"})


def _matrix(rows, numeric, categories):
    """Mean of every column of the assembled matrix."""
    fitted = prep.encoder(numeric, categories).fit(rows)
    names = prep.feature_names(fitted, numeric, categories)
    x = fitted.transform(rows).select(F.posexplode(vector_to_array("features")).alias("j", "x"))
    name = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("j") + 1).alias("feature")
    return r6(x.groupBy("j").agg(F.avg("x").alias("mean"), F.count(F.lit(1)).alias("n")).select(name, "mean", "n"))


def by_modulus(rows, key):
    """A split by key arithmetic, which SQL can repeat."""
    return rows.withColumn("Split", F.when(F.col(key) % 5 == 0, "test").otherwise("train"))


def _judged(s):
    return sample_scores(s.churn).select(F.col("CustomerID").alias("id"), F.col("Churn").alias("label"), F.col("ChurnProbability").alias("score"))


def _split_sizes(df, *by):
    return df.groupBy("Split", *by).agg(F.count(F.lit(1)).alias("n"))


def _train(which):
    def run(s):
        task = s.delivery if which == "delivery" else s.churning
        parts = [task.judge(task.predict(s.fitted(which, n), task.test)).select(F.lit(n).alias("Model"), "*") for n in task.models]
        return ml.union(parts)

    return run


def _grid_search(s):
    """The whole grid of the trees, for both tasks; the larger grids are searched at random."""
    return search.best_points(union([search.full_grid(s.spark, s.task(w), "Decision Tree", w) for w in ("delivery", "churn")]), "grid")


def _comparison(s, which):
    return s.keep(f"comparison/{which}", lambda: materialise(ml.compare(s.task(which), which, s.searched(which), s.every_model(which))))


def _selected(s):
    out = [ml.select_by_cv(_comparison(s, w), m).select(F.lit(w).alias("task"), "Model", F.col(m).alias("cv"))
           for w, m in (("delivery", "CV_R2_mean"), ("churn", "CV_AUC"))]
    return union(out)


SELECTION = {"delivery": ("CV_R2_mean", "permutation_mse_increase"), "churn": ("CV_AUC", "auc_drop_when_shuffled")}


def _chosen(s, which):
    """The task, the name of the model that cross-validation chose, and the model."""
    name = s.searched(which).winner(which)
    return s.task(which), name, s.model(which, name)


def _model_rows(s, which):
    """The comparison with all its scores; for delivery times also the leakage demonstration."""
    rows = _comparison(s, which).withColumn("task", F.lit(which))
    return ml.union([rows, _leakage(s).withColumn("task", F.lit(which))]) if which == "delivery" else rows


def _leakage(s):
    return s.keep("leakage", lambda: materialise(ml.leakage_demo(s.delivery)))


def _importance(s, which):
    task, _, model = _chosen(s, which)
    return s.keep(f"importance/{which}", lambda: materialise(ml.permutation_importance(task, model)))


def _scores(s, which, build):
    task, _, model = _chosen(s, which)
    return s.keep(f"scores/{which}", lambda: materialise(build(task, model)))


MODEL_TABLES = {
    "ml_delivery_predictions": lambda s: _scores(s, "delivery", ml.delivery_predictions),
    "ml_churn_scores": lambda s: _scores(s, "churn", ml.churn_scores),
    "ml_delivery_feature_importance": lambda s: top_features(_importance(s, "delivery"), SELECTION["delivery"][1]),
    "ml_churn_feature_importance": lambda s: top_features(_importance(s, "churn"), SELECTION["churn"][1]),
    "ml_model_comparison_delivery": lambda s: _model_rows(s, "delivery").drop("task"),
    "ml_model_comparison_churn": lambda s: _model_rows(s, "churn").drop("task"),
}


def model_table(s, name):
    """A model table of the star schema, from the model that cross-validation chose; a report builds only those it reads."""
    return MODEL_TABLES[name](s)


def model_tables(s, *names) -> dict:
    """The named model tables, or all six. What both tasks need is searched side by side."""
    names = names or tuple(MODEL_TABLES)
    s.searched(*[w for w in ("delivery", "churn") if any(w in n for n in names)])
    return {n: model_table(s, n) for n in names}


def _test_scores(s):
    return model_table(s, "ml_churn_scores").where("Split = 'test'")


def _measures(s):
    return ml_measures(ChainMap(model_tables(s, "ml_delivery_predictions", "ml_churn_scores"), s.star))


def _importance_measures(s):
    star = ChainMap(model_tables(s, "ml_delivery_feature_importance", "ml_churn_feature_importance"), s.star)
    parts = [m.evaluate(star, [name], [f"{table}.feature"]).select(F.lit(name).alias("measure"), "feature", F.col(name).alias("value"))
             for name, table in (("Delivery Importance", "ml_delivery_feature_importance"), ("Churn Importance", "ml_churn_feature_importance"))]
    return union(parts)


def _export_full_star(s):
    """All seventeen tables: eleven of the star, six of the models."""
    folder, tables = new_folder(s.spark), {**s.star, **model_tables(s)}
    files.export_tables(tables, folder, by_month=("fact_orders",))
    return union([s.spark.read.parquet(f"{folder}/{n}").agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("n")) for n in tables])


def _save(s):
    """The chosen model, saved with its facts, loaded and used."""
    task, name, model = _chosen(s, "churn")
    folder = new_folder(s.spark)
    delete_at_end(s.spark, folder)
    saved = Registry(s.spark, folder)
    saved.save(name, "", model, task)
    return saved.score(name, "", task, task.test)


def _export_ml(s):
    folder, tables = new_folder(s.spark), model_tables(s)
    files.export_tables(tables, folder)
    return union([s.spark.read.parquet(f"{folder}/{n}").agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("n")) for n in tables])


QUERIES = {
    "delivery_matrix": lambda s: _matrix(prep.delivery_rows(s.base), prep.DELIVERY_NUMERIC, prep.DELIVERY_CATEGORIES),
    "churn_matrix": lambda s: _matrix(prep.churn_rows(s.churn), prep.CHURN_NUMERIC, prep.CHURN_CATEGORIES),
    "split_random": lambda s: _split_sizes(prep.split(prep.delivery_rows(s.base).select("OrderID"), "OrderID")),
    "split_stratified": lambda s: _split_sizes(prep.split(prep.churn_rows(s.churn).select("CustomerID", "label"), "CustomerID", stratify="label"), "label"),
    "standardise": lambda s: r6(prep.scaling(prep.delivery_rows(s.base), prep.DELIVERY_NUMERIC)),
    "baseline_regression": lambda s: r6(ml.baseline_regression(by_modulus(prep.delivery_rows(s.base), "OrderID"))),
    "baseline_churn": lambda s: r6(ml.baseline_churn(by_modulus(prep.churn_rows(s.churn), "CustomerID"))),
    "regression_metrics": lambda s: r6(mt.regression_metrics(sample_predictions(s.base))),
    "classification_metrics": lambda s: r6(mt.classification_metrics(_judged(s))),
    "confusion_matrix": lambda s: mt.confusion(_judged(s)),
    "roc_curve": lambda s: r6(mt.roc_points(_judged(s)).select("score", "tpr", "fpr")),
    "risk_segment_rates_by_key": lambda s: segment_rates(with_segments(sample_scores(s.churn))),
    "risk_segment_rates": lambda s: segment_rates(model_table(s, "ml_churn_scores")),
    "measures_ml": _measures,
    "dash_ml": lambda s: k.dash_models(model_tables(s)),
    "auc_null_test": lambda s: x.auc_null(_test_scores(s), "CustomerID", "Churn", "ChurnProbability"),
    "train_regressors": _train("delivery"),
    "train_classifiers": _train("churn"),
    "cross_validate": lambda s: search.cv_scores(search.scores(s.spark, s.crossed("delivery", "churn").rows)),
    "random_search": lambda s: search.best_points(s.chosen.results, "random"),
    "grid_search": _grid_search,
    "model_comparison": lambda s: ml.union([_model_rows(s, w) for w in ("delivery", "churn")]),
    "select_by_cv": _selected,
    "leakage_demo": _leakage,
    "impurity_importance": lambda s: ml.impurity_importance(s.delivery, s.fitted("delivery", "Random Forest")),
    "permutation_importance": lambda s: _importance(s, "delivery"),
    "permutation_importance_churn": lambda s: _importance(s, "churn"),
    "delivery_predictions": lambda s: model_table(s, "ml_delivery_predictions"),
    "churn_scores": lambda s: model_table(s, "ml_churn_scores"),
    "target_shuffle_test": lambda s: ml.target_shuffle(s.delivery),
    "save_model": _save,
    "export_ml_tables": _export_ml,
    "export_full_star": _export_full_star,
    "measures_importance": _importance_measures,
}


def queries() -> dict:
    return {k: over_store(f) for k, f in QUERIES.items()}
