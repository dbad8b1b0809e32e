"""Fitting, tuning and judging the two models with Spark ML."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.classification import DecisionTreeClassifier, GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.ml import metrics as mt
from orderlens.ml import prep
from orderlens.session import materialise

SEED = prep.SEED
#: train rows up to which a forest keeps the node of each row in each tree (4 bytes each) and does not walk down to it again at each level
KEPT_NODES = 2_000_000


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def regressors() -> dict:
    return {
        "Linear Regression": Pipeline(stages=[prep.scaler(), LinearRegression(featuresCol="scaled", solver="normal")]),
        "Decision Tree": DecisionTreeRegressor(maxDepth=6, minInstancesPerNode=50, seed=SEED),
        "Random Forest": RandomForestRegressor(numTrees=60, maxDepth=8, minInstancesPerNode=30, featureSubsetStrategy="0.5", seed=SEED),
        "Gradient Boosting": GBTRegressor(maxIter=100, stepSize=0.05, maxDepth=3, minInstancesPerNode=30, seed=SEED),
    }


def classifiers() -> dict:
    w = {"weightCol": "weight"}
    return {
        "Logistic Regression": Pipeline(stages=[prep.scaler(), LogisticRegression(featuresCol="scaled", maxIter=200, standardization=False, **w)]),
        "Decision Tree": DecisionTreeClassifier(maxDepth=5, minInstancesPerNode=50, seed=SEED, **w),
        "Random Forest": RandomForestClassifier(numTrees=60, maxDepth=8, minInstancesPerNode=30, featureSubsetStrategy="sqrt", seed=SEED, **w),
        "Gradient Boosting": GBTClassifier(maxIter=100, stepSize=0.05, maxDepth=3, minInstancesPerNode=30, seed=SEED, **w),
    }


# The values searched, by model; names are Spark ML parameters
REGRESSION_GRIDS = {
    "Random Forest": {"numTrees": [40, 60], "maxDepth": [4, 6, 8, 12], "minInstancesPerNode": [20, 50, 100], "featureSubsetStrategy": ["0.3", "0.5"]},
    "Gradient Boosting": {"maxIter": [50, 100, 200], "stepSize": [0.02, 0.05, 0.1], "maxDepth": [2, 3, 4], "minInstancesPerNode": [30, 80]},
    "Decision Tree": {"maxDepth": [3, 4, 6, 8], "minInstancesPerNode": [30, 50, 100, 200]},
}
CLASSIFICATION_GRIDS = {
    "Random Forest": {"numTrees": [40, 60], "maxDepth": [4, 6, 8], "minInstancesPerNode": [30, 60, 120], "featureSubsetStrategy": ["sqrt", "0.5"]},
    "Gradient Boosting": {"maxIter": [50, 100, 150], "stepSize": [0.02, 0.05, 0.1], "maxDepth": [2, 3], "minInstancesPerNode": [30, 80]},
    "Decision Tree": {"maxDepth": [3, 4, 5, 7], "minInstancesPerNode": [30, 60, 120]},
}


class Task:
    """What differs between the two models."""

    def __init__(self, data: DataFrame, names: list[str], key: str, classify: bool):
        self.data, self.names, self.key, self.classify = data, names, key, classify
        self.train, self.test = data.filter("Split = 'train'"), data.filter("Split = 'test'")
        if classify:
            self.train = prep.class_weights(self.train)
        self.stratify = "label" if classify else None
        self.grids = CLASSIFICATION_GRIDS if classify else REGRESSION_GRIDS
        self.models = classifiers() if classify else regressors()
        self.models["Random Forest"].setCacheNodeIds(self.train.count() <= KEPT_NODES)

    def evaluator(self):
        return BinaryClassificationEvaluator(metricName="areaUnderROC") if self.classify else RegressionEvaluator(metricName="r2")

    def predict(self, model, rows: DataFrame) -> DataFrame:
        out = model.transform(rows)
        if self.classify:
            return out.select(F.col(self.key).alias("id"), F.col("label").cast("int").alias("label"), vector_to_array("probability")[1].alias("score"))
        return out.select(F.col(self.key).alias("id"), F.col("label").alias("Actual"), F.col("prediction").alias("Predicted"))

    def judge(self, pred: DataFrame) -> DataFrame:
        return mt.classification_metrics(pred) if self.classify else mt.regression_metrics(pred)


def delivery_task(base: DataFrame) -> Task:
    data, names = prep.prepared(prep.delivery_rows(base), "OrderID", prep.DELIVERY_NUMERIC, prep.DELIVERY_CATEGORIES)
    return Task(data, names, "OrderID", False)


def churn_task(churn: DataFrame) -> Task:
    data, names = prep.prepared(prep.churn_rows(churn), "CustomerID", prep.CHURN_NUMERIC, prep.CHURN_CATEGORIES, stratify="label")
    return Task(data, names, "CustomerID", True)


# ------------------------------------------------------------- baselines
def baseline_regression(rows: DataFrame) -> DataFrame:
    """Every test row gets the train mean."""
    mean = rows.filter("Split = 'train'").select(F.avg("label")).scalar()
    pred = rows.filter("Split = 'test'").select(F.col("label").alias("Actual"), mean.alias("Predicted"))
    return mt.regression_metrics(pred)


def baseline_churn(rows: DataFrame) -> DataFrame:
    """Everyone churns: the areas are those of a constant score."""
    d = rows.filter("Split = 'test'").select("label", F.lit(1.0).alias("score"))
    return d.agg(*mt.threshold_exprs(), F.lit(0.5).alias("ROC_AUC"), F.avg("label").alias("PR_AUC"))


# ------------------------------------------------------------- selection
def fit_all(task: Task, names: list[str] | None = None) -> dict:
    return {n: task.models[n].fit(task.train) for n in names or task.models}


def compare(task: Task, name: str, chosen, fitted: dict) -> DataFrame:
    """One row for the baseline, each family at its fixed parameters and each tuned one: scores of the folds, which
    select, beside those of the test rows, which do not. ``fitted``: models by family, tuned ones too."""
    metric, deviation = ("CV_AUC", "CV_std") if task.classify else ("CV_R2_mean", "CV_std")
    base = baseline_churn(task.data) if task.classify else baseline_regression(task.data)
    rows = [base.select(F.lit("Baseline").alias("Model"), F.lit(0.5 if task.classify else 0.0).alias(metric), F.lit("baseline").alias("Stage"), "*")]
    for label, model in fitted.items():
        tuned = label.endswith(" (tuned)")
        family = label.removesuffix(" (tuned)")
        here = (F.col("task") == name) & (F.col("family") == family) & (F.col("stage") == ("random" if tuned else "cv"))
        params = json.dumps(chosen.best_points[name, family]) if tuned else "{}"
        score = chosen.results.where(here & (F.col("point") == params)).agg(F.avg("score").alias(metric), F.stddev_pop("score").alias(deviation))
        judged = task.judge(task.predict(model, task.test)).select(F.lit(label).alias("Model"), F.lit("tuned" if tuned else "default").alias("Stage"), F.lit(params if tuned else None).cast("string").alias("Params"), "*")
        rows.append(judged.withColumns({metric: score.select(metric).scalar(), deviation: score.select(deviation).scalar()}))
    return union(rows)


def select_by_cv(comparison: DataFrame, metric: str) -> DataFrame:
    return comparison.filter("Stage in ('default', 'tuned')").orderBy(F.desc(metric), "Model").limit(1)


def leakage_demo(task: Task) -> DataFrame:
    """What an input known only afterwards would do to the score."""
    from pyspark.ml.feature import VectorAssembler

    wide = VectorAssembler(inputCols=["features", "late"], outputCol="leaky").transform(task.data.withColumn("late", F.col("IsLate").cast("double")))
    m = GBTRegressor(featuresCol="leaky", maxIter=100, stepSize=0.05, maxDepth=3, minInstancesPerNode=30, seed=SEED).fit(wide.filter("Split = 'train'"))
    return task.judge(task.predict(m, wide.filter("Split = 'test'"))).select(F.lit("leakage demo").alias("Model"), F.lit("leakage-demo").alias("Stage"), "*")


# ------------------------------------------------------------ importances
def impurity_importance(task: Task, model) -> DataFrame:
    values = model.featureImportances.toArray().tolist()
    return task.data.sparkSession.createDataFrame(list(zip(task.names, values)), "feature string, impurity_importance double")


def permutation_importance(task: Task, model, repeats: int = 5, seed: int = SEED) -> DataFrame:
    """Loss of quality on the test rows when one input is shuffled.

    Every repeat fixes one random donor per row. Copies with one input taken from
    the donor are made and scored in a single pass, then aggregated per input."""
    test = task.test.select(task.key, "label", "features")
    x = test.select(F.col(task.key).alias("_id"), vector_to_array("features").alias("theirs"))
    pairs = mt.donors(test, task.key, repeats, seed).join(test.withColumn("mine", vector_to_array("features")).drop("features"), task.key)
    pairs = pairs.join(x, F.col("donor") == F.col("_id"))
    copies = pairs.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(len(task.names) - 1))))
    mixed = F.zip_with("mine", F.transform("theirs", lambda v, i: F.when(i == F.col("j"), v)), lambda a, b: F.coalesce(b, a))
    scored = model.transform(copies.withColumn("features", array_to_vector(mixed)))
    names = F.element_at(F.array(*[F.lit(n) for n in task.names]), F.col("j") + 1).alias("feature")
    if task.classify:
        s = scored.select("rep", "j", F.col("label").cast("int").alias("label"), vector_to_array("probability")[1].alias("score"))
        base = mt.roc_auc(task.predict(model, task.test)).scalar()
        per = mt.roc_auc(s, ["rep", "j"]).select("j", (base - F.col("ROC_AUC")).alias("loss"))
        out = "auc_drop_when_shuffled"
    else:
        base = mt.regression_metrics(task.predict(model, task.test)).select("MSE").scalar()
        e = F.col("label") - F.col("prediction")
        per = scored.groupBy("rep", "j").agg(F.avg(e * e).alias("m")).select("j", (F.col("m") - base).alias("loss"))
        out = "permutation_mse_increase"
    return per.groupBy("j").agg(F.avg("loss").alias(out)).select(names, out).orderBy(F.desc(out), "feature")


# ---------------------------------------------------------------- outputs
def delivery_predictions(task: Task, model) -> DataFrame:
    p = task.predict(model, task.test)
    where = task.test.select(F.col("OrderID").alias("id"), "RCity", "OrderDate")
    return where.join(p, "id").select(F.col("id").alias("OrderID"), "RCity", "OrderDate", "Actual", "Predicted", (F.col("Actual") - F.col("Predicted")).alias("Residual"))


def churn_scores(task: Task, model) -> DataFrame:
    from orderlens.ml.scores import risk_segments

    p = task.predict(model, task.data).select("id", F.col("score").alias("ChurnProbability"))
    d = task.data.select("CustomerID", "Recency", "Frequency", "Monetary", F.col("label").alias("Churn"), "Split").join(p, F.col("CustomerID") == F.col("id")).drop("id")
    return risk_segments(materialise(d))


def target_shuffle(task: Task, repeats: int = 5, seed: int = SEED) -> DataFrame:
    """R2 of a model fitted on the true target and on shuffled targets."""
    model = task.models["Random Forest"]
    parts = [task.judge(task.predict(model.fit(task.train), task.test)).select(F.lit(0).alias("shuffle"), "R2")]
    target = task.train.select(F.col(task.key).alias("_d"), F.col("label").alias("_y"))
    swapped = mt.donors(task.train, task.key, repeats, seed).where(F.col(task.key).isNotNull()).join(target, F.col("donor") == F.col("_d"))
    # a fit reads its rows several times: the inputs meet the targets of all repeats once, as a list each, since keys may repeat
    given = [F.collect_list(F.when(F.col("rep") == r, F.col("_y"))).alias(f"_y{r}") for r in range(1, repeats + 1)]
    inputs = task.train.select(task.key, "features", *(["weight"] if task.classify else []))
    parts_of_fit = max(1, -(-inputs.count() // prep.ROWS_PER_PART))
    rows = materialise(inputs.repartition(parts_of_fit, task.key).join(swapped.groupBy(task.key).agg(*given), task.key))
    for r in range(1, repeats + 1):
        train = rows.select(*inputs.columns, F.explode(f"_y{r}").alias("label"))
        parts.append(task.judge(task.predict(model.fit(train), task.test)).select(F.lit(r).alias("shuffle"), "R2"))
    return union(parts)
