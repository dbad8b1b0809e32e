"""Model metrics as aggregates over a prediction table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions import ratio
from orderlens.operators.blocks import row_numbers, running, sort_blocks
from orderlens.session import materialise


def regression_exprs(actual: str = "Actual", predicted: str = "Predicted") -> list[Column]:
    y, e = F.col(actual), F.col(actual) - F.col(predicted)
    mse = F.avg(e * e)
    total = F.sum(y * y) - F.sum(y) * F.sum(y) / F.count(y)
    r2 = F.when(total > 0, 1.0 - F.sum(e * e) / total).otherwise(0.0)
    return [F.avg(F.abs(e)).alias("MAE"), mse.alias("MSE"), F.sqrt(mse).alias("RMSE"), r2.alias("R2")]


def regression_metrics(pred: DataFrame, by: list[str] = ()) -> DataFrame:
    return pred.groupBy(*by).agg(*regression_exprs())


def confusion(pred: DataFrame, threshold: float = 0.5) -> DataFrame:
    return pred.groupBy("label", (F.col("score") >= threshold).cast("int").alias("predicted")).agg(F.count(F.lit(1)).alias("n"))


def threshold_exprs(threshold: float = 0.5) -> list[Column]:
    hit, y = F.col("score") >= threshold, F.col("label") == 1
    tp, fp, fn, tn = F.count_if(hit & y), F.count_if(hit & ~y), F.count_if(~hit & y), F.count_if(~hit & ~y)

    def f1(a, b, c) -> Column:
        p, r = F.coalesce(ratio(a, a + b), F.lit(0.0)), F.coalesce(ratio(a, a + c), F.lit(0.0))
        return F.coalesce(F.try_divide(2 * p * r, p + r), F.lit(0.0))

    return [ratio(tp + tn, F.count(F.lit(1))).alias("Accuracy"), F.coalesce(ratio(tp, tp + fp), F.lit(0.0)).alias("Precision"),
            F.coalesce(ratio(tp, tp + fn), F.lit(0.0)).alias("Recall"), f1(tp, fp, fn).alias("F1"), f1(tn, fn, fp).alias("F1_retained")]


def roc_points(pred: DataFrame, by: list[str] = ()) -> DataFrame:
    """True and false positive rate at each distinct score, highest first. Rows are
    counted per score before they are ordered."""
    by = list(by)
    g = pred.groupBy(*by, "score").agg(F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg"))
    blk = sort_blocks(g, by, [F.col("score").desc()])
    cum = running(blk, by, {"tps": ("sum", "pos"), "fps": ("sum", "neg")})
    tot = blk.groupBy(*by).agg(F.sum("pos").alias("_p"), F.sum("neg").alias("_n"))
    if by:
        cum = cum.join(tot, by)
    else:
        cum = cum.withColumns({"_p": tot.select("_p").scalar(), "_n": tot.select("_n").scalar()})
    return cum.select(*by, "score", "pos", "neg", "tps", "fps", F.coalesce(ratio(F.col("tps"), F.col("_p")), F.lit(0.0)).alias("tpr"),
                      F.coalesce(ratio(F.col("fps"), F.col("_n")), F.lit(0.0)).alias("fpr"), "_p", "_n")


def roc_auc(pred: DataFrame, by: list[str] = ()) -> DataFrame:
    """Area under the curve through the distinct scores (ties count half); 0 where only one class occurs."""
    area = F.sum(F.col("neg") * (F.col("tps") - F.col("pos") / 2.0))
    return roc_points(pred, by).groupBy(*by).agg(F.coalesce(F.try_divide(area, (F.max("_p") * F.max("_n")).cast("double")), F.lit(0.0)).alias("ROC_AUC"))


def average_precision(pred: DataFrame, key: str = "id") -> DataFrame:
    """Mean of the precision at each positive row, ties in key order."""
    blk = row_numbers(sort_blocks(pred.select(key, "label", "score"), [], [F.col("score").desc(), key]), [])
    run = running(blk, [], {"tp": ("sum", "label")})
    return run.agg(F.coalesce(F.try_divide(F.sum(F.col("label") * F.col("tp") / F.col("rn")), F.sum("label").cast("double")), F.lit(0.0)).alias("PR_AUC"))


def classification_metrics(pred: DataFrame, key: str = "id") -> DataFrame:
    """One row. ``pred`` has the key, label (0 or 1) and score."""
    one = pred.agg(*threshold_exprs())
    return one.withColumns({"ROC_AUC": roc_auc(pred).scalar(), "PR_AUC": average_precision(pred, key).scalar()})


def shuffled_positions(rows: DataFrame, key: str, repeats: int, seed: int) -> DataFrame:
    """(rep, position, key): the rows in a different fixed random order per repeat;
    repeat 0 is the order the others are matched to."""
    reps = rows.select(key).withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(repeats))))
    blk = sort_blocks(reps.withColumn("_h", F.xxhash64(key, "rep", F.lit(seed))), ["rep"], ["_h", key])
    return row_numbers(blk, ["rep"], "position").select("rep", "position", key)


def donors(rows: DataFrame, key: str, repeats: int, seed: int) -> DataFrame:
    """(key, rep, donor): for every row and repeat the row whose values it borrows."""
    order = materialise(shuffled_positions(rows, key, repeats, seed))
    first = order.filter("rep = 0").select("position", key)
    return first.join(order.filter("rep > 0").select("rep", "position", F.col(key).alias("donor")), "position").drop("position")


