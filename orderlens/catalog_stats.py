"""Statistics queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderlens.catalog_reports import over_store, sample_scores
from orderlens.plans import stats as x


def _r(df):
    return df.withColumns({c: F.round(c, 6) for c, t in df.dtypes if t == "double"})


def _chi2(s):
    return _r(x.chi2(x.count_cells(s.base, x.flag_entries())))


def _chi2_documents(spark, d):
    """Toxic labels against the language of the documents."""
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang")
    labels = spark.read.parquet(f"{d}/labels.parquet").select("doc_id", "toxic")
    j = labels.join(docs, "doc_id")
    cells = j.groupBy(F.lit("toxic_by_lang").alias("test"), x._cat("lang").alias("g"), F.col("toxic").cast("double").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    return _r(x.chi2(cells))


def _group_means(s):
    return _r(x.mean_variance(x.count_cells(s.base, x.time_entries())))


QUERIES = {
    "chi2_statistic": _chi2,
    "group_mean_variance": _group_means,
    "perm_test_rate": lambda s: x.rate_tests(s.base),
    "perm_test_group_mean": lambda s: x.time_tests(s.base),
    "perm_test_order_value": lambda s: x.value_tests(s.base),
    "perm_partner_spread": lambda s: x.partner_test(s.base),
    "stat_battery": lambda s: x.battery(s.base),
    "auc_null_test_by_key": lambda s: x.auc_null(sample_scores(s.churn), "CustomerID", "Churn", "ChurnProbability"),
}


def queries() -> dict:
    return {**{k: over_store(f) for k, f in QUERIES.items()}, "chi2_documents": _chi2_documents}
