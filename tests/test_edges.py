"""Late orders, files in many parts, odd numbers and names, constant columns, block counts, large draws."""

import datetime as dt
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlens.functions.dates import parse_mixed_dates
from orderlens.functions.text import digits_or_null, title_case, to_number
from orderlens.ml import metrics, prep
from orderlens.operators import blocks
from orderlens.plans import kpis, measures, stats
from orderlens.session import new_folder
from orderlens.sources import files
from orderlens.sources.schemas import CLEAN
from orderlens.streaming import jobs


def _column(spark, values, fn):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, c string").orderBy("i").select(fn(F.col("c")).alias("v"))
    return [r.v for r in rows.collect()]


def test_stream_keeps_orders_that_come_out_of_time_order(spark):
    folder, out, checkpoint = new_folder(spark), new_folder(spark), new_folder(spark)
    for i, day in enumerate((400, 0, 800, 20)):
        at = dt.date(2024, 1, 1) + dt.timedelta(days=day)
        row = (i, 7, 1, 1, at, "10:00:00", 30, 100.0, 20.0, 0.0, None, 5.0, 125.0, "Delivered", "Card")
        spark.createDataFrame([row, (0, *row[1:])], CLEAN["orders"]).coalesce(1).write.mode("append").parquet(folder)
    jobs.run(jobs.customer_changes(jobs.order_stream(spark, folder, files_per_batch=1)), jobs.customer_sums, out, checkpoint)
    assert [r.NewOrders for r in jobs.totals(spark, out, "CustomerID").collect()] == [4]
    jobs.compact(spark, out, "CustomerID", number=3)
    assert os.listdir(f"{out}/batches") == [] and os.listdir(f"{out}/compacted") == ["upto=3"]
    assert [r.NewOrders for r in jobs.totals(spark, out, "CustomerID").collect()] == [4]


def test_rows_of_many_files_keep_their_order(spark):
    folder = new_folder(spark)
    os.makedirs(f"{folder}/cities.csv")
    for part, rows in (("a", 1), ("b", 400)):  # the second file is the larger one, so it is packed first
        with open(f"{folder}/cities.csv/{part}.csv", "w") as f:
            f.write("CityID,City,Population,Region,AverageIncome\n" + "".join(f"{i},{part},1,North,2\n" for i in range(rows)))
    rows = files.read_raw_text(spark, "cities", folder).filter("CityID = '0'").orderBy("SourceRow").collect()
    assert [r.City for r in rows] == ["a", "b"]


def test_quoted_line_break_stays_in_its_value(spark):
    folder = new_folder(spark)
    os.makedirs(folder)
    with open(f"{folder}/customer_feedback.csv", "w") as f:
        f.write('FeedbackID,OrderID,CustomerRating,DeliveryRating,FoodRating,Review,Sentiment\n1,2,3,4,5,"good\nfood, ""hot""",Positive\n')
    row = files.read_raw_text(spark, "customer_feedback", folder).first()
    assert (row.Review, row.Sentiment) == ('good\nfood, "hot"', "Positive")


def test_numbers_names_and_white_space(spark):
    assert _column(spark, ["12", " -1.5\t", "1e3", ".5", "5.", "12d", "1.5F", "abc", "", None, "nan"], to_number) == [12, -1.5, 1000, 0.5, 5, None, None, None, None, None, None]
    assert _column(spark, ["new-delhi o'neil", "ÉCLAIR bar", "", None, "a1b"], title_case) == ["New-Delhi O'Neil", "Éclair Bar", "", None, "A1B"]
    assert _column(spark, ["\t2024-01-05\n", "05/13/2024 "], lambda c: parse_mixed_dates(c)["parsed"]) == [dt.date(2024, 1, 5), dt.date(2024, 5, 13)]
    assert _column(spark, ["\t12345 ", "1234"], lambda c: digits_or_null(c, 5)) == ["12345", None]


def test_columns_without_spread(spark):
    d = spark.createDataFrame([(1, 5.0)] * 4, "g int, v double")
    assert [(r["bin"], r.left_edge, r.n) for r in kpis.histogram(d, "v", "x").collect()] == [(0, 5.0, 4)]
    assert all(r.density is None for r in kpis.density(d, "v", "g").collect())
    one = spark.createDataFrame([(1, 1, 0.3), (2, 1, 0.4)], "id int, label int, score double")
    assert metrics.classification_metrics(one).first().ROC_AUC == 0.0
    assert {r.weight for r in prep.class_weights(one).collect()} == {1.0}


def test_density_follows_the_bandwidth(spark):
    values = [float(x) for x in np.random.default_rng(3).normal(0, 1, 4000)] + [1000.0]
    d = spark.createDataFrame([(v,) for v in values], "v double")
    got = {round(r.x, 6): r.density for r in kpis.density(d, "v", None, grid=11).collect()}
    x = np.array(values)
    h = x.std(ddof=1) * len(x) ** -0.2
    for at, value in got.items():
        assert value == pytest.approx(np.exp(-0.5 * ((at - x) / h) ** 2).sum() / (len(x) * h * np.sqrt(2 * np.pi)), rel=0.01, abs=1e-9)


@pytest.mark.parametrize("rows_per_block", [1, 7, 1_000_000])
def test_ranks_do_not_depend_on_the_blocks(spark, monkeypatch, rows_per_block):
    monkeypatch.setattr(blocks, "BLOCK_ROWS", rows_per_block)
    df = spark.createDataFrame([(i % 3 and 1, i % 5, i) for i in range(60)], "g int, v int, id int")
    got = {r.id: (r.row_num, r.rank_num, r.dense_rank_num) for r in blocks.ranks(df, ["g"], "v", "id").collect()}
    spark_sql = "row_number() over w as a, rank() over (partition by g order by v desc) as b, dense_rank() over (partition by g order by v desc) as c"
    df.createOrReplaceTempView("ranked_rows")
    expected = {r.id: (r.a, r.b, r.c) for r in spark.sql(f"select id, {spark_sql} from ranked_rows window w as (partition by g order by v desc, id)").collect()}
    assert got == expected


@pytest.mark.parametrize(("good", "rest", "need"), [(300, 700, 200), (5, 995, 500), (3, 2, 2)])
def test_large_draws_have_the_exact_law(good, rest, need):
    rng, n = np.random.default_rng(5), 40_000
    ours = stats._hyper_large(rng, *(np.full(n, x) for x in (good, rest, need)))
    theirs = rng.hypergeometric(good, rest, need, n)
    for k in np.unique(theirs):
        assert abs((ours <= k).mean() - (theirs <= k).mean()) < 0.015
    assert ours.min() >= max(0, need - rest) and ours.max() <= min(good, need)


def test_every_status_has_its_cells(spark):
    base = spark.createDataFrame([("Cash", "Success"), ("Cash", "Odd"), ("Card", None)], "PaymentMethod string, PaymentStatus string")
    assert {tuple(r) for r in kpis.payment_by_status(base).collect()} == {("Cash", "Success", 1), ("Cash", "Odd", 1), ("Card", None, 1)}


def test_measures_follow_chains_and_ignore_unrelated_filters(spark):
    star = {
        "ml_delivery_predictions": spark.createDataFrame([(1, 2.0), (2, 4.0)], "OrderID int, Residual double"),
        "fact_orders": spark.createDataFrame([(1, 10), (2, 11)], "OrderID int, RestaurantID int"),
        "dim_restaurant": spark.createDataFrame([(10, "Thai"), (11, "Indian")], "RestaurantID int, Cuisine string"),
        "dim_menu": spark.createDataFrame([(1, "x")], "FoodItemID int, Category string"),
    }
    got = measures.evaluate(star, ["Delivery MAE"], ["dim_restaurant.Cuisine"], {"dim_menu.Category": ["none"]})
    assert {r.Cuisine: r["Delivery MAE"] for r in got.collect()} == {"Thai": 2.0, "Indian": 4.0}
    with pytest.raises(ValueError, match="no relationship"):
        measures.evaluate(star, ["Delivery MAE"], ["dim_menu.Category"])
