import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlens.ml import metrics as mt
from orderlens.plans import stats as st


def cells(spark, rows, test="t"):
    df = spark.createDataFrame(rows, "g string, v double")
    return df.groupBy(F.lit(test).alias("test"), "g", "v").agg(F.count(F.lit(1)).alias("n"))


def brute_chi2(g, f):
    out = 0.0
    for k in set(g):
        for v in (0, 1):
            o = sum(1 for a, b in zip(g, f) if a == k and b == v)
            e = g.count(k) * sum(1 for b in f if b == v) / len(f)
            out += (o - e) ** 2 / (e if e > 0 else 1)
    return out


@pytest.fixture(scope="module")
def flags():
    rng = np.random.default_rng(1)
    g = [str(x) for x in rng.integers(0, 3, 120)]
    return g, [int(x) for x in rng.random(120) < 0.3]


def test_chi2(spark, flags):
    g, f = flags
    got = st.chi2(cells(spark, [(a, float(b)) for a, b in zip(g, f)])).first().statistic
    assert got == pytest.approx(brute_chi2(g, f))


def test_rate_shuffles_have_the_null_distribution(spark, flags):
    g, f = flags
    c = cells(spark, [(a, float(b)) for a, b in zip(g, f)])
    null = st.shuffle_few_values(c, st._groups(c), st._tests(c, "chi2", 400))
    got = [r.stat for r in null.collect()]
    rng = np.random.default_rng(2)
    want = [brute_chi2(g, list(rng.permutation(f))) for _ in range(400)]
    assert len(got) == 400
    assert np.mean(got) == pytest.approx(np.mean(want), rel=0.2)
    assert np.percentile(got, 90) == pytest.approx(np.percentile(want, 90), rel=0.25)


def test_constant_flag(spark):
    c = cells(spark, [(x, 0.0) for x in "aabbcc"])
    null = st.shuffle_few_values(c, st._groups(c), st._tests(c, "chi2", 50))
    r = st.p_values(null, st.chi2(c)).first()
    assert r.statistic == 0 and r.p == pytest.approx(1 + 1 / 51)


def test_mean_shuffles_by_counts_and_by_blocks_agree(spark):
    rng = np.random.default_rng(4)
    g = [str(x) for x in rng.integers(0, 4, 200)]
    y = [float(x) for x in rng.integers(1, 60, 200)]
    c = cells(spark, list(zip(g, y)))
    a = [r.stat for r in st.shuffle_few_values(c, st._groups(c), st._tests(c, "mean", 400)).collect()]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(y)], "id long, y double")
    sums = st.shuffle_many_values(rows, st._groups(c), 400)
    b = [r.s for r in sums.groupBy("rep").agg(F.var_samp(F.col("s") / F.col("n")).alias("s")).collect()]
    assert np.mean(a) == pytest.approx(np.mean(b), rel=0.2)
    total = sums.groupBy("rep").agg(F.sum("s").alias("s")).select(F.min("s"), F.max("s")).first()
    assert total[0] == pytest.approx(sum(y)) and total[1] == pytest.approx(sum(y))


@pytest.mark.parametrize(("per_block", "fan"), [(20, 64), (5, 3)])  # one level, three levels
def test_block_shuffles_over_several_blocks(spark, monkeypatch, per_block, fan):
    monkeypatch.setattr(st, "VALUES_PER_BLOCK", per_block)
    monkeypatch.setattr(st, "FAN", fan)
    rows = spark.createDataFrame([(i, float(i)) for i in range(100)], "id long, y double")
    groups = spark.createDataFrame([("t", "a", 30), ("t", "b", 70)], "test string, g string, n long")
    sums = st.shuffle_many_values(rows, groups, 300)
    got = [r.s for r in sums.filter("i = 0").collect()]
    assert len(got) == 300 and np.mean(got) == pytest.approx(30 * 49.5, rel=0.05)
    # deviation of the sum of 30 of 100 values drawn without replacement
    sd = np.sqrt(30 * 70 / 99 * np.var(np.arange(100)))
    assert np.std(got) == pytest.approx(sd, rel=0.2)
    assert {round(r.s, 6) for r in sums.groupBy("rep").agg(F.sum("s").alias("s")).collect()} == {4950.0}


def test_counts_and_rows_give_the_same_null():
    """Repeated values by counts, and one by one in a plain shuffle: means and deviations within their own error."""
    rng = np.random.default_rng(5)
    y, n, sizes = np.array([1.0, 2.5, 4.0, 90.0]), np.array([400, 300, 250, 50]), np.array([200, 300, 500])
    every = np.repeat(y, n)
    plain = np.array([[p.sum() for p in np.split(rng.permutation(every), np.cumsum(sizes)[:-1])] for _ in range(3000)])
    drawn = st.group_sums(rng, y, n, np.tile(sizes, (3000, 1)))
    assert (drawn.sum(axis=1) == pytest.approx(every.sum()))
    error = plain.std(axis=0) / np.sqrt(3000)
    assert (np.abs(plain.mean(axis=0) - drawn.mean(axis=0)) < 5 * error).all()
    assert drawn.std(axis=0) == pytest.approx(plain.std(axis=0), rel=0.06)
    assert np.corrcoef(drawn.T)[0, 1] == pytest.approx(np.corrcoef(plain.T)[0, 1], abs=0.06)


def test_work_follows_distinct_values_not_rows():
    import time

    def seconds(times):
        start = time.process_time()
        st.group_sums(np.random.default_rng(1), np.arange(300.0), np.full(300, 40 * times), np.tile([6000 * times, 6000 * times], (200, 1)))
        return time.process_time() - start

    seconds(1)
    assert seconds(1000) < 4 * min(seconds(1) for _ in range(3)) + 0.2


def test_large_populations_are_drawn(spark):
    rng = np.random.default_rng(0)
    counts = np.array([3 * 10**9, 10**9, 2], dtype=np.int64)
    for n in (0, 10, 10**9, int(counts.sum())):
        d = st._draw(rng, np.tile(counts, (5, 1)), n)
        assert (d.sum(axis=1) == n).all() and (d >= 0).all() and (d <= counts).all()


def test_battery_finds_a_real_difference(spark):
    rows = [("a", 1.0)] * 60 + [("a", 0.0)] * 40 + [("b", 1.0)] * 10 + [("b", 0.0)] * 90
    c = cells(spark, rows)
    r = st.p_values(st.shuffle_few_values(c, st._groups(c), st._tests(c, "chi2", 200)), st.chi2(c)).first()
    assert r.p == pytest.approx(1 / 201)


# ------------------------------------------------------------------ metrics
def pred(spark, rows):
    return spark.createDataFrame([(i, y, float(s)) for i, (y, s) in enumerate(rows)], "id long, label int, score double")


def brute_auc(rows):
    p, n = [s for y, s in rows if y], [s for y, s in rows if not y]
    return sum((a > b) + (a == b) / 2 for a in p for b in n) / (len(p) * len(n))


def test_auc(spark):
    assert mt.roc_auc(pred(spark, [(1, 0.9), (1, 0.8), (0, 0.1)])).first()[0] == 1
    assert mt.roc_auc(pred(spark, [(1, 0.5), (0, 0.5), (0, 0.5)])).first()[0] == 0.5
    rng = np.random.default_rng(7)
    rows = [(int(a), float(b)) for a, b in zip(rng.integers(0, 2, 200), rng.integers(0, 12, 200) / 12)]
    assert mt.roc_auc(pred(spark, rows)).first()[0] == pytest.approx(brute_auc(rows))


def test_auc_null_matches_observed(spark):
    rng = np.random.default_rng(9)
    rows = [(int(a), float(b)) for a, b in zip(rng.integers(0, 2, 150), rng.integers(0, 9, 150))]
    df = pred(spark, rows)
    r = st.auc_null(df, "id", "label", "score", 200).first()
    assert r.statistic == pytest.approx(brute_auc(rows)) and 0 < r.p <= 1 + 1 / 201


def test_no_predicted_positive(spark):
    r = mt.classification_metrics(pred(spark, [(1, 0.1), (0, 0.2), (0, 0.0)])).first()
    assert (r.Precision, r.Recall, r.F1) == (0, 0, 0) and r.Accuracy == pytest.approx(2 / 3)


def test_average_precision(spark):
    rows = [(1, 0.9), (0, 0.8), (1, 0.7), (0, 0.6)]
    assert mt.average_precision(pred(spark, rows)).first()[0] == pytest.approx((1 + 2 / 3) / 2)


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 3.0), (5.0, 4.0)], "Actual double, Predicted double")
    r = mt.regression_metrics(df).first()
    assert (r.MAE, r.MSE) == (pytest.approx(2 / 3), pytest.approx(2 / 3)) and r.R2 == pytest.approx(1 - 2 / 8)


def test_donors_are_permutations(spark):
    df = spark.createDataFrame([(i,) for i in range(50)], "id long")
    got = mt.donors(df, "id", 3, 1).collect()
    for rep in (1, 2, 3):
        assert sorted(r.donor for r in got if r.rep == rep) == list(range(50))
