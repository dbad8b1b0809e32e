import datetime as dt

import pytest
from pyspark.sql import functions as F

from orderlens.functions import text as tx
from orderlens.functions.dates import parse_mixed_dates
from orderlens.operators import cleaning as op
from orderlens.plans import cleaning as jobs


def column(spark, values, fn, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r.x for r in df.select("i", fn(F.col("v")).alias("x")).orderBy("i").collect()]


def test_clean_text(spark):
    got = column(spark, ["  a   b ", "", "nan", "None", "  ", "NAN", "a\t\n b", None, "NaN"], tx.clean_text)
    assert got == ["a b", None, None, None, None, "NAN", "a b", None, None]


def test_clean_text_is_idempotent(spark):
    once = lambda c: tx.clean_text(c)
    vals = [" x  y ", "q", " z "]
    assert column(spark, vals, once) == column(spark, vals, lambda c: once(once(c)))


def test_to_number(spark):
    assert column(spark, ["12", " 3.5", "x", "nan", "", None, "-4"], tx.to_number) == [12.0, 3.5, None, None, None, None, -4.0]


def test_patterns(spark):
    ten = lambda c: tx.digits_or_null(c, 10)
    six = lambda c: tx.digits_or_null(c, 6, True)
    assert column(spark, ["9876543210", "9876543210.0", "123", "abc", None], ten) == ["9876543210", "9876543210", None, None, None]
    assert column(spark, ["-400001", "400001.0", "40001", "abc"], six) == ["400001", "400001", None, None]


D = dt.date
DATES = {
    "2024-03-05": (D(2024, 3, 5), False, None), "2024.03.05": (D(2024, 3, 5), False, None), "05-03-2024": (D(2024, 3, 5), False, None),
    "5 Mar 2024": (D(2024, 3, 5), False, None), "05 Mar 2024": (D(2024, 3, 5), False, None), "25/03/2024": (D(2024, 3, 25), False, None),
    "03/25/2024": (D(2024, 3, 25), False, None), "05/03/2024": (D(2024, 3, 5), True, D(2024, 5, 3)), "04/04/2024": (D(2024, 4, 4), True, D(2024, 4, 4)),
    "31/31/2024": (None, False, None), "2024-02-30": (None, False, None), "abc": (None, False, None), " 2024-03-05 ": (D(2024, 3, 5), False, None),
}


def test_mixed_dates(spark):
    got = column(spark, [*DATES, None], parse_mixed_dates)
    assert [tuple(g) for g in got] == [*DATES.values(), (None, False, None)]


def test_mixed_dates_month_first(spark):
    got = column(spark, ["05/03/2024"], lambda c: parse_mixed_dates(c, day_first=False))[0]
    assert tuple(got) == (D(2024, 5, 3), True, D(2024, 3, 5))


def test_ambiguous_dates_follow_the_reference(spark):
    rows = spark.createDataFrame([(1, "05/03/2024"), (2, "05/03/2024"), (3, "05/03/2024"), (4, "05/03/2024"), (5, "25/03/2024")], "k int, d string")
    # closer to the alternative; closer to the default; none; none; not ambiguous
    refs = spark.createDataFrame([(1, D(2024, 5, 1)), (2, D(2024, 3, 6)), (4, None), (5, D(2024, 1, 1))], "k int, reference date")
    out = {r.k: r for r in op.resolve_ambiguous_dates(rows, "d", "k", refs).collect()}
    assert out[1].d == D(2024, 5, 3) and out[1].flipped
    assert [out[k].d for k in (2, 3, 4)] == [D(2024, 3, 5)] * 3 and not out[4].flipped
    assert out[5].d == D(2024, 3, 25) and not out[5].ambiguous
    # 2 April and 4 February are both 29 days from 4 March: the default stays
    tie = op.resolve_ambiguous_dates(spark.createDataFrame([(1, "02/04/2024")], "k int, d string"), "d", "k",
                                     spark.createDataFrame([(1, D(2024, 3, 4))], "k int, reference date")).first()
    assert tie.d == D(2024, 4, 2) and not tie.flipped


def test_reference_must_be_unambiguous(spark):
    pay = spark.createDataFrame([(1, "1", "05/03/2024"), (2, "2", "2024-03-01"), (3, "2", "2024-09-01")], f"{op.SRC} int, OrderID string, PaymentDate string")
    got = {r.OrderID: r.reference for r in op.first_payment_dates(pay).collect()}
    assert got == {1: None, 2: D(2024, 3, 1)}


def test_city_names(spark):
    cities = spark.createDataFrame([("Delhi",), ("Mumbai",), ("Bengaluru",)], "City string")
    raw = ["DELHI", " delhi ", "Bombay", "dehli", "Mumbay", "Atlantis", None, "bangalore", "new  delhi"]
    df = spark.createDataFrame(list(enumerate(raw)), "i int, City string")
    got = [r.City for r in op.canonical_city(df, cities).orderBy("i").collect()]
    assert got == ["Delhi", "Delhi", "Mumbai", "Delhi", "Mumbai", None, None, "Bengaluru", "Delhi"]


def test_dedupe(spark):
    df = spark.createDataFrame([(3, 1, "b"), (1, 1, "a"), (2, 1, "a"), (4, 2, "c")], f"{op.SRC} int, k int, v string")
    exact = op.dedupe_rows(df)
    assert sorted((r.k, r.v, r[op.SRC], r.copies) for r in exact.collect()) == [(1, "a", 1, 1), (1, "b", 3, 0), (2, "c", 4, 0)]
    first = op.dedupe_key(df, ["k"], count="n")
    assert sorted((r.k, r.v, r.n) for r in first.collect()) == [(1, "a", 2), (2, "c", 0)]
    again = op.dedupe_key(first, ["k"], count="m")
    assert sorted((r.k, r.v, r.m) for r in again.collect()) == [(1, "a", 0), (2, "c", 0)]


def test_best_status(spark):
    rows = [(1, 1, "Failed"), (2, 1, "Success"), (3, 2, "Success"), (4, 2, "Success"), (5, 3, "Odd"), (6, 3, "Failed"), (7, 4, None)]
    got = op.best_status_row(spark.createDataFrame(rows, "PaymentID int, OrderID int, PaymentStatus string"))
    assert sorted((r.OrderID, r.PaymentID) for r in got.collect()) == [(1, 2), (2, 4), (3, 6), (4, 7)]


def test_group_median(spark):
    rows = [("a", 1.0), ("a", 4.0), ("a", None), ("b", None), ("c", 9.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    for bounded in (True, False):
        got = sorted(r.v for r in op.impute_group_median(df, "v", "g", True, bounded).collect())
        assert got == [1.0, 2.5, 4.0, 4.0, 9.0]  # b has no value and takes the overall median


def test_row_mean_fills_in_sequence(spark):
    cols = ["CustomerRating", "DeliveryRating", "FoodRating"]
    rows = [(1, None, 4.0, 2.0), (2, None, None, None), (3, None, 3.0, 2.0), (4, None, 4.0, 3.0), (5, 5.0, 5.0, 5.0)]
    got = {r.i: tuple(r)[1:] for r in op.impute_row_mean(spark.createDataFrame(rows, "i int, " + ", ".join(f"{c} double" for c in cols)), cols).collect()}
    assert got[1] == (3.0, 4.0, 2.0)
    assert got[2] == (5.0, 5.0, 5.0)  # the median, then through the row mean
    assert got[3] == (2.0, 3.0, 2.0) and got[4] == (4.0, 4.0, 3.0)  # half to even


def test_caps(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 1000]] + [(None,)], "v double")
    got = [r.v for r in op.cap_iqr(df, "v").collect()]
    assert got[:4] == [1.0, 2.0, 3.0, 4.0] and got[4] == 4 + 3 * 2 and got[5] is None
    same = spark.createDataFrame([(5.0,)] * 4, "v double")
    assert {r.v for r in op.cap_iqr(same, "v").collect()} == {5.0}
    p = op.cap_percentile(df, "v", 0.99).collect()
    assert p[4].v == pytest.approx(4 + 996 * 0.96) and p[4].v_outlier and not p[5].v_outlier


def test_swap(spark):
    rows = [(D(2024, 2, 1), D(2024, 1, 1)), (D(2024, 1, 1), D(2024, 1, 1)), (D(2024, 1, 1), None)]
    got = [tuple(r) for r in op.swap_reversed(spark.createDataFrame(rows, "StartDate date, EndDate date")).collect()]
    assert got == [(D(2024, 1, 1), D(2024, 2, 1), True), (D(2024, 1, 1), D(2024, 1, 1), False), (D(2024, 1, 1), None, False)]


def test_city_blocks(spark):
    vals = [None, "A", None, "A", None, "B", None]
    df = spark.createDataFrame(list(enumerate(vals)), "WeatherID int, City string")
    got = [(r.City, r.recovered) for r in op.fill_city_blocks(df).orderBy("WeatherID").collect()]
    assert got == [(None, False), ("A", False), ("A", True), ("A", False), ("A", False), ("B", False), ("B", False)]


def test_nearest_class(spark):
    rows = [(1, "Low", 10.0), (2, "High", 20.0), (3, None, 12.0), (4, None, 15.0), (5, None, None), (6, None, 20.0)]
    got = {r.i: r.l for r in op.infer_nearest_class(spark.createDataFrame(rows, "i int, l string, v double"), "l", "v").collect()}
    assert got == {1: "Low", 2: "High", 3: "Low", 4: "High", 5: None, 6: "High"}  # a tie goes to the first name


def test_keys(spark):
    child = spark.createDataFrame([(1, "x"), (2, "y"), (None, "z")], "k int, c string")
    parent = spark.createDataFrame([(1,)], "k int")
    kept = op.drop_orphans(child, ("k", parent))
    assert [r.k for r in kept.collect()] == [1]
    assert kept.count() + child.join(parent, "k", "left_anti").count() == child.count()
    codes = spark.createDataFrame([("x",)], "c string")
    assert sorted(str(r.c) for r in op.null_unknown(child, "c", codes).collect()) == ["None", "None", "x"]


def test_clean_again_changes_nothing(spark):
    from orderlens.catalog import _r

    raw = _r(spark, "/root/testdata/sf0.001")
    once = jobs.Cleaner(raw).table("customers")
    text = once.select(F.col("CustomerID").alias(op.SRC), *[F.col(c).cast("string").alias(c) for c in once.columns])

    class Again:
        def __getitem__(self, name):
            return text if name == "customers" else raw[name]

    twice = jobs.Cleaner(Again()).table("customers")
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))
