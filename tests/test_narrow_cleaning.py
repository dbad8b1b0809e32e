"""The log of the cleaning moves what its rules read; keys and numbered lines are found once."""

import shutil

from pyspark.sql import functions as F

from orderlens.functions.text import strip
from orderlens.plans import cleaning as cl
from orderlens.sources import sample


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _raw(spark, tmp_path):
    folder = str(tmp_path / "in")
    shutil.copytree("/root/testdata/sf0.001", folder)
    return folder, sample.raw_tables(spark, folder)


def test_strip_takes_what_the_pattern_takes(spark):
    white = [chr(i) for i in range(0x3001) if chr(i).isspace()]
    texts = [None, "", " ", "\n", "a", " a b ", "a\n", "\r\na\r\n", "​a​", "﻿1 ", *[f"{w}{w}1{w}2{w}" for w in white], "".join(white)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for r in df.select("t", strip(F.col("t")).alias("got"), F.regexp_replace("t", r"(?U)^\s+|\s+$", "").alias("want")).collect():
        assert r.got == r.want, repr(r.t)


def test_the_log_of_narrow_rows_is_that_of_whole_ones(spark, tmp_path):
    cleaner = cl.Cleaner(_raw(spark, tmp_path)[1])
    for table, unread in cl.UNREAD.items():
        narrow = cleaner.counted(table).log()
        assert sorted(map(str, narrow.collect())) == sorted(map(str, cleaner.job(table).log().collect())), table
    moved = "".join(line for line in _plan(cleaner.counted("order_items").log()).splitlines() if "min_by(" in line)
    assert "Quantity" in moved and "UnitPrice" not in moved and "UnitPrice" in _plan(cleaner.table("order_items"))


def test_dates_of_payments_are_read_in_the_kept_rows(spark, tmp_path):
    _, raw = _raw(spark, tmp_path)
    plan = _plan(cl.Cleaner(raw).table("payments")).splitlines()
    reads = [i for i, line in enumerate(plan) if "gettimestamp" in line or "try_to_date" in line or "cast(gettimestamp" in line]
    chosen = next(i for i, line in enumerate(plan) if "min_by(" in line)
    assert reads and max(reads) < chosen
    assert "PaymentDate" not in "".join(line for line in _plan(cl.Cleaner(raw).counted("payments").log()).splitlines() if "min_by(" in line)


def test_keys_and_numbered_lines_are_stored_once(spark, tmp_path, monkeypatch):
    folder, raw = _raw(spark, tmp_path)
    want = {t: sorted(map(str, raw.build(t).collect())) for t in ("order_items", "payments")}
    stored = []
    monkeypatch.setattr(cl, "materialise", lambda df, **how: stored.append(df.columns) or df)
    cleaner = cl.Cleaner(raw)
    for t in ("orders", "order_items", "payments", "customer_feedback"):
        cleaner.job(t)
    assert sorted(stored) == [["FoodItemID"], ["OrderID"]]
    assert len([k for k in sample._layer if k[1] == folder and k[3] == sample.LINES]) == 1
    assert {t: sorted(map(str, raw[t].collect())) for t in want} == want and "Window" not in _plan(raw.build("payments"))
