import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from orderlens.operators import blocks as bl


@pytest.fixture(scope="module")
def skewed(spark):
    """One group holds most rows; ties and missing values are common."""
    rnd = random.Random(5)
    rows = []
    for i in range(900):
        g = "hot" if rnd.random() < 0.7 else rnd.choice("abc")
        rows.append((i, g, rnd.choice([1.0, 2.0, 2.5, 7.0, 9.0]), rnd.choice([None, "x", "y"])))
    return spark.createDataFrame(rows, "id long, g string, v double, c string")


def test_blocks_split_a_hot_group(skewed):
    blk = bl.sort_blocks(skewed, ["g"], ["id"], 6)
    hot = blk.filter("g = 'hot'").select(bl.BLOCK).distinct().count()
    assert hot >= 3


def test_running_values_equal_windows(skewed):
    w = Window.partitionBy("g").orderBy("id")
    to_here = w.rowsBetween(Window.unboundedPreceding, 0)
    from_here = w.rowsBetween(0, Window.unboundedFollowing)
    want = skewed.select(
        "id", F.sum("v").over(to_here).alias("s"), F.max("v").over(to_here).alias("m"),
        F.last("c", True).over(to_here).alias("l"), F.first("c", True).over(from_here).alias("n"))
    got = bl.running(bl.sort_blocks(skewed, ["g"], ["id"], 6), ["g"],
                     {"s": ("sum", "v"), "m": ("max", "v"), "l": ("last", "c"), "n": ("next", "c")}).select("id", "s", "m", "l", "n")
    assert sorted(got.collect()) == sorted(want.collect())


def test_running_without_groups(skewed):
    w = Window.partitionBy(F.lit(0)).orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    want = skewed.select("id", F.sum("v").over(w).alias("s"))
    got = bl.running(bl.sort_blocks(skewed, [], ["id"], 5), [], {"s": ("sum", "v")}).select("id", "s")
    assert sorted(got.collect()) == sorted(want.collect())


def test_neighbours_equal_lag_and_lead(skewed):
    w = Window.partitionBy("g").orderBy("v", "id")
    want = skewed.select("id", F.lag("id").over(w).alias("p"), F.lead("id").over(w).alias("n"))
    got = bl.neighbours(bl.sort_blocks(skewed, ["g"], ["v", "id"], 7), ["g"], ["id"]).select("id", "prev_id", "next_id")
    key = lambda r: r[0]
    assert [tuple(r) for r in sorted(got.collect(), key=key)] == [tuple(r) for r in sorted(want.collect(), key=key)]


@pytest.mark.parametrize("desc", [True, False])
def test_ranks_equal_windows(skewed, desc):
    order = F.col("v").desc() if desc else F.col("v").asc()
    w = Window.partitionBy("g").orderBy(order)
    want = skewed.select("id", F.row_number().over(Window.partitionBy("g").orderBy(order, "id")).alias("a"), F.rank().over(w).alias("b"), F.dense_rank().over(w).alias("c"))
    got = bl.ranks(skewed, ["g"], "v", "id", desc).select("id", "row_num", "rank_num", "dense_rank_num")
    assert [tuple(r) for r in sorted(got.collect())] == [tuple(r) for r in sorted(want.collect())]


def test_row_numbers_are_a_permutation(skewed):
    got = bl.row_numbers(bl.sort_blocks(skewed, [], [F.desc("v"), "id"], 5), [])
    assert sorted(r.rn for r in got.select("rn").collect()) == list(range(1, 901))


def test_percentiles_equal_numpy(skewed):
    got = {r.g: r for r in bl.percentiles(skewed, ["g"], "v", {"a": 0.25, "b": 0.5, "c": 0.99}).collect()}
    pdf = skewed.toPandas()
    for g, part in pdf.groupby("g"):
        assert [got[g].a, got[g].b, got[g].c] == pytest.approx(np.percentile(part.v, [25, 50, 99]).tolist())


def test_percentiles_even_count_nulls_and_weights(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 3), (None, 9), (10.0, 2)], "v double, w int")
    assert bl.percentiles(df, [], "v", {"m": 0.5}).first().m == 2.0
    assert bl.percentiles(df, [], "v", {"m": 0.75}, weight="w").first().m == pytest.approx(np.percentile([1, 2, 2, 2, 10, 10], 75))
    assert bl.percentiles(df.filter("v is null"), [], "v", {"m": 0.5}).first().m is None


@pytest.mark.parametrize(("few", "bins", "weight"), [(10_000, 1024, None), (10_000, 1024, "w"), (25, 8, "w")])
def test_selected_percentiles_match_numpy(spark, few, bins, weight):
    from orderlens.operators import selection

    rng = np.random.default_rng(4)
    rows = [("hot" if i % 3 else f"g{i % 7}", float(rng.normal()) * 10 ** int(rng.integers(0, 9)), float(i % 5), int(rng.integers(0, 4))) for i in range(400)]
    rows += [(None, 1.0, None, 1), ("one", 5.0, 2.0, 1), ("empty", None, None, 1)]
    df = spark.createDataFrame(rows, "g string, x double, y double, w int").repartition(3)
    points = {"x": [0.0, 0.25, 0.5, 0.99, 1.0], "y": [0.5]}
    got = selection.percentiles(df, points, [["g"], []], weight=weight, few=few, bins=bins)
    for group in ([], ["g"]):
        table = got.table(group, {f"{c}_{p}": (c, p) for c, ps in points.items() for p in ps}).collect()
        for r in table:
            for i, c in ((1, "x"), (2, "y")):
                values = [row[i] for row in rows if (not group or row[0] == r["g"]) and row[i] is not None for _ in range(row[3] if weight else 1)]
                for p in points[c]:
                    want = float(np.percentile(values, p * 100)) if values else None
                    assert r[f"{c}_{p}"] == (want if want is None else pytest.approx(want, rel=1e-12, abs=1e-12)), (group, r, c, p)
        assert len(table) == (1 if not group else len({row[0] for row in rows if row[1] is not None and (row[3] if weight else 1)} | {row[0] for row in rows if row[2] is not None and (row[3] if weight else 1)}))


def test_selected_percentiles_of_an_empty_table(spark):
    from orderlens.operators import selection

    got = selection.percentiles(spark.createDataFrame([], "g string, x double"), {"x": [0.5]}, [["g"], []])
    assert got.table(["g"], {"m": ("x", 0.5)}).count() == 0
    assert got.table([], {"m": ("x", 0.5)}).first()["m"] is None


def test_duplicates_by_fingerprints_and_with_a_forced_collision(spark):
    from orderlens.operators.fingerprints import count_duplicates

    rows = [("a", None, 1), (None, "a", 1), ("a", None, 1), ("b", "c", 2), ("b", "c", 2), ("b", "c", 2), (None, None, None), (None, None, None), ("x", "y", 3)]
    df = spark.createDataFrame(rows, "p string, q string, n int").repartition(3)
    want = (len(rows), len(rows) - len(set(rows)))
    assert tuple(count_duplicates(df, df.columns).first()) == want

    def collide(columns):
        return F.lit(7).cast("long"), F.lit(7).cast("long")

    assert tuple(count_duplicates(df, df.columns, collide).first()) == want
    assert tuple(count_duplicates(df.limit(0), df.columns).first()) == (0, 0)
