"""Are the reported patterns distinguishable from noise? Permutation tests.

Shuffling n rows thousands of times is replaced by drawing what the statistic
needs, with the same null distribution:

* a flag or a whole-number value has few distinct values, so a shuffle is a draw
  of value counts per group without replacement (multivariate hypergeometric);
  its cost does not grow with the rows;
* a column of many values is counted first, and its distinct values are dealt into
  blocks, the leaves of a tree. How many rows of a node go to each group is drawn
  from the root down (hypergeometric again): a node sees the numbers of its own
  branch only. In a leaf the rows of each value are drawn for each group; where
  values hardly repeat, their few rows are shuffled, which is the same draw. The
  work follows the distinct values, not the rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.operators.blocks import ranks
from orderlens.session import materialise

SEED = 42
BATCH = 100  # replicates per task
GROUPS_PER_CHUNK = 2000
VALUES_PER_BLOCK = 20_000
FAN = 64  # children of a node
REPEATS = 16  # rows for each value (of a group, where there are many) from which on counts are drawn instead of rows shuffled
FEW_GROUPS = 64  # up to so many, counts are drawn for each group and value
DRAWS_HELD = 500  # draws that a task holds before it hands them on
_NUMPY_LIMIT = 10**9  # the library's bound on a hypergeometric population
_lgamma = np.vectorize(math.lgamma, otypes=[float])


def _hyper(rng, good: np.ndarray, rest: np.ndarray, need: np.ndarray) -> np.ndarray:
    """Hypergeometric draws, exact for any population: the library's generator up to its
    bound, the ratio of uniforms beyond."""
    small = good + rest < _NUMPY_LIMIT
    if small.all():
        return rng.hypergeometric(good, rest, need)
    out = np.empty(len(good), np.int64)
    out[small] = rng.hypergeometric(good[small], rest[small], need[small])
    out[~small] = _hyper_large(rng, good[~small], rest[~small], need[~small])
    return out


def _hyper_large(rng, good: np.ndarray, rest: np.ndarray, need: np.ndarray) -> np.ndarray:
    """Rejection from a table mountain hat around the mode (ratio of uniforms, Stadlober 1990)."""
    low, high = np.maximum(need - rest, 0), np.minimum(good, need)
    total = (good + rest).astype(float)
    mean = need * (good / total)
    sd = np.sqrt(np.maximum(mean * (rest / total) * (total - need) / np.maximum(total - 1, 1), 0) + 0.5)
    mode = np.clip(np.floor((need + 1.0) * (good + 1.0) / (total + 2)), low, high)

    def log_weight(k, at):  # log of the probability, up to a constant
        return -(_lgamma(k + 1) + _lgamma(good[at] - k + 1) + _lgamma(need[at] - k + 1) + _lgamma(rest[at] - need[at] + k + 1))

    top = log_weight(mode, np.arange(len(good)))
    width = 2 * np.sqrt(2 / np.e) * sd + 3 - 2 * np.sqrt(3 / np.e)  # the hat's width, from the paper
    out, open_ = np.where(low == high, low, -1).astype(np.int64), np.flatnonzero(low < high)
    while len(open_):
        u, v = 1.0 - rng.random(len(open_)), rng.random(len(open_))
        k = np.floor(mean[open_] + 0.5 + width[open_] * (v - 0.5) / u)
        inside = (k >= low[open_]) & (k <= high[open_])
        accept = np.zeros(len(open_), bool)
        accept[inside] = 2 * np.log(u[inside]) <= log_weight(k[inside], open_[inside]) - top[open_[inside]]
        out[open_[accept]] = k[accept].astype(np.int64)
        open_ = open_[~accept]
    return out


def _draw(rng, left: np.ndarray, n) -> np.ndarray:
    """For each row of ``left`` (replicates x values) the counts per value in a draw of
    n without replacement; n is one number or one for each row."""
    out, need, rest = np.zeros_like(left), np.broadcast_to(np.asarray(n, np.int64), len(left)).copy(), left.sum(axis=1)
    for i in range(left.shape[1]):
        rest = rest - left[:, i]
        out[:, i] = _hyper(rng, left[:, i], rest, need)
        need = need - out[:, i]
    return out


def _rng(seed: int, test: str, *place: int):
    """The generator of one batch of replicates, wherever the batch is worked on."""
    return np.random.default_rng([seed, sum(map(ord, test)), *place])


# ------------------------------------------------------------ observed
def _cat(c) -> Column:
    return F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit("nan"))


def chi2(cells: DataFrame) -> DataFrame:
    """Chi-square per test from (test, g, v in {0, 1}, n)."""
    g = cells.groupBy("test", "g").agg(F.sum("n").alias("ng"), F.sum(F.when(F.col("v") == 1, F.col("n")).otherwise(0)).alias("o1"))
    tot = cells.groupBy("test").agg(F.sum("n").alias("nn"), F.sum(F.when(F.col("v") == 1, F.col("n")).otherwise(0)).alias("ff"))
    d = g.join(tot, "test")

    def part(obs: Column, margin: Column) -> Column:
        e = F.col("ng") * margin / F.col("nn")
        return F.pow(obs - e, 2) / F.when(e > 0, e).otherwise(1.0)

    o1, f1 = F.col("o1"), F.col("ff")
    return d.groupBy("test").agg(F.sum(part(o1, f1) + part(F.col("ng") - o1, F.col("nn") - f1)).alias("statistic"))


def mean_variance(cells: DataFrame) -> DataFrame:
    """Sample variance of the group means per test from (test, g, v, n)."""
    means = cells.groupBy("test", "g").agg((F.sum(F.col("v") * F.col("n")) / F.sum("n")).alias("m"))
    return means.groupBy("test").agg(F.var_samp("m").alias("statistic"))


# --------------------------------------------------- shuffles, few values
def _chunk_draws(seed: int):
    def run(batches):
        for pdf in batches:
            rows = []
            for test, batch, width, counts, chunks, sizes in zip(pdf.test, pdf.batch, pdf.width, pdf.counts, pdf.chunks, pdf.sizes):
                rng = _rng(seed, test, int(batch), 0)
                left = np.tile(np.asarray(counts, dtype=np.int64), (int(width), 1))
                for c, n in zip(chunks, sizes):
                    d = _draw(rng, left, n)
                    left = left - d
                    rows.append((test, int(batch), int(c), d.ravel()))
                    if len(rows) == DRAWS_HELD:
                        yield pd.DataFrame(rows, columns=["test", "batch", "chunk", "draw"])
                        rows = []
            yield pd.DataFrame(rows, columns=["test", "batch", "chunk", "draw"])

    return run


def chunk_sums(rng, y: np.ndarray, left: np.ndarray, sizes: np.ndarray) -> Iterator[np.ndarray]:
    """For each group, the sums over its rows in all replicates. ``left`` (replicates x values): rows of each value, which the
    groups take between them. Many small groups are cut from the shuffled rows: counts drawn value by value would be more
    than the rows are. At most REPEATS rows for each group and value are held."""
    if len(sizes) > FEW_GROUPS and sizes.sum() <= REPEATS * len(y) * len(sizes):
        starts = np.cumsum(sizes) - sizes
        yield from np.stack([np.add.reduceat(rng.permutation(np.repeat(y, n)), starts) for n in left], axis=1)
        return
    for n in sizes:
        d = _draw(rng, left, n)
        left = left - d
        yield d @ y


def _group_statistics(seed: int):
    def run(key, draws: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
        test, chunk, batch = key[0], int(key[1]), int(key[2])
        one = draws.iloc[0]
        v, c = np.asarray(one["values"], dtype=float), np.asarray(one["counts"], dtype=float)
        left = np.asarray(one["draw"], dtype=np.int64).reshape(-1, len(v))
        total, grand = c.sum(), (c * v).sum() / c.sum()
        rng, reps = _rng(seed, test, batch, chunk + 1), len(left)
        s1, s2 = np.zeros(reps), np.zeros(reps)
        sizes, flags = groups.sort_values("g").n.to_numpy(dtype=np.int64), one["kind"] == "chi2"
        for n, sums in zip(sizes, chunk_sums(rng, (v == 1).astype(float) if flags else v, left, sizes), strict=True):
            if flags:
                f = c[v == 1].sum()
                e1, e0 = n * f / total, n * (total - f) / total
                s1 += (sums - e1) ** 2 / (e1 if e1 > 0 else 1) + (n - sums - e0) ** 2 / (e0 if e0 > 0 else 1)
            else:
                m = sums / n - grand
                s1, s2 = s1 + m, s2 + m * m
        return pd.DataFrame({"test": test, "kind": one["kind"], "rep": np.arange(reps) + batch * BATCH, "k": len(groups), "s1": s1, "s2": s2})

    return run


def shuffle_few_values(cells: DataFrame, groups: DataFrame, tests: DataFrame, seed: int = SEED) -> DataFrame:
    """Null statistics (test, rep, stat).

    ``cells`` (test, g, v, n) counts all values, ``groups`` (test, g, n) the groups
    that take part, ``tests`` (test, kind, reps) the statistic and the replicates."""
    spark = cells.sparkSession
    # values of one test: two for a flag, at most a few hundred whole minutes
    per_value = cells.groupBy("test", "v").agg(F.sum("n").alias("n"))
    arrays = per_value.groupBy("test").agg(F.sort_array(F.collect_list(F.struct("v", "n"))).alias("a")).select(
        "test", F.col("a.v").alias("values"), F.col("a.n").alias("counts"))
    in_test = groups.groupBy("test").agg(F.count(F.lit(1)).alias("_k"))
    parts = F.ceil(F.col("_k") / GROUPS_PER_CHUNK)
    placed = groups.join(in_test, "test").withColumn("chunk", F.pmod(F.xxhash64("g"), parts).cast("int")).drop("_k")
    sizes = placed.groupBy("test", "chunk").agg(F.sum("n").alias("s")).groupBy("test").agg(
        F.sort_array(F.collect_list(F.struct("chunk", "s"))).alias("a")).select(
        "test", F.col("a.chunk").alias("chunks"), F.col("a.s").alias("sizes"))
    setup = materialise(tests.join(arrays, "test").join(sizes, "test"))
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    batch = F.explode(F.expr(f"sequence(0, cast(floor((reps - 1) / {BATCH}) as int))")).alias("batch")
    each = setup.select("test", "reps", "counts", "chunks", "sizes", batch).withColumn("width", F.least(F.lit(BATCH), F.col("reps") - F.col("batch") * BATCH))
    draws = each.repartition(width, "test", "batch").select("test", "batch", "width", "counts", "chunks", "sizes").mapInPandas(
        _chunk_draws(seed), "test string, batch int, chunk int, draw array<long>")
    draws = draws.join(setup.select("test", "kind", "values", "counts"), "test")
    members = placed.join(setup.select("test", "reps"), "test").select("test", "chunk", "g", "n", batch)
    keys = ("test", "chunk", "batch")
    parts_out = draws.groupBy(*keys).cogroup(members.groupBy(*keys)).applyInPandas(
        _group_statistics(seed), "test string, kind string, rep int, k int, s1 double, s2 double")
    per_rep = parts_out.groupBy("test", "kind", "rep").agg(F.sum("k").alias("k"), F.sum("s1").alias("s1"), F.sum("s2").alias("s2"))
    spread = F.try_divide(F.col("s2") - F.col("s1") * F.col("s1") / F.col("k"), F.col("k") - 1.0)
    return per_rep.select("test", "rep", F.when(F.col("kind") == "chi2", F.col("s1")).otherwise(spread).alias("stat"))


# ------------------------------------------------ shuffles, many values
DRAWS = "test string, batch int, node long, take array<long>, k int"


def _child_draws(seed: int, level: int):
    """What of a node's rows goes to each child, for all replicates of a batch."""
    def run(batches):
        for pdf in batches:
            rows = []
            for test, batch, node, take, k, children, lengths in zip(pdf.test, pdf.batch, pdf.node, pdf["take"], pdf.k, pdf.children, pdf.lengths):
                rng = _rng(seed, test, int(batch), 7, level, int(node))
                left = np.asarray(take, dtype=np.int64).reshape(-1, int(k))
                for child, n in zip(children, lengths):
                    d = _draw(rng, left, n)
                    left = left - d
                    rows.append((test, int(batch), int(child), d.ravel(), int(k)))
                    if len(rows) == DRAWS_HELD:
                        yield pd.DataFrame(rows, columns=["test", "batch", "node", "take", "k"])
                        rows = []
            yield pd.DataFrame(rows, columns=["test", "batch", "node", "take", "k"])

    return run


def group_sums(rng, y: np.ndarray, n: np.ndarray, take: np.ndarray) -> np.ndarray:
    """(replicates x groups): sums of values that each group draws, values y of n rows each; ``take``: rows by group."""
    if n.sum() <= REPEATS * len(y):
        every = np.repeat(y, n)
        ends = np.concatenate([np.zeros((len(take), 1), np.int64), np.cumsum(take, axis=1)], axis=1)
        return np.stack([np.diff(np.concatenate([[0.0], np.cumsum(rng.permutation(every))])[e]) for e in ends])
    left, sums = np.tile(n, (len(take), 1)), np.zeros(take.shape)
    for i in range(take.shape[1] - 1):
        d = _draw(rng, left, take[:, i])
        left = left - d
        sums[:, i] = d @ y
    sums[:, -1] = left @ y
    return sums


def _block_sums(seed: int):
    def run(key, rows: pd.DataFrame, draws: pd.DataFrame) -> pd.DataFrame:
        rows, block = rows.sort_values("y"), int(key[0])
        y, n = rows.y.to_numpy(dtype=float), rows.n.to_numpy(dtype=np.int64)
        parts = []
        for test, batch, take, k in zip(draws.test, draws.batch, draws["take"], draws.k):
            sums = group_sums(_rng(seed, test, int(batch), block + 1, 11), y, n, np.asarray(take, dtype=np.int64).reshape(-1, int(k)))
            reps, groups = np.indices(sums.shape)
            parts.append(pd.DataFrame({"test": test, "rep": int(batch) * BATCH + reps.ravel(), "i": groups.ravel(), "s": sums.ravel()}))
        return pd.concat(parts) if parts else pd.DataFrame({"test": [], "rep": [], "i": [], "s": []})

    return run


def shuffle_many_values(rows: DataFrame, groups: DataFrame, reps: int, seed: int = SEED) -> DataFrame:
    """(test, rep, i, s, n): sum of the shuffled y over group i of n rows.

    ``rows`` (y), ``groups`` (test, g, n) with few groups per test, which take all rows between them."""
    spark = rows.sparkSession
    counted = materialise(rows.where("y is not null").groupBy("y").agg(F.count(F.lit(1)).alias("n")))
    leaves, depth = -(-counted.count() // VALUES_PER_BLOCK), 0
    while FAN**depth < leaves:
        depth += 1
    placed = counted.withColumn("node", F.pmod(F.xxhash64("y"), F.lit(max(1, leaves))))
    lengths = materialise(placed.groupBy("node").agg(F.sum("n").alias("n")))
    sizes = groups.groupBy("test").agg(F.sort_array(F.collect_list(F.struct("g", "n"))).alias("a")).select("test", F.col("a.n").alias("sizes"))
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    each = sizes.withColumn("batch", F.explode(F.sequence(F.lit(0), F.lit((reps - 1) // BATCH))))
    in_batch = F.least(F.lit(BATCH), F.lit(reps) - F.col("batch") * BATCH)
    draws = each.select("test", "batch", F.lit(0).cast("long").alias("node"), F.flatten(F.array_repeat("sizes", in_batch)).alias("take"), F.size("sizes").alias("k"))
    for level in range(depth):
        below = FAN ** (depth - level - 1)  # leaves under a child
        sums = lengths.groupBy(F.floor(F.col("node") / below).alias("child")).agg(F.sum("n").alias("n"))
        children = sums.groupBy(F.floor(F.col("child") / FAN).alias("node")).agg(F.sort_array(F.collect_list(F.struct("child", "n"))).alias("c"))  # at most FAN
        at = draws.join(children.select("node", F.col("c.child").alias("children"), F.col("c.n").alias("lengths")), "node")
        columns = ("test", "batch", "node", "take", "k", "children", "lengths")
        draws = materialise(at.select(*columns).repartition(width, "test", "batch", "node").mapInPandas(_child_draws(seed, level), DRAWS))
    sums = placed.groupBy("node").cogroup(draws.groupBy("node")).applyInPandas(_block_sums(seed), "test string, rep int, i int, s double")
    per = sums.groupBy("test", "rep", "i").agg(F.sum("s").alias("s"))
    number = sizes.select("test", F.posexplode("sizes").alias("i", "n"))
    return per.join(number, ["test", "i"])


def p_values(null: DataFrame, observed: DataFrame) -> DataFrame:
    """Share of null statistics not below the observed one, plus 1 / (n + 1)."""
    hit = F.col("stat") >= F.col("statistic") - F.abs(F.col("statistic")) * 1e-9
    return null.join(observed, "test").groupBy("test").agg(
        F.max("statistic").alias("statistic"), (F.avg(hit.cast("double")) + 1.0 / (F.count(F.lit(1)) + 1)).alias("p"))


# --------------------------------------------------------------- battery
def _entry(test: str, g, v: str, when: Column | None = None) -> Column:
    e = F.struct(F.lit(test).alias("test"), _cat(g).alias("g"), F.col(v).cast("double").alias("v"))
    return e if when is None else F.when(when, e)


# What each test compares.
CANCEL = {"cuisine": "Cuisine", "restaurant_city": "RCity", "weather": "WeatherCondition", "payment_method": "PaymentMethod", "hour": "hour",
          "weekend": "WeekendOrder", "membership": "Membership", "has_coupon": "HasCoupon"}
LATE_BY = {"restaurant_city": "RCity", "traffic": "TrafficScore", "rain": "RainImpact", "vehicle": "VehicleType", "peak_hour": "PeakHour", "weekend": "WeekendOrder"}
TIME_BY = {"traffic": "TrafficScore", "rain": "RainImpact", "weather": "WeatherCondition", "vehicle": "VehicleType", "city": "RCity"}
VALUE_BY = {"membership": "Membership", "has_coupon": "HasCoupon", "cuisine": "Cuisine"}
PARTNER = "partner_time_spread"


def count_cells(base: DataFrame, entries: list[Column]) -> DataFrame:
    """(test, g, v, n) for all tests in one pass over the orders."""
    e = base.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.*")
    return e.groupBy("test", "g", "v").agg(F.count(F.lit(1)).alias("n"))


def flag_entries() -> list[Column]:
    done = F.col("IsDelivered") & F.col("DeliveryTimeMinutes").isNotNull()
    return [_entry(f"cancel_rate_by_{k}", c, "IsCancelled") for k, c in CANCEL.items()] + [
        _entry(f"late_rate_by_{k}", c, "IsLate", done) for k, c in LATE_BY.items()]


def time_entries() -> list[Column]:
    done = F.col("IsDelivered") & F.col("DeliveryTimeMinutes").isNotNull()
    return [_entry(f"delivery_time_by_{k}", c, "DeliveryTimeMinutes", done) for k, c in TIME_BY.items()]


def partner_entries() -> list[Column]:
    done = F.col("IsDelivered") & F.col("DeliveryTimeMinutes").isNotNull()
    return [_entry(PARTNER, "DeliveryPartnerID", "DeliveryTimeMinutes", done)]


def _groups(cells: DataFrame) -> DataFrame:
    return cells.groupBy("test", "g").agg(F.sum("n").alias("n"))


def _tests(cells: DataFrame, kind: str, reps: int) -> DataFrame:
    return cells.select("test").distinct().select("test", F.lit(kind).alias("kind"), F.lit(reps).alias("reps"))


def rate_tests(base: DataFrame, reps: int = 2000) -> DataFrame:
    cells = materialise(count_cells(base, flag_entries()))
    null = shuffle_few_values(cells, _groups(cells), _tests(cells, "chi2", reps))
    return p_values(null, chi2(cells))


def time_tests(base: DataFrame, reps: int = 2000) -> DataFrame:
    cells = materialise(count_cells(base, time_entries()))
    null = shuffle_few_values(cells, _groups(cells), _tests(cells, "mean", reps))
    return p_values(null, mean_variance(cells))


def partner_test(base: DataFrame, reps: int = 500, least: int = 10) -> DataFrame:
    """Values are shuffled over all deliveries; only busy partners are compared."""
    cells = materialise(count_cells(base, partner_entries()))
    busy = _groups(cells).filter(F.col("n") >= least)
    null = shuffle_few_values(cells, busy, _tests(cells, "mean", reps))
    return p_values(null, mean_variance(cells.join(busy.select("g"), "g", "left_semi")))


def value_tests(base: DataFrame, reps: int = 2000, by: dict | None = None) -> DataFrame:
    by = by or VALUE_BY
    done = base.filter("IsDelivered and FinalAmount is not null")
    names = [F.struct(F.lit(f"order_value_by_{k}").alias("test"), _cat(c).alias("g")) for k, c in by.items()]
    long = done.select("FinalAmount", F.explode(F.array(*names)).alias("e")).select("FinalAmount", "e.*")
    stats = materialise(long.groupBy("test", "g").agg(F.count(F.lit(1)).alias("n"), F.avg("FinalAmount").alias("m")))
    observed = stats.groupBy("test").agg(F.var_samp("m").alias("statistic"))
    sums = shuffle_many_values(done.select(F.col("OrderID").alias("id"), F.col("FinalAmount").alias("y")), stats.select("test", "g", "n"), reps)
    null = sums.groupBy("test", "rep").agg(F.var_samp(F.col("s") / F.col("n")).alias("stat"))
    return p_values(null, observed)


def battery(base: DataFrame, reps: int = 2000, partner_reps: int = 500) -> DataFrame:
    parts = [rate_tests(base, reps), time_tests(base, reps), value_tests(base, reps), partner_test(base, partner_reps)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def battery_summary(tests: DataFrame) -> DataFrame:
    return tests.agg(F.count(F.lit(1)).alias("n_tests"), F.count_if(F.col("p") < 0.05).alias("n_p_below_05"))


def auc_null(scores: DataFrame, key: str, label: str, score: str, reps: int = 500) -> DataFrame:
    """Observed AUC and its permutation p-value: under the null the positives are a
    random subset of the rows, so their rank sum is a sum over a random group."""
    blk = ranks(scores.select(F.col(key).alias("id"), F.col(label).alias("label"), F.col(score).alias("s")), [], "s", "id", descending=False)
    tied = blk.groupBy("s").agg(F.count(F.lit(1)).alias("_k"))
    r = materialise(blk.join(tied, "s").select("id", "label", (F.col("rank_num") + (F.col("_k") - 1) / 2.0).alias("y")))
    groups = r.groupBy(F.lit("auc").alias("test"), F.col("label").cast("string").alias("g")).agg(F.count(F.lit(1)).alias("n"))
    m, n = r.select(F.sum("label")).scalar(), r.select(F.count(F.lit(1))).scalar()

    def auc(rank_sum: Column) -> Column:
        return F.coalesce(F.try_divide(rank_sum - m * (m + 1) / 2.0, (m * (n - m)).cast("double")), F.lit(0.0))

    observed = r.filter("label = 1").agg(F.sum("y").alias("rs")).select(F.lit("auc").alias("test"), auc(F.col("rs")).alias("statistic"))
    sums = shuffle_many_values(r.select("id", "y"), groups, reps)
    # groups are in label order, so the positives are the last one
    null = sums.filter("i = 1").select("test", "rep", auc(F.col("s")).alias("stat"))
    return p_values(null, observed)


