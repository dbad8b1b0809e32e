"""Exact percentiles of many columns and groupings in one pass over the rows.

The values of all columns are stacked as (grouping, group, column, value) and equal ones are counted: the only exchange
of rows, after partial counts. From there every wanted rank is found by counting in narrowing ranges: the range of a rank
is cut into ``BINS``, the counts of the bins say which of them hold it, and the smallest and largest value of those bins
are the next range. When a range holds at most ``FEW`` distinct values they are laid in order. Nothing is sorted as a
whole, no group meets in one task, and the number of jobs does not grow with columns, groups or ranks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.session import materialise, release

BINS = 1024
FEW = 10_000
#: rows of a table of targets that may be broadcast (some 100 bytes each)
BROADCAST_ROWS = 200_000


class Percentiles:
    """What was found: one row for each grouping, group, column and point."""

    def __init__(self, found: DataFrame, groupings: list[list[str]]):
        self.found, self.groupings = found, groupings

    def table(self, group: list[str], names: dict[str, tuple[str, float]]) -> DataFrame:
        """The group's columns and one column for each name: (column, point)."""
        here = self.found.where(F.col("_g") == self.groupings.index(group))
        picked = [F.max(F.when((F.col("_column") == c) & (F.col("_point") == float(p)), F.col("_value"))).alias(name) for name, (c, p) in names.items()]
        return here.groupBy(*group).agg(*picked)

    def scalar(self, column: str, point: float) -> Column:
        """A percentile of the whole table, for the grouping []."""
        return self.table([], {"value": (column, point)}).scalar()


def _small(rows: DataFrame) -> DataFrame:
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    return reduce(Column.__and__, [left[k].eqNullSafe(right[f"t{k}"]) for k in keys])


def _cut(counts: DataFrame, targets: DataFrame, keys: list[str]) -> DataFrame:
    """Values in the ranges of the targets: (target columns, _v, _n)."""
    t = _small(targets.withColumnsRenamed({k: f"t{k}" for k in keys}))
    inside = counts["_v"].between(t["_low"], t["_high"])
    return counts.join(t, _same(counts, t, keys) & inside).drop(*[f"t{k}" for k in keys])


def percentiles(df: DataFrame, columns: dict[str, list[float]], groupings: list[list[str]], weight: str | None = None, few: int = FEW, bins: int = BINS) -> Percentiles:
    """Linearly interpolated percentiles of each column at its points, for each grouping (a list of columns, [] for
    the whole table). NULL values are left out; a NULL group is a group. ``weight``: the rows that a row stands for."""
    names = list(dict.fromkeys(c for g in groupings for c in g))
    group_of = {c: f"_k{i}" for i, c in enumerate(names)}
    entries = [
        F.struct(F.lit(i).alias("_g"), *[(F.col(c) if c in g else F.lit(None).cast(df.schema[c].dataType)).alias(group_of[c]) for c in names],
                 F.lit(v).alias("_column"), F.col(v).cast("double").alias("_v"))
        for i, g in enumerate(groupings) for v in columns
    ]
    size = F.col(weight).cast("long") if weight else F.lit(1).cast("long")
    stacked = df.select(size.alias("_n"), F.explode(F.array(*entries)).alias("_e")).select("_n", "_e.*").where("_v is not null")
    keys = ["_g", *group_of.values(), "_column"]
    counts = materialise(stacked.groupBy(*keys, "_v").agg(F.sum("_n").alias("_n")).where("_n > 0"))

    points = F.create_map(*[x for c, ps in columns.items() for x in (F.lit(c), F.array(*[F.lit(float(p)) for p in ps]))])
    whole = counts.groupBy(*keys).agg(
        F.sum("_n").alias("_total"), F.count(F.lit(1)).alias("_distinct"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    place = F.col("_point") * (F.col("_total") - 1)
    targets = materialise(
        whole.withColumn("_point", F.explode(points[F.col("_column")])).withColumn("_first", F.floor(place))
        .withColumn("_second", F.least(F.col("_first") + 1, F.col("_total") - 1)).withColumn("_part", place - F.col("_first")).withColumn("_below", F.lit(0).cast("long")).drop("_total")
    )
    every = [*keys, "_point", "_first", "_second", "_part"]
    done = targets.where(F.col("_distinct") <= few)
    open_ = targets.where(F.col("_distinct") > few)
    finished = [done]
    while not open_.isEmpty():
        open_ = materialise(_narrowed(_cut(counts, open_, keys), every, bins))
        finished.append(open_.where(F.col("_distinct") <= few))
        open_ = open_.where(F.col("_distinct") > few)
    ready = materialise(reduce(DataFrame.unionByName, finished))

    order = Window.partitionBy(*keys, "_point").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)  # at most ``few`` rows
    laid = _cut(counts, ready, keys).withColumn("_end", F.col("_below") + F.sum("_n").over(order))

    def at(rank: str) -> Column:
        return F.max(F.when((F.col("_end") - F.col("_n") <= F.col(rank)) & (F.col(rank) < F.col("_end")), F.col("_v")))

    low, high = at("_first"), at("_second")
    found = laid.groupBy(*every).agg((low + (high - low) * F.col("_part")).alias("_value"))
    stored = materialise(found.select(*keys, "_point", "_value").withColumnsRenamed({k: c for c, k in group_of.items()}))
    release(counts)
    return Percentiles(stored, groupings)


def _narrowed(inside: DataFrame, every: list[str], bins: int) -> DataFrame:
    """The next range of each target: the bins that hold its two ranks, from their smallest to their largest value."""
    step = F.floor((F.col("_v") / bins - F.col("_low") / bins) / (F.col("_high") / bins - F.col("_low") / bins) * bins)
    binned = inside.withColumn("_bin", F.greatest(F.lit(0), F.least(step, F.lit(bins - 1))))
    per = binned.groupBy(*every, "_below", "_bin").agg(F.sum("_n").alias("_n"), F.count(F.lit(1)).alias("_distinct"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    order = Window.partitionBy(*every).orderBy("_bin").rowsBetween(Window.unboundedPreceding, 0)  # at most ``bins`` rows
    ended = per.withColumn("_end", F.col("_below") + F.sum("_n").over(order))
    holding = ended.where((F.col("_end") > F.col("_first")) & (F.col("_end") - F.col("_n") <= F.col("_second")))
    return holding.groupBy(*every).agg(
        F.sum("_distinct").alias("_distinct"), F.min("_low").alias("_low"), F.max("_high").alias("_high"), F.min(F.col("_end") - F.col("_n")).alias("_below"))
