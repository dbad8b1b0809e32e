"""Ordered operators that hold when one group owns a large share of the rows.

A plain window puts a whole group into one task. Here the rows are range
partitioned by (group, order), so a large group is spread over many blocks.
Each block is worked on alone; what has to cross a block border is carried by
a small table with one row per (block, group).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.session import materialise

BLOCK = "_blk"
POS = "_pos"
_IN_BLOCK = (1 << 33) - 1
BLOCK_ROWS = 1_000_000


def _key(k) -> Column:
    return k if isinstance(k, Column) else F.col(k).asc_nulls_last()


def sort_blocks(df: DataFrame, group: list[str], order: list, blocks: int | None = None) -> DataFrame:
    """Rows in (group, order) order with their block number and a position that
    grows in that order. ``order`` must be total for a repeatable result. The number
    of blocks follows the rows, so a block stays small however large the table is."""
    rows = materialise(df)  # read twice here: by the range sampler and by the exchange
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = blocks or max(least, -(-rows.count() // BLOCK_ROWS))
    keys = [_key(k) for k in [*group, *order]]
    return materialise(
        rows.repartitionByRange(n, *keys)
        .sortWithinPartitions(*keys)
        .withColumn(BLOCK, F.spark_partition_id())
        .withColumn(POS, F.monotonically_increasing_id())
    )


def _same_block(left: DataFrame, right: DataFrame, group: list[str]) -> Column:
    conds = [left[BLOCK] == right[f"c_{BLOCK}"]]
    conds += [left[g].eqNullSafe(right[f"c_{g}"]) for g in group]
    return reduce(lambda a, b: a & b, conds)


def _attach(blk: DataFrame, carry: DataFrame, group: list[str], outs: list[str]) -> DataFrame:
    # A block can continue at most one group from the block before it, so the
    # carry table has no more rows than there are blocks: safe to broadcast.
    renamed = carry.select(
        F.col(BLOCK).alias(f"c_{BLOCK}"), *[F.col(g).alias(f"c_{g}") for g in group], *outs
    )
    joined = blk.join(F.broadcast(renamed), _same_block(blk, renamed, group), "left")
    return joined.drop(f"c_{BLOCK}", *[f"c_{g}" for g in group])


_TOTAL = {
    "sum": lambda c: F.sum(c),
    "max": lambda c: F.max(c),
    "last": lambda c: F.max_by(c, F.when(c.isNotNull(), F.col(POS))),
    "next": lambda c: F.min_by(c, F.when(c.isNotNull(), F.col(POS))),
}


def running(blk: DataFrame, group: list[str], specs: dict[str, tuple[str, str]]) -> DataFrame:
    """Running values up to and including the row: ``{out: (kind, column)}`` with
    kind sum, max, last (last non-null so far) or next (first non-null from here)."""
    inside = Window.partitionBy(BLOCK, *group)
    to_here = inside.orderBy(POS).rowsBetween(Window.unboundedPreceding, 0)
    # read backwards: a frame that only grows costs one step per row
    from_here = inside.orderBy(F.desc(POS)).rowsBetween(Window.unboundedPreceding, 0)
    totals = blk.groupBy(BLOCK, *group).agg(
        *[_TOTAL[kind](F.col(c)).alias(f"t_{out}") for out, (kind, c) in specs.items()]
    )
    chain = Window.partitionBy(*[F.col(g) for g in group] or [F.lit(0)])
    before = chain.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    after = chain.orderBy(F.desc(BLOCK)).rowsBetween(Window.unboundedPreceding, -1)

    def carried(out: str, kind: str) -> Column:
        c = F.col(f"t_{out}")
        if kind == "sum":
            return F.sum(c).over(before)
        if kind == "max":
            return F.max(c).over(before)
        if kind == "last":
            return F.last(c, ignorenulls=True).over(before)
        return F.last(c, ignorenulls=True).over(after)

    outs = [f"k_{out}" for out in specs]
    carry = totals.select(
        BLOCK, *group, *[carried(out, kind).alias(f"k_{out}") for out, (kind, _) in specs.items()]
    ).filter(reduce(lambda a, b: a | b, [F.col(o).isNotNull() for o in outs]))

    def here(out: str, kind: str, c: str) -> Column:
        col, k = F.col(c), F.col(f"k_{out}")
        if kind == "sum":
            return F.sum(col).over(to_here) + F.coalesce(k, F.lit(0))
        if kind == "max":
            return F.greatest(F.max(col).over(to_here), k)
        if kind == "last":
            return F.coalesce(F.last(col, ignorenulls=True).over(to_here), k)
        return F.coalesce(F.last(col, ignorenulls=True).over(from_here), k)

    return (
        _attach(blk, carry, group, outs)
        .withColumns({out: here(out, kind, c) for out, (kind, c) in specs.items()})
        .drop(*outs)
    )


def neighbours(blk: DataFrame, group: list[str], cols: list[str]) -> DataFrame:
    """The values of the row before (``prev_c``) and after (``next_c``) in the group."""
    w = Window.partitionBy(BLOCK, *group).orderBy(POS)
    both = F.struct(*cols)
    ends = blk.groupBy(BLOCK, *group).agg(
        F.max_by(both, POS).alias("_tail"), F.min_by(both, POS).alias("_head")
    )
    chain = Window.partitionBy(*[F.col(g) for g in group] or [F.lit(0)]).orderBy(BLOCK)
    carry = ends.select(
        BLOCK, *group, F.lag("_tail").over(chain).alias("_kp"), F.lead("_head").over(chain).alias("_kn")
    ).filter("_kp is not null or _kn is not null")
    out = _attach(blk, carry, group, ["_kp", "_kn"])
    out = out.withColumns(
        {"_lp": F.coalesce(F.lag(both).over(w), F.col("_kp")), "_ln": F.coalesce(F.lead(both).over(w), F.col("_kn"))}
    )
    return out.select(
        *[c for c in blk.columns],
        *[F.col(f"_lp.{c}").alias(f"prev_{c}") for c in cols],
        *[F.col(f"_ln.{c}").alias(f"next_{c}") for c in cols],
    )


def row_numbers(blk: DataFrame, group: list[str], out: str = "rn") -> DataFrame:
    """1-based position in the group."""
    if group:
        return running(blk.withColumn("_one", F.lit(1)), group, {out: ("sum", "_one")}).drop("_one")
    sizes = blk.groupBy(BLOCK).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(F.lit(0)).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col(BLOCK).alias("c_" + BLOCK), F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off")
    )
    return (
        blk.join(F.broadcast(offsets), F.col(BLOCK) == F.col("c_" + BLOCK))
        .withColumn(out, F.col("_off") + F.col(POS).bitwiseAND(F.lit(_IN_BLOCK)) + 1)
        .drop("c_" + BLOCK, "_off")
    )


def ranks(df: DataFrame, group: list[str], value: str, tie: str, descending: bool = True) -> DataFrame:
    """row_num, rank_num and dense_rank_num of ``value`` inside ``group``.

    Positions over the whole table are known per block; a row's ranks follow from
    the positions where its group and its run of equal values begin."""
    order = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()
    blk = row_numbers(sort_blocks(df, group, [order, tie]), [], "_at")
    blk = neighbours(blk, group, [value, "_at"])
    first = F.col("prev__at").isNull()
    new = first | ~F.col(value).eqNullSafe(F.col(f"prev_{value}"))
    blk = blk.withColumns(
        {"_new": new.cast("long"), "_run": F.when(new, F.col("_at")), "_grp": F.when(first, F.col("_at"))}
    )
    out = running(blk, group, {"dense_rank_num": ("sum", "_new"), "_r0": ("max", "_run"), "_g0": ("max", "_grp")})
    return out.select(
        *df.columns, (F.col("_at") - F.col("_g0") + 1).alias("row_num"),
        (F.col("_r0") - F.col("_g0") + 1).alias("rank_num"), "dense_rank_num",
    )


def percentiles(
    df: DataFrame, group: list[str], value: str, points: dict[str, float], weight: str | None = None,
    blocks: int | None = None,
) -> DataFrame:
    """Exact linearly interpolated percentiles per group.

    ``weight`` gives the number of rows a row stands for. Equal values are counted first, then their counts are accumulated over
    blocks, so neither a large group nor many distinct values meet in one task."""
    size = F.sum(weight) if weight else F.count(F.lit(1))
    counts = df.filter(F.col(value).isNotNull()).groupBy(*group, value).agg(size.alias("_n"))
    blk = sort_blocks(counts, group, [value], blocks)
    cum = running(blk, group, {"_cum": ("sum", "_n")})
    totals = blk.groupBy(*group).agg(F.sum("_n").alias("_total"))
    if group:
        t = totals.select(*[F.col(g).alias(f"t_{g}") for g in group], "_total")
        cond = reduce(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"t_{g}")) for g in group])
        ranked = cum.join(t, cond).drop(*[f"t_{g}" for g in group])
    else:
        ranked = cum.withColumn("_total", totals.scalar())

    def at(pos: Column) -> Column:
        hit = (F.col("_cum") - F.col("_n") <= pos) & (pos < F.col("_cum"))
        return F.max(F.when(hit, F.col(value)))

    aggs, outs = [], []
    for name, p in points.items():
        pos = F.lit(float(p)) * (F.col("_total") - 1)
        lo = F.floor(pos)
        hi = F.least(lo + 1, F.col("_total") - 1)
        aggs += [at(lo).alias(f"l_{name}"), at(hi).alias(f"h_{name}"), F.max(pos - lo).alias(f"f_{name}")]
        outs.append(
            (F.col(f"l_{name}") + (F.col(f"h_{name}") - F.col(f"l_{name}")) * F.col(f"f_{name}"))
            .cast("double")
            .alias(name)
        )
    return ranked.groupBy(*group).agg(*aggs).select(*group, *outs)
