"""Totals kept up to date from a stream of orders, also when an order changes.

State holds the last version of each order, on disk, many orders by the hash of their key in one entry: Python is called
once for an entry and batch instead of once for an order. A version that is newer than the one held takes its place: what the
old one had added is taken back and the new one added, as two signed rows. An older or equal version, sent again or late,
changes nothing. Each micro-batch adds its signed rows up by key and writes the sums to its own folder, named by the
batch number: a replayed batch overwrites its folder, so the result is the same after a restart. The current totals are the
sums over all folders; they never depend on how the input was cut into batches.

Amounts are added up as decimals, so that taking back leaves nothing behind."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from orderlens.session import children, discard, exists
from orderlens.sources.schemas import CLEAN

MONEY = "decimal(28,4)"
DISK_STATE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_CONF = "spark.sql.streaming.stateStore.providerClass"
#: entries of the state; a checkpoint keeps to the number it began with
ENTRIES = 2048


def order_stream(spark: SparkSession, folder: str, schema: StructType | None = None, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema or CLEAN["orders"])
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(folder)


def changes(orders: DataFrame, values: dict[str, Column], key: str = "OrderID", version: str | None = None) -> DataFrame:
    """Signed rows (sign, values): each new version of an order adds its own and takes back those of the one before.

    ``values``: what a version adds to, by name; an order whose values are all NULL adds nothing. ``version`` is a whole
    number that grows with each change; without it the first version is kept. Rows without a key or a version are left
    out."""
    number = F.col(version).cast("long") if version else F.lit(0).cast("long")
    typed = orders.select(F.col(key).cast("long").alias("_key"), number.alias("_version"), *[c.alias(n) for n, c in values.items()])
    typed = typed.where("_key is not null and _version is not null")
    names = list(values)
    # as texts, since pandas would make a column of whole numbers with gaps one of floats
    rows = typed.select(F.pmod(F.xxhash64("_key"), F.lit(ENTRIES)).alias("_entry"), F.col("_key").cast("string"), "_version", *[F.col(n).cast("string") for n in names])
    kinds = [int if isinstance(typed.schema[n].dataType, T.LongType) else str for n in names]

    def follow(entry: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = json.loads(state.get[0]) if state.exists else {}
        new: dict[str, tuple] = {}
        for batch in batches:
            for key, number, *row in zip(*(batch[c].tolist() for c in ("_key", "_version", *names)), strict=True):
                last = new.get(key) or held.get(key)
                if last is None or number > last[0]:
                    new[key] = (number, *(None if pd.isna(v) else v for v in row))
        if new:
            signed = [(1, *v[1:]) for v in new.values()] + [(-1, *held[k][1:]) for k in new if k in held]
            held.update(new)
            state.update((json.dumps(held),))
            columns = zip(*signed, strict=True)
            found = {c: [None if v is None else kind(v) for v in column] for c, kind, column in zip(["sign", *names], [int, *kinds], columns, strict=True)}
            yield pd.DataFrame(found, dtype=object)

    out = T.StructType([T.StructField("sign", T.LongType()), *[typed.schema[n] for n in names]])
    return rows.groupBy("_entry").applyInPandasWithState(follow, out, "held string", "append", GroupStateTimeout.NoTimeout)


def customer_changes(orders: DataFrame, version: str | None = None) -> DataFrame:
    return changes(orders, {"CustomerID": F.col("CustomerID").cast("long")}, version=version)


def city_changes(orders: DataFrame, restaurants: DataFrame, version: str | None = None) -> DataFrame:
    """An order of an unknown restaurant has no city; it counts from the version on that has one."""
    cities = restaurants.select("RestaurantID", "City")
    values = {"City": F.col("City"), "FinalAmount": F.col("FinalAmount").cast(MONEY).cast("string"), "Minutes": F.col("DeliveryTimeMinutes").cast("long").cast("string")}
    return changes(orders.join(cities, "RestaurantID", "left"), values, version=version)


SIGN = "sign"


def customer_sums(signed: DataFrame) -> DataFrame:
    return signed.where("CustomerID is not null").groupBy("CustomerID").agg(F.sum(SIGN).alias("NewOrders"))


def city_sums(signed: DataFrame) -> DataFrame:
    minutes = F.col("Minutes").cast("long")
    return signed.where("City is not null").groupBy("City").agg(
        F.sum(SIGN).alias("TotalOrders"), F.sum(F.col(SIGN).cast(MONEY) * F.col("FinalAmount").cast(MONEY)).cast(MONEY).alias("Revenue"),
        F.sum(F.col(SIGN) * minutes).alias("Minutes"), F.sum(F.when(minutes.isNotNull(), F.col(SIGN))).alias("Timed"))


SUM_SCHEMAS = {
    "CustomerID": "CustomerID long, NewOrders long",
    "City": f"City string, TotalOrders long, Revenue {MONEY}, Minutes long, Timed long",
}


def run(signed: DataFrame, sums, out: str, checkpoint: str, continuous: bool = False):
    """Start the query, with its state on disk; without ``continuous`` it ends when the input is used up."""
    def store(batch: DataFrame, number: int) -> None:
        sums(batch).write.mode("overwrite").parquet(f"{out}/batches/batch={number}")

    signed.sparkSession.conf.set(STATE_CONF, DISK_STATE)
    writer = signed.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(store)
    if continuous:
        return writer.start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def _added(rows: DataFrame, key: str) -> DataFrame:
    sums = [F.sum(c).cast(t).alias(c) for c, t in rows.dtypes if c not in (key, "batch")]
    return rows.groupBy(key).agg(*sums)


def _compacted(spark: SparkSession, out: str) -> int:
    """The last batch that complete compacted sums hold, or -1."""
    done = [int(n.removeprefix("upto=")) for n in children(spark, f"{out}/compacted") if exists(spark, f"{out}/compacted/{n}/_SUCCESS")]
    return max(done, default=-1)


def _stored(spark: SparkSession, out: str, key: str) -> DataFrame:
    """The compacted sums and those of the batches behind them."""
    upto = _compacted(spark, out)
    new = [n for n in children(spark, f"{out}/batches") if int(n.removeprefix("batch=")) > upto]
    folders = [f"{out}/batches/{n}" for n in new] + ([f"{out}/compacted/upto={upto}"] if upto >= 0 else [])
    return spark.read.schema(SUM_SCHEMAS[key]).parquet(*folders) if folders else spark.createDataFrame([], SUM_SCHEMAS[key])


def compact(spark: SparkSession, out: str, key: str, number: int) -> None:
    """Add all batches up to ``number``, the last one, up into one folder, so that reading does not grow with the life of
    the stream. For use between runs. The new sums count from the moment they are complete; what they hold goes after
    that, and a folder that a crash leaves behind is not read any more."""
    upto = _compacted(spark, out)
    if number <= upto:
        return
    batches = [n for n in children(spark, f"{out}/batches") if int(n.removeprefix("batch=")) <= number]
    _added(_stored(spark, out, key), key).write.mode("overwrite").parquet(f"{out}/compacted/upto={number}")
    for n in batches:
        discard(spark, f"{out}/batches/{n}")
    if upto >= 0:
        discard(spark, f"{out}/compacted/upto={upto}")


def totals(spark: SparkSession, out: str, key: str) -> DataFrame:
    """The sums over all batches; a key that nothing counts for any more has none."""
    counted = {"CustomerID": "NewOrders", "City": "TotalOrders"}[key]
    return _added(_stored(spark, out, key), key).where(F.col(counted) != 0)


def city_kpis(spark: SparkSession, out: str) -> DataFrame:
    return totals(spark, out, "City").select(
        "City", "TotalOrders", F.col("Revenue").cast("double").alias("TotalRevenue"), F.try_divide(F.col("Minutes"), F.col("Timed")).alias("AvgDeliveryTime"))


def current_totals(customers: DataFrame, counts: DataFrame) -> DataFrame:
    """The stored customer totals plus what the stream has counted."""
    c = customers.select("CustomerID", "TotalOrders").join(counts, "CustomerID", "left")
    return c.select("CustomerID", (F.col("TotalOrders") + F.coalesce("NewOrders", F.lit(0))).alias("TotalOrders"))
