"""Session settings and the one place where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join partition even where that costs one more exchange later
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

FIRST_PARTS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
PART_ROWS = 100_000
CODEC = "spark.sql.parquet.compression.codec"
DENSE = "zstd"

_local_scratch: dict[str, str] = {}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by the cluster; a temporary one only in local mode."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="orderlens-")
    return _local_scratch[app]


def new_folder(spark: SparkSession) -> str:
    return f"{scratch_dir(spark)}/orderlens/{uuid.uuid4().hex}"


@contextmanager
def parts_for(spark: SparkSession, rows: int) -> Iterator[None]:
    """Exchanges in parts of at most ``PART_ROWS`` wide rows, so that sorting one needs no disk; small ones are joined again."""
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    before = spark.conf.get(FIRST_PARTS, None)
    if rows > least * PART_ROWS:
        spark.conf.set(FIRST_PARTS, str(-(-rows // PART_ROWS)))
    try:
        yield
    finally:
        spark.conf.unset(FIRST_PARTS) if before is None else spark.conf.set(FIRST_PARTS, before)


@contextmanager
def dense(spark: SparkSession) -> Iterator[None]:
    """Tables are stored in two thirds of the bytes: for wide ones, written once. Around all threads of a job, not inside one."""
    before = spark.conf.get(CODEC, None)
    spark.conf.set(CODEC, DENSE)
    try:
        yield
    finally:
        spark.conf.unset(CODEC) if before is None else spark.conf.set(CODEC, before)


def cut_lineage(spark: SparkSession) -> None:
    """A folder for checkpoints, where none is set: without one every boosting round sends all rounds before it along."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = new_folder(spark)
        delete_at_end(spark, folder)
        sc.setCheckpointDir(folder)


def side_by_side(spark: SparkSession, work: Callable, items: Iterable) -> list:
    """What the work returns for each item, as many at once as the cluster has cores."""
    with ThreadPoolExecutor(max(1, spark.sparkContext.defaultParallelism)) as pool:
        return list(pool.map(inheritable_thread_target(spark)(work), items))


def materialise(df: DataFrame, path: str | None = None, codec: str | None = None) -> DataFrame:
    """Write once to the shared folder and read back, so that every later use
    sees the same rows and a lost executor costs only one re-read. The folder
    goes when the application ends."""
    spark = df.sparkSession
    path = path or new_folder(spark)
    delete_at_end(spark, path)
    (df.write.option("compression", codec) if codec else df.write).parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    return stored


def release(*stored: DataFrame) -> None:
    """Remove the folders of materialised tables that nothing reads any more."""
    for df in stored:
        discard(df.sparkSession, df.stored_at)


def delete_at_end(spark: SparkSession, path: str) -> None:
    """Remove a folder when the application ends."""
    _file_system(spark, path).deleteOnExit(_path(spark, path))


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder that nothing reads any more."""
    _file_system(spark, path).delete(_path(spark, path), True)


def exists(spark: SparkSession, path: str) -> bool:
    return _file_system(spark, path).exists(_path(spark, path))


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, there at once or not at all."""
    _file_system(spark, path).createNewFile(_path(spark, path))


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder; none where it is not there."""
    return sorted(f.getPath().getName() for f in _file_system(spark, path).listStatus(_path(spark, path))) if exists(spark, path) else []


def input_version(spark: SparkSession, folder: str) -> str:
    """Changes when a file or folder directly below does: names, lengths and times of change."""
    found = _file_system(spark, folder).listStatus(_path(spark, folder))
    return "|".join(sorted(f"{f.getPath().getName()},{f.getLen()},{f.getModificationTime()}" for f in found))


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
