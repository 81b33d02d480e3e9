"""Intermediate results written to the shared checkpoint folder.

A staged frame is read back from files, so its lineage ends there: several consumers do not
recompute it, and a lost executor costs only the tasks it was running. Everything an application
stages lies under one folder, which ``release`` removes; ``scope`` does so for one job, ``discard`` for
one frame.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

TASK_ROWS = 1_000_000  # rows of a daily table that one task sorts, at some 400 bytes a row
FIRST_PARTITIONS = 1_000  # of a shuffle under ``fine``, before adaptive execution merges them
PARTITION_SIZE = "12m"  # what it merges them to: at 11 to 13 bytes a row of a daily panel, about TASK_ROWS
PAGE_ROWS = 200_000  # most rows of a page in a compact file; the default of 20,000 ends most of them early
_SETTING = "spark.checkpoint.dir"
# removes the shuffle files of a query when it ends; otherwise they stay until the driver's next collection
# of garbage, which may be hours away
_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# false: a join reads tables in buckets by some of its keys as they lie, without dealing them by all keys
_ALL_JOIN_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"
_PARTITIONS = "spark.sql.shuffle.partitions"
_FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_PARTITION_SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_scope: ContextVar[str] = ContextVar("scope", default="shared")
_tables: dict[str, list[str]] = {}  # catalog entries of bucketed stages, by scope
_folders: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()  # where staged frames lie


def staging_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster or set as checkpoint folder."""
    root = spark.conf.get(_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise RuntimeError(f"set {_SETTING} to a folder that all executors share")
    return root


def run_folder(spark: SparkSession) -> str:
    """Folder of everything that this application stages."""
    return f"{staging_root(spark)}/factorspark/{spark.sparkContext.applicationId}"


def tasks_for(rows: int, at_least: int) -> int:
    """Tasks or buckets for so many rows, so that the part of one does not grow with the table."""
    return max(at_least, -(-rows // TASK_ROWS))


def stage(df: DataFrame, name: str, small: bool = False) -> DataFrame:
    """Write ``df`` to a new folder, ``small`` as ``compact`` says, and return it as read from there."""
    return _written(df, _new_folder(df.sparkSession, name), small)


def stage_small(df: DataFrame, name: str) -> DataFrame:
    """``stage`` of a ``small`` file."""
    return stage(df, name, small=True)


def stage_alone(spark: SparkSession, plan: Callable[[], DataFrame], name: str, small: bool = False) -> DataFrame:
    """The frame that ``plan`` returns, staged. What ``plan`` stages on the way is removed once the frame
    is written."""
    path = _new_folder(spark, name)
    with scope(spark):
        return _written(plan(), path, small)


def discard(*staged: DataFrame) -> None:
    """Remove the files of staged frames that nothing reads any more; other frames are left alone."""
    for frame in staged:
        if path := _folders.pop(frame, None):
            _delete(frame.sparkSession, path)


def compact(df: DataFrame) -> dict[str, str]:
    """Write options by which tables of prices and signals take least disk: zstd over long pages, and no
    dictionary for doubles, of which few repeat."""
    doubles = [name for name, dtype in df.dtypes if dtype == "double"]
    options = {"compression": "zstd", "parquet.page.row.count.limit": str(PAGE_ROWS)}
    return options | {f"parquet.enable.dictionary#{name}": "false" for name in doubles}


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@contextmanager
def frugal(spark: SparkSession) -> Iterator[None]:
    """Queries begun inside leave no shuffle files behind, so that the disk holds those of one query at a
    time, and joins use the buckets of stored tables. A frame made inside is meant to be run once."""
    with _settings(spark, {_FREE_SHUFFLES: "true", _ALL_JOIN_KEYS: "false"}):
        yield


@contextmanager
def fine(spark: SparkSession) -> Iterator[None]:
    """Shuffles of queries begun inside have partitions that follow the bytes, not the session's number of
    partitions: with few of those a task of a large panel would spill more than the panel takes. Without
    adaptive execution the session's number holds."""
    first = max(int(spark.conf.get(_PARTITIONS)), FIRST_PARTITIONS)
    with _settings(spark, {_FIRST_PARTITIONS: str(first), _PARTITION_SIZE: PARTITION_SIZE}):
        yield


def _new_folder(spark: SparkSession, name: str) -> str:
    return f"{run_folder(spark)}/{_scope.get()}/{name}-{uuid.uuid4().hex}"


def _written(df: DataFrame, path: str, small: bool = False) -> DataFrame:
    df.write.options(**(compact(df) if small else {})).parquet(path)
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    _folders[found] = path
    return found


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def stage_bucketed(df: DataFrame, name: str, by: Sequence[str], buckets: int) -> DataFrame:
    """``stage`` in buckets by some columns, one file each. Windows and joins over these columns read the
    result without a shuffle. The layout is known through an entry of the catalog, which ``release``
    drops."""
    spark, scope_, number = df.sparkSession, _scope.get(), uuid.uuid4().hex
    table = f"{spark.catalog.currentDatabase()}.staged_{name}_{number}"
    dealt = df.repartition(buckets, *by)
    path = f"{run_folder(spark)}/{scope_}/{name}-{number}"
    dealt.write.format("parquet").bucketBy(buckets, *by).option("path", path).saveAsTable(table)
    _tables.setdefault(scope_, []).append(table)
    return spark.table(table)


def stage_observed(df: DataFrame, name: str, **figures) -> tuple[DataFrame, dict]:
    """``stage``, and aggregates of the rows, taken while they are written."""
    seen = Observation(name)
    staged = stage(df.observe(seen, *[column.alias(key) for key, column in figures.items()]), name)
    return staged, seen.get


def stage_counted(df: DataFrame, name: str) -> tuple[DataFrame, int]:
    """``stage``, and the number of rows, counted while they are written."""
    staged, seen = stage_observed(df, name, n=F.count("*"))
    return staged, seen["n"]


def release(spark: SparkSession, scope: str | None = None) -> None:
    """Remove what this application has staged, or one scope of it; frames read from there end."""
    for name in [scope] if scope else list(_tables):
        for table in _tables.pop(name, []):
            spark.sql(f"DROP TABLE IF EXISTS {table}")
    _delete(spark, run_folder(spark) + (f"/{scope}" if scope else ""))


@contextmanager
def scope(spark: SparkSession) -> Iterator[str]:
    """What is staged inside is removed at the end; only stored results may leave it."""
    name = f"run-{uuid.uuid4().hex}"
    token = _scope.set(name)
    try:
        yield name
    finally:
        _scope.reset(token)
        release(spark, name)
