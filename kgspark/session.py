"""Helpers around the session: checkpoint folder, loop rounds, small tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from kgspark.errors import IngestError

CHECKPOINT_SETTING = "spark.checkpoint.dir"
CLEANUP_SETTING = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Sizes of tasks over tables of keys: a megabyte of these holds a hundred thousand rows, and a row in a sort or a hash map takes
#: ten times what it takes in a file.
SMALL_TASKS = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m", "spark.sql.files.maxPartitionBytes": "16m"}
PARTITIONS_SETTING = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
#: Rows of a table that one task is to hold, where their number is known.
ROWS_A_TASK = 500_000
GROUPS_SETTING = "spark.sql.objectHashAggregate.sortBased.fallbackThreshold"
#: Groups of gathered lists that one task may hold before it sorts.
GROUPS_A_TASK = 100_000


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, taking it from the session's own setting.

    Only a local master may fall back to a temporary folder: on a cluster that
    folder would live on one machine and be lost with it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(CHECKPOINT_SETTING, None)
    if not configured:
        if not sc.master.startswith("local"):
            raise IngestError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="spark-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def materialise(df: DataFrame, path: str | None = None) -> tuple[DataFrame, int]:
    """Write ``df`` as a table in the checkpoint folder; return it, as read back, with its row count.

    The count is observed while the table is written, so the plan runs once.
    """
    seen = Observation()
    stored = write_shared(df.observe(seen, F.count(F.lit(1)).alias("rows")), path)
    rows = observed(seen, "rows")
    return stored, stored.count() if rows is None else int(rows)


def observed(seen: Observation, name: str):
    """A metric of an observation whose action is done; None if nothing was observed.

    A plan that is folded away as empty is never observed, but that is not the only reason for a missing metric: the
    caller looks at its stored rows instead of guessing.
    """
    try:
        return seen.get[name]
    except Py4JJavaError:
        return None


def shared_folder(spark: SparkSession) -> str:
    """A folder of its own in the checkpoint folder, not made yet."""
    return f"{ensure_checkpoint_dir(spark)}/{uuid.uuid4().hex}"


def write_shared(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the checkpoint folder and read it back.

    For a wide table that several later plans read: readers take only their
    columns, and the optimizer knows its true size.
    """
    path = path or shared_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def _settings(spark: SparkSession, wanted: dict[str, str]) -> Iterator[None]:
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


@contextmanager
def small_tasks(spark: SparkSession, rows: int = 0) -> Iterator[None]:
    """Within it, tasks of a query are dealt for tables of keys, which are small in files and large in memory.

    Spark puts partitions together up to a size in bytes as shuffled, so the memory of a task would grow with the table
    until 64 compressed MB are reached. ``rows`` of the largest table, if known, give the number of partitions to begin
    with, so that a task's share does not grow with the table under any setting of the session.
    """
    wanted = dict(SMALL_TASKS)
    parts = rows // ROWS_A_TASK + 1
    if parts > int(spark.conf.get("spark.sql.shuffle.partitions")):
        wanted[PARTITIONS_SETTING] = str(parts)
    with _settings(spark, wanted):
        yield


@contextmanager
def gathering(spark: SparkSession) -> Iterator[None]:
    """Within it, small lists are gathered in memory: Spark would sort after 128 groups in a task."""
    with _settings(spark, {GROUPS_SETTING: str(GROUPS_A_TASK)}):
        yield


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Within it, a query's shuffle files go when the query ends, not when the driver happens to collect its garbage.

    For jobs of many stored steps, whose shuffles would otherwise lie on the disks together.
    """
    with _settings(spark, {CLEANUP_SETTING: "true"}):
        yield


def folder_exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def remove_folder(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def remove_shared(stored: DataFrame) -> None:
    """Remove the folders of tables of :func:`write_shared` once nothing reads them any more."""
    spark = stored.sparkSession
    base = ensure_checkpoint_dir(spark)
    for folder in {f.rsplit("/", 1)[0] for f in stored.inputFiles()}:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        if where.getParent().toUri().getPath() == spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base).toUri().getPath():
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def literal_table(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """A table of rows given by the caller, for use as a join side."""
    return spark.createDataFrame(list(rows), schema)


def any_row(df: DataFrame) -> bool:
    """True when ``df`` has a row; stops at the first one found."""
    return not df.isEmpty()


def sample_text(df: DataFrame, column: str, n: int = 3) -> str:
    """The ``n`` smallest values of a column, for an error message."""
    rows = df.select(F.col(column).cast("string").alias("v")).distinct().orderBy("v").limit(n)
    return ", ".join(str(r["v"]) for r in rows.collect())
