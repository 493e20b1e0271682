"""Snapshot publication: data first, marker last, nothing published twice."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kgspark.errors import PublishError
from kgspark.functions.text import PORTAL_PATTERN, RELEASE_TAG_PATTERN, SNAPSHOT_PATTERN, length_prefixed, md5_number
from kgspark.session import literal_table, remove_shared, write_shared
from kgspark.sources.loads import path_exists, remove

MARKER = "_manifest"
MARKER_SCHEMA = "portal STRING, snapshot STRING, rows BIGINT, folded STRING, mixed BIGINT"


def snapshot_fingerprint(df: DataFrame) -> DataFrame:
    """One row identifying a table's content whatever its row order: ``rows, folded, mixed``.

    Two folds of a row hash, sum and xor, combine on the map side.
    """
    row = md5_number(length_prefixed(*[F.col(c) for c in sorted(df.columns)]))
    return df.select(row.alias("h")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(F.col("h").cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)").cast("string").alias("folded"),
        F.coalesce(F.bit_xor("h"), F.lit(0)).cast("bigint").alias("mixed"),
    )


def snapshot_path(root: str, portal: str, snapshot: str) -> str:
    """Folder of a snapshot; keys that readers would not accept are errors."""
    if not re.search(PORTAL_PATTERN, portal):
        raise PublishError(f"invalid portal {portal!r}")
    if not re.fullmatch(SNAPSHOT_PATTERN.strip("^$"), snapshot, re.ASCII):
        if re.search(RELEASE_TAG_PATTERN, snapshot):
            raise PublishError(f"{snapshot!r} is a release tag; publish under a date")
        raise PublishError(f"snapshot {snapshot!r} is not YYYY-MM-DD")
    return f"{root.rstrip('/')}/{portal}/{snapshot}"


def publish_snapshot(df: DataFrame, root: str, portal: str, snapshot: str, allow_existing: bool = False) -> str:
    """Write a snapshot and, as the very last step, its marker.

    A target with content is refused unless allowed; content equal to what is
    already published there is always refused, since a reader would skip it.
    The input is evaluated once, into the checkpoint folder: what is compared,
    written and marked are the same rows, even if the input is not stable.
    """
    spark = df.sparkSession
    target = snapshot_path(root, portal, snapshot)
    if path_exists(spark, target) and not allow_existing:
        raise PublishError(f"{target} is not empty")
    df = write_shared(df)
    mark = snapshot_fingerprint(df).collect()[0]
    marker_path = f"{target}/{MARKER}"
    if path_exists(spark, marker_path):
        old = spark.read.schema(MARKER_SCHEMA).json(marker_path).collect()
        if old and (old[0]["rows"], old[0]["folded"], old[0]["mixed"]) == (mark["rows"], mark["folded"], mark["mixed"]):
            raise PublishError(f"{target} already holds identical content")
    if mark["rows"] == 0:
        raise PublishError("nothing to publish")
    remove(spark, marker_path)
    df.write.mode("overwrite").parquet(f"{target}/data")
    literal_table(
        spark, [(portal, snapshot, mark["rows"], mark["folded"], mark["mixed"])], MARKER_SCHEMA
    ).coalesce(1).write.mode("overwrite").json(marker_path)
    remove_shared(df)
    return target


def list_published(spark: SparkSession, root: str) -> DataFrame:
    """``portal, snapshot, rows`` of the marked snapshots; unmarked folders are not listed."""
    markers = f"{root.rstrip('/')}/*/*/{MARKER}"
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(markers)
    found = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(where)
    if found is None or len(found) == 0:
        return literal_table(spark, [], MARKER_SCHEMA).select("portal", "snapshot", "rows")
    return spark.read.schema(MARKER_SCHEMA).json(markers).select("portal", "snapshot", "rows")


def read_snapshot(spark: SparkSession, root: str, portal: str, snapshot: str) -> DataFrame:
    """A published snapshot; one without its marker is not there yet."""
    target = snapshot_path(root, portal, snapshot)
    if not path_exists(spark, f"{target}/{MARKER}"):
        raise PublishError(f"{target} is not published")
    return spark.read.parquet(f"{target}/data")
