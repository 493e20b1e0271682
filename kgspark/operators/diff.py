"""Release to release: retired, added and relabelled nodes, successors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def label_conflicts(nodes: DataFrame, id_col: str = "id", label_col: str = "label") -> DataFrame:
    """Ids with more than one label: ``id, labels, first_label, last_label``."""
    label = F.col(label_col)
    return (
        nodes.groupBy(F.col(id_col).alias("id"))
        .agg(
            F.countDistinct(label).alias("labels"),
            F.min(label).alias("first_label"),
            F.max(label).alias("last_label"),
        )
        .filter(F.col("labels") > 1)
    )


def release_diff(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Changed nodes: ``id, previous_label, current_label, change``.

    Both releases go through one grouped union. An id listed twice in a release
    takes its greatest label.
    """
    old = previous.select("id", F.col("label").alias("old"), F.lit(None).cast("string").alias("new"),
                          F.lit(True).alias("in_old"), F.lit(False).alias("in_new"))
    new = current.select("id", F.lit(None).cast("string").alias("old"), F.col("label").alias("new"),
                         F.lit(False).alias("in_old"), F.lit(True).alias("in_new"))
    merged = old.unionByName(new).groupBy("id").agg(
        F.max("old").alias("previous_label"),
        F.max("new").alias("current_label"),
        F.bool_or("in_old").alias("was"),
        F.bool_or("in_new").alias("is"),
    )
    change = (
        F.when(~F.col("is"), "retired")
        .when(~F.col("was"), "added")
        .when(~F.col("previous_label").eqNullSafe(F.col("current_label")), "relabelled")
    )
    return merged.withColumn("change", change).filter(F.col("change").isNotNull()).select(
        "id", "previous_label", "current_label", "change"
    )


def diff_counts(diff: DataFrame) -> DataFrame:
    """Nodes per kind of change."""
    return diff.groupBy("change").agg(F.count(F.lit(1)).alias("nodes"))


def successors(diff: DataFrame) -> DataFrame:
    """Retired nodes whose exact label an added node carries: ``id, label, replaced_by``.

    A heuristic for callers who ask for it. Ties go to the greatest id.
    """
    by_label = (
        diff.filter(F.col("change") == "added")
        .groupBy(F.col("current_label").alias("label"))
        .agg(F.max("id").alias("replaced_by"))
    )
    return (
        diff.filter(F.col("change") == "retired")
        .select("id", F.col("previous_label").alias("label"))
        .join(by_label, "label")
        .select("id", "label", "replaced_by")
    )


def retired_rows(diff: DataFrame, previous: str, current: str, infer_successors: bool = False) -> DataFrame:
    """History rows of the retired nodes: ``id, label, last_seen, retired_in, replaced_by``."""
    gone = diff.filter(F.col("change") == "retired").select(
        "id", F.col("previous_label").alias("label"),
        F.lit(release_name(previous)).alias("last_seen"),
        F.lit(release_name(current)).alias("retired_in"),
    )
    if infer_successors:
        return gone.join(successors(diff).select("id", "replaced_by"), "id", "left")
    return gone.withColumn("replaced_by", F.lit(None).cast(dict(gone.dtypes)["id"]))


def release_name(version: str) -> str:
    """``97``, ``v97`` and ``V97`` all name release ``V97``."""
    return "V" + version.lstrip("vV")
