"""Release diff as Markdown and as history."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kgspark.operators.diff import diff_counts, release_diff, release_name, retired_rows
from kgspark.session import literal_table
from kgspark.sources.releases import append_retired


def _lines(df: DataFrame, block: int, key: Column, line: Column) -> DataFrame:
    return df.select(F.lit(block).alias("block"), key.cast("string").alias("key"), line.alias("line"))


def diff_report(diff: DataFrame, previous: str, current: str, retired: DataFrame) -> DataFrame:
    """Markdown lines ``block, key, line``, to be written in that order.

    Every retired and every relabelled node has a line, so the report stays a table.
    """
    spark = diff.sparkSession
    head = [f"# {release_name(previous)} -> {release_name(current)} diff", ""]
    kinds = literal_table(spark, [("retired",), ("added",), ("relabelled",)], "change STRING")
    counts = kinds.join(diff_counts(diff), "change", "left").select(
        "change", F.coalesce("nodes", F.lit(0)).cast("string").alias("nodes")
    )
    def fixed(block: int, texts: list[str]) -> DataFrame:
        rows = [(block, f"{i:02d}", t) for i, t in enumerate(texts)]
        return literal_table(spark, rows, "block INT, key STRING, line STRING")

    code = lambda c: F.concat(F.lit("`"), F.col(c).cast("string"), F.lit("`"))
    row = lambda *cells: F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))
    renamed = diff.filter(F.col("change") == "relabelled")
    return reduce(DataFrame.unionByName, [
        fixed(0, head),
        _lines(counts, 1, F.col("change"), F.concat(F.lit("- "), F.col("change"), F.lit(": **"), F.col("nodes"), F.lit("**"))),
        fixed(2, ["", "## Retired", "", "| Id | Last label | Successor |", "|---|---|---|"]),
        _lines(retired, 3, F.col("id"), row(code("id"), F.col("label"), F.coalesce(code("replaced_by"), F.lit("--")))),
        fixed(4, ["", "## Relabelled", "", "| Id | Old label | New label |", "|---|---|---|"]),
        _lines(renamed, 5, F.col("id"), row(code("id"), F.col("previous_label"), F.col("current_label"))),
    ])


def write_report(lines: DataFrame, path: str) -> None:
    """Write report lines as text, in order."""
    lines.orderBy("block", "key").select("line").write.mode("overwrite").text(path)


def compare_releases(
    previous: DataFrame, current: DataFrame, previous_version: str, current_version: str,
    history: str, infer_successors: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Diff two releases, append the retired nodes to the history, return diff and report lines."""
    diff = release_diff(previous, current)
    retired = retired_rows(diff, previous_version, current_version, infer_successors)
    append_retired(retired, history)
    return diff, diff_report(diff, previous_version, current_version, retired)
