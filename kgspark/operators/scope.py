"""Scope filters: by name, by membership, by in-scope id."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from kgspark.errors import ScopeError, UnknownCodeError
from kgspark.functions.text import trim_blanks
from kgspark.session import any_row, sample_text


def unknown_names(df: DataFrame, column: str, vocabulary: Iterable[str]) -> DataFrame:
    """Names that are not in the vocabulary, with their row counts."""
    name = trim_blanks(F.col(column))
    return (
        df.groupBy(name.alias("name"))
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter(F.col("name").isNull() | ~F.col("name").isin(*vocabulary))
    )


def scope_filter(
    df: DataFrame, column: str, keep: str, vocabulary: Iterable[str], strict: bool = False
) -> DataFrame:
    """Rows whose trimmed name equals ``keep``.

    ``strict`` first checks every name, dropped ones included: a scope that was
    renamed at the source would otherwise just lose its rows. To check in the
    same pass as the work, use :func:`watch_names`.
    """
    vocabulary = list(vocabulary)
    if keep not in vocabulary:
        raise UnknownCodeError(f"{keep!r} is not in the vocabulary")
    if strict:
        unknown = unknown_names(df, column, vocabulary)
        if any_row(unknown):
            raise UnknownCodeError(f"unknown names in {column}: {sample_text(unknown, 'name')}")
    return df.filter(trim_blanks(F.col(column)) == keep)


def watch_names(
    df: DataFrame, column: str, vocabulary: Iterable[str]
) -> tuple[DataFrame, Callable[[], None]]:
    """``df`` under observation, and a call that raises if it held an unknown name.

    The names are counted while the first action on the result runs, so the
    source is not read a second time. Make the call after that action.
    """
    name = trim_blanks(F.col(column))
    odd = name.isNull() | ~name.isin(*vocabulary)
    seen = Observation()
    watched = df.observe(
        seen, F.count_if(odd).alias("unknown"), F.min(F.when(odd, F.coalesce(name, F.lit("NULL")))).alias("first")
    )

    def verify() -> None:
        try:
            unknown, first = seen.get["unknown"], seen.get["first"]
        except Py4JJavaError:
            # Folded away as empty before it ran, so nothing was observed.
            rest = unknown_names(df, column, vocabulary).agg(F.sum("rows"), F.min(F.coalesce("name", F.lit("NULL"))))
            unknown, first = rest.collect()[0]
        if unknown:
            raise UnknownCodeError(f"{unknown} rows with unknown names in {column}, first {first!r}")

    return watched, verify


def scope_tally(df: DataFrame, column: str, keep: str) -> DataFrame:
    """Rows kept and dropped per name: ``name, rows, kept``."""
    name = trim_blanks(F.col(column))
    return df.groupBy(name.alias("name")).agg(F.count(F.lit(1)).alias("rows")).withColumn(
        "kept", F.coalesce(F.col("name") == keep, F.lit(False))
    )


def top_dropped(tally: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` most frequent dropped names of a tally."""
    return tally.filter(~F.col("kept")).select("name", "rows").orderBy(F.desc("rows"), "name").limit(n)


def classify_edges(
    edges: DataFrame, ids: DataFrame, child: str = "child", parent: str = "parent", id_col: str = "id"
) -> DataFrame:
    """Add ``scope``: ``kept`` (both ends in scope), ``mixed`` (one) or ``dropped`` (none)."""
    known = ids.select(F.col(id_col)).distinct()
    child_ids = known.select(F.col(id_col).alias(child), F.lit(1).alias("_child_in"))
    parent_ids = known.select(F.col(id_col).alias(parent), F.lit(1).alias("_parent_in"))
    ends = F.coalesce(F.col("_child_in"), F.lit(0)) + F.coalesce(F.col("_parent_in"), F.lit(0))
    return (
        edges.join(child_ids, child, "left")
        .join(parent_ids, parent, "left")
        .withColumn("scope", F.when(ends == 2, "kept").when(ends == 1, "mixed").otherwise("dropped"))
        .drop("_child_in", "_parent_in")
    )


def scope_edges(
    edges: DataFrame, ids: DataFrame, child: str = "child", parent: str = "parent", id_col: str = "id"
) -> DataFrame:
    """Edges with both ends in scope; an edge with one end in scope is an error."""
    classed = classify_edges(edges, ids, child, parent, id_col)
    mixed = classed.filter(F.col("scope") == "mixed")
    if any_row(mixed):
        named = mixed.select(F.concat_ws(" -> ", F.col(child), F.col(parent)).alias("edge"))
        raise ScopeError(f"edges cross the scope boundary: {sample_text(named, 'edge')}")
    return classed.filter(F.col("scope") == "kept").drop("scope")


def scope_edge_tally(classed: DataFrame) -> DataFrame:
    """Edge counts per scope class; a mixed edge also counts as dropped by the caller."""
    return classed.groupBy("scope").agg(F.count(F.lit(1)).alias("edges"))


def in_scope(df: DataFrame, column: str, ids: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows whose ``column`` is an in-scope id."""
    return df.join(ids.select(F.col(id_col).alias(column)), column, "left_semi")


def off_scope(df: DataFrame, column: str, ids: DataFrame, id_col: str = "id") -> DataFrame:
    """Rows whose ``column`` is no in-scope id."""
    return df.join(ids.select(F.col(id_col).alias(column)), column, "left_anti")
