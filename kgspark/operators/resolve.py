"""Identifier resolution: alias map, fan-out, unresolved rows, the fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kgspark.errors import IngestError
from kgspark.functions.text import base_accession, blank_to_null, trim_blanks


def alias_map(
    df: DataFrame, id_col: str = "id", symbol_col: str = "symbol", aliases_col: str = "aliases", sep: str = "|"
) -> DataFrame:
    """Distinct ``alias, id`` pairs of a dictionary with delimited alias lists."""
    alias = F.explode(F.split(F.coalesce(F.col(aliases_col), F.lit("")), F.concat(F.lit("\\Q"), F.lit(sep), F.lit("\\E"))))
    key = F.col(id_col)
    if dict(df.dtypes)[id_col] == "string":
        key = blank_to_null(key)
    return (
        df.select(key.alias("id"), alias.alias("alias"))
        .select(blank_to_null(F.col("alias")).alias("alias"), "id")
        .filter(F.col("alias").isNotNull() & F.col("id").isNotNull())
        .distinct()
    )


def symbol_table(
    df: DataFrame, id_col: str = "id", symbol_col: str = "symbol", order_col: str | None = None
) -> DataFrame:
    """One symbol per id: the one with the greatest ``order_col``, else the greatest symbol."""
    symbol = trim_blanks(F.coalesce(F.col(symbol_col), F.lit("")))
    order = F.col(order_col) if order_col else symbol
    return df.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.max_by(symbol, order).alias("symbol")
    )


def collapse(raw: DataFrame) -> DataFrame:
    """Source rows folded to ``accession, pathway, code, rows`` before any join.

    The fold combines on the map side, so a key that holds a third of all rows
    reaches the shuffle as one row per task. Everything below starts from it.
    """
    return raw.groupBy("accession", "pathway", "code").agg(F.count(F.lit(1)).alias("rows"))


def resolve(collapsed: DataFrame, aliases: DataFrame) -> DataFrame:
    """Distinct facts ``gene, pathway, code, accession``; several matches fan out.

    Both sides are distinct, so the join's rows are too and no second
    ``distinct`` is needed. The full accession stays on the fact.
    """
    keyed = collapsed.select("accession", "pathway", "code", base_accession(F.col("accession")).alias("alias"))
    return keyed.join(aliases, "alias").select(F.col("id").alias("gene"), "pathway", "code", "accession")


def match_counts(aliases: DataFrame) -> DataFrame:
    """Number of ids per alias."""
    return aliases.groupBy("alias").agg(F.count(F.lit(1)).alias("matches"))


def with_matches(collapsed: DataFrame, aliases: DataFrame) -> DataFrame:
    """Folded rows with their number of matches, 0 when unresolved."""
    return (
        collapsed.withColumn("alias", base_accession(F.col("accession")))
        .join(match_counts(aliases), "alias", "left")
        .withColumn("matches", F.coalesce(F.col("matches"), F.lit(0).cast("bigint")))
    )


def fanout_rows(collapsed: DataFrame, aliases: DataFrame) -> DataFrame:
    """Source rows by number of matches: ``matches, rows``."""
    return with_matches(collapsed, aliases).groupBy("matches").agg(F.sum("rows").alias("rows"))


def unresolved(collapsed: DataFrame, aliases: DataFrame) -> DataFrame:
    """Per full accession without a match: rows, an example pathway and its code.

    The example is the smallest pathway (and the smallest code on it).
    """
    return (
        collapsed.withColumn("alias", base_accession(F.col("accession")))
        .join(aliases.select("alias").distinct(), "alias", "left_anti")
        .groupBy("accession")
        .agg(
            F.sum("rows").alias("rows"),
            F.min(F.struct("pathway", "code")).alias("example"),
        )
        .select(
            "accession", "rows",
            F.col("example.pathway").alias("example_pathway"),
            F.col("example.code").alias("evidence"),
        )
    )


def unresolved_fraction(collapsed: DataFrame, aliases: DataFrame, off_scope_rows: int = 0) -> DataFrame:
    """``rows_in_scope, unresolved_rows, fraction``.

    ``rows_in_scope`` also counts rows whose pathway is off scope, which never
    reach resolution: pass their number.
    """
    totals = with_matches(collapsed, aliases).agg(
        (F.coalesce(F.sum("rows"), F.lit(0)) + F.lit(off_scope_rows)).cast("bigint").alias("rows_in_scope"),
        F.coalesce(F.sum(F.when(F.col("matches") == 0, F.col("rows"))), F.lit(0)).cast("bigint").alias("unresolved_rows"),
    )
    return totals.withColumn(
        "fraction", F.try_divide(F.col("unresolved_rows").cast("double"), F.col("rows_in_scope"))
    )


def require_resolved(fraction: DataFrame, limit: float = 0.10) -> float:
    """Raise when no row is in scope or too many rows are unresolved."""
    row = fraction.collect()[0]
    if row["rows_in_scope"] == 0:
        raise IngestError("no rows in scope")
    if row["fraction"] > limit:
        raise IngestError(f"{row['fraction']:.2%} of rows are unresolved, limit {limit:.2%}")
    return row["fraction"]


def evidence_rows(collapsed: DataFrame) -> DataFrame:
    """Source rows per code, before resolution."""
    return collapsed.groupBy("code").agg(F.sum("rows").alias("rows"))


def participation_edges(facts: DataFrame) -> DataFrame:
    """Distinct ``gene, pathway`` pairs of the facts."""
    return facts.select("gene", "pathway").distinct()
