"""Associations with evidence compared with the plain edges derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


#: Seeds and bits of the hashes in digests of pairs: sums of 30 bits hold for 2^33 associations.
DIGESTS, BITS = 4, 30
SUPPORT = "associations"


def supported_edges(associations: DataFrame) -> DataFrame:
    """Distinct edges ``gene, pathway`` with the number of their ``associations``."""
    return associations.groupBy("gene", "pathway").agg(F.count(F.lit(1)).alias(SUPPORT))


def _pair_digest(rows: DataFrame, weight: Column) -> list[int | None]:
    """Rows, sum and least of their weights, and weighted sums of pair hashes; nothing is shuffled but one row per task."""
    pair = [x for c in ("gene", "pathway") for x in (F.col(c), F.col(c).isNull())]
    marks = [F.xxhash64(F.lit(seed), *pair).bitwiseAND(F.lit((1 << BITS) - 1)) for seed in range(DIGESTS)]
    found = rows.agg(F.count(F.lit(1)), F.min(weight), F.sum(weight), *[F.sum(weight * mark) for mark in marks]).first()
    return list(found)


def pair_counts(associations: DataFrame, edges: DataFrame) -> DataFrame:
    """Per pair: number of associations and of edges.

    Both tables are stacked and grouped once, so there is one shuffle and it
    combines on the map side.
    """
    marked = associations.select("gene", "pathway", F.lit(1).alias("a"), F.lit(0).alias("e")).unionByName(
        edges.select("gene", "pathway", F.lit(0).alias("a"), F.lit(1).alias("e"))
    )
    return marked.groupBy("gene", "pathway").agg(F.sum("a").alias("associations"), F.sum("e").alias("edges"))


def reconcile_shapes(associations: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: edges, pairs, unsupported (edge without association), unreachable (the reverse)."""
    return pair_counts(associations, edges).agg(
        F.coalesce(F.sum("edges"), F.lit(0)).cast("bigint").alias("edges"),
        F.count(F.lit(1)).alias("pairs"),
        F.count_if(F.col("associations") == 0).alias("unsupported"),
        F.count_if(F.col("edges") == 0).alias("unreachable"),
    )


def shape_agreement(associations: DataFrame, edges: DataFrame) -> DataFrame:
    """One row: distinct edges, distinct pairs, equal or not, associations per edge.

    Edges of :func:`supported_edges` say how many associations they stand for. If the pairs of the associations, repeats
    included, have the digest of the edges so often, they are the same pairs and the number of edges is all there is to
    count; two different tables pass with a probability of about 2^-120. All else is grouped by pair.
    """
    if SUPPORT in edges.columns:
        _, _, *pairs = _pair_digest(associations, F.lit(1).cast("bigint"))
        rows, least, *claimed = _pair_digest(edges, F.col(SUPPORT))
        if rows and least is not None and least > 0 and pairs == claimed:
            per_edge = F.round(F.lit(pairs[0]) / F.lit(rows), 3)
            return edges.sparkSession.range(1).select(
                F.lit(rows).cast("bigint").alias("edges"), F.lit(rows).cast("bigint").alias("association_pairs"),
                F.lit(pairs[0]).cast("bigint").alias("associations"), F.lit(True).alias("matches"),
                per_edge.alias("associations_per_edge"),
            )
    counts = pair_counts(associations, edges).agg(
        F.count_if(F.col("edges") > 0).alias("edges"),
        F.count_if(F.col("associations") > 0).alias("association_pairs"),
        F.count_if((F.col("edges") > 0) != (F.col("associations") > 0)).alias("differing"),
        F.coalesce(F.sum("associations"), F.lit(0)).cast("bigint").alias("associations"),
    )
    return counts.select(
        "edges", "association_pairs", "associations",
        (F.col("differing") == 0).alias("matches"),
        F.round(F.col("associations") / F.greatest("edges", F.lit(1)), 3).alias("associations_per_edge"),
    )


def pair_evidence_profile(facts: DataFrame, curated: str, inferred: str) -> DataFrame:
    """Pairs by their evidence: ``curated_only``, ``inferred_only``, ``both`` or ``other``."""
    code = F.col("code")
    pairs = facts.groupBy("gene", "pathway").agg(
        F.bool_or(F.coalesce(code == curated, F.lit(False))).alias("has_curated"),
        F.bool_or(F.coalesce(code == inferred, F.lit(False))).alias("has_inferred"),
    )
    profile = (
        F.when(F.col("has_curated") & F.col("has_inferred"), "both")
        .when(F.col("has_curated"), "curated_only")
        .when(F.col("has_inferred"), "inferred_only")
        .otherwise("other")
    )
    return pairs.groupBy(profile.alias("profile")).agg(F.count(F.lit(1)).alias("pairs"))
