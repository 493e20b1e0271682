"""A release from the one before it: what came and went, as signed rows, moves the stored measures.

Sizes, degrees, tallies, overlaps and fingerprints of sets are sums or xors, so a difference of facts moves them by its
own rows; the facts themselves are only scanned, and only those of pairs and genes that the difference names are joined.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kgspark.operators import sets as S
from kgspark.operators.digests import table_difference
from kgspark.plans.release import Release
from kgspark.session import small_tasks, write_shared

FACT = ("gene", "pathway", "code", "accession")
#: Hash seeds of the fingerprints kept.
SEEDS = 2


@dataclass(frozen=True)
class Measures:
    """``sizes`` (pathway, genes, f0, f1: members and their fingerprints, sets with members only), ``degrees`` (gene,
    pathways), ``common`` (child, parent, common: members shared along a hierarchy edge, if any), ``evidence`` (code,
    facts)."""

    sizes: DataFrame
    degrees: DataFrame
    common: DataFrame
    evidence: DataFrame

    def stored(self) -> Measures:
        with small_tasks(self.sizes.sparkSession):
            return Measures(*[write_shared(df) for df in (self.sizes, self.degrees, self.common, self.evidence)])

    def contained(self, hierarchy: DataFrame) -> DataFrame:
        """:func:`kgspark.operators.sets.containment` of a hierarchy."""
        size = lambda name: self.sizes.select(F.col("pathway").alias(name), F.col("genes").alias(f"{name}_genes"))
        pairs = hierarchy.select("child", "parent").distinct().join(size("child"), "child").join(size("parent"), "parent")
        found = pairs.join(self.common, ["child", "parent"], "left").select(
            "child", "parent", "child_genes", F.coalesce("common", F.lit(0)).cast("bigint").alias("common")
        )
        return found.withColumn("fraction", F.col("common").cast("double") / F.col("child_genes"))


def measure(release: Release) -> Measures:
    """All measures of a release, from its tables."""
    prints = S.fingerprints(release.participation.select("pathway", "gene"), SEEDS)
    common = S.containment(release.hierarchy, release.participation, is_set=True)
    return Measures(
        prints, S.degree_of_genes(release.participation, is_set=True),
        common.filter("common > 0").select("child", "parent", "common"),
        release.facts.groupBy("code").agg(F.count(F.lit(1)).alias("facts")),
    )


def signed_facts(old: DataFrame, new: DataFrame) -> DataFrame:
    """Facts that came (``change`` > 0) and went (< 0)."""
    moved = table_difference(old.select(*FACT), new.select(*FACT), ["gene"])
    return moved.select(*FACT, (F.col("right_rows") - F.col("left_rows")).alias("change"))


def signed_edges(old: DataFrame, changes: DataFrame) -> DataFrame:
    """Edges ``gene, pathway`` that came with their first fact (``change`` 1) or went with their last (-1)."""
    moved = changes.groupBy("gene", "pathway").agg(F.sum("change").alias("change"))
    before = old.join(moved.select("gene", "pathway"), ["gene", "pathway"], "left_semi").groupBy("gene", "pathway").agg(
        F.count(F.lit(1)).alias("n")
    )
    had = F.coalesce("n", F.lit(0))
    sign = (had + F.col("change") > 0).cast("int") - (had > 0).cast("int")
    return moved.join(before, ["gene", "pathway"], "left").select("gene", "pathway", sign.alias("change")).filter("change <> 0")


def added(stored: DataFrame, changes: DataFrame, key: str, value: str) -> DataFrame:
    """Counts ``key, value`` after signed ``changes``; counts of zero go."""
    summed = stored.select(key, value).unionByName(changes.select(key, F.col("change").cast("bigint").alias(value)))
    return summed.groupBy(key).agg(F.sum(value).alias(value)).filter(F.col(value) > 0)


def moved_sizes(sizes: DataFrame, edges: DataFrame) -> DataFrame:
    """Sizes and fingerprints after signed edges: a member that comes or goes turns the same bits."""
    names = [f"f{seed}" for seed in range(SEEDS)]
    turned = edges.groupBy("pathway").agg(
        F.sum("change").alias("genes"), *[F.bit_xor(S.member_hash(seed)).alias(f"f{seed}") for seed in range(SEEDS)]
    )
    both = sizes.select("pathway", "genes", *names).unionByName(turned.select("pathway", F.col("genes").cast("bigint"), *names))
    return both.groupBy("pathway").agg(F.sum("genes").alias("genes"), *[F.bit_xor(n).alias(n) for n in names]).filter("genes > 0")


def moved_overlaps(pairs: DataFrame, members: DataFrame, edges: DataFrame) -> DataFrame:
    """``child, parent, change`` of the shared members of hierarchy ``pairs``; ``members`` are those before.

    Only members that came or went on either side of a pair count, each by what both sides hold before and after.
    """
    signed = edges.select("gene", "pathway", "change")
    touched = pairs.join(signed.select("gene", F.col("pathway").alias("child")), "child").unionByName(
        pairs.join(signed.select("gene", F.col("pathway").alias("parent")), "parent").select("child", "parent", "gene")
    ).distinct()
    ends = touched.select("gene", F.explode(F.array("child", "parent")).alias("pathway")).distinct()
    held = members.join(ends, ["gene", "pathway"], "left_semi").select("gene", "pathway", F.lit(1).alias("had"))
    known = held.join(signed, ["gene", "pathway"], "full_outer").select(
        "gene", "pathway", F.coalesce("had", F.lit(0)).alias("had"), (F.coalesce("had", F.lit(0)) + F.coalesce("change", F.lit(0))).alias("has")
    )
    side = lambda name: known.select("gene", F.col("pathway").alias(name), F.col("had").alias(f"{name}_had"), F.col("has").alias(f"{name}_has"))
    none = lambda c: F.coalesce(c, F.lit(0))
    change = none(F.col("child_has")) * none(F.col("parent_has")) - none(F.col("child_had")) * none(F.col("parent_had"))
    told = touched.join(side("child"), ["gene", "child"], "left").join(side("parent"), ["gene", "parent"], "left")
    return told.groupBy("child", "parent").agg(F.sum(change).alias("change")).filter("change <> 0")


def advance(measures: Measures, old: Release, new: Release) -> Measures:
    """Measures of ``new`` from those of ``old``. Hierarchy edges that are new are counted in full, lost ones go.

    Facts that came and went are found by digests; their tables and ``participation`` must be stored, as both are read
    more than once.
    """
    with small_tasks(old.facts.sparkSession, old.facts.count() + new.facts.count()):
        return _advanced(measures, old, new)


def _advanced(measures: Measures, old: Release, new: Release) -> Measures:
    changes = write_shared(signed_facts(old.facts, new.facts))
    edges = write_shared(signed_edges(old.facts, changes))
    before, after = (r.hierarchy.select("child", "parent").distinct() for r in (old, new))
    kept, fresh = after.join(before, ["child", "parent"], "left_semi"), after.join(before, ["child", "parent"], "left_anti")
    counted = S.containment(fresh, new.participation, is_set=True).filter("common > 0").select("child", "parent", "common")
    moved = moved_overlaps(kept, old.participation, edges)
    stayed = measures.common.join(kept, ["child", "parent"], "left_semi").unionByName(
        moved.select("child", "parent", F.col("change").cast("bigint").alias("common"))
    ).groupBy("child", "parent").agg(F.sum("common").alias("common")).filter("common > 0")
    return Measures(
        moved_sizes(measures.sizes, edges), added(measures.degrees, edges, "gene", "pathways"), stayed.unionByName(counted),
        added(measures.evidence, changes, "code", "facts"),
    ).stored()
