"""Characteristics of a release as one long table: ``section, metric, item, value, label``.

Long instead of nested, because some of its lists (roots, the largest identical
group) grow with the release and must not become one row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kgspark.operators import hierarchy as H
from kgspark.operators import sets as S
from kgspark.operators import stats as T
from kgspark.operators.shapes import shape_agreement
from kgspark.plans.incremental import Measures
from kgspark.plans.release import Release
from kgspark.session import write_shared

SPREAD = ("n", "mean", "min", "p25", "median", "p75", "p95", "max")


def _rows(
    df: DataFrame, section: str, metric: Column | str, item: Column | None, value: Column, label: Column | None = None
) -> DataFrame:
    name = F.lit(metric) if isinstance(metric, str) else metric
    item = F.lit("") if item is None else item
    label = F.lit("") if label is None else F.coalesce(label.cast("string"), F.lit(""))
    return df.select(
        F.lit(section).alias("section"), name.alias("metric"),
        item.cast("string").alias("item"), value.cast("double").alias("value"), label.alias("label"),
    )


def _named(few: DataFrame, key: str, names: DataFrame, name: str) -> DataFrame:
    """``few`` with the ``name`` of its ``key``; names are looked up for these rows only."""
    wanted = names.join(few.select(F.col(key).alias("id")).distinct(), "id", "left_semi")
    return few.join(wanted.groupBy(F.col("id").alias(key)).agg(F.max(name).alias("name")), key, "left")


def _wide(df: DataFrame, section: str, columns: Sequence[str]) -> DataFrame:
    """The columns of a one-row table as rows."""
    entries = F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in columns
    ])
    return _rows(df.select(F.inline(entries)), section, F.col("metric"), None, F.col("value"))


def _spread(df: DataFrame, name: Column) -> DataFrame:
    entries = F.array(*[
        F.struct(F.lit(c).alias("item"), F.col(c).cast("double").alias("value")) for c in SPREAD
    ])
    return _rows(
        df.select(name.alias("metric"), F.inline(entries)), "distribution", F.col("metric"), F.col("item"), F.col("value")
    )


def characteristics(
    release: Release, *, codes: Sequence[str], source: str, statements: DataFrame | None = None,
    band: tuple[int, int] = (15, 500), top: int = 20, classes: Mapping[str, str] | None = None,
    knowledge_sources: DataFrame | None = None, metadata: DataFrame | None = None,
    manifest: tuple[DataFrame, DataFrame] | None = None, measures: Measures | None = None,
) -> DataFrame:
    """The report. ``statements`` (part, statements) adds the emitted counts.

    ``knowledge_sources`` (source, n) are counts from the statements themselves;
    without them all facts count for ``source``. ``metadata`` (p, o) is what is
    stored about the release, ``manifest`` the header (key, value) and the files
    (filename, bytes) of its sources.

    ``measures`` are those of this release, as :func:`kgspark.plans.incremental.advance`
    keeps them from one release to the next; without them they are counted here.

    What several sections read (degrees, set sizes, overlaps, equal sets) is
    computed once and kept in the checkpoint folder; the sections themselves are
    small aggregates over those tables.
    """
    classes = classes or {"node": "Pathway", "gene": "Gene", "association": "GeneToPathwayAssociation"}
    node, members = release.node, release.participation
    count = F.count(F.lit(1))
    keep = write_shared

    depths = keep(H.depth(node, release.hierarchy))
    degree = keep(H.degrees(node, release.hierarchy))
    if measures is None:
        gene_degree = keep(S.degree_of_genes(members, is_set=True))
        # No set has more members than there are genes in sets.
        most = gene_degree.count()
        packed = S.packs(members, most, is_set=True)
        prints = keep(S.packed_fingerprints(packed))
        sizes = keep(S.with_empty_sets(node, prints))
        contained = keep(S.packed_containment(release.hierarchy, packed))
        grouped = S.identical_members(members, is_set=True, prints=prints, packed=packed)
        evidence = keep(T.evidence_mix(release.facts, codes))
    else:
        sizes = keep(S.with_empty_sets(node, measures.sizes))
        gene_degree = measures.degrees
        contained = keep(measures.contained(release.hierarchy))
        grouped = S.identical_members(members, is_set=True, prints=measures.sizes)
        evidence = measures.evidence.withColumn("mapped", T.is_mapped(codes))
    terms = keep(release.crosswalk.select("pathway", "term").distinct().groupBy("pathway").agg(count.alias("terms")))

    def measure(df: DataFrame, name: str, column: str) -> DataFrame:
        return df.select(F.lit(name).alias("measure"), F.col(column).cast("bigint").alias("value"))

    measures = reduce(DataFrame.unionByName, [
        measure(degree, "parents_per_pathway", "parents"),
        measure(degree, "children_per_pathway", "children"),
        measure(depths, "depth_below_root", "depth"),
        measure(sizes, "genes_per_pathway", "genes"),
        measure(gene_degree, "pathways_per_gene", "pathways"),
        measure(terms, "terms_per_pathway", "terms"),
    ])
    taxa = node.select("taxon").unionByName(release.gene.select("taxon")).groupBy("taxon").agg(count.alias("n"))
    facts_total = F.coalesce(F.sum("facts"), F.lit(0))
    symbols = release.gene.groupBy("id").agg(F.max(F.length(F.coalesce("symbol", F.lit("")))).alias("len")).agg(
        count.alias("genes"), F.count_if(F.col("len") > 0).alias("genes_with_symbol")
    )
    if knowledge_sources is None:
        knowledge_sources = evidence.agg(facts_total.alias("n")).select(F.lit(source).alias("source"), "n")
    roots = _named(degree.filter("parents = 0"), "id", node, "label")
    largest = _named(S.top_sets(sizes.filter("genes > 0"), top), "pathway", node, "label")
    hubs = _named(S.top_genes(gene_degree, top), "gene", release.gene, "symbol")
    equal = _named(S.largest_identical_group(grouped), "pathway", node, "label")
    totals = [
        _rows(evidence.agg(facts_total.alias("n")), "types", classes["association"], None, F.col("n")),
        _rows(node.agg(count.alias("n")), "types", classes["node"], None, F.col("n")),
        _rows(release.gene.agg(count.alias("n")), "types", classes["gene"], None, F.col("n")),
        _rows(taxa, "taxa", "nodes", F.col("taxon"), F.col("n")),
        _wide(symbols, "coverage", ["genes", "genes_with_symbol"]),
        _rows(gene_degree.agg(count.alias("n")), "coverage", "genes_in_association", None, F.col("n")),
        _rows(sizes.agg(count.alias("n")), "coverage", "pathways", None, F.col("n")),
        _rows(sizes.agg(F.count_if(F.col("genes") > 0).alias("n")), "coverage", "pathways_with_set", None, F.col("n")),
        _rows(terms.agg(count.alias("n")), "coverage", "pathways_with_term", None, F.col("n")),
        _wide(H.shape_of(degree), "hierarchy", ["part_of_edges", "roots", "leaves", "multi_parent"]),
        _rows(depths.agg(F.count_if(F.col("depth").isNull()).alias("n")), "hierarchy", "endless_nodes", None, F.col("n")),
        _rows(roots, "hierarchy", "root", F.col("id"), F.col("children"), F.col("name")),
        _spread(keep(T.distribution(measures, "value", by=["measure"])), F.col("measure")),
        _rows(evidence, "associations", "evidence", F.col("code"), F.col("facts")),
        _rows(evidence.agg(F.count_if(~F.col("mapped")).alias("n")), "associations", "unmapped_codes", None, F.col("n")),
        _rows(evidence.filter(~F.col("mapped")), "associations", "unmapped_code", F.col("code"), F.col("facts")),
        _rows(knowledge_sources, "associations", "knowledge_source", F.col("source"), F.col("n")),
        _wide(T.accession_counts(release.facts), "associations", ["source_accessions", "isoform_accessions"]),
        _wide(
            shape_agreement(release.facts, members).withColumn("matches", F.col("matches").cast("int")),
            "participation", ["edges", "association_pairs", "matches", "associations_per_edge"],
        ),
        _rows(sizes.agg(F.count_if(F.col("genes") == 0).alias("n")), "gene_sets", "without_genes", None, F.col("n")),
        _wide(S.band_counts(sizes, *band), "gene_sets", ["in_band", "below_band", "above_band"]),
        _rows(largest, "gene_sets", "largest", F.col("pathway"), F.col("genes"), F.col("name")),
        _rows(hubs, "gene_sets", "hub", F.col("gene"), F.col("pathways"), F.col("name")),
        _wide(
            contained.agg(
                count.alias("pairs_compared"),
                F.count_if(F.col("common") == F.col("child_genes")).alias("fully_contained"),
                F.round(
                    F.count_if(F.col("common") == F.col("child_genes")) / F.greatest(count, F.lit(1)), 4
                ).alias("fully_contained_fraction"),
            ),
            "propagation", ["pairs_compared", "fully_contained", "fully_contained_fraction"],
        ),
        _spread(keep(T.distribution(contained, "fraction", digits=4)), F.lit("child_genes_in_parent")),
        _rows(grouped.agg(F.countDistinct("group_id").alias("n")), "propagation", "identical_groups", None, F.col("n")),
        _rows(grouped.agg(count.alias("n")), "propagation", "sets_in_identical_groups", None, F.col("n")),
        _rows(equal, "propagation", "largest_identical", F.col("pathway"), F.col("genes"), F.col("name")),
        _rows(terms.agg(F.coalesce(F.sum("terms"), F.lit(0)).alias("n")), "crosswalk", "edges", None, F.col("n")),
    ]
    if statements is not None:
        totals.append(_rows(statements, "statements", "part", F.col("part"), F.col("statements")))
    if metadata is not None:
        totals.append(_rows(metadata, "release", F.col("p"), None, F.lit(None), F.col("o")))
    if manifest is not None:
        header, files = manifest
        totals.append(_rows(header, "sources", F.col("key"), None, F.lit(None), F.col("value")))
        totals.append(_rows(files, "sources", "file", F.col("filename"), F.col("bytes")))
    return reduce(DataFrame.unionByName, totals)
