"""Named membership queries over one release.

``gene_pathways`` and ``evidence_breakdown`` read the facts; the others read the
distinct edges, which are far fewer rows.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kgspark.functions.text import SYMBOL_PATTERN
from kgspark.plans.release import TABLES, Release
from kgspark.session import literal_table
from kgspark.vocab import GENE_PANELS


def check_symbol(symbol: str) -> str:
    """A symbol is letters, digits, dot, dash and underscore."""
    if not re.match(SYMBOL_PATTERN, symbol):
        raise ValueError(f"invalid gene symbol {symbol!r}")
    return symbol


def _genes(release: Release, symbols: Sequence[str]) -> DataFrame:
    return release.gene.filter(F.col("symbol").isin(*symbols)).select(F.col("id").alias("gene"), "symbol").distinct()


def gene_pathway_count(release: Release, symbol: str) -> DataFrame:
    """Distinct pathways of a symbol; genes sharing it merge; no row when unknown."""
    return release.participation.join(_genes(release, [symbol]), "gene").groupBy("symbol").agg(
        F.countDistinct("pathway").alias("pathway_count")
    )


def gene_pathways(release: Release, symbol: str) -> DataFrame:
    """Label and evidence of every association of a symbol, one row per association."""
    mine = release.facts.join(_genes(release, [symbol]), "gene").select("pathway", F.col("code").alias("evidence"))
    labels = release.node.select(F.col("id").alias("pathway"), "label")
    return mine.join(labels, "pathway").select("label", "evidence", "pathway").orderBy(
        "label", "pathway", "evidence"
    ).select("label", "evidence")


def gene_panel(release: Release, symbols: Sequence[str]) -> DataFrame:
    """Distinct pathways per panel symbol; every symbol has a row, 0 when absent."""
    panel = literal_table(release.gene.sparkSession, [(s,) for s in symbols], "symbol STRING")
    counts = release.participation.join(_genes(release, symbols), "gene").groupBy("symbol").agg(
        F.countDistinct("pathway").alias("n")
    )
    return panel.join(counts, "symbol", "left").select(
        "symbol", F.coalesce("n", F.lit(0).cast("bigint")).alias("pathway_count")
    ).orderBy(F.desc("pathway_count"), "symbol")


def disease_gene_panel(release: Release, panel: str = "als") -> DataFrame:
    """:func:`gene_panel` over a named panel."""
    if panel not in GENE_PANELS:
        raise ValueError(f"panel must be one of {sorted(GENE_PANELS)}, not {panel!r}")
    return gene_panel(release, GENE_PANELS[panel])


def hub_genes(release: Release, limit: int = 10) -> DataFrame:
    """Symbols in most distinct pathways; ties by symbol."""
    if limit < 1:
        raise ValueError("limit must be positive")
    named = release.gene.select(F.col("id").alias("gene"), "symbol").distinct()
    return (
        release.participation.join(named, "gene")
        .groupBy("symbol")
        .agg(F.countDistinct("pathway").alias("pathway_count"))
        .orderBy(F.desc("pathway_count"), "symbol")
        .limit(limit)
    )


def shared_pathways(release: Release, a: str, b: str) -> DataFrame:
    """Labels of the pathways both symbols are in, one row per pathway.

    One pass over the edges of both symbols instead of a self-join. Should a
    symbol name several genes, a pathway has a row per pair of genes.
    """
    mine = release.participation.join(_genes(release, sorted({a, b})), "gene")
    per_pathway = mine.groupBy("pathway").agg(
        F.count_if(F.col("symbol") == a).alias("na"), F.count_if(F.col("symbol") == b).alias("nb")
    ).filter((F.col("na") > 0) & (F.col("nb") > 0))
    copies = per_pathway.select(
        "pathway", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("na") * F.col("nb"))).alias("_copy")
    )
    labels = release.node.select(F.col("id").alias("pathway"), "label")
    return copies.join(labels, "pathway").orderBy("label", "pathway").select("label")


def evidence_breakdown(release: Release, symbol: str) -> DataFrame:
    """Associations of a symbol per evidence code."""
    return release.facts.join(_genes(release, [symbol]), "gene").groupBy(F.col("code").alias("evidence")).agg(
        F.count(F.lit(1)).alias("n")
    ).orderBy(F.desc("n"), "evidence")


def terms_for_gene(release: Release, symbol: str) -> DataFrame:
    """Distinct crosswalk terms of a symbol's pathways."""
    mine = release.participation.join(_genes(release, [symbol]), "gene").select("pathway").distinct()
    return release.crosswalk.join(mine, "pathway", "left_semi").select("term").distinct().orderBy("term")


def raw_sql(release: Release, text: str, **others: Release) -> DataFrame:
    """A caller's own Spark SQL over the release's tables ``node``, ``facts`` and so on.

    Further releases are given by name: ``v96=release`` makes ``v96_node`` and so
    on. The views live while the text is analysed; views of these names that the
    session had before are not kept.
    """
    spark = release.node.sparkSession
    named = {"": release, **{f"{name}_": r for name, r in others.items()}}
    for prefix, each in named.items():
        each.register(prefix)
    try:
        return spark.sql(text)
    finally:
        for prefix in named:
            for name in TABLES:
                spark.catalog.dropTempView(prefix + name)


# Query names and the keyword arguments each of them takes.
NAMED_QUERIES: dict[str, tuple[Callable[..., DataFrame], tuple[str, ...]]] = {
    "gene-pathway-count": (gene_pathway_count, ("symbol",)),
    "gene-pathways": (gene_pathways, ("symbol",)),
    "disease-gene-panel": (disease_gene_panel, ("panel",)),
    "hub-genes": (hub_genes, ("limit",)),
    "shared-pathways": (shared_pathways, ("a", "b")),
    "evidence-breakdown": (evidence_breakdown, ("symbol",)),
    "terms-for-gene": (terms_for_gene, ("symbol",)),
}
DEFAULTS = {"panel": "als", "limit": 10}


def run_named(release: Release, name: str, **arguments) -> DataFrame:
    """Run a named query; missing arguments and malformed symbols are errors."""
    if name not in NAMED_QUERIES:
        raise ValueError(f"unknown query {name!r}; known: {', '.join(sorted(NAMED_QUERIES))}")
    run, names = NAMED_QUERIES[name]
    values = {n: arguments.get(n, DEFAULTS.get(n)) for n in names}
    missing = [n for n, v in values.items() if v is None]
    if missing:
        raise ValueError(f"{name} requires {', '.join(missing)}")
    for n in ("symbol", "a", "b"):
        if n in values:
            check_symbol(values[n])
    return run(release, **values)
