"""Tables stored in the order of their keys, and lookups that read only what the keys are in."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import fields, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kgspark.plans.release import Release
from kgspark.session import remove_shared, write_shared

#: Order of each stored table. More than the key alone, so that a key with many rows is dealt to several files.
ORDER = {
    "node": ("id", "label"), "hierarchy": ("child", "parent"), "gene": ("symbol", "id"), "facts": ("gene", "pathway", "code", "accession"),
    "participation": ("gene", "pathway"), "crosswalk": ("pathway", "term"),
}
#: Tables that joins on a gene read together, and their join key.
BUCKETED = {"facts": "gene", "participation": "gene", "gene": "id"}
#: Most ids that a lookup names in its condition; more are joined.
MOST_IDS = 1_000
ROW_GROUP = 16 << 20


def write_clustered(df: DataFrame, path: str, by: Sequence[str], overwrite: bool = True) -> None:
    """Write a table dealt by ranges of ``by`` and sorted within, so that statistics of files, row groups and pages tell
    where a key is.

    Ranges are drawn from a sample of the rows, for which they are stored first: the input is evaluated once.
    """
    stored = write_shared(df)
    dealt = stored.repartitionByRange(*by).sortWithinPartitions(*by)
    dealt.write.mode("overwrite" if overwrite else "error").option("parquet.block.size", ROW_GROUP).parquet(path)
    remove_shared(stored)


def store_clustered(release: Release, folder: str) -> Release:
    """The release written table by table in key order, as read back."""
    spark = release.node.sparkSession
    for name, by in ORDER.items():
        write_clustered(getattr(release, name), f"{folder}/{name}", by)
    return read_clustered(spark, folder)


def read_clustered(spark: SparkSession, folder: str) -> Release:
    return Release(**{f.name: spark.read.parquet(f"{folder}/{f.name}") for f in fields(Release)})


def focused(release: Release, symbols: Sequence[str]) -> Release:
    """The release of the genes of some symbols: every query on those symbols has the same answer on it.

    The ids are looked up first, then named in the conditions on facts and edges, which skip what they cannot be in.
    """
    genes = release.gene.filter(F.col("symbol").isin(*symbols))
    ids = [r["id"] for r in genes.select("id").distinct().limit(MOST_IDS + 1).collect()]

    def of_genes(df: DataFrame) -> DataFrame:
        if len(ids) > MOST_IDS:
            return df.join(genes.select(F.col("id").alias("gene")).distinct(), "gene", "left_semi")
        return df.filter(F.col("gene").isin(*ids)) if ids else df.filter(F.lit(False))

    return replace(release, gene=genes, facts=of_genes(release.facts), participation=of_genes(release.participation))


def store_bucketed(release: Release, folder: str, prefix: str, buckets: int) -> Release:
    """Facts, edges and genes as tables ``<prefix>_<name>`` in ``buckets`` of the gene, as read back: joins and grouping on
    the gene move no row; those on gene and pathway neither, if ``spark.sql.requireAllClusterKeysForCoPartition`` is off.
    For releases without a gene that holds a large share of all rows; a bucket is one task.
    """
    spark = release.node.sparkSession
    stored = {}
    for name, key in BUCKETED.items():
        table = f"{prefix}_{name}"
        getattr(release, name).repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key).option(
            "path", f"{folder}/{name}"
        ).format("parquet").saveAsTable(table)
        stored[name] = spark.table(table)
    return replace(release, **stored)
