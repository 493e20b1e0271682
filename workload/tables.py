"""Stand-in tables: the generic schemas derived from the test tables.

Every table is derived from whole test tables. Faults the checks must find are
planted by column values (sizes, balances, types), never by row position.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kgspark.operators import resolve as R
from kgspark.plans.release import Release

MODEL_BASE = "https://example.org/model#"
CURATED, INFERRED = "A", "R"
SYMBOLS = ["Supplier#000000002", "Supplier#000000003", "Supplier#000000009", "Supplier#absent"]
SPOT_GENE, SPOT_PATHWAY = 2, 8


class Tables:
    """Lazily derived stand-ins over one folder of test tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def kept(self, edges: bool = False, support: bool = False) -> Tables:
        """The same tables with the facts (and edges, and their support) written to the checkpoint folder once."""
        stored = self.release.stored(edges, support)
        other = Tables(self.spark, self.sf_dir)
        other.facts, other.edges = stored.facts, stored.participation
        return other

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def part(self) -> DataFrame:
        return self.read("part")

    @cached_property
    def supplier(self) -> DataFrame:
        return self.read("supplier")

    @cached_property
    def node(self) -> DataFrame:
        return self.part.selectExpr("p_partkey AS id", "p_name AS label", "p_type AS taxon")

    @cached_property
    def hierarchy(self) -> DataFrame:
        """Multi-parent DAG: half the key, and a third of it for small parts."""
        below = self.part.filter("p_partkey > 0")
        first = below.filter("p_size < 50").selectExpr("p_partkey AS child", "p_partkey div 2 AS parent")
        second = below.filter("p_size <= 7").selectExpr("p_partkey AS child", "p_partkey div 3 AS parent")
        return first.unionByName(second).distinct()

    @cached_property
    def cyclic(self) -> DataFrame:
        """The hierarchy with one planted edge from the top node down to its smallest child."""
        back = self.hierarchy.filter("parent = 0").groupBy("parent").agg(F.min("child").alias("low"))
        return self.hierarchy.unionByName(back.select(F.col("parent").alias("child"), F.col("low").alias("parent")))

    @cached_property
    def xref(self) -> DataFrame:
        """Gene dictionary; suppliers with a low balance are missing, so accessions have 0, 1 or 2 matches."""
        return self.supplier.filter("s_acctbal >= 1500").selectExpr(
            "s_suppkey AS id", "s_name AS symbol",
            "concat('A', s_suppkey, '|', 'A', s_suppkey + 7) AS aliases",
        )

    @cached_property
    def gene(self) -> DataFrame:
        return self.supplier.filter("s_acctbal >= 1500").selectExpr(
            "s_suppkey AS id", "s_name AS symbol", "concat('N', s_nationkey) AS taxon"
        )

    @cached_property
    def aliases(self) -> DataFrame:
        return R.alias_map(self.xref)

    @cached_property
    def raw(self) -> DataFrame:
        return self.read("lineitem").selectExpr(
            "concat('A', l_suppkey, CASE WHEN l_linenumber > 5 THEN concat('-', l_linenumber) ELSE '' END) AS accession",
            "l_partkey AS pathway", "l_returnflag AS code", "l_linestatus AS species",
        )

    @cached_property
    def scoped(self) -> DataFrame:
        return self.raw.filter("species = 'F'")

    @cached_property
    def collapsed(self) -> DataFrame:
        return R.collapse(self.scoped)

    @cached_property
    def facts(self) -> DataFrame:
        return R.resolve(self.collapsed, self.aliases)

    @cached_property
    def edges(self) -> DataFrame:
        return R.participation_edges(self.facts)

    @cached_property
    def damaged(self) -> DataFrame:
        """Edges after a partial run: those of wealthy suppliers moved to the next gene."""
        wealthy = self.supplier.filter("s_acctbal > 8000").selectExpr("s_suppkey AS gene")
        moved = self.edges.join(wealthy, "gene", "left_semi").selectExpr("gene + 1 AS gene", "pathway")
        return self.edges.join(wealthy, "gene", "left_anti").unionByName(moved).distinct()

    @cached_property
    def next_release(self) -> Release:
        """The release after: facts of wealthy suppliers belong to the next gene, parts of size 5 have no second parent."""
        wealthy = self.supplier.filter("s_acctbal > 8000").selectExpr("s_suppkey AS gene", "1 AS step").distinct()
        facts = self.facts.join(wealthy, "gene", "left").selectExpr(
            "gene + coalesce(step, 0) AS gene", "pathway", "code", "accession"
        ).distinct()
        smaller = self.part.filter("p_size = 5").selectExpr("p_partkey AS child", "p_partkey div 3 AS parent")
        hierarchy = self.hierarchy.join(smaller, ["child", "parent"], "left_anti").unionByName(
            self.part.filter("p_size = 50").selectExpr("p_partkey AS child", "p_partkey div 2 AS parent")
        )
        return Release(self.node, hierarchy, self.gene, facts, R.participation_edges(facts), self.crosswalk).stored()

    @cached_property
    def crosswalk(self) -> DataFrame:
        brand = self.part.filter("p_size <= 17").selectExpr("p_partkey AS pathway", "p_brand AS term")
        kind = self.part.filter("p_size <= 5").selectExpr("p_partkey AS pathway", "p_type AS term")
        return brand.unionByName(kind).distinct()

    @cached_property
    def previous(self) -> DataFrame:
        return self.part.filter("p_size <> 13").selectExpr("p_partkey AS id", "p_name AS label")

    @cached_property
    def current(self) -> DataFrame:
        """The next release: a size is gone, another got new ids, a brand new labels."""
        return self.part.filter("p_size <> 17").selectExpr(
            "CASE WHEN p_size = 23 THEN -1 - p_partkey ELSE p_partkey END AS id",
            "CASE WHEN p_brand = 'Brand#1' THEN p_brand ELSE p_name END AS label",
        )

    @cached_property
    def small_sets(self) -> DataFrame:
        return self.read("lineitem").selectExpr(
            "l_orderkey AS pathway", "concat(l_returnflag, l_linestatus) AS gene"
        ).distinct()

    @cached_property
    def faulty(self) -> DataFrame:
        """Nodes with planted faults: lost ones, wrong, missing and doubled taxa, second labels."""
        base = self.part.filter("p_size > 1").selectExpr(
            "p_partkey AS id", "p_name AS label",
            "CASE WHEN p_size = 2 THEN 'WRONG' WHEN p_size = 3 THEN NULL ELSE 'GOOD' END AS taxon",
        )
        second = self.part.filter("p_size = 4").selectExpr("p_partkey AS id", "p_brand AS label", "'OTHER' AS taxon")
        return base.unionByName(second)

    @cached_property
    def release(self) -> Release:
        return Release(self.node, self.hierarchy, self.gene, self.facts, self.edges, self.crosswalk)

    @cached_property
    def emitted(self) -> DataFrame:
        return self.release.quads("v1", "infores:source")

    @cached_property
    def two_releases(self) -> DataFrame:
        """Label statements of both releases, as one statement table."""
        def labels(df: DataFrame, graph: str) -> DataFrame:
            return df.selectExpr(
                f"'{graph}' AS graph", "concat('P:', id) AS s", "'rdfs:label' AS p", "label AS o",
                "'literal' AS o_kind", "CAST(NULL AS STRING) AS o_datatype",
            )
        return labels(self.previous, "v1").unionByName(labels(self.current, "v2"))

    @cached_property
    def event_quads(self) -> DataFrame:
        """Events as statements: a model predicate per type, and a class per heavy user."""
        return self.read("events").selectExpr(
            "concat('E:', event_id) AS s",
            f"CASE WHEN value < 50 THEN concat('{MODEL_BASE}', event_type) ELSE 'a' END AS p",
            f"CASE WHEN value < 20 THEN concat('U:', user_id) ELSE concat('{MODEL_BASE}', upper(event_type)) END AS o",
        )

    @cached_property
    def defined(self) -> DataFrame:
        """Terms the model defines: the types of events that carry no large value."""
        return self.read("events").filter("event_type IN ('view', 'click', 'purchase')").selectExpr(
            "event_type AS term"
        ).distinct()

    @cached_property
    def model_files(self) -> DataFrame:
        """Documents as statement files: each declares its language as a prefix, some for another base."""
        base = f"CASE WHEN lang IN ('en', 'fr') THEN '{MODEL_BASE}' ELSE 'https://example.org/other#' END"
        return self.read("documents").selectExpr(
            "CAST(doc_id AS STRING) AS file",
            f"explode(concat(array(concat('@prefix ', lang, ': <', {base}, '> .')), "
            "split(concat(lang, ':', replace(text, ' ', concat(' ', lang, ':'))), '\\n'))) AS line",
        )

    @cached_property
    def glued_files(self) -> DataFrame:
        """Documents as statement files whose names are glued together, each file by a separator of its own."""
        glue = "element_at(array('.', '/', '=', '|', '-', '#', 'é', ':'), CAST(doc_id % 8 AS INT) + 1)"
        return self.read("documents").selectExpr(
            "CAST(doc_id AS STRING) AS file",
            f"explode(concat(array(concat('@prefix ', lang, ': <{MODEL_BASE}> .')), "
            f"split(concat(lang, ':', replace(text, ' ', concat({glue}, lang, ':'))), '\n'))) AS line",
        )

    @cached_property
    def model_text(self) -> DataFrame:
        """Turns as model text: what a user says defines, what an answer says only mentions."""
        return self.read("conversations").selectExpr(
            "explode(split(concat(CASE WHEN role = 'user' THEN 'model:' ELSE '    model:' END, text), '\\n')) AS line"
        )
