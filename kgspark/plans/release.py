"""The tables of one release, as the compositions take them."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

from kgspark.operators.quads import GraphVocabulary, count_statements, to_quads
from kgspark.operators.resolve import participation_edges
from kgspark.operators.shapes import supported_edges
from kgspark.session import small_tasks, write_shared


TABLES = ("node", "hierarchy", "gene", "facts", "participation", "crosswalk")


@dataclass(frozen=True)
class Release:
    """``node`` (id, label, taxon), ``hierarchy`` (child, parent), ``gene`` (id,
    symbol, taxon), ``facts`` (gene, pathway, code, accession), ``participation``
    (gene, pathway; distinct), ``crosswalk`` (pathway, term)."""

    node: DataFrame
    hierarchy: DataFrame
    gene: DataFrame
    facts: DataFrame
    participation: DataFrame
    crosswalk: DataFrame

    def stored(self, edges: bool = True, support: bool = False) -> Release:
        """The release with its facts written to the checkpoint folder once.

        The plain edges derive from the written facts, so both shapes come from
        the same rows and reports that read them often do not resolve again.
        ``edges`` writes them too, ``support`` with the number of facts behind each.
        """
        spark = self.facts.sparkSession
        with small_tasks(spark):
            facts = write_shared(self.facts)
        participation = supported_edges(facts) if support else participation_edges(facts)
        if edges:
            with small_tasks(spark, facts.count()):
                participation = write_shared(participation)
        return replace(self, facts=facts, participation=participation)

    def quads(self, graph: str, source: str, vocabulary: GraphVocabulary = GraphVocabulary()) -> DataFrame:
        """All statements of the release with their ``part``."""
        return to_quads(
            self.node, self.hierarchy, self.gene, self.facts, self.participation, self.crosswalk,
            graph, source, vocabulary,
        )

    def statements_per_part(self, source: str, vocabulary: GraphVocabulary = GraphVocabulary()) -> DataFrame:
        """Statements of :meth:`quads` per part, counted without making them."""
        return count_statements(
            self.node, self.hierarchy, self.gene, self.facts, self.participation, self.crosswalk, source, vocabulary,
        )

    def register(self, prefix: str = "") -> None:
        """Register every table as a temporary view."""
        for name in TABLES:
            getattr(self, name).createOrReplaceTempView(prefix + name)
