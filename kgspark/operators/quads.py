"""Statements: emission from the fact tables, release selection, pattern match.

A statement is ``graph, s, p, o, o_kind, o_datatype``; ``o_kind`` is ``iri`` or
``literal``. Release graphs have set semantics, emitted counts do not.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from kgspark.functions.text import plain_curie
from kgspark.session import literal_table, observed

PARTS = ("pathways", "associations", "participation", "crosswalk")
QUAD_COLUMNS = ("graph", "s", "p", "o", "o_kind", "o_datatype")
Mint = Callable[[str, Column], Column]


@dataclass(frozen=True)
class GraphVocabulary:
    """Prefixes, classes and predicates used for a release graph."""

    node_prefix: str = "P"
    gene_prefix: str = "HGNC"
    term_prefix: str = "GO"
    accession_prefix: str = "UNIPROT"
    node_class: str = "biolink:Pathway"
    gene_class: str = "biolink:Gene"
    association_class: str = "biolink:GeneToPathwayAssociation"
    type: str = "a"
    label: str = "rdfs:label"
    in_taxon: str = "biolink:in_taxon"
    part_of: str = "biolink:part_of"
    subject: str = "biolink:subject"
    object: str = "biolink:object"
    predicate: str = "biolink:predicate"
    has_evidence: str = "biolink:has_evidence"
    source_slot: str = "biolink:primary_knowledge_source"
    original_subject: str = "biolink:original_subject"
    stated_predicate: str = "biolink:participates_in"
    participates_in: str = "model:participates_in"
    close_match: str = "skos:closeMatch"


def _iri(p: str, o: Column | str) -> Column:
    value = F.lit(o) if isinstance(o, str) else o
    return F.struct(F.lit(p).alias("p"), value.cast("string").alias("o"), F.lit("iri").alias("o_kind"),
                    F.lit(None).cast("string").alias("o_datatype"))


def _text(p: str, o: Column) -> Column:
    return F.struct(F.lit(p).alias("p"), o.cast("string").alias("o"), F.lit("literal").alias("o_kind"),
                    F.lit(None).cast("string").alias("o_datatype"))


def _typed(p: str, o: Column, datatype: str) -> Column:
    return F.struct(F.lit(p).alias("p"), o.cast("string").alias("o"), F.lit("literal").alias("o_kind"),
                    F.lit(datatype).alias("o_datatype"))


def _state(df: DataFrame, subject: Column, statements: Sequence[Column]) -> DataFrame:
    """One row per statement; statements without an object are not made.

    The subject is computed below the generator, once per input row.
    """
    return df.withColumn("s", subject).select("s", F.inline(F.array(*statements))).filter(F.col("o").isNotNull())


def _unminted(prefix: str, col: Column) -> Column:
    """In place of :func:`plain_curie` where only counts matter: there when the id is there."""
    return F.when(col.isNotNull(), F.lit(""))


def _tally(df: DataFrame, statements: Sequence[Column]) -> DataFrame:
    """Number of rows of :func:`_state`, ``n``: objects that are there, without a row for each."""
    return df.agg(reduce(add, [F.count(statement.getField("o")) for statement in statements]).alias("n"))


def _of_node(v: GraphVocabulary) -> list[Column]:
    return [_iri(v.type, v.node_class), _text(v.label, F.col("label")), _iri(v.in_taxon, F.col("taxon"))]


def node_quads(node: DataFrame, v: GraphVocabulary = GraphVocabulary()) -> DataFrame:
    """Class, label and taxon of each node ``id, label, taxon``."""
    return _state(node, plain_curie(v.node_prefix, F.col("id")), _of_node(v))


def _of_hierarchy(v: GraphVocabulary, mint: Mint = plain_curie) -> list[Column]:
    return [_iri(v.part_of, mint(v.node_prefix, F.col("parent")))]


def hierarchy_quads(hierarchy: DataFrame, v: GraphVocabulary = GraphVocabulary()) -> DataFrame:
    """One statement per distinct ``child, parent``."""
    pairs = hierarchy.select("child", "parent").distinct()
    return _state(pairs, plain_curie(v.node_prefix, F.col("child")), _of_hierarchy(v))


def _of_gene(v: GraphVocabulary) -> list[Column]:
    return [
        _iri(v.type, v.gene_class),
        _text(v.label, F.nullif(F.col("symbol"), F.lit(""))),
        _iri(v.in_taxon, F.col("taxon")),
    ]


def gene_quads(gene: DataFrame, v: GraphVocabulary = GraphVocabulary()) -> DataFrame:
    """Class, taxon and, unless empty, symbol of each gene ``id, symbol, taxon``."""
    return _state(gene, plain_curie(v.gene_prefix, F.col("id")), _of_gene(v))


def association_subject() -> Column:
    """Stable anonymous subject of an association: a hash of its four fields."""
    fields = F.concat_ws("|", *[F.col(c).cast("string") for c in ("gene", "pathway", "code", "accession")])
    return F.concat(F.lit("_:"), F.sha2(fields, 256))


def _of_association(source: str, v: GraphVocabulary, mint: Mint = plain_curie) -> list[Column]:
    return [
        _iri(v.type, v.association_class),
        _iri(v.subject, mint(v.gene_prefix, F.col("gene"))),
        _iri(v.object, mint(v.node_prefix, F.col("pathway"))),
        _iri(v.predicate, v.stated_predicate),
        _iri(v.has_evidence, F.col("code")),
        _iri(v.source_slot, source),
        _text(v.original_subject, mint(v.accession_prefix, F.col("accession"))),
    ]


def association_quads(facts: DataFrame, source: str, v: GraphVocabulary = GraphVocabulary()) -> DataFrame:
    """Seven statements per fact ``gene, pathway, code, accession``."""
    return _state(facts, association_subject(), _of_association(source, v))


def _of_edge(v: GraphVocabulary, mint: Mint = plain_curie) -> list[Column]:
    return [_iri(v.participates_in, mint(v.node_prefix, F.col("pathway")))]


def participation_quads(edges: DataFrame, v: GraphVocabulary = GraphVocabulary()) -> DataFrame:
    """One statement per ``gene, pathway`` edge."""
    return _state(edges, plain_curie(v.gene_prefix, F.col("gene")), _of_edge(v))


def _of_crosswalk(v: GraphVocabulary, mint: Mint = plain_curie) -> list[Column]:
    return [_iri(v.close_match, mint(v.term_prefix, F.col("term")))]


def crosswalk_quads(crosswalk: DataFrame, v: GraphVocabulary = GraphVocabulary()) -> DataFrame:
    """One statement per distinct ``pathway, term``."""
    pairs = crosswalk.select("pathway", "term").distinct()
    return _state(pairs, plain_curie(v.node_prefix, F.col("pathway")), _of_crosswalk(v))


def to_quads(
    node: DataFrame, hierarchy: DataFrame, gene: DataFrame, association: DataFrame,
    participation: DataFrame, crosswalk: DataFrame, graph: str, source: str,
    v: GraphVocabulary = GraphVocabulary(),
) -> DataFrame:
    """All statements of a release with the ``part`` they were emitted for. No shuffle
    but the two ``distinct`` on the small tables."""
    tables = (
        node_quads(node, v).unionByName(hierarchy_quads(hierarchy, v)),
        gene_quads(gene, v).unionByName(association_quads(association, source, v)),
        participation_quads(participation, v),
        crosswalk_quads(crosswalk, v),
    )
    out = None
    for name, df in zip(PARTS, tables):
        part = df.select(F.lit(graph).alias("graph"), "s", "p", "o", "o_kind", "o_datatype", F.lit(name).alias("part"))
        out = part if out is None else out.unionByName(part)
    return out


def statements_per_part(emitted: DataFrame) -> DataFrame:
    """Emitted statements per part, before duplicates collapse."""
    return emitted.groupBy("part").agg(F.count(F.lit(1)).alias("statements"))


def count_statements(
    node: DataFrame, hierarchy: DataFrame, gene: DataFrame, association: DataFrame,
    participation: DataFrame, crosswalk: DataFrame, source: str, v: GraphVocabulary = GraphVocabulary(),
) -> DataFrame:
    """:func:`statements_per_part` of :func:`to_quads`, counted on the tables: no statement is made."""
    tables = (
        ("pathways", node, _of_node(v)),
        ("pathways", hierarchy.select("child", "parent").distinct(), _of_hierarchy(v, _unminted)),
        ("associations", gene, _of_gene(v)),
        ("associations", association, _of_association(source, v, _unminted)),
        ("participation", participation, _of_edge(v, _unminted)),
        ("crosswalk", crosswalk.select("pathway", "term").distinct(), _of_crosswalk(v, _unminted)),
    )
    counted = [_tally(df, made).select(F.lit(part).alias("part"), "n") for part, df, made in tables]
    summed = reduce(DataFrame.unionByName, counted).groupBy("part").agg(F.sum("n").alias("statements"))
    return summed.filter("statements > 0")


def part_counts(emitted: DataFrame) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """``emitted`` under observation, and a call for :func:`statements_per_part` of it.

    Counts are taken while the first action on the result runs; make the call after it.
    """
    seen = Observation()
    watched = emitted.observe(seen, *[F.count_if(F.col("part") == p).alias(p) for p in PARTS])

    def counted() -> DataFrame:
        found = {p: observed(seen, p) for p in PARTS}
        if None in found.values():
            return statements_per_part(emitted)
        return literal_table(emitted.sparkSession, [x for x in found.items() if x[1]], "part STRING, statements BIGINT")

    return watched, counted


def matches_metadata(per_part: DataFrame, stated: int) -> DataFrame:
    """One row: statements counted, statements the metadata claims, equal or not."""
    return per_part.agg(F.coalesce(F.sum("statements"), F.lit(0)).cast("bigint").alias("statements")).select(
        "statements", F.lit(stated).cast("bigint").alias("stated"),
        (F.col("statements") == F.lit(stated)).alias("matches"),
    )


def as_set(quads: DataFrame) -> DataFrame:
    """Set semantics of a graph: duplicate statements collapse."""
    return quads.select(*QUAD_COLUMNS).distinct()


def select_release(quads: DataFrame, graphs: Sequence[str]) -> DataFrame:
    """Statements of one release or of the union of several; an unknown release is empty.

    The filter is on the partition column, so only those folders are read. A
    statement that several releases make is one statement of their union.
    """
    chosen = quads.filter(F.col("graph").isin(*graphs))
    if len(graphs) == 1:
        return chosen
    return chosen.select("s", "p", "o", "o_kind", "o_datatype").distinct()


def _bind(quads: DataFrame, pattern: tuple[str, str, str]) -> tuple[DataFrame, list[str]]:
    """Filter one pattern and name its variables. A variable is bound to a term:
    its text in ``name`` and its kind in ``name#``."""
    rows, seen = quads, {}
    for column, want in zip(("s", "p", "o"), pattern):
        kind = (
            F.concat_ws("^^", "o_kind", "o_datatype") if column == "o" else F.lit("iri")
        )
        if want.startswith("?"):
            name = want[1:]
            if name in seen:
                text, other = seen[name]
                rows = rows.filter((F.col(column) == text) & (kind == other))
            else:
                seen[name] = (F.col(column), kind)
        elif column == "o" and want.startswith('"'):
            rows = rows.filter((F.col("o") == want.strip('"')) & (F.col("o_kind") == "literal"))
        elif column == "o":
            rows = rows.filter((F.col("o") == want) & (F.col("o_kind") == "iri"))
        else:
            rows = rows.filter(F.col(column) == want)
    columns = []
    for name, (text, kind) in seen.items():
        columns += [text.alias(name), kind.alias(name + "#")]
    return rows.select(*columns), list(seen)


def relevant(quads: DataFrame, patterns: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Statements with a predicate that some pattern names; all if one leaves it open."""
    wanted = {p for _, p, _ in patterns}
    return quads if any(p.startswith("?") for p in wanted) else quads.filter(F.col("p").isin(*sorted(wanted)))


def match(quads: DataFrame, patterns: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Basic graph pattern: one row per solution, one column per variable, bag semantics.

    Terms starting with ``?`` are variables, quoted objects are literals, all
    else are IRIs. Every pattern after the first must share a variable with an
    earlier one; patterns are equi-joined in the given order, sorted and merged:
    statements are emitted from files so much smaller than they are themselves
    that their size, judged by these, would have them broadcast.
    """
    solution, bound = None, []
    for pattern in patterns:
        rows, names = _bind(quads, pattern)
        if solution is None:
            solution, bound = rows, names
            continue
        shared = [n for n in names if n in bound]
        if not shared:
            raise ValueError(f"pattern {pattern} shares no variable with the ones before it")
        solution = solution.join(rows.hint("merge"), [c for n in shared for c in (n, n + "#")])
        bound += [n for n in names if n not in bound]
    return solution.select(*bound)
