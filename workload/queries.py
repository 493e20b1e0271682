"""One entry per operator: the library call, bound to the stand-in tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kgspark.functions import text as X
from kgspark.operators import diff as D
from kgspark.operators import digests as G
from kgspark.operators import encoded as E
from kgspark.operators import hierarchy as H
from kgspark.operators import quads as Q
from kgspark.operators import reachability as Y
from kgspark.operators import resolve as R
from kgspark.operators import rules as U
from kgspark.operators import scope as O
from kgspark.operators import sets as S
from kgspark.operators import shapes as P
from kgspark.operators import stats as T
from kgspark.operators import terms as M
from kgspark.plans import checks as C
from kgspark.plans import incremental as V
from kgspark.plans import ingest as I
from kgspark.plans import queries as N
from kgspark.plans.describe import characteristics
from kgspark.session import ensure_checkpoint_dir, write_shared
from kgspark.sources import clustered, manifests, quoted, releases, snapshots, statements, tsv
from workload.tables import CURATED, INFERRED, MODEL_BASE, SPOT_GENE, SPOT_PATHWAY, SYMBOLS, Tables

Query = Callable[[Tables], DataFrame]
QUERIES: dict[str, Query] = {}

LANGUAGES = ["en", "fr", "de", "es"]
CODE_TERMS = {"A": "ECO:1", "R": "ECO:2"}
ALL_TERMS = {"A": "ECO:1", "R": "ECO:2", "N": "ECO:3"}
KEYWORDS = {"folded": ["RING"], "exact": ["old"]}
SEED = 97


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


# Sources and sinks.

@query
def payload_sniff(t: Tables) -> DataFrame:
    pages = t.read("pages").selectExpr("'page' AS kind", "html AS content")
    texts = t.read("documents").selectExpr("'document' AS kind", "text AS content")
    rows = t.read("orders").selectExpr("'table' AS kind", "concat_ws('\\t', o_orderkey, o_orderstatus) AS content")
    sniffed = manifests.sniff_tabular(pages.unionByName(texts).unionByName(rows))
    return sniffed.groupBy("kind", "tabular").agg(F.count(F.lit(1)).alias("files"))


@query
def manifest_compare(t: Tables) -> DataFrame:
    docs = t.read("documents")
    ours = docs.selectExpr("CAST(doc_id AS STRING) AS filename", "md5(text) AS md5")
    theirs = docs.filter("lang <> 'es'").selectExpr(
        "CAST(doc_id AS STRING) AS filename", "md5(CASE WHEN lang = 'de' THEN concat(text, '.') ELSE text END) AS md5"
    )
    return manifests.compare_manifests(ours, theirs)


@query
def emit_quads(t: Tables) -> DataFrame:
    return t.emitted


@query
def statements_per_part(t: Tables) -> DataFrame:
    return Q.statements_per_part(t.emitted)


@query
def nquads_lines(t: Tables) -> DataFrame:
    quads = t.read("documents").selectExpr(
        "'urn:kg:release:v1' AS graph", "concat('P:', doc_id) AS s", "'rdfs:comment' AS p", "text AS o",
        "'literal' AS o_kind", "CASE WHEN lang = 'en' THEN 'xsd:string' END AS o_datatype",
    )
    return statements.nquads_lines(quads)


@query
def parse_statements(t: Tables) -> DataFrame:
    """Statement lines of every document, read back."""
    return statements.parse_statements(nquads_lines(t).withColumnRenamed("line", "value"))


@query
def quoted_records(t: Tables) -> DataFrame:
    """Each document as a quoted file of two records, its lines in blocks, put together again."""
    content = (
        "concat('\"', replace(text, '\"', '\"\"'), '\"\\t', lang, '\\n', source, ' 5\" wide\\t\"', lang, '\"')"
    )
    lines = t.read("documents").selectExpr(
        "CAST(doc_id AS STRING) AS file", f"posexplode(split({content}, '\n')) AS (position, value)"
    )
    return quoted.quoted_records(lines.selectExpr("file", "position div 7 AS block", "position", "value"))


@query
def release_metadata(t: Tables) -> DataFrame:
    described = t.read("orders").selectExpr(
        "concat('urn:kg:release:v', o_orderkey) AS graph", "concat('v', o_orderkey) AS version",
        "concat('10.1/', o_custkey) AS doi",
        "CASE WHEN o_orderstatus = 'F' THEN concat('https://example.org/', o_custkey) END AS doi_url",
        "CASE WHEN o_orderstatus = 'P' THEN '' WHEN o_orderstatus = 'F' THEN date_format(o_orderdate, 'yyyy-MM') "
        "ELSE date_format(o_orderdate, 'yyyy-MM-dd') END AS publication_date",
        "CASE WHEN o_orderpriority = '1-URGENT' THEN 'CC-BY-4.0' WHEN o_orderpriority = '2-HIGH' THEN '' "
        "ELSE o_orderpriority END AS license_id",
        "o_custkey AS triples",
    )
    return releases.release_metadata(described, "2026-01-31", taxon="NCBITaxon:9606")


@query
def upsert_metadata(t: Tables) -> DataFrame:
    stated = t.two_releases.select(F.col("graph").alias("s"), "p", "o")
    fresh = t.current.selectExpr("'v2' AS s", "'void:entry' AS p", "label AS o")
    return releases.upsert_metadata(stated, fresh, "v2")


@query
def snapshot_fingerprint(t: Tables) -> DataFrame:
    return snapshots.snapshot_fingerprint(t.facts)


@query
def key_shape(t: Tables) -> DataFrame:
    key = (
        "CASE o_orderstatus WHEN 'P' THEN concat('v', o_orderkey) "
        "WHEN 'F' THEN date_format(o_orderdate, 'yyyy-MM-dd') ELSE date_format(o_orderdate, 'yyyy-M-d') END AS key"
    )
    portal = "CASE WHEN o_orderstatus = 'O' THEN lower(o_orderpriority) ELSE o_orderpriority END AS portal"
    keyed = t.read("orders").selectExpr(key, portal)
    return keyed.groupBy(
        X.snapshot_key_class(F.col("key")).alias("class"), X.portal_key_valid(F.col("portal")).alias("portal_ok")
    ).agg(F.count(F.lit(1)).alias("keys"))


# Scope, codes, identifiers.

@query
def scope_filter(t: Tables) -> DataFrame:
    kept = O.scope_filter(t.read("documents"), "lang", "en", LANGUAGES, strict=True)
    return kept.select("doc_id", "lang", "source", "n_chars")


@query
def scope_tally(t: Tables) -> DataFrame:
    return O.scope_tally(t.read("documents"), "lang", "en")


@query
def scope_unknown(t: Tables) -> DataFrame:
    return O.unknown_names(t.read("documents"), "lang", ["en", "fr"])


@query
def scope_edges(t: Tables) -> DataFrame:
    classed = O.classify_edges(t.hierarchy, t.node.filter("taxon = 'PROMO'"))
    return O.scope_edge_tally(classed)


@query
def map_codes(t: Tables) -> DataFrame:
    mapped = U.map_codes(t.raw, "code", CODE_TERMS, "term")
    return mapped.groupBy("code", "term").agg(F.count(F.lit(1)).alias("rows"))


@query
def unknown_codes(t: Tables) -> DataFrame:
    return U.unknown_codes(U.map_codes(t.raw, "code", CODE_TERMS, "term"), "code", "term")


@query
def in_scope_facts(t: Tables) -> DataFrame:
    return O.in_scope(t.facts, "pathway", t.node.filter("taxon = 'PROMO'"))


@query
def off_scope_facts(t: Tables) -> DataFrame:
    rest = O.off_scope(t.facts, "pathway", t.node.filter("taxon = 'PROMO'"))
    return rest.agg(F.count(F.lit(1)).alias("rows"))


@query
def expand_curie(t: Tables) -> DataFrame:
    prefix = "CASE WHEN p_size <= 20 THEN 'P' WHEN p_size <= 40 THEN 'GO' ELSE 'unknown' END"
    ids = t.part.selectExpr("p_partkey AS id", f"concat({prefix}, ':', p_partkey, ':x') AS curie")
    return ids.select("id", "curie", X.expand_curie(F.col("curie"), {"P": "https://example.org/p/", "GO": "http://purl.obolibrary.org/obo/GO_"}).alias("iri"))


@query
def mint_curie(t: Tables) -> DataFrame:
    ids = t.gene.selectExpr("id", "concat('HGNC:', id) AS given")
    return ids.select("id", X.curie("HGNC", F.col("given")).alias("kept"), X.curie("HGNC", F.col("id")).alias("minted"))


@query
def base_accession(t: Tables) -> DataFrame:
    return t.raw.groupBy(X.base_accession(F.col("accession")).alias("base")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(X.is_isoform(F.col("accession"))).alias("isoform_rows")
    )


@query
def model_term(t: Tables) -> DataFrame:
    return t.event_quads.select(
        "s", X.model_term(F.concat(F.lit("<"), F.col("p"), F.lit(">")), MODEL_BASE).alias("term")
    )


@query
def verify_layout(t: Tables) -> DataFrame:
    spec = U.LayoutSpec(
        "customer", ("c_name", "c_mktsegment"),
        (U.ColumnRule("c_name", "pattern", r"^Customer#\d{9}$"), U.ColumnRule("c_mktsegment", "required"),
         U.ColumnRule("c_mktsegment", "enum", ("BUILDING", "MACHINERY", "AUTOMOBILE"))),
    )
    parsed = t.read("customer").selectExpr(
        "c_name", "c_mktsegment", "CASE WHEN c_acctbal < 0 THEN 3 ELSE 2 END AS n_fields"
    )
    return U.layout_report(parsed, spec)


@query
def layout_samples(t: Tables) -> DataFrame:
    """The 20 smallest offending values of each rule over all orders."""
    spec = U.LayoutSpec(
        "orders", ("key", "priority", "status"),
        (U.ColumnRule("key", "pattern", r"^[0-8]+$"), U.ColumnRule("priority", "enum", ("1-URGENT", "5-LOW")), U.ColumnRule("status", "required")),
    )
    parsed = t.read("orders").selectExpr(
        "CAST(o_orderkey AS STRING) AS key", "o_orderpriority AS priority",
        "CASE WHEN o_totalprice < 20000 THEN ' ' ELSE o_orderstatus END AS status", "CASE WHEN o_totalprice > 400000 THEN 2 ELSE 3 END AS n_fields",
    )
    return U.layout_samples(parsed, spec)


@query
def slot_rules(t: Tables) -> DataFrame:
    orders = t.read("orders").select("o_orderstatus", "o_orderpriority", "o_totalprice", "o_custkey")
    return U.check_rules(orders, [
        U.ColumnRule("o_orderstatus", "required"),
        U.ColumnRule("o_orderstatus", "enum", ("F", "O")),
        U.ColumnRule("o_orderpriority", "pattern", r"^\d-[A-Z]+$"),
        U.ColumnRule("o_orderpriority", "equals", "5-LOW"),
        U.ColumnRule("o_totalprice", "minimum", 10000.0),
    ])


# Resolution.

@query
def alias_map(t: Tables) -> DataFrame:
    return t.aliases


@query
def resolve_fanout(t: Tables) -> DataFrame:
    return t.facts


@query
def participation_edges(t: Tables) -> DataFrame:
    return t.edges


@query
def fanout_rows(t: Tables) -> DataFrame:
    return R.fanout_rows(t.collapsed, t.aliases)


@query
def unresolved(t: Tables) -> DataFrame:
    return R.unresolved(t.collapsed, t.aliases)


@query
def unresolved_fraction(t: Tables) -> DataFrame:
    return R.unresolved_fraction(t.collapsed, t.aliases)


@query
def evidence_rows(t: Tables) -> DataFrame:
    return R.evidence_rows(t.collapsed)


@query
def ingest_facts(t: Tables) -> DataFrame:
    settings = I.Settings(
        version="1", run_date="2026-01-31", scope="F", species={"F": "1", "O": "2"}, evidence=ALL_TERMS
    )
    everything = t.node.withColumn("species", F.lit("F"))
    facts, _, _ = I.build_facts(t.raw, I.build_nodes(everything, settings), t.aliases, settings)
    return facts


# Named queries.

@query
def gene_pathway_count(t: Tables) -> DataFrame:
    return N.gene_pathway_count(t.release, SYMBOLS[0])


@query
def gene_pathways(t: Tables) -> DataFrame:
    return N.gene_pathways(t.release, SYMBOLS[0])


@query
def gene_pathways_clustered(t: Tables) -> DataFrame:
    """The same query on a release stored in key order, looked up by ids."""
    stored = clustered.store_clustered(t.release, f"{ensure_checkpoint_dir(t.spark)}/clustered-{uuid.uuid4().hex}")
    return N.gene_pathways(clustered.focused(stored, SYMBOLS[:1]), SYMBOLS[0])


@query
def gene_panel(t: Tables) -> DataFrame:
    return N.gene_panel(t.release, SYMBOLS)


@query
def hub_by_symbol(t: Tables) -> DataFrame:
    return N.hub_genes(t.release, 10)


@query
def shared_pathways(t: Tables) -> DataFrame:
    return N.shared_pathways(t.release, SYMBOLS[0], SYMBOLS[2])


@query
def evidence_breakdown(t: Tables) -> DataFrame:
    return N.evidence_breakdown(t.release, SYMBOLS[0])


@query
def terms_for_gene(t: Tables) -> DataFrame:
    return N.terms_for_gene(t.release, SYMBOLS[0])


@query
def raw_sql(t: Tables) -> DataFrame:
    return N.raw_sql(t.release, """
        SELECT n.taxon, f.code, count(DISTINCT f.gene) AS genes
        FROM facts f JOIN node n ON n.id = f.pathway GROUP BY n.taxon, f.code""")


# Sets, shapes, statistics.

@query
def hub_by_id(t: Tables) -> DataFrame:
    return S.hub_by_id(t.edges, t.gene)


@query
def largest_sets(t: Tables) -> DataFrame:
    return S.largest_sets(t.edges, t.node)


@query
def set_size_distribution(t: Tables) -> DataFrame:
    t = t.kept()
    return S.set_size_distribution(t.node, t.edges)


@query
def scoring_band(t: Tables) -> DataFrame:
    return S.scoring_band(t.edges, 15, 22)


@query
def empty_sets(t: Tables) -> DataFrame:
    debts = t.edges.join(t.supplier.filter("s_acctbal > 9000").selectExpr("s_suppkey AS gene"), "gene", "left_semi")
    return S.empty_sets(t.node, debts)


@query
def containment(t: Tables) -> DataFrame:
    t = t.kept(edges=True)
    return S.containment(t.hierarchy, t.edges)


@query
def containment_summary(t: Tables) -> DataFrame:
    t = t.kept(edges=True)
    return S.containment_summary(S.containment(t.hierarchy, t.edges))


@query
def identical_sets(t: Tables) -> DataFrame:
    return S.identical_sets(t.small_sets)


@query
def largest_identical_group(t: Tables) -> DataFrame:
    return S.largest_identical_group(S.identical_members(t.small_sets))


@query
def reconcile_sets(t: Tables) -> DataFrame:
    t = t.kept()
    ours = t.facts.selectExpr("pathway AS key", "gene AS member")
    theirs = t.damaged.selectExpr("pathway AS key", "gene AS member")
    return S.reconcile_sets(ours, theirs)


@query
def reconcile_by_digest(t: Tables) -> DataFrame:
    t = t.kept(edges=True)
    ours, theirs = (df.selectExpr("pathway AS key", "gene AS member") for df in (t.edges, write_shared(t.damaged)))
    return G.reconcile_sets_by_digest(ours, theirs, is_set=True)


@query
def first_lines(t: Tables) -> DataFrame:
    """First lines by position, whatever order the lines come in."""
    lines = t.read("documents").select(
        F.concat(F.lit("d"), "doc_id").alias("file"), F.posexplode(F.split("text", "\n", -1)).alias("position", "value")
    )
    return tsv.first_lines(lines.repartition("value"))


@query
def trim_blanks(t: Tables) -> DataFrame:
    """Padded labels come back as they were."""
    padded = t.node.select("id", F.concat(F.lit(" \t\r\n"), "label", F.lit("\t \n")).alias("label"))
    trimmed = X.trim_blanks(F.col("label"))
    return padded.select("id", trimmed.alias("trimmed"), F.length(trimmed).cast("bigint").alias("n"))


@query
def reconcile_sample(t: Tables) -> DataFrame:
    """Sampled keys only, against memberships that differ."""
    t = t.kept()
    ours = t.facts.selectExpr("pathway AS key", "gene AS member")
    theirs = t.damaged.selectExpr("pathway AS key", "gene AS member")
    return S.reconcile_sets(ours, theirs, T.seeded_sample(ours, "key", 100, SEED))


@query
def seeded_sample(t: Tables) -> DataFrame:
    return T.seeded_sample(t.edges, "pathway", 5, SEED)


@query
def reconcile_shapes(t: Tables) -> DataFrame:
    t = t.kept()
    return P.reconcile_shapes(t.facts, t.damaged)


@query
def shape_agreement(t: Tables) -> DataFrame:
    t = t.kept()
    return P.shape_agreement(t.facts, t.edges)


@query
def pair_evidence_profile(t: Tables) -> DataFrame:
    return P.pair_evidence_profile(t.facts, CURATED, INFERRED)


@query
def evidence_mix(t: Tables) -> DataFrame:
    return T.evidence_mix(t.facts, ["A", "R"])


@query
def value_histogram(t: Tables) -> DataFrame:
    return T.value_histogram(t.read("lineitem"), ["l_returnflag", "l_linestatus", "l_linenumber"])


@query
def distribution(t: Tables) -> DataFrame:
    return T.distribution(t.read("lineitem"), "l_suppkey", by=["l_returnflag"])


@query
def distribution_doubles(t: Tables) -> DataFrame:
    balances = t.read("customer").select("c_mktsegment", "c_acctbal")
    return T.distribution(balances, "c_acctbal", by=["c_mktsegment"], digits=2)


@query
def type_tally(t: Tables) -> DataFrame:
    typed = t.emitted.filter("p IN ('a', 'biolink:in_taxon', 'biolink:primary_knowledge_source')")
    return typed.groupBy("p", "o").agg(F.count(F.lit(1)).alias("statements"))


@query
def coverage(t: Tables) -> DataFrame:
    t = t.kept()
    return T.coverage(t.node, t.gene, t.edges, t.crosswalk)


@query
def accession_counts(t: Tables) -> DataFrame:
    return T.accession_counts(t.facts)


@query
def crosswalk_summary(t: Tables) -> DataFrame:
    return T.crosswalk_summary(t.crosswalk)


# Statements and terms.

@query
def select_release(t: Tables) -> DataFrame:
    return Q.select_release(t.two_releases, ["v2"])


@query
def select_union(t: Tables) -> DataFrame:
    return Q.select_release(t.two_releases, ["v1", "v2", "v3"])


@query
def bgp_match(t: Tables) -> DataFrame:
    patterns = [
        ("?a", "a", "biolink:GeneToPathwayAssociation"), ("?a", "biolink:subject", "?gene"),
        ("?a", "biolink:object", "?pathway"), ("?pathway", "biolink:part_of", "?parent"),
        ("?gene", "rdfs:label", "?symbol"),
    ]
    found = Q.match(Q.relevant(t.kept().emitted, patterns), patterns)
    return found.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("solutions"), F.countDistinct("parent").alias("parents")
    )


@query
def bgp_match_ids(t: Tables) -> DataFrame:
    """The same pattern over encoded statements; only the symbols of the answer are decoded."""
    patterns = [
        ("?a", "a", "biolink:GeneToPathwayAssociation"), ("?a", "biolink:subject", "?gene"),
        ("?a", "biolink:object", "?pathway"), ("?pathway", "biolink:part_of", "?parent"),
        ("?gene", "rdfs:label", "?symbol"),
    ]
    encoded = E.encode(Q.relevant(t.kept().emitted, patterns))
    found = E.match_ids(encoded, patterns).groupBy("symbol").agg(
        F.count(F.lit(1)).alias("solutions"), F.countDistinct("parent").alias("parents")
    )
    return encoded.decode(found, ["symbol"])


@query
def distinct_encoded(t: Tables) -> DataFrame:
    repeated = t.two_releases.unionByName(t.two_releases.filter("graph = 'v1'"))
    return E.distinct_statements(E.encode(repeated), by_graph=True)


@query
def graph_set(t: Tables) -> DataFrame:
    repeated = t.two_releases.unionByName(t.two_releases.filter("graph = 'v1'"))
    return Q.as_set(repeated).groupBy("graph").agg(F.count(F.lit(1)).alias("statements"))


@query
def term_usage(t: Tables) -> DataFrame:
    return M.term_usage(t.event_quads, MODEL_BASE)


@query
def undefined_terms(t: Tables) -> DataFrame:
    return M.undefined_terms(M.term_usage(t.event_quads, MODEL_BASE), t.defined)


@query
def emitted_terms(t: Tables) -> DataFrame:
    return M.emitted_terms(t.model_files, MODEL_BASE)


@query
def emitted_terms_glued(t: Tables) -> DataFrame:
    return M.emitted_terms(t.glued_files, MODEL_BASE)


@query
def defined_terms(t: Tables) -> DataFrame:
    return M.defined_terms(t.model_text, MODEL_BASE, "model")


# Hierarchy.

@query
def find_cycle_nodes(t: Tables) -> DataFrame:
    return H.find_cycle_nodes(t.cyclic)


@query
def name_cycle(t: Tables) -> DataFrame:
    return H.name_cycle(t.cyclic)


@query
def depth(t: Tables) -> DataFrame:
    return H.depth(t.node, t.hierarchy)


@query
def hierarchy_shape(t: Tables) -> DataFrame:
    return H.hierarchy_shape(t.node, t.hierarchy)


@query
def degree_distributions(t: Tables) -> DataFrame:
    return H.degree_distributions(t.node, t.hierarchy)


@query
def roots(t: Tables) -> DataFrame:
    return H.roots(t.node, t.hierarchy)


@query
def ancestors(t: Tables) -> DataFrame:
    return H.ancestors(t.hierarchy)


@query
def gene_ancestors(t: Tables) -> DataFrame:
    t = t.kept(edges=True)
    return H.gene_ancestors(t.edges, t.hierarchy)


@query
def ancestors_of(t: Tables) -> DataFrame:
    return H.ancestors_of(t.hierarchy, t.node.filter("taxon = 'PROMO'"))


@query
def indexed_ancestors_of(t: Tables) -> DataFrame:
    """Ancestors of the promoted nodes, from the chains of the hierarchy."""
    below = t.hierarchy.filter("child <> parent")
    return Y.reachability_index(below).ancestors_of(t.node.filter("taxon = 'PROMO'"))


@query
def indexed_ancestor_counts(t: Tables) -> DataFrame:
    return Y.reachability_index(t.hierarchy.filter("child <> parent")).ancestor_counts()


@query
def gene_ancestors_of(t: Tables) -> DataFrame:
    mine = t.edges.filter(F.col("gene") == SPOT_GENE)
    return H.gene_ancestors(mine, t.hierarchy, few=True)


@query
def closure_violations(t: Tables) -> DataFrame:
    t = t.kept()
    return H.closure_violations(t.edges, t.hierarchy)


@query
def closed_memberships(t: Tables) -> DataFrame:
    """Closed memberships lack nothing; a level of the hierarchy taken out again leaves holes."""
    closed = H.closed_packs(t.edges, t.hierarchy)
    inner = t.hierarchy.select(F.col("child").alias("pathway"), F.lit(True).alias("inner")).distinct()
    marked = closed.join(inner.hint("merge"), "pathway", "left")
    return H.packed_violation_counts(marked, t.hierarchy, {"closed": F.lit(True), "without roots": F.col("inner")})


# Release diff.

@query
def release_diff(t: Tables) -> DataFrame:
    return D.release_diff(t.previous, t.current)


@query
def release_diff_by_digest(t: Tables) -> DataFrame:
    return G.release_diff_by_digest(t.previous, t.current)


@query
def table_difference(t: Tables) -> DataFrame:
    """Edges before and after a partial run, those of the damaged ones twice that end in a promoted node."""
    t = t.kept(edges=True)
    promoted = t.node.filter("taxon = 'PROMO'").selectExpr("id AS pathway")
    return G.table_difference(t.edges, t.damaged.unionByName(t.damaged.join(promoted, "pathway", "left_semi").select("gene", "pathway")), ["gene"])


@query
def advanced_measures(t: Tables) -> DataFrame:
    """Measures of the next release, moved there by the difference of facts."""
    t = t.kept(edges=True)
    old = t.release
    moved = V.advance(V.measure(old).stored(), old, t.next_release)
    rows = lambda df, name, item, value: df.selectExpr(f"'{name}' AS measure", f"{item} AS item", f"{value} AS value")
    return (
        rows(moved.sizes, "genes", "CAST(pathway AS STRING)", "genes")
        .unionByName(rows(moved.degrees, "pathways", "CAST(gene AS STRING)", "pathways"))
        .unionByName(rows(moved.common, "common", "concat(child, '-', parent)", "common"))
        .unionByName(rows(moved.evidence, "facts", "code", "facts"))
    )


@query
def advanced_containment(t: Tables) -> DataFrame:
    t = t.kept(edges=True)
    old, new = t.release, t.next_release
    return S.containment_summary(V.advance(V.measure(old).stored(), old, new).contained(new.hierarchy))


@query
def diff_counts(t: Tables) -> DataFrame:
    return D.diff_counts(D.release_diff(t.previous, t.current))


@query
def successors(t: Tables) -> DataFrame:
    return D.successors(D.release_diff(t.previous, t.current))


@query
def retired_rows(t: Tables) -> DataFrame:
    return D.retired_rows(D.release_diff(t.previous, t.current), "v96", "97", infer_successors=True)


@query
def label_conflicts(t: Tables) -> DataFrame:
    return D.label_conflicts(t.faulty)


# Checks.

@query
def label_keywords(t: Tables) -> DataFrame:
    return t.node.filter(C.has_keyword(F.col("label"), **KEYWORDS)).select("id", "label")


@query
def nested_pairs(t: Tables) -> DataFrame:
    return C.nested_pairs(t.facts, t.hierarchy, SPOT_GENE)


@query
def dangling_endpoints(t: Tables) -> DataFrame:
    return C.dangling_endpoints(t.hierarchy, t.faulty)


@query
def missing_evidence(t: Tables) -> DataFrame:
    return C.missing_evidence(t.facts.withColumn("code", F.nullif("code", F.lit("N")))).select(
        "gene", "pathway", "accession"
    )


@query
def unexpected_evidence(t: Tables) -> DataFrame:
    return C.unexpected_evidence(t.facts, ["A", "R"])


@query
def taxon_cardinality(t: Tables) -> DataFrame:
    return C.taxon_cardinality(t.faulty, t.faulty)


@query
def chk_taxon(t: Tables) -> DataFrame:
    return C.chk_taxon(t.faulty, "GOOD")


@query
def chk_ids(t: Tables) -> DataFrame:
    return C.chk_ids(t.part.selectExpr("concat(CASE WHEN p_size = 9 THEN 'R-MMU-' ELSE 'R-HSA-' END, p_partkey) AS id"), "R-HSA-")


@query
def chk_cardinality(t: Tables) -> DataFrame:
    return C.chk_cardinality(t.faulty, t.faulty)


@query
def chk_count(t: Tables) -> DataFrame:
    return C.chk_count(t.node, 2050)


@query
def chk_acyclic(t: Tables) -> DataFrame:
    return C.chk_acyclic(t.cyclic)


@query
def chk_endpoints(t: Tables) -> DataFrame:
    return C.chk_endpoints(t.hierarchy, t.faulty)


@query
def chk_evidence(t: Tables) -> DataFrame:
    return C.chk_evidence(t.facts, ["A", "R"])


def _spot(t: Tables) -> dict:
    return dict(gene=SPOT_GENE, must_have=SPOT_PATHWAY, **KEYWORDS)


@query
def spot_check(t: Tables) -> DataFrame:
    t = t.kept()
    return C.spot_check(t.facts, t.node, t.hierarchy, **_spot(t))


@query
def chk_shapes(t: Tables) -> DataFrame:
    t = t.kept()
    return C.chk_shapes(t.facts, t.damaged)


@query
def chk_members(t: Tables) -> DataFrame:
    t = t.kept()
    ours = t.facts.selectExpr("pathway AS key", "gene AS member")
    return C.chk_members(ours, t.damaged.selectExpr("pathway AS key", "gene AS member"))


@query
def chk_total(t: Tables) -> DataFrame:
    return C.chk_total(t.emitted.drop("part"), 100_000, 1_000_000)


@query
def chk_terms(t: Tables) -> DataFrame:
    return C.chk_terms(M.term_usage(t.event_quads, MODEL_BASE), t.defined)


@query
def check_offenders(t: Tables) -> DataFrame:
    """Offenders of a release with faults of every kind: foreign and doubled taxa, cycles, lost ends, codes, terms."""
    t = t.kept()
    broken = replace(t.release, node=t.faulty.selectExpr("id", "label", "taxon"), hierarchy=t.cyclic)
    usage = M.term_usage(t.event_quads, MODEL_BASE)
    return C.check_offenders(broken, taxon="GOOD", infix="1", evidence=["A", "R"], usage=usage, defined=t.defined)


@query
def acceptance(t: Tables) -> DataFrame:
    t = t.kept(edges=True)
    return C.acceptance(
        t.release, t.emitted.drop("part"), taxon="PROMO", infix="1", evidence=["A", "R"], expected_nodes=2000,
        spot=_spot(t), usage=M.term_usage(t.event_quads, MODEL_BASE), defined=t.defined,
        statements=(1_000, 10_000_000_000),
        members=(t.facts.selectExpr("pathway AS key", "gene AS member"), t.damaged.selectExpr("pathway AS key", "gene AS member")),
    )


@query
def characteristics_report(t: Tables) -> DataFrame:
    release = t.kept(edges=True, support=True).release
    return characteristics(
        release, codes=["A", "R"], source="infores:source", statements=release.statements_per_part("infores:source"),
        band=(15, 22),
    )


QUERIES["characteristics"] = QUERIES.pop("characteristics_report")


def bound(run: Query) -> Callable[[SparkSession, str], DataFrame]:
    """A query as the driver calls it."""
    return lambda spark, sf_dir: run(Tables(spark, sf_dir))
