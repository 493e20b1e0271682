"""The ten-statement graph: queries, replacement, metadata, text round trip."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from kgspark.errors import IngestError
from kgspark.operators import quads as Q
from kgspark.plans import checks as C
from kgspark.plans import queries as N
from kgspark.plans.release import Release
from kgspark.sources import releases as R
from kgspark.sources import statements as S

G1, G2 = "urn:kg:release:v99997", "urn:kg:release:v99996"


def ten(spark, gene_rows=True):
    """Two node, two gene, four association, one edge and one crosswalk statement."""
    rows = [
        ("P:R-HSA-1", "a", "biolink:Pathway", "iri"), ("P:R-HSA-1", "rdfs:label", "Pathway one", "literal"),
        ("HGNC:1", "model:participates_in", "P:R-HSA-1", "iri"), ("P:R-HSA-1", "skos:closeMatch", "GO:0000165", "iri"),
    ]
    if gene_rows:
        rows += [
            ("HGNC:1", "a", "biolink:Gene", "iri"), ("HGNC:1", "rdfs:label", "SOD1", "literal"),
            ("_:x", "a", "biolink:GeneToPathwayAssociation", "iri"), ("_:x", "biolink:subject", "HGNC:1", "iri"),
            ("_:x", "biolink:object", "P:R-HSA-1", "iri"), ("_:x", "biolink:has_evidence", "ECO:0000304", "iri"),
        ]
    return spark.createDataFrame(rows, "s STRING, p STRING, o STRING, o_kind STRING").withColumn(
        "o_datatype", F.lit(None).cast("string")
    )


def in_graph(df, graph):
    return df.select(F.lit(graph).alias("graph"), "s", "p", "o", "o_kind", "o_datatype")


def small_release(spark, edges=(("1", "R-HSA-1"),), facts=(("1", "R-HSA-1", "ECO:0000304", "P00441"),)):
    return Release(
        node=spark.createDataFrame([("R-HSA-1", "Pathway one", "NCBITaxon:9606")], "id STRING, label STRING, taxon STRING"),
        hierarchy=spark.createDataFrame([], "child STRING, parent STRING"),
        gene=spark.createDataFrame([("1", "SOD1", "NCBITaxon:9606")], "id STRING, symbol STRING, taxon STRING"),
        facts=spark.createDataFrame(list(facts), "gene STRING, pathway STRING, code STRING, accession STRING"),
        participation=spark.createDataFrame(list(edges), "gene STRING, pathway STRING"),
        crosswalk=spark.createDataFrame([("R-HSA-1", "0000165")], "pathway STRING, term STRING"),
    )


def test_panel_keeps_missing_genes(spark):
    rows = N.disease_gene_panel(small_release(spark), "als").collect()
    assert {r[0]: r[1] for r in rows} == {"SOD1": 1, "FUS": 0, "C9orf72": 0, "TARDBP": 0}
    assert rows[0][0] == "SOD1"


def test_unknown_symbol_has_no_row_but_panel_has_a_zero(spark):
    release = small_release(spark)
    assert N.gene_pathway_count(release, "FUS").count() == 0
    assert N.gene_panel(release, ["FUS"]).collect()[0]["pathway_count"] == 0


def test_every_named_query_runs(spark):
    release = small_release(spark)
    arguments = dict(symbol="SOD1", a="SOD1", b="FUS", panel="als", limit=10)
    for name in N.NAMED_QUERIES:
        N.run_named(release, name, **arguments).collect()
    assert N.terms_for_gene(release, "SOD1").collect()[0][0] == "0000165"


def test_bad_arguments(spark):
    release = small_release(spark)
    with pytest.raises(ValueError):
        N.run_named(release, "gene-pathways")
    with pytest.raises(ValueError):
        N.run_named(release, "gene-pathways", symbol='x" }')
    with pytest.raises(ValueError):
        N.hub_genes(release, 0)
    with pytest.raises(ValueError):
        N.disease_gene_panel(release, "none")
    with pytest.raises(ValueError):
        N.run_named(release, "no-such-query")


def test_shared_pathways_of_a_symbol_with_two_genes(spark):
    release = small_release(spark, edges=[("1", "R-HSA-1"), ("2", "R-HSA-1"), ("3", "R-HSA-1")])
    genes = spark.createDataFrame(
        [("1", "A", "t"), ("2", "A", "t"), ("3", "B", "t")], "id STRING, symbol STRING, taxon STRING"
    )
    two = Release(release.node, release.hierarchy, genes, release.facts, release.participation, release.crosswalk)
    assert N.shared_pathways(two, "A", "B").count() == 2
    assert N.shared_pathways(two, "A", "A").count() == 4
    assert N.gene_pathway_count(two, "A").collect()[0]["pathway_count"] == 1


def test_replacing_one_release_keeps_the_other(spark, tmp_path):
    path = str(tmp_path / "quads")
    for graph in (G1, G2):
        assert R.replace_release(in_graph(ten(spark), graph), path, graph) == 10
    assert R.replace_release(in_graph(ten(spark, gene_rows=False), G1), path, G1) == 4
    counts = {r["graph"]: r["n"] for r in R.read_releases(spark, path).groupBy("graph").agg(F.count("*").alias("n")).collect()}
    assert counts == {G1: 4, G2: 10}
    assert R.replace_release(in_graph(ten(spark), G1).limit(0), path, G1) == 0
    assert Q.select_release(R.read_releases(spark, path), [G1]).count() == 0
    assert Q.select_release(R.read_releases(spark, path), [G2]).count() == 10


def test_release_filter_prunes_folders(spark, tmp_path):
    path = str(tmp_path / "quads")
    for graph in (G1, G2):
        R.replace_release(in_graph(ten(spark), graph), path, graph)
    plan = Q.select_release(R.read_releases(spark, path), [G1])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and G1 in plan


def test_repeated_statements_collapse(spark, tmp_path):
    twice = in_graph(ten(spark), G1).unionByName(in_graph(ten(spark), G1))
    assert R.replace_release(twice, str(tmp_path / "q"), G1) == 10


def test_pattern_match(spark):
    quads = in_graph(ten(spark), G1)
    rows = Q.match(quads, [("?g", "a", "biolink:Gene"), ("?g", "rdfs:label", "?symbol")]).collect()
    assert [(r["g"], r["symbol"]) for r in rows] == [("HGNC:1", "SOD1")]
    named = Q.match(quads, [("?g", "rdfs:label", '"SOD1"'), ("?g", "model:participates_in", "?p"), ("?p", "rdfs:label", "?l")])
    assert named.collect()[0]["l"] == "Pathway one"
    with pytest.raises(ValueError):
        Q.match(quads, [("?a", "a", "biolink:Gene"), ("?b", "a", "biolink:Pathway")])


def test_literal_is_not_an_iri(spark):
    rows = [("x", "p", "y", "literal"), ("y", "q", "z", "iri"), ("x", "same", "x", "iri"), ("x", "same", "y", "iri")]
    quads = in_graph(spark.createDataFrame(rows, "s STRING, p STRING, o STRING, o_kind STRING").withColumn(
        "o_datatype", F.lit(None).cast("string")), "g")
    assert Q.match(quads, [("?a", "p", "?b"), ("?b", "q", "?c")]).count() == 0
    assert Q.match(quads, [("?a", "same", "?a")]).count() == 1


def test_shapes_fail_in_both_directions(spark):
    good = small_release(spark)
    assert C.chk_shapes(good.facts, good.participation).collect()[0]["status"] == "PASS"
    extra = small_release(spark, edges=[("1", "R-HSA-1"), ("1", "R-HSA-2")])
    row = C.chk_shapes(extra.facts, extra.participation).collect()[0]
    assert row["status"] == "FAIL" and "1 with no association behind them" in row["detail"]
    none = C.chk_shapes(good.facts, good.participation.limit(0)).collect()[0]
    assert none["status"] == "FAIL" and none["detail"] == "no edges"


def test_metadata_content(spark):
    row = R.release_row(
        spark, graph=G1, version='v99997 "test"', doi="10.1234/release.1", publication_date="2026-06",
        license_id="cc-by-4.0", triples=10,
    )
    meta = {(r["s"], r["p"]): r for r in R.release_metadata(row, "2026-09-15", taxon="NCBITaxon:9606").collect()}
    assert meta[(G1, "dcterms:source")]["o"] == "https://doi.org/10.1234/release.1"
    assert meta[(G1, "void:triples")]["o"] == "10"
    assert meta[(G1, "dcterms:issued")]["o"] == "2026-06-01"
    assert meta[(G1, "dcterms:license")]["o"] == "https://creativecommons.org/licenses/by/4.0/"
    assert sum(1 for s, _ in meta if s != G1) == 4


def test_metadata_reload_replaces_only_its_release(spark, tmp_path):
    path = str(tmp_path / "meta")
    def load(graph, n, day):
        R.write_metadata(spark, R.release_metadata(R.release_row(spark, graph=graph, version="v", triples=n), day), path, graph)
    load(G1, 10, "2026-01-01")
    load(G2, 9, "2026-01-02")
    load(G1, 3, "2026-01-03")
    stored = R.read_metadata(spark, path)
    triples = {r["s"]: r["o"] for r in stored.filter("p = 'void:triples'").collect()}
    assert triples == {G1: "3", G2: "9"}
    assert stored.filter("p = 'prov:endedAtTime'").count() == 3
    assert stored.count() == stored.distinct().count()


def test_release_number(spark):
    assert R.graph_name("V97") == R.graph_name("97") == "urn:kg:release:v97"
    with pytest.raises(IngestError):
        R.graph_name("97> }")


def test_text_round_trip(spark, tmp_path):
    texts = ['plain', 'a "quoted" \\ back', "line\nbreak\r\ttab", "\\n is not a break", "ends with \\"]
    rows = [(G1, f"P:{i}", "rdfs:label", t, "literal", None) for i, t in enumerate(texts)]
    rows += [(G1, "P:9", "a", "biolink:Pathway", "iri", None), (G1, "P:9", "dcterms:issued", "2026-01-01", "literal", "xsd:date"),
             (G1, "_:b", "biolink:subject", "HGNC:1", "iri", None)]
    quads = spark.createDataFrame(rows, "graph STRING, s STRING, p STRING, o STRING, o_kind STRING, o_datatype STRING")
    path = str(tmp_path / "nq")
    S.write_nquads(quads, path)
    back = S.read_statements(spark, path)
    assert back.count() == len(rows)
    literals = {r["s"].rsplit("/", 1)[-1]: r["o"] for r in back.filter("o_kind = 'literal' AND p LIKE '%label'").collect()}
    assert literals == {str(i): t for i, t in enumerate(texts)}
    dated = back.filter("o = '2026-01-01'").collect()[0]
    assert dated["o_datatype"] == "http://www.w3.org/2001/XMLSchema#date"
    assert back.filter("s = '_:b'").collect()[0]["o"] == "https://identifiers.org/hgnc:1"
    assert back.filter("p LIKE '%22-rdf-syntax-ns#type'").count() == 1


def test_text_sink_is_ordered_and_refuses_unknown_prefixes(spark, tmp_path):
    quads = in_graph(ten(spark), G1)
    S.write_nquads(quads, str(tmp_path / "a"))
    S.write_nquads(quads.repartition(7), str(tmp_path / "b"))
    read = lambda n: [r[0] for r in spark.read.text(str(tmp_path / n)).collect()]
    assert sorted(read("a")) == sorted(read("b")) and len(read("a")) == 10
    odd = quads.withColumn("s", F.lit("NOPE:1"))
    with pytest.raises(IngestError, match="NOPE:1"):
        S.write_nquads(odd, str(tmp_path / "c"))


def test_emission_counts(spark):
    """Nodes make 3 statements plus one per parent; genes 3; associations 7."""
    release = small_release(spark)
    per_part = {r["part"]: r["statements"] for r in Q.statements_per_part(release.quads(G1, "infores:x")).collect()}
    assert per_part == {"pathways": 3, "associations": 10, "participation": 1, "crosswalk": 1}
    assert 2_883 * 3 + 2_899 == 11_548 and 11_485 * 3 + 161_818 * 7 == 1_167_181
    parts = Q.statements_per_part(release.quads(G1, "infores:x"))
    assert Q.matches_metadata(parts, 15).collect()[0]["matches"]
    assert not Q.matches_metadata(parts, 14).collect()[0]["matches"]


def test_empty_symbol_makes_no_label(spark):
    gene = spark.createDataFrame([("1", "", "t"), ("2", None, "t")], "id STRING, symbol STRING, taxon STRING")
    assert Q.gene_quads(gene).count() == 4
