"""The whole job on hand-written sources."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from kgspark.errors import IngestError, ScopeError, UnknownCodeError
from kgspark.plans import ingest as I
from kgspark.sources.releases import read_metadata, read_releases

HUMAN, MOUSE = "Homo sapiens", "Mus musculus"
PATHWAYS = [
    ("R-HSA-1", "Signal by RAS", HUMAN), ("R-HSA-2", "MAP kinase cascade", HUMAN), ("R-HSA-3", "Leaf", HUMAN),
    ("R-MMU-1", "Signal by RAS", MOUSE), ("R-MMU-2", "MAP kinase cascade", MOUSE),
]
RELATIONS = [("R-HSA-1", "R-HSA-2"), ("R-HSA-2", "R-HSA-3"), ("R-MMU-1", "R-MMU-2"), ("R-HSA-1", "R-HSA-2")]
ASSOCIATIONS = [
    ("P00001", "R-HSA-1", "TAS", HUMAN), ("P00001", "R-HSA-2", "TAS", HUMAN), ("P00001", "R-HSA-2", "TAS", HUMAN),
    ("P00001-2", "R-HSA-2", "IEA", HUMAN), ("P00002", "R-HSA-1", "IEA", HUMAN), ("P00002", "R-HSA-3", "TAS", HUMAN),
    ("P00001", "R-MMU-1", "IEA", MOUSE),
] + [("P00003", "R-HSA-1", "TAS", HUMAN)] * 8 + [("Q00009", "R-HSA-1", "IEA", HUMAN)]
CROSSWALK = [("R-HSA-1", "Signal by RAS", "GO:0000165"), ("R-HSA-9", "Gone", "GO:0000001")]
DICTIONARY = [("HGNC:1", "G1", "P00001"), ("HGNC:2", "G2", "P00002|P00003"), ("HGNC:3", "G3", "P00003"), ("HGNC:4", "G4", "")]


def sources(folder, pathways=PATHWAYS, relations=RELATIONS, associations=ASSOCIATIONS):
    def write(name, lines):
        path = folder / name
        path.write_text("".join("\t".join(line) + "\n" for line in lines))
        return str(path)
    full = [(a, p, f"https://example.org/{p}", "event", c, s) for a, p, c, s in associations]
    return {
        "pathways": write("pathways.txt", pathways), "relations": write("relations.txt", relations),
        "associations": write("map_All_Levels.txt", full),
        "crosswalk": write("terms.txt", [("Identifier", "Name", "GO_Term"), *CROSSWALK]),
        "dictionary": write("genes.tsv", [("hgnc_id", "symbol", "uniprot_ids"), *DICTIONARY]),
    }


def settings(**changes):
    values = dict(
        version="97", run_date="2026-01-31", expected_nodes=3, statements=(10, 200),
        spot=dict(gene="1", must_have="R-HSA-2", folded=["RAS"], exact=["MAP kinase"]),
    )
    return I.Settings(**{**values, **changes})


@pytest.fixture(scope="module")
def defined(spark):
    return spark.createDataFrame([("participates_in",)], "term STRING")


@pytest.fixture(scope="module")
def done(spark, defined, tmp_path_factory):
    folder = tmp_path_factory.mktemp("ingest")
    described = folder / "release.json"
    described.write_text(json.dumps({"version": "v97", "doi": "10.1/x", "publication_date": "2026-06", "license_id": "cc-by-4.0"}))
    work = str(folder / "work")
    results = I.run(spark, sources(folder), work, settings(), defined, str(described))
    return folder, work, {r["check"].split(".")[0]: r for r in results.collect()}


def test_all_checks_pass(done):
    _, _, results = done
    assert len(results) == 11
    assert {r["status"] for r in results.values()} == {"PASS"}, results
    assert results["8"]["detail"] == "3 pathways, 2 nested pairs"


def test_facts_fan_out_and_keep_isoforms(spark, done):
    _, work, _ = done
    facts = {tuple(r) for r in spark.read.parquet(f"{work}/release=v97/facts").select("gene", "pathway", "code", "accession").collect()}
    tas, iea = "ECO:0000304", "ECO:0000501"
    assert facts == {
        ("1", "R-HSA-1", tas, "P00001"), ("1", "R-HSA-2", tas, "P00001"), ("1", "R-HSA-2", iea, "P00001-2"),
        ("2", "R-HSA-1", iea, "P00002"), ("2", "R-HSA-3", tas, "P00002"), ("2", "R-HSA-1", tas, "P00003"),
        ("3", "R-HSA-1", tas, "P00003"),
    }
    edges = spark.read.parquet(f"{work}/release=v97/participation")
    assert edges.count() == edges.distinct().count() == 5


def test_statements_and_metadata_agree(spark, done):
    _, work, _ = done
    quads = read_releases(spark, f"{work}/quads")
    # 3 nodes x 3 + 2 edges, 3 genes x 3 + 7 x 7, 5 edges, 1 term.
    assert quads.count() == 9 + 2 + 9 + 49 + 5 + 1
    meta = {r["p"]: r["o"] for r in read_metadata(spark, f"{work}/metadata").filter("s = 'urn:kg:release:v97'").collect()}
    assert meta["void:triples"] == str(quads.count())
    assert meta["dcterms:issued"] == "2026-06-01" and meta["dcterms:source"] == "https://doi.org/10.1/x"


def test_unresolved_report_and_characteristics(spark, done):
    _, work, _ = done
    lost = spark.read.option("sep", "\t").option("header", True).csv(f"{work}/release=v97/unresolved").collect()
    assert [tuple(r) for r in lost] == [("Q00009", "1", "R-HSA-1", "IEA")]
    report = {(r["section"], r["metric"], r["item"]): r["value"] for r in spark.read.json(f"{work}/release=v97/characteristics").collect()}
    assert report[("coverage", "pathways", "")] == 3 and report[("coverage", "genes", "")] == 3
    assert report[("distribution", "depth_below_root", "max")] == 2
    assert report[("participation", "matches", "")] == 1
    assert report[("statements", "part", "associations")] == 58
    labels = {(r["section"], r["metric"], r["item"]): r["label"] for r in spark.read.json(f"{work}/release=v97/characteristics").collect()}
    assert labels[("hierarchy", "root", "R-HSA-1")] == "Signal by RAS" and labels[("gene_sets", "hub", "1")] == "G1"
    assert labels[("release", "pav:version", "")] == "V97"
    assert report[("associations", "knowledge_source", "infores:source")] == 7
    layout = spark.read.parquet(f"{work}/release=v97/layout")
    assert {r["source"] for r in layout.collect()} == {"pathways", "relations", "associations", "crosswalk"}
    assert layout.filter("violations > 0").count() == 0
    check = spark.read.parquet(f"{work}/release=v97/metadata_check").collect()[0]
    assert check["matches"] and check["statements"] == 75
    undefined = spark.read.parquet(f"{work}/release=v97/undefined_terms")
    assert undefined.columns == ["term", "uses"]


def test_reports_are_written(spark, done):
    _, work, _ = done
    read = lambda name: "\n".join(r["value"] for r in spark.read.text(f"{work}/release=v97/{name}").collect())
    layout, checks = read("layout_report"), read("check_report")
    assert "### `associations`" in layout and f"| `species_name` | `{HUMAN}` | 15 |" in layout and "| `evidence_code` | `TAS` | 12 |" in layout
    assert "| 1 | `stable_id` | `R-HSA-1` |" in layout and "| `fields` | `6` | 16 |" in layout
    assert "# Checks of v97" in checks and "| 4. node count | **PASS** |" in checks
    held = spark.read.parquet(f"{work}/release=v97/layout_values")
    counted = {(r["source"], r["column"], r["value"]): r["rows"] for r in held.filter("rows is not null").collect()}
    assert counted[("associations", "species_name", MOUSE)] == 1 and counted[("pathways", "fields", "other")] == 0
    assert spark.read.parquet(f"{work}/release=v97/offenders").isEmpty()


def test_members_of_another_source_are_sampled(spark, defined, tmp_path):
    theirs = spark.createDataFrame([("R-HSA-1", "1"), ("R-HSA-2", "9")], "key STRING, member STRING")
    theirs.write.parquet(str(tmp_path / "other"))
    chosen = settings(other_members=str(tmp_path / "other"), sample=2, seed=5, ceiling=2)
    results = {r["check"].split(".")[0]: r for r in I.run(spark, sources(tmp_path), str(tmp_path / "w"), chosen, defined).collect()}
    assert results["10"]["status"] == "WARN" and results["10"]["detail"].endswith("of 2 differ")
    assert results["4"]["status"] == "FAIL" and "above 2" in results["4"]["detail"]


def test_the_large_source_is_read_once(spark, defined, tmp_path):
    """Rows read from the association file: its own number, plus the first block for the header check."""
    paths = sources(tmp_path, associations=ASSOCIATIONS * 200)
    plans = []
    inner = I.watch_layout

    def watched(parsed, spec):
        if spec.name == "associations":
            counter = spark.sparkContext.accumulator(0)
            plans.append(counter)

            def count(batches):
                for batch in batches:
                    counter.add(batch.num_rows)
                    yield batch

            parsed = parsed.mapInArrow(count, parsed.schema)
        return inner(parsed, spec)

    I.watch_layout = watched
    try:
        I.run(spark, paths, str(tmp_path / "w"), settings(max_unresolved=0.5), defined)
    finally:
        I.watch_layout = inner
    assert plans[0].value == len(ASSOCIATIONS) * 200


def test_the_graph_is_shuffled_once(spark, done):
    """Writing a release needs one exchange of its statements; counting the stored set needs none of them."""
    _, work, _ = done
    loaded = read_releases(spark, f"{work}/quads")
    plan = I.C.chk_total(loaded, 1, 10**9, known_set=True)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan and "Exchange SinglePartition" in plan


def test_next_release_leaves_the_first(spark, done, defined, tmp_path):
    _, work, _ = done
    before = read_releases(spark, f"{work}/quads").filter("graph = 'urn:kg:release:v97'").count()
    fewer = [r for r in ASSOCIATIONS if r[0] != "P00002"]
    I.run(spark, sources(tmp_path, associations=fewer), work, settings(version="98", max_unresolved=0.5), defined)
    quads = read_releases(spark, f"{work}/quads")
    counts = {r["graph"]: r["count"] for r in quads.groupBy("graph").count().collect()}
    assert counts["urn:kg:release:v97"] == before and counts["urn:kg:release:v98"] < before


def test_failed_check_leaves_no_report(spark, defined, tmp_path):
    work = tmp_path / "work"
    results = I.run(spark, sources(tmp_path), str(work), settings(expected_nodes=30), defined)
    assert [r["check"] for r in results.filter("status = 'FAIL'").collect()] == ["4. node count"]
    assert not (work / "release=v97" / "characteristics").exists()


def test_a_failed_load_leaves_the_release(spark, done, defined, tmp_path):
    """Neither a failing check nor a failing write takes anything from the release that is there."""
    _, work, _ = done
    def state():
        quads = read_releases(spark, f"{work}/quads").groupBy("graph").count().collect()
        meta = read_metadata(spark, f"{work}/metadata").filter("s = 'urn:kg:release:v97'").collect()
        return sorted(map(tuple, quads)), sorted(map(tuple, meta), key=str), spark.read.parquet(f"{work}/release=v97/facts").count()

    before = state()
    fewer = [r for r in ASSOCIATIONS if r[0] != "P00002"]
    results = I.run(spark, sources(tmp_path, associations=fewer), work, settings(expected_nodes=30, max_unresolved=0.5), defined)
    assert results.filter("status = 'FAIL'").count() == 1 and state() == before
    assert spark.read.parquet(f"{work}/failed=v97/facts").count() < before[2]


def test_too_many_unresolved_rows_stop_the_job(spark, defined, tmp_path):
    with pytest.raises(IngestError, match="unresolved"):
        I.run(spark, sources(tmp_path), str(tmp_path / "w"), settings(max_unresolved=0.01), defined)
    assert not (tmp_path / "w" / "quads").exists()


@pytest.mark.parametrize("change, error", [
    (dict(pathways=PATHWAYS + [("R-HSA-1", "Another name", HUMAN)]), IngestError),
    (dict(relations=RELATIONS + [("R-HSA-1", "R-MMU-2")]), ScopeError),
    (dict(pathways=PATHWAYS + [("R-XXX-1", "x", "Unknown species")]), IngestError),
    (dict(associations=ASSOCIATIONS + [("P00001", "R-HSA-1", "XXX", HUMAN)]), IngestError),
    (dict(pathways=PATHWAYS[3:]), IngestError),
])
def test_bad_sources_stop_the_job(spark, defined, tmp_path, change, error):
    with pytest.raises(error):
        I.run(spark, sources(tmp_path, **change), str(tmp_path / "w"), settings(), defined)


def test_layout_section(spark, tmp_path):
    paths = sources(tmp_path, associations=ASSOCIATIONS + [("P1", "R-HSA-1", "TAS", HUMAN)])
    spec = I.LAYOUTS["associations"]
    parsed = I.read_strict_tsv(spark, paths["associations"], spec.columns, False, strict=False)
    text = I.layout_markdown(parsed, spec)
    assert "- rows: **17**" in text and "| 5 | `evidence_code` | `IEA` |" in text
    assert "- uniprot_accession:pattern: 1, first `P1`" in text
    values = {(r["column"], r["value"]): r["rows"] for r in I.layout_values(parsed, spec).collect()}
    assert values[("species_name", HUMAN)] == 16 and values[("number of fields", "6")] == 17
    assert values[("evidence_code", "TAS")] + values[("evidence_code", "IEA")] == 17


def test_undeclared_values_hide_no_others(spark):
    """However many values a closed column holds, each is counted."""
    spec = I.LAYOUTS["associations"]
    rows = spark.range(500).selectExpr(
        "'P00001' AS uniprot_accession", "'R-HSA-1' AS pathway_stable_id", "'https://x' AS pathway_browser_url",
        "'e' AS event_name", "concat('X', id) AS evidence_code", "'Homo sapiens' AS species_name", "6 AS n_fields",
    )
    values = I.layout_values(rows, spec)
    assert values.count() == 500 + 1 + 1 and values.filter("column = 'species_name'").collect()[0]["rows"] == 500


def test_codes_are_strict_without_layout_checks(spark):
    rows = spark.createDataFrame([("P1", "1", "XXX", HUMAN)], "accession STRING, pathway STRING, code STRING, species STRING")
    nodes = spark.createDataFrame([("1",)], "id STRING")
    aliases = spark.createDataFrame([("P1", "1")], "alias STRING, id STRING")
    with pytest.raises(UnknownCodeError, match="XXX"):
        I.build_facts(rows, nodes, aliases, settings())
    with pytest.raises(UnknownCodeError, match="Nobody"):
        I.build_facts(rows.withColumn("species", F.lit("Nobody")), nodes, aliases, settings())
    facts, _, fraction = I.build_facts(rows.withColumn("code", F.lit("TAS")), nodes, aliases, settings())
    assert facts.count() == 1 and fraction.collect()[0]["rows_in_scope"] == 1
