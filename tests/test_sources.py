"""Scans and sinks on small files."""

from __future__ import annotations

import gzip
import hashlib
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from kgspark.errors import IngestError, LayoutError, PublishError
from kgspark.operators import rules, terms
from kgspark.session import ensure_checkpoint_dir
from kgspark.sources import manifests, snapshots, tsv
from kgspark.sources.releases import append_retired, retired_quads


def write(path, text):
    path.write_text(text, encoding="utf-8", newline="")
    return str(path)


def test_strict_scan_keeps_quotes_and_skips_blank_lines(spark, tmp_path):
    path = write(tmp_path / "x_All_Levels.txt", 'a\t"b\tc\n\n  \r\nd\te"\t\r\n')
    rows = tsv.read_strict_tsv(spark, path, ["p", "q", "r"], False, "_All_Levels").collect()
    assert sorted(tuple(r) for r in rows) == [("a", '"b', "c"), ("d", 'e"', "")]


def test_strict_scan_reads_gzip(spark, tmp_path):
    path = tmp_path / "x.txt.gz"
    with gzip.open(path, "wt", encoding="utf-8") as out:
        out.write("a\tb\n")
    assert tsv.read_strict_tsv(spark, str(path), ["p", "q"], False).collect()[0]["q"] == "b"


def test_strict_scan_errors(spark, tmp_path):
    path = write(tmp_path / "x.txt", "a\tb\nc\n")
    with pytest.raises(LayoutError, match="expected 2 fields, got 1"):
        tsv.read_strict_tsv(spark, path, ["p", "q"], False)
    loose = tsv.read_strict_tsv(spark, path, ["p", "q"], False, strict=False)
    assert tsv.arity_violations(loose, 2).count() == 1
    with pytest.raises(LayoutError, match="file name"):
        tsv.read_strict_tsv(spark, path, ["p", "q"], False, "_All_Levels")
    headed = write(tmp_path / "h.txt", "Identifier\tName\n1\tx\n")
    with pytest.raises(LayoutError, match="header expected: False"):
        tsv.read_strict_tsv(spark, headed, ["p", "q"], False)
    with pytest.raises(LayoutError, match="header expected: True"):
        tsv.read_strict_tsv(spark, path, ["p", "q"], True)


def test_header_of_every_file_is_dropped(spark, tmp_path):
    for i in range(3):
        write(tmp_path / f"part{i}.txt", f"Identifier\tName\n{i}\tx\n")
    rows = tsv.read_strict_tsv(spark, str(tmp_path), ["id", "name"], True).collect()
    assert sorted(r["id"] for r in rows) == ["0", "1", "2"]


def test_only_the_first_line_is_a_header(spark, tmp_path):
    """A later line that equals the header is a row, and a line with a control character is kept whole."""
    write(tmp_path / "a.txt", "Identifier\tName\n1\tx\nIdentifier\tName\n2\ty\x01z\n")
    rows = tsv.read_strict_tsv(spark, str(tmp_path), ["id", "name"], True).collect()
    assert sorted(tuple(r) for r in rows) == [("1", "x"), ("2", "y\x01z"), ("Identifier", "Name")]


def test_jobs_do_not_grow_with_the_files(spark, tmp_path):
    def jobs(n):
        folder = tmp_path / f"n{n}"
        folder.mkdir()
        for i in range(n):
            write(folder / f"part{i:03}.txt", f"Identifier\tName\n{i}\tx\n")
        spark.sparkContext.setJobGroup(f"scan{n}", "scan")
        try:
            assert tsv.read_strict_tsv(spark, str(folder), ["id", "name"], True).count() == n
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"scan{n}"))

    assert jobs(50) == jobs(3)


def test_keyed_files_need_one_header(spark, tmp_path):
    write(tmp_path / "a.tsv", 'k\tv\n1\t"two\nlines"\n')
    assert [tuple(r) for r in tsv.read_keyed_tsv(spark, str(tmp_path), ["k", "v"]).collect()] == [("1", "two\nlines")]
    write(tmp_path / "b.tsv", "v\tk\n1\t2\n")
    with pytest.raises(Exception, match="header"):
        tsv.read_keyed_tsv(spark, str(tmp_path), ["k", "v"]).collect()


def test_manifest_of_a_file_larger_than_a_chunk(spark, tmp_path):
    data = bytes(range(256)) * 1000
    (tmp_path / "big.bin").write_bytes(data)
    row = manifests.file_manifest(spark, str(tmp_path), chunk=1000).collect()[0]
    assert (row["bytes"], row["md5"]) == (len(data), hashlib.md5(data).hexdigest())


def test_publication_of_an_unstable_input(spark, tmp_path):
    """Marker and data agree although the input differs each time it is evaluated."""
    df = spark.range(50).select(F.col("id"), F.expr("uuid()").alias("v"))
    snapshots.publish_snapshot(df, str(tmp_path), "nf", "2026-09-21")
    folder = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    snapshots.publish_snapshot(df, str(tmp_path), "nf", "2026-09-22")
    assert set(folder.iterdir()) == before  # nothing is left in the shared folder
    stored = snapshots.read_snapshot(spark, str(tmp_path), "nf", "2026-09-21")
    marker = spark.read.schema(snapshots.MARKER_SCHEMA).json(f"{tmp_path}/nf/2026-09-21/_manifest").collect()[0]
    assert tuple(snapshots.snapshot_fingerprint(stored).collect()[0]) == (marker["rows"], marker["folded"], marker["mixed"])


def test_keyed_scan_uses_quoting(spark, tmp_path):
    path = write(tmp_path / "d.tsv", 'hgnc_id\tname\tsymbol\tuniprot_ids\nHGNC:1\tx\t"SO""D\t1"\tP1|P2\n \ty\tZ\tP3\nHGNC:2\t\tFUS\t\n')
    rows = tsv.read_keyed_tsv(spark, path, ["hgnc_id", "symbol", "uniprot_ids"]).orderBy("hgnc_id").collect()
    assert [(r["hgnc_id"], r["symbol"], r["uniprot_ids"]) for r in rows] == [
        ("HGNC:1", 'SO"D\t1', "P1|P2"), ("HGNC:2", "FUS", None)]
    with pytest.raises(LayoutError, match="no column nope"):
        tsv.read_keyed_tsv(spark, path, ["hgnc_id", "nope"])


def test_layout_header_rules():
    spec = rules.LayoutSpec("x", ("Identifier", "Name"), (), has_header=True, expected_header=("Identifier", "Name"),
                            id_patterns=(r"^R-[A-Z]{3}-\d+$",))
    assert rules.header_matches(["Identifier", "Name"], spec) == []
    assert len(rules.header_matches(["R-HSA-1", "x"], spec)) == 2
    assert len(rules.header_matches(["Identifier", "Other"], spec)) == 1


def test_layout_violations_raise(spark):
    spec = rules.LayoutSpec("x", ("a", "b"), (rules.ColumnRule("a", "pattern", r"^\d+$"), rules.ColumnRule("b", "enum", ("y",))))
    lines = spark.createDataFrame([("1\ty",), ("x\ty",), ("2",), ("3\tY ",)], "value STRING")
    parsed = tsv.split_lines(lines, spec.columns)
    found = {r["rule"]: (r["violations"], r["sample"]) for r in rules.verify_layout(parsed, spec).collect()}
    assert found == {"arity": (1, "1"), "not_empty": (0, None), "a:pattern": (1, "x"), "b:enum": (1, "Y ")}
    with pytest.raises(LayoutError, match="a:pattern"):
        rules.verify_layout(parsed, spec, strict=True)
    with pytest.raises(LayoutError, match="not_empty"):
        rules.verify_layout(parsed.limit(0), spec, strict=True)


def test_manifests(spark, tmp_path):
    folder = tmp_path / "files"
    folder.mkdir()
    write(folder / "a.txt", "a\tb\n")
    write(folder / "page.txt", "  \n<html>\tno</html>")
    rows = {r["filename"]: r for r in manifests.file_manifest(spark, str(folder), "https://example.org/").collect()}
    assert rows["a.txt"]["md5"] == hashlib.md5(b"a\tb\n").hexdigest()
    assert rows["a.txt"]["bytes"] == 4 and rows["a.txt"]["retrieved_from"] == "https://example.org/a.txt"
    payloads = spark.read.format("binaryFile").load(str(folder))
    sniffed = {r["path"].rsplit("/", 1)[-1]: r["tabular"] for r in manifests.sniff_tabular(payloads).collect()}
    assert sniffed == {"a.txt": True, "page.txt": False}
    ours = manifests.file_manifest(spark, str(folder))
    other = ours.withColumn("md5", F.when(F.col("filename") == "a.txt", F.lit("0")).otherwise(F.col("md5")))
    assert manifests.compare_manifests(ours, ours, strict=True).filter("same").count() == 2
    with pytest.raises(IngestError, match="a.txt"):
        manifests.compare_manifests(ours, other, strict=True)
    missing = other.filter("filename <> 'a.txt'")
    assert manifests.compare_manifests(ours, missing, strict=True).count() == 1


def test_manifest_header(spark, tmp_path):
    path = write(tmp_path / "m.tsv", (
        "# Source manifest\n# provenance (authoritative): https://doi.org/1\n# concept DOI: https://doi.org/2\n"
        "# published: 2026-06  license: cc-by-4.0\nfilename\tbytes\tmd5\tretrieved_from\na.txt\t12\tx\ty\nb.txt\tmany\tx\ty\n"))
    header, files = manifests.read_manifest(spark, path)
    assert {r["key"]: r["value"] for r in header.collect()} == {
        "provenance": "https://doi.org/1", "concept_doi": "https://doi.org/2", "published": "2026-06", "license": "cc-by-4.0"}
    assert {r["filename"]: r["bytes"] for r in files.collect()} == {"a.txt": 12, "b.txt": None}


def test_term_scans_of_files(spark, tmp_path):
    base = "https://example.org/model#"
    write(tmp_path / "new.ttl", (
        f"@prefix m: <{base}> .\n# m:commented\nHGNC:1 m:uses P:1, P:2 .\n<urn:m:release> m:uses <{base}Full> .\n"))
    write(tmp_path / "old.ttl", f"@prefix m: <https://example.org/other#> .\nHGNC:1 m:uses P:1 ; a <{base}Full> .\n")
    found = terms.emitted_terms(tsv.read_lines(spark, str(tmp_path)), base)
    assert {r["term"]: r["uses"] for r in found.collect()} == {"uses": 2, "Full": 2}
    model = write(tmp_path / "model.txt", (
        f"@prefix m: <{base}> .\n# m:no\nm:uses a owl:ObjectProperty ;\n    rdfs:range m:OnlyMentioned .\n<{base}Full> a owl:Class .\n\nother:x a y .\n"))
    defined = terms.defined_terms(tsv.read_lines(spark, model), base, "m")
    assert {r["term"] for r in defined.collect()} == {"uses", "Full"}


@pytest.mark.parametrize(
    "line, terms_of_ex",
    [
        ("b.ex:C x/ex:D =ex:E |ex:F é.ex:G <ex:H (ex:I", "CDEFGHI"),
        ("aex:A éex:B _ex:C 5ex:D -ex:E #ex:F :ex:G urn:ex:H a-ex:I", ""),
        ("ex:A ex:Bex:C ex:D.ex:E ex:F,ex:G;ex:H a:b.ex:I a:.ex:J", "ADEFGHIJ"),
    ],
)
def test_labels_inside_longer_names(spark, line, terms_of_ex):
    """Only : \\w # - before a label hide it; ``Bex`` is a local name of its own."""
    rows = [("f", "@prefix ex: <urn:m#> ."), ("f", line), ("g", "@prefix other: <urn:m#> ."), ("g", line)]
    found = terms.emitted_terms(spark.createDataFrame(rows, "file STRING, line STRING"), "urn:m#").collect()
    assert "".join(sorted(r["term"] for r in found if len(r["term"]) == 1)) == terms_of_ex
    assert all(r["uses"] == 1 for r in found)


def test_the_empty_label(spark):
    rows = [("f", "@prefix : <urn:m#> ."), ("f", ":A x.:B x:C (:D ::E")]
    found = terms.emitted_terms(spark.createDataFrame(rows, "file STRING, line STRING"), "urn:m#").collect()
    assert sorted(r["term"] for r in found) == ["A", "B", "D"]


def test_results_in_three_formats(spark, tmp_path):
    df = spark.createDataFrame([("SOD1", 3)], "symbol STRING, n INT")
    for fmt, line in (("tsv", "SOD1\t3"), ("csv", "SOD1,3"), ("json", '{"symbol":"SOD1","n":3}')):
        path = str(tmp_path / fmt)
        tsv.write_result(df, path, fmt)
        assert line in [r[0] for r in spark.read.text(path).collect()]
    with pytest.raises(ValueError):
        tsv.write_result(df, str(tmp_path / "x"), "xml")


def test_unresolved_report_order(spark, tmp_path):
    rows = [("P2", 1, "R-1", "TAS"), ("P1-2", 5, "R-2", "IEA")]
    df = spark.createDataFrame(rows, "accession STRING, rows LONG, example_pathway STRING, evidence STRING")
    tsv.write_unresolved_report(df, str(tmp_path / "u"))
    back = spark.read.option("sep", "\t").option("header", True).csv(str(tmp_path / "u"))
    assert back.columns == ["accession", "rows_dropped", "example_pathway", "evidence_code"]
    assert sorted(r["accession"] for r in back.collect()) == ["P1-2", "P2"]


def test_history_only_grows(spark, tmp_path):
    path = str(tmp_path / "retired")
    schema = "id STRING, label STRING, last_seen STRING, retired_in STRING, replaced_by STRING"
    first = spark.createDataFrame([("1", "a", "V96", "V97", None)], schema)
    second = spark.createDataFrame([("2", "b", "V97", "V98", "9")], schema)
    append_retired(first, path)
    append_retired(first, path)
    append_retired(second, path)
    history = spark.read.parquet(path)
    assert sorted((r["id"], r["retired_in"]) for r in history.collect()) == [("1", "V97"), ("2", "V98")]
    quads = retired_quads(history, "urn:kg:retired", "NCBITaxon:9606")
    assert quads.count() == 6 + 7
    assert quads.filter("p = 'dcterms:isReplacedBy'").collect()[0]["o"] == "P:9"


@pytest.mark.parametrize("snapshot", ["v97", "2026-9-21", "20260921", "latest", "2026-09-21/", "", "2026-09-21\n"])
def test_bad_snapshot_keys(snapshot):
    with pytest.raises(PublishError):
        snapshots.snapshot_path("/r", "nf", snapshot)


@pytest.mark.parametrize("portal", ["NF", "nf/2026", "-nf", "nf_osi", ""])
def test_bad_portals(portal):
    with pytest.raises(PublishError):
        snapshots.snapshot_path("/r", portal, "2026-09-21")


@pytest.mark.parametrize("portal", ["nf", "amp-als", "nf2"])
def test_good_portals(portal):
    assert snapshots.snapshot_path("/r/", portal, "2026-09-21") == f"/r/{portal}/2026-09-21"


def test_publication(spark, tmp_path):
    root = str(tmp_path)
    df = spark.createDataFrame([(1, "a"), (2, None)], "k INT, v STRING")
    assert snapshots.list_published(spark, root).count() == 0
    target = snapshots.publish_snapshot(df, root, "nf", "2026-09-21")
    assert snapshots.read_snapshot(spark, root, "nf", "2026-09-21").count() == 2
    with pytest.raises(PublishError, match="identical"):
        snapshots.publish_snapshot(df.repartition(3), root, "nf", "2026-09-21", allow_existing=True)
    changed = df.unionByName(df.limit(1))
    with pytest.raises(PublishError, match="not empty"):
        snapshots.publish_snapshot(changed, root, "nf", "2026-09-21")
    snapshots.publish_snapshot(changed, root, "nf", "2026-09-21", allow_existing=True)
    assert snapshots.list_published(spark, root).collect()[0]["rows"] == 3
    with pytest.raises(PublishError, match="nothing"):
        snapshots.publish_snapshot(df.limit(0), root, "nf", "2026-09-22")
    # Data without its marker is not published.
    df.write.parquet(f"{root}/nf/2026-10-01/data")
    assert snapshots.list_published(spark, root).count() == 1
    with pytest.raises(PublishError, match="not published"):
        snapshots.read_snapshot(spark, root, "nf", "2026-10-01")
    assert target.endswith("nf/2026-09-21")


def test_fingerprint_sees_nulls_and_duplicates(spark):
    mark = lambda rows: tuple(snapshots.snapshot_fingerprint(spark.createDataFrame(rows, "a STRING, b STRING")).collect()[0])
    assert mark([("x", "y"), ("p", "q")]) == mark([("p", "q"), ("x", "y")])
    marks = [mark([("x", None)]), mark([(None, "x")]), mark([("x", "")]), mark([("x", "-")]), mark([("x", None)] * 2)]
    assert len(set(marks)) == len(marks)
