"""The figures FIXTURES.md records for its stand-in views, from the library operators."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from kgspark.operators import diff, hierarchy, resolve, scope, sets, shapes, stats

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def views(spark):
    read = lambda name: spark.read.parquet(f"{SF_DIR}/{name}.parquet")
    part, supplier, lineitem = read("part"), read("supplier"), read("lineitem")
    below = part.filter("p_partkey > 0")
    hier = below.filter("p_partkey % 50 <> 0").selectExpr("p_partkey AS child", "p_partkey div 2 AS parent").unionByName(
        below.filter("p_partkey % 7 = 0").selectExpr("p_partkey AS child", "p_partkey div 3 AS parent")
    ).distinct()
    xref = supplier.filter("s_suppkey % 5 <> 0").selectExpr(
        "s_suppkey AS id", "s_name AS symbol", "concat('A', s_suppkey, '|A', s_suppkey + 7) AS aliases"
    )
    raw = lineitem.selectExpr(
        "concat('A', l_suppkey, CASE WHEN l_linenumber > 5 THEN concat('-', l_linenumber) ELSE '' END) AS accession",
        "l_partkey AS pathway", "l_returnflag AS code", "l_linestatus AS species",
    )
    aliases = resolve.alias_map(xref).cache()
    folded = resolve.collapse(raw.filter("species = 'F'")).cache()
    facts = resolve.resolve(folded, aliases).cache()
    return dict(
        node=part.selectExpr("p_partkey AS id", "p_name AS label", "p_type AS taxon"), hierarchy=hier.cache(),
        aliases=aliases, folded=folded, facts=facts, edges=resolve.participation_edges(facts).cache(),
        prev=part.filter("p_partkey % 17 <> 0").selectExpr("p_partkey AS id", "p_name AS label"),
        cur=part.filter("p_partkey % 13 <> 0").selectExpr(
            "CASE WHEN p_partkey % 34 = 1 THEN p_partkey + 1000000 ELSE p_partkey END AS id",
            "CASE WHEN p_partkey % 11 = 0 THEN p_brand ELSE p_name END AS label",
        ),
        small=lineitem.selectExpr("l_orderkey AS pathway", "concat(l_returnflag, l_linestatus) AS gene").distinct(),
    )


def test_facts_and_edges(views):
    facts = views["facts"]
    assert facts.count() == 45_472
    assert facts.distinct().count() == 45_472
    assert facts.select("gene").distinct().count() == 80
    assert facts.select("pathway").distinct().count() == 2_000
    assert views["edges"].count() == 39_946
    assert views["aliases"].count() == 160


def test_unresolved_base_accessions(views):
    lost = resolve.unresolved(views["folded"], views["aliases"]).withColumn(
        "base", F.split_part("accession", F.lit("-"), F.lit(1))
    ).groupBy("base").agg(F.sum("rows").alias("rows")).collect()
    assert {r["base"]: r["rows"] for r in lost} == {"A0": 323, "A5": 294}


def test_hierarchy(views):
    h = views["hierarchy"]
    assert h.count() == 2_245
    two = h.groupBy("child").count().filter("count > 1").count()
    assert (h.select("child").distinct().count(), two) == (1_965, 280)
    depths = hierarchy.depth(views["node"], h)
    assert depths.select("depth").distinct().count() == 12
    assert hierarchy.roots(views["node"], h).count() == 35
    assert hierarchy.ancestors(h).count() == 25_170
    assert hierarchy.find_cycle_nodes(h).count() == 0


def test_scope_edges(views):
    classed = scope.classify_edges(views["hierarchy"], views["node"].filter("taxon = 'PROMO'"))
    tally = {r["scope"]: r["edges"] for r in scope.scope_edge_tally(classed).collect()}
    assert (tally["kept"], tally["mixed"]) == (75, 619)


def test_sets(views):
    assert sets.containment(views["hierarchy"], views["edges"]).count() == 2_245
    row = stats.distribution(sets.all_set_sizes(views["node"], views["edges"]), "genes").collect()[0]
    assert (row["p25"], row["median"], row["p75"]) == (16, 20, 23)
    groups = sets.identical_sets(views["small"])
    total = groups.agg(F.count("*"), F.sum("sets"), F.max("sets")).collect()[0]
    assert tuple(total) == (63, 14_743, 301)


def test_diff(views):
    changes = diff.release_diff(views["prev"], views["cur"])
    counts = {r["change"]: r["nodes"] for r in diff.diff_counts(changes).collect()}
    assert counts == {"retired": 199, "added": 163, "relabelled": 154}
    assert diff.successors(changes).count() == 188


def test_reconciliation(views):
    row = shapes.reconcile_shapes(views["facts"], views["edges"].filter("gene % 9 <> 0")).collect()[0]
    assert (row["unsupported"], row["unreachable"], row["pairs"]) == (0, 4_406, 39_946)
