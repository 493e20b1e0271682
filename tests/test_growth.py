"""What grows with the input: results stay whole, rows are moved once, no table of a loop is broadcast by the size of its files."""

from __future__ import annotations

from pyspark.sql import functions as F

from kgspark.operators import digests, hierarchy, quads, sets, shapes
from kgspark.plans import checks
from kgspark.plans.release import Release
from workload.queries import QUERIES
from workload.tables import Tables


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_statements_are_counted_without_moving_their_text(spark):
    rows = spark.createDataFrame([("g", "s", None), ("g", "s", None), ("g", None, "s"), ("g", "s", "")], "graph STRING, s STRING, o STRING")
    assert digests.distinct_count(rows).first()["rows"] == 3
    assert checks.chk_total(rows, 3, 3).first()["status"] == "PASS"
    exchanges = [line for line in plan_of(checks.chk_total(rows, 3, 3)).split("\n") if "Exchange hashpartitioning" in line]
    assert exchanges and not any("graph#" in line or "s#" in line for line in exchanges)


def test_acceptance_moves_no_statement_text(spark):
    tables = Tables(spark, "/root/testdata/sf0.001")
    plan = plan_of(QUERIES["acceptance"](tables))
    assert not any("Exchange hashpartitioning" in line and "o_datatype#" in line for line in plan.split("\n"))
    assert not any("Scan parquet" in line and "o_datatype#" in line for line in plan.split("\n"))


def test_patterns_store_and_broadcast_no_statements(spark):
    plan = plan_of(QUERIES["bgp_match"](Tables(spark, "/root/testdata/sf0.001")))
    assert "o_datatype#" not in "".join(line for line in plan.split("\n") if "Scan parquet" in line)
    assert "BroadcastHashJoin" not in plan


def test_pairs_step_up_once_and_rounds_are_removed(spark, tmp_path):
    """A diamond, a cycle with a tail and a way out of it; a stored table per round is not left behind."""
    edges = spark.createDataFrame([(4, 2), (4, 3), (2, 1), (3, 1), (11, 12), (12, 11), (13, 12), (11, 2)], "child LONG, parent LONG")
    found = hierarchy.ancestors(edges)
    above = {4: {2, 3, 1}, 2: {1}, 3: {1}, 11: {11, 12, 2, 1}, 12: {11, 12, 2, 1}, 13: {11, 12, 2, 1}}
    assert sorted(map(tuple, found.collect())) == sorted((n, a) for n, up in above.items() for a in up)
    folders = {f.rsplit("/", 1)[0].rsplit("/", 1)[1] for f in found.inputFiles()}
    assert folders == {"level=-1"}


def test_depths_broadcast_no_side(spark):
    edges = spark.createDataFrame([(2, 1), (3, 2)], "child LONG, parent LONG")
    nodes = spark.createDataFrame([(1,), (2,), (3,)], "id LONG")
    found = hierarchy.depth(nodes, edges)
    plan = plan_of(found)
    assert "BroadcastHashJoin" not in plan and plan.count("Scan parquet") == 1
    assert dict(found.collect()) == {1: 0, 2: 1, 3: 2}


def test_leaves_take_no_part_in_rounds(spark, monkeypatch):
    """A tree, a chain, a cycle with leaves below it and ones that hang below both, an edge without a parent."""
    tree = [(c, c // 2) for c in range(2, 256)]
    chain = [(300, 1)] + [(c, c - 1) for c in range(301, 312)]
    loop = [(401, 402), (402, 401), (403, 402), (404, 403), (405, 404), (405, 311), (406, 7), (406, 401), (500, None), (1, 1000)]
    edges = spark.createDataFrame(tree + chain + loop + [(2, 1)], "child LONG, parent LONG")
    nodes = spark.range(520)
    seen, peel = [], hierarchy.peel
    monkeypatch.setattr(hierarchy, "peel", lambda e: seen.append(e.count()) or peel(e))
    found = dict(hierarchy.depth(nodes, edges).collect())
    depths = {1: 1}
    for c, p in tree + chain:
        depths[c] = depths[p] + 1
    endless = {401, 402, 403, 404, 405, 406}
    assert found == {n: None if n in endless else 1 if n == 500 else depths.get(n, 0) for n in range(520)}
    assert seen == [sum(1 for c, _ in tree if c < 32) + 1 + 10 + 2]
    monkeypatch.setattr(hierarchy, "LAYERS", 0)
    assert dict(hierarchy.depth(nodes, edges).collect()) == found


def test_violations_of_parts_come_from_one_grouping(spark):
    edges = spark.createDataFrame([(2, 1), (3, 2)], "child LONG, parent LONG")
    members = spark.createDataFrame([(7, 3), (7, 2), (7, 1), (8, 3)], "gene LONG, pathway LONG")
    parts = {"all": F.lit(True), "low": F.col("pathway") > 1}
    assert dict(hierarchy.closure_violation_counts(members, edges, parts).collect()) == {"all": 1, "low": 2}
    assert sorted(map(tuple, hierarchy.closure_violations(members, edges).collect())) == [(8, 2)]


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


def test_statements_of_a_release_are_counted_on_its_tables(spark):
    """Objects that are lost or empty make no statement, repeated pairs make one; a part without any has no row."""
    release = Release(
        spark.createDataFrame([(1, "n", "t"), (2, None, "t"), (3, "n", None)], "id LONG, label STRING, taxon STRING"),
        spark.createDataFrame([(2, 1), (2, 1), (3, 1), (3, None)], "child LONG, parent LONG"),
        spark.createDataFrame([(7, "", "t"), (8, None, None), (9, "g", "t")], "id LONG, symbol STRING, taxon STRING"),
        spark.createDataFrame([(7, 1, "A", "P1"), (8, None, None, "P2"), (None, 2, "R", None)], "gene LONG, pathway LONG, code STRING, accession STRING"),
        spark.createDataFrame([(7, 1), (8, None)], "gene LONG, pathway LONG"),
        spark.createDataFrame([(1, "x"), (1, "x"), (2, None)], "pathway LONG, term STRING"),
    )
    emitted = quads.statements_per_part(release.quads("v1", "infores:x"))
    counted = release.statements_per_part("infores:x")
    assert rows(counted) == rows(emitted) and counted.schema["statements"].dataType == emitted.schema["statements"].dataType
    plan = plan_of(counted)
    assert "Generate" not in plan and "sha2" not in plan and "concat" not in plan
    none = Release(release.node, release.hierarchy, release.gene, release.facts, release.participation.limit(0), release.crosswalk)
    assert {r["part"] for r in none.statements_per_part("infores:x").collect()} == {"pathways", "associations", "crosswalk"}


def test_overlaps_join_packs_and_not_members(spark, monkeypatch):
    """Sets in one pack and in several, unequal ones, an empty parent, a child that is no set, a null gene, repeated edges."""
    held = [(1, g) for g in range(40)] + [(2, g) for g in range(20, 60)] + [(3, 5), (4, 99), (5, None), (5, 5)]
    members = spark.createDataFrame(held, "pathway LONG, gene LONG")
    edges = spark.createDataFrame([(2, 1), (1, 2), (3, 1), (3, 1), (4, 1), (5, 3), (3, 8), (8, 1)], "child LONG, parent LONG")
    for limit in (500_000, 10):
        monkeypatch.setattr(sets, "ROWS_A_TASK", limit)
        packed = sets.packs(members, 62, is_set=True)
        assert packed.agg(F.max(F.size("members"))).first()[0] == (40 if limit > 62 else packed.agg(F.max("genes")).first()[0])
        assert (packed.filter("pathway = 1").count() == 1) == (limit > 62)
        found = sets.packed_containment(edges, packed)
        assert rows(found) == rows(sets.containment(edges, members, is_set=True))
        assert rows(sets.packed_fingerprints(packed)) == rows(sets.fingerprints(members, 2))
        assert not any("Exchange" in line and "gene#" in line for line in plan_of(found).split("\n"))


def test_equal_sets_are_proved_on_packs(spark, monkeypatch):
    held = [(p, g) for p in (1, 2, 3) for g in range(30)] + [(4, g) for g in range(29)] + [(5, 7), (6, 7), (7, 8)]
    members = spark.createDataFrame(held, "pathway LONG, gene LONG")
    for limit in (500_000, 10):
        monkeypatch.setattr(sets, "ROWS_A_TASK", limit)
        packed = sets.packs(members, 30, is_set=True)
        prints = sets.packed_fingerprints(packed)
        want = rows(sets.identical_members(members, is_set=True))
        assert rows(sets.identical_members(members, is_set=True, prints=prints, packed=packed)) == want
        # Fingerprints that collide do not pass the proof on packs.
        weak = prints.withColumn("f0", F.lit(0).cast("bigint")).withColumn("f1", F.lit(0).cast("bigint"))
        assert rows(sets.identical_members(members, is_set=True, prints=weak, packed=packed)) == want


def test_shapes_agree_by_digest_and_differ_by_count(spark):
    facts = spark.createDataFrame(
        [(1, 1, "A", "x"), (1, 1, "R", "x"), (2, 1, "A", "y"), (None, 1, "A", "z")], "gene LONG, pathway LONG, code STRING, accession STRING"
    )
    edges = shapes.supported_edges(facts)
    agreed = shapes.shape_agreement(facts, edges)
    assert rows(agreed) == rows(shapes.shape_agreement(facts, edges.select("gene", "pathway")))
    assert agreed.first()["matches"] and "Exchange" not in plan_of(agreed)
    extra = spark.createDataFrame([(9, 9, 1)], "gene LONG, pathway LONG, associations LONG")
    wrong = spark.createDataFrame([(2, 1, 1)], "gene LONG, pathway LONG, associations LONG")
    doubtful = (
        edges.unionByName(extra), edges.unionByName(extra.withColumn("associations", F.lit(0).cast("bigint"))), edges.filter("gene = 1"),
        edges.limit(0), edges.filter("gene = 1").unionByName(wrong), edges.filter("gene = 1").unionByName(extra),
    )
    for other in doubtful:
        exact = shapes.shape_agreement(facts, other.select("gene", "pathway"))
        assert rows(shapes.shape_agreement(facts, other)) == rows(exact) and not exact.first()["matches"]
    none = facts.limit(0)
    assert rows(shapes.shape_agreement(none, shapes.supported_edges(none))) == rows(shapes.shape_agreement(none, none.select("gene", "pathway")))


def test_characteristics_make_no_statements_and_group_no_pairs_again(spark):
    plan = plan_of(QUERIES["characteristics"](Tables(spark, "/root/testdata/sf0.001")))
    assert "sha2" not in plan and "biolink:primary_knowledge_source" not in plan
    assert not any("Exchange hashpartitioning(gene#" in line for line in plan.split("\n"))


def closed_by_hand(held, pairs):
    up = {}
    for c, p in pairs:
        if c is not None:
            up.setdefault(c, set()).add(p)
    closed = set(held)
    while True:
        more = {(g, p) for g, c in closed for p in up.get(c, ())} - closed
        if not more:
            return closed
        closed |= more


def test_memberships_climb_as_arrays(spark, monkeypatch):
    """Two hubs, a diamond, a cycle with ways in and out, a lost parent, null genes and pathways, in one share and in several."""
    pairs = [(c, c % 2) for c in range(2, 40)] + [(c, c // 2) for c in range(40, 80)] + [(0, 100), (1, 100), (1, 101), (50, None)]
    pairs += [(201, 202), (202, 203), (203, 201), (204, 201), (202, 5), (205, 205), (51, None)]
    held = [(g, (7 * g + 3 * k) % 80) for g in range(30) for k in range(4)] + [(1, 204), (2, 205), (3, 202), (None, 60), (4, None), (5, 999)]
    edges = spark.createDataFrame(pairs + pairs[:9], "child LONG, parent LONG")
    members = spark.createDataFrame(held + held[:20], "gene LONG, pathway LONG")
    want = sorted(closed_by_hand(held, pairs), key=str)
    inner = {c for c, _ in pairs}
    low = {(g, p) for g, p in want if p in inner}
    holes = {(g, p) for g, c in low for k, p in pairs if k == c} - low
    assert holes
    parts = {"closed": F.lit(True), "low": F.col("inner")}
    children = spark.createDataFrame([(c,) for c in inner], "pathway LONG").withColumn("inner", F.lit(True))
    for rows_a_task, fan, few in ((500_000, 16, 0), (7, 1, 100_000)):
        monkeypatch.setattr(hierarchy, "ROWS_A_TASK", rows_a_task)
        monkeypatch.setattr(hierarchy, "FAN", fan)
        monkeypatch.setattr(hierarchy, "FEW_ROWS", few)
        packed = hierarchy.closed_packs(members, edges)
        assert packed.count() == packed.select("pathway", "share").distinct().count()
        assert (packed.agg(F.max("share")).first()[0] == 0) == (rows_a_task > 30)
        assert rows(packed.select("pathway", F.explode("genes").alias("gene"))) == want
        marked = packed.join(children, "pathway", "left")
        counted = dict(hierarchy.packed_violation_counts(marked, edges, parts).collect())
        assert counted == {"closed": 0, "low": len(holes)}
        loose = packed.select("pathway", "share", F.expr("filter(genes, g -> g IS NULL OR g % 3 > 0 OR pathway > 20)").alias("genes"))
        by_rows = loose.select(F.explode("genes").alias("gene"), "pathway")
        some = {"all": F.lit(True), "odd": F.col("pathway") % 2 == 1, "none": F.lit(False)}
        exact = dict(hierarchy.closure_violation_counts(by_rows, edges, some).collect())
        assert dict(hierarchy.packed_violation_counts(loose, edges, some).collect()) == exact and exact["all"] > 0 and exact["none"] == 0
    assert rows(hierarchy.gene_ancestors(members, edges).withColumnRenamed("ancestor", "pathway")) == want
    none = hierarchy.closed_packs(members.limit(0), edges.limit(0))
    assert none.count() == 0 and dict(hierarchy.packed_violation_counts(none, edges.limit(0), some).collect()) == {"all": 0, "odd": 0, "none": 0}


def test_closed_memberships_move_no_row_for_a_pair(spark, monkeypatch):
    """The closed pairs of the query are arrays from end to end: no table of single pairs is closed or grouped."""
    def refuse(*_):
        raise AssertionError("pairs are moved one by one")
    monkeypatch.setattr(hierarchy, "closed_pairs", refuse)
    monkeypatch.setattr(hierarchy, "_held_and_implied", refuse)
    found = dict(QUERIES["closed_memberships"](Tables(spark, "/root/testdata/sf0.001")).collect())
    assert found["closed"] == 0 and found["without roots"] > 0
