"""One key holds a third of all rows: results stay whole, plans stay free of hot gathers."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from kgspark.operators import diff, hierarchy, resolve, scope, sets, shapes, stats
from kgspark.plans import queries as N
from kgspark.plans.release import Release

ROWS = 30_000
HOT = ROWS // 3


@pytest.fixture(scope="module")
def joins_by_sorting(spark):
    """No side fits a broadcast, and skewed partitions are split already at this size."""
    settings = {
        "spark.sql.shuffle.partitions": "32",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
    }
    old = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield
    for key, value in old.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot_or(own):
    """0 for the first third of the ids, else the expression."""
    return F.when(F.col("id") < HOT, F.lit(0).cast("bigint")).otherwise(own)


@pytest.fixture(scope="module")
def raw(spark):
    return spark.range(ROWS).select(
        F.concat(F.lit("A"), hot_or(F.col("id") % 97 + 1).cast("string")).alias("accession"),
        (F.col("id") % 5_000).alias("pathway"), F.when(F.col("id") % 3 == 0, "T").otherwise("I").alias("code"),
    )


@pytest.fixture(scope="module")
def members(spark):
    return spark.range(ROWS).select(hot_or(F.col("id") % 500 + 1).alias("pathway"), F.col("id").alias("gene"))


def plan_after(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_accession(spark, raw, joins_by_sorting):
    aliases = spark.range(98).select(F.concat(F.lit("A"), F.col("id").cast("string")).alias("alias"), "id").unionByName(
        spark.createDataFrame([("A0", 1000)], "alias STRING, id LONG"))
    folded = resolve.collapse(raw)
    facts = resolve.resolve(folded, aliases)
    local = {tuple(r) for r in raw.collect()}
    want = {(g, p, c, a) for a, p, c in local for g in ([0, 1000] if a == "A0" else [int(a[1:])])}
    got = [tuple(r) for r in facts.collect()]
    assert len(got) == len(want) and set(got) == want
    assert "skew=true" in plan_after(facts)
    matches = dict(resolve.fanout_rows(folded, aliases).collect())
    assert matches == {1: ROWS - HOT, 2: HOT}


def test_hot_accession_combines_before_the_shuffle(raw):
    plan = resolve.collapse(raw)._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan


def test_hot_set(spark, members, joins_by_sorting):
    sizes = dict(sets.set_sizes(members).collect())
    assert sizes[0] == HOT and sum(sizes.values()) == ROWS
    pairs = spark.createDataFrame([(0, 1), (1, 0), (2, 0)], "child LONG, parent LONG")
    overlap = members.filter("pathway = 0").selectExpr("CAST(1 AS BIGINT) AS pathway", "gene").unionByName(members)
    got = {(r["child"], r["parent"]): r["common"] for r in sets.containment(pairs, overlap).collect()}
    assert got == {(0, 1): HOT, (1, 0): HOT, (2, 0): 0}


def test_a_third_of_all_sets_are_equal(spark, joins_by_sorting):
    same = spark.range(HOT).select(F.col("id").alias("pathway"), F.explode(F.array(F.lit(1), F.lit(2))).alias("gene"))
    own = spark.range(HOT, ROWS).select(F.col("id").alias("pathway"), F.col("id").cast("int").alias("gene"))
    groups = sets.identical_sets(same.unionByName(own)).collect()
    assert [tuple(r) for r in groups] == [(0, HOT, 2)]


def test_one_large_set_twice(spark, joins_by_sorting):
    big = spark.range(HOT).select(F.explode(F.array(F.lit(1), F.lit(2))).alias("pathway"), F.col("id").alias("gene"))
    near = spark.range(HOT - 1).select(F.lit(3).alias("pathway"), F.col("id").alias("gene"))
    assert [tuple(r) for r in sets.identical_sets(big.unionByName(near)).collect()] == [(1, 2, HOT)]


def test_no_operator_gathers_a_set(members, spark):
    nodes = spark.range(600).select("id", F.lit("x").alias("label"))
    for df in (
        sets.set_sizes(members), sets.hub_by_id(members), sets.set_size_distribution(nodes, members), sets.scoring_band(members),
        sets.reconcile_sets(members.toDF("key", "member"), members.toDF("key", "member")),
        shapes.reconcile_shapes(members, members),
    ):
        plan = df._jdf.queryExecution().executedPlan().toString()
        for gather in ("collect_set", "collect_list", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert gather not in plan


def test_hot_parent(spark, joins_by_sorting):
    """A third of all nodes hang below one parent, which has a chain above it."""
    chain = [(i, i - 1) for i in range(1, 6)]
    leaves = spark.range(10, 10 + HOT).select(F.col("id").alias("child"), F.lit(5).cast("bigint").alias("parent"))
    edges = spark.createDataFrame(chain, "child LONG, parent LONG").unionByName(leaves)
    nodes = edges.select(F.explode(F.array("child", "parent")).alias("id")).distinct()
    depths = dict(hierarchy.depth(nodes, edges).groupBy("depth").count().collect())
    assert depths == {**{i: 1 for i in range(6)}, 6: HOT}
    assert hierarchy.ancestors(edges).count() == 15 + 6 * HOT
    ids = nodes.filter("id <> 5")
    tally = dict(scope.scope_edge_tally(scope.classify_edges(edges, ids)).collect())
    assert tally == {"kept": 4, "mixed": HOT + 1}


def test_hot_label(spark, joins_by_sorting):
    old = spark.range(ROWS).select("id", F.when(F.col("id") < HOT, "same").otherwise(F.col("id").cast("string")).alias("label"))
    new = old.select((F.col("id") + ROWS).alias("id"), "label")
    changes = diff.release_diff(old, new)
    found = diff.successors(changes)
    assert found.count() == ROWS
    assert {r[0] for r in found.filter("label = 'same'").select("replaced_by").distinct().collect()} == {ROWS + HOT - 1}


def test_hot_gene(spark, joins_by_sorting):
    edges = spark.range(ROWS).select(hot_or(F.col("id") % 50 + 1).alias("gene"), F.col("id").alias("pathway"))
    gene = spark.range(51).select("id", F.concat(F.lit("G"), F.col("id").cast("string")).alias("symbol"), F.lit("t").alias("taxon"))
    none = spark.createDataFrame([], "id LONG, label STRING, taxon STRING")
    release = Release(none, none, gene, none, edges, none)
    top = N.hub_genes(release, 1).collect()[0]
    assert (top["symbol"], top["pathway_count"]) == ("G0", HOT)


def test_hot_value_distribution(spark):
    df = spark.range(ROWS).select(hot_or(F.col("id")).alias("v"))
    row = stats.distribution(df, "v").collect()[0]
    ordered = sorted([0] * HOT + list(range(HOT, ROWS)))
    assert (row["n"], row["p25"], row["median"], row["p95"]) == (
        ROWS, ordered[round(0.25 * (ROWS - 1))], ordered[round(0.5 * (ROWS - 1))], ordered[round(0.95 * (ROWS - 1))])
