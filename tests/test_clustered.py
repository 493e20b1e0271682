"""Stored order: the same answers, rows that lookups do not read, joins without an exchange."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from kgspark.plans import queries as N
from kgspark.plans.release import Release
from kgspark.sources import clustered as K


@pytest.fixture(scope="module")
def release(spark):
    """Gene 7 holds a third of all facts."""
    facts = spark.range(120_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 997).alias("gene"), (F.col("id") * 7919 % 4001).alias("pathway"),
        F.when(F.col("id") % 5 == 0, "A").otherwise("R").alias("code"), F.concat(F.lit("P"), F.col("id") % 11).alias("accession"),
    ).distinct()
    nodes = spark.range(4001).selectExpr("id", "concat('n', id) AS label", "'t' AS taxon")
    genes = spark.range(997).selectExpr("id", "concat('G', id div 2) AS symbol", "'t' AS taxon")
    return Release(
        nodes, spark.range(1, 4001).selectExpr("id AS child", "id div 2 AS parent"), genes, facts, facts.select("gene", "pathway").distinct(),
        spark.range(50).selectExpr("id AS pathway", "concat('T', id) AS term"),
    ).stored()


@pytest.fixture(scope="module")
def stored(spark, release, tmp_path_factory):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small ranges would become one file
    yield K.store_clustered(release, str(tmp_path_factory.mktemp("clustered")))
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def rows_read(spark, df) -> int:
    """Rows that the stages of one action take in from storage."""
    store = spark.sparkContext._jsc.sc().statusStore()
    none = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0)
    total = lambda: sum(s.inputRecords() for s in (lambda x: [x.apply(i) for i in range(x.size())])(store.stageList(None, False, False, none, None)))
    before = total()
    df.collect()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    return total() - before


@pytest.mark.parametrize("name, arguments", [
    ("gene-pathways", {"symbol": "G250"}), ("gene-pathway-count", {"symbol": "G3"}), ("evidence-breakdown", {"symbol": "G9"}),
    ("terms-for-gene", {"symbol": "G3"}), ("shared-pathways", {"a": "G3", "b": "G4"}), ("gene-pathways", {"symbol": "absent"}),
])
def test_focused_queries(release, stored, name, arguments):
    small = K.focused(stored, [v for v in arguments.values()])
    ours, theirs = N.run_named(small, name, **arguments), N.run_named(release, name, **arguments)
    assert sorted(map(tuple, ours.collect())) == sorted(map(tuple, theirs.collect()))


def test_lookups_skip_rows(spark, release, stored):
    total = release.facts.count()
    small = K.focused(stored, ["G400"])
    assert "In" in small.facts._jdf.queryExecution().executedPlan().toString()
    assert rows_read(spark, small.facts) < total / 2 and small.facts.count() == release.facts.filter("gene in (800, 801)").count()


def test_a_hot_gene_is_dealt_to_several_files(spark, stored):
    holding = stored.facts.filter("gene = 7").select(F.input_file_name().alias("f")).distinct().count()
    assert holding > 1 and stored.facts.count() == stored.facts.distinct().count()


def test_many_ids_are_joined(release, stored, monkeypatch):
    monkeypatch.setattr(K, "MOST_IDS", 1)
    small = K.focused(stored, ["G3", "G4"])
    assert "Join" in small.facts._jdf.queryExecution().executedPlan().toString()
    assert small.facts.count() == release.facts.filter("gene in (6, 7, 8, 9)").count()


def test_joins_on_buckets_move_nothing(spark, release, tmp_path):
    small = Release(**{**release.__dict__, "facts": release.facts.filter("gene <> 7")})
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        held = K.store_bucketed(small, str(tmp_path), "bucketed_test", 4)
        counted = held.facts.join(held.gene.withColumnRenamed("id", "gene"), "gene").groupBy("gene").agg(F.count(F.lit(1)).alias("n"))
        spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
        pairs = held.facts.join(held.participation, ["gene", "pathway"]).groupBy("gene", "pathway").agg(F.count(F.lit(1)).alias("n"))
        for df in (counted, pairs):
            assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
            assert df.agg(F.sum("n")).first()[0] == small.facts.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.requireAllClusterKeysForCoPartition")
        for name in K.BUCKETED:
            spark.sql(f"DROP TABLE IF EXISTS bucketed_test_{name}")
