"""Comparison by digests: equal to the full comparison, and cheap where tables are equal."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from kgspark.operators import digests as G
from kgspark.operators.diff import release_diff
from kgspark.operators.sets import reconcile_sets


def same(found, expected):
    assert found.columns == expected.columns
    key = lambda r: tuple((v is not None, str(v)) for v in r)
    assert sorted(map(tuple, found.collect()), key=key) == sorted(map(tuple, expected.collect()), key=key)


def exchanged(spark, run) -> int:
    """Records written to exchanges while ``run`` runs."""
    def total() -> int:
        stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), None)
        return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))

    before = total()
    run()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    return total() - before


@pytest.fixture(scope="module")
def releases(spark):
    rng = random.Random(2)
    old = [(i if i % 50 else None, rng.choice(["a", None, "b", f"l{i}"])) for i in range(3000)] + [(7, "second"), (7, "second")]
    new = [(i, "changed" if k % 400 == 0 else label) for k, (i, label) in enumerate(old) if k % 500] + [(9000 + i, "a") for i in range(20)]
    make = lambda rows: spark.createDataFrame(rows, "id LONG, label STRING").repartition(5)
    return make(old), make(new)


@pytest.mark.parametrize("levels, enough", [((1,), 0), ((4, 8), 0), ((10, 20), 10**6), ((10, 20), 0)])
def test_rows_that_differ_are_all_kept(spark, releases, levels, enough):
    old, new = releases
    left, right = G.differing_rows(old, new, ["id"], levels=levels, enough=enough)
    for a, b, kept in ((old, new, left), (new, old, right)):
        assert a.exceptAll(b).exceptAll(kept).isEmpty() and kept.exceptAll(a).isEmpty()
    same(release_diff(left, right), release_diff(old, new))
    if levels == (10, 20) and not enough:
        assert left.count() < 400


def test_release_diff(spark, releases):
    old, new = releases
    same(G.release_diff_by_digest(old, new), release_diff(old, new))
    empty = old.limit(0)
    same(G.release_diff_by_digest(empty, new), release_diff(empty, new))
    same(G.release_diff_by_digest(empty, empty), release_diff(empty, empty))


def test_equal_tables_shuffle_no_rows(spark, tmp_path):
    spark.range(300_000).select("id", F.concat(F.lit("label "), "id").alias("label")).repartition(6).write.parquet(str(tmp_path / "a"))
    spark.read.parquet(str(tmp_path / "a")).orderBy(F.desc("id")).write.parquet(str(tmp_path / "b"))
    a, b = (spark.read.parquet(str(tmp_path / n)) for n in "ab")
    assert exchanged(spark, lambda: G.release_diff_by_digest(a, b).collect()) < 2 * 8 * 1024 * 2 + 1000
    assert exchanged(spark, lambda: release_diff(a, b).collect()) >= 600_000
    one = a.withColumn("label", F.when(F.col("id") == 777, "other").otherwise(F.col("label")))
    found = []
    assert exchanged(spark, lambda: found.extend(G.release_diff_by_digest(a, one).collect())) < 60_000
    assert [tuple(r) for r in found] == [(777, "label 777", "other", "relabelled")]


def test_table_difference(spark):
    left = [("a", 1), ("a", 1), (None, 2), ("b", None), ("c", 3)]
    right = [("a", 1), (None, 2), (None, 2), ("b", None), ("d", 3)]
    make = lambda rows: spark.createDataFrame(rows, "k STRING, v INT")
    found = G.table_difference(make(left), make(right), ["k"]).collect()
    assert sorted(map(tuple, found), key=str) == sorted([("a", 1, 2, 1), (None, 2, 1, 2), ("c", 3, 1, 0), ("d", 3, 0, 1)], key=str)
    assert G.table_difference(make(left), make(left[::-1])).isEmpty()
    assert not G.table_difference(make([("a", None)]), spark.createDataFrame([(None, "a")], "k STRING, v STRING").select("k", F.lit(None).cast("int").alias("v"))).isEmpty()


def test_nulls_in_other_columns_differ(spark):
    make = lambda rows: spark.createDataFrame(rows, "k STRING, v STRING, w STRING")
    assert G.table_difference(make([("k", "a", None)]), make([("k", None, "a")]), ["k"]).count() == 2


@pytest.mark.parametrize("is_set", [True, False])
def test_reconciled_sets(spark, is_set):
    rng = random.Random(3)
    ours = {(f"k{rng.randrange(40)}", rng.randrange(60)) for _ in range(1500)} | {("hot", i) for i in range(5000)} | {("gone", 1), (None, 4)}
    theirs = {p for p in ours if p != ("hot", 4321) and p[0] != "gone" and not (p[0] == "k3" and p[1] % 2)} | {("new", 1), ("k5", 99), ("hot", -1)}
    left, right = sorted(ours, key=str), sorted(theirs, key=str)
    if not is_set:
        left, right = left + left[:500], right + right[200:300]
    a, b = (spark.createDataFrame(rows, "key STRING, member LONG").repartition(4) for rows in (left, right))
    same(G.reconcile_sets_by_digest(a, b, is_set), reconcile_sets(a, b))


def test_one_member_of_a_hot_set_costs_a_share_of_it(spark, tmp_path):
    spark.range(200_000).select(F.lit("hot").alias("key"), F.col("id").alias("member")).write.parquet(str(tmp_path / "a"))
    a = spark.read.parquet(str(tmp_path / "a"))
    found = []
    spent = exchanged(spark, lambda: found.extend(G.reconcile_sets_by_digest(a, a.filter("member <> 5"), True).collect()))
    assert [tuple(r) for r in found] == [("hot", 200_000, 199_999, 0, 1, False)] and spent < 50_000


def test_small_sets_cost_their_members_once(spark, tmp_path):
    """Every set lost a member: shares of so few members are not digested, and digests of keys are moved once."""
    spark.range(40_000).selectExpr("id div 20 AS key", "id AS member").write.parquet(str(tmp_path / "a"))
    a = spark.read.parquet(str(tmp_path / "a"))
    b = a.filter("member % 20 <> 7")
    found = []
    spent = exchanged(spark, lambda: found.extend(G.reconcile_sets_by_digest(a, b, True).collect()))
    assert sorted(map(tuple, found)) == [(k, 20, 19, 0, 1, False) for k in range(2000)] and spent < 110_000
