"""Stored releases: staged loads, their markers, what an interruption leaves; metadata by last load."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from kgspark.errors import PublishError
from kgspark.sources import loads as L
from kgspark.sources import releases as R

G1, G2 = "urn:kg:release:v1", "urn:kg:release:v2"


def quads(spark, graph, n, start=0):
    return spark.range(start, start + n).select(
        F.lit(graph).alias("graph"), F.concat(F.lit("P:"), "id").alias("s"), F.lit("a").alias("p"), F.lit("C").alias("o"),
        F.lit("iri").alias("o_kind"), F.lit(None).cast("string").alias("o_datatype"),
    )


def counts(spark, path):
    return {r["graph"]: r["count"] for r in R.read_releases(spark, path).groupBy("graph").count().collect()}


def test_a_staged_load_is_not_seen(spark, tmp_path):
    path = str(tmp_path / "q")
    assert R.read_releases(spark, path).isEmpty()
    R.replace_release(quads(spark, G1, 10), path, G1)
    load, n = R.stage_release(quads(spark, G1, 7), path, G1)
    assert n == 7 and counts(spark, path) == {G1: 10} and R.read_staged(spark, path, G1, load).count() == 7
    R.publish_release(spark, path, G1, load)
    assert counts(spark, path) == {G1: 7}
    folder = next(tmp_path.glob("q/graph*"))
    assert [f.name for f in folder.iterdir() if f.name.startswith("load=")] == [f"load={load}"]
    other, _ = R.stage_release(quads(spark, G1, 5), path, G1)
    R.discard_release(spark, path, G1, other)
    assert counts(spark, path) == {G1: 7} and L.published(spark, path, folder.name)[-1] == (2, load)


def test_a_failing_write_leaves_the_release(spark, tmp_path):
    path = str(tmp_path / "q")
    R.replace_release(quads(spark, G1, 10), path, G1)
    R.replace_release(quads(spark, G2, 3), path, G2)
    broken = quads(spark, G1, 50).withColumn("o", F.when(F.col("s") == "P:40", F.raise_error(F.lit("killed"))).otherwise(F.col("o")))
    with pytest.raises(Exception, match="killed"):
        R.replace_release(broken, path, G1)
    assert counts(spark, path) == {G1: 10, G2: 3}
    assert R.replace_release(quads(spark, G1, 4), path, G1) == 4 and counts(spark, path) == {G1: 4, G2: 3}


def test_an_empty_release(spark, tmp_path):
    path = str(tmp_path / "q")
    assert R.replace_release(quads(spark, G1, 0), path, G1) == 0 and R.read_releases(spark, path).isEmpty()
    R.replace_release(quads(spark, G1, 2), path, G1)
    assert R.replace_release(quads(spark, G1, 0), path, G1) == 0 and R.read_releases(spark, path).isEmpty()


def test_of_two_loads_at_once_one_counts(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    L.publish(spark, root, "t", "a", "t")
    first = L.published(spark, root, "t")
    seen = [first, first + [(2, "z")]]
    monkeypatch.setattr(L, "published", lambda *_: seen.pop(0))
    with pytest.raises(PublishError, match="same time"):
        L.publish(spark, root, "t", "b", "t")
    monkeypatch.undo()
    assert L.published(spark, root, "t") == first


def metadata(spark, graph, n, day):
    return R.release_metadata(R.release_row(spark, graph=graph, version="v", triples=n), day)


def test_many_activities_make_few_files(spark, tmp_path):
    path = str(tmp_path / "meta")
    many = spark.range(1000).select(
        F.concat(F.lit("urn:a:"), "id").alias("s"), F.lit("a").alias("p"), F.lit("prov:Activity").alias("o"), F.lit("iri").alias("o_kind"),
        F.lit(None).cast("string").alias("o_datatype"),
    )
    R.write_metadata(spark, metadata(spark, G1, 1, "2026-01-01").unionByName(many).distinct(), path, G1)
    files = [f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]
    assert len(files) <= 8 and R.read_metadata(spark, path).filter("o = 'prov:Activity'").count() == 1001


def test_loads_are_put_together(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "meta")
    monkeypatch.setattr(R, "MOST_LOADS", 3)
    for n in range(1, 7):
        graph = (G1, G2)[n % 2]
        R.write_metadata(spark, metadata(spark, graph, n, f"2026-01-0{n}"), path, graph)
        stored = R.read_metadata(spark, path)
        triples = {r["s"]: r["o"] for r in stored.filter("p = 'void:triples'").collect()}
        assert triples == {g: str(k) for k, g in ((n - 1, (G1, G2)[(n - 1) % 2]), (n, graph)) if k}
        assert stored.filter("p = 'prov:endedAtTime'").count() == n and stored.count() == stored.distinct().count()
        assert len(list(tmp_path.glob("meta/load=*"))) <= 3


def test_an_interrupted_clearing_says_nothing_new(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "meta")
    monkeypatch.setattr(R, "MOST_LOADS", 2)
    for n in (1, 2):
        R.write_metadata(spark, metadata(spark, G1, n, f"2026-01-0{n}"), path, G1)
    monkeypatch.setattr(R, "remove", lambda *_: None)
    R.write_metadata(spark, metadata(spark, G2, 3, "2026-01-03"), path, G2)
    stored = R.read_metadata(spark, path)
    assert {(r["s"], r["o"]) for r in stored.filter("p = 'void:triples'").collect()} == {(G1, "2"), (G2, "3")}
    assert stored.filter("p = 'prov:endedAtTime'").count() == 3 and stored.count() == stored.distinct().count()
