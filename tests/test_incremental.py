"""Measures moved by signed differences equal those counted anew, and so does the whole report."""

from __future__ import annotations

import random

import pytest

from kgspark import session
from kgspark.operators.resolve import participation_edges
from kgspark.plans import incremental as V
from kgspark.plans.describe import characteristics
from kgspark.plans.release import Release


def release(spark, facts, hierarchy, nodes=30):
    f = spark.createDataFrame(sorted(facts), "gene LONG, pathway LONG, code STRING, accession STRING")
    return Release(
        spark.range(nodes).selectExpr("id", "concat('n', id) AS label", "'t' AS taxon"),
        spark.createDataFrame(sorted(hierarchy), "child LONG, parent LONG"),
        f.selectExpr("gene AS id", "concat('g', gene) AS symbol", "'t' AS taxon").distinct(), f, participation_edges(f),
        spark.createDataFrame([(1, "x"), (2, "y")], "pathway LONG, term STRING"),
    ).stored()


@pytest.fixture(scope="module")
def two(spark):
    rng = random.Random(11)
    fact = lambda: (rng.randrange(25), rng.randrange(24), rng.choice("AR"), f"P{rng.randrange(4)}")
    old = {fact() for _ in range(500)} | {(g, 29, "A", "P0") for g in range(25)}
    edges = {(c, c // 2) for c in range(1, 30)} | {(c, c // 3) for c in range(3, 20)}
    # Single facts come and go, a gene leaves altogether, a set is emptied, another is new, a code disappears for one gene.
    gone = set(rng.sample(sorted(old), 60)) | {f for f in old if f[0] == 3 or f[1] == 7}
    new = (old - gone) | {fact() for _ in range(40)} | {(g, 25, "N", "P9") for g in range(10)}
    new = {f for f in new if f[1] != 7}
    moved = (edges - {(10, 5), (6, 2)}) | {(25, 2), (29, 1)}
    return release(spark, old, edges), release(spark, new, moved)


def rows(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


def test_advance_equals_measure(spark, two):
    old, new = two
    moved, counted = V.advance(V.measure(old).stored(), old, new), V.measure(new)
    for name in ("sizes", "degrees", "common", "evidence"):
        assert rows(getattr(moved, name)) == rows(getattr(counted, name)), name
    back = V.advance(moved, new, old)
    assert rows(back.sizes) == rows(V.measure(old).sizes) and rows(back.common) == rows(V.measure(old).common)


def test_nothing_moved(spark, two):
    old, _ = two
    measures = V.measure(old).stored()
    moved = V.advance(measures, old, old)
    assert V.signed_facts(old.facts, old.facts).isEmpty()
    assert all(rows(getattr(moved, n)) == rows(getattr(measures, n)) for n in ("sizes", "degrees", "common", "evidence"))


def test_the_report_of_moved_measures(spark, two):
    old, new = two
    moved = V.advance(V.measure(old).stored(), old, new)
    common = dict(codes=["A", "R"], source="s", top=5, band=(2, 10))
    assert rows(characteristics(new, measures=moved, **common)) == rows(characteristics(new, **common))


def test_edges_count_by_their_last_fact(spark, two):
    old, new = two
    changes = V.signed_facts(old.facts, new.facts)
    signed = V.signed_edges(old.facts, changes)
    before, after = ({tuple(r) for r in x.participation.select("gene", "pathway").collect()} for x in (old, new))
    expected = {(*e, 1) for e in after - before} | {(*e, -1) for e in before - after}
    assert {tuple(r) for r in signed.collect()} == expected


def test_tasks_hold_a_share_of_the_rows(spark, two, monkeypatch):
    """Every table of the step is dealt by rows, and the session's own settings are back afterwards."""
    old, new = two
    names = [*session.SMALL_TASKS, session.PARTITIONS_SETTING]
    before, seen = [spark.conf.get(n, None) for n in names], []
    write = V.write_shared
    monkeypatch.setattr(session, "ROWS_A_TASK", 10)
    monkeypatch.setattr(V, "write_shared", lambda df: seen.append([spark.conf.get(n) for n in names]) or write(df))
    measures = V.measure(old).stored()
    del seen[:]
    V.advance(measures, old, new)
    parts = (old.facts.count() + new.facts.count()) // 10 + 1
    assert parts > 4 and len(seen) == 6
    assert all(s[:2] == ["8m", "16m"] for s in seen) and seen[0][2] == str(parts) == seen[1][2]
    assert [spark.conf.get(n, None) for n in names] == before
