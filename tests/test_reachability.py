"""The index against the closure, on random hierarchies, a deep one and a wide one."""

from __future__ import annotations

import random

import pytest

from kgspark.errors import IngestError
from kgspark.operators import reachability as Y


def closure(edges):
    up = {}
    for c, p in edges:
        up.setdefault(c, set()).add(p)
    def above(n, seen):
        for p in up.get(n, ()):
            if p not in seen:
                seen.add(p)
                above(p, seen)
        return seen
    return {(n, a) for n in up for a in above(n, set())}


def dag(rng, n, parents):
    return [(c, rng.randrange(c)) for c in range(1, n) for _ in range(rng.randrange(parents + 1))]


@pytest.mark.parametrize("edges", [
    dag(random.Random(1), 30, 3), [(1, 0), (1, 0), (3, 2), (4, 0)],
])
def test_index_equals_the_closure(spark, edges):
    df = spark.createDataFrame(edges, "child LONG, parent LONG").repartition(3)
    index = Y.reachability_index(df)
    pairs = closure(edges)
    nodes = {n for e in edges for n in e}
    start = spark.createDataFrame([(n,) for n in nodes if n % 2], "id LONG")
    assert sorted(map(tuple, index.ancestors_of(start).collect())) == sorted(p for p in pairs if p[0] % 2)
    asked = [(a, b) for a in nodes for b in nodes] + [(a, -1) for a in nodes]
    told = index.is_above(spark.createDataFrame(asked, "node LONG, ancestor LONG")).collect()
    assert len(told) == len(asked) and {(r["node"], r["ancestor"]) for r in told if r["above"]} == pairs
    counts = {r["node"]: r["ancestors"] for r in index.ancestor_counts().collect()}
    assert counts == {n: sum(p[0] == n for p in pairs) for n in {p[0] for p in pairs}}
    places = index.places.collect()
    assert sorted(r["node"] for r in places) == sorted(nodes) and len({(r["chain"], r["position"]) for r in places}) == len(nodes)


def test_a_deep_hierarchy_has_a_small_index(spark):
    edges = [(c, c - 1) for c in range(1, 200)] + [(1000 + c, c) for c in range(0, 200, 20)]
    index = Y.reachability_index(spark.createDataFrame(edges, "child LONG, parent LONG"))
    assert index.reach.count() < 2 * len(edges) and len(closure(edges)) > 20_000
    start = spark.createDataFrame([(199,), (1180,)], "id LONG")
    assert sorted(map(tuple, index.ancestors_of(start).collect())) == sorted(p for p in closure(edges) if p[0] in (199, 1180))


def test_cycles_and_empty_hierarchies(spark):
    for edges in ([(1, 2), (2, 3), (3, 1)], [(2, 1), (3, 2), (1, 3), (1, 0), (5, 1)]):
        with pytest.raises(IngestError, match="cycle"):
            Y.reachability_index(spark.createDataFrame(edges, "child LONG, parent LONG"))
    empty = Y.reachability_index(spark.createDataFrame([], "child LONG, parent LONG"))
    assert empty.reach.isEmpty() and empty.ancestor_counts().isEmpty()


def test_levels_hand_on_what_doubling_finds(spark, monkeypatch):
    """Both ways give the same index; level by level, no table is composed with itself."""
    edges = dag(random.Random(8), 20, 2)
    df = spark.createDataFrame(edges, "child LONG, parent LONG").repartition(3)
    doubled = Y._doubled(df.distinct(), Y.chains(df.distinct()))
    monkeypatch.setattr(Y, "_filled", None)
    levels = Y.reachability_index(df).reach
    assert sorted(map(tuple, levels.collect())) == sorted(map(tuple, doubled.select("node", "chain", "lowest").collect()))
    monkeypatch.setattr(Y, "SHALLOW", 0)
    with pytest.raises(TypeError):
        Y.reachability_index(df)
