import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from kgspark.llm import simhash
from kgspark.llm.shared import components
from tests.llm import brute


def test_groups_match_all_pairs(docs, rows, same):
    same(simhash.op1_simhash(docs), brute.simhash(rows))


def test_empty_table(no_docs):
    assert simhash.op1_simhash(no_docs).collect() == []
    assert simhash.one_of_each_group(no_docs).collect() == []


def near_values(seed: int, centres: int, copies: int, bits: int) -> list[int]:
    rng = random.Random(seed)
    out = []
    for _ in range(centres):
        c = rng.getrandbits(64)
        out += [c] + [c ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(1, bits))) for _ in range(copies)]
    return list(dict.fromkeys(out))


@pytest.mark.parametrize("radius", [1, 3, 4, 7])
def test_forest_is_the_components_of_all_links(radius):
    values = near_values(radius, 40, 5, 10)
    ordered = sorted(values)
    roots = brute.linked(len(ordered), ((i, j) for i in range(len(ordered)) for j in range(i) if (ordered[i] ^ ordered[j]).bit_count() <= radius))
    members, heads = simhash.forest(np.array(values, np.uint64), radius)
    assert dict(zip(members.tolist(), heads.tolist())) == {ordered[i]: ordered[r] for i, r in enumerate(roots) if r != i}


@pytest.mark.parametrize("n", [10, 10**8, 10**10, 10**14])
def test_schemes_are_exact(n):
    blocks, equal = simhash.scheme(n, 4)
    assert blocks - equal == 4  # four differing bits spoil four blocks at most


@pytest.mark.parametrize("scheme", [(5, 1), (6, 2), (7, 3)])
def test_every_link_is_found_by_every_scheme(spark, monkeypatch, scheme):
    monkeypatch.setattr(simhash, "scheme", lambda n, radius: scheme)
    values = near_values(5, 60, 4, 6)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    roots = {r["node"]: r["root"] for r in components(simhash.link_edges(df, 4, chunk=16)).collect()}
    got = [roots.get(v, v) for v in signed]
    expected = brute.linked(len(values), ((i, j) for i in range(len(values)) for j in range(i) if (values[i] ^ values[j]).bit_count() <= 4))
    assert len({(g, e) for g, e in zip(got, expected)}) == len(set(got)) == len(set(expected))


def test_a_hot_bucket_is_dealt_out(spark):
    """A third of all fingerprints share their lower bits: tiles stay small, and links across chunks are kept."""
    rng = random.Random(8)
    hot = {(rng.getrandbits(40) << 24 | 12345) for _ in range(400)}
    hot |= {v ^ 1 << 60 for v in list(hot)[:100]}
    values = [v - (1 << 64) if v >> 63 else v for v in hot | {rng.getrandbits(64) for _ in range(800)}]
    df = spark.createDataFrame([(v,) for v in values], "fp long").distinct()
    edges = simhash.link_edges(df, 4, chunk=64)
    assert components(edges).count() == 100


def test_components_of_chains_stars_and_rings(spark):
    rng = random.Random(2)
    pairs = [(i, i + 1) for i in range(200)] + [(1000, 2000 + i) for i in range(100)] + [(3000 + i, 3000 + (i + 1) % 50) for i in range(50)] + [(7, 7), (None, 3)]
    rng.shuffle(pairs)
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert found == {i: 0 for i in range(1, 201)} | {2000 + i: 1000 for i in range(100)} | {3000 + i: 3000 for i in range(1, 50)}


def test_component_rounds_leave_one_table(spark):
    from pathlib import Path

    from kgspark.session import ensure_checkpoint_dir

    folder = Path(ensure_checkpoint_dir(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    found = components(spark.createDataFrame([(i, i + 1) for i in range(40)], "u long, v long"))
    assert len(set(folder.iterdir()) - before) == 1 and found.count() == 40


def test_one_document_of_each_group_stays(docs, rows):
    """Also where an id is repeated, is the smallest of two groups, or is null."""
    root_of = dict(zip((r[1] for r in rows), brute.near_groups([brute.fingerprint(r[1]) for r in rows])))
    expected = {(root_of[r[1]], head) for r, (_, _, head) in zip(rows, brute.simhash(rows))}
    kept = simhash.one_of_each_group(docs)
    assert kept.columns == docs.columns
    got = [(root_of[r["text"]], r["doc_id"]) for r in kept.collect()]
    assert len(got) == len(expected) and set(got) == expected
    assert kept.where(F.col("`a.b`") != "a.b").count() == 0
