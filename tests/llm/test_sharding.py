import hashlib
import random
from collections import Counter, defaultdict

import pytest

from kgspark.llm import sharding

SCHEMA = "doc_id long, text string"


def bits(doc_id):
    return format(int(hashlib.md5(("" if doc_id is None else str(doc_id)).encode()).hexdigest()[:15], 16), "060b")


def expected(rows, limit):
    """Shard of each hash, by splitting from the top."""
    out = {}

    def split(held, depth):
        if sum(size for _, size in held) <= limit or depth == 60:
            for h, _ in held:
                out[h] = h[:depth]
            return
        for b in "01":
            part = [x for x in held if x[0][depth] == b]
            if part:
                split(part, depth + 1)

    split([(bits(d), len((t or "").encode())) for d, t in rows], 0)
    return [(d, len((t or "").encode()), out[bits(d)], len(out[bits(d)])) for d, t in rows]


@pytest.mark.parametrize("limit", [10**9, 20_000, 700])
def test_shards_match_recursive_splits(spark, same, limit):
    rng = random.Random(limit)
    rows = [(i, rng.choice(["", "é", "x" * rng.randrange(300)])) for i in range(1500)] + [(9000, "y" * 5000), (9001, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    same(sharding.op10_sharding(df, limit), expected(rows, limit))
    assigned, directory = sharding.assign_shards(df, limit)
    sizes = Counter()
    for r in assigned.collect():
        assert r["overflow"] == 0
        sizes[r["shard"]] += r["bytes"]
    assert all(n <= limit or s == 5000 + 0 for s, n in sizes.items() if n != 5000)
    assert sum(r["bytes"] for r in directory.collect()) == sum(len((t or "").encode()) for _, t in rows)


def test_one_id_for_a_third_of_all_rows(spark):
    """No bit separates them: they go to overflow pages, each within the limit, and no row is lost."""
    rows = [(7, "x" * (i % 90)) for i in range(500)] + [(None, "z" * 10)] * 50 + [(i, "y" * 50) for i in range(100, 1100)]
    assigned, _ = sharding.assign_shards(spark.createDataFrame(rows, SCHEMA).repartition(6), 2000)
    found = assigned.collect()
    assert Counter((r["doc_id"], r["bytes"]) for r in found) == Counter((d, len(t)) for d, t in rows)
    sizes = defaultdict(int)
    for r in found:
        sizes[r["shard"], r["overflow"]] += r["bytes"]
    assert max(sizes.values()) <= 2000
    assert len({r["overflow"] for r in found if r["doc_id"] == 7}) > 10


def test_awkward_documents_and_empty_table(docs, rows, no_docs, same):
    found = sharding.op10_sharding(docs, 3000)
    assert found.count() == len(rows)
    assert sharding.op10_sharding(no_docs).collect() == []
