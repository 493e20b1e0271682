import random

import pytest

from kgspark.llm import decontaminate
from tests.llm import brute

ITEMS = "item_id long, text string"


def items_and_rows(seed: int):
    """Few words, so that windows recur by chance, share words and overlap."""
    rng = random.Random(seed)
    text = lambda n: " ".join(rng.choice(["a", "B", "c,", "dé", "E9"]) for _ in range(n))
    items = [(i, brute.sentence(rng, rng.randrange(1, 40))) for i in range(20)] + [(100 + i, text(rng.randrange(1, 16))) for i in range(10)]
    items += [(200, ""), (201, None), (None, brute.sentence(rng, 20)), (0, items[0][1]), (202, items[1][1] + " tail"), (203, "x-y"), (204, "one two three four five")]
    rows = []
    for i in range(60):
        parts = [text(rng.randrange(0, 30)) for _ in range(3)]
        for _ in range(rng.randrange(3)):
            words = (rng.choice(items)[1] or "").split()
            a = rng.randrange(0, max(1, len(words)))
            parts.insert(rng.randrange(len(parts)), ". ".join(words[a : a + 30]).upper())
        rows.append((i, "\n".join(parts), None, None, None))
    return items, rows


@pytest.mark.parametrize("block", [10**6, 60])
def test_hits_match_brute_force(spark, same, block, monkeypatch):
    items, rows = items_and_rows(block)
    rows += brute.awkward()
    benchmark = spark.createDataFrame(items, ITEMS)
    df = spark.createDataFrame(rows, brute.SCHEMA).repartition(3)
    default = decontaminate.find_windows
    monkeypatch.setattr(decontaminate, "find_windows", lambda *a, **k: default(*a, **k, block=block))
    same(decontaminate.op5_decontaminate(df, benchmark), brute.contamination(rows, items))


def test_clean_documents_stay_as_they_are(spark, docs, rows):
    items = [(1, rows[0][1]), (2, rows[5][1])]
    kept = decontaminate.clean(docs, spark.createDataFrame(items, ITEMS))
    expected = [r for r, c in zip(rows, brute.contamination(rows, items)) if not c[-1]]
    assert kept.columns == docs.columns
    assert sorted(str(tuple(r)[:5]) for r in kept.collect()) == sorted(map(str, expected))


def test_empty_tables(spark, docs, no_docs, rows):
    nothing = spark.createDataFrame([], ITEMS)
    assert decontaminate.op5_decontaminate(docs, nothing).where("contaminated or n_hit > 0").count() == 0
    assert decontaminate.op5_decontaminate(docs, nothing).count() == len(rows)
    assert decontaminate.op5_decontaminate(no_docs, spark.createDataFrame([(1, "a b")], ITEMS)).collect() == []


def test_the_rarest_shingle_is_the_prefix():
    window = tuple(f"w{i}".encode() for i in range(8))
    shingles = decontaminate.shingles_of(window, 5)
    vocabulary = {s: i + 1 for i, s in enumerate(shingles)}
    counts = {1: 5, 2: 4, 3: 1, 4: 9}
    postings = decontaminate.prefix_postings([(window, ["1"])], counts, vocabulary, 5)
    assert list(postings) == [shingles[2]] and postings[shingles[2]][0][0] == 2
