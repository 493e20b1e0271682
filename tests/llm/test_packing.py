import re
from collections import Counter, defaultdict

from kgspark.llm import packing


def checked(found, texts_of, capacity):
    """Every sequence within its room and free of conflicts."""
    bins = defaultdict(list)
    for r in found:
        bins[r["sequence"]].append(r)
    for held in bins.values():
        assert sum(r["words"] for r in held) <= capacity
        sources = [r["source"] for r in held if r["source"] is not None]
        assert len(sources) == len(set(sources))
        copies = [r["text_of"] for r in held if r["text_of"]]
        assert len(copies) == len(set(copies))
        assert sorted(r["place"] for r in held) == list(range(len(held)))
    return bins


def test_pieces_cover_all_texts(docs, rows):
    found = packing.pieces(docs, 100, "doc_id", "text", "source", True).collect()
    whole = defaultdict(list)
    for r in found:
        whole[r["doc_id"], r["cluster"]].append((r["piece"], r["text"], r["words"]))
        assert r["words"] == len(re.findall(r"[^\x20\x09-\x0D]+", r["text"])) <= 100
    assert Counter(r[0] for r in rows) == Counter(r["doc_id"] for r in found if r["piece"] == 0)
    texts = Counter((r[0], r[1] or "") for r in rows)
    rebuilt = Counter()
    for (doc_id, _), parts in whole.items():
        copies = Counter(p[0] for p in parts)[0]
        parts = sorted(set(parts))
        rebuilt[doc_id, "".join(p[1] for p in parts)] += copies
    assert {k: n for k, n in texts.items() if k[0] is not None and k[1]} == {k: n for k, n in rebuilt.items() if k[0] is not None and k[1]}


def test_no_conflict_and_nothing_lost(docs, rows):
    for part in (10, 2048):
        packed = packing.pack(docs, 300, texts=True, part=part).collect()
        found = [{**r.asDict(), "text_of": r["text"]} for r in packed]
        checked(found, None, 300)
        assert sum(r["words"] for r in found) == sum(len((r[1] or "").encode().split()) for r in rows)
        assert Counter(r["doc_id"] for r in found if r["piece"] == 0) == Counter(r[0] for r in rows)


def naive(sizes, sources, clusters, capacity):
    bins, chosen = [], []
    for size, source, cluster in zip(sizes, sources, clusters):
        fits = [
            (capacity - sum(x[0] for x in b), i) for i, b in enumerate(bins)
            if sum(x[0] for x in b) + size <= capacity and not any((source is not None and x[1] == source) or (cluster is not None and x[2] == cluster) for x in b)
        ]
        i = min(fits)[1] if fits else len(bins)
        if i == len(bins):
            bins.append([])
        bins[i].append((size, source, cluster))
        chosen.append(i)
    return chosen


def test_tightest_compatible_sequence():
    import random

    rng = random.Random(4)
    for _ in range(30):
        n = rng.randrange(1, 80)
        sizes = [rng.randrange(0, 40) for _ in range(n)]
        sources = [rng.choice([None, "a", "b", "c"]) for _ in range(n)]
        clusters = [rng.choice([None, *range(10)]) for _ in range(n)]
        assert packing.best_fit(sizes, sources, clusters, 50) == naive(sizes, sources, clusters, 50)


def test_a_hot_source_is_spread(spark):
    rows = [(i, f"w{i} x y", "hot" if i % 3 else f"s{i}") for i in range(900)]
    found = packing.pack(spark.createDataFrame(rows, "doc_id long, text string, source string"), 30, part=50).collect()
    checked([{**r.asDict(), "text_of": None} for r in found], None, 30)
    assert len({r["sequence"] for r in found}) >= 600  # one hot document in each


def test_large_ids_beside_a_null_stay_exact(spark):
    rows = [(2**60 + i, f"a{i} b", "s") for i in range(20)] + [(None, "c d", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert {r["doc_id"] for r in packing.op4_packing(df).collect()} == {r[0] for r in rows}
    assert {d for r in packing.sequences(df).collect() for d in r["doc_ids"]} == {r[0] for r in rows}


def test_sequences_and_empty_table(docs, rows, no_docs):
    made = packing.sequences(docs, 300).collect()
    assert sum(r["words"] for r in made) == sum(len((r[1] or "").encode().split()) for r in rows)
    packed = {}
    for r in packing.pack(docs, 300, texts=True).orderBy("sequence", "place").collect():
        packed.setdefault(r["sequence"], []).append((r["doc_id"], r["piece"], r["text"]))
    for r in made:
        ids, pieces, texts = zip(*packed.pop(r["sequence"]))
        assert (r["doc_ids"], r["pieces"], r["text"]) == (list(ids), list(pieces), "\n\n".join(texts))
    assert not packed
    assert packing.op4_packing(no_docs).collect() == [] and packing.sequences(no_docs).collect() == []
