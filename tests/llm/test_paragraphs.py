import os
import random

import pytest

from kgspark.llm import paragraphs
from tests.llm import brute


def shingles(words):
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def by_brute_force(rows, min_words, similarity=0.8):
    """Paragraphs (doc_id, unit, shingles, words) and their clusters."""
    units = []
    for doc_id, text in ((r[0], r[1]) for r in rows):
        for number, line in enumerate((text or "").split("\n")):
            words = brute.WORD.findall(line.translate(brute.UPPER))
            if len(words) >= min_words:
                units.append((doc_id, number, shingles(words), len(words)))
    jaccard = lambda a, b: len(a & b) / len(a | b)
    roots = brute.linked(len(units), ((i, j) for i in range(len(units)) for j in range(i) if jaccard(units[i][2], units[j][2]) >= similarity))
    groups = {}
    for u, root in zip(units, roots):
        groups.setdefault(root, []).append(u)
    return units, groups


def near_copies(seed):
    rng = random.Random(seed)
    passages = [brute.sentence(rng, rng.randrange(50, 120)) for _ in range(12)]
    rows = []
    for i in range(80):
        lines = [brute.sentence(rng, rng.randrange(5, 70)) for _ in range(rng.randrange(4))]
        for p in rng.sample(passages, rng.randrange(3)):
            words = p.split()
            for _ in range(rng.randrange(3)):
                words[rng.randrange(len(words))] = "changed"
            lines.insert(rng.randrange(len(lines) + 1), rng.choice([str.upper, str])(" ".join(words)))
        rows.append((i, "\n".join(lines), None, None, None))
    return rows


@pytest.mark.parametrize("chunk", [512, 3])
def test_clusters_match_all_pairs(spark, monkeypatch, chunk):
    rows = near_copies(6)
    monkeypatch.setattr(paragraphs, "clusters", lambda units, sets, similarity, f=paragraphs.clusters: f(units, sets, similarity, chunk))
    units, groups = by_brute_force(rows, 50)
    found = paragraphs.repeated_paragraphs(spark.createDataFrame(rows, brute.SCHEMA).repartition(3)).collect()
    got = {}
    for r in found:
        got.setdefault(r["cluster"], set()).add((r["doc_id"], r["unit"]))
    expected = {frozenset((d, u) for d, u, _, _ in g) for g in groups.values()}
    assert {frozenset(g) for g in got.values()} == expected
    assert sum(len(g) > 1 for g in expected) >= 8
    removed = {(r["doc_id"], r["unit"]) for r in found if r["removed"]}
    assert removed == {(d, u) for g in groups.values() for d, u in sorted((x[0], x[1]) for x in g)[1:]}
    texts = {r[0]: r[1] for r in rows}
    for r in found:
        assert texts[r["doc_id"]][r["start"] : r["end"]] == texts[r["doc_id"]].split("\n")[r["unit"]]


def test_one_row_per_document(spark):
    rows = near_copies(9)
    _, groups = by_brute_force(rows, 50)
    spread = [g for g in groups.values() if len({x[0] for x in g}) > 1]
    grams = {}
    for d, text, *_ in rows:
        words = text.lower().split()
        for i in range(len(words) - paragraphs.SPAN + 1):
            grams.setdefault(tuple(words[i : i + paragraphs.SPAN]), set()).add(d)
    df = spark.createDataFrame(rows, brute.SCHEMA)
    found = {r["doc_id"]: r for r in paragraphs.op6_paragraphs(df).collect()}
    windows = [(r["doc_id"], r["head"], r["start"]) for r in paragraphs.shared_windows(df).collect()]
    texts = {r[0]: r[1].lower().split() for r in rows}
    for d, head, at in windows:  # each is a true repeat
        assert min(grams[tuple(texts[d][at : at + paragraphs.SPAN])]) <= head and len(grams[tuple(texts[d][at : at + paragraphs.SPAN])]) > 1
    roots = brute.linked(80, [(x[0], g[0][0]) for g in spread for x in g] + [(d, head) for d, head, _ in windows])
    assert [found[i]["class_id"] for i in range(80)] == roots
    assert [found[i]["n_repeated"] for i in range(80)] == [sum(x[0] == i for g in spread for x in g) for i in range(80)]
    clean = {i for i in range(80)} - {x[0] for g in groups.values() if len(g) > 1 for x in g} - {d for ds in grams.values() if len(ds) > 1 for d in ds}
    assert clean and all(found[i]["n_removed"] == found[i]["passage_words"] == 0 and found[i]["class_id"] == i for i in clean)


def test_passages_of_fifty_words_anywhere(spark):
    """Inside a paragraph, across lines, in other case, once or often: each is found in each document; nothing else is."""
    rng = random.Random(11)
    rows, expected = [], {}
    for p in range(40):
        passage = brute.sentence(rng, rng.choice([50, 51, 55, 70])).split()
        for _ in range(rng.randrange(2, 5)):
            before, after = (brute.sentence(rng, rng.randrange(200)).split() for _ in "ab")
            words = before + passage + after
            text = "".join(w + rng.choice([" ", " ", " ", "\n", "\t "]) for w in words)
            expected.setdefault(p, []).append(len(rows))
            rows.append((len(rows), rng.choice([text, text.upper()]), None, None, None))
    clean = list(range(len(rows), len(rows) + 60))
    rows += [(i, brute.sentence(rng, 150), None, None, None) for i in clean]
    found = {r["doc_id"]: r for r in paragraphs.op6_paragraphs(spark.createDataFrame(rows, brute.SCHEMA).repartition(5)).collect()}
    for ids in expected.values():
        assert {found[i]["class_id"] for i in ids} == {min(ids)}
        assert all(found[i]["passage_words"] >= 32 for i in ids)
        assert [found[i]["passage_removed"] > 0 for i in sorted(ids)] == [False] + [True] * (len(ids) - 1)
    assert all(found[i]["passage_words"] == 0 and found[i]["class_id"] == i for i in clean)


def test_short_units(spark):
    """Short lines, hard-wrapped near copies and short documents are linked too, each like all pairs at 0.8."""
    rng = random.Random(21)
    other = lambda n: brute.sentence(rng, n)
    license_, near, wrapped, tiny = other(9), other(30).split(), other(48).split(), other(3)
    changed = [*near[:-1], "changed"]
    wrap = lambda words, n: "\n".join(" ".join(words[i : i + n]) for i in range(0, len(words), n))
    rewrapped = [*wrapped[:-1], "changed"]
    texts = [
        f"{other(60)}\n{license_}", f"{license_.upper()}\n{other(70)}",  # a line of nine words
        f"{other(80)}\n{' '.join(near)}", f"{' '.join(changed)}\n{other(55)}",  # near copies of 30 words
        f"{other(60)}\n\n{wrap(wrapped, 10)}\n\n{other(60)}", f"{other(90)}\n\n{wrap(rewrapped, 7)}\n\n{other(52)}",  # wrapped anew
        tiny, f" {tiny} ", "one\n\ntwo\n\nthree four", "one two\n\nthree\n\nfour",  # whole documents
        other(9), other(3), f"{other(60)}\n{other(30)}", "", "",
    ]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate(texts)], brute.SCHEMA).repartition(4)
    found = sorted(paragraphs.op6_paragraphs(df).collect(), key=lambda r: r["doc_id"])
    assert [r["class_id"] for r in found] == [0, 0, 2, 2, 4, 4, 6, 6, 8, 8, 10, 11, 12, 13, 14]
    assert [r["n_removed"] for r in found] == [0, 1, 0, 1] + [0] * 11
    assert [r["removed_words"] for r in found] == [0, 9, 0, 30] + [0] * 11
    assert [r["joined_removed"] for r in found] == [0, 0, 0, 0, 0, 1, 0, 1, 0, 1] + [0] * 5
    assert [r["n_long"] for r in found] == [1, 1, 1, 1, 2, 2] + [0] * 6 + [1, 0, 0]


def test_thinning_keeps_a_window_of_every_neighbourhood():
    rng = random.Random(5)
    for vocabulary in (2, 5, 1000):
        words = [f"{rng.randrange(vocabulary)}".encode() for _ in range(400)]
        hashes, starts = paragraphs.thinned_windows(words, paragraphs._Hashes())
        kept = {tuple(words[s : s + 32]) for s in starts.tolist()}
        assert len(kept) == len(hashes)
        windows = [tuple(words[i : i + 32]) for i in range(400 - 31)]
        assert all(any(w in kept for w in windows[i : i + 19]) for i in range(len(windows) - 18))
    assert len(paragraphs.thinned_windows(words[:49], paragraphs._Hashes())[0]) == 0
    assert len(paragraphs.thinned_windows(words[:50], paragraphs._Hashes())[0]) >= 1


def test_awkward_documents(docs, rows, no_docs):
    found = paragraphs.op6_paragraphs(docs).collect()
    assert sorted(str(r["doc_id"]) for r in found) == sorted(str(r[0]) for r in rows)
    assert all(r["class_id"] is None for r in found if r["doc_id"] is None)
    assert paragraphs.op6_paragraphs(no_docs).collect() == []


def test_recall_of_the_bands():
    """At the threshold itself, the tuned bands meet the stated recall; measured on pairs near it."""
    rng = random.Random(1)
    multiply, add = paragraphs.coefficients(2 * paragraphs.tuned_bands())
    met = total = 0
    while total < 400:
        words = brute.sentence(rng, 80).split()
        other = list(words)
        for _ in range(2):
            other[rng.randrange(5, 75)] = "x"
        a, b = paragraphs.shingle_set([w.encode() for w in words]), paragraphs.shingle_set([w.encode() for w in other])
        both = len(set(a.tolist()) & set(b.tolist()))
        if 0.75 <= both / (len(a) + len(b) - both) <= 0.85:
            total += 1
            met += bool(set(paragraphs.band_keys(a, multiply, add, 2)) & set(paragraphs.band_keys(b, multiply, add, 2)))
    assert met / total >= 0.98


def test_dense_group_is_verified_whole():
    import numpy as np

    rng = random.Random(7)
    base = brute.sentence(rng, 60).split()
    sets = []
    for i in range(60):
        words = list(base)
        for _ in range(i % 4):
            words[rng.randrange(60)] = f"c{i}"
        sets.append(sorted(hash(s) for s in shingles(words)))
    roots = brute.linked(60, ((i, j) for i in range(60) for j in range(i) if len(set(sets[i]) & set(sets[j])) >= 0.8 * len(set(sets[i]) | set(sets[j]))))
    found = dict(paragraphs.verified(sets, np.arange(60), 0.8))
    assert [found.get(i, i) for i in range(60)] == roots


def test_candidates_travel_as_words(spark):
    """What meets in the tiles is the folded text, not eight bytes for each of its shingles; the sets are the same."""
    rng = random.Random(3)
    texts = [brute.sentence(rng, n) for n in (60, 3, 120, 5)]
    df = spark.createDataFrame([(i, f" {t.upper()}\t", None, None, None) for i, t in enumerate(texts)], brute.SCHEMA).coalesce(1)
    members = [bytes(r["members"]) for r in paragraphs.sets_of(df, "doc_id", "text", 50).collect()]
    assert members == [t.encode() for t in texts]
    made = list(paragraphs.shingle_sets(members))
    assert [m.tolist() for m in made] == [paragraphs.shingle_set(t.encode().split()).tolist() for t in texts]


def test_shuffles_do_not_pile_up(spark):
    """Shuffle files of the stored steps are gone when the result is at hand, and the setting is as it was."""
    from kgspark.session import CLEANUP_SETTING

    def held():
        manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
        names = manager.getAllFiles().mkString("\n").split("\n")
        return {n: os.path.getsize(n) for n in names if n.endswith(".data") and os.path.exists(n)}

    df = spark.createDataFrame(near_copies(9), brute.SCHEMA).repartition(3)
    setting, before = spark.conf.get(CLEANUP_SETTING), held()
    found = paragraphs.op6_paragraphs(df)
    left = sum(size for name, size in held().items() if name not in before)
    assert left < 20_000
    assert spark.conf.get(CLEANUP_SETTING) == setting and found.count() == 80
