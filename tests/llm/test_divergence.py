"""The audit against plain integers; skybands against all terms; tiles and bounded memory."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from kgspark.llm import divergence
from tests.llm import brute

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def audited(rows, least=10, top=10):
    said, seen, groups = defaultdict(Counter), defaultdict(Counter), set()
    for _, text, lang, source, _ in rows:
        lang, source = lang or "", source or ""
        terms = TERM.findall((text or "").translate(brute.UPPER))
        said[lang, source].update(terms)
        seen[lang].update(set(terms))
        groups.add((lang, source))
    out = []
    for lang in {lang for lang, _ in groups}:
        kept = sorted(t for t, n in seen[lang].items() if n >= least)
        sources = sorted(s for l, s in groups if l == lang)
        whole = Counter()
        for s in sources:
            whole.update(said[lang, s])

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // (total + 2 * len(kept)) for t in kept}

        q = shares(whole)
        p = {s: shares(said[lang, s]) for s in sources}
        f = lambda x, y: (x - y) ** 2 // (x + y)
        for s in sources:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(f(p[s][t], q[t]), t) for t in kept if said[lang, s][t] > 0 and p[s][t] > q[t]]
            for part, found, limit in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:limit]
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(ranked)]
    return out


@pytest.fixture(scope="module")
def spoken():
    rng = random.Random(6)
    vocabulary = [f"{a}{b}" for a in ("ab", "É", "zz", "ß日", "q") for b in ("", "a", "b", "ÿ", "x", "yy", "k", "m")]
    rows = []
    for i in range(400):
        lang, source = rng.choice(["en", "en", "de", None, "Ü"]), rng.choice([None, "s1", "s2", "s2", "s2", "é", "s3"])
        words = [rng.choice(vocabulary[: 10 + 6 * len(source or "")]).title() for _ in range(rng.randrange(0, 30))]
        rows.append((i, rng.choice([" ", "1", "\n", "-@"]).join(words), lang, source, None))
    rows += [(None, None, "en", "silent", None), (1, "", "en", "silent2", None), (2, "rare words only", "xx", "a", None), (3, "", "xx", "b", None), (4, "one source", "yy", "a", None)]
    return rows + [rows[3]] * 30 + [(9, "Tie tIE tie x", "en", f"t{i % 3}", 1) for i in range(12)] + [(10, "long " * 20_000, "en", "s1", 0)]


def table(spark, rows):
    names = ("n", "v", "m", "term", "a", "b", "chunk", "d", "first", "item", "value", "rank", "a.b")
    return spark.createDataFrame(rows, brute.SCHEMA).repartition(4).withColumns({n: F.lit(n) for n in names})


def test_against_brute_force(spark, spoken, same):
    same(divergence.op13_divergence(table(spark, spoken)), audited(spoken))


def test_other_parameters(spark, spoken, same):
    same(divergence.audit(table(spark, spoken), least=1, top=3), audited(spoken, 1, 3))


def test_small_tiles(spark, spoken, same):
    docs = table(spark, spoken)
    kept = divergence.kept_terms(docs, "text", "lang", "source", 10)
    sizes = divergence.group_sizes(docs, kept, "lang", "source")
    whole, tiled = divergence.source_pairs(kept, sizes), divergence.source_pairs(kept, sizes, chunk=2, terms=5)
    same(tiled, [tuple(r) for r in whole.collect()])


def test_flushing_changes_nothing(spark, spoken, same, monkeypatch):
    expected = audited(spoken)
    monkeypatch.setattr(divergence, "HELD", 7)
    counted = divergence.term_counts(table(spark, spoken).coalesce(1), "text", "lang", "source")
    once = counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d")).collect()
    said = Counter()
    for _, text, lang, source, _ in spoken:
        said.update(((lang or "", source or "", t) for t in TERM.findall((text or "").translate(brute.UPPER))))
    assert {(r["lang"], r["source"], r["term"]): r["n"] for r in once} == dict(said) and expected


def test_empty_table(no_docs):
    assert divergence.op13_divergence(no_docs).collect() == []


def test_skyband_is_exact():
    rng = random.Random(7)
    for _ in range(30):
        n, k = rng.randrange(1, 120), rng.randrange(1, 6)
        a, b = (np.array([rng.randrange(1, 12) for _ in range(n)]) for _ in range(2))
        terms = [f"t{i:03}".encode() for i in rng.sample(range(999), n)]
        dominators = [sum(a[j] >= a[i] and b[j] <= b[i] and terms[j] < terms[i] for j in range(n)) for i in range(n)]
        assert sorted(divergence.skyband(a, b, terms, k)) == [i for i in range(n) if dominators[i] < k]


def test_skybands_in_bounded_memory():
    rng = random.Random(8)
    rows = [("l", f"s{rng.randrange(3)}", f"t{i}", rng.randrange(1, 50), rng.randrange(1, 50), 0) for i in range(3000)]
    held = divergence.Skybands(5, group_rows=40, task_rows=60)
    handed = list(held.add(rows)) + list(held.drain())
    assert held.held == 0
    for s in ("s0", "s1", "s2"):
        some = [r for r in handed if r[1] == s]
        every = [r for r in rows if r[1] == s]
        of = lambda rs: {rs[i] for i in divergence.skyband(np.array([r[3] for r in rs]), np.array([r[4] for r in rs]), [r[2].encode() for r in rs], 5)}
        assert of(some) == of(every) and len(some) < len(every)


def test_shares_are_exact():
    rng = random.Random(1)
    cases = [(rng.randrange(10**e), rng.randrange(10**e) * 3 + 10**e, rng.randrange(10**6)) for e in range(1, 15) for _ in range(20)]
    c, n, v = (np.array(x, np.int64) for x in zip(*cases))
    assert divergence.share(c, n, v).tolist() == [1 + 10**9 * (x + 2) // (y + 2 * z) for x, y, z in cases]
