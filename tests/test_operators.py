"""Operators against brute force on small fixtures."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from kgspark.errors import IngestError, ScopeError, UnknownCodeError
from kgspark.functions import text as X
from kgspark.operators import diff, hierarchy, resolve, rules, scope, sets, stats
from kgspark.plans import checks as C
from kgspark.plans.release_report import compare_releases, write_report


def edges_df(spark, pairs):
    return spark.createDataFrame(list(pairs), "child LONG, parent LONG")


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def one(spark, column, text):
    return spark.createDataFrame([(text,)], "t STRING").select(column(F.col("t"))).collect()[0][0]


# Functions.

def test_identifier_functions(spark):
    assert one(spark, X.base_accession, "P21359-2") == "P21359"
    assert one(spark, X.base_accession, "P21359") == "P21359"
    assert one(spark, lambda c: X.curie("HGNC", c), "HGNC:7765") == "HGNC:7765"
    assert one(spark, lambda c: X.curie("HGNC", c), "7765") == "HGNC:7765"
    known = {"GO": "http://go/", "X": "http://x/"}
    assert one(spark, lambda c: X.expand_curie(c, known), "GO:1:2") == "http://go/1:2"
    assert one(spark, lambda c: X.expand_curie(c, known), "ZZ:1") is None
    assert one(spark, lambda c: X.model_term(c, "http://m#"), "<http://m#uses>") == "uses"
    assert one(spark, lambda c: X.model_term(c, "http://m#"), "http://m#") is None
    assert one(spark, X.trim_blanks, " \t a b\r\n") == "a b"
    assert one(spark, X.pad_month, "2026-06") == "2026-06-01"
    assert one(spark, X.pad_month, "2026-06-15") == "2026-06-15"
    assert one(spark, X.licence_url, "MIT") == "https://spdx.org/licenses/mit"
    assert one(spark, X.licence_url, "CC-BY-4.0") == "https://creativecommons.org/licenses/by/4.0/"
    for key, kind in (("2026-09-21", "date"), ("v97", "release_tag"), ("V1", "release_tag"), ("latest", "invalid")):
        assert one(spark, X.snapshot_key_class, key) == kind


# Scope and codes.

def test_scope_validates_dropped_rows_too(spark):
    df = spark.createDataFrame([("a", "Homo sapiens "), ("b", "Mus musculus"), ("c", "Mus muscullus")], "id STRING, sp STRING")
    known = ["Homo sapiens", "Mus musculus"]
    assert scope.scope_filter(df, "sp", "Homo sapiens", known).count() == 1
    with pytest.raises(UnknownCodeError, match="Mus muscullus"):
        scope.scope_filter(df, "sp", "Homo sapiens", known, strict=True)
    with pytest.raises(UnknownCodeError):
        scope.scope_filter(df, "sp", "Nobody", known)
    tally = scope.scope_tally(df, "sp", "Homo sapiens")
    assert rows(scope.top_dropped(tally)) == [("Mus muscullus", 1), ("Mus musculus", 1)]


def test_mixed_edges_are_errors(spark):
    ids = spark.createDataFrame([(1,), (2,)], "id LONG")
    good = edges_df(spark, [(2, 1), (4, 3)])
    assert rows(scope.scope_edges(good, ids).select("child", "parent")) == [(2, 1)]
    with pytest.raises(ScopeError, match="3 -> 1"):
        scope.scope_edges(edges_df(spark, [(2, 1), (3, 1)]), ids)


def test_unknown_code_never_gets_a_default(spark):
    df = spark.createDataFrame([(" TAS",), ("IEA",), ("XXX",)], "code STRING")
    vocabulary = {"TAS": "ECO:1", "IEA": "ECO:2"}
    mapped = rules.map_codes(df, "code", vocabulary, "term")
    assert rows(mapped.filter("term IS NOT NULL").select("term")) == [("ECO:1",), ("ECO:2",)]
    assert rows(rules.unknown_codes(mapped, "code", "term")) == [("XXX", 1)]
    with pytest.raises(UnknownCodeError, match="XXX"):
        rules.map_codes(df, "code", vocabulary, "term", strict=True)


def test_required_rule_counts_nulls_and_blanks(spark):
    df = spark.createDataFrame([("x",), (" ",), (None,)], "v STRING")
    found = rules.check_rules(df, [rules.ColumnRule("v", "required"), rules.ColumnRule("v", "equals", "x")])
    assert {r["rule"]: r["violations"] for r in found.collect()} == {"v:required": 2, "v:equals": 1}


# Resolution.

@pytest.fixture(scope="module")
def resolution(spark):
    dictionary = spark.createDataFrame(
        [("1", "G1", " P1 | P2 |"), ("2", "G2", "P2"), ("3", "G3", None), ("4", "G4", "P2|P2")],
        "id STRING, symbol STRING, aliases STRING")
    raw = spark.createDataFrame(
        [("P1", "a", "T"), ("P1", "a", "T"), ("P2-3", "a", "I"), ("P9", "b", "T"), ("P9", "a", "I"), ("P9-1", "a", "I")],
        "accession STRING, pathway STRING, code STRING")
    return resolve.alias_map(dictionary), resolve.collapse(raw)


def test_fan_out(resolution):
    aliases, folded = resolution
    assert rows(aliases) == [("P1", "1"), ("P2", "1"), ("P2", "2"), ("P2", "4")]
    assert rows(resolve.resolve(folded, aliases)) == [
        ("1", "a", "I", "P2-3"), ("1", "a", "T", "P1"), ("2", "a", "I", "P2-3"), ("4", "a", "I", "P2-3")]
    assert rows(resolve.fanout_rows(folded, aliases)) == [(0, 3), (1, 2), (3, 1)]


def test_unresolved(resolution):
    aliases, folded = resolution
    assert rows(resolve.unresolved(folded, aliases)) == [("P9", 2, "a", "I"), ("P9-1", 1, "a", "I")]
    fraction = resolve.unresolved_fraction(folded, aliases, off_scope_rows=4)
    row = fraction.collect()[0]
    assert (row["rows_in_scope"], row["unresolved_rows"], row["fraction"]) == (10, 3, 0.3)
    with pytest.raises(IngestError, match="30.00%"):
        resolve.require_resolved(fraction, 0.1)
    assert resolve.require_resolved(fraction, 0.3) == 0.3
    with pytest.raises(IngestError, match="no rows"):
        resolve.require_resolved(resolve.unresolved_fraction(folded.limit(0), aliases))


def test_last_symbol_wins(spark):
    df = spark.createDataFrame([("1", "B", 1), ("1", "A", 2)], "id STRING, symbol STRING, line INT")
    assert rows(resolve.symbol_table(df, order_col="line")) == [("1", "A")]


# Hierarchy.

def brute_depth(nodes, pairs):
    parents = defaultdict(set)
    for child, parent in pairs:
        parents[child].add(parent)
    def depth(n):
        return 1 + max((depth(p) for p in parents[n]), default=-1)
    return {n: depth(n) for n in nodes}


def brute_closure(pairs):
    closed = set(pairs)
    while True:
        more = {(a, d) for a, b in closed for c, d in closed if b == c} - closed
        if not more:
            return closed
        closed |= more


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_dag(spark, seed):
    rng = random.Random(seed)
    nodes = list(range(40))
    pairs = {(c, rng.randrange(c)) for c in nodes[1:] for _ in range(rng.choice([0, 1, 1, 2, 3]))}
    df, ids = edges_df(spark, pairs), spark.createDataFrame([(n,) for n in nodes], "id LONG")
    assert dict(rows(hierarchy.depth(ids, df))) == brute_depth(nodes, pairs)
    closed = brute_closure(pairs)
    assert set(rows(hierarchy.ancestors(df))) == closed
    start = ids.filter("id > 30")
    assert set(rows(hierarchy.ancestors_of(df, start))) == {(a, b) for a, b in closed if a > 30}
    assert hierarchy.find_cycle_nodes(df).count() == 0
    assert hierarchy.name_cycle(df).count() == 0


def test_longest_of_two_parents_at_different_depths(spark):
    pairs = [(1, 0), (2, 1), (3, 2), (3, 0)]
    ids = spark.createDataFrame([(n,) for n in range(5)], "id LONG")
    assert dict(rows(hierarchy.depth(ids, edges_df(spark, pairs)))) == {0: 0, 1: 1, 2: 2, 3: 3, 4: 0}


def test_cycle_with_tails(spark):
    # 5 -> 6 -> 7 -> 5 is a cycle; 8 and 9 hang below it; 1 -> 0 is a clean tail; 7 also has a clean parent.
    pairs = [(1, 0), (5, 6), (6, 7), (7, 5), (7, 0), (8, 5), (9, 8), (9, 1)]
    df = edges_df(spark, pairs)
    assert rows(hierarchy.find_cycle_nodes(df)) == [(5,), (6,), (7,), (8,), (9,)]
    assert rows(hierarchy.name_cycle(df)) == [(0, 5), (1, 6), (2, 7)]
    ids = spark.createDataFrame([(n,) for n in (0, 1, 5, 8, 9)], "id LONG")
    assert dict(hierarchy.depth(ids, df).collect()) == {0: 0, 1: 1, 5: None, 8: None, 9: None}
    row = C.chk_acyclic(df).collect()[0]
    assert (row["status"], row["violations"]) == ("FAIL", 5)
    assert set(rows(hierarchy.ancestors(df))) == brute_closure(pairs)


def test_self_loop_is_a_cycle(spark):
    df = edges_df(spark, [(1, 1), (2, 0)])
    assert rows(hierarchy.find_cycle_nodes(df)) == [(1,)]
    assert rows(hierarchy.name_cycle(df)) == [(0, 1)]


def test_long_cycle_is_named_in_order(spark):
    n = 37
    pairs = [(i, (i + 1) % n) for i in range(n)] + [(100 + i, i) for i in range(5)]
    assert rows(hierarchy.name_cycle(edges_df(spark, pairs))) == [(i, i) for i in range(n)]


def test_closure_is_reported_not_added(spark):
    members = spark.createDataFrame([(1, 2), (1, 1), (2, 2)], "gene LONG, pathway LONG")
    df = edges_df(spark, [(2, 1)])
    assert rows(hierarchy.closure_violations(members, df)) == [(2, 1)]
    assert rows(hierarchy.gene_ancestors(members, df)) == [(1, 1), (1, 2), (2, 1), (2, 2)]


# Distributions.

def brute_distribution(values):
    ordered = sorted(values)
    pick = lambda f: ordered[round(f * (len(ordered) - 1))]
    return (len(ordered), math.fsum(ordered) / len(ordered), ordered[0], pick(0.25), pick(0.5), pick(0.75), pick(0.95), ordered[-1])


@pytest.mark.parametrize("values", [
    [7], [1, 2], [1, 2, 3], [0, 0, 0, 5], list(range(100)), [1, 1, 2, 2, 1000000, 3, 70000, 5, 9, 11], [-5, -3, 0, 4, 4, 4, 4],
])
def test_integer_distribution(spark, values):
    got = stats.distribution(spark.createDataFrame([(v,) for v in values], "v LONG"), "v").collect()[0]
    assert tuple(got) == pytest.approx(brute_distribution(values))
    assert isinstance(got["median"], int)


def test_random_distributions_per_group(spark):
    rng = random.Random(5)
    data = [(g, rng.choice([rng.randrange(10), int(rng.paretovariate(0.6)), 0])) for g in "abc" for _ in range(rng.randrange(1, 400))]
    got = stats.distribution(spark.createDataFrame(data, "g STRING, v LONG"), "v", by=["g"]).collect()
    for row in got:
        want = brute_distribution([v for g, v in data if g == row["g"]])
        assert tuple(row)[1:] == pytest.approx(want)
    assert len(got) == 3


def test_distribution_of_infinite_and_missing_numbers(spark):
    inf, nan = float("inf"), float("nan")
    frame = lambda values: spark.createDataFrame([(v,) for v in values], "v DOUBLE")
    got = stats.distribution(frame([1.0, 2.0, nan]), "v").collect()[0]
    assert (got["n"], got["min"], got["p25"], got["median"]) == (3, 1.0, 1.0, 2.0)
    assert all(math.isnan(got[k]) for k in ("mean", "p75", "p95", "max"))
    got = stats.distribution(frame([-inf, -1.5, 0.0, 5e-324, 1.5, inf]), "v").collect()[0]
    assert (got["min"], got["p25"], got["median"], got["p75"], got["max"]) == (-inf, -1.5, 0.0, 1.5, inf)


def test_order_key_never_decreases(spark):
    rng = random.Random(3)
    values = [rng.uniform(-1, 1) * 10.0 ** rng.randrange(-300, 300) for _ in range(3000)] + [2.0**k * m for k in range(-60, 60) for m in (1, 1 - 2**-53, -1)]
    frame = spark.createDataFrame([(v,) for v in [*values, 0.0, float("inf"), float("-inf"), float("nan")]], "v DOUBLE")
    keys = [r["k"] for r in frame.withColumn("k", stats._order_key(F.col("v"))).orderBy("v").collect()]
    assert keys == sorted(keys)


def test_clustered_values_are_spread(spark):
    """250,000 values close together: exact, and no window sees more than a small part of them."""
    df = spark.range(250_000).selectExpr("1700000000 + (id * 7919) % 250000 AS v")
    got = stats.distribution(df, "v").collect()[0]
    at = lambda f: 1_700_000_000 + round(f * 249_999)
    assert (got["min"], got["p25"], got["median"], got["p75"], got["p95"], got["max"]) == (at(0), at(0.25), at(0.5), at(0.75), at(0.95), at(1))
    keys = df.select(stats._order_key(F.col("v")).alias("k"))
    for above, below in zip((60, *stats.LEVELS), (*stats.LEVELS, 0)):
        cells = keys.select(F.shiftright("k", above).alias("a"), F.shiftright("k", below).alias("b")).distinct()
        assert cells.groupBy("a").count().agg(F.max("count")).collect()[0][0] <= 1 << 17


def test_double_distribution(spark):
    rng = random.Random(6)
    values = [rng.gauss(0, 100) for _ in range(301)] + [0.0, -0.5]
    got = stats.distribution(spark.createDataFrame([(v,) for v in values], "v DOUBLE"), "v").collect()[0]
    assert tuple(got) == pytest.approx(brute_distribution(values))


def test_empty_distribution(spark):
    row = stats.distribution(spark.createDataFrame([], "v LONG"), "v").collect()[0]
    assert row["n"] == 0 and all(row[c] is None for c in ("mean", "min", "p25", "median", "p75", "p95", "max"))


def test_halfway_rank_rounds_to_even(spark):
    # n = 3: 0.25 * 2 = 0.5 -> rank 0; 0.75 * 2 = 1.5 -> rank 2.
    row = stats.distribution(spark.createDataFrame([(10,), (20,), (30,)], "v LONG"), "v").collect()[0]
    assert (row["p25"], row["p75"]) == (10, 30)


def test_sample_is_reproducible(spark):
    df = spark.createDataFrame([(i % 50,) for i in range(500)], "k LONG")
    a, b = rows(stats.seeded_sample(df, "k", 7, 97)), rows(stats.seeded_sample(df.repartition(5), "k", 7, 97))
    assert a == b and len(a) == 7 and a != rows(stats.seeded_sample(df, "k", 7, 98))


# Sets.

def test_identical_sets_and_containment(spark):
    members = [("a", 1), ("a", 2), ("b", 2), ("b", 1), ("b", 1), ("c", 1), ("d", 1), ("e", 3)]
    df = spark.createDataFrame(members, "pathway STRING, gene LONG")
    assert rows(sets.identical_sets(df)) == [("a", 2, 2), ("c", 2, 1)]
    assert rows(sets.largest_identical_group(sets.identical_members(df))) == [("a", 2), ("b", 2)]
    pairs = spark.createDataFrame([("c", "a"), ("a", "c"), ("e", "a"), ("a", "zz")], "child STRING, parent STRING")
    got = {(r["child"], r["parent"]): r["fraction"] for r in sets.containment(pairs, df).collect()}
    assert got == {("c", "a"): 1.0, ("a", "c"): 0.5, ("e", "a"): 0.0}
    summary = sets.containment_summary(sets.containment(pairs, df)).collect()[0]
    assert (summary["pairs_compared"], summary["fully_contained"], summary["fully_contained_fraction"]) == (3, 1, 0.3333)
    nothing = sets.containment_summary(sets.containment(pairs, df.limit(0))).collect()[0]
    assert (nothing["pairs_compared"], nothing["fully_contained_fraction"]) == (0, 0.0)


def test_colliding_fingerprints_are_split(spark, monkeypatch):
    """With hashes that always collide, the proof on members must still tell sets apart."""
    real = sets._fingerprints

    def blunt(held, seeds):
        if seeds < 4:
            return held.groupBy("pathway").agg(F.count(F.lit(1)).alias("genes")), ["genes"]
        return real(held, seeds)

    monkeypatch.setattr(sets, "_fingerprints", blunt)
    df = spark.createDataFrame([("a", 1), ("b", 2), ("c", 1)], "pathway STRING, gene LONG")
    assert rows(sets.identical_sets(df)) == [("a", 2, 1)]


def test_empty_sets_and_band(spark):
    nodes = spark.createDataFrame([("a",), ("b",), ("z",)], "id STRING")
    df = spark.createDataFrame([("a", i) for i in range(5)] + [("b", 1)], "pathway STRING, gene INT")
    assert rows(sets.empty_sets(nodes, df)) == [("z",)]
    assert rows(sets.scoring_band(df, 2, 4)) == [(0, 1, 1)]
    assert rows(sets.all_set_sizes(nodes, df)) == [("a", 5), ("b", 1), ("z", 0)]


def test_reconcile_sets(spark):
    ours = spark.createDataFrame([("k", "a"), ("k", "b"), ("k", "b"), ("l", "x")], "key STRING, member STRING")
    theirs = spark.createDataFrame([("k", "b"), ("k", "c"), ("m", "y"), ("l", "x")], "key STRING, member STRING")
    assert rows(sets.reconcile_sets(ours, theirs)) == [
        ("k", 2, 2, 1, 1, False), ("l", 1, 1, 0, 0, True), ("m", 0, 1, 1, 0, False)]
    sample = spark.createDataFrame([("l",)], "key STRING")
    assert rows(sets.reconcile_sets(ours, theirs, sample)) == [("l", 1, 1, 0, 0, True)]
    assert C.chk_members(ours, theirs).collect()[0]["status"] == "WARN"


# Diff.

def test_release_diff(spark, tmp_path):
    old = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "c")], "id STRING, label STRING")
    new = spark.createDataFrame([("2", "B"), ("3", "c"), ("4", "a"), ("5", "a")], "id STRING, label STRING")
    changes, report = compare_releases(old, new, "v96", "V97", str(tmp_path / "history"), infer_successors=True)
    assert rows(changes.select("id", "change")) == [("1", "retired"), ("2", "relabelled"), ("4", "added"), ("5", "added")]
    history = spark.read.parquet(str(tmp_path / "history"))
    assert rows(history) == [("1", "a", "V96", "V97", "5")]
    write_report(report, str(tmp_path / "report"))
    text = [r["line"] for r in report.orderBy("block", "key").collect()]
    assert text[0] == "# V96 -> V97 diff" and "- retired: **1**" in text and "| `1` | a | `5` |" in text and "| `2` | b | B |" in text
    many = spark.range(1_000).selectExpr("id", "concat('old ', id) AS label")
    renamed = spark.range(1_000).selectExpr("id", "concat('new ', id) AS label")
    _, lines = compare_releases(many, renamed, "v1", "v2", str(tmp_path / "h2"))
    assert lines.filter("block = 5").count() == 1_000
    plain = diff.retired_rows(diff.release_diff(old, new), "96", "97")
    assert plain.collect()[0]["replaced_by"] is None


# Checks with and without faults.

def test_counts_against_expectation(spark):
    nodes = spark.range(100)
    status = lambda *a, **k: C.chk_count(nodes, *a, **k).collect()[0]["status"]
    assert status(None) == "PASS" and status(100) == "PASS" and status(105) == "PASS" and status(110) == "FAIL"
    assert status(100, ceiling=50) == "FAIL"
    large = C.chk_count(spark.range(20_000), 20_000).collect()[0]
    assert large["status"] == "PASS"
    total = C.chk_total(spark.range(5)).collect()[0]
    assert (total["status"], total["detail"]) == ("PASS", "5 statements, nothing to compare")


def test_cardinality_counts_zero_and_two(spark):
    nodes = spark.createDataFrame([("a", "t"), ("b", None), ("c", "t"), ("c", "u")], "id STRING, taxon STRING")
    assert rows(C.taxon_cardinality(nodes, nodes)) == [("b", 0), ("c", 2)]
    assert C.chk_taxon(nodes, "t").collect()[0]["violations"] == 1
    clean = nodes.filter("id = 'a'")
    assert C.chk_cardinality(clean, clean).collect()[0]["status"] == "PASS"


def test_evidence_check(spark):
    facts = spark.createDataFrame([(1, "T"), (2, "X"), (3, None)], "gene INT, code STRING")
    row = C.chk_evidence(facts, ["T"]).collect()[0]
    assert row["status"] == "FAIL" and row["detail"] == "unexpected codes: 1 from X; without evidence: 1"
    assert C.chk_evidence(facts.filter("code = 'T'"), ["T"]).collect()[0]["status"] == "PASS"


def test_spot_check_problems(spark):
    facts = spark.createDataFrame([(1, "a", "T", "P"), (1, "a", "I", "P"), (1, "b", "T", "P")], "gene INT, pathway STRING, code STRING, accession STRING")
    nodes = spark.createDataFrame([("a", "Ras signal"), ("b", "MAP kinase x")], "id STRING, label STRING")
    pairs = spark.createDataFrame([("a", "b")], "child STRING, parent STRING")
    words = dict(folded=["RAS", "MAPK"], exact=["MAP kinase"])
    good = C.spot_check(facts, nodes, pairs, 1, "a", **words)
    assert rows(good) == [(3, True, 2, 2)]
    assert C.chk_spot(good).collect()[0]["status"] == "PASS"
    none = C.chk_spot(C.spot_check(facts, nodes, pairs, 2, "a", **words)).collect()[0]
    assert none["violations"] == 4 and none["detail"].startswith("no pathways; ")
    flat = C.chk_spot(C.spot_check(facts, nodes, pairs.limit(0), 1, "zz", **words)).collect()[0]
    assert flat["detail"] == "required pathway absent; one level only"


def test_suite_verdict_and_report(spark):
    nodes = spark.range(100)
    results = C.suite([C.chk_count(nodes, 100), C.chk_count(nodes, 200)])
    assert not C.accepted(results) and C.accepted(results.filter("status = 'PASS'"))
    assert "| 4. node count | **FAIL** | 100 nodes, expected 200 |" in C.markdown(results, "Checks")
    assert Counter(r["status"] for r in results.collect()) == {"PASS": 1, "FAIL": 1}
