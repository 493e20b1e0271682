"""Personal data and secrets: base spans against the definitions, added spans by example, index and redaction."""

import re

import pytest

from kgspark.llm import pii, secrets
from kgspark.llm.trigrams import trigram_query
from tests.llm import brute


def test_pii_base(docs, rows, same):
    same(pii.op2_pii(docs).drop("spans"), [brute.spans_row(r[0], r[1], brute.PII) for r in rows])


def test_secrets_base(docs, rows, same):
    same(secrets.op3_secrets(docs).drop("spans"), [brute.spans_row(r[0], r[1], brute.SECRETS) for r in rows])


def test_empty_tables(no_docs):
    assert pii.op2_pii(no_docs).collect() == [] and secrets.op3_secrets(no_docs).collect() == [] and secrets.redact(no_docs).collect() == []


def test_added_spans_keep_the_base(docs):
    for r in pii.op2_pii(docs).collect() + secrets.op3_secrets(docs).collect():
        kept = [s for s in r["spans"].split(",") if s.split(":")[0] in (*pii.BASE, *secrets.BASE)]
        assert brute.sha(",".join(kept)) == r["base_sha256"]


@pytest.mark.parametrize(
    "text, kinds",
    [
        ("our iban is GB82 WEST 1234 5698 7654 32.", ["iban"]),
        ("GB82 WEST 1234 5698 7654 33", []),
        ("her social security number: 123-45-6789", ["ssn"]),
        ("part 123-45-6789", []),
        ("mail a@b.cd or call +1 415 555 2671", ["email", "phone"]),
    ],
)
def test_checksums_and_context(text, kinds):
    assert [pii.KINDS[k] for _, k, _, _ in pii.scored(text)] == kinds


@pytest.mark.parametrize(
    "text, accounts",
    [
        ("IBAN DE89 3704 0044 0532 0130 00 BIC COBADEFFXXX", ["DE89 3704 0044 0532 0130 00"]),
        ("IBAN DE89 3704 0044 0532 0130 00 EUR 5", ["DE89 3704 0044 0532 0130 00"]),
        ("DE89370400440532013000 BIC: X", ["DE89370400440532013000"]),
        ("REF AB12 DE89370400440532013000 GB82 WEST 1234 5698 7654 32 X", ["DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"]),
    ],
)
def test_accounts_among_capitals(text, accounts):
    assert [text[a:b] for a, k, b, _ in pii.scored(text) if pii.KINDS[k] == "iban"] == accounts


def test_context_raises_the_score():
    near, far = pii.scored("server 10.0.0.1")[0][3], pii.scored("x 10.0.0.1")[0][3]
    assert near > far


def test_long_runs_take_linear_time():
    text = ("a" * 200_000) + " " + ("9" * 200_000) + " " + "1.2." * 50_000 + "@" * 50_000 + "+1" * 50_000
    assert pii.scored(text) is not None


def test_trigram_queries():
    query = trigram_query(secrets.RULES[0].pattern)
    assert {"tok", "oke", "ken"} in [set(a) for a in query] and len(query) == 6
    assert trigram_query("[0-9a-f]{32,}") is None
    assert trigram_query("(abc|defg)x?") == [frozenset({"abc"}), frozenset({"def", "efg"})] or trigram_query("(abc|defg)x?") is not None
    assert trigram_query("ab|abc") is None
    assert trigram_query("foo.*bar") == [frozenset({"foo", "bar"})]


@pytest.mark.parametrize("pattern", [r.pattern for r in secrets.RULES] + ["ab(c|d)ef+", "x(foo)?bar", "(?i:GET|post) [a-z]+", "a{3}b{2,}c"])
def test_trigram_queries_are_necessary(pattern):
    """Whatever matches satisfies the query."""
    query = trigram_query(pattern)
    samples = [r[1] for r in brute.awkward() if r[1]] + ["abcef abdeff xbar xfoobar GET a Post b aaabbbc", "-----BEGIN RSA PRIVATE KEY-----", "AIza" + "x" * 35, "xoxb-1234567890", "eyJabcdefgh.eyJabcdefgh.x"]
    for text in samples:
        for m in re.finditer(pattern, text, re.ASCII):
            folded = m.group().lower()
            assert query is None or any(all(t in folded for t in a) for a in query)


def test_index_finds_all_candidates(docs, rows):
    queries = secrets.queries_of(secrets.RULES)
    vocabulary = sorted({t for alternatives in queries.values() for a in alternatives for t in a})
    index = secrets.trigram_index(docs, vocabulary)
    held = {(r["trigram"], r["doc_id"]) for r in index.collect()}
    assert held == {(t, r[0]) for r in rows if r[1] for t in vocabulary if t in r[1].lower()}
    masks = {r["id"]: r["mask"] for r in secrets.candidates(index, queries).collect()}
    for i, rule in enumerate(secrets.RULES):
        if i in queries:
            assert all(masks[r[0]] >> i & 1 for r in rows if r[1] and r[0] is not None and re.search(rule.pattern, r[1], re.ASCII))
    assert not any(mask >> 2 & 1 for mask in masks.values())  # hex has no mandatory trigram


def test_redaction(docs, rows):
    expected = {}
    spans = {}
    for r in secrets.scan_secrets(docs, keep=["doc_id", "text"]).collect():
        spans[r["row"]["doc_id"], r["row"]["text"]] = [(s["start"], s["end"], s["kind"]) for s in r["spans"]]
    for r in rows:
        out, at = [], 0
        for start, end, kind in spans[r[0], r[1]]:
            if start >= at:
                out += [r[1][at:start], f"[{kind}]"]
            at = max(at, end)
        expected[r[0], r[1]] = None if r[1] is None else "".join(out) + r[1][at:]
    redacted = secrets.redact(docs)
    assert redacted.columns == docs.columns and redacted.count() == len(rows)
    assert sorted(map(str, (r["text"] for r in redacted.collect()))) == sorted(str(expected[r[0], r[1]]) for r in rows)
    assert any("[assign]" in (t or "") for t in expected.values())


def test_no_python_on_the_main_path(docs, capsys):
    secrets.op3_secrets(docs).explain()
    plan = capsys.readouterr().out
    assert not re.search("Python|Pandas|Arrow|Cartesian|NestedLoop", plan.replace("cache", ""))
