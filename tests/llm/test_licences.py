"""License scans: places and labels by their definition, expressions by example and by plain evaluation."""

import random
import re

import pytest
from pyspark.sql import functions as F

from kgspark.llm import licences
from tests.llm import brute

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PIECES = ["under the MIT License", "UNDER-the mit.license", "Apache License, Version 2.0", "CC BY-NC 4.0", "cc by nc", "under the", "mit", "é", "all rights\nreserved", "x1", "GNU General Public License"]


def base_row(doc_id, text):
    words = WORDS.findall((text or "").translate(brute.UPPER))
    places = [
        (i, label) for phrase, label in licences.BASE.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()
    ]
    starts = [i for i, _ in places]
    return doc_id, len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({label for _, label in places}))


@pytest.fixture(scope="module")
def licensed(rows):
    rng = random.Random(4)
    texts = [rng.choice([" ", "\n", ". "]).join(rng.choices(PIECES, k=rng.randrange(1, 40))) for _ in range(80)]
    texts += ["under the mit license " * 3000, texts[0], "SPDX-License-Identifier: MIT", "xunder the mit license", "under the mit licensee"]
    return rows + [(1000 + i, t, None, None, None) for i, t in enumerate(texts)]


def test_base(spark, licensed, same):
    docs = spark.createDataFrame(licensed, brute.SCHEMA).repartition(4).withColumns({n: F.lit(n) for n in ("row", "out", "labels", "b", "a.b")})
    found = licences.op11_licences(docs)
    same(found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels"), [base_row(r[0], r[1]) for r in licensed])
    for r in found.collect():
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1


def test_empty_table(no_docs):
    assert licences.op11_licences(no_docs).collect() == []


@pytest.mark.parametrize(
    "text, polish",
    [
        ("MIT", "mit"),
        ("MIT OR GPL-2.0-only AND Apache-2.0", "mit gpl-2.0-only apache-2.0 AND OR"),
        ("(MIT OR GPL-2.0-only) AND Apache-2.0", "mit gpl-2.0-only OR apache-2.0 AND"),
        ("GPL-2.0-or-later WITH Classpath-exception-2.0 OR MIT\nmore", "gpl-2.0-or-later classpath-exception-2.0 WITH mit OR"),
        ("MIT. This file", "mit"),
        ("MIT) more", "mit"),
        ("((((mit))))", "mit"),
        ("", ""), ("OR MIT", ""), ("MIT AND", ""), ("(MIT", ""), ("MIT WITH (x)", ""), ("()", ""),
    ],
)
def test_expressions(text, polish):
    found, _ = licences.parsed(text.lower().encode(), 0)
    assert " ".join(t.upper() if t in licences.BINDS else t for t in found) == polish


def plainly(tree):
    """Infix text and freedom of a random expression tree."""
    if isinstance(tree, str):
        return tree, licences.FREEDOM.get(licences.label_of(tree), licences.UNKNOWN)
    operator, left, right = tree
    (a, x), (b, y) = plainly(left), plainly(right)
    return f"({a}) {operator} ({b})", max(x, y) if operator == "or" else min(x, y)


def test_evaluation_of_random_trees():
    rng = random.Random(9)

    def tree(depth):
        return rng.choice(["mit", "gpl-3.0", "cc-by-nc-4.0", "odd-1"]) if depth == 0 or rng.random() < 0.2 else (rng.choice(["and", "or"]), tree(depth - 1), tree(depth - 1))

    for _ in range(50):
        text, freedom = plainly(tree(5))
        labels, found = licences.evaluated(licences.parsed(text.encode(), 0)[0])
        assert found == freedom and labels <= {"mit", "gpl", "cc-by-nc", "odd-1"}


def test_tags_add_labels_and_freedom():
    text = b"# SPDX-License-Identifier: (MIT OR GPL-3.0+) AND Apache-2.0 WITH LLVM-exception\nunder the mit license\nLicense-Expression: odd"
    n_words, tags, found, expressions = licences.statements(text)
    assert tags == 2 and expressions == ["mit gpl-3.0+ OR apache-2.0 llvm-exception WITH AND", "odd"]
    assert {label for _, label, _, _ in found} == {"mit", "gpl", "apache-2", "odd"}
    assert min(v for *_, v in found) == licences.UNKNOWN and [s[1] for s in found if s[2]] == ["mit"]


def test_long_texts_are_linear():
    many = b"SPDX-License-Identifier: MIT all rights reserved " * 20_000 + b"SPDX-License-Identifier: " + b"(" * 100_000
    _, tags, found, _ = licences.statements(many)
    assert tags == 20_001 and len(found) == 40_000
