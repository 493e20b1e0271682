"""License scans: an Aho-Corasick automaton finds notice phrases and identifier tags, a shunting-yard parser evaluates tags.

The automaton runs over a text's words with single spaces between them, so line breaks, case and punctuation inside a
phrase do not matter. What follows an identifier tag is read from the text itself: identifiers joined by AND, OR and WITH.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kgspark.llm.decontaminate import FOLD
from kgspark.llm.shared import map_text

#: Base phrases and their labels. Fixed values.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: Further phrases of the method. Fixed values.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "permission to use copy modify and or distribute this software": "isc",
    "boost software license": "boost",
    "mozilla public license": "mpl",
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl",
    "cc by 4 0": "cc-by",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "creative commons attribution noncommercial": "cc-by-nc",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons zero": "cc0",
    "released into the public domain": "public-domain",
    "all rights reserved": "reserved",
}
#: Words of the tags that an expression follows, as the automaton sees them. Fixed values.
TAGS = ("spdx license identifier", "license expression")
TAG = re.compile(rb"(?<![a-z0-9\x80-\xff])(?:spdx-license-identifier|license-expression)[ \t]*:")
TOKEN = re.compile(rb"[ \t]*([a-z0-9.+-]+|[()])")
#: Labels of identifiers that do not carry their label as a name. Fixed values.
IDENTIFIERS = {
    "apache-2.0": "apache-2", "bsd-2-clause": "bsd", "bsd-3-clause": "bsd", "0bsd": "bsd", "bsl-1.0": "boost", "unlicense": "public-domain",
    "cc0-1.0": "cc0", "mpl-2.0": "mpl",
}
FAMILIES = re.compile(r"(cc-by(?:-nc|-sa|-nd)*|a?gpl|lgpl)-[0-9.]+(?:-only|-or-later)?$")
#: How freely a text under a label may be used, 0 to 1; any other label counts as UNKNOWN. Fixed values.
FREEDOM = {
    "public-domain": 1.0, "cc0": 1.0, "mit": 0.9, "bsd": 0.9, "isc": 0.9, "boost": 0.9, "apache-2": 0.9, "cc-by": 0.9,
    "mpl": 0.6, "lgpl": 0.6, "cc-by-sa": 0.5, "gpl": 0.4, "agpl": 0.3, "cc-by-nd": 0.2, "cc-by-nc": 0.2, "reserved": 0.0,
}
UNKNOWN, EXCEPTION = 0.1, 0.2
#: Operators by how tightly they bind.
BINDS = {"or": 1, "and": 2, "with": 3}
FIELDS = "n_words bigint, n_tags bigint, base array<boolean>, labels array<string>, places array<bigint>, values array<double>, expressions array<string>"


@cache
def automaton() -> ahocorasick.Automaton:
    """All phrases and tags; a match carries (number of words, label or None for a tag, base)."""
    made = ahocorasick.Automaton()
    for phrases, base in ((BASE, True), (NOTICES, False), (dict.fromkeys(TAGS), False)):
        for phrase, label in phrases.items():
            made.add_word(f" {phrase} ", (len(phrase.split()), label, base))
    made.make_automaton()
    return made


def label_of(identifier: str) -> str:
    """Label of a licence identifier; one that is not known is its own label."""
    name = identifier.removesuffix("+")
    family = FAMILIES.match(name)
    return family.group(1) if family else IDENTIFIERS.get(name, name)


def parsed(text: bytes, at: int) -> tuple[list[str], int]:
    """Reverse Polish form of the expression at ``at`` (empty if broken) and where it ends.

    It ends before the first token that cannot follow. A dangling operator or an open bracket breaks it.
    """
    out: list[str] = []
    waiting: list[str] = []
    operand = False  # whether the last token ended an operand
    while m := TOKEN.match(text, at):
        token = m.group(1).decode().rstrip(".")
        if token == ")":
            if not operand or "(" not in waiting:
                break
            while (top := waiting.pop()) != "(":
                out.append(top)
        elif token in BINDS:
            if not operand:
                break
            while waiting and BINDS.get(waiting[-1], 0) >= BINDS[token]:
                out.append(waiting.pop())
            waiting.append(token)
            operand = False
        elif operand or not token:
            break
        elif token == "(":
            if waiting and waiting[-1] == "with":
                break
            waiting.append(token)
        else:
            out.append(token)
            operand = True
        at = m.end()
    if not operand or "(" in waiting:
        return [], at
    return [*out, *reversed(waiting)], at


def evaluated(polish: list[str]) -> tuple[set[str], float]:
    """Labels of the licences of an expression and its freedom: OR lets the user choose, AND binds to both, an exception
    of WITH loosens."""
    labels: set[str] = set()
    stack: list[tuple[str, float]] = []
    for token in polish:
        if token in BINDS and len(stack) > 1:
            (_, right), (name, left) = stack.pop(), stack.pop()
            stack.append((name, {"or": max(left, right), "and": min(left, right), "with": min(1.0, left + EXCEPTION)}[token]))
        else:
            stack.append((token, FREEDOM.get(label_of(token), UNKNOWN)))
    exceptions = {polish[i - 1] for i, token in enumerate(polish) if token == "with"}
    labels.update(label_of(token) for token in polish if token not in BINDS and token not in exceptions)
    return labels, stack[-1][1]


def statements(text: bytes | None) -> tuple[int, int, list[tuple[int, str, bool, float]], list[str]]:
    """Number of words, of tags, (word place, label, base, freedom) of every statement found, expressions."""
    folded = (text or b"").translate(FOLD)
    words = folded.split()
    plain = (b" " + b" ".join(words) + b" ").decode("latin-1")
    found: list[tuple[int, str, bool, float]] = []
    at, seen, tagged = 0, 0, False
    for end, (size, label, base) in automaton().iter(plain):
        seen, at = seen + plain.count(" ", at, end), end  # spaces before the one that ends the match
        if label is None:
            tagged = True
        else:
            found.append((seen - size, label, base, FREEDOM[label]))
    expressions: list[str] = []
    tags = 0
    if tagged:
        lower = text.lower()  # of bytes: A-Z only
        at, place = 0, 0
        for m in TAG.finditer(lower):
            tags += 1
            place, at = place + len(folded[at : m.start()].split()), m.start()
            polish, _ = parsed(lower, m.end())
            if polish:
                labels, freedom = evaluated(polish)
                expressions.append(" ".join(t.upper() if t in BINDS else t for t in polish))
                found.extend((place, label, False, freedom) for label in sorted(labels))
    return len(words), tags, sorted(found), expressions


def scan_licences(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``row`` (the kept columns) and ``out``: n_words, n_tags, and parallel arrays base, labels, places, values of all
    statements by place, then by label; expressions in reverse Polish form.

    Null and empty texts have no word and no statement; repeated rows are scanned each; an empty table gives no row. Work
    is linear in the length of a text. Nothing is shuffled. A tag whose expression is broken counts in n_tags only.
    """

    def kernel(texts: list) -> dict[str, list]:
        made = [statements(t) for t in texts]
        return {
            "n_words": [m[0] for m in made], "n_tags": [m[1] for m in made],
            "base": [[s[2] for s in m[2]] for m in made], "labels": [[s[1] for s in m[2]] for m in made],
            "places": [[s[0] for s in m[2]] for m in made], "values": [[s[3] for s in m[2]] for m in made], "expressions": [m[3] for m in made],
        }

    return map_text(docs, text_col, kernel, FIELDS, keep)


def op11_licences(docs: DataFrame) -> DataFrame:
    """Digest per document. ``score``: freedom of the strictest statement, all of which bind; 0 where there is none."""
    of = lambda kept: F.filter(F.arrays_zip("out.base", "out.labels", "out.places"), kept)
    found = scan_licences(docs, keep=["doc_id"]).withColumn("b", of(lambda s: s["base"]))
    joined = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return found.select(
        F.col("row.doc_id").alias("doc_id"), F.col("out.n_words").alias("n_words"), F.size("b").cast("bigint").alias("n_base"),
        F.array_min("b.places").alias("first_word"), F.array_max("b.places").alias("last_word"),
        joined(F.col("b.labels")).alias("base_labels"), joined(F.col("out.labels")).alias("labels"),
        F.coalesce(F.array_min("out.values"), F.lit(0.0)).alias("score"), F.col("out.n_tags").alias("n_tags"),
        F.array_join("out.expressions", "; ").alias("expressions"),
    )
