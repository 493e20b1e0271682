"""Statements as numbers: a dictionary of terms, id columns in the table, text only where an answer is shown.

A term is its text and its kind, as in :func:`kgspark.operators.quads.match`. Its id is a hash of both, so statements are
encoded row by row, without a join; the dictionary proves that no two terms share an id, or the hash gets another seed.
Joins, grouping and duplicates then move three longs a statement.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from kgspark.session import observed, remove_shared, write_shared

Pattern = tuple[str, str, str]
IRI = "iri"


def _id(text: Column, kind: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), kind, text)


def _object_kind() -> Column:
    return F.concat_ws("^^", "o_kind", "o_datatype")


@dataclass(frozen=True)
class Encoded:
    """``statements`` (graph, s, p, o; ids but for the graph) and their ``terms`` (id, text, kind)."""

    statements: DataFrame
    terms: DataFrame
    seed: int

    def id_of(self, text: str, kind: str = IRI) -> Column:
        """Id of a term; one that no statement holds has one too."""
        return _id(F.lit(text), F.lit(kind), self.seed)

    def decode(self, df: DataFrame, names: Sequence[str]) -> DataFrame:
        """``df`` with the text of its id columns ``names`` in place of the ids."""
        for name in names:
            text = self.terms.select(F.col("id").alias(name), F.col("text").alias("_text"))
            df = df.join(text, name, "left").withColumn(name, F.col("_text")).drop("_text")
        return df


def encode(quads: DataFrame) -> Encoded:
    """Encode statements ``graph, s, p, o, o_kind, o_datatype``; both tables are stored.

    The only shuffle of text is that of the distinct terms, which are written once; repeated statements stay repeated.
    """
    iri = F.lit(IRI)
    parts = [("s", F.col("s"), iri), ("p", F.col("p"), iri), ("o", F.col("o"), _object_kind())]
    named = quads.select(F.inline(F.array(*[F.struct(text.alias("text"), kind.alias("kind")) for _, text, kind in parts])))
    named, seed = named.filter(F.col("text").isNotNull()).distinct(), 0
    while True:
        terms = write_shared(named.select(_id(F.col("text"), F.col("kind"), seed).alias("id"), "text", "kind"))
        shared = terms.groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        if shared.isEmpty():
            break
        remove_shared(terms)  # as good as never: the terms are made distinct once more, under another seed
        seed += 1
    ids = quads.select("graph", *[F.when(text.isNotNull(), _id(text, kind, seed)).alias(name) for name, text, kind in parts])
    return Encoded(write_shared(ids.sortWithinPartitions("p", "s")), terms, seed)


def distinct_statements(encoded: Encoded, by_graph: bool = False) -> DataFrame:
    """Number of distinct statements, per graph or of all graphs together: ids only are shuffled."""
    columns = ["graph", "s", "p", "o"] if by_graph else ["s", "p", "o"]
    distinct = encoded.statements.select(*columns).distinct()
    counted = distinct.groupBy("graph") if by_graph else distinct
    return counted.agg(F.count(F.lit(1)).alias("statements"))


def _constant(encoded: Encoded, column: str, want: str) -> Column:
    """Condition that a place of a pattern, which is no variable, puts on a statement."""
    if column == "o" and want.startswith('"'):
        # A literal of any datatype: its text is in the dictionary under each kind it occurs with.
        text = want.strip('"')
        kinds = [r["kind"] for r in encoded.terms.filter((F.col("text") == text) & F.col("kind").startswith("literal")).select("kind").collect()]
        return F.col("o").isin(*[encoded.id_of(text, k) for k in kinds]) if kinds else F.lit(False)
    return F.col(column) == encoded.id_of(want)


def _condition(encoded: Encoded, pattern: Pattern) -> Column:
    """What a statement must satisfy to match a pattern's constants and repeated variables."""
    tests = [_constant(encoded, c, want) for c, want in zip("spo", pattern) if not want.startswith("?")]
    tests += [
        F.col(a) == F.col(b) for a, b in (("s", "p"), ("s", "o"), ("p", "o"))
        if pattern["spo".index(a)].startswith("?") and pattern["spo".index(a)] == pattern["spo".index(b)]
    ]
    return reduce(and_, tests, F.lit(True))


def _scan(encoded: Encoded, pattern: Pattern) -> DataFrame:
    """Solutions of one pattern: a column of ids per variable."""
    names: dict[str, str] = {}
    for column, want in zip("spo", pattern):
        if want.startswith("?"):
            names.setdefault(want[1:], column)
    return encoded.statements.filter(_condition(encoded, pattern)).select(*[F.col(c).alias(n) for n, c in names.items()])


def _star(encoded: Encoded, subject: str, patterns: Sequence[Pattern]) -> DataFrame:
    """Solutions of patterns that share a subject variable: one grouping of the subject's statements.

    A pattern with one statement for each subject is answered by the grouping. One with several for some subject is
    joined to what the others left, as its values multiply the rows. Nothing gathers the values of a subject.
    """
    found = [_condition(encoded, p) for p in patterns]
    used = encoded.statements.filter(F.col("p").isin(*[encoded.id_of(p) for p in {p[1] for p in patterns}]))
    counted = used.groupBy("s").agg(
        *[F.count_if(c).alias(f"n{i}") for i, c in enumerate(found)], *[F.min(F.when(c, F.col("o"))).alias(f"v{i}") for i, c in enumerate(found)]
    ).filter(reduce(and_, [F.col(f"n{i}") > 0 for i in range(len(patterns))]))
    seen = Observation()
    stored = write_shared(counted.observe(seen, *[F.max(f"n{i}").alias(f"n{i}") for i in range(len(patterns))]))
    most = [observed(seen, f"n{i}") or 1 for i in range(len(patterns))]
    star = stored.select(F.col("s").alias(subject), *[F.col(f"v{i}").alias(f"v{i}") for i in range(len(patterns))])
    for i, pattern in enumerate(patterns):
        if most[i] > 1:
            values = encoded.statements.filter(found[i]).select(F.col("s").alias(subject), F.col("o").alias(f"v{i}"))
            star = star.drop(f"v{i}").join(values, subject)
    names: dict[str, Column] = {subject: F.col(subject)}
    for i, (_, _, value) in enumerate(patterns):
        if value.startswith("?"):
            name, column = value[1:], F.col(f"v{i}")
            if name in names:
                star = star.filter(column == names[name])
            else:
                names[name] = column
    return star.select(*[c.alias(n) for n, c in names.items()])


def match_ids(encoded: Encoded, patterns: Sequence[Pattern]) -> DataFrame:
    """Basic graph pattern over encoded statements: :func:`kgspark.operators.quads.match` with ids as values.

    Patterns of one subject variable and named predicates are one star. Stars and single patterns are joined on the
    variables they share, each with one before it; bag semantics.
    """
    groups: dict[object, list[Pattern]] = {}
    for i, pattern in enumerate(patterns):
        plain = pattern[0].startswith("?") and not pattern[1].startswith("?")
        groups.setdefault(pattern[0] if plain else i, []).append(pattern)
    tables = [_star(encoded, p[0][0][1:], p) if len(p) > 1 else _scan(encoded, p[0]) for p in groups.values()]
    solution, waiting = tables[0], tables[1:]
    while waiting:
        for table in waiting:
            shared = [c for c in table.columns if c in solution.columns]
            if shared:
                break
        else:
            raise ValueError("some patterns share no variable with the others")
        waiting.remove(table)
        solution = solution.join(table, shared)
    return solution


def match_encoded(encoded: Encoded, patterns: Sequence[Pattern]) -> DataFrame:
    """:func:`match_ids`, decoded."""
    found = match_ids(encoded, patterns)
    return encoded.decode(found, found.columns)
