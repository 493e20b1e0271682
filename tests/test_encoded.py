"""Encoded statements: the same answers as over text, ids in every exchange, collisions noticed."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from kgspark.operators import encoded as E
from kgspark.operators import quads as Q

SCHEMA = "graph STRING, s STRING, p STRING, o STRING, o_kind STRING, o_datatype STRING"


@pytest.fixture(scope="module")
def quads(spark):
    rng = random.Random(5)
    rows = []
    for _ in range(400):
        s, p = f"s{rng.randrange(25)}", rng.choice(["a", "p", "q", "r"])
        kind = rng.choice(["iri", "iri", "literal"])
        datatype = rng.choice([None, "xsd:string", "xsd:date"]) if kind == "literal" else None
        rows.append(("g", s, p, f"s{rng.randrange(25)}", kind, datatype))
    rows += [("g", f"s{i}", "one", f"v{i % 4}", "literal", None) for i in range(25)] + [("g", f"s{i}", "type", "C", "iri", None) for i in range(0, 25, 2)]
    rows += rows[:30] + [("g", "s1", "a", None, "iri", None), ("h", "s1", "one", "v1", "literal", None)]
    rows = [r for r in rows if r[2] != "one" or r[0] == "g"] + [("h", "s1", "two", "v1", "literal", None)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def encoded(quads):
    return E.encode(quads)


@pytest.mark.parametrize(
    "patterns",
    [
        [("?x", "a", "?y")],
        [("?x", "one", "?v"), ("?x", "type", "C")],
        [("?x", "one", "?v"), ("?x", "type", "C"), ("?x", "p", "?y"), ("?y", "one", "?w"), ("?y", "q", "?z")],
        [("?x", "p", "?y"), ("?x", "q", "?y")],
        [("?x", "p", "?x"), ("?x", "one", "?v")],
        [("?x", "p", "?y"), ("?x", "p", "?z"), ("?z", "a", "?w")],
        [("?x", "one", '"v1"'), ("?x", "p", "?y")],
        [("?x", "p", '"s3"'), ("?x", "q", "?y")],
        [("?x", "p", '"absent"'), ("?x", "q", "?y")],
        [("s1", "?p", "?y"), ("?y", "a", "?z")],
        [("?x", "?p", "?y"), ("?y", "one", "?v")],
        [("?x", "absent", "?y"), ("?x", "a", "?z")],
    ],
)
def test_matches_equal_those_over_text(quads, encoded, patterns):
    text, ids = Q.match(quads, patterns), E.match_encoded(encoded, patterns)
    assert sorted(text.columns) == sorted(ids.columns)
    assert sorted(map(tuple, text.select(sorted(text.columns)).collect()), key=str) == sorted(map(tuple, ids.select(sorted(text.columns)).collect()), key=str)


def test_unrelated_patterns(encoded):
    with pytest.raises(ValueError):
        E.match_ids(encoded, [("?a", "p", "?b"), ("?c", "p", "?d")])


def exchanged(df) -> set[str]:
    """What the exchanges of the plan are dealt by."""
    df.collect()
    return set(re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", df._jdf.queryExecution().executedPlan().toString()))


def test_only_ids_are_exchanged(spark, encoded):
    assert {t for c, t in encoded.statements.dtypes if c in "spo"} == {"bigint"}
    star = E.match_ids(encoded, [("?x", "one", "?v"), ("?x", "type", "C")])
    assert exchanged(star) == set()  # its statements were grouped once, by the subject, and the groups stored
    assert len(exchanged(E.distinct_statements(encoded))) == 1
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = E.match_ids(encoded, [("?x", "one", "?v"), ("?x", "p", "?y"), ("?y", "one", "?w")])
        joined.collect()
        plan = joined._jdf.queryExecution().optimizedPlan()
        assert exchanged(joined) and {t for _, t in joined.dtypes} == {"bigint"}
        assert "o_kind" not in plan.toString() and "text" not in plan.toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_set_semantics(quads, encoded):
    assert E.distinct_statements(encoded).first()[0] == quads.select("s", "p", "o", "o_kind", "o_datatype").distinct().count()
    found = {r["graph"]: r["statements"] for r in E.distinct_statements(encoded, True).collect()}
    assert found == {r["graph"]: r["count"] for r in Q.as_set(quads).groupBy("graph").count().collect()}


def test_collisions_change_the_seed(quads, monkeypatch):
    real = E._id
    monkeypatch.setattr(E, "_id", lambda text, kind, seed: real(text, kind, seed) % 50 if seed < 2 else real(text, kind, seed))
    encoded = E.encode(quads)
    assert encoded.seed == 2
    patterns = [("?x", "p", "?y"), ("?y", "one", "?v")]
    assert sorted(map(tuple, E.match_encoded(encoded, patterns).select("x", "y", "v").collect())) == sorted(
        map(tuple, Q.match(quads, patterns).select("x", "y", "v").collect()))
    assert encoded.decode(encoded.statements.filter(F.col("s") == encoded.id_of("s1")).select("s"), ["s"]).distinct().collect()[0][0] == "s1"
