"""Queries against their SQL; and the list of queries."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from kgspark.llm.queries import QUERIES
from kgspark.llm.sql import ORACLES
from tests.compare import connect, difference

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    assert {n.split("_")[0] for n in QUERIES} == {*(f"op{i}" for i in range(1, 14)), "pipeline"}
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(QUERIES)
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "simhash_dedup", "decontamination", "secret_scans", "best_fit_packing"]


@pytest.mark.parametrize("name", ORACLES)
def test_query_equals_its_sql(spark, name):
    assert difference(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) is None
