"""The driver contract holds with and without the corpus operators."""

from __future__ import annotations

import importlib
import sys

import __spark_entry__ as entry
from workload.queries import QUERIES


class _Missing:
    """An import hook under which the corpus operators are not there."""

    def find_spec(self, name, path=None, target=None):
        if name.startswith("kgspark.llm") or name == "corpus_pipeline":
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
        return None


def test_every_oracle_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.FLAGSHIP in entry.queries()


def test_the_rest_works_without_the_corpus_operators(monkeypatch):
    for name in [n for n in sys.modules if n.startswith("kgspark.llm") or n == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setattr(sys, "meta_path", [_Missing(), *sys.meta_path])
    monkeypatch.delitem(sys.modules, "__spark_entry__")
    alone = importlib.import_module("__spark_entry__")
    assert set(alone.queries()) == set(QUERIES)
    assert set(alone.oracle_sql()) <= set(QUERIES)
