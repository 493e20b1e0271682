"""Quoted text in parallel: records against a sequential reader, splits, several files."""

from __future__ import annotations

import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from kgspark.errors import LayoutError
from kgspark.sources import quoted, tsv


def content(rng: random.Random, records: int) -> str:
    """Quoted and plain fields, line breaks, doubled and stray quotes, separators inside quotes, empty fields."""
    def field():
        kind = rng.randrange(6)
        text = "".join(rng.choice(["a", "é", " ", "7", " "]) for _ in range(rng.randrange(5)))
        if kind == 0:
            return f'x{text}"{text}'
        if kind < 3:
            inner = "".join(rng.choice(["b", "\n", '"', "\t", "\n\n", text]) for _ in range(rng.randrange(6)))
            return '"' + inner.replace('"', '""') + '"'
        return "f" + text
    return "".join("\t".join(field() for _ in range(rng.randrange(1, 5))) + "\n" for _ in range(records))


def parsed(text: str) -> list[list[str]]:
    return list(csv.reader(io.StringIO(text, newline=""), delimiter="\t"))


@pytest.mark.parametrize("per_block", [1, 7, 10_000])
def test_records_against_a_sequential_reader(spark, per_block):
    rng = random.Random(per_block)
    texts = {f"f{i}": content(rng, rng.randrange(1, 60)) for i in range(6)}
    lines = [
        (name, 1000 * (i // per_block), i, line) for name, text in texts.items() for i, line in enumerate(text.split("\n")[:-1])
    ]
    rng.shuffle(lines)
    found = quoted.quoted_records(spark.createDataFrame(lines, "file STRING, block LONG, position LONG, value STRING").repartition(3)).collect()
    for name, text in texts.items():
        records = [r["record"] for r in sorted(found, key=lambda r: r["position"]) if r["file"] == name]
        assert "".join(r + "\n" for r in records) == text
        assert [row for r in records for row in parsed(r + "\n")] == parsed(text)
        assert all(len(parsed(r + "\n")) == 1 for r in records)
    opened = quoted.files_with_open_lines(spark.createDataFrame(lines, "file STRING, block LONG, position LONG, value STRING"))
    assert {r["file"] for r in opened.collect()} == {n for n, t in texts.items() if any("\n" in f for row in parsed(t) for f in row)}


def test_long_fields_cost_no_stack(spark):
    value = '"' + 'a""b\t' * 100_000
    row = spark.createDataFrame([(value,), (value + '"',)], "value STRING").select(
        quoted.leaves_open(F.col("value"), False).alias("o"), quoted.leaves_open(F.col("value"), True).alias("i")
    ).collect()
    assert [tuple(r) for r in row] == [(True, False), (False, True)]


def test_a_quote_never_closed(spark):
    lines = [("f", 0, 0, "a\tb"), ("f", 9, 1, 'x\t"y'), ("f", 20, 2, "z")]
    with pytest.raises(LayoutError, match="f: a quote is never closed"):
        quoted.quoted_records(spark.createDataFrame(lines, "file STRING, block LONG, position LONG, value STRING"))


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_files_are_split(spark, tmp_path, small_splits):
    rng = random.Random(1)
    head = "key\tvalue\tother\n"
    def rows(n, breaks):
        for i in range(n):
            text = " ".join(rng.choices(["alpha", 'quo""te', "tab\tin", "line\nbreak" if breaks else "plain", "é"], k=rng.randrange(1, 12)))
            yield f'K{i}\t"{text}"\t{rng.randrange(9)}\n' if i % 7 else f"K{i}\tplain {i}\t\n"
    (tmp_path / "breaks one.tsv").write_bytes((head + "".join(rows(12_000, True))).encode())
    (tmp_path / "plain.tsv").write_bytes((head + "".join(rows(8_000, False))).encode())
    path = str(tmp_path)
    found = tsv.read_keyed_tsv(spark, path, ["key", "value", "other"])
    whole = spark.read.options(sep="\t", quote='"', escape='"', header=True, multiLine=True).csv(path)
    assert found.exceptAll(whole).isEmpty() and whole.exceptAll(found).isEmpty() and found.count() == 20_000
    assert tsv.physical_lines(spark, path).rdd.getNumPartitions() > 8 > whole.rdd.getNumPartitions()
    only = tsv.read_keyed_tsv(spark, f"{path}/plain.tsv", ["key", "value"])
    assert only.rdd.getNumPartitions() > 1 and "Exchange" not in only._jdf.queryExecution().executedPlan().toString()


def test_headers_of_files_with_line_breaks(spark, tmp_path):
    (tmp_path / "a.tsv").write_text('k\t"v\nw"\n1\t"two\nlines"\n\n \t\t\n2\tx\n')
    found = tsv.read_keyed_tsv(spark, str(tmp_path), ["k", "v\nw"])
    assert sorted(tuple(r) for r in found.collect()) == [("1", "two\nlines"), ("2", "x")]
    (tmp_path / "b.tsv").write_text('other\tv\n1\t"two\nlines"\n')
    with pytest.raises(LayoutError, match="header"):
        tsv.read_keyed_tsv(spark, str(tmp_path), ["k", "v\nw"])


def test_carriage_returns_before_line_feeds_go(spark, tmp_path):
    (tmp_path / "a.tsv").write_bytes(b'k\tv\r\n1\t"two\r\nlines"\r\n2\tx\r\n')
    found = tsv.read_keyed_tsv(spark, str(tmp_path), ["k", "v"])
    assert sorted(tuple(r) for r in found.collect()) == [("1", "two\nlines"), ("2", "x")]
