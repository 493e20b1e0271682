"""Closed vocabularies, column layouts and slot rules as column expressions."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from kgspark.errors import LayoutError, UnknownCodeError
from kgspark.functions.text import trim_blanks
from kgspark.session import any_row, literal_table, observed, sample_text


def map_codes(
    df: DataFrame, column: str, vocabulary: Mapping[str, str], into: str, strict: bool = False
) -> DataFrame:
    """Add ``into``: the vocabulary's value for a trimmed code, NULL for an unknown one.

    The vocabulary is a literal map, so mapping needs no join. ``strict`` raises
    on the first unknown code: a code never gets a default.
    """
    table = F.create_map(*[F.lit(x) for pair in vocabulary.items() for x in pair])
    mapped = df.withColumn(into, F.try_element_at(table, trim_blanks(F.col(column))))
    if strict:
        unknown = mapped.filter(F.col(into).isNull())
        if any_row(unknown):
            raise UnknownCodeError(f"unknown codes in {column}: {sample_text(unknown, column)}")
    return mapped


def unknown_codes(mapped: DataFrame, column: str, into: str) -> DataFrame:
    """Codes a mapping did not know, with their row counts."""
    return (
        mapped.filter(F.col(into).isNull())
        .groupBy(trim_blanks(F.col(column)).alias("code"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


@dataclass(frozen=True)
class ColumnRule:
    """One rule on one column.

    ``kind`` is ``required``, ``pattern``, ``enum``, ``equals`` or ``minimum``;
    ``arg`` is the pattern, the allowed values, the constant or the bound.
    Only ``required`` speaks about missing values.
    """

    column: str
    kind: str
    arg: object = None

    @property
    def name(self) -> str:
        return f"{self.column}:{self.kind}"

    def violated(self) -> Column:
        """TRUE where the rule is broken; never NULL."""
        col = F.col(self.column)
        if self.kind == "required":
            return F.coalesce(F.length(trim_blanks(col.cast("string"))) == 0, F.lit(True))
        broken = {
            "pattern": lambda: ~col.cast("string").rlike(str(self.arg)),
            "enum": lambda: ~col.isin(*self.arg),
            "equals": lambda: col != F.lit(self.arg),
            "minimum": lambda: col < F.lit(self.arg),
        }[self.kind]()
        return F.coalesce(broken, F.lit(False))


def check_rules(df: DataFrame, rules: Sequence[ColumnRule]) -> DataFrame:
    """One row per rule: ``rule, rows, violations, sample``; the table is read once.

    ``sample`` is the smallest offending value, so it does not depend on row order.
    """
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, rule in enumerate(rules):
        broken = rule.violated()
        aggs.append(F.count_if(broken).alias(f"n{i}"))
        aggs.append(F.min(F.when(broken, F.col(rule.column).cast("string"))).alias(f"s{i}"))
    one_row = df.agg(*aggs)
    entries = F.array(*[
        F.struct(
            F.lit(rule.name).alias("rule"),
            F.col("rows"),
            F.col(f"n{i}").alias("violations"),
            F.col(f"s{i}").alias("sample"),
        )
        for i, rule in enumerate(rules)
    ])
    return one_row.select(F.inline(entries))


@dataclass(frozen=True)
class LayoutSpec:
    """Declared layout of a delimited source: column names, rules, header policy."""

    name: str
    columns: tuple[str, ...]
    rules: tuple[ColumnRule, ...]
    has_header: bool = False
    expected_header: tuple[str, ...] | None = None
    id_patterns: tuple[str, ...] = field(default_factory=tuple)
    note: str = ""


def _layout_counts(spec: LayoutSpec) -> list[Column]:
    """Rows, and violations with a sample for the arity and each rule."""
    width = len(spec.columns)
    right = F.col("n_fields") == width
    aggs = [F.count(F.lit(1)).alias("rows"), F.count_if(~right).alias("arity_n"),
            F.min(F.when(~right, F.col("n_fields"))).cast("string").alias("arity_s")]
    for i, rule in enumerate(spec.rules):
        broken = right & rule.violated()
        aggs.append(F.count_if(broken).alias(f"n{i}"))
        aggs.append(F.min(F.when(broken, F.col(rule.column))).alias(f"s{i}"))
    return aggs


def layout_report(parsed: DataFrame, spec: LayoutSpec) -> DataFrame:
    """Rule and arity counts over a whole parsed source: ``rule, rows, violations, sample``.

    ``parsed`` comes from :func:`kgspark.sources.tsv.split_lines`: the declared
    columns plus ``n_fields``. Rules only speak about rows of the right arity.
    """
    return _as_report(parsed.agg(*_layout_counts(spec)), spec)


def _as_report(counts: DataFrame, spec: LayoutSpec) -> DataFrame:
    entries = [F.struct(
        F.lit("arity").alias("rule"), F.col("rows"),
        F.col("arity_n").alias("violations"), F.col("arity_s").alias("sample"),
    ), F.struct(
        F.lit("not_empty").alias("rule"), F.col("rows"),
        F.when(F.col("rows") == 0, 1).otherwise(0).cast("bigint").alias("violations"),
        F.lit(None).cast("string").alias("sample"),
    )]
    for i, rule in enumerate(spec.rules):
        entries.append(F.struct(
            F.lit(rule.name).alias("rule"), F.col("rows"),
            F.col(f"n{i}").alias("violations"), F.col(f"s{i}").alias("sample"),
        ))
    return counts.select(F.inline(F.array(*entries)))


def watch_layout(parsed: DataFrame, spec: LayoutSpec) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """``parsed`` under observation, and a call that raises if a rule was broken, else returns the report.

    The counts are taken while the first action on the result runs, so the source
    is not read a second time. Make the call after that action.
    """
    seen = Observation()
    counts = _layout_counts(spec)
    watched = parsed.observe(seen, *counts)

    def verify() -> DataFrame:
        schema = parsed.limit(0).agg(*counts).schema
        found = [observed(seen, name) for name in schema.names]
        if found[0] is None:  # folded away as empty before it ran
            return verify_layout(parsed, spec, strict=True)
        report = _as_report(parsed.sparkSession.createDataFrame([tuple(found)], schema), spec)
        return _refused(report, spec)

    return watched, verify


def watch_values(parsed: DataFrame, spec: LayoutSpec) -> tuple[DataFrame, Callable[[], DataFrame]]:
    """``parsed`` under observation, and a call for ``column, value, rows``: what a source holds, seen while it is read.

    Rows per declared value of the closed columns; rows per number of fields (column ``fields``: the declared number, and
    ``other``); for every column its smallest value (``rows`` is NULL), as an example. Make the call after the first action.
    """
    closed = [(r.column, v) for r in spec.rules if r.kind == "enum" for v in r.arg]
    right = F.col("n_fields") == len(spec.columns)
    aggs = [F.count_if(F.col(c) == v).alias(f"v{i}") for i, (c, v) in enumerate(closed)]
    aggs += [F.count_if(right).alias("right"), F.count_if(~right).alias("other")]
    aggs += [F.min(F.when(right, F.col(c))).alias(f"e{i}") for i, c in enumerate(spec.columns)]
    seen = Observation()

    def counted() -> DataFrame:
        names = [f"v{i}" for i in range(len(closed))] + ["right", "other"] + [f"e{i}" for i in range(len(spec.columns))]
        found = dict(zip(names, (observed(seen, n) for n in names)))
        if found["right"] is None:
            found = parsed.agg(*aggs).first().asDict()
        rows = [(c, v, found[f"v{i}"]) for i, (c, v) in enumerate(closed)]
        rows += [("fields", str(len(spec.columns)), found["right"]), ("fields", "other", found["other"])]
        rows += [(c, found[f"e{i}"], None) for i, c in enumerate(spec.columns)]
        return literal_table(parsed.sparkSession, rows, "column STRING, value STRING, rows BIGINT")

    return parsed.observe(seen, *aggs), counted


def layout_samples(parsed: DataFrame, spec: LayoutSpec, most: int = 20) -> DataFrame:
    """The smallest offending values of each rule: ``rule, place, value, rows``, ``most`` of them at most.

    One pass; values are counted and cut to the smallest within tasks before they meet.
    """
    right = F.col("n_fields") == len(spec.columns)
    broken = [F.when(~right, F.struct(F.lit("arity").alias("rule"), F.col("n_fields").cast("string").alias("value")))]
    broken += [
        F.when(right & rule.violated(), F.struct(F.lit(rule.name).alias("rule"), F.col(rule.column).alias("value"))) for rule in spec.rules
    ]
    return smallest(parsed.select(F.inline(F.array_compact(F.array(*broken)))), "rule", "value", most)


def smallest(rows: DataFrame, by: str, value: str, most: int) -> DataFrame:
    """The ``most`` smallest distinct values per group, with their rows: ``by, place, value, rows``.

    A rank limit is applied by each task before groups are put together, so a group brings a few rows of each task
    however many it has.
    """
    counted = rows.groupBy(by, value).agg(F.count(F.lit(1)).alias("rows"))
    place = F.row_number().over(Window.partitionBy(by).orderBy(value))
    return counted.withColumn("place", place).filter(F.col("place") <= most).select(by, "place", value, "rows")


def header_faults(heads: DataFrame, spec: LayoutSpec) -> DataFrame:
    """Files whose first line breaks the header rules of a source: ``file, head``."""
    first = trim_blanks(F.substring_index("head", "\t", 1))
    is_header = ~reduce(or_, [first.rlike(p) for p in spec.id_patterns], F.lit(False))
    wrong = is_header != F.lit(spec.has_header)
    if spec.has_header and spec.expected_header:
        wrong = wrong | (F.col("head") != "\t".join(spec.expected_header))
    return heads.filter(wrong)


def column_examples(parsed: DataFrame, spec: LayoutSpec) -> DataFrame:
    """The smallest value of each column as its example: ``column, example``."""
    one_row = parsed.agg(*[F.min(c).alias(c) for c in spec.columns])
    return one_row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).alias("example")) for c in spec.columns
    ])))


def header_matches(first_fields: Sequence[str], spec: LayoutSpec) -> list[str]:
    """Header problems of a source's first line; the line is a header when its
    first field fits none of the id patterns."""
    import re

    problems = []
    first = first_fields[0].strip() if first_fields else ""
    is_header = not any(re.match(p, first) for p in spec.id_patterns)
    if is_header != spec.has_header:
        problems.append(f"header expected: {spec.has_header}, first line: {list(first_fields)!r}")
    if spec.has_header and spec.expected_header and tuple(first_fields) != spec.expected_header:
        problems.append(f"header is {list(first_fields)!r}, expected {list(spec.expected_header)!r}")
    return problems


def verify_layout(parsed: DataFrame, spec: LayoutSpec, strict: bool = False) -> DataFrame:
    """Layout report of a source; ``strict`` raises when any rule is broken."""
    report = layout_report(parsed, spec)
    return _refused(report, spec) if strict else report


def _refused(report: DataFrame, spec: LayoutSpec) -> DataFrame:
    """The report, unless a rule is broken: one row per rule, so this is a small read."""
    broken = [r for r in report.collect() if r["violations"]]
    if broken:
        text = "; ".join(f"{r['rule']}: {r['violations']} (e.g. {r['sample']!r})" for r in broken)
        raise LayoutError(f"{spec.name}: {text}")
    return report
