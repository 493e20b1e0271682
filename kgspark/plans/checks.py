"""Acceptance checks: one row each, ``check, status, critical, violations, detail``.

``violations`` counts over the whole release. ``detail`` names the smallest
offenders, so it does not depend on row order.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kgspark.functions.text import plain_curie
from kgspark.operators import hierarchy as H
from kgspark.operators.digests import distinct_count
from kgspark.operators.rules import smallest
from kgspark.operators.sets import reconcile_sets
from kgspark.operators.shapes import reconcile_shapes
from kgspark.operators.terms import term_review, undefined_terms
from kgspark.plans.release import Release


def _check(one_row: DataFrame, name: str, violations: Column, detail: Column, critical: bool = True,
           passed: Column | None = None) -> DataFrame:
    ok = (violations == 0) if passed is None else passed
    return one_row.select(
        F.lit(name).alias("check"),
        F.when(ok, "PASS").otherwise("FAIL" if critical else "WARN").alias("status"),
        F.lit(critical).alias("critical"),
        violations.cast("bigint").alias("violations"),
        detail.alias("detail"),
    )


def _offenders(rows: DataFrame, column: str) -> DataFrame:
    """Number of offenders and the smallest of them."""
    return rows.agg(F.count(F.lit(1)).alias("n"), F.min(F.col(column)).cast("string").alias("first"))


def _listed(name: str, rows: DataFrame, column: str, clean: str, critical: bool = True) -> DataFrame:
    detail = F.when(F.col("n") == 0, clean).otherwise(
        F.concat(F.col("n").cast("string"), F.lit(" found, first "), F.coalesce("first", F.lit("none")))
    )
    return _check(_offenders(rows, column), name, F.col("n"), detail, critical)


# Offender tables, also useful on their own.

def foreign_taxa(nodes: DataFrame, allowed: str) -> DataFrame:
    """Nodes with a taxon that is not the allowed one; a missing taxon is not foreign."""
    return nodes.filter(F.col("taxon") != allowed).select("id", "taxon")


def foreign_ids(nodes: DataFrame, infix: str) -> DataFrame:
    """Nodes whose id lacks the required infix."""
    return nodes.filter(~F.col("id").cast("string").contains(infix)).select("id")


def taxon_cardinality(typed: DataFrame, taxa: DataFrame) -> DataFrame:
    """Typed nodes with a number of taxa other than one, zero included: ``id, taxa``."""
    counts = taxa.filter(F.col("taxon").isNotNull()).select("id", "taxon").distinct().groupBy("id").agg(
        F.count(F.lit(1)).alias("n")
    )
    return (
        typed.select("id").distinct().join(counts, "id", "left")
        .select("id", F.coalesce("n", F.lit(0).cast("bigint")).alias("taxa"))
        .filter(F.col("taxa") != 1)
    )


def dangling_endpoints(hierarchy: DataFrame, nodes: DataFrame) -> DataFrame:
    """Hierarchy endpoints on either side that are no nodes; one row per use."""
    ends = hierarchy.select(F.explode(F.array("child", "parent")).alias("id"))
    return ends.join(nodes.select("id"), "id", "left_anti")


def missing_evidence(facts: DataFrame) -> DataFrame:
    """Associations without an evidence code."""
    return facts.filter(F.col("code").isNull())


def unexpected_evidence(facts: DataFrame, allowed: Sequence[str]) -> DataFrame:
    """Evidence codes outside the allowed set, with their number of facts."""
    return (
        facts.filter(F.col("code").isNotNull() & ~F.col("code").isin(*allowed))
        .groupBy("code").agg(F.count(F.lit(1)).alias("facts"))
    )


def nested_pairs(facts: DataFrame, hierarchy: DataFrame, gene) -> DataFrame:
    """Child/parent pairs among one gene's associations: ``child, parent, pairs``.

    ``pairs`` counts combinations of associations; equal objects are counted
    before joining instead of being multiplied out.
    """
    mine = facts.filter(F.col("gene") == gene).groupBy("pathway").agg(F.count(F.lit(1)).alias("n"))
    return (
        hierarchy.select("child", "parent").distinct()
        .join(mine.select(F.col("pathway").alias("child"), F.col("n").alias("nc")), "child")
        .join(mine.select(F.col("pathway").alias("parent"), F.col("n").alias("np")), "parent")
        .select("child", "parent", (F.col("nc") * F.col("np")).alias("pairs"))
    )


def has_keyword(label: Column, folded: Sequence[str], exact: Sequence[str]) -> Column:
    """TRUE when the upper-cased label holds a folded keyword or the label holds an exact one."""
    tests = [F.upper(label).contains(k) for k in folded] + [label.contains(k) for k in exact]
    return reduce(lambda x, y: x | y, tests)


# Checks in report order.

def chk_taxon(nodes: DataFrame, allowed: str) -> DataFrame:
    return _listed("1. one taxon only", foreign_taxa(nodes, allowed), "id", "no other taxon")


def chk_ids(nodes: DataFrame, infix: str) -> DataFrame:
    return _listed("2. ids carry the infix", foreign_ids(nodes, infix), "id", "no other id")


def chk_cardinality(typed: DataFrame, taxa: DataFrame) -> DataFrame:
    return _listed("3. exactly one taxon per node", taxon_cardinality(typed, taxa), "id", "every node has one")


def chk_count(
    nodes: DataFrame, expected: int | None, tolerance: float = 0.05, ceiling: int | None = None
) -> DataFrame:
    """Distinct nodes against the announced number: drift, and a ceiling if one is given."""
    row = nodes.agg(F.countDistinct("id").alias("n"))
    n = F.col("n")
    shown = n.cast("string")
    if expected is None:
        return _check(row, "4. node count", F.lit(0), F.concat(shown, F.lit(" nodes, nothing to compare")), False)
    drift = F.abs(n - F.lit(expected)) / F.lit(float(expected))
    above = F.lit(False) if ceiling is None else n > ceiling
    wrong = above | (drift > tolerance)
    detail = F.concat(
        shown, F.lit(f" nodes, expected {expected}"), F.when(above, F.lit(f", above {ceiling}")).otherwise("")
    )
    return _check(row, "4. node count", F.when(wrong, 1).otherwise(0), detail)


def chk_acyclic(hierarchy: DataFrame) -> DataFrame:
    """Nodes on or below a cycle."""
    return _listed("5. hierarchy is acyclic", H.find_cycle_nodes(hierarchy), "node", "no cycles")


def chk_endpoints(hierarchy: DataFrame, nodes: DataFrame) -> DataFrame:
    return _listed("6. no dangling endpoints", dangling_endpoints(hierarchy, nodes), "id", "every endpoint is a node")


def chk_evidence(facts: DataFrame, allowed: Sequence[str]) -> DataFrame:
    """Unexpected codes and associations without any, from one pass."""
    code = F.col("code")
    odd = code.isNotNull() & ~code.isin(*allowed)
    row = facts.agg(
        F.countDistinct(F.when(odd, code)).alias("odd"), F.min(F.when(odd, code)).alias("first"),
        F.count_if(code.isNull()).alias("none"),
    )
    detail = F.concat(
        F.lit("unexpected codes: "), F.col("odd").cast("string"),
        F.coalesce(F.concat(F.lit(" from "), F.col("first")), F.lit("")),
        F.lit("; without evidence: "), F.col("none").cast("string"),
    )
    return _check(row, "7. evidence is the mapped set", F.col("odd") + F.col("none"), detail)


def spot_check(
    facts: DataFrame, nodes: DataFrame, hierarchy: DataFrame, gene, must_have,
    folded: Sequence[str], exact: Sequence[str],
) -> DataFrame:
    """One gene in detail: it has pathways, a given one among them, keyword labels, nested levels.

    One row: ``rows, has_required, keyword_labels, nested``.
    """
    label = F.col("label")
    mine = facts.filter(F.col("gene") == gene).join(nodes.select(F.col("id").alias("pathway"), "label"), "pathway")
    own = mine.select(
        F.lit(1).alias("rows"), (F.col("pathway") == must_have).cast("int").alias("required"),
        F.when(has_keyword(label, folded, exact), label).alias("keyword"), F.lit(0).cast("bigint").alias("pairs"),
    )
    nested = nested_pairs(facts, hierarchy, gene).select(
        F.lit(0).alias("rows"), F.lit(0).alias("required"), F.lit(None).cast("string").alias("keyword"), "pairs"
    )
    return own.unionByName(nested).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).cast("bigint").alias("rows"),
        F.coalesce(F.max("required") == 1, F.lit(False)).alias("has_required"),
        F.countDistinct("keyword").alias("keyword_labels"),
        F.coalesce(F.sum("pairs"), F.lit(0)).cast("bigint").alias("nested"),
    )


def chk_spot(spot: DataFrame) -> DataFrame:
    problems = [
        F.when(F.col("rows") == 0, "no pathways"),
        F.when(~F.col("has_required"), "required pathway absent"),
        F.when(F.col("keyword_labels") == 0, "no keyword label"),
        F.when(F.col("nested") == 0, "one level only"),
    ]
    text = F.concat_ws("; ", *problems)
    violations = F.size(F.array_compact(F.array(*problems)))
    clean = F.concat(F.col("rows").cast("string"), F.lit(" pathways, "), F.col("nested").cast("string"), F.lit(" nested pairs"))
    return _check(spot, "8. spot check of one gene", violations, F.when(text == "", clean).otherwise(text))


def chk_shapes(facts: DataFrame, participation: DataFrame) -> DataFrame:
    """The plain edges and the associations must state the same pairs."""
    row = reconcile_shapes(facts, participation)
    wrong = F.when(F.col("edges") == 0, F.lit(1).cast("bigint")).otherwise(F.col("unsupported") + F.col("unreachable"))
    detail = F.when(F.col("edges") == 0, "no edges").otherwise(F.concat(
        F.col("edges").cast("string"), F.lit(" edges, "), F.col("unsupported").cast("string"),
        F.lit(" with no association behind them, "), F.col("unreachable").cast("string"),
        F.lit(" pairs without an edge"),
    ))
    return _check(row, "9. edges match the associations", wrong, detail)


def chk_members(ours: DataFrame, theirs: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Member sets against another source; differences only warn."""
    row = reconcile_sets(ours, theirs, keys).agg(
        F.count(F.lit(1)).alias("keys"), F.count_if(~F.col("exact_match")).alias("differ")
    )
    detail = F.concat(F.col("differ").cast("string"), F.lit(" of "), F.col("keys").cast("string"), F.lit(" differ"))
    return _check(row, "10. members match the other source", F.col("differ"), detail, critical=False)


def chk_total(quads: DataFrame, low: int | None = None, high: int | None = None, known_set: bool = False) -> DataFrame:
    """Distinct statements within a range; without one the number is only reported.

    ``known_set``: the statements are stored as a set, so they are counted as they are, without a shuffle.
    """
    row = quads.agg(F.count(F.lit(1)).alias("n")) if known_set else distinct_count(quads).withColumnRenamed("rows", "n")
    if low is None or high is None:
        detail = F.concat(F.col("n").cast("string"), F.lit(" statements, nothing to compare"))
        return _check(row, "11. statement count in range", F.lit(0), detail, False)
    inside = F.col("n").between(low, high)
    detail = F.concat(F.col("n").cast("string"), F.lit(f" statements, range {low} to {high}"))
    return _check(row, "11. statement count in range", F.when(inside, 0).otherwise(1), detail)


def chk_terms(usage: DataFrame, defined: DataFrame) -> DataFrame:
    """Terms in use that the model does not define; never critical."""
    row = term_review(usage, defined)
    detail = F.concat(F.col("undefined").cast("string"), F.lit(" of "), F.col("emitted").cast("string"), F.lit(" undefined"))
    return _check(row, "12. model terms are defined", F.col("undefined"), detail, critical=False)


def suite(checks: Sequence[DataFrame]) -> DataFrame:
    """All check rows in one table."""
    return reduce(DataFrame.unionByName, checks)


def acceptance(
    release: Release, quads: DataFrame, *, taxon: str, infix: str, evidence: Sequence[str],
    expected_nodes: int | None, spot: Mapping, usage: DataFrame, defined: DataFrame,
    statements: tuple[int, int] | None = None, tolerance: float = 0.05,
    ceiling: int | None = None, members: tuple[DataFrame, ...] | None = None, known_set: bool = False,
) -> DataFrame:
    """The whole suite; the member comparison runs only when another source is given.

    ``members``: our sets, theirs, and the keys to compare if not all. ``known_set``: ``quads`` holds no duplicates.
    """
    entities = acceptance_entities(release)
    checks = [
        chk_taxon(entities, taxon),
        chk_ids(release.node, infix),
        chk_cardinality(entities, entities),
        chk_count(release.node, expected_nodes, tolerance, ceiling),
        chk_acyclic(release.hierarchy),
        chk_endpoints(release.hierarchy, release.node),
        chk_evidence(release.facts, evidence),
        chk_spot(spot_check(release.facts, release.node, release.hierarchy, **spot)),
        chk_shapes(release.facts, release.participation),
    ]
    if members is not None:
        checks.append(chk_members(*members))
    checks += [chk_total(quads, *(statements or ()), known_set=known_set), chk_terms(usage, defined)]
    return suite(checks)


def check_offenders(
    release: Release, *, taxon: str, infix: str, evidence: Sequence[str], usage: DataFrame | None = None,
    defined: DataFrame | None = None, most: int = 20,
) -> DataFrame:
    """The smallest offenders of the checks that have any: ``check, place, offender, rows``, ``most`` a check at most.

    Checks 1, 2, 3, 5, 6 and 7 name nodes, codes and associations, 12 the terms that the model lacks. ``rows`` tells
    how often an offender offends. All checks are cut in one pass over their offenders.
    """
    entities = acceptance_entities(release)
    named = lambda check, df, offender: df.select(F.lit(check).alias("check"), offender.cast("string").alias("offender"))
    bare = missing_evidence(release.facts)
    tables = [
        named("1. one taxon only", foreign_taxa(entities, taxon), F.col("id")),
        named("2. ids carry the infix", foreign_ids(release.node, infix), F.col("id")),
        named("3. exactly one taxon per node", taxon_cardinality(entities, entities), F.col("id")),
        named("5. hierarchy is acyclic", H.find_cycle_nodes(release.hierarchy), F.col("node")),
        named("6. no dangling endpoints", dangling_endpoints(release.hierarchy, release.node), F.col("id")),
        named("7. evidence is the mapped set", unexpected_evidence(release.facts, evidence), F.col("code")),
        named("7. evidence is the mapped set", bare, F.concat_ws(" ", F.col("gene").cast("string"), F.col("pathway").cast("string"))),
    ]
    if usage is not None and defined is not None:
        tables.append(named("12. model terms are defined", undefined_terms(usage, defined), F.col("term")))
    return smallest(suite(tables), "check", "offender", most)


def acceptance_entities(release: Release) -> DataFrame:
    """Nodes and genes with their taxon; ids carry what they are, as both may use the same numbers."""
    return release.node.select(plain_curie("node", F.col("id")).alias("id"), "taxon").unionByName(
        release.gene.select(plain_curie("gene", F.col("id")).alias("id"), "taxon")
    )


def accepted(results: DataFrame) -> bool:
    """False when a critical check failed. One row per check, so this is a small read."""
    return results.filter(F.col("status") == "FAIL").isEmpty()


def markdown(results: DataFrame, title: str, offenders: DataFrame | None = None) -> str:
    """The report of a suite; with the offenders of :func:`check_offenders` below it."""
    rows = sorted(results.collect(), key=lambda r: int(r["check"].split(".")[0]))
    lines = [f"# {title}", "", "| Check | Status | Detail |", "|---|---|---|"]
    lines += [f"| {r['check']} | **{r['status']}** | {r['detail']} |" for r in rows]
    if offenders is not None:
        listed: dict[str, list[str]] = {}
        for r in sorted(offenders.collect(), key=lambda r: (int(r["check"].split(".")[0]), r["place"])):  # a few per check
            listed.setdefault(r["check"], []).append(f"- `{r['offender']}`" + (f" ({r['rows']} times)" if r["rows"] > 1 else ""))
        for check, lines_of in listed.items():
            lines += ["", f"## {check}", "", *lines_of]
    return "\n".join(lines) + "\n"
