"""The ingest job: verify, scope, resolve, emit, load, check, describe.

One application, one lazy plan per table. It stops at the first failing step;
the report is written only after the checks have passed.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kgspark.errors import IngestError
from kgspark.functions.text import trim_blanks
from kgspark.operators import resolve as R
from kgspark.operators.diff import label_conflicts
from kgspark.operators.quads import GraphVocabulary, matches_metadata, part_counts
from kgspark.operators.rules import (
    ColumnRule, LayoutSpec, column_examples, header_faults, header_matches, layout_report, map_codes, watch_layout, watch_values,
)
from kgspark.operators.scope import in_scope, off_scope, scope_edges, scope_filter, watch_names
from kgspark.operators.stats import field_counts, seeded_sample, value_histogram
from kgspark.operators.terms import term_usage, undefined_terms
from kgspark.plans import checks as C
from kgspark.plans.describe import characteristics
from kgspark.plans.release import Release
from kgspark.session import any_row, sample_text, write_shared
from kgspark.sources.clustered import ORDER, write_clustered
from kgspark.sources.loads import fresh_load, move, path_exists, remove
from kgspark.sources.manifests import read_manifest
from kgspark.sources.releases import (
    discard_release, graph_name, publish_release, read_release_json, read_staged, release_metadata, release_row, stage_release,
    write_metadata,
)
from kgspark.sources.tsv import (
    file_heads, read_keyed_tsv, read_strict_tsv, write_result, write_unresolved_report,
)
from kgspark.vocab import EVIDENCE_TERM, SPECIES_TAXON

# Shapes of the source columns.
STABLE_ID = r"^R-[A-Z]{3}-\d+(\.\d+)?$"
SCOPED_ID = r"^R-HSA-\d+(\.\d+)?$"
ACCESSION = r"^[A-Z0-9]{6,10}(-\d+)?$"
TERM_ID = r"^GO:\d{7}$"
WEB_ADDRESS = r"^https?://"
ID_PATTERNS = (STABLE_ID, ACCESSION)

SPECIES = tuple(SPECIES_TAXON)
#: Tables that queries look genes up in.
CLUSTERED = ("gene", "facts", "participation")
CODES = tuple(EVIDENCE_TERM)


def _required(*columns: str) -> tuple[ColumnRule, ...]:
    return tuple(ColumnRule(c, "required") for c in columns)


LAYOUTS = {
    "pathways": LayoutSpec(
        "pathways", ("stable_id", "pathway_name", "species_name"),
        (ColumnRule("stable_id", "pattern", STABLE_ID), *_required("pathway_name"),
         ColumnRule("species_name", "enum", SPECIES)),
        id_patterns=ID_PATTERNS, note="all species; scope is the name in column 3",
    ),
    "relations": LayoutSpec(
        "relations", ("parent_stable_id", "child_stable_id"),
        (ColumnRule("parent_stable_id", "pattern", STABLE_ID), ColumnRule("child_stable_id", "pattern", STABLE_ID)),
        id_patterns=ID_PATTERNS, note="no species column; scope is membership of both ids",
    ),
    "associations": LayoutSpec(
        "associations",
        ("uniprot_accession", "pathway_stable_id", "pathway_browser_url", "event_name", "evidence_code", "species_name"),
        (ColumnRule("uniprot_accession", "pattern", ACCESSION), ColumnRule("pathway_stable_id", "pattern", STABLE_ID),
         ColumnRule("pathway_browser_url", "pattern", WEB_ADDRESS), *_required("event_name"),
         ColumnRule("evidence_code", "enum", CODES), ColumnRule("species_name", "enum", SPECIES)),
        id_patterns=ID_PATTERNS, note="memberships are already closed upwards",
    ),
    "crosswalk": LayoutSpec(
        "crosswalk", ("Identifier", "Name", "GO_Term"),
        (ColumnRule("Identifier", "pattern", SCOPED_ID), *_required("Name"), ColumnRule("GO_Term", "pattern", TERM_ID)),
        has_header=True, expected_header=("Identifier", "Name", "GO_Term"), id_patterns=ID_PATTERNS,
        note="has a header line",
    ),
}


@dataclass(frozen=True)
class Settings:
    """What an ingest is told besides its sources."""

    version: str
    run_date: str
    scope: str = "Homo sapiens"
    species: Mapping[str, str] = field(default_factory=lambda: dict(SPECIES_TAXON))
    evidence: Mapping[str, str] = field(default_factory=lambda: dict(EVIDENCE_TERM))
    max_unresolved: float = 0.10
    source: str = "infores:source"
    infix: str = "R-HSA-"
    model_base: str = "https://example.org/model#"
    expected_nodes: int | None = None
    ceiling: int | None = None
    statements: tuple[int, int] | None = None
    spot: Mapping | None = None
    other_members: str | None = None  # another source's sets, a table of key and member
    sample: int | None = None  # sets compared with it, all unless given
    seed: int = 0
    manifest: str | None = None  # manifest of the source files, for the report
    vocabulary: GraphVocabulary = field(default_factory=GraphVocabulary)

    @property
    def taxon(self) -> str:
        if self.scope not in self.species:
            raise IngestError(f"{self.scope!r} is not in the species vocabulary")
        return f"NCBITaxon:{self.species[self.scope]}"


@dataclass(frozen=True)
class Built:
    """A release with what is needed to report on its making."""

    release: Release
    collapsed: DataFrame
    aliases: DataFrame
    fraction: DataFrame


def local_id(column: str) -> Column:
    """Trimmed id without the prefix it may carry."""
    return F.regexp_replace(trim_blanks(F.col(column)), "^[^:]*:", "")


def build_nodes(pathways: DataFrame, settings: Settings) -> DataFrame:
    """Distinct nodes in scope: ``id, label, taxon``. Every species name must be known."""
    kept = scope_filter(pathways, "species", settings.scope, settings.species, strict=True)
    return kept.select(
        trim_blanks(F.col("id").cast("string")).alias("id"), trim_blanks(F.col("label")).alias("label"),
        F.lit(settings.taxon).alias("taxon"),
    ).distinct()


def build_facts(
    associations: DataFrame, nodes: DataFrame, aliases: DataFrame, settings: Settings, keep=None, verify=None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Facts ``gene, pathway, code, accession``, the folded rows, the unresolved fraction.

    ``associations`` is ``accession, pathway, code, species``, all text. The
    source is read once: names and layout are checked while the folded rows are
    written, and everything after that reads the folded rows.
    """
    keep = keep or (lambda _name, df: write_shared(df))
    watched, verify_names = watch_names(associations, "species", settings.species)
    kept = scope_filter(watched, "species", settings.scope, settings.species).select(
        *[trim_blanks(F.col(c).cast("string")).alias(c) for c in ("accession", "pathway", "code")]
    )
    folded = keep("rows", R.collapse(kept))
    if verify:
        verify()
    verify_names()
    scoped = in_scope(folded, "pathway", nodes)
    mapped = map_codes(scoped, "code", settings.evidence, "term", strict=True)
    facts = R.resolve(mapped.withColumn("code", F.col("term")), aliases)
    if len(set(settings.evidence.values())) < len(settings.evidence):
        facts = facts.distinct()
    off_rows = off_scope(folded, "pathway", nodes).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("n"), F.lit(0).cast("bigint").alias("lost")
    )
    matched = R.with_matches(scoped, aliases).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.when(F.col("matches") == 0, F.col("rows"))), F.lit(0)).alias("lost"),
    )
    fraction = (
        matched.unionByName(off_rows)
        .agg(F.sum("n").alias("rows_in_scope"), F.sum("lost").alias("unresolved_rows"))
        .withColumn("fraction", F.try_divide(F.col("unresolved_rows").cast("double"), F.col("rows_in_scope")))
    )
    return facts, scoped, fraction


def build_genes(facts: DataFrame, dictionary: DataFrame, settings: Settings) -> DataFrame:
    """Genes of the facts with their symbol: ``id, symbol, taxon``."""
    used = facts.select(F.col("gene").alias("id")).distinct()
    symbols = R.symbol_table(dictionary, "id", "symbol")
    return used.join(symbols, "id", "left").select("id", "symbol", F.lit(settings.taxon).alias("taxon"))


def build_release(
    pathways: DataFrame, relations: DataFrame, associations: DataFrame, crosswalk: DataFrame,
    dictionary: DataFrame, settings: Settings, store=None, verify: Mapping | None = None,
) -> Built:
    """All tables of a release from parsed sources.

    Sources: ``id, label, species``; ``child, parent``; ``accession, pathway,
    code, species``; ``pathway, term``; ``id, symbol, aliases``. ``store(name,
    df)`` writes a table and returns it as read back: both shapes derive from
    one stored fact table. ``verify`` has a call per source that raises if its
    layout was broken; it is made once the source has been read.
    """
    keep = store or (lambda _name, df: write_shared(df))
    verified = lambda source: verify[source]() if verify else None
    nodes = keep("node", build_nodes(pathways, settings))
    verified("pathways")
    twice = label_conflicts(nodes)
    if any_row(twice):
        raise IngestError(f"conflicting labels for {sample_text(twice, 'id')}")
    if not any_row(nodes):
        raise IngestError(f"no node is in scope {settings.scope!r}")
    pairs = keep("relations", relations.select("child", "parent").distinct())
    verified("relations")
    hierarchy = keep("hierarchy", scope_edges(pairs, nodes))
    aliases = R.alias_map(dictionary)
    facts, scoped, fraction = build_facts(
        associations, nodes, aliases, settings, keep, verify=lambda: verified("associations")
    )
    facts = keep("facts", facts)
    release = Release(
        node=nodes, hierarchy=hierarchy,
        gene=keep("gene", build_genes(facts, dictionary, settings)),
        facts=facts,
        participation=keep("participation", R.participation_edges(facts)),
        crosswalk=keep("crosswalk", in_scope(crosswalk.select("pathway", "term").distinct(), "pathway", nodes)),
    )
    verified("crosswalk")
    if not any_row(release.crosswalk):
        raise IngestError("no crosswalk row is in scope")
    return Built(release, scoped, aliases, fraction)


def parse_source(spark: SparkSession, path: str, spec: LayoutSpec) -> DataFrame:
    """Rows of one source with ``n_fields``; a wrong header in any of its files is an error."""
    faults = header_faults(file_heads(spark, path), spec).limit(1).collect()
    if faults:
        problems = header_matches(faults[0]["head"].split("\t"), spec)
        raise IngestError(f"{faults[0]['file']}: {'; '.join(problems)}")
    must = "_All_Levels" if spec.name == "associations" else None
    return read_strict_tsv(spark, path, spec.columns, spec.has_header, must, strict=False)


def read_sources(spark: SparkSession, paths: Mapping[str, str]) -> tuple[dict[str, DataFrame], dict, dict]:
    """Parsed sources, for each a call that raises if its layout was broken, and one for the values it holds.

    Both are observed while the sources are read for the first and only time, so
    the calls are made after that.
    """
    parsed, verify, values = {}, {}, {}
    for name, spec in LAYOUTS.items():
        rows, verify[name] = watch_layout(parse_source(spark, paths[name], spec), spec)
        rows, values[name] = watch_values(rows, spec)
        parsed[name] = rows.drop("n_fields")
    dictionary = read_keyed_tsv(spark, paths["dictionary"], ["hgnc_id", "symbol", "uniprot_ids"])
    return {
        "pathways": parsed["pathways"].toDF("id", "label", "species"),
        "relations": parsed["relations"].select(
            trim_blanks(F.col("child_stable_id")).alias("child"), trim_blanks(F.col("parent_stable_id")).alias("parent")
        ),
        "associations": parsed["associations"].select(
            F.col("uniprot_accession").alias("accession"), F.col("pathway_stable_id").alias("pathway"),
            F.col("evidence_code").alias("code"), F.col("species_name").alias("species"),
        ),
        "crosswalk": parsed["crosswalk"].select(
            trim_blanks(F.col("Identifier")).alias("pathway"), local_id("GO_Term").alias("term")
        ),
        "dictionary": dictionary.select(local_id("hgnc_id").alias("id"), "symbol", F.col("uniprot_ids").alias("aliases")),
    }, verify, values


def run(
    spark: SparkSession, paths: Mapping[str, str], workdir: str, settings: Settings, defined: DataFrame,
    release_json: str | None = None,
) -> DataFrame:
    """The whole job; returns the check rows. Tables go to ``workdir``.

    Everything is written aside first. A release takes the place of the one
    before it when its checks have passed: its tables by a rename, its
    statements by their marker, its metadata last. A job that fails or is killed
    leaves the former release; what a failed check was about is in the folder
    ``failed=...``.
    """
    workdir = workdir.rstrip("/")
    graph = graph_name(settings.version)
    version = graph.rsplit(":", 1)[-1]
    final, replaced = f"{workdir}/release={version}", f"{workdir}/_replaced/{version}"
    if path_exists(spark, replaced) and not path_exists(spark, final):
        move(spark, replaced, final)  # a job was killed between its two renames
    tables = f"{workdir}/_staged/{version}-{fresh_load()}"

    def store(name: str, df: DataFrame) -> DataFrame:
        path = f"{tables}/{name}"
        if name in CLUSTERED:
            write_clustered(df, path, ORDER[name])
        else:
            df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    sources, verify, values = read_sources(spark, paths)
    reports: dict[str, DataFrame] = {}
    noted = {name: (lambda name=name: reports.setdefault(name, verify[name]())) for name in verify}
    built = build_release(**sources, settings=settings, store=store, verify=noted)
    sourced = lambda tables: reduce(DataFrame.unionByName, [df.withColumn("source", F.lit(n)) for n, df in tables.items()])
    layout = store("layout", sourced(reports))
    held = store("layout_values", sourced({name: counted() for name, counted in values.items()}))
    write_text(spark, layout_sections(layout, held), f"{tables}/layout_report")
    write_unresolved_report(R.unresolved(built.collapsed, built.aliases), f"{tables}/unresolved")
    R.require_resolved(built.fraction, settings.max_unresolved)

    emitted = built.release.quads(graph, settings.source, settings.vocabulary)
    watched, counted = part_counts(emitted)
    load, total = stage_release(watched, f"{workdir}/quads", graph)
    parts = store("statements_per_part", counted())
    stated = parts.agg(F.sum("statements")).collect()[0][0]
    store("metadata_check", matches_metadata(spark.createDataFrame([(total,)], "statements BIGINT"), stated))
    if release_json:
        described = read_release_json(spark, release_json).select(
            F.lit(graph).alias("graph"), "version", "doi", "doi_url", "publication_date", "license_id",
            F.lit(total).cast("bigint").alias("triples"),
        )
    else:
        described = release_row(spark, graph=graph, version=f"v{settings.version.lstrip('vV')}", triples=total)
    metadata = release_metadata(described, settings.run_date, taxon=settings.taxon)

    loaded = read_staged(spark, f"{workdir}/quads", graph, load)
    prefix = settings.vocabulary.participates_in.split(":", 1)[0] + ":"
    usage = store("term_usage", term_usage(loaded, prefix))
    results = store("checks", run_checks(built.release, loaded, settings, defined, usage))
    store("undefined_terms", undefined_terms(usage, defined))
    offenders = store("offenders", C.check_offenders(
        built.release, taxon=settings.taxon, infix=settings.infix, evidence=list(settings.evidence.values()), usage=usage, defined=defined
    ))
    write_text(spark, C.markdown(results, f"Checks of {version}", offenders), f"{tables}/check_report")
    if not C.accepted(results):
        discard_release(spark, f"{workdir}/quads", graph, load)
        remove(spark, f"{workdir}/failed={version}")
        move(spark, tables, f"{workdir}/failed={version}")
        return spark.read.parquet(f"{workdir}/failed={version}/checks")
    sourced = loaded.filter(F.col("p") == settings.vocabulary.source_slot).groupBy("o").agg(F.count(F.lit(1)).alias("n"))
    report = characteristics(
        built.release, codes=list(settings.evidence.values()), source=settings.source, statements=parts,
        knowledge_sources=sourced.select(F.col("o").alias("source"), "n"),
        metadata=metadata.filter(F.col("s") == graph),
        manifest=read_manifest(spark, settings.manifest) if settings.manifest else None,
    )
    write_result(report, f"{tables}/characteristics", "json")
    if path_exists(spark, final):
        remove(spark, replaced)
        move(spark, final, replaced)
    move(spark, tables, final)
    publish_release(spark, f"{workdir}/quads", graph, load)
    write_metadata(spark, metadata, f"{workdir}/metadata", graph)
    remove(spark, replaced)
    return spark.read.parquet(f"{final}/checks")


def write_text(spark: SparkSession, text: str, path: str) -> None:
    """A short report as one text file."""
    rows = [(line,) for line in text.split("\n")]
    spark.createDataFrame(rows, "line STRING").coalesce(1).write.mode("overwrite").text(path)


def layout_markdown(parsed: DataFrame, spec: LayoutSpec) -> str:
    """Layout section of a source: rows, rules and an example per column.

    Reads aggregates only: one row per rule and column. Value counts may be many;
    they are a table of their own, :func:`layout_values`.
    """
    examples = {r["column"]: r["example"] for r in column_examples(parsed, spec).collect()}
    return layout_section(spec, layout_report(parsed, spec).collect(), examples, [])


def layout_sections(layout: DataFrame, values: DataFrame) -> str:
    """Layout sections of all sources from what was observed while they were read; one row per rule, column and value."""
    rules, held = layout.collect(), values.collect()
    sections = []
    for name, spec in LAYOUTS.items():
        own = [r for r in held if r["source"] == name]
        examples = {r["column"]: r["value"] for r in own if r["rows"] is None}
        counts = sorted((r["column"], -r["rows"], r["value"]) for r in own if r["rows"])
        sections.append(layout_section(spec, [r for r in rules if r["source"] == name], examples, [(c, v, -n) for c, n, v in counts]))
    return "\n".join(sections)


def layout_section(spec: LayoutSpec, report: list, examples: Mapping[str, str | None], counts: list[tuple[str, str, int]]) -> str:
    lines = [f"### `{spec.name}`", "", f"- rows: **{report[0]['rows']}**",
             f"- header line: **{'yes' if spec.has_header else 'no'}**", f"- fields: {len(spec.columns)}"]
    if spec.note:
        lines.append(f"- note: {spec.note}")
    lines += ["", "| Col | Name | Example |", "|---|---|---|"]
    lines += [f"| {i} | `{c}` | `{(examples[c] or '')}` |" for i, c in enumerate(spec.columns, start=1)]
    if counts:
        lines += ["", "| Column | Value | Rows |", "|---|---|---|", *(f"| `{c}` | `{v}` | {n} |" for c, v, n in counts)]
    broken = [r for r in report if r["violations"]]
    if broken:
        lines += ["", "**Violations**"]
        lines += [f"- {r['rule']}: {r['violations']}, first `{r['sample']}`" for r in broken]
    return "\n".join(lines) + "\n"


def layout_values(parsed: DataFrame, spec: LayoutSpec) -> DataFrame:
    """Rows per value of the closed columns, and per number of fields: ``column, value, rows``."""
    closed = [r.column for r in spec.rules if r.kind == "enum"]
    counted = field_counts(parsed)
    return counted.unionByName(value_histogram(parsed, closed)) if closed else counted


def member_tables(release: Release, settings: Settings) -> tuple[DataFrame, ...] | None:
    """Our sets, another source's and the seeded sample of keys to compare; None without another source."""
    if settings.other_members is None:
        return None
    ours = release.participation.select(F.col("pathway").alias("key"), F.col("gene").alias("member"))
    theirs = release.node.sparkSession.read.parquet(settings.other_members).select("key", "member")
    if settings.sample is None:
        return ours, theirs
    keys = ours.select("key").unionByName(theirs.select("key"))
    return ours, theirs, seeded_sample(keys, "key", settings.sample, settings.seed)


def run_checks(
    release: Release, quads: DataFrame, settings: Settings, defined: DataFrame, usage: DataFrame
) -> DataFrame:
    """The acceptance suite of a built and stored release; without a spot gene that check is left out."""
    common = dict(
        taxon=settings.taxon, infix=settings.infix, evidence=list(settings.evidence.values()),
        expected_nodes=settings.expected_nodes, usage=usage, defined=defined, statements=settings.statements,
        ceiling=settings.ceiling, members=member_tables(release, settings), known_set=True,
    )
    spot = settings.spot
    results = C.acceptance(
        release, quads, spot=spot or dict(gene="", must_have="", folded=["\0"], exact=[]), **common
    )
    return results if spot else results.filter(~F.col("check").startswith("8."))
