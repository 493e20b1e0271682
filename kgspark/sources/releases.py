"""Release tables on storage: replace one release, metadata, history."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from kgspark.errors import IngestError
from kgspark.functions.text import licence_url, pad_month
from kgspark.operators.quads import QUAD_COLUMNS, _iri, _text, _typed
from kgspark.session import literal_table, observed
from kgspark.sources.loads import EMPTY, current_loads, fresh_load, names_in, path_exists, publish, remove


def graph_name(version: str, base: str = "urn:kg:release:v") -> str:
    """Graph of a release; the version must be a release number."""
    number = version.lstrip("vV")
    if not (number.isascii() and number.isdecimal()):
        raise IngestError(f"release must be a number, e.g. 97, not {version!r}")
    return base + number


def stage_release(quads: DataFrame, path: str, graph: str) -> tuple[str, int]:
    """Write the statements of a graph to a fresh folder; return the load and its number of statements.

    Readers do not see it before :func:`publish_release`. Rows are sorted by
    predicate within files, so a pattern on a predicate skips row groups. The
    statements are a set; without any there is no folder.
    """
    spark, load, seen = quads.sparkSession, fresh_load(), Observation()
    folder = staged_folder(path, graph, load)
    rows = quads.filter(F.col("graph") == graph).select(*QUAD_COLUMNS).distinct().drop("graph")
    rows.sortWithinPartitions("p", "s").observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(folder)
    written = observed(seen, "rows")
    if written is None:
        written = spark.read.parquet(folder).count()
    if written == 0:
        remove(spark, folder)
        load = EMPTY
    return load, int(written)


def publish_release(spark: SparkSession, path: str, graph: str, load: str) -> None:
    """Make a staged load the release that readers see; the one before it goes afterwards."""
    name = f"graph={_escape(graph)}"
    publish(spark, path, name, load, name)


def discard_release(spark: SparkSession, path: str, graph: str, load: str) -> None:
    """Remove a staged load that will not be published."""
    if load != EMPTY:
        remove(spark, staged_folder(path, graph, load))


def replace_release(quads: DataFrame, path: str, graph: str) -> int:
    """Replace one release graph in a table and leave all others; return its statements.

    The new statements are written aside and then made current in one step, so
    a write that fails leaves the former release.
    """
    load, written = stage_release(quads, path, graph)
    publish_release(quads.sparkSession, path, graph, load)
    return written


def staged_folder(path: str, graph: str, load: str) -> str:
    return f"{path}/graph={_escape(graph)}/load={load}"


# Characters that a partition folder name spells as %XX.
FOLDER_ESCAPED = '"#%\'*/:=?\\{[]^\x7f'


def _escape(value: str) -> str:
    """Folder spelling of a partition value."""
    return "".join(f"%{ord(c):02X}" if c in FOLDER_ESCAPED or ord(c) < 32 else c for c in value)


def read_releases(spark: SparkSession, path: str) -> DataFrame:
    """The statement table over all published releases."""
    folders = [f"{path}/{name}/load={load}" for name, load in sorted(current_loads(spark, path).items()) if load != EMPTY]
    return _statements(spark, path, folders)


def read_staged(spark: SparkSession, path: str, graph: str, load: str) -> DataFrame:
    """The statements of one load, published or not."""
    return _statements(spark, path, [] if load == EMPTY else [staged_folder(path, graph, load)])


def _statements(spark: SparkSession, path: str, folders: list[str]) -> DataFrame:
    schema = "s STRING, p STRING, o STRING, o_kind STRING, o_datatype STRING, graph STRING"
    if not folders:
        return spark.createDataFrame([], schema).select(*QUAD_COLUMNS)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders).select(*QUAD_COLUMNS)


def release_metadata(
    releases: DataFrame, run_date: str, title: str = "Release", taxon: str | None = None,
    scope_note: str = "", closure_note: str = "", activity_base: str = "urn:kg:ingest:",
) -> DataFrame:
    """Dataset and activity statements of releases.

    ``releases`` has ``graph, version, doi, doi_url, publication_date,
    license_id, triples``. A missing date makes no statement; a month is dated
    to its first day.
    """
    activity = F.lit(activity_base + run_date)
    source = F.coalesce(
        F.nullif(F.col("doi_url"), F.lit("")), F.concat(F.lit("https://doi.org/"), F.coalesce("doi", F.lit("")))
    )
    text = lambda value: F.lit(value or None).cast("string")
    dataset = [
        _iri("a", "void:Dataset"),
        _text("rdfs:label", F.concat(F.lit(title + " "), F.col("version"))),
        _iri("dcterms:source", source),
        _text("pav:version", F.upper("version")),
        _iri("dcterms:license", licence_url(F.col("license_id"))),
        _typed("void:triples", F.col("triples"), "xsd:integer"),
        _iri("biolink:in_taxon", text(taxon)),
        _text("dcterms:description", text(scope_note)),
        _text("rdfs:comment", text(closure_note)),
        _iri("prov:wasGeneratedBy", activity),
        _typed("dcterms:issued", pad_month(F.nullif(F.col("publication_date"), F.lit(""))), "xsd:date"),
    ]
    run = [
        _iri("a", "prov:Activity"),
        _text("rdfs:label", F.lit(f"{title} ingest, {run_date}")),
        _iri("prov:used", source),
        _typed("prov:endedAtTime", F.lit(run_date), "xsd:date"),
    ]
    stated = releases.select(F.col("graph").alias("s"), F.inline(F.array(*dataset))).unionByName(
        releases.select(activity.alias("s"), F.inline(F.array(*run)))
    )
    return stated.filter(F.col("o").isNotNull()).distinct()


def upsert_metadata(existing: DataFrame, new: DataFrame, graph: str) -> DataFrame:
    """Metadata after a load: the graph's own statements are replaced, all others stay."""
    kept = existing.filter(F.col("s") != graph)
    return kept.unionByName(new).distinct()


METADATA = "s STRING, p STRING, o STRING, o_kind STRING, o_datatype STRING, own BOOLEAN, load BIGINT"
#: Loads kept side by side; one more puts them together.
MOST_LOADS = 32


def write_metadata(spark: SparkSession, new: DataFrame, path: str, graph: str) -> None:
    """Upsert metadata in storage: a load is appended, and reading decides what it replaces.

    The graph's own statements replace those of its earlier loads; activity
    statements accumulate. Every load is one folder of few files whatever it
    describes. When there are many loads, the new one takes in what the others
    still say and they go; they say nothing new, should that be interrupted.
    """
    loads = _metadata_loads(spark, path)
    rows = new.withColumn("own", F.col("s") == graph)
    crowded = len(loads) >= MOST_LOADS
    if crowded:
        kept = _last_statements(spark, path).filter(~F.col("own") | (F.col("s") != graph))
        rows = rows.unionByName(kept.select(*rows.columns)).distinct()
    rows.write.mode("append").parquet(f"{path}/load={max(loads, default=0) + 1}")
    if crowded:
        for load in loads:
            remove(spark, f"{path}/load={load}")


def _metadata_loads(spark: SparkSession, path: str) -> list[int]:
    return [int(n[len("load="):]) for n in names_in(spark, path) if n.startswith("load=")]


def _last_statements(spark: SparkSession, path: str) -> DataFrame:
    """Statements with ``own``: of a graph those of its last load, of an activity all."""
    if not _metadata_loads(spark, path):
        return spark.createDataFrame([], METADATA).drop("load")
    stored = spark.read.schema(METADATA).parquet(path)
    last = stored.filter("own").groupBy("s").agg(F.max("load").alias("last"))
    kept = stored.join(last, "s", "left").filter(~F.col("own") | (F.col("load") == F.col("last")))
    return kept.drop("load", "last").distinct()


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """Stored metadata statements."""
    return _last_statements(spark, path).select("s", "p", "o", "o_kind", "o_datatype")


def append_retired(rows: DataFrame, path: str) -> None:
    """Append retirement rows to the history; rows already there are not repeated."""
    spark = rows.sparkSession
    if path_exists(spark, path):
        known = spark.read.parquet(path).select("id", "retired_in")
        rows = rows.join(known, ["id", "retired_in"], "left_anti")
    rows.write.mode("append").parquet(path)


def retired_quads(rows: DataFrame, graph: str, taxon: str, prefix: str = "P") -> DataFrame:
    """Statements about retired nodes for the cumulative retired graph."""
    from kgspark.functions.text import plain_curie

    statements = [
        _iri("a", "biolink:Pathway"),
        _text("rdfs:label", F.col("label")),
        _iri("biolink:in_taxon", taxon),
        _typed("owl:deprecated", F.lit("true"), "xsd:boolean"),
        _text("model:last_seen_in_release", F.col("last_seen")),
        _text("model:retired_in_release", F.col("retired_in")),
        _iri("dcterms:isReplacedBy", F.when(F.col("replaced_by").isNotNull(), plain_curie(prefix, F.col("replaced_by")))),
    ]
    return rows.select(plain_curie(prefix, F.col("id")).alias("s"), F.inline(F.array(*statements))).filter(
        F.col("o").isNotNull()
    ).select(F.lit(graph).alias("graph"), "s", "p", "o", "o_kind", "o_datatype")


def release_row(spark: SparkSession, **fields) -> DataFrame:
    """A one-row input for :func:`release_metadata`."""
    names = ("graph", "version", "doi", "doi_url", "publication_date", "license_id")
    row = tuple(fields.get(n) or "" for n in names) + (int(fields.get("triples") or 0),)
    return literal_table(spark, [row], ", ".join(f"{n} STRING" for n in names) + ", triples BIGINT")


def read_release_json(spark: SparkSession, path: str) -> DataFrame:
    """The release description written next to the sources."""
    schema = (
        "version STRING, doi STRING, doi_url STRING, publication_date STRING, license_id STRING, "
        "zip_url STRING, zip_size BIGINT, zip_md5 STRING, concept_doi STRING"
    )
    return spark.read.schema(schema).option("multiLine", True).json(path)
