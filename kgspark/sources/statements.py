"""Statement text: a line-oriented sink and scan, so both run in parallel."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kgspark.errors import IngestError
from kgspark.functions.text import expand_curie, iri, quoted_literal, unescape_literal
from kgspark.session import any_row, sample_text
from kgspark.vocab import NAMESPACES

RDF_TYPE = NAMESPACES["rdf"] + "type"
# One statement per line: subject, predicate, object, optional graph. The body of a literal is
# matched without backtracking, so that its length does not matter.
LINE = r'^(\S+) (\S+) ("(?:[^"\\]|\\.)*+"(?:\^\^\S+)?|[^"\s]\S*)(?: (<[^>]*>))? \.$'


def _term(col: Column, prefixes: Mapping[str, str]) -> Column:
    """Bracketed IRI of a CURIE; blank nodes and full IRIs (urn:, http:) stay."""
    full = F.when(col.rlike("^(urn:|https?://)"), col).otherwise(expand_curie(col, prefixes))
    return F.when(col.startswith("_:"), col).when(col == "a", iri(F.lit(RDF_TYPE))).otherwise(iri(full))


def nquads_lines(quads: DataFrame, prefixes: Mapping[str, str] = NAMESPACES) -> DataFrame:
    """One escaped line per statement; NULL where a prefix is unknown."""
    literal = F.when(
        F.col("o_datatype").isNull(), quoted_literal(F.col("o"))
    ).otherwise(F.concat(quoted_literal(F.col("o")), F.lit("^^"), _term(F.col("o_datatype"), prefixes)))
    line = F.concat(
        _term(F.col("s"), prefixes), F.lit(" "), _term(F.col("p"), prefixes), F.lit(" "),
        F.when(F.col("o_kind") == "literal", literal).otherwise(_term(F.col("o"), prefixes)),
        F.lit(" "), _term(F.col("graph"), prefixes), F.lit(" ."),
    )
    return quads.select(line.alias("line"))


def unknown_prefixes(quads: DataFrame, prefixes: Mapping[str, str] = NAMESPACES) -> DataFrame:
    """CURIEs no prefix is registered for."""
    terms = quads.select(F.explode(F.array(
        "s", "p", F.when(F.col("o_kind") == "iri", F.col("o")), F.col("o_datatype"), "graph"
    )).alias("term")).filter(F.col("term").isNotNull())
    return terms.filter(_term(F.col("term"), prefixes).isNull()).select("term").distinct()


def write_nquads(quads: DataFrame, path: str, prefixes: Mapping[str, str] = NAMESPACES) -> None:
    """Write statements as text, in the order of subject and predicate over all files.

    The order is total, so equal releases give equal files; an unknown prefix is
    an error before anything is written.
    """
    unknown = unknown_prefixes(quads, prefixes)
    if any_row(unknown):
        raise IngestError(f"no prefix registered for {sample_text(unknown, 'term')}")
    nquads_lines(quads, prefixes).orderBy("line").write.mode("overwrite").text(path)


def read_statements(spark: SparkSession, path: str) -> DataFrame:
    """:func:`parse_statements` of text files."""
    return parse_statements(spark.read.text(path))


def parse_statements(lines: DataFrame) -> DataFrame:
    """``graph, s, p, o, o_kind, o_datatype`` of statement lines ``value``; comments are skipped.

    IRIs come without brackets, literals unquoted and unescaped. A line that is
    no statement gives a row of NULLs for the caller to count.
    """
    lines = lines.filter(
        (F.length(F.trim("value")) > 0) & ~F.ltrim("value").startswith("#")
    )
    def part(i: int) -> Column:
        return F.nullif(F.regexp_extract("value", LINE, i), F.lit(""))

    parts = lines.select(part(1).alias("s"), part(2).alias("p"), part(3).alias("o"), part(4).alias("graph"))
    is_literal = F.col("o").startswith('"')
    body = F.regexp_extract("o", r'^"((?:[^"\\]|\\.)*+)"', 1)
    datatype = F.nullif(F.regexp_extract("o", r'"\^\^<([^>]*)>$', 1), F.lit(""))
    bare = lambda c: F.btrim(F.col(c), F.lit("<>"))
    return parts.select(
        bare("graph").alias("graph"), bare("s").alias("s"), bare("p").alias("p"),
        F.when(is_literal, unescape_literal(body)).otherwise(bare("o")).alias("o"),
        F.when(is_literal, "literal").when(F.col("o").isNotNull(), "iri").alias("o_kind"),
        F.when(is_literal, datatype).alias("o_datatype"),
    )
