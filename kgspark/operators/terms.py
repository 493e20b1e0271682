"""Model terms: used in the graph, emitted in files, defined by the model."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kgspark.functions.text import BLANKS, model_term
from kgspark.session import write_shared

LOCAL_NAME = "[A-Za-z_][A-Za-z_0-9]*"
# What may stand before the colon of a prefixed name, labels of any file among it.
HEAD = r"[^\s:<>\"'()\[\]{},;^@]*+"
# No label starts right after one of these.
JOINED = r"[:_\p{L}\p{N}#-]"


def _start():
    """A line without its leading blanks."""
    return F.ltrim(F.col("line"), F.lit(BLANKS))


def term_usage(quads: DataFrame, base: str, type_predicate: str = "a") -> DataFrame:
    """Uses of each model term as a predicate or as a class: ``term, uses``."""
    as_class = F.when(F.col("p") == type_predicate, F.col("o"))
    used = quads.select(F.explode(F.array(F.col("p"), as_class)).alias("iri"))
    return (
        used.select(model_term(F.col("iri"), base).alias("term"))
        .filter(F.col("term").isNotNull())
        .groupBy("term")
        .agg(F.count(F.lit(1)).alias("uses"))
    )


def undefined_terms(usage: DataFrame, defined: DataFrame) -> DataFrame:
    """Used terms the model does not define, most used first."""
    return usage.join(defined.select("term"), "term", "left_anti").orderBy(F.desc("uses"), "term")


def _prefix_base(line):
    """Base IRI of a prefix declaration line, else NULL."""
    return F.nullif(F.regexp_extract(line, r"^\s*@prefix\s+[^\s:]*:\s+<([^>]*)>", 1), F.lit(""))


def file_prefixes(lines: DataFrame, base: str) -> DataFrame:
    """Per file, the label its own declarations bind to the model base.

    ``lines`` is ``file, line``. The last label by name wins if a file binds two.
    """
    label = F.regexp_extract("line", r"^\s*@prefix\s+([^\s:]*):\s+<", 1)
    return (
        lines.filter(_start().startswith("@prefix"))
        .select("file", label.alias("label"), _prefix_base(F.col("line")).alias("base"))
        .filter(F.col("base") == base)
        .groupBy("file")
        .agg(F.max("label").alias("label"))
    )


def emitted_terms(lines: DataFrame, base: str) -> DataFrame:
    """Model terms written in text files: ``term, uses``.

    A prefixed name counts only where the file itself binds the prefix to the
    model base. Declarations and comment lines are skipped, and so are
    labels in the middle of a longer name. What stands before a colon may be
    longer than the label (``see/ex:T``), so it is counted whole and its end
    compared with the label of the file.
    """
    # Both spellings of a name hold a colon.
    body = lines.filter(F.contains("line", F.lit(":")) & ~_start().startswith("@prefix") & ~_start().startswith("#"))
    full = F.regexp_extract_all("line", F.lit("<" + re.escape(base) + f"({LOCAL_NAME})>"), 1)
    prefixed = F.regexp_extract_all("line", F.lit(rf"(?<!{JOINED})({HEAD}:{LOCAL_NAME})"), 1)
    # One short row per file, stored so that its true size is known: up to about a million files the text stays where it is.
    bound = write_shared(file_prefixes(lines, base)).select("file", F.col("label").alias("own"))
    own, name = F.col("own"), F.col("name")
    names = F.when(own.isNull(), full).otherwise(F.concat(full, prefixed))
    head = F.substring_index(name, ":", 1)
    before = F.substring(head, F.length(head) - F.length(own), F.lit(1))
    labelled = (head == own) | (F.endswith(head, own) & ~before.rlike(JOINED))
    # A name without a colon was written in full.
    return (
        body.join(bound, "file", "left").select("own", F.explode(names).alias("name"))
        .filter(~F.contains(name, F.lit(":")) | labelled)
        .groupBy(F.substring_index(name, ":", -1).alias("term")).agg(F.count(F.lit(1)).alias("uses"))
    )


def defined_terms(lines: DataFrame, base: str, label: str) -> DataFrame:
    """Terms a model makes statements about: only a line's subject defines.

    Indented lines, comments and declarations have no subject.
    """
    line = F.col("line")
    subject = F.regexp_extract(line, r"^([^\s#@]\S*)", 1)
    local = F.when(
        subject.startswith(label + ":"), F.substring(subject, len(label) + 2, 1 << 30)
    ).otherwise(model_term(subject, base))
    return lines.select(local.alias("term")).filter(F.col("term").isNotNull() & (F.length("term") > 0)).distinct()


def term_review(usage: DataFrame, defined: DataFrame) -> DataFrame:
    """One row: emitted terms and how many of them are undefined."""
    known = defined.select("term", F.lit(1).alias("known")).distinct()
    return usage.join(known, "term", "left").agg(
        F.count(F.lit(1)).alias("emitted"),
        F.count_if(F.col("known").isNull()).alias("undefined"),
    )
