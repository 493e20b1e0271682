"""Column functions on identifiers, literals and keys. All stay JVM-side."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every blank a text source may pad a field with; plain trim() only takes spaces.
BLANKS = " \t\r\n\x0b\x0c"

SYMBOL_PATTERN = r"^[A-Za-z0-9_.-]+$"
SNAPSHOT_PATTERN = r"^\d{4}-\d{2}-\d{2}$"
RELEASE_TAG_PATTERN = r"(?i)^v[0-9]"
PORTAL_PATTERN = r"^[a-z0-9][a-z0-9-]*$"


def trim_blanks(col: Column) -> Column:
    """Trim every kind of blank from both ends."""
    return F.btrim(col, F.lit(BLANKS))


def blank_to_null(col: Column) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.nullif(trim_blanks(col), F.lit(""))


def base_accession(col: Column) -> Column:
    """The accession before its first ``-``; the suffix names an isoform."""
    return F.substring_index(col, "-", 1)


def is_isoform(col: Column) -> Column:
    """True when the local part of an accession carries an isoform suffix."""
    return local_name(col).contains("-")


def local_name(col: Column) -> Column:
    """Text after the last ``:``."""
    return F.substring_index(col, ":", -1)


def last_segment(col: Column) -> Column:
    """Text after the last ``/``."""
    return F.substring_index(col, "/", -1)


def curie(prefix: str, col: Column) -> Column:
    """Mint ``prefix:local``; a prefix the id already carries is dropped first."""
    return F.concat(F.lit(prefix + ":"), F.regexp_replace(col.cast("string"), "^[^:]*:", ""))


def plain_curie(prefix: str, col: Column) -> Column:
    """Mint ``prefix:id`` without looking inside the id."""
    return F.concat(F.lit(prefix + ":"), col.cast("string"))


def expand_curie(col: Column, prefixes: Mapping[str, str]) -> Column:
    """Full IRI of a CURIE, split at its first ``:``; NULL for an unknown prefix."""
    table = F.create_map(*[F.lit(x) for pair in prefixes.items() for x in pair])
    prefix = F.split_part(col, F.lit(":"), F.lit(1))
    local = F.regexp_replace(col, "^[^:]*:?", "")
    return F.concat(F.try_element_at(table, prefix), local)


def escape_literal(col: Column) -> Column:
    r"""Escape ``\ " \n \r \t`` for a quoted literal."""
    out = F.replace(col, F.lit("\\"), F.lit("\\\\"))
    for raw, escaped in (('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        out = F.replace(out, F.lit(raw), F.lit(escaped))
    return out


def unescape_literal(col: Column) -> Column:
    """Exact inverse of :func:`escape_literal`; JSON strings share these escapes."""
    quoted = F.concat(F.lit('["'), col, F.lit('"]'))
    parsed = F.from_json(quoted, "array<string>", {"allowUnquotedControlChars": "true"})
    return parsed[0]


def quoted_literal(col: Column) -> Column:
    """A literal in quotes."""
    return F.concat(F.lit('"'), escape_literal(col), F.lit('"'))


def iri(col: Column) -> Column:
    """An IRI in angle brackets."""
    return F.concat(F.lit("<"), col, F.lit(">"))


def model_term(col: Column, base: str) -> Column:
    """Local name of a term under ``base``; NULL for every other IRI."""
    bare = F.btrim(col, F.lit("<>"))
    return F.when(
        bare.startswith(base) & (F.length(bare) > len(base)),
        F.substring(bare, len(base) + 1, 1 << 30),
    )


def pad_month(col: Column) -> Column:
    """``YYYY-MM`` becomes the first of that month; other values stay."""
    return F.when(F.length(col) == 7, F.concat(col, F.lit("-01"))).otherwise(col)


def licence_url(col: Column, default: str = "cc-by-4.0") -> Column:
    """Licence page of a licence id."""
    known = F.lower(F.coalesce(blank_to_null(col), F.lit(default)))
    return F.when(
        known.startswith("cc-by-4"), F.lit("https://creativecommons.org/licenses/by/4.0/")
    ).otherwise(F.concat(F.lit("https://spdx.org/licenses/"), known))


def snapshot_key_class(col: Column) -> Column:
    """``date``, ``release_tag`` or ``invalid`` for a snapshot key."""
    return (
        F.when(col.rlike(SNAPSHOT_PATTERN), "date")
        .when(col.rlike(RELEASE_TAG_PATTERN), "release_tag")
        .otherwise("invalid")
    )


def portal_key_valid(col: Column) -> Column:
    """True for a usable portal key."""
    return col.rlike(PORTAL_PATTERN)


def length_prefixed(*cols: Column) -> Column:
    """One text per row that no other row's values can spell."""
    parts = []
    for col in cols:
        text = col.cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.concat(*parts)


def md5_number(col: Column) -> Column:
    """The first 60 bits of the md5 of a text as BIGINT."""
    return F.conv(F.substring(F.md5(col), 1, 15), 16, 10).cast("bigint")
