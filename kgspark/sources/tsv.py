"""Tab-separated sources: strict, keyed; and delimited or JSON results."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kgspark.errors import LayoutError
from kgspark.functions.text import BLANKS, trim_blanks
from kgspark.session import any_row, write_shared
from kgspark.sources.quoted import files_with_open_lines, quoted_records
from kgspark.vocab import HEADER_WORDS


def split_lines(lines: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Split ``value`` at tabs, without any quoting: the columns plus ``n_fields``.

    Blank lines are skipped. A short line leaves its missing columns NULL.
    """
    fields = F.split(F.rtrim(F.col("value"), F.lit("\r")), "\t", -1)
    blank = (F.col("n_fields") == 1) & (F.length(trim_blanks(F.col("f")[0])) == 0)
    parsed = lines.select(*[c for c in lines.columns if c != "value"], fields.alias("f")).withColumn(
        "n_fields", F.size("f")
    ).filter(~blank)
    extra = [c for c in lines.columns if c != "value"]
    return parsed.select(
        *extra, *[F.get(F.col("f"), F.lit(i)).alias(c) for i, c in enumerate(columns)], "n_fields"
    )


def first_lines(lines: DataFrame) -> DataFrame:
    """First line of each file, ``file, head``, from ``file, position, value``."""
    return lines.groupBy("file").agg(F.min_by(F.rtrim(F.col("value"), F.lit("\r")), F.col("position")).alias("head"))


def file_heads(spark: SparkSession, path: str) -> DataFrame:
    """First line of each file below a path, in one job for any number of files."""
    lines = spark.read.text(path).filter(F.col("_metadata.file_block_start") == 0)
    return first_lines(lines.select(
        F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("position"), "value"
    ))


def whole_lines(spark: SparkSession, path: str, has_header: bool) -> DataFrame:
    """``value`` of each line of text files; with ``has_header`` without the first line of each file.

    The delimited reader knows where a file starts, so it drops that line and no
    other. Its delimiter is a control character; should a line hold one, the
    reader hands over the line as it is.
    """
    if not has_header:
        return spark.read.text(path)
    read = spark.read.schema("value STRING, broken STRING").option("header", True).option("sep", "\x01").option(
        "quote", "").option("columnNameOfCorruptRecord", "broken")
    return read.csv(path).select(F.coalesce("broken", "value").alias("value"))


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, line`` of text files; compressed files are read by suffix."""
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("line"))


def arity_violations(parsed: DataFrame, width: int) -> DataFrame:
    """Rows whose number of fields is not ``width``."""
    return parsed.filter(F.col("n_fields") != width)


def read_strict_tsv(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    has_header: bool,
    name_must_contain: str | None = None,
    strict: bool = True,
) -> DataFrame:
    """A tab-separated source of fixed layout; all columns are strings.

    No quoting, blank lines skipped, every line must have the declared number of
    fields. The first line of each file must be a header or must not be one, as
    declared. ``strict`` raises at the first line of wrong arity; without it the
    rows come with ``n_fields`` for :func:`arity_violations`.
    """
    files = spark.read.text(path).inputFiles()
    if name_must_contain:
        wrong = [f for f in files if name_must_contain not in f.rsplit("/", 1)[-1]]
        if wrong:
            raise LayoutError(f"file name must contain {name_must_contain!r}: {wrong[0]}")
    is_header = F.lower(trim_blanks(F.substring_index("head", "\t", 1))).isin(*HEADER_WORDS)
    wrong = file_heads(spark, path).filter(is_header != F.lit(has_header)).limit(1).collect()
    if wrong:
        raise LayoutError(f"{wrong[0]['file']}: header expected: {has_header}, first line is {wrong[0]['head']!r}")
    parsed = split_lines(whole_lines(spark, path, has_header), columns)
    if not strict:
        return parsed
    bad = arity_violations(parsed, len(columns))
    if any_row(bad):
        row = bad.limit(1).collect()[0].asDict()
        raise LayoutError(f"{path}: expected {len(columns)} fields, got {row['n_fields']}: {row}")
    return parsed.drop("n_fields")


def read_keyed_tsv(spark: SparkSession, path: str, required: Sequence[str], key: str | None = None) -> DataFrame:
    """A tab-separated source with a header and standard quoting, by column name.

    A missing column is an error, and so is a file whose header differs from the
    first one's, when it is read. A quoted field may hold line breaks. Rows with a
    blank ``key`` (the first required column unless given) are skipped.

    Files are split and read in parallel. Spark's delimited reader takes those
    without a line break in a field line by line; the records of the others are
    put together first (:mod:`kgspark.sources.quoted`).
    """
    key = key or required[0]
    options = {"sep": "\t", "quote": '"', "escape": '"', "enforceSchema": "false", "header": "true"}
    columns = spark.read.options(**options, multiLine=True).csv(path).columns
    missing = [c for c in required if c not in columns]
    if missing:
        raise LayoutError(f"{path} has no column {', '.join(missing)}")
    lines = physical_lines(spark, path)
    spanning = [r["file"] for r in files_with_open_lines(lines).collect()]  # names of files
    schema = ", ".join(f"`{c.replace('`', '``')}` STRING" for c in columns)
    df = spark.read.options(**options).schema(schema).csv(path)
    if spanning:
        here = F.col("_metadata.file_path").isin(*spanning)
        rest = _records_by_name(lines.filter(F.col("file").isin(*spanning)), columns, schema)
        df = df.filter(~here).select(*required).unionByName(rest.select(*required))
    return df.select(*required).filter(F.length(F.btrim(F.coalesce(F.col(key), F.lit("")), F.lit(BLANKS))) > 0)


def physical_lines(spark: SparkSession, path: str) -> DataFrame:
    """``file, block, position, value`` of text files: ``block`` is where a split starts, ``position`` grows within it.

    Only line feeds end a line; a carriage return before one goes.
    """
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("position"), F.rtrim(F.col("value"), F.lit("\r")).alias("value"),
    )


def _records_by_name(lines: DataFrame, columns: Sequence[str], schema: str) -> DataFrame:
    """Columns of the records of ``lines``, the first record of each file being its header."""
    # The lines are read once: positions of another reading need not be the same.
    records = write_shared(quoted_records(write_shared(lines)))
    parsed = records.filter(F.length(trim_blanks(F.col("record"))) > 0).select(
        "file", "block", "position", F.from_csv("record", F.lit(schema), {"sep": "\t", "quote": '"', "escape": '"'}).alias("row"),
    )
    first = parsed.groupBy("file").agg(F.min(F.struct("block", "position")).alias("first"))
    marked = parsed.join(first, "file").withColumn("head", F.struct("block", "position") == F.col("first"))
    wrong = reduce(or_, [~F.col("row").getField(c).eqNullSafe(F.lit(c)) for c in columns])
    faulty = marked.filter(F.col("head") & wrong).agg(F.min("file")).first()[0]
    if faulty is not None:
        raise LayoutError(f"{faulty}: its header is not that of the first file")
    return marked.filter(~F.col("head")).select("row.*")


def write_result(df: DataFrame, path: str, fmt: str = "tsv") -> None:
    """A result table as ``tsv``, ``csv`` or ``json`` files, written in parallel."""
    if fmt == "json":
        df.write.mode("overwrite").json(path)
    elif fmt in ("tsv", "csv"):
        sep = "\t" if fmt == "tsv" else ","
        df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)
    else:
        raise ValueError(f"unknown result format {fmt!r}")


def write_unresolved_report(unresolved: DataFrame, path: str) -> None:
    """The unresolved accessions as TSV in accession order."""
    unresolved.select(
        F.col("accession"), F.col("rows").alias("rows_dropped"), "example_pathway",
        F.col("evidence").alias("evidence_code"),
    ).orderBy("accession").write.mode("overwrite").option("header", True).option("sep", "\t").csv(path)
