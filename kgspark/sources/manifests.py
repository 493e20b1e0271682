"""File manifests: checksums, payload checks, comparison, commented headers."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kgspark.errors import IngestError
from kgspark.functions.text import BLANKS, trim_blanks
from kgspark.session import any_row, sample_text


# Bytes hashed at a time.
CHUNK = 8 << 20


def file_manifest(spark: SparkSession, directory: str, origin: str = "", chunk: int = CHUNK) -> DataFrame:
    """``filename, bytes, md5, retrieved_from`` of the files in a folder.

    Spark lists the files and deals them out, a task reads one after the other in
    chunks, so a file of any size takes little memory.
    """
    files = spark.read.format("binaryFile").load(directory).select("path", "length")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sums = []
            for path in batch.column("path").to_pylist():
                store, name = fs.FileSystem.from_uri(re.sub(r"^file:/(?!//)", "file:///", path))
                digest = hashlib.md5()
                with store.open_input_stream(name) as stream:
                    while block := stream.read(chunk):
                        digest.update(block)
                sums.append(digest.hexdigest())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums, pa.string())], names=["path", "length", "md5"])

    name = F.substring_index("path", "/", -1)
    return files.mapInArrow(hashed, "path STRING, length BIGINT, md5 STRING").select(
        name.alias("filename"), F.col("length").alias("bytes"), "md5", F.concat(F.lit(origin), name).alias("retrieved_from")
    )


def sniff_tabular(payloads: DataFrame, content: str = "content") -> DataFrame:
    """Add ``tabular``: FALSE for a payload that is a web page or has no tab in its first line.

    The whole payload is looked at: its first character that is not blank, and
    its first line.
    """
    text = F.col(content).cast("string")
    page = F.ltrim(text, F.lit(BLANKS)).startswith("<")
    tabbed = F.substring_index(text, "\n", 1).contains("\t")
    return payloads.withColumn("tabular", F.coalesce(~page & tabbed, F.lit(False)))


def compare_manifests(ours: DataFrame, theirs: DataFrame, strict: bool = False) -> DataFrame:
    """``filename, ours_md5, theirs_md5, same`` of the files both sides have."""
    pairs = ours.select("filename", F.col("md5").alias("ours_md5")).join(
        theirs.select("filename", F.col("md5").alias("theirs_md5")), "filename"
    ).withColumn("same", F.col("ours_md5") == F.col("theirs_md5"))
    if strict:
        differing = pairs.filter(~F.col("same"))
        if any_row(differing):
            raise IngestError(f"copies differ: {sample_text(differing, 'filename')}")
    return pairs


def manifest_header(spark: SparkSession, path: str) -> DataFrame:
    """``key, value`` pairs of a manifest's ``#`` lines.

    Two pairs may share a line, two blanks apart; a remark in parentheses is not
    part of the key; keys become lower snake case.
    """
    comments = spark.read.text(path).filter(F.col("value").startswith("#"))
    pair = comments.select(F.explode(F.split(F.ltrim("value", F.lit("# ")), "  ")).alias("pair"))
    cut = F.instr("pair", ":")
    key = F.substring_index(F.substring_index("pair", ":", 1), "(", 1)
    value = trim_blanks(F.col("pair").substr(cut + 1, F.length("pair")))
    return (
        pair.filter(cut > 0)
        .select(F.replace(F.lower(trim_blanks(key)), F.lit(" "), F.lit("_")).alias("key"), value.alias("value"))
        .filter(F.length("value") > 0)
    )


def read_manifest(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Header pairs and file rows of a manifest; ``bytes`` becomes BIGINT where numeric."""
    files = spark.read.option("sep", "\t").option("header", True).option("comment", "#").csv(path)
    if "bytes" in files.columns:
        files = files.withColumn("bytes", F.expr("try_cast(bytes AS BIGINT)"))
    return manifest_header(spark, path), files
