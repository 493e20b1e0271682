"""Helpers of the corpus operators: stored intermediates, Arrow kernels over whole rows, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

from kgspark.session import remove_shared, write_shared

#: ASCII white space as a byte string: the separators of `[^\x20\x09-\x0D]+` words. ``bytes.split()`` uses the same six.
WHITE = b" \t\n\r\x0b\f"


def documents(spark, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def map_text(docs: DataFrame, text_col: str, kernel: Callable[[list], dict], fields: str, keep: list[str] | None = None) -> DataFrame:
    """Columns ``row`` (the kept columns as one struct, so that they may have any name) and ``out`` (the kernel's fields).

    ``kernel`` gets a batch of texts as UTF-8 byte strings (None for a null) and returns one list per field of ``fields``
    (DDL). ``keep``: the columns to carry, all by default. Batches are bounded in bytes as well as in rows.
    """
    names = docs.columns if keep is None else keep
    row = F.struct(*[F.col(f"`{c}`") for c in names])
    given = docs.select(row.alias("row"), F.col(f"`{text_col}`").alias("text"))
    inside = text_col in names  # then the text travels once, inside the row
    if inside:
        given = given.select("row")
    made_type = StructType.fromDDL(fields)
    result = StructType([StructField("row", given.schema["row"].dataType), StructField("out", made_type)])
    types = {f.name: to_arrow_type(f.dataType) for f in made_type}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _bounded(whole):
                rows = batch.column("row")
                texts = rows.field(text_col) if inside else batch.column("text")
                made = kernel(texts.cast(pa.binary()).to_pylist())
                out = pa.StructArray.from_arrays([pa.array(made[k], t) for k, t in types.items()], names=list(types))
                yield pa.RecordBatch.from_arrays([rows, out], names=["row", "out"])

    return given.mapInArrow(run, result)


def _bounded(batch: pa.RecordBatch, most: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``most`` bytes, one row at least."""
    step = max(1, int(batch.num_rows * most / max(batch.nbytes, 1)))
    for start in range(0, batch.num_rows, step):
        yield batch.slice(start, step)


def hex_of(value: Column) -> Column:
    """Sixteen lowercase hex digits of a long's two's complement."""
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (u, v; long): one row (node, root) per node of an edge that is not its own root.

    Large-star and small-star steps in turn: each node points all its larger neighbours at its smallest one, then itself
    and its smaller neighbours. A step is grouped minima, combined before the shuffle, and equi-joins with the stored
    minima: stored, so that adaptive execution can split the neighbours of a hot node. The loop ends when a round changes
    nothing; tables of earlier rounds are removed.
    Null ends and loops are ignored; repeated edges count once; no edges give no rows.
    """
    now = write_shared(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    )
    seen = _digest(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = write_shared(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = write_shared(large)
        done, low = low, write_shared(large.groupBy("u").agg(F.min("v").alias("m")))
        remove_shared(done)
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        )
        last, now = now, write_shared(small.select("e.*").where("u <> v").distinct())
        for done in (last, large, low):
            remove_shared(done)
        before, seen = seen, _digest(now)
        if seen == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u", F.lit(7)))).first()
    return tuple(row)
