"""Quoted delimited text in parallel: fields may hold line breaks, so where a record starts depends on all lines before.

A line acts on "inside a quote or not" as one of four functions: keep, swap, or settle on either. The last line that settles
and the swaps after it give the state at any place, so states are running aggregates: within each block of a file, then
over the blocks of a file, then over the lines again with the state their block starts in. Lines are put together within
their block; only what a block adds to a record is exchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kgspark.errors import LayoutError
from kgspark.session import write_shared

#: A quoted body up to its closing quote; doubled quotes are inside. Possessive, so a long field costs no stack.
BODY = r'(?:[^"]++|"")*+'


def _fields(sep: str) -> str:
    """Whole fields, each with the separator behind it; a quote opens a field at its very start only."""
    return rf'(?:(?:"{BODY}"[^{sep}]*+|[^"{sep}][^{sep}]*+|){sep})*+'


def leaves_open(line: Column, inside: bool, sep: str = "\t") -> Column:
    """Whether a line that starts inside a quote, or outside, ends inside one."""
    opened = rf'{_fields(sep)}"{BODY}'
    start = rf'(?:{BODY}|{BODY}"[^{sep}]*+{sep}{opened})' if inside else opened
    return line.rlike(rf"\A{start}\z")


def files_with_open_lines(lines: DataFrame, sep: str = "\t") -> DataFrame:
    """``file`` of the files with a field that holds a line break (or is never closed), from ``file, value``.

    Up to the first such line every line starts outside a quote, so no order is needed to find it.
    """
    return lines.filter(F.contains("value", F.lit('"')) & leaves_open(F.col("value"), False, sep)).select("file").distinct()


def quoted_records(lines: DataFrame, sep: str = "\t") -> DataFrame:
    """``file, block, position, record``: whole records from lines ``file, block, position, value``.

    ``block`` orders the parts of a file, ``position`` the lines of a part; both are numbers. A record carries the place
    of its first line; its lines are joined by line feeds. A quote that is never closed is an error, which names a file.
    The order of blocks is worked out on one row per block, that of lines within their block. Blocks are as large as
    Spark splits files, so no task holds more than a block of lines, or one record. ``lines`` are read twice and must be
    the same both times.
    """
    stated = _stated(lines, sep)
    starts = write_shared(_starts(stated))  # of the lines' flags only: their text is not moved for it
    unclosed = starts.groupBy("file").agg(F.max_by("ends", "block").alias("open")).filter("open").agg(F.min("file")).first()[0]
    if unclosed is not None:
        raise LayoutError(f"{unclosed}: a quote is never closed")
    of = lambda name: F.when(F.col("begins"), F.col(f"{name}_in")).otherwise(F.col(f"{name}_out"))
    placed = stated.join(starts.select("file", "block", "begins", "carried"), ["file", "block"]).select(
        "file", "block", "position", "value", of("inside").alias("inside"), of("stays").alias("stays"), of("opener").alias("opener"), "carried"
    )
    # A line belongs to the one that opened its record, in its own block or an earlier one; most are records of their own.
    opened = F.when(F.col("opener").isNotNull(), F.struct("block", F.col("opener").alias("position"))).otherwise(F.col("carried"))
    place = F.when(F.col("inside") | F.col("stays"), opened).otherwise(F.struct("block", "position"))
    # Lines of a block are put together where they are; what is exchanged then is one row per record and block.
    pieces = placed.select("file", "block", place.alias("at"), "position", "value").groupBy("file", "block", "at").agg(
        F.array_join(F.array_sort(F.collect_list(F.struct("position", "value"))).getField("value"), "\n").alias("piece")
    )
    records = pieces.groupBy("file", "at").agg(F.array_sort(F.collect_list(F.struct("block", "piece"))).alias("pieces"))
    return records.select("file", "at.block", "at.position", F.array_join("pieces.piece", "\n").alias("record"))


def _stated(lines: DataFrame, sep: str) -> DataFrame:
    """Lines with what holds if their block starts outside a quote (``_out``) and if it starts inside one (``_in``).

    ``inside`` is the state before the line, ``stays`` that behind it, ``opener`` the last line of the block so far that
    left a quote open.
    """
    has_quote = F.contains("value", F.lit('"'))
    acting = lines.select(
        "file", "block", "position", "value",
        F.when(has_quote, leaves_open(F.col("value"), False, sep)).otherwise(False).alias("from_out"),
        F.when(has_quote, leaves_open(F.col("value"), True, sep)).otherwise(True).alias("from_in"),
    )
    settles, swaps = F.col("from_out") == F.col("from_in"), F.col("from_out") & ~F.col("from_in")
    in_block = Window.partitionBy("file", "block").orderBy("position")
    so_far = in_block.rowsBetween(Window.unboundedPreceding, 0)
    before = in_block.rowsBetween(Window.unboundedPreceding, -1)
    # The state before a line: what the last line that settles left, turned by every swap since.
    counted = acting.withColumn("swapped", F.sum(swaps.cast("int")).over(so_far)).select(
        "*", F.last(F.when(settles, F.struct("from_out", "swapped")), ignorenulls=True).over(before).alias("settled"),
        F.coalesce(F.lag("swapped").over(in_block), F.lit(0)).alias("until"),
    )
    for name, begins in (("out", False), ("in", True)):
        inside = F.when(F.col("settled").isNull(), _turned(F.lit(begins), F.col("until"))).otherwise(
            _turned(F.col("settled.from_out"), F.col("until") - F.col("settled.swapped"))
        )
        counted = counted.withColumn(f"inside_{name}", inside)
        stays = F.when(F.col(f"inside_{name}"), F.col("from_in")).otherwise(F.col("from_out"))
        counted = counted.withColumn(f"stays_{name}", stays).withColumn(
            f"opener_{name}", F.last(F.when(~F.col(f"inside_{name}") & F.col(f"stays_{name}"), F.col("position")), ignorenulls=True).over(so_far)
        )
    return counted.select("file", "block", "position", "value", *[f"{c}_{n}" for n in ("out", "in") for c in ("inside", "stays", "opener")])


def _turned(state: Column, swaps: Column) -> Column:
    return state != (swaps % 2 == 1)


def _starts(stated: DataFrame) -> DataFrame:
    """One row per block: ``begins`` and ``ends`` inside a quote or not; ``carried``, the line left open before it."""
    blocks = stated.groupBy("file", "block").agg(
        F.max_by(F.struct("stays_out", "stays_in"), "position").alias("e"), F.max("opener_out").alias("opener_out"), F.max("opener_in").alias("opener_in")
    ).select("file", "block", "e.stays_out", "e.stays_in", "opener_out", "opener_in")
    over_file = Window.partitionBy("file").orderBy("block")
    earlier = over_file.rowsBetween(Window.unboundedPreceding, -1)
    swaps = F.col("stays_out") & ~F.col("stays_in")
    counted = blocks.withColumn("swapped", F.sum(swaps.cast("int")).over(over_file)).withColumn(
        "settled", F.last(F.when(F.col("stays_out") == F.col("stays_in"), F.struct("stays_out", "swapped")), ignorenulls=True).over(earlier)
    ).withColumn("until", F.coalesce(F.lag("swapped").over(over_file), F.lit(0)))
    begins = F.when(F.col("settled").isNull(), F.col("until") % 2 == 1).otherwise(  # a file starts outside a quote
        _turned(F.col("settled.stays_out"), F.col("until") - F.col("settled.swapped"))
    )
    known = counted.withColumn("begins", begins).select(
        "file", "block", "begins", F.when(F.col("begins"), F.col("stays_in")).otherwise(F.col("stays_out")).alias("ends"),
        F.when(F.col("begins"), F.col("opener_in")).otherwise(F.col("opener_out")).alias("opener"),
    )
    opened = F.when(F.col("opener").isNotNull(), F.struct("block", F.col("opener").alias("position")))
    return known.withColumn("carried", F.last(opened, ignorenulls=True).over(earlier)).drop("opener")
