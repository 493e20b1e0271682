"""Best-fit packing of documents into sequences of a fixed number of words, under conflicts.

A sequence never holds two pieces of one source, nor two pieces of one cluster of duplicates. Open sequences are ordered
by what is left in them and carry a bitmap of their sources and one of their clusters; the search starts at the smallest
residual that suffices and goes on through its successors until a compatible sequence, hence the tightest, is found.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections import Counter

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from kgspark.llm.shared import map_text
from kgspark.session import write_shared

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
#: Words in a sequence.
CAPACITY = 4096
#: Mean number of pieces that one task packs; the number of such parts follows the corpus.
PART = 2048
LOW = 40  # bits of a sequence's number within its part


def cut(text: bytes | None, capacity: int) -> tuple[list[int], list[int], list[int]]:
    """Pieces of at most ``capacity`` words that cover the text: byte starts, byte ends, words. No word: one empty piece."""
    text = text or b""
    n = len(text.split())
    if n <= capacity:
        return [0], [len(text)], [n]
    first = [m.start() for i, m in enumerate(WORD.finditer(text)) if i % capacity == 0]
    first[0] = 0
    return first, [*first[1:], len(text)], [capacity] * (len(first) - 1) + [n - capacity * (len(first) - 1)]


def best_fit(sizes: list[int], sources: list, clusters: list, capacity: int) -> list[int]:
    """Sequence number of each piece, taken in the given order.

    Bitmaps are integers of any length with one bit for each source and each repeated cluster of this part, so they are
    exact. A null source or cluster conflicts with nothing. An empty piece takes no room but obeys conflicts.
    """
    bit_of: dict = {}
    source_bits = [0 if s is None else 1 << bit_of.setdefault(s, len(bit_of)) for s in sources]
    counts: dict = {}
    for c in clusters:
        counts[c] = counts.get(c, 0) + 1
    bit_of = {}
    cluster_bits = [0 if c is None or counts[c] == 1 else 1 << bit_of.setdefault(c, len(bit_of)) for c in clusters]
    by_residual: list[tuple[int, int]] = []  # (residual, sequence), ascending
    held_sources: list[int] = []
    held_clusters: list[int] = []
    chosen = []
    for size, source, cluster in zip(sizes, source_bits, cluster_bits):
        at = bisect_left(by_residual, (size, -1))
        while at < len(by_residual):
            bin_ = by_residual[at][1]
            if not (held_sources[bin_] & source or held_clusters[bin_] & cluster):
                break
            at += 1
        if at < len(by_residual):
            residual, bin_ = by_residual.pop(at)
        else:
            residual, bin_ = capacity, len(held_sources)
            held_sources.append(0)
            held_clusters.append(0)
        held_sources[bin_] |= source
        held_clusters[bin_] |= cluster
        chosen.append(bin_)
        insort(by_residual, (residual - size, bin_))
    return chosen


def pieces(docs: DataFrame, capacity: int, id_col: str, text_col: str, source_col: str, texts: bool) -> DataFrame:
    """One row per piece: doc_id, source, cluster (a hash of the exact text; null for an empty one), piece, words[, text]."""
    fields = "cluster bigint, starts array<bigint>, ends array<bigint>, words array<bigint>"

    def kernel(batch: list) -> dict[str, list]:
        made = [cut(t, capacity) for t in batch]
        return {"cluster": [None] * len(batch), "starts": [m[0] for m in made], "ends": [m[1] for m in made], "words": [m[2] for m in made]}

    keep = [id_col, source_col, text_col]
    cuts = map_text(docs, text_col, kernel, fields, keep)
    text = F.col("row").getField(text_col)
    rows = cuts.select(
        F.col("row").getField(id_col).alias("doc_id"), F.col("row").getField(source_col).alias("source"),
        F.when(F.length(text) > 0, F.xxhash64(text)).alias("cluster"), F.coalesce(text, F.lit("")).cast("binary").alias("body"),
        F.posexplode(F.arrays_zip("out.starts", "out.ends", "out.words")).alias("piece", "at"),
    )
    part = F.expr("substring(body, cast(at.starts as int) + 1, cast(at.ends - at.starts as int))").cast("string")
    return rows.select("doc_id", "source", "cluster", "piece", F.col("at")["words"].alias("words"), *[part.alias("text")] * texts)


def _dealt(docs: DataFrame, capacity: int, id_col: str, text_col: str, source_col: str, texts: bool, part: int) -> DataFrame:
    """Pieces with their part, dealt by a hash of document and piece; about ``part`` of them in each."""
    made = write_shared(pieces(docs, capacity, id_col, text_col, source_col, texts))
    parts = -(-made.count() // part)
    return made.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "cluster"), F.lit(max(parts, 1))))


def _placed(part: pa.Table, capacity: int) -> tuple[pa.Table, list[int], list[int]]:
    """The pieces of one part, longest first, ties by document and piece; the sequence and place of each."""
    keys = [("words", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("cluster", "ascending")]
    part = part.take(pc.sort_indices(part, sort_keys=keys))
    chosen = best_fit(*(part[c].to_pylist() for c in ("words", "source", "cluster")), capacity)
    held: Counter = Counter()
    places = []
    for c in chosen:
        places.append(held[c])
        held[c] += 1
    first = part["part"][0].as_py() << LOW
    return part, [first + c for c in chosen], places


def pack(
    docs: DataFrame, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", texts: bool = False, part: int = PART
) -> DataFrame:
    """Sequence and place of every piece: doc_id, source, piece, words, sequence, place[, text].

    A document of more than ``capacity`` words is cut into whole pieces; nothing is dropped. Pieces are dealt by a hash of
    document and piece into parts of about ``part`` pieces, which are packed apart, longest first, ties by document and
    piece: so a hot source or cluster is spread evenly, no task grows with the corpus, and what is lost is the few open
    sequences at the end of each part. Null or empty texts are empty pieces; null sources conflict with nothing; repeated
    rows are packed each. An empty table gives no row.
    """
    dealt = _dealt(docs, capacity, id_col, text_col, source_col, texts, part)
    columns = ["doc_id", "source", "piece", "words", *["text"] * texts]
    schema = ", ".join(f"`{c}` {dealt.schema[c].dataType.simpleString()}" for c in columns)

    def one_part(given: pa.Table) -> pa.Table:
        rows, chosen, places = _placed(given, capacity)
        added = [pa.array(chosen, pa.int64()), pa.array(places, pa.int64())]
        return pa.table([*(rows[c] for c in columns), *added], names=[*columns, "sequence", "place"])

    return dealt.groupBy("part").applyInArrow(one_part, f"{schema}, sequence bigint, place bigint")


def sequences(
    docs: DataFrame, capacity: int = CAPACITY, separator: str = "\n\n", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", part: int = PART
) -> DataFrame:
    """One row per sequence of :func:`pack`: sequence, words, doc_ids, pieces, text (the pieces in their order, separated).

    A part holds its sequences whole, so they are put together where they are packed.
    """
    dealt = _dealt(docs, capacity, id_col, text_col, source_col, True, part)

    kind = dealt.schema["doc_id"].dataType
    id_type = to_arrow_type(kind)

    def one_part(given: pa.Table) -> pa.Table:
        rows, chosen, _ = _placed(given, capacity)
        held: dict[int, list] = {}
        for sequence, row in zip(chosen, rows.select(["doc_id", "piece", "words", "text"]).to_pylist()):
            held.setdefault(sequence, []).append(row)  # rows keep their order, which is that of place
        of = lambda name: [[r[name] for r in rows] for rows in held.values()]
        columns = {
            "sequence": pa.array(list(held), pa.int64()), "words": pa.array(map(sum, of("words")), pa.int64()),
            "doc_ids": pa.array(of("doc_id"), pa.list_(id_type)), "pieces": pa.array(of("piece"), pa.list_(pa.int32())),
            "text": pa.array(map(separator.join, of("text")), pa.string()),
        }
        return pa.table(columns)

    return dealt.groupBy("part").applyInArrow(one_part, f"sequence bigint, words bigint, doc_ids array<{kind.simpleString()}>, pieces array<int>, text string")


def op4_packing(docs: DataFrame) -> DataFrame:
    return pack(docs).select("doc_id", "source", "piece", "words", "sequence", "place")
