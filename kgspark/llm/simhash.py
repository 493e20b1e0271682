"""Near-duplicates by SimHash: 64-bit fingerprints, linked where few bits differ.

Bit-sliced comparison: a tile's fingerprints are stored as 64 vertical bit planes, so one machine word holds one bit
of 64 fingerprints. A query's distances to all lanes of a word are updated together, plane by plane, in carry-save
counters; a word is abandoned as soon as all its 64 distances exceed the radius.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kgspark.llm.shared import components, hex_of, map_text
from kgspark.session import write_shared

BITS = 64
SEED = 42
#: Rows of a bucket in one tile side; a larger bucket is dealt out as pairs of chunks.
CHUNK = 4096
#: Buckets far smaller than this are compared together.
SWEEP = 512
ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


# ---------------------------------------------------------------- fingerprints


def fingerprint(text: bytes | None, shingle: int = 4) -> int:
    """Majority bits of the XXH64 of all word shingles, as a signed long; 0 without a word."""
    words = (text or b"").lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n < shingle:
        return int.from_bytes(xxhash.xxh64_digest(joined, SEED), "big", signed=True)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[: n - shingle + 1].tolist()
    ends = ends[shingle - 1 :].tolist()
    digest, count, total = xxhash.xxh64_digest, np.zeros(BITS, np.int64), len(ends)
    for at in range(0, total, 1 << 16):  # a very long text is counted in blocks
        block = b"".join([digest(joined[a:b], SEED) for a, b in zip(starts[at : at + (1 << 16)], ends[at : at + (1 << 16)])])
        bits = np.unpackbits(np.frombuffer(block, np.uint8).reshape(-1, 8), axis=1)
        count += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * count > total).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None, shingle: int = 4) -> DataFrame:
    """``row`` (the kept columns) and ``out.fp`` of every document; a null text counts as empty."""
    return map_text(docs, text_col, lambda texts: {"fp": [fingerprint(t, shingle) for t in texts]}, "fp bigint", keep)


# ---------------------------------------------------------------- bit-sliced comparison


def planes(values: np.ndarray) -> np.ndarray:
    """Bit planes of 64-bit values: row b, word w holds bit b of values 64w to 64w+63."""
    pad = -len(values) % BITS
    bits = np.unpackbits(np.concatenate([values, np.zeros(pad, np.uint64)]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def near(queries: np.ndarray, sliced: np.ndarray, skip: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, word, lanes): the lanes of ``sliced`` within ``radius`` of each query, without those set in ``skip``.

    ``skip`` has a row per query and a word per 64 lanes. Counters are vertical too: counter k holds bit k of 64
    distances. Two planes enter through a full adder, the carry ripples up, and what leaves the top stays set.
    """
    digits = radius.bit_length()
    row, word = np.nonzero(skip != ONES)
    lost = skip[row, word]
    counters = [np.zeros(len(row), np.uint64) for _ in range(digits)]
    for first in range(0, BITS, 8):
        for bit in range(first, first + 8, 2):
            x = sliced[bit][word] ^ _spread(queries, bit)[row]
            y = sliced[bit + 1][word] ^ _spread(queries, bit + 1)[row]
            odd = x ^ y
            carry = (x & y) | (counters[0] & odd)
            counters[0] ^= odd
            for k in range(1, digits):
                counters[k], carry = counters[k] ^ carry, counters[k] & carry
            lost = lost | carry
        over = lost | _exceeds(counters, radius)
        left = np.flatnonzero(over != ONES)
        if len(left) < len(row):  # whole words are beyond the radius: abandon them
            row, word, lost, over = row[left], word[left], lost[left], over[left]
            counters = [c[left] for c in counters]
        if not len(row):
            break
    return row, word, ~over if len(row) else lost


def _spread(queries: np.ndarray, bit: int) -> np.ndarray:
    """All ones where the query has the bit."""
    return np.uint64(0) - ((queries >> np.uint64(bit)) & np.uint64(1))


def _exceeds(counters: list[np.ndarray], limit: int) -> np.ndarray:
    more, same = np.zeros_like(counters[0]), np.full_like(counters[0], ONES)
    for k in reversed(range(len(counters))):
        if limit >> k & 1:
            same = same & counters[k]
        else:
            more, same = more | (same & counters[k]), same & ~counters[k]
    return more


def forest(values: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(member, head): a star for each linked component within ``values``; single values give nothing.

    Lanes already known to be connected are skipped, so a dense group costs one sweep, and no list of pairs is made.
    """
    values = np.unique(values)
    n = len(values)
    if n < 2:
        return values[:0], values[:0]
    sliced = planes(values)
    label = np.full(sliced.shape[1] * BITS, -1)
    label[:n] = np.arange(n)
    for w in range(sliced.shape[1]):
        own = slice(w * BITS, min((w + 1) * BITS, n))
        skip = (label[own, None] == label[None, w * BITS :]) | (label[None, w * BITS :] < 0)
        skip[:, :BITS] |= np.tri(skip.shape[0], BITS, dtype=bool)
        skip = np.packbits(skip, axis=1, bitorder="little").view(np.uint64)
        row, word, lanes = near(values[own], sliced[:, w:], skip, radius)
        hits = np.unpackbits(lanes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        entry, lane = np.nonzero(hits)
        other, mine = (word[entry] + w) * BITS + lane, row[entry] + w * BITS
        for q in np.unique(mine):
            met = np.unique(label[other[mine == q]])
            met = met[met != label[q]]
            if len(met):
                low = min(met[0], label[q])
                label[np.isin(label, np.append(met, label[q]))] = low
    label = label[:n]
    moved = np.flatnonzero(label != np.arange(n))
    return values[moved], values[label[moved]]


def tile_links(radius: int):
    """Partition kernel: rows (tile, fp) sorted by tile to star edges. Only the tile at hand is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles, values = np.empty(0, np.int64), np.empty(0, np.uint64)

        def edges(cuts: np.ndarray) -> pa.RecordBatch:
            # small neighbours share a sweep: a link found between two buckets is as true as one within
            at = [a for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()) if a // SWEEP != b // SWEEP]
            found = [forest(part, radius) for part in np.split(values[: cuts[-1]], at)]
            u, v = (np.concatenate([np.empty(0, np.uint64), *(f[i] for f in found)]).view(np.int64) for i in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])

        for batch in batches:
            tiles = np.concatenate([tiles, batch.column("tile").to_numpy()])
            values = np.concatenate([values, batch.column("fp").to_numpy().view(np.uint64)])
            cuts = np.flatnonzero(tiles[1:] != tiles[:-1]) + 1
            if len(cuts):
                yield edges(cuts)
                tiles, values = tiles[cuts[-1] :], values[cuts[-1] :]
        if len(values) > 1:
            yield edges(np.array([len(values)]))

    return run


# ---------------------------------------------------------------- candidates


def scheme(n: int, radius: int) -> tuple[int, int]:
    """(blocks, equal blocks): the cheapest exact split for ``n`` fingerprints.

    With ``radius + e`` blocks, two fingerprints within the radius agree in ``e`` whole blocks at least, so each scheme
    finds every link. More equal blocks mean longer keys (fewer comparisons) and more copies of a row. Costs: about
    1 microsecond to shuffle a row, 2 nanoseconds to compare a pair.
    """

    def cost(equal: int) -> float:
        copies = math.comb(radius + equal, equal)
        return n * copies * (1.0 + 0.002 * n / 2 / 2 ** (BITS * equal / (radius + equal)))

    best = min(range(1, 5), key=cost)
    return radius + best, best


def block_keys(fp: Column, blocks: int, equal: int) -> Column:
    """One long for each choice of ``equal`` blocks: its number above the packed bits of the blocks."""
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    keys = []
    for number, chosen in enumerate(combinations(range(blocks), equal)):
        packed, width = F.lit(number).cast("bigint"), 0
        for b in chosen:
            size = edges[b + 1] - edges[b]
            part = F.shiftrightunsigned(fp, edges[b]).bitwiseAND(F.lit((1 << size) - 1).cast("bigint"))
            packed, width = F.shiftleft(packed, size).bitwiseOR(part), width + size
        keys.append(packed)
    return F.array(*keys)


def link_edges(distinct: DataFrame, radius: int = 4, chunk: int = CHUNK) -> DataFrame:
    """Star edges (u, v) that connect exactly the fingerprints linked by chains of at most ``radius`` bits.

    ``distinct``: column fp, no repeats. Rows meet where they share a block key. A bucket of more than ``chunk`` rows is
    cut into chunks by hash, and each pair of chunks is a tile of its own, so no task gets a whole hot bucket.
    """
    blocks, equal = scheme(distinct.count(), radius)
    keyed = distinct.select("fp", F.explode(block_keys(F.col("fp"), blocks, equal)).alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    # Stored, so that the join below can split a hot key.
    shared = write_shared(shared.select("key", F.ceil(F.col("n") / chunk).cast("int").alias("chunks")))
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    dealt = keyed.join(shared, "key").select(
        "fp", "key", own.alias("own"),
        F.explode(F.when(F.col("chunks") == 1, F.array(F.lit(0))).otherwise(
            F.filter(F.sequence(F.lit(0), F.col("chunks") - 1), lambda other: other != own))).alias("other"),
    )
    tiled = dealt.select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("tile"), "fp")
    return tiled.repartition("tile").sortWithinPartitions("tile").mapInArrow(tile_links(radius), "u bigint, v bigint")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = 4, shingle: int = 4) -> DataFrame:
    """One row per row of ``docs``: doc_id, fp (long), root (a fingerprint that names the group), component_id.

    Words are runs of other than ASCII white space, A-Z lower-cased; a text of fewer words than a shingle is one
    shingle; an empty or null text has fingerprint 0 and is linked like any other. component_id is the smallest id of
    the group, null only if no row of the group has one. Repeated rows stay, in one group. An empty table gives no row.
    """
    prints = write_shared(
        fingerprints(docs, text_col, [id_col], shingle).select(F.col("row").getField(id_col).alias("doc_id"), F.col("out.fp").alias("fp"))
    )
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    edges = link_edges(distinct.select("fp"), radius)
    rooted = distinct.join(components(edges), F.col("fp") == F.col("node"), "left")
    rooted = rooted.select("fp", "first", F.coalesce("root", "fp").alias("root"))
    rooted = write_shared(rooted)
    named = write_shared(rooted.groupBy("root").agg(F.min("first").alias("component_id")))
    return prints.join(rooted.select("fp", "root").join(named, "root"), "fp").select("doc_id", "fp", "root", "component_id")


def op1_simhash(docs: DataFrame) -> DataFrame:
    groups = simhash_groups(docs)
    return groups.select("doc_id", hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group: the one with the smallest id.

    Ids that name one row each are settled by an anti-join with the ids to drop. Rows whose id is null or repeated are
    settled by their own fingerprints: a row stays if its id is its group's smallest (null only where no row of the
    group has an id), and of equal ones one stays.
    """
    groups = write_shared(simhash_groups(docs, id_col, text_col))
    unclear = write_shared(groups.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1 or doc_id is null").select("doc_id"))
    gone = groups.where("doc_id <> component_id").select("doc_id").distinct()
    apart = write_shared(gone.union(unclear).distinct())
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").alias("ident"))
    met = F.col("ident").eqNullSafe(F.col("doc_id"))
    clear = rows.join(apart, met, "left_anti").select("row.*")
    if unclear.isEmpty():
        return clear
    printed = fingerprints(rows.join(unclear, met, "left_semi").select("row.*"), text_col)
    printed = printed.select("row", F.col("row").getField(id_col).alias("ident"), F.col("out.fp").alias("fp"))
    heads = groups.select("fp", "root", "component_id").distinct()
    printed = printed.join(heads, "fp").where("ident <=> component_id").dropDuplicates(["ident", "root"])
    return clear.unionByName(printed.select("row.*"))
