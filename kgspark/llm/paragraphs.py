"""Repeated paragraphs across documents: MinHash banding, exact Jaccard, components, removal of all but the first.

A paragraph is a line of at least one shingle of five words. Further units are the consecutive short lines of a
paragraph that blank lines end, joined, and a short document as a whole, however few its words. The shingles of a unit are
hashed; bands of MinHash values, tuned for recall at the wanted similarity, bring similar units together; colliding ones
are verified on their whole shingle sets. Linked units form clusters, and a cluster keeps its first unit by document and
place.

A passage may also be repeated inside longer paragraphs, or across line breaks. For these, each document's windows of 32
words are thinned by keeping the smallest hash of any 19 neighbours: whatever two passages of 50 words or more have in
common, they keep a common window.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kgspark.llm.shared import components, map_text
from kgspark.session import brief_shuffles, remove_shared, write_shared

#: MIN_WORDS: a line or document of fewer words is short. It decides what is joined and how a line is reported, not what is compared.
MIN_WORDS, SHINGLE, SIMILARITY, RECALL, ROWS = 50, 5, 0.8, 0.995, 2
#: Kinds of units: a line, short lines joined, a short document.
LINE, JOINED, WHOLE = 0, 1, 2
#: Distinct paragraphs of one band key in a tile side; a larger bucket is dealt out as pairs of chunks.
CHUNK = 512
CONTINUED = bytes(range(0x80, 0xC0))
#: Words in a window (a power of two) and neighbours thinned to one; a repeat of their sum less one is always found.
SPAN, THIN = 32, 19
#: Words that one round of array operations takes, from as many texts as it needs: their arrays stay in a core's cache.
GROUP = 8192
#: Nodes a task remembers to have given the shingles of; beyond, it forgets them and may give them again.
REMEMBERED = 1 << 19
UNIT = ("kind", "unit", "start", "end", "words", "node")
WINDOW = ("window", "at")


def tuned_bands(similarity: float = SIMILARITY, rows: int = ROWS, recall: float = RECALL) -> int:
    """Fewest bands of ``rows`` values in which a pair at the wanted similarity collides with the wanted probability."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**rows))


def coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and offsets of ``n`` hash functions, the same on every machine."""
    made = [xxhash.xxh64_intdigest(f"minhash {i}", 0) for i in range(2 * n)]
    return np.array(made[:n], np.uint64) | np.uint64(1), np.array(made[n:], np.uint64)


class _Hashes:
    """64-bit hashes of words, a whole array at a time; the same on every machine."""

    def __call__(self, words: list[bytes]) -> np.ndarray:
        return pd.util.hash_array(np.array(words, object), categorize=False)


def _mixed(hashes: np.ndarray) -> np.ndarray:
    hashes ^= hashes >> np.uint64(31)
    hashes *= np.uint64(0xD6E8FEB86659FD93)
    hashes ^= hashes >> np.uint64(32)
    return hashes


def shingle_hashes(hashes: np.ndarray, shingle: int = SHINGLE) -> np.ndarray:
    """64-bit hash of the shingle that starts at each hashed word; fewer words than a shingle are one shingle."""
    size = min(shingle, len(hashes))
    n = len(hashes) - size + 1
    made = hashes[:n].copy()
    for i in range(1, size):
        made *= np.uint64(0x9E3779B97F4A7C15)
        made += hashes[i : i + n]
    return _mixed(made)


def shingle_set(words: list[bytes], shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles."""
    return np.unique(shingle_hashes(_Hashes()(words), shingle))


def bands_of(hashes: np.ndarray, spans: list[tuple[int, int]], multiply: np.ndarray, add: np.ndarray, rows: int) -> np.ndarray:
    """Band keys of each span (start, end) of shingles: an array of spans by bands.

    The shingle hashes are mixed already, so a MinHash function is one multiplication and one addition of 32 bits.
    """
    high = (hashes >> np.uint64(32)).astype(np.uint32)
    mixed = np.empty((len(multiply), len(high) + 1), np.uint32)  # a span may end with the last shingle
    np.multiply(multiply.astype(np.uint32)[:, None], high[None, :], out=mixed[:, :-1])
    mixed += add.astype(np.uint32)[:, None]
    lows = np.minimum.reduceat(mixed, np.array(spans).ravel(), axis=1)[:, ::2].astype(np.uint64).reshape(-1, rows, len(spans))
    keys = np.arange(1, len(lows) + 1, dtype=np.uint64)[:, None] * np.uint64(0xC2B2AE3D27D4EB4F)
    for i in range(rows):
        keys = _mixed(keys * np.uint64(0x9E3779B97F4A7C15) + lows[:, i])
    return keys.T.view(np.int64)


def band_keys(members: np.ndarray, multiply: np.ndarray, add: np.ndarray, rows: int) -> list[int]:
    return bands_of(members, [(0, len(members))], multiply, add, rows)[0].tolist()


def units_in(text: bytes | None, short: int) -> tuple[list[bytes], list[tuple[int, int, int, int, int, int]]]:
    """(folded words, units) of a text. Unit: kind, number of the first line, start, end (code points), first word, words."""
    words, units, run, at = [], [], [], 0

    def join() -> None:
        if len(run) > 1 and (n := sum(r[5] for r in run)) >= SHINGLE:
            units.append((JOINED, run[0][1], run[0][2], run[-1][3], run[0][4], n))
        run.clear()

    for number, line in enumerate((text or b"").split(b"\n")):
        size = len(line.translate(None, CONTINUED))
        own = line.lower().split()
        unit = (LINE, number, at, at + size, len(words), len(own))
        if len(own) >= SHINGLE:
            units.append(unit)
        if 0 < len(own) < short:
            run.append(unit)
        else:
            join()
        words += own
        at += size + 1
    join()
    if 0 < len(words) < short and all(u[5] < len(words) for u in units):
        units.append((WHOLE, 0, 0, at - 1, 0, len(words)))
    return words, units


def shingled(unit: tuple) -> tuple[int, int]:
    """First and last shingle (exclusive) of a unit."""
    return unit[4], unit[4] + max(1, unit[5] - SHINGLE + 1)


def node_of(words: list[bytes]) -> int:
    """Name of a sequence of folded words (64 bits): case and white space do not matter."""
    return xxhash.xxh64_intdigest(b" ".join(words), 1) - (1 << 63)


def grouped(texts: list, short: int) -> Iterator[tuple[list, list, list, list]]:
    """(words, words of each text, units, units of each text) of consecutive texts with about GROUP words together.

    First words of units are counted within the group. A text too short for a shingle stands alone, as do its words.
    """
    words, sizes, units, counts = [], [], [], []
    for text in texts:
        own, found = units_in(text, short)
        tiny = 0 < len(own) < SHINGLE
        if sizes and (tiny or len(words) + len(own) > GROUP):
            yield words, sizes, units, counts
            words, sizes, units, counts = [], [], [], []
        units += [(*u[:4], u[4] + len(words), u[5]) for u in found]
        words += own
        sizes.append(len(own))
        counts.append(len(found))
        if tiny:
            yield words, sizes, units, counts
            words, sizes, units, counts = [], [], [], []
    if sizes:
        yield words, sizes, units, counts


def nodes_of(words: list[bytes], units: list[tuple]) -> list[int]:
    return [node_of(words[u[4] : u[4] + u[5]]) for u in units]


def _lists(counts: list, values, kind: pa.DataType) -> pa.Array:
    """Lists of as many values as ``counts`` says, one after another."""
    offsets = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def scanned(docs: DataFrame, id_col: str, text_col: str, short: int, similarity: float, rows: int) -> DataFrame:
    """Stored: one row per row of ``docs``: doc_id, lists of equal length for its units, others for its thinned windows."""
    bands = tuned_bands(similarity, rows)
    multiply, add = coefficients(rows * bands)
    keys = [f"band{i}" for i in range(bands)]

    def kernel(texts: list) -> dict[str, pa.Array]:
        hashed = _Hashes()
        fields = {name: [] for name in UNIT}
        parts = {"keys": [np.empty((0, bands), np.int64)], "window": [np.empty(0, np.int64)], "at": [np.empty(0, np.int64)]}
        units_each, windows_each = [], []
        for words, sizes, units, counts in grouped(texts, short):
            hashes = hashed(words)
            if units:
                parts["keys"].append(bands_of(shingle_hashes(hashes), list(map(shingled, units)), multiply, add, rows))
                for name, values in zip(("kind", "unit", "start", "end", "first", "words"), zip(*units)):
                    if name != "first":
                        fields[name] += values
                fields["node"] += nodes_of(words, units)
            window, at, each = thinned(hashes, sizes)
            parts["window"].append(window)
            parts["at"].append(at)
            units_each += counts
            windows_each += each.tolist()
        found = np.concatenate(parts["keys"])
        out = {name: _lists(units_each, fields[name], pa.int64()) for name in UNIT}
        out |= {name: _lists(units_each, found[:, i], pa.int64()) for i, name in enumerate(keys)}
        return out | {name: _lists(windows_each, np.concatenate(parts[name]), pa.int64()) for name in WINDOW}

    made = map_text(docs, text_col, kernel, ", ".join(f"{name} array<bigint>" for name in (*UNIT, *keys, *WINDOW)), [id_col])
    return write_shared(made.select(F.col("row").getField(id_col).alias("doc_id"), "out.*"))


def _rows(stored: DataFrame, names: tuple) -> DataFrame:
    """One row per place of the lists ``names``, with doc_id."""
    made = stored.select("doc_id", F.explode(F.arrays_zip(*names)).alias("u"))
    return made.select("doc_id", *[F.col("u").getField(n).alias(n) for n in names])


def units_of(stored: DataFrame) -> DataFrame:
    """One row per unit: doc_id, kind, unit, start, end (code points), words, node, band0, band1, ..."""
    return _rows(stored, (*UNIT, *[c for c in stored.columns if c.startswith("band")]))


def sets_of(docs: DataFrame, id_col: str, text_col: str, short: int) -> DataFrame:
    """(node, members): the folded words of each unit, joined by spaces, to verify candidates by.

    Words and not the hashes of their shingles: these are longer and do not compress. A task gives the words of a node
    once (or once more for every ``REMEMBERED`` other ones), so a line that stands in a third of all documents gives a row
    per task and not one per document.
    """
    given: set[int] = set()

    def kernel(texts: list) -> dict[str, pa.Array]:
        nodes, members, counts = [], [], []
        for text in texts:
            words, units = units_in(text, short)
            before = len(nodes)
            for unit, node in zip(units, nodes_of(words, units)):
                if node not in given:
                    if len(given) >= REMEMBERED:
                        given.clear()
                    given.add(node)
                    nodes.append(node)
                    members.append(b" ".join(words[unit[4] : unit[4] + unit[5]]))
            counts.append(len(nodes) - before)
        return {"node": _lists(counts, nodes, pa.int64()), "members": _lists(counts, members, pa.binary())}

    made = map_text(docs, text_col, kernel, "node array<bigint>, members array<binary>", [id_col])
    return made.select(F.explode(F.arrays_zip("out.node", "out.members")).alias("u")).select("u.node", "u.members")


# ---------------------------------------------------------------- windows


def _sliding(smaller: np.ufunc, values: np.ndarray, width: int) -> np.ndarray:
    """``smaller`` (a minimum or maximum) over every ``width`` neighbours, by spans that double."""
    size = 1
    while 2 * size <= width:
        values = smaller(values[:-size], values[size:])
        size *= 2
    return smaller(values[: len(values) - width + size], values[width - size :])


def thinned(hashes: np.ndarray, sizes: list[int], span: int = SPAN, thin: int = THIN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first word within its text, number by text) of the windows that are the smallest of ``thin`` neighbours.

    ``hashes``: of the words of several texts with ``sizes`` words. Equal windows of a text count once, its first.
    """
    reach = span + thin - 1
    if len(hashes) < reach:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(sizes), np.int64)
    size, base = 1, 0x9E3779B97F4A7C15
    while size < span:  # a window is two halves
        hashes = hashes[:-size] * np.uint64(base) + hashes[size:]
        size, base = 2 * size, base * base % (1 << 64)
    hashes = np.maximum(_mixed(hashes), np.uint64(1))  # nothing is as small as the zeros below
    text = np.repeat(np.arange(len(sizes)), sizes)
    lows = _sliding(np.minimum, hashes, thin)
    lows[text[: len(lows)] != text[reach - 1 :]] = 0  # neighbours of two texts
    edge = np.zeros(thin - 1, np.uint64)
    kept = np.flatnonzero(hashes <= _sliding(np.maximum, np.concatenate([edge, lows, edge]), thin))
    kept = kept[np.lexsort((hashes[kept], text[kept]))]
    value, own = hashes[kept], text[kept]
    first = np.ones(len(kept), bool)
    first[1:] = (value[1:] != value[:-1]) | (own[1:] != own[:-1])
    kept, own = kept[first], own[first]
    return value[first].view(np.int64), kept - (np.cumsum(sizes) - sizes)[own], np.bincount(own, minlength=len(sizes))


def thinned_windows(words: list[bytes], hashed: _Hashes, span: int = SPAN, thin: int = THIN) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word) of the thinned windows of one text."""
    return thinned(hashed(words), [len(words)], span, thin)[:2]


def shared_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stored: DataFrame | None = None) -> DataFrame:
    """Stored: doc_id, start, end (words), head: windows found in more than one document, head being the smallest of these.

    Every repeat of SPAN + THIN - 1 words or more between two documents shows in both; shorter ones, down to SPAN words,
    may. Rows without an id take no part, nor do repeats within one document. ``stored``: what :func:`scanned` gave for
    ``docs``, if it is at hand.
    """
    stored = scanned(docs, id_col, text_col, MIN_WORDS, SIMILARITY, ROWS) if stored is None else stored
    found = _rows(stored.where("doc_id is not null"), WINDOW)
    shared = found.groupBy("window").agg(F.min("doc_id").alias("head"), F.max("doc_id").alias("last"))
    shared = write_shared(shared.where("head < last").select("window", "head"))  # stored: the join can split a hot window
    met = found.join(shared, "window").select("doc_id", F.col("at").cast("int").alias("start"), (F.col("at") + SPAN).cast("int").alias("end"), "head")
    return write_shared(met)


def covered(spans: Column) -> Column:
    """Number of words in the union of sorted (start, end) spans."""
    zero = F.struct(F.lit(0).cast("bigint").alias("total"), F.lit(0).cast("bigint").alias("reach"))

    def step(done: Column, s: Column) -> Column:
        added = F.greatest(F.lit(0), s["end"] - F.greatest(s["start"], done["reach"]))
        return F.struct((done["total"] + added).alias("total"), F.greatest(done["reach"], s["end"]).cast("bigint").alias("reach"))

    return F.aggregate(spans, zero, step, lambda done: done["total"])


# ---------------------------------------------------------------- paragraphs


def verified(sets: list[list], nodes: np.ndarray, similarity: float) -> list[tuple[int, int]]:
    """(member, head) stars of the components of pairs with a Jaccard similarity of ``similarity`` or more.

    Every pair not yet connected is compared; connected ones need not be, so a dense group costs one sweep.
    """
    groups: list[list[int]] = []
    frozen = [set(s) for s in sets]
    order = np.argsort([len(s) for s in frozen], kind="stable")
    for i in order.tolist():
        joined = None
        for group in groups[:]:
            for j in reversed(group):  # members come by size: once too small for this one, so is the rest
                if len(frozen[j]) < similarity * len(frozen[i]):
                    break
                both = len(frozen[i] & frozen[j])
                if both >= similarity * (len(frozen[i]) + len(frozen[j]) - both):
                    if joined is None:
                        joined = group
                    else:
                        joined[:] = sorted(joined + group, key=lambda k: len(frozen[k]))
                        groups.remove(group)
                    break
        if joined is None:
            groups.append([i])
        else:
            joined.append(i)
    return [(int(nodes[i]), int(nodes[min(g)])) for g in groups for i in g if i != min(g)]


def shingle_sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    """:func:`shingle_set` of each text of folded words, hashed together."""
    words = [text.split() for text in texts]
    hashes, at = _Hashes()([w for own in words for w in own]), 0
    for own in words:
        yield np.unique(shingle_hashes(hashes[at : at + len(own)]))
        at += len(own)


def _verify_tiles(similarity: float):
    """Partition kernel over rows (tile, node, members) sorted by tile; only the tile at hand is held."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, nodes, sets = None, [], []

        def edges() -> pa.RecordBatch:
            found = verified(sets, np.array(nodes), similarity) if len(nodes) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], names=["u", "v"])

        for batch in batches:
            made = shingle_sets(batch.column("members").to_pylist())
            for t, node, own in zip(batch.column("tile").to_pylist(), batch.column("node").to_pylist(), made):
                if t != tile:
                    yield edges()
                    tile, nodes, sets = t, [], []
                nodes.append(node)
                sets.append(own.tolist())
        yield edges()

    return run


def clusters(units: DataFrame, sets: DataFrame, similarity: float = SIMILARITY, chunk: int = CHUNK) -> DataFrame:
    """(node, cluster): each distinct paragraph that is linked to a smaller node, directly or by a chain.

    ``sets`` are made from the texts again and meet the candidates as they come: keeping them all would cost more than
    a second reading. Bands that bring the same nodes together, told by two 64-bit digests of these and their number, are
    one bucket and verified once.
    """
    bands = [c for c in units.columns if c.startswith("band")]
    nodes = write_shared(units.groupBy("node").agg(*[F.min(b).alias(b) for b in bands]))  # equal in all units of a node
    keyed = nodes.select("node", F.explode(F.array(*bands)).alias("key"))
    digest = [F.bit_xor(F.xxhash64("node", F.lit(seed))).alias(f"x{seed}") for seed in (1, 2)]
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), *digest).where("n > 1")
    shared = shared.groupBy("n", "x1", "x2").agg(F.min("key").alias("key"))
    shared = write_shared(shared.select("key", F.ceil(F.col("n") / chunk).cast("int").alias("chunks")))
    own = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    dealt = keyed.join(shared, "key").select(
        "node", "key", own.alias("own"),
        F.explode(F.when(F.col("chunks") == 1, F.array(F.lit(0))).otherwise(
            F.filter(F.sequence(F.lit(0), F.col("chunks") - 1), lambda other: other != own))).alias("other"),
    )
    tiles = write_shared(dealt.select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("tile"), "node"))
    # Candidates grow with the corpus: sort and merge, whatever their number happens to be.
    wanted = sets.join(tiles.select("node").distinct().hint("merge"), "node", "left_semi")
    members = write_shared(wanted.groupBy("node").agg(F.first("members").alias("members")))
    met = tiles.join(members, "node").select("tile", "node", "members")
    edges = met.repartition("tile").sortWithinPartitions("tile").mapInArrow(_verify_tiles(similarity), "u bigint, v bigint")
    linked = components(edges).withColumnRenamed("root", "cluster")
    for done in (nodes, shared, tiles, members):
        remove_shared(done)
    return linked


def repeated_units(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", short: int = MIN_WORDS, similarity: float = SIMILARITY, rows: int = ROWS,
    stored: DataFrame | None = None,
) -> DataFrame:
    """Stored: one row per unit: doc_id, kind, unit, start, end, words, cluster, head, removed, spread.

    ``kind``: LINE (of a shingle or more), JOINED (two or more consecutive lines of fewer than ``short`` words) or WHOLE (a
    document of fewer than ``short`` words that is no other unit). All kinds are compared with each other. ``removed``: all
    units of a cluster but its first by document and place. ``head``: the smallest document of the cluster. ``spread``: the
    cluster reaches more than one document. Rows that share an id count as one document; a null id counts as the smallest.
    Null and empty texts have no units. ``stored``: what :func:`scanned` gave for ``docs`` with these parameters.
    """
    units = units_of(scanned(docs, id_col, text_col, short, similarity, rows) if stored is None else stored)
    named = units.select("doc_id", "kind", "unit", "start", "end", "words", "node").join(
        clusters(units, sets_of(docs, id_col, text_col, short), similarity), "node", "left"
    )
    named = write_shared(named.withColumn("cluster", F.coalesce("cluster", "node")).drop("node"))
    place = F.struct(F.col("doc_id").isNotNull().alias("named"), "doc_id", "unit", "start", "kind")
    heads = named.groupBy("cluster").agg(F.min(place).alias("first"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"), F.count(F.lit(1)).alias("n"), F.count("doc_id").alias("ids"))
    heads = heads.where("n > 1").select(F.col("cluster").alias("c"), "first", F.col("low").alias("head"), (F.col("low").eqNullSafe(F.col("high")) & F.col("ids").isin(0, F.col("n"))).alias("alone"))
    found = named.join(write_shared(heads), F.col("cluster") == F.col("c"), "left")
    removed = F.col("c").isNotNull() & ~place.eqNullSafe(F.col("first"))
    return write_shared(found.select("doc_id", "kind", "unit", "start", "end", "words", "cluster", "head", removed.alias("removed"), (~F.coalesce("alone", F.lit(True))).alias("spread")))


def repeated_paragraphs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, **options) -> DataFrame:
    """The lines of ``min_words`` words or more of :func:`repeated_units`."""
    return repeated_units(docs, id_col, text_col, **options).where((F.col("kind") == LINE) & (F.col("words") >= min_words)).drop("kind")


def describe_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_paragraphs, n_long, n_repeated, n_removed, removed_words, n_joined,
    joined_repeated, joined_removed, passage_words, passage_removed, class_id.

    n_paragraphs: lines of a shingle or more; n_long: those of MIN_WORDS words or more; n_repeated: paragraphs that other
    documents have too; n_removed: those of a cluster but its first. n_joined, joined_repeated, joined_removed: the same of
    joined short lines and short documents, whose words are also in their lines and not counted again. passage_words:
    words inside passages shared with other documents, wherever they stand; passage_removed: those of them whose first
    document is another one. class_id: the smallest id of the documents joined by shared units or passages, directly or by
    a chain; its own id if none.
    """
    options = {"short": MIN_WORDS, "similarity": SIMILARITY, "rows": ROWS} | options
    with brief_shuffles(docs.sparkSession):
        stored = scanned(docs, id_col, text_col, **options)
        units = repeated_units(docs, id_col, text_col, **options, stored=stored)
        windows = shared_windows(docs, id_col, text_col, stored)
        remove_shared(stored)
        edges = units.where("spread and doc_id is not null").select(F.col("doc_id").alias("u"), F.col("head").alias("v"))
        links = components(edges.unionByName(windows.select(F.col("doc_id").alias("u"), F.col("head").alias("v"))))
    count = lambda condition: F.count(F.when(condition, 1))
    line = F.col("kind") == LINE
    summed = units.groupBy("doc_id").agg(
        count(line).alias("n_paragraphs"), count(line & (F.col("words") >= MIN_WORDS)).alias("n_long"),
        count(line & F.col("spread")).alias("n_repeated"), count(line & F.col("removed")).alias("n_removed"),
        F.sum(F.when(line & F.col("removed"), F.col("words")).otherwise(0)).alias("removed_words"),
        count(~line).alias("n_joined"), count(~line & F.col("spread")).alias("joined_repeated"), count(~line & F.col("removed")).alias("joined_removed"),
    )
    # A document's own windows: no more than it has words.
    spans = windows.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("start", "end", (F.col("head") < F.col("doc_id")).alias("later")))).alias("spans"))
    passages = spans.select(
        F.col("doc_id").alias("id"), covered(F.col("spans")).alias("passage_words"),
        covered(F.filter("spans", lambda s: s["later"])).alias("passage_removed"),
    )
    ids = docs.select(F.col(f"`{id_col}`").alias("doc_id"))
    out = ids.alias("d").join(summed.alias("s"), F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")), "left")
    out = out.join(passages, F.col("d.doc_id") == F.col("id"), "left").join(links, F.col("d.doc_id") == F.col("node"), "left")
    zero = lambda name: F.coalesce(name, F.lit(0)).cast("bigint").alias(name)
    counts = (
        "n_paragraphs", "n_long", "n_repeated", "n_removed", "removed_words", "n_joined", "joined_repeated", "joined_removed",
        "passage_words", "passage_removed",
    )
    return out.select("d.doc_id", *map(zero, counts), F.coalesce("root", "d.doc_id").alias("class_id"))


def op6_paragraphs(docs: DataFrame) -> DataFrame:
    return describe_documents(docs)
