"""Source divergence audit: how each source's words differ from its language's and from each other source's.

The strongest terms of a group are those of the largest f(p, q): p grows with the term's count in the group, q with its
count in the language, and where p > q, f grows with p and falls with q. So a term that k others dominate (count in the
group at least as high, count in the language at most as high, earlier in UTF-8) cannot be among the first k, and
partitions keep only their k-skyband: terms with fewer than k dominators. Skybands are merged, and what is left is ranked
exactly.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kgspark.session import write_shared

#: Documents of a language a kept term stands in; terms ranked per group; scale of p.
LEAST_DOCUMENTS, TOP, SCALE = 10, 10, 1_000_000_000
#: Entries of the word counts a task holds before it hands them on.
HELD, DOCUMENT = 400_000, 1 << 38
#: Rows of one group, and of all groups, that a task holds before it reduces them to skybands.
GROUP_ROWS, TASK_ROWS = 4_096, 262_144
#: Sources and terms of a tile: a tile of the pairs compares two chunks of sources over one block of terms.
CHUNK, TERMS = 64, 1_024
#: A-Z to a-z; other ASCII than letters to a space; the rest as it is.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 97 <= c <= 122 else 32 for c in range(256))


def term_counts(docs: DataFrame, text_col: str, lang_col: str, source_col: str) -> DataFrame:
    """lang, source, term, n (occurrences), d (documents): summed within tasks, so a key may come once per task and flush."""
    text = lambda name: F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))
    given = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source"), text(text_col).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Occurrences and documents of a term in one number: a task hands on long before either reaches DOCUMENT.
        counts: dict[tuple, dict[bytes, int]] = defaultdict(dict)
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), found in counts.items():
                terms = list(found)
                for at in range(0, len(terms), 10_000):
                    some = terms[at : at + 10_000]
                    both = np.array([found[t] for t in some], np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang] * len(some), pa.string()), pa.array([source] * len(some), pa.string()),
                            pa.array([t.decode("utf-8", "replace") for t in some], pa.string()),
                            pa.array(both % DOCUMENT, pa.int64()), pa.array(both // DOCUMENT, pa.int64()),
                        ],
                        names=["lang", "source", "term", "n", "d"],
                    )
            counts.clear()

        for batch in batches:
            for lang, source, raw in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), batch.column("text").to_pylist()):
                own = counts[lang, source]
                before, known = len(own), own.get
                for term, n in Counter(raw.translate(LETTERS).split()).items():
                    own[term] = known(term, 0) + DOCUMENT + n
                held += len(own) - before
                if held > HELD:
                    yield from flush()
                    held = 0
        yield from flush()

    return given.mapInArrow(run, "lang string, source string, term string, n bigint, d bigint")


def kept_terms(docs: DataFrame, text_col: str, lang_col: str, source_col: str, least: int) -> DataFrame:
    """Stored: lang, source, term, a (count in the group), b (count in the language), first (true once per lang and term).

    Only terms in at least ``least`` documents of the language. One exchange of the pre-summed counts, by language and
    term; sums per source and per language follow in place.
    """
    counted = term_counts(docs, text_col, lang_col, source_col).repartition("lang", "term")
    summed = counted.groupBy("lang", "term", "source").agg(F.sum("n").alias("a"), F.sum("d").alias("d"))
    of_term = Window.partitionBy("lang", "term")
    told = summed.select(
        "lang", "source", "term", "a", F.sum("a").over(of_term).alias("b"), F.sum("d").over(of_term).alias("documents"),
        (F.col("source") == F.min("source").over(of_term)).alias("first"),
    )
    return write_shared(told.where(F.col("documents") >= least).drop("documents"))


def group_sizes(docs: DataFrame, kept: DataFrame, lang_col: str, source_col: str) -> DataFrame:
    """Stored: lang, source, n (kept occurrences of the group), v (kept terms), m (kept occurrences of the language).

    Every group of a language and a source that occurs, with or without terms.
    """
    text = lambda name: F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))
    groups = docs.select(text(lang_col).alias("lang"), text(source_col).alias("source")).distinct()
    sizes = write_shared(kept.groupBy("lang", "source").agg(F.sum("a").alias("n"), F.count_if("first").alias("terms")))
    langs = sizes.groupBy("lang").agg(F.sum("n").alias("m"), F.sum("terms").alias("v"))
    found = groups.join(sizes.drop("terms"), ["lang", "source"], "left").join(langs, "lang", "left")
    return write_shared(found.select("lang", "source", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n", "v", "m")]))


def share(count: np.ndarray, total: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * (count + 2) / (total + 2 * terms)): long division by thousands, exact in longs up to a total of 9e15."""
    size = np.maximum(total + 2 * terms, 1)
    whole, rest = np.divmod(count + 2, size)
    for _ in range(3):
        digit, rest = np.divmod(rest * 1000, size)
        whole = whole * 1000 + digit
    return whole + 1


def apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q))."""
    return (p - q) * (p - q) // (p + q)


def skyband(a: np.ndarray, b: np.ndarray, terms: list[bytes], k: int) -> np.ndarray:
    """Places of the terms with fewer than k dominators: a at least as high, b at most as high, term earlier.

    Dominators are counted among kept terms only: one left out has k dominators that dominate whatever it dominates.
    """
    by_name = sorted(range(len(terms)), key=terms.__getitem__)
    name = np.empty(len(terms), np.int64)
    name[by_name] = np.arange(len(terms))
    kept = np.empty(len(terms), np.int64)
    kept_b, kept_name, size = np.empty_like(kept), np.empty_like(kept), 0
    for at in np.lexsort((name, b, -a)):
        if size < k or np.count_nonzero((kept_b[:size] <= b[at]) & (kept_name[:size] < name[at])) < k:
            kept[size], kept_b[size], kept_name[size] = at, b[at], name[at]
            size += 1
    return kept[:size]


class Skybands:
    """Skybands of many groups in bounded memory: a group is reduced when it has grown, all are handed on when too many."""

    def __init__(self, k: int, group_rows: int = GROUP_ROWS, task_rows: int = TASK_ROWS) -> None:
        self.k, self.group_rows, self.task_rows = k, group_rows, task_rows
        self.rows: dict[tuple, list[tuple]] = defaultdict(list)
        self.limits: dict[tuple, int] = {}
        self.held = 0

    def reduce(self, group: tuple) -> None:
        rows = self.rows[group]
        a, b = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
        self.rows[group] = [rows[i] for i in skyband(a, b, [r[0].encode() for r in rows], self.k)]
        self.held -= len(rows) - len(self.rows[group])
        self.limits[group] = max(self.group_rows, 2 * len(self.rows[group]))

    def add(self, rows: Iterable[tuple]) -> Iterator[tuple]:
        for lang, source, *rest in rows:
            group = (lang, source)
            self.rows[group].append(tuple(rest))
            self.held += 1
            if len(self.rows[group]) > self.limits.get(group, self.group_rows):
                self.reduce(group)
            if self.held > self.task_rows:
                yield from self.drain()

    def drain(self) -> Iterator[tuple]:
        """All skybands; nothing is held afterwards."""
        for group in list(self.rows):
            self.reduce(group)
            yield from ((*group, *row) for row in self.rows.pop(group))
        self.limits.clear()
        self.held = 0


def _skyband_kernel(k: int, choose: bool) -> Callable:
    """Skybands of a partition's terms; ``choose``: of those with p > q, worked out first."""
    columns = ["lang", "source", "term", "a", "b", "f"]
    types = [pa.string()] * 3 + [pa.int64()] * 3

    def batches_of(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(rows), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows[at : at + 10_000]), types)], names=columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Skybands(k)
        for batch in batches:
            if choose:
                a, b, n, v, m = (batch.column(c).to_numpy() for c in ("a", "b", "n", "v", "m"))
                p, q = share(a, n, v), share(b, m, v)
                batch = batch.append_column("f", pa.array(apart(p, q), pa.int64())).filter(pa.array(p > q))
            yield from batches_of(list(held.add(zip(*(batch.column(c).to_pylist() for c in columns)))))
        yield from batches_of(list(held.drain()))

    return run


def strongest_terms(kept: DataFrame, sizes: DataFrame, top: int = TOP) -> DataFrame:
    """lang, source, item, value, rank: the first ``top`` kept terms of each group by f, those with p > q only."""
    schema = "lang string, source string, term string, a bigint, b bigint, f bigint"
    told = kept.select("lang", "source", "term", "a", "b").join(sizes, ["lang", "source"])
    partial = told.mapInArrow(_skyband_kernel(top, choose=True), schema)
    # Merged twice: on shares of a group first, so that one task never gets the skybands of a large group from all partitions.
    for salt in ([F.pmod(F.xxhash64("term"), F.lit(16))], []):
        partial = partial.repartition("lang", "source", *salt).mapInArrow(_skyband_kernel(top, choose=False), schema)
    return ranked(partial.select("lang", "source", F.col("term").alias("item"), F.col("f").alias("value")), top)


def ranked(rows: DataFrame, top: int | None = None) -> DataFrame:
    """Rows with their rank by value, highest first, then by item."""
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    found = rows.withColumn("rank", F.row_number().over(order))
    return found if top is None else found.where(F.col("rank") <= top)


def tile_sums(key: tuple, table: pa.Table) -> pa.Table:
    """One tile: sums of f over its terms for all pairs of a source of the first chunk and one of the second.

    Rows with a term are counts, rows without one name the sources of both chunks. ``present`` is the number of terms
    that have a count in the tile; those without one differ by nothing but the groups' sizes and are added later.
    """
    lang, low, high = key[0].as_py(), key[1].as_py(), key[2].as_py()
    rows = table.to_pydict()
    heads = [i for i, term in enumerate(rows["term"]) if term is None]
    own = {rows["source"][i]: (rows["chunk"][i], rows["n"][i], rows["v"][i]) for i in heads}
    names = list(own)
    number = {s: i for i, s in enumerate(names)}
    chunk, n, v = (np.array([own[s][i] for s in names], np.int64) for i in range(3))
    terms: dict[str, int] = {}
    cells = [(number[s], terms.setdefault(t, len(terms)), a) for s, t, a in zip(rows["source"], rows["term"], rows["a"]) if t is not None]
    counts = np.zeros((len(names), len(terms)), np.int64)
    if cells:
        at, term, a = map(np.array, zip(*cells))
        counts[at, term] = a
    p = share(counts, n[:, None], v[:, None])
    left, right, value = [], [], []
    others = np.flatnonzero(chunk == high)
    for i in np.flatnonzero(chunk == low):
        partners = others if low < high else others[others > i]
        sums = apart(p[i], p[partners]).sum(axis=1)
        for j, total in zip(partners, sums):
            left += [names[i], names[j]]
            right += [names[j], names[i]]
            value += [int(total)] * 2
    return pa.table(
        [pa.array([lang] * len(left), pa.string()), pa.array(left, pa.string()), pa.array(right, pa.string()), pa.array(value, pa.int64()), pa.array([len(terms)] * len(left), pa.int64())],
        names=["lang", "source", "item", "value", "present"],
    )


def source_pairs(kept: DataFrame, sizes: DataFrame, chunk: int = CHUNK, terms: int = TERMS) -> DataFrame:
    """lang, source, item (each other source of the language), value: f summed over all kept terms.

    Sources are dealt into chunks and terms into blocks by hash. A tile is two chunks over one block, so no task holds
    more than about ``2 * chunk * terms`` counts however large a language or a source is; tiles' sums are added up.
    """
    of_lang = sizes.groupBy("lang").agg(F.count(F.lit(1)).alias("sources"), F.max("v").alias("terms"))
    shape = of_lang.select(
        "lang", F.ceil(F.col("sources") / chunk).cast("int").alias("chunks"), F.greatest(F.ceil(F.col("terms") / terms), F.lit(1)).cast("int").alias("blocks")
    )
    heads = sizes.join(shape, "lang").withColumn("chunk", F.pmod(F.xxhash64("source"), F.col("chunks")).cast("int"))
    partners = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other")
    tile = [F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high")]
    of_source = heads.select("*", partners).select(
        "lang", *tile, F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "source", "chunk", "n", "v",
        F.lit(None).cast("string").alias("term"), F.lit(None).cast("bigint").alias("a"),
    )
    counts = kept.select("lang", "source", "term", "a").join(heads, ["lang", "source"])
    of_term = counts.select("*", partners).select(
        "lang", *tile, F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block"), "source", "chunk", "n", "v", "term", "a"
    )
    summed = (
        of_source.unionByName(of_term).groupBy("lang", "low", "high", "block")
        .applyInArrow(tile_sums, "lang string, source string, item string, value bigint, present bigint")
        .groupBy("lang", "source", "item").agg(F.sum("value").alias("value"), F.sum("present").alias("present"))
    )
    none = lambda n: F.lit(1) + F.expr(f"({2 * SCALE} div greatest({n} + 2 * v, 1))")
    own = sizes.select("lang", "source", "v", none("n").alias("p"))
    other = sizes.select("lang", F.col("source").alias("item"), none("n").alias("q"))
    found = summed.join(own, ["lang", "source"]).join(other, ["lang", "item"])
    rest = F.expr("(v - present) * (((p - q) * (p - q)) div (p + q))")
    return found.select("lang", "source", "item", (F.col("value") + rest).alias("value"))


def audit(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", least: int = LEAST_DOCUMENTS, top: int = TOP
) -> DataFrame:
    """lang, source, part (pair, term), item, value, rank for every group of ``docs``.

    Null texts, languages and sources are empty strings. A language without kept terms gives pairs of value 0; one with a
    single source gives none. Repeated rows count each. Equal values are ranked by item in UTF-8. An empty table gives no
    row. Other columns are not read. Counts are exact up to a total of 9e15 occurrences in a language.
    """
    kept = kept_terms(docs, text_col, lang_col, source_col, least)
    sizes = group_sizes(docs, kept, lang_col, source_col)
    part = lambda rows, name: rows.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank")
    return part(ranked(source_pairs(kept, sizes)), "pair").unionByName(part(strongest_terms(kept, sizes, top), "term"))


def op13_divergence(docs: DataFrame) -> DataFrame:
    return audit(docs)
