"""Benchmark decontamination: a prefix-filtered join of benchmark windows with documents.

Windows are short word sequences of benchmark items. Each is a set of word shingles, all of which a document must hold
to contain it, so one shingle is a sufficient prefix: the rarest in the corpus. Where a document has a window's prefix
shingle, the shingle's place in the window fixes where the window must start (positional bound) and that it must end
within the document (length bound); what passes is compared word by word.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kgspark.llm.shared import map_text
from kgspark.session import write_shared

#: Window length in words, shingle length in words.
WINDOW, SHINGLE = 13, 5
#: Most words of benchmark windows held by a worker at once; more are searched in further passes over the documents.
BLOCK = 1_000_000
#: A-Z to a-z; other ASCII than letters and digits to a space; the rest as it is.
FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(FOLD).split()


def windows_of(words: list[bytes], window: int) -> Iterator[tuple[bytes, ...]]:
    if words:
        for i in range(max(1, len(words) - window + 1)):
            yield tuple(words[i : i + window])


def benchmark_windows(benchmark: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """Stored: one row per distinct window: words (array), items (sorted distinct ids as strings)."""

    def kernel(texts: list) -> dict[str, list]:
        return {"windows": [[b" ".join(w).decode("utf-8", "replace") for w in dict.fromkeys(windows_of(words_of(t), window))] for t in texts]}

    made = map_text(benchmark, text_col, kernel, "windows array<string>", [id_col])
    made = made.select(F.col("row").getField(id_col).cast("string").alias("item"), F.explode("out.windows").alias("window"))
    return write_shared(made.groupBy("window").agg(F.array_sort(F.collect_set("item")).alias("items")))


def shingles_of(words: tuple | list, size: int) -> list[tuple]:
    """Shingles of a window in order; a shorter window is one shingle."""
    size = min(size, len(words))
    return [tuple(words[i : i + size]) for i in range(len(words) - size + 1)]


def _scan(words: list[bytes], sizes: list[int]) -> Iterator[Iterator[tuple]]:
    """For each shingle size, the document's shingles in order."""
    for size in sizes:
        yield zip(*(words[i:] for i in range(size)))


def shingle_counts(docs: DataFrame, vocabulary: dict, text_col: str) -> dict[int, int]:
    """Occurrences in all documents of each shingle of the vocabulary (shingle to number); summed by Spark."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        sizes = sorted({len(s) for s in known})
        found: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                for shingles in _scan(words_of(text.as_py()), sizes):
                    found.update(filter(None, map(known.get, shingles)))
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.int64()), pa.array(list(found.values()), pa.int64())], names=["shingle", "n"])

    counted = docs.select(F.col(f"`{text_col}`").cast("binary").alias("text")).mapInArrow(run, "shingle bigint, n bigint")
    counts = {r["shingle"]: r["n"] for r in counted.groupBy("shingle").agg(F.sum("n").alias("n")).collect()}  # at most the vocabulary
    shared.unpersist()
    return counts


def prefix_postings(windows: list[tuple[tuple, list[str]]], counts: dict, vocabulary: dict, size: int) -> dict:
    """Rarest shingle of each window to its (offset, window, items): ties go to the first shingle."""
    postings = defaultdict(list)
    for words, items in windows:
        shingles = shingles_of(words, size)
        offset = min(range(len(shingles)), key=lambda i: counts.get(vocabulary[shingles[i]], 0))
        postings[shingles[offset]].append((offset, list(words), items))
    return dict(postings)


def occurrences(words: list[bytes], postings: dict, sizes: list[int]) -> tuple[list[int], list[int], set[str]]:
    """Starts and ends of all windows found in a document, and the items they belong to."""
    starts, ends, items, n = [], [], set(), len(words)
    for shingles in _scan(words, sizes):
        for at, met in enumerate(map(postings.get, shingles)):
            if met:
                for offset, window, owners in met:
                    start = at - offset
                    if start >= 0 and start + len(window) <= n and words[start : start + len(window)] == window:
                        starts.append(start)
                        ends.append(start + len(window))
                        items.update(owners)
    return starts, ends, items




def find_windows(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, text_col: str = "text",
    keep: list[str] | None = None, item_col: str = "item_id", item_text_col: str = "text", block: int = BLOCK,
) -> DataFrame:
    """``row`` (the kept columns), n_words, n_hit, items: the windows of ``benchmark`` found in each row of ``docs``.

    An item of fewer words than a window is one window, an item without words none. Items that share a window are all
    reported; repeated items count once; an item without an id marks words but is not reported. Null texts have no
    words. An empty benchmark hits nothing; an empty table of documents gives no row.

    The benchmark is held in workers in blocks of ``block`` words, a bound that does not depend on its size; each
    further block is one more narrow pass, and the found spans are merged before words are counted. Documents are never
    shuffled.
    """
    spark = docs.sparkSession
    keep = docs.columns if keep is None else keep
    stored = benchmark_windows(benchmark, window, item_col, item_text_col)
    blocks = max(1, -(-stored.count() * window // block))
    fields = "n_words bigint, starts array<bigint>, ends array<bigint>, items array<string>"
    found = None
    for number in range(blocks):
        postings = _block_postings(spark, docs, stored, number, blocks, shingle, text_col)
        sizes = sorted({len(s) for s in postings.value})

        def kernel(texts: list, postings=postings, sizes=sizes) -> dict[str, list]:
            made: dict[str, list] = {"n_words": [], "starts": [], "ends": [], "items": []}
            for text in texts:
                words = words_of(text)
                starts, ends, items = occurrences(words, postings.value, sizes)
                for name, value in zip(made, (len(words), starts, ends, sorted(items))):
                    made[name].append(value)
            return made

        if found is None:
            wanted = keep if text_col in keep or blocks == 1 else [*keep, text_col]
            found = map_text(docs, text_col, kernel, fields, wanted)
        else:
            nested = found.select("row", "out", F.col("row").getField(text_col).alias("text"))
            more = map_text(nested, "text", kernel, fields, ["row", "out"])
            joined = lambda name: F.concat(F.col("row.out").getField(name), F.col("out").getField(name)).alias(name)
            found = more.select(F.col("row.row").alias("row"), F.struct(F.col("out.n_words").alias("n_words"), *map(joined, ("starts", "ends", "items"))).alias("out"))
    spans = F.array_sort(F.arrays_zip("out.starts", "out.ends"))
    zero = F.struct(F.lit(0).cast("bigint").alias("total"), F.lit(0).cast("bigint").alias("reach"))
    n_hit = F.aggregate(
        spans, zero,
        lambda done, s: F.struct(
            (done["total"] + F.greatest(F.lit(0), s["ends"] - F.greatest(s["starts"], done["reach"]))).alias("total"), F.greatest(done["reach"], s["ends"]).alias("reach")
        ),
        lambda done: done["total"],
    )
    return found.select("row", F.col("out.n_words").alias("n_words"), n_hit.alias("n_hit"), F.array_sort(F.array_distinct("out.items")).alias("items"))


def _block_postings(spark: SparkSession, docs: DataFrame, stored: DataFrame, number: int, blocks: int, shingle: int, text_col: str):
    """Broadcast postings of one block of windows; a block's size is bounded."""
    rows = stored.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == number).collect()
    windows = [(tuple(r["window"].encode().split(b" ")), list(r["items"])) for r in sorted(rows, key=lambda r: r["window"])]
    vocabulary: dict = {}
    for words, _ in windows:
        for s in shingles_of(words, shingle):
            vocabulary.setdefault(s, len(vocabulary) + 1)
    counts = shingle_counts(docs, vocabulary, text_col) if vocabulary else {}
    return spark.sparkContext.broadcast(prefix_postings(windows, counts, vocabulary, shingle))


def is_contaminated():
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents that are not contaminated, unchanged."""
    return find_windows(docs, benchmark).where(~is_contaminated()).select("row.*")


def op5_decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return find_windows(docs, benchmark, keep=["doc_id"]).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), is_contaminated().alias("contaminated"),
    )
