"""Quality rules with host verdicts.

Each document is measured and tried against a few rules. Failures are summed by host; a host's rate of failures is shrunk
towards the mean by a beta prior fitted to all hosts (empirical Bayes), so that a few documents do not condemn a host.
The verdict goes back to the documents: on a condemned host, a document that fails any of the softer rules goes too.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kgspark.llm.shared import map_text
from kgspark.session import write_shared

MEASURES = "n_words bigint, word_chars bigint, n_symbols bigint, n_lines bigint, n_dup_lines bigint, n_repeat_words bigint"
SYMBOLS = b"#*$%&|<>"
CONTINUED = bytes(range(0x80, 0xC0))
WINDOW = 5
#: A host whose shrunk rate of failures of any rule reaches this is condemned.
CONDEMNED = 0.5


def repeated_words(words: list, window: int = WINDOW) -> int:
    """Words inside windows that occur more than once, first occurrences included."""
    if len(words) <= window:
        return 0
    shingles = list(zip(*(words[i:] for i in range(window))))
    if len(set(shingles)) == len(shingles):
        return 0
    counts, total, reach = Counter(shingles), 0, 0
    for at, s in enumerate(shingles):
        if counts[s] > 1:
            total += at + window - max(at, reach)
            reach = at + window
    return total


def measure(text: bytes | None) -> tuple[int, ...]:
    """The measures of one text, in the order of MEASURES."""
    text = text or b""
    words = text.split()
    white = len(text) - sum(map(len, words))
    lines = [line for line in text.split(b"\n") if line.split()] if words else []
    return (
        len(words), len(text.translate(None, CONTINUED)) - white, len(text) - len(text.translate(None, SYMBOLS)),
        len(lines), len(lines) - len(set(lines)), repeated_words(words),
    )


def measured(docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``row`` (the kept columns) and ``out`` (MEASURES) of every document; a null text has no words."""
    names = [f.split()[0] for f in MEASURES.split(", ")]
    return map_text(docs, text_col, lambda texts: dict(zip(names, map(list, zip(*map(measure, texts))))), MEASURES, keep)


def rules(m: str = "out") -> dict[str, Column]:
    """True where a document fails. ``base`` settles a document; the others count on condemned hosts only."""
    of = lambda name: F.col(f"{m}.{name}")
    return {
        "base": (of("n_words") < 10) | (100 * of("n_repeat_words") > 20 * of("n_words")),
        "symbols": 10 * of("n_symbols") > of("word_chars"),
        "dup_lines": 10 * of("n_dup_lines") > 3 * of("n_lines"),
        "word_length": (of("word_chars") < 2 * of("n_words")) | (of("word_chars") > 20 * of("n_words")),
    }


def soft_failure(m: str = "out") -> Column:
    return F.array_contains(F.array(*[fails for name, fails in rules(m).items() if name != "base"]), True)


def condemned_hosts(measures: DataFrame, host: Column) -> DataFrame:
    """(host), stored: hosts whose shrunk rate of failures reaches the limit for some rule.

    The prior of a rule is the beta distribution with the mean of all documents and, by moments, the variance of the
    hosts' rates. Documents without a host are in no host.
    """
    names = list(rules())
    counted = measures.select(host.alias("host"), *[fails.cast("bigint").alias(name) for name, fails in rules().items()]).where("host is not null")
    by_host = write_shared(counted.groupBy("host").agg(F.count(F.lit(1)).alias("n"), *[F.sum(name).alias(name) for name in names]))
    rate = lambda name: F.col(name) / F.col("n")
    moments = by_host.agg(
        *[(F.sum(name) / F.sum("n")).alias(f"{name}_mean") for name in names], *[F.var_pop(rate(name)).alias(f"{name}_var") for name in names]
    ).first()
    bad = F.lit(False)
    for name in names:
        mean, spread = moments[f"{name}_mean"] or 0.0, moments[f"{name}_var"] or 0.0
        # weight of the prior, in documents; hosts that do not differ leave the mean alone
        weight = min(max(mean * (1 - mean) / spread - 1, 1.0), 1e6) if spread > 0 else 1e6
        bad = bad | ((F.col(name) + F.lit(mean * weight)) / (F.col("n") + F.lit(weight)) >= CONDEMNED)
    return write_shared(by_host.where(bad).select("host"))


def judge(docs: DataFrame, text_col: str = "text", source_col: str = "source", keep: list[str] | None = None) -> DataFrame:
    """``row`` (the kept columns, the source among them), ``out`` (measures), base_failed, kept: for every row of ``docs``.

    Null and empty texts have no words and fail the base. Rows without a source are judged by their own texts. Repeated
    rows count each. An empty table gives no row. Texts are read twice and never shuffled unless the condemned hosts
    outgrow Spark's limit for broadcasts.
    """
    keep = docs.columns if keep is None else keep
    if text_col in keep:  # large rows: measure again rather than store
        first, again = measured(docs, text_col, [source_col]), measured(docs, text_col, keep)
    else:
        first = again = write_shared(measured(docs, text_col, keep))
    condemned = condemned_hosts(first, F.col("row").getField(source_col))
    found = again.withColumn("own", F.col("row").getField(source_col))
    found = found.join(condemned, F.col("own") == F.col("host"), "left")
    failed = rules()["base"]
    return found.select("row", "out", failed.alias("base_failed"), (~failed & ~(F.col("host").isNotNull() & soft_failure())).alias("kept"))


def passing(docs: DataFrame) -> DataFrame:
    """The documents that are kept, unchanged."""
    return judge(docs).where("kept").select("row.*")


def op8_quality(docs: DataFrame) -> DataFrame:
    return judge(docs, keep=["doc_id", "source"]).select(
        "row.doc_id", "out.n_words", "out.word_chars", "out.n_symbols", "out.n_dup_lines", "out.n_repeat_words", "base_failed", "kept"
    )
