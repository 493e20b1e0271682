"""Secret scans over a trigram inverted index, with DataFrame functions only.

Each rule's expression yields a Boolean trigram query. The index lists, for every trigram of these queries, the
documents that hold it (letters folded). A rule's candidates are the intersection of its postings; its expression runs
on candidates alone. A rule without a mandatory trigram runs on every document.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kgspark.llm.trigrams import trigram_query
from kgspark.session import write_shared


@dataclass(frozen=True)
class Rule:
    """``pattern``: no look-around that depends on text consumed before; ``group`` must have ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: Fixed values. The first three are the base; order settles ties.
RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
)
BASE = tuple(rule.kind for rule in RULES[:3])


def queries_of(rules: tuple[Rule, ...]) -> dict[int, list[list[str]]]:
    """Rule number to its alternatives of trigrams, for the rules that have mandatory ones."""
    found = {i: trigram_query(rule.pattern) for i, rule in enumerate(rules)}
    return {i: [sorted(a) for a in query] for i, query in found.items() if query is not None}


def trigram_index(docs: DataFrame, vocabulary: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The inverted index, stored: (trigram, doc_id) for each trigram of ``vocabulary`` in a document's folded text."""
    folded = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.lower(F.col(f"`{text_col}`")).alias("folded"))
    held = F.array_compact(F.array(*[F.when(F.contains("folded", F.lit(t)), F.lit(t)) for t in vocabulary]))
    return write_shared(folded.select(F.explode(held).alias("trigram"), "doc_id"))


def candidates(index: DataFrame, queries: dict[int, list[list[str]]]) -> DataFrame:
    """(id, mask), stored: documents that satisfy a rule's query; bit i of the mask stands for rule i.

    Postings are intersected as bit sets: a document satisfies an alternative when the bits of its trigrams are full.
    """
    terms = [
        (rule, number, t, 1 << place, (1 << len(alternative)) - 1)
        for rule, alternatives in queries.items() for number, alternative in enumerate(alternatives) for place, t in enumerate(alternative)
    ]
    terms = index.sparkSession.createDataFrame(terms, "rule int, alternative int, trigram string, bit long, full long")
    met = index.join(terms, "trigram").groupBy("doc_id", "rule", "alternative").agg(F.bit_or("bit").alias("held"), F.first("full").alias("full"))
    met = met.where("held = full").groupBy("doc_id").agg(F.bit_or(F.expr("shiftleft(1L, rule)")).alias("mask"))
    return write_shared(met.withColumnRenamed("doc_id", "id"))


def _spans(text: Column, matches: Column, values: Column, place: int, rule: Rule) -> Column:
    """Array of (start, place, end, kind) of the matches whose value is long enough.

    Pieces between matches come from splitting at the same expression, so running sums of lengths give the offsets.
    """
    none = F.array().cast("array<struct<start:bigint,place:int,end:bigint,kind:string>>")
    pieces = F.split(text, rule.pattern, -1)
    steps = F.arrays_zip(
        F.transform(F.slice(pieces, 1, F.size(matches)), lambda p: F.length(p).cast("bigint")).alias("gap"),
        F.transform(matches, lambda m: F.length(m).cast("bigint")).alias("size"),
        F.transform(values, lambda v: F.length(v).cast("bigint")).alias("value"),
    )
    start = F.struct(F.lit(0).cast("bigint").alias("at"), none.alias("spans"))

    def step(done: Column, x: Column) -> Column:
        begin = done["at"] + x["gap"]
        end = begin + x["size"]
        span = F.struct(begin.alias("start"), F.lit(place).alias("place"), end.alias("end"), F.lit(rule.kind).alias("kind"))
        return F.struct(end.alias("at"), F.when(x["value"] >= rule.least, F.concat(done["spans"], F.array(span))).otherwise(done["spans"]).alias("spans"))

    return F.when(F.size(matches) > 0, F.aggregate(steps, start, step, lambda done: done["spans"])).otherwise(none)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES, keep: list[str] | None = None) -> DataFrame:
    """``row`` (the kept columns) and ``spans``: sorted array of (start, place, end, kind), code points, end exclusive.

    One row per row of ``docs``. A null text counts as empty; a document without an id cannot be in the index, so all
    rules run on it; rows that repeat an id are all tried if one of them is a candidate. An empty table gives no row.
    The join with the candidates is by id; Spark broadcasts them if their stored size allows, else it sorts and merges.
    """
    queries = queries_of(rules)
    vocabulary = sorted({t for alternatives in queries.values() for a in alternatives for t in a})
    names = docs.columns if keep is None else keep
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), F.col(f"`{id_col}`").alias("key"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("body")
    )
    mask: Column = F.lit(0).cast("bigint")
    if vocabulary:
        found = candidates(trigram_index(docs, vocabulary, id_col, text_col), queries)
        rows = rows.join(found, F.col("key") == F.col("id"), "left")
        mask = F.coalesce("mask", F.when(F.col("key").isNull(), F.lit((1 << len(rules)) - 1)).otherwise(F.lit(0)).cast("bigint"))
    empty = F.array().cast("array<string>")

    def tried(i: int, group: int) -> Column:
        hits = F.regexp_extract_all("body", F.lit(rules[i].pattern), F.lit(group))
        return F.when(F.col("mask").bitwiseAND(F.lit(1 << i).cast("bigint")) != 0, hits).otherwise(empty) if i in queries else hits

    rows = rows.select("row", "body", mask.alias("mask"))
    rows = rows.select("row", "body", "mask", *[tried(i, 0).alias(f"m{i}") for i in range(len(rules))])
    values = [
        (F.when(F.size(f"m{i}") > 0, F.regexp_extract_all("body", F.lit(r.pattern), F.lit(r.group))).otherwise(empty) if r.group else F.col(f"m{i}")).alias(f"v{i}")
        for i, r in enumerate(rules)
    ]
    rows = rows.select("row", "body", *[f"m{i}" for i in range(len(rules))], *values)
    spans = [_spans(F.col("body"), F.col(f"m{i}"), F.col(f"v{i}"), i, r) for i, r in enumerate(rules)]
    return rows.select("row", "body", F.array_sort(F.concat(*spans)).alias("spans"))


def redacted(body: Column, spans: Column) -> Column:
    """``body`` with each union of overlapping spans replaced by the kind that starts it, in brackets."""
    state = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(done: Column, s: Column) -> Column:
        gap = F.substring(body, (done["at"] + 1).cast("int"), (s["start"] - done["at"]).cast("int"))
        fresh = F.concat(done["parts"], F.array(gap, F.concat(F.lit("["), s["kind"], F.lit("]"))))
        return F.struct(
            F.greatest(done["at"], s["end"]).alias("at"),
            F.when(s["start"] >= done["at"], fresh).otherwise(done["parts"]).alias("parts"),
        )

    end = lambda done: F.concat(F.array_join(done["parts"], ""), F.substring(body, (done["at"] + 1).cast("int"), F.length(body)))
    return F.when(F.size(spans) > 0, F.aggregate(spans, state, step, end)).otherwise(body)


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every secret replaced by its kind in brackets; other columns, and null texts, stay."""
    found = scan_secrets(docs, id_col, text_col)
    text = F.col("row").getField(text_col)
    return found.select(
        *[
            (F.when(text.isNotNull(), redacted(F.col("body"), F.col("spans"))) if c == text_col else F.col("row").getField(c)).alias(c)
            for c in docs.columns
        ]
    )


def op3_secrets(docs: DataFrame) -> DataFrame:
    found = scan_secrets(docs, keep=["doc_id"]).select(F.col("row.doc_id").alias("doc_id"), "spans")
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    of = lambda kind: F.filter("spans", lambda s: s["kind"] == kind)
    return found.select(
        "doc_id", *[F.size(of(kind)).cast("bigint").alias(f"n_{kind}") for kind in BASE],
        F.sha2(text(F.filter("spans", lambda s: s["kind"].isin(*BASE))), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
    )
