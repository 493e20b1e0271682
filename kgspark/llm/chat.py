"""Chat formatting of reply trees: one training conversation per chosen root-to-leaf path.

Paths are found by self-joins that double their reach: after round k every message knows its ancestor 2^k steps up and
the score of the steps between, so a tree of depth d takes log2(d) rounds and no list of all ancestors is ever made.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce
from urllib.parse import quote, unquote

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kgspark.llm.shared import map_text
from kgspark.session import write_shared

# ---------------------------------------------------------------- template

#: Control strings of the template and of common others: none of them survives inside an escaped text.
OPENERS = re.compile(r"([<\[])(\\*)(?=\||/?s>|/?INST\])")
ESCAPED = re.compile(r"([<\[])\\(\\*)(?=\||/?s>|/?INST\])")
TURN = re.compile(r"<\|([^|]*)\|>\n(.*?)</s>\n", re.DOTALL)
LEARNED = "assistant"


def escape(text: str) -> str:
    """One backslash more between the first character of a control string and its rest."""
    return OPENERS.sub(r"\1\\\2", text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1\2", text)


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[int], list[int]]:
    """The formatted conversation, and where its loss mask starts and ends (code points; the escaped assistant texts)."""
    parts, starts, ends, at = [], [], [], 0
    for role, text in turns:
        head, body = f"<|{quote(role, safe='')}|>\n", escape(text)
        if role == LEARNED:
            starts.append(at + len(head))
            ends.append(at + len(head) + len(body))
        parts += [head, body, "</s>\n"]
        at += len(head) + len(body) + 5
    return "".join(parts), starts, ends


def parse_turns(formatted: str) -> Iterator[tuple[str, str]]:
    """The turns of a formatted conversation."""
    for m in TURN.finditer(formatted):
        yield unquote(m[1]), unescape(m[2])


# ---------------------------------------------------------------- trees


def chosen_paths(messages: DataFrame, branches: int = 1) -> DataFrame:
    """(conv_id, leaf, node, up): the messages of the ``branches`` best root-to-leaf paths of each conversation.

    ``messages``: conv_id, node (unique within a conversation), parent, score. A path scores the mean of its messages;
    ties go to the longer path, then to the smaller leaf. A parent that does not exist counts as none, a null score as
    0. Messages on or below a cycle reach no root and lie on no path. ``up``: steps from the leaf.
    """
    same = lambda a, b: F.col(f"{a}.conv_id").eqNullSafe(F.col(f"{b}.conv_id"))
    base = write_shared(messages.select("conv_id", "node", "parent", F.coalesce("score", F.lit(0.0)).cast("double").alias("score")))
    names = base.select("conv_id", "node")
    state = write_shared(
        base.alias("a").join(names.alias("b"), same("a", "b") & (F.col("a.parent") == F.col("b.node")), "left")
        .select("a.conv_id", "a.node", F.col("b.node").alias("up"), F.col("a.score").alias("total"), F.lit(1).cast("bigint").alias("length"))
    )
    parents = state.where("up is not null").select("conv_id", F.col("up").alias("node")).distinct()
    jumps, done = [], []
    for _ in range(base.count().bit_length()):
        # Conversations all of whose messages have reached their root are settled; the others go on.
        open_ = write_shared(state.where("up is not null").select("conv_id").distinct())
        if open_.isEmpty():
            break
        held = state.alias("a").join(open_.alias("b"), same("a", "b"), "left_anti")
        done.append(held)
        state = write_shared(state.alias("a").join(open_.alias("b"), same("a", "b"), "left_semi"))
        jumps.append(state)
        state = write_shared(
            state.alias("a").join(state.alias("b"), same("a", "b") & (F.col("a.up") == F.col("b.node")), "left").select(
                "a.conv_id", "a.node", F.col("b.up").alias("up"), (F.col("a.total") + F.coalesce("b.total", F.lit(0.0))).alias("total"),
                (F.col("a.length") + F.coalesce("b.length", F.lit(0))).alias("length"),
            )
        )
    rooted = reduce(DataFrame.unionByName, [*done, state]).where("up is null").alias("a")
    leaves = rooted.join(parents.alias("b"), same("a", "b") & (F.col("a.node") == F.col("b.node")), "left_anti")
    order = Window.partitionBy("conv_id").orderBy(F.desc(F.col("total") / F.col("length")), F.desc("length"), "node")
    best = leaves.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= branches)
    paths = write_shared(best.select("conv_id", F.col("node").alias("leaf"), "node", F.lit(0).cast("bigint").alias("up")))
    for k, jump in enumerate(jumps):
        # Ancestors 2^k steps above those found so far: the distances so far are 0 to 2^k - 1, the new ones follow on.
        nodes = jump.where("up is not null").select("conv_id", "node", F.col("up").alias("above"))
        met = paths.alias("a").join(nodes.alias("b"), same("a", "b") & (F.col("a.node") == F.col("b.node")))
        above = met.select("a.conv_id", "a.leaf", F.col("b.above").alias("node"), (F.col("a.up") + (1 << k)).alias("up"))
        paths = paths.unionByName(write_shared(above))
    return paths


def format_trees(messages: DataFrame, branches: int = 1) -> DataFrame:
    """One row per chosen path: row (conv_id, leaf), out (formatted, starts, ends).

    ``messages``: conv_id, node, parent, role, text, score. Null roles and texts are empty. A conversation is one row of
    the result, so its messages meet in one task; nothing larger does. An empty table gives no row.
    """
    paths = chosen_paths(messages, branches)
    texts = messages.select("conv_id", "node", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    turns = paths.alias("a").join(texts.alias("b"), F.col("a.conv_id").eqNullSafe(F.col("b.conv_id")) & (F.col("a.node") == F.col("b.node")))
    turns = turns.select("a.conv_id", "a.leaf", F.struct((-F.col("a.up")).alias("at"), F.col("b.role").alias("role"), F.col("b.text").alias("text")).alias("turn"))
    held = turns.groupBy("conv_id", "leaf").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    # Roles and texts travel as one JSON text, which keeps the kernel's input a single column.
    held = held.select("conv_id", "leaf", F.to_json(F.transform("turns", lambda t: F.array(t["role"], t["text"]))).alias("turns"))
    return map_text(held, "turns", _formatted, "formatted string, starts array<bigint>, ends array<bigint>", ["conv_id", "leaf"])


def _formatted(batch: list) -> dict[str, list]:
    import json

    made = [format_turns([tuple(t) for t in json.loads(x)]) for x in batch]
    return {"formatted": [m[0] for m in made], "starts": [m[1] for m in made], "ends": [m[2] for m in made]}


def as_messages(conversations: DataFrame) -> DataFrame:
    """Conversation rows as messages: by turn, each replies to the one before; equal turns in order of role and text."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    node = F.row_number().over(order).cast("bigint")
    numbered = conversations.select("conv_id", "role", "text", node.alias("node"))
    return numbered.withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1)).withColumn("score", F.lit(0.0))


def op7_chat(conversations: DataFrame) -> DataFrame:
    spark = conversations.sparkSession
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = conversations.select("conv_id", "turn", "role", "text").unionByName(extra)
    made = format_trees(write_shared(as_messages(rows)))
    made = made.select(F.struct("row.conv_id", "out.starts", "out.ends").alias("kept"), F.col("out.formatted").alias("formatted"))
    made = made.select(F.to_json(F.struct("formatted", "kept.starts", "kept.ends")).alias("output"), F.col("kept.conv_id").alias("conv_id"))

    def read_back(batch: list) -> dict[str, list]:
        import json

        columns: dict[str, list] = {k: [] for k in ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")}
        for output in batch:
            output = json.loads(output)
            formatted, digest, n = output["formatted"], hashlib.sha256(), 0
            for role, text in parse_turns(formatted):
                digest.update(f"{role}\n{text}\n".encode())
                n += 1
            learned = "".join(unescape(formatted[a:b]) for a, b in zip(output["starts"], output["ends"]))
            loss = hashlib.sha256(learned.encode()).hexdigest()
            for column, value in zip(columns.values(), (n, digest.hexdigest(), len(learned), loss, len(formatted))):
                column.append(value)
        return columns

    back = map_text(made, "output", read_back, "n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint", ["conv_id"])
    return back.select("row.conv_id", "out.*")
