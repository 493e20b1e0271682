import random
import re
from collections import defaultdict

import pytest
from hypothesis import given
from hypothesis import strategies as st

from kgspark.llm import chat
from tests.llm.brute import sha

PIECES = ["</s>", "<s>", "[INST]", "[/INST]", "<|", "|>", "\\", "<\\|", "<\\\\/s>", "[\\/INST]", "\n", "a", "é", "<", "[", "/", "assistant"]


@given(st.lists(st.sampled_from(PIECES), max_size=12).map("".join))
def test_escape_is_reversible_and_hides_controls(text):
    escaped = chat.escape(text)
    assert chat.unescape(escaped) == text
    assert not re.search(r"<\||</?s>|\[/?INST\]", escaped)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "", "a|>b\n", "rôle"]), st.lists(st.sampled_from(PIECES), max_size=8).map("".join)), max_size=5))
def test_format_round_trip(turns):
    formatted, starts, ends = chat.format_turns(turns)
    assert list(chat.parse_turns(formatted)) == turns
    assert [chat.unescape(formatted[a:b]) for a, b in zip(starts, ends)] == [t for r, t in turns if r == "assistant"]


def expected(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append(((turn is not None, turn or 0), (role is not None, role or ""), (text is not None, text or "")))
    out = []
    for conv, turns in by.items():
        turns = [(r[1], t[1]) for _, r, t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        formatted = chat.format_turns(turns)[0]
        out.append((conv, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), len(formatted)))
    return out


SCHEMA = "conv_id long, turn long, role string, text string"
MINUS_ONE = [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")]


def test_conversations_round_trip(spark, same):
    rng = random.Random(1)
    rows = [(c, t * 3, rng.choice(["user", "assistant", "system", None]), rng.choice(["</s>", "é\\<|x", None, "", "a\nb", "[INST] " * 5]) ) for c in range(12) for t in range(rng.randrange(1, 9))]
    rows += [(3, 0, "user", "tie"), (3, 0, "user", "tie"), (None, 1, "user", "no id"), (None, None, "assistant", "no turn"), (50, None, "assistant", "x" * 300_000)]
    rows += [(77, t, "assistant" if t % 2 else "user", f"t{t}") for t in range(300)]
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, SCHEMA).repartition(3).withColumns({n: F.lit(1) for n in ("node", "leaf", "up", "parent", "formatted", "row")})
    same(chat.op7_chat(df), expected(rows + MINUS_ONE))


def test_empty_table_has_conversation_minus_one(spark, same):
    same(chat.op7_chat(spark.createDataFrame([], SCHEMA)), expected(MINUS_ONE))


MESSAGES = "conv_id long, node long, parent long, role string, text string, score double"


def paths_by_recursion(messages, branches):
    by = defaultdict(dict)
    for conv, node, parent, _, _, score in messages:
        by[conv][node] = (parent, score or 0.0)
    out = set()
    for conv, nodes in by.items():
        inner = {p for p, _ in nodes.values() if p in nodes}
        found = []
        for leaf in nodes:
            path, at, seen = [], leaf, set()
            while at in nodes and at not in seen:
                seen.add(at)
                path.append(at)
                at = nodes[at][0]
            if leaf not in inner and at not in seen:
                found.append((-sum(nodes[x][1] for x in path) / len(path), -len(path), leaf, path))
        for _, _, leaf, path in sorted(found)[:branches]:
            out |= {(conv, leaf, node, up) for up, node in enumerate(path)}
    return out


@pytest.mark.parametrize("branches", [1, 3])
def test_best_branches_of_random_trees(spark, branches):
    rng = random.Random(branches)
    messages = []
    for conv in range(15):
        for node in range(rng.randrange(1, 40)):
            parent = rng.choice([None, 999, rng.randrange(node)]) if node and rng.random() < 0.2 else (node - 1 if node and rng.random() < 0.6 else rng.randrange(node) if node else None)
            messages.append((conv, node, parent, "user", f"{conv}:{node}", rng.choice([None, 0.25, 0.5, 1.0])))
    messages += [(99, 1, 2, "user", "", 1.0), (99, 2, 1, "user", "", 1.0), (99, 3, 2, "user", "", 1.0), (99, 4, None, "user", "root", 1.0)]  # a cycle
    df = spark.createDataFrame(messages, MESSAGES).repartition(4)
    assert {tuple(r) for r in chat.chosen_paths(df, branches).collect()} == paths_by_recursion(messages, branches)
    first = min(r["row"]["leaf"] for r in chat.format_trees(df, branches).where("row.conv_id = 99").collect())
    assert first == 4
