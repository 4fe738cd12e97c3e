"""Quote linking on written conversations, against a plain walk on random ones, and the edge cases."""

import random
import re

import pytest

from viewloom.llm import quotes
from viewloom.llm.quotes import reply_conversations
from viewloom.llm.shared import Staging

SCHEMA = "conv_id long, turn long, role string, text string"


def quote(text, level=1):
    return "\n".join(">" * level + " " + line for line in text.split("\n"))


def test_nested_quotes_link_to_their_authors(spark):
    a = "First thought.\nSecond line here.\n\nAnother paragraph."
    b = f"Ann wrote:\n{quote('first   THOUGHT.')}\nI disagree with that."
    c = f"{quote('Ann wrote:')}\n{quote('First thought.', 2)}\n{quote('I disagree with that.')}\nMe too."
    d = f"{quote('Another paragraph.')}\nYes.\n{quote('nobody said this')}"
    e = "A plain follow-up."
    rows = [(1, i, "user", t) for i, t in enumerate([a, b, c, d, e])] + [(2, 0, "user", "First thought.")]
    got = {(r.conv_id, r.turn): r for r in reply_conversations(spark.createDataFrame(rows, SCHEMA)).collect()}
    one = [got[1, t] for t in range(5)]
    assert [r.reply_to for r in one] == [None, 0, 1, 0, 3]
    assert [r.branch for r in one] == [0, 0, 0, 3, 3]
    assert [(r.n_quotes, r.n_linked) for r in one] == [(0, 0), (1, 1), (3, 2), (2, 1), (0, 0)]
    assert [r.text for r in one[1:]] == ["I disagree with that.", "Me too.", "Yes.", "A plain follow-up."]
    assert got[2, 0].reply_to is None


def preorder(parents):
    children = {}
    for t, p in parents.items():
        children.setdefault(p, []).append(t)
    out, todo = [], [None]
    while todo:
        t = todo.pop()
        if t is not None:
            out.append(t)
        todo += sorted(children.get(t, []), reverse=True)
    return out


@pytest.mark.parametrize("block", [4, 1024])
def test_order_is_a_walk_of_the_reply_tree(spark, monkeypatch, block):
    monkeypatch.setattr(quotes, "BLOCK_TURNS", block)
    rng = random.Random(9)
    rows, parents = [], {}
    for conv in range(12):
        turns = sorted(rng.sample(range(60), rng.randint(1, 25)))
        for i, t in enumerate(turns):
            parent = turns[i - 1] if i else None
            text = f"message {conv} {t}"
            if i and rng.random() < 0.4:
                parent = rng.choice(turns[:i])
                text = f"> message {conv} {parent}\n{text}"
            parents.setdefault(conv, {})[t] = parent
            rows.append((conv, t, "user", text))
    rng.shuffle(rows)
    got = reply_conversations(spark.createDataFrame(rows, SCHEMA).repartition(6)).collect()
    for conv, expected in parents.items():
        own = [r for r in got if r.conv_id == conv]
        assert {r.turn: r.reply_to for r in own} == expected
        assert [r.turn for r in own] == preorder(expected)


def test_edge_cases(spark):
    schema = SCHEMA + ", levels int, message string, path int"
    rows = [
        (1, 0, "u", None),
        (1, 1, "u", ""),
        (1, 1, "u", ""),
        (1, 2, "u", ">\n> >\n>>>"),
        (1, 3, "u", "> later text"),
        (1, 4, "u", "later text"),
        (None, 0, "u", "> x"),
        (1, None, "u", "later text"),
        (7, 5, "u", "long line\n" * 20000 + "> long line"),
    ]
    df = spark.createDataFrame([(*r, 0, "", 0) for r in rows], schema)
    got = reply_conversations(df).collect()
    assert len(got) == len(rows)
    by = {(r.conv_id, r.turn): r for r in got}
    assert by[1, 0].text is None and by[1, 2].text == "" and by[1, 2].n_linked == 0
    assert by[1, 3].reply_to == 2 and by[1, 3].n_linked == 0  # a later message is no origin
    assert by[None, 0].reply_to is None and by[1, None].branch is None
    assert by[7, 5].n_quotes == 1 and not re.search(">", by[7, 5].text)
    assert reply_conversations(df.limit(0)).collect() == []


def test_no_python_in_the_plan(spark):
    df = reply_conversations(spark.createDataFrame([(1, 0, "u", "a"), (1, 1, "u", "> a\nb")], SCHEMA))
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())


def test_deeply_nested_branches_take_few_rounds(spark, monkeypatch):
    deep = 100
    branches = [(1, 0, None, None)] + [(1, 2 * k, 2 * k - 2, 2 * k - 2) for k in range(1, deep + 1)] + [(2, 5, None, None), (2, 9, 6, 5)]
    df = spark.createDataFrame(branches, "conv_id long, branch long, reply_to long, parent_branch long").repartition(4)
    writes, write = [], Staging.write
    monkeypatch.setattr(Staging, "write", lambda self, table, name: writes.append(name) or write(self, table, name))
    got = {(r.conv_id, r.branch): [tuple(s) for s in r.path] for r in quotes._paths(df, Staging(spark, "test")).collect()}
    assert got == {
        **{(1, 2 * k): [(-(2 * j - 2), 2 * j) for j in range(1, k + 1)] for k in range(deep + 1)},
        (2, 5): [],
        (2, 9): [(-6, 9)],
    }
    assert len(writes) <= 9  # the first, and a round for each doubling


def test_a_message_may_quote_within_a_branch_of_a_branch(spark):
    texts = [f"message number {i}" if i % 2 or i == 0 else f"> message number {i - 2}\nmessage number {i}" for i in range(24)]
    rows = [(7, i, "user", text) for i, text in enumerate(texts)]
    got = reply_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    for r in got:
        k = r.turn // 2
        assert r.branch == 2 * k if k else r.branch == 0
        assert [tuple(s) for s in r.path] == [(-(2 * j - 2), 2 * j) for j in range(1, k + 1)]
