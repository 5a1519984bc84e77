import random
import re
from collections import defaultdict

import pytest
from fixtures import clashing

from eventide.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
RULES = chat.Automaton()


def brute(roles):
    best = {0: 0.0}
    for role in roles:
        step = RULES.step(chat.role_number(role))
        best = {q: min(c + step[p, q] for p, c in best.items()) for q in (1, 2, 3)}
    return min(c + RULES.finish[p] for p, c in best.items())


@pytest.fixture
def cut(spark):
    """Many small parts, so that long conversations reach over cuts."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_least_cost_and_legal(spark, cut):
    rng = random.Random(3)
    roles = ["user", "assistant", "system", None, "GPT", "odd"]
    data = [(7, i, rng.choice(roles), f"t{i}") for i in range(800)]
    data += [(c, i, rng.choice(roles[:4]), f"{c}-{i}") for c in range(10, 90) for i in range(rng.randrange(1, 7))]
    df = clashing(spark.createDataFrame(data, SCHEMA).repartition(4))
    by, given = defaultdict(list), defaultdict(list)
    for r in chat.format_turns(df).collect():
        by[r.conv_id].append(r)
    for c, turn, role, text in data:
        given[c].append((turn, role, text))
    assert by.keys() == given.keys()
    for c, turns in by.items():
        turns.sort(key=lambda r: r.seq)
        assert [r.seq for r in turns] == list(range(len(given[c])))
        assert sum(r.cost for r in turns) == pytest.approx(brute([r for _, r, _ in given[c]]))
        text = "".join(r.piece for r in turns)
        seen = re.findall(r"<\|(system|user|assistant)\|>", text)
        assert all(pair in chat.LEGAL for pair in zip(["start", *seen], seen)) and seen[-1] in chat.ENDS
        assert text.count("<|end|>") == len(seen)
        assert [t for t in re.findall(r"[\d-]*\d|t\d+", text) if t] == [t for _, _, t in given[c]]


def test_parts_of_any_size_give_the_same(spark):
    rng = random.Random(9)
    data = [(rng.choice([1, 2, 2, 2, None]), i, rng.choice(["user", "assistant", "system", None]), "é" * rng.randrange(300))
            for i in range(300)] + [(2, 300, "user", "long " * 20_000), (3, 0, None, None)]
    df = spark.createDataFrame(data, SCHEMA)
    want = sorted(map(str, chat.format_turns(df).collect()))
    for size in (1, 500, 20_000):
        assert sorted(map(str, chat.format_turns(df, part_bytes=size).collect())) == want
    ranged = chat._sorted_parts(df, "conv_id", "turn", "role", "text", 2000).toPandas()
    ends = [rows.text.fillna("").str.encode("utf-8").str.len().sum() for _, rows in ranged.groupby("part")]
    assert len(ends) > 30 and sorted(ends)[-2] <= 2000 + 600


def test_repairs(spark):
    data = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c"), (2, 0, "assistant", "x"),
            (3, 0, "system", "s"), (None, None, None, None), (4, 0, "user", "same"), (4, 0, "user", "same")]
    got = {}
    for r in chat.format_turns(spark.createDataFrame(data, SCHEMA)).orderBy("conv_id", "seq").collect():
        got.setdefault(r.conv_id, []).append((r.new_role, r.action, r.piece))
    assert got[1] == [("user", "keep", "<|user|>\na"), ("user", "merge", "\nb"),
                      ("assistant", "keep", "<|end|>\n<|assistant|>\nc<|end|>\n")]
    assert got[2] == [("user", "relabel", "<|user|>\nx<|end|>\n")]
    assert got[3] == [("user", "relabel", "<|user|>\ns<|end|>\n")]
    assert got[None] == [("user", "relabel", "<|user|>\n<|end|>\n")]
    assert [a for _, a, _ in got[4]] == ["keep", "merge"]


def test_empty(spark):
    assert chat.format_turns(spark.createDataFrame([], SCHEMA)).collect() == []
