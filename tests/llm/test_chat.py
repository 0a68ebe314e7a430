from itertools import product

import pytest

from daytally.llm import chat
from daytally.llm.chat import ASSISTANT, START, STATES, SYSTEM, USER, Costs, Grammar

COSTS = Costs()
GRAMMAR = Grammar.of(COSTS)
FOLLOWS = {(START, SYSTEM), (START, USER), (SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}


def cost_of(roles, states):
    """Of giving the turns these roles, by the rules one by one; None if it cannot be done."""
    total, at = 0, START
    for role, state in zip(roles, states):
        total += 0 if role == state else COSTS.relabel if role else COSTS.name
        if (at, state) in FOLLOWS:
            pass
        elif at == state:
            total += COSTS.merge
        elif state == ASSISTANT:
            total += COSTS.insert
        else:
            return None
        at = state
    return total + COSTS.insert * {ASSISTANT: 0, USER: 1, SYSTEM: 2, START: 2}[at]


def brute(roles):
    """Cost and states of the cheapest repair, of equally cheap ones the first."""
    found = [(c, s) for s in product((1, 2, 3), repeat=len(roles)) if (c := cost_of(roles, s)) is not None]
    return min(found)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5])
def test_all_short_conversations(n):
    for roles in product(STATES, repeat=n):
        _, states = brute(roles)
        assert tuple(GRAMMAR.walk(list(roles), START, GRAMMAR.ending)) == states, roles


def test_stretches_multiply():
    roles = [2, 2, 1, 3, 0, 3, 3, 2, 0, 1, 2]
    whole = GRAMMAR.walk(roles, START, GRAMMAR.ending)
    for cut in range(1, len(roles)):
        m = GRAMMAR.matrix(roles[cut:])
        after = tuple(min(m[a][b] + GRAMMAR.ending[b] for b in STATES) for a in STATES)
        first = GRAMMAR.walk(roles[:cut], START, after)
        assert first + GRAMMAR.walk(roles[cut:], first[-1], GRAMMAR.ending) == whole


def expected(turns):
    """(turn, role, action, text) of the repaired conversation, from its turns (role, text) in order."""
    roles = [chat.role_code(r) for r, _ in turns]
    out, at, number = [], START, -1
    for (_, text), role, state in zip(turns, roles, brute(roles)[1] if len(roles) < 8 else GRAMMAR.walk(roles, START, GRAMMAR.ending)):
        if (at, state) not in FOLLOWS and at != state:
            number += 1
            out.append((number, "user", "insert", ""))
        merged = at == state
        number += not merged
        names = ["relabel"] * (role != state) + ["merge"] * merged
        out.append((number, chat.ROLES[state - 1], " and ".join(names) or "keep", text or ""))
        at = state
    for x in {ASSISTANT: [], USER: ["assistant"], SYSTEM: ["user", "assistant"]}[at]:
        number += 1
        out.append((number, x, "insert", ""))
    return out


def by_conversation(rows):
    found = {}
    for r in sorted(rows.collect(), key=lambda r: r.order):
        assert r.order == len(found.setdefault(r.conv_id, []))
        found[r.conv_id].append(r)
    return found


CASES = {
    1: [("user", "a"), ("assistant", "b")],
    2: [("user", "a"), ("user", "b"), ("assistant", None), ("assistant", "d")],
    3: [("assistant", "a"), ("user", "b")],
    4: [("system", ""), ("assistant", "b"), ("system", "c")],
    5: [(None, "a"), ("tool", "b"), (" Human ", "c"), ("GPT", "d")],
    6: [("system", "only")],
    None: [("user", "null id"), ("bot", "x")],
}


def table(spark, cases, extra=""):
    rows = [(c, i, r, t) for c, turns in cases.items() for i, (r, t) in enumerate(turns)]
    return spark.createDataFrame(rows[::-1], "conv_id long, turn long, role string, text string")


def test_cases_and_rendering(spark):
    got = by_conversation(chat.repair(table(spark, CASES)))
    assert got.keys() == CASES.keys()
    for c, turns in CASES.items():
        assert [(r.turn, r.role, r.action, r.text) for r in got[c]] == expected(turns), c
    assert "".join(r.rendered for r in got[2]) == "<|user|>\na\nb\n<|end|>\n<|assistant|>\n\nd\n<|end|>\n"
    assert "".join(r.rendered for r in got[6]) == "<|user|>\nonly\n<|end|>\n<|assistant|>\n\n<|end|>\n"


def test_a_conversation_over_many_parts(spark):
    """One conversation with nearly all rows, dealt over eight parts; also equal rows."""
    roles = ["user", "assistant", "user", "system", None, "assistant", "assistant"]
    long = [(roles[(i * i + i // 3) % 7], f"t{i}") for i in range(3_000)]
    cases = {0: CASES[1], 1: long, 2: CASES[2]}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = by_conversation(chat.repair(table(spark, cases)))
        equal = spark.createDataFrame([(1, 0, "user", "x")] * 500, "conv_id long, turn long, role string, text string")
        same = by_conversation(chat.repair(equal))
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    for c, turns in cases.items():
        assert [(r.turn, r.role, r.action, r.text) for r in got[c]] == expected(turns), c
    assert "".join(r.rendered for r in got[1]).count("<|end|>") == got[1][-1].turn + 1
    assert [(r.role, r.action) for r in same[1]] == [("user", "keep")] + [("user", "merge")] * 498 + [("assistant", "relabel")]


def test_given_conversations_are_made_legal(spark):
    rows = chat.repair(spark.read.parquet("/root/testdata/sf0.01/conversations.parquet"))
    for turns in by_conversation(rows).values():
        opened = [r.role for i, r in enumerate(turns) if not i or r.turn != turns[i - 1].turn]
        body = opened[1:] if opened[0] == "system" else opened
        assert body == ["user", "assistant"] * (len(body) // 2) and body


def test_no_rows_nulls_and_other_columns(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.repair(none).collect() == []
    odd = spark.createDataFrame(
        [(None, None, None, None, 1), (None, None, None, None, 1), (1, None, "user", "b", 2), (1, 0, "assistant", "c" * 200_000, 2)],
        "conv_id long, turn long, role string, text string, order long",
    )
    got = by_conversation(chat.repair(odd))
    assert [(r.role, r.action) for r in got[None]] == [("user", "relabel"), ("assistant", "relabel")]
    assert [(r.role, r.action, len(r.text)) for r in got[1]] == [("user", "keep", 1), ("assistant", "keep", 200_000)]
