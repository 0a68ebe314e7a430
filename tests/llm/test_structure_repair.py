import hashlib
import random
import zlib

import pytest

from daytally.llm import structure_repair
from daytally.llm.structure_repair import damaged, digests, edits, placed, repaired_rows, reports
from helpers import rows

SF = "/root/testdata/sf0.001"
COLUMNS = "conv_id long, turn long, role string, text string"
BLANKS = " \t\n\x0b\f\r"


def sound(initials: str) -> bool:
    rest = initials[1:] if initials[:1] == "s" else initials
    return initials == "" or (len(rest) > 0 and rest == "ua" * (len(rest) // 2))


def cheapest(kinds):
    """The least cost, letters and initials of all edits that do not cost more than to delete every row."""
    best = (2 * len(kinds), "D" * len(kinds), "")

    def go(i, cost, letters, initials):
        nonlocal best
        open_ = initials.removeprefix("s")
        if cost > best[0] or open_ != ("ua" * len(open_))[: len(open_)]:
            return
        if i == len(kinds) and sound(initials):
            best = min(best, (cost, letters, initials))
        for x in "ua":
            go(i, cost + 5, letters + "I", initials + x)
        if i < len(kinds):
            initial, truncated = kinds[i]
            go(i + 1, cost + 2, letters + "D", initials)
            if initial is not None:
                more = 5 if truncated else 0
                go(i + 1, cost + more, letters + "K", initials + initial)
                for x in "ua":
                    go(i + 1, cost + more + 1, letters + "R", initials + x)

    go(0, 0, "", "")
    return best


def by_brute_force(conversation):
    """conversation: (turn, role, text) in order. Figures of the report, without the id."""
    seen, kinds, faults = set(), [], []
    for _, role, text in conversation:
        body = text.rstrip(BLANKS)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated"
        seen.add((role, text))
        faults.append(fault)
        kinds.append((None if fault in ("blank", "duplicate") else role[:1], fault == "truncated"))
    turns = {t for t, _, _ in conversation if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(conversation, conversation[1:]))
    cost, letters, initials = cheapest(kinds)
    made, at, place = [], 0, 0
    for letter in letters:
        if letter == "D":
            at += 1
            continue
        role = {"s": "system", "u": "user", "a": "assistant"}[initials[place]]
        text = ""
        if letter != "I":
            role, text = (conversation[at][1] if letter == "K" else role), conversation[at][2]
            at += 1
        made.append(f"{role}:{text}")
        place += 1
    digest = hashlib.sha256("\n".join(made).encode()).hexdigest()
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *counts, illegal, cost, letters, digest)


def damage(table):
    """The contract in plain Python; conversations by id, in order."""
    found = {}
    for conv, turn, role, text in table:
        found.setdefault(conv, [])
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if code == 0:
            continue
        if code == 1:
            text = ""
        if code == 2:
            text = "".join(c for c in text if c not in ".!?")
        found[conv] += [(turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
    order = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
    return {conv: sorted(c, key=order) for conv, c in found.items()}


@pytest.fixture
def many_parts(spark):
    """Conversations are cut into parts of a few rows."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    yield
    spark.conf.set(key, before)
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def random_table(seed: int, conversations: int, longest: int):
    rng = random.Random(seed)
    table = []
    for conv in range(conversations):
        for turn in range(rng.randint(1, longest)):
            role = rng.choice(["system", "user", "assistant", "user", "assistant", "tool", None])
            text = rng.choice([f"Fine {rng.randint(0, 3)}.", "cut off", " \t", "", "Yes!", "Why? \n", None, f"{turn}."])
            table.append((conv, rng.choice([turn, turn, turn, turn + 2, None]), role, text))
    return table


def expected(table):
    return sorted(((c, *by_brute_force(rs)) for c, rs in damage(table).items()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_all_repairs_of_short_conversations(spark, seed):
    table = random_table(seed, 60, 4)
    got = digests(spark.createDataFrame(table, COLUMNS))
    columns = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert got.columns == columns
    assert rows(got) == expected(table)


def test_conversations_over_several_parts(spark, many_parts, monkeypatch):
    table = random_table(3, 9, 5)
    docs = spark.createDataFrame(table, COLUMNS).repartition(3)
    assert placed(damaged(docs)).select("part").distinct().count() > 6
    assert rows(digests(docs)) == expected(table)
    monkeypatch.setattr(structure_repair, "CHUNK", 5)
    assert rows(digests(docs)) == expected(table)


def plain_edits(kinds):
    """Letters by a table of best strings from the end; no checkpoints."""
    follow = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    other = {"": "u", "s": "u", "u": "a", "a": "u"}
    best = {s: (0, "") if s in ("", "a") else None for s in follow}

    def with_inserts(v):
        for _ in range(3):
            v = {s: min(x for x in (v[s], (5 + v[other[s]][0], "I" + v[other[s]][1]) if v[other[s]] else None) if x) for s in v if any((v[s], v[other[s]]))} | {
                s: None for s in v if not any((v[s], v[other[s]]))
            }
        return v

    best = with_inserts(best)
    for initial, truncated in reversed(kinds):
        more, new = 5 if truncated else 0, {}
        for s in follow:
            ways = [(2 + best[s][0], "D" + best[s][1])]
            if initial is not None:
                to = other[s]
                ways.append((1 + more + best[to][0], "R" + best[to][1]))
                if initial in follow[s]:
                    to = follow[s][initial]
                    ways.append((more + best[to][0], "K" + best[to][1]))
            new[s] = min(ways)
        best = with_inserts(new)
    return best[""]


def test_checkpoints_against_whole_tables():
    rng = random.Random(5)
    for n in (0, 1, 2, 3, 5, 9, 10, 50, 121, 400):
        kinds = [(rng.choice(["s", "u", "a", "u", "a", "t", None]), rng.random() < 0.2) for _ in range(n)]
        assert "".join(e for e, _, _ in edits(kinds)) == plain_edits(kinds)[1]


def test_a_long_conversation(spark, many_parts):
    rng = random.Random(7)
    table = [(1, t, rng.choice(["user", "assistant", "assistant"]), f"Text {rng.randint(0, 300)}" + rng.choice([".", ""])) for t in range(800)]
    table += [(2, 1, "user", "Hello.")]
    got = {r["conv_id"]: r for r in digests(spark.createDataFrame(table, COLUMNS)).collect()}
    damaged_rows = damage(table)[1]
    seen, kinds = set(), []
    for _, role, text in damaged_rows:
        blank, copy = not text.strip(BLANKS), (role, text) in seen
        seen.add((role, text))
        kinds.append((None if blank or copy else role[:1], not blank and not copy and text[-1] not in ".!?"))
    cost, letters = plain_edits(kinds)
    assert (got[1]["cost"], got[1]["audit"]) == (cost, letters)


def test_given_conversations_keep_every_id(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    got = digests(table)
    ids = sorted(r[0] for r in got.select("conv_id").collect())
    assert ids == sorted(r[0] for r in table.select("conv_id").distinct().collect())
    short = {c: rs for c, rs in damage([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]).items() if len(rs) < 5}
    figures = {r[0]: tuple(r) for r in got.collect()}
    assert short and all(figures[c] == (c, *by_brute_force(rs)) for c, rs in short.items())


def test_edge_cases(spark):
    long = "word " * 60_000 + "."
    table = [
        (None, None, None, None),
        (None, 1, "user", "Hi."),
        (None, 1, "user", "Hi."),
        (5, 1, "user", long),
        (5, 2, "assistant", "Ok."),
        (6, None, "user", ""),
        (7, 1, "", "Text."),
        (8, 3, "user", "Again."),
        (8, 3, "user", "Again."),
        (8, 9, "assistant", "So."),
    ]
    table += [(c, 1, "user", "One row.") for c in range(100, 160)]  # some of them are dropped whole
    assert any(not rs for rs in damage(table).values())
    wide = spark.createDataFrame([(*r, "x", 1, True) for r in table], f"{COLUMNS}, audit string, part int, times boolean")
    assert rows(digests(wide)) == expected(table)
    assert digests(spark.createDataFrame([], COLUMNS)).collect() == []


def test_repaired_rows_are_sound(spark):
    table = random_table(9, 30, 5)
    got = repaired_rows(spark.createDataFrame(table, COLUMNS)).collect()
    by_conv = {}
    for r in sorted(got, key=lambda r: (r["part"], r["n"])):
        by_conv.setdefault(r["conv_id"], []).append(r)
    assert len(by_conv) == len({r[0] for r in table})
    assert all(sound("".join(r["role"][:1] for r in rs if r["edit"] != "D")) for rs in by_conv.values())


def test_reports_take_rows_with_a_number_of_times(spark):
    docs = spark.createDataFrame([(1, 1, "user", "A.", 3), (1, 2, "assistant", "B.", 1)], f"{COLUMNS}, times long")
    one = reports(docs).first()
    assert (one["duplicate"], one["audit"], one["cost"], one["illegal"]) == (2, "KDDK", 4, 2)
