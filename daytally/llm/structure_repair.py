"""Conversation structure repair: faults are found, and the cheapest edits that mend them.

Roles of a sound conversation go ``s?(ua)+`` by their initials, or there is no row at all. Rows are kept, reroled to user
or assistant, or deleted, and empty rows can be inserted; blank and duplicate rows have to be deleted. A state says what
the rows so far allow: nothing yet, after the system row, after a user, after an assistant. The cost of the best rest from
each state, a backward vector, is found from the last row to the first. Only every square-root-th vector is stored; going
forward, those between two of them are made again from the later one, and the edit of each row is the ASCII-least of
those that are tight, that is, whose cost and rest add up to the vector's entry.

A conversation may hold any share of all rows, so none is gathered as a whole. Equal rows are counted before any shuffle.
Rows are range-partitioned by conversation and turn; a part holds many short conversations, or a stretch of a long one,
whose checkpoints then begin at the part's end: the driver gets a 4 x 4 matrix of costs for the first and last
conversation of each part, and tells each part the vector after it and the state before it. What it holds goes with the
number of parts. Only a conversation that lies in several parts is put together from its stretches' edits, as a stream in
their order, as the digest of its text can be made in no other way.

Cases: a null role or text is one space. Null turns come first; rows of one turn go by role, the first 100 characters of
their text, and its hash. Rows without a conversation id are one conversation. Equal rows are duplicates of the first.
A role's initial is its first character; other initials than s, u and a cannot be kept. An empty table gives no rows.
Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daytally.llm.common import BLANKS, written

EMPTY, SYSTEM, USER, ASSISTANT = STATES = range(4)
FAR = 1 << 40
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
# The state after a row that is made a user or assistant; which of them, the state before says.
TURNED = (USER, USER, ASSISTANT, USER)
KEPT = {"s": {EMPTY: SYSTEM}, "u": {EMPTY: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
LEGAL = {"su", "ua", "au"}
NAMES = {USER: "user", ASSISTANT: "assistant"}
CHUNK = 1 << 20

Vector = tuple[int, int, int, int]
# What the edits of a row depend on: its initial, or None if it has to go; whether it is truncated.
Kind = tuple[str | None, bool]


# Damage, as the contract of the query has it


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows with ``times``, and a row with none of each conversation that lost one.

    crc32 of "conv_id:turn", modulo 20: 0 drops the row, 1 empties its text, 2 removes its full stops, exclamation and
    question marks, 3 repeats it, 4 makes it the user's.
    """
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    code = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    gone = code == 0
    return conversations.select(
        "conv_id",
        F.when(~gone, F.col("turn")).alias("turn"),
        F.when(gone, "").when(code == 4, "user").otherwise(role).alias("role"),
        F.when(gone | (code == 1), "").when(code == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(gone, 0).when(code == 3, 2).otherwise(1).cast("long").alias("times"),
    )


# Faults


def with_faults(rows: DataFrame) -> DataFrame:
    """Different rows with ``times``, and of the first of each kind: blank, duplicate (of an earlier turn), truncated."""
    conv = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    counted = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("times").alias("times"))
    body: Column = F.rtrim(F.col("text"), F.lit(BLANKS))
    counted = counted.select(
        conv.alias("conv"),
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        "role",
        "text",
        "times",
        F.unhex(F.md5(F.concat(F.length("role"), F.lit(":"), "role", "text"))).alias("hash"),
        (F.length(body) == 0).alias("blank"),
        (~F.right(body, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
    )
    again = (
        counted.filter("times > 0")
        .groupBy("conv", "hash")
        .agg(F.count("*").alias("n"), F.bool_or(F.col("turn").isNull()).alias("at_null"), F.min("turn").alias("least"))
        .filter("n > 1")
        .drop("n")
    )
    earlier = F.col("turn").isNotNull() & (F.col("at_null") | (F.col("least") < F.col("turn")))
    return (
        counted.join(again, ["conv", "hash"], "left")
        .withColumn("seen", F.coalesce(earlier, F.lit(False)))
        .drop("at_null", "least")
    )


# Edits


def closed(v: list[int]) -> Vector:
    """The vector when empty rows may be inserted first."""
    user, assistant = min(v[USER], INSERT + v[ASSISTANT]), min(v[ASSISTANT], INSERT + v[USER])
    return min(v[EMPTY], INSERT + user), min(v[SYSTEM], INSERT + user), user, assistant


END = closed([0, FAR, FAR, 0])


def before(kind: Kind, after: Vector) -> Vector:
    """The backward vector before a row, from the one after it."""
    initial, truncated = kind
    v = [DELETE + x for x in after]
    if initial is not None:
        more = TRUNCATED if truncated else 0
        v = [min(x, REROLE + more + after[TURNED[s]]) for s, x in enumerate(v)]
        for s, to in KEPT.get(initial, {}).items():
            v[s] = min(v[s], more + after[to])
    return closed(v)


def tight(kind: Kind | None, state: int, here: Vector, after: Vector) -> tuple[str, int]:
    """The ASCII-least edit on a cheapest way, and the state after it. None: there are no more rows."""
    cost = here[state]
    if kind is not None and DELETE + after[state] == cost:
        return "D", state
    if INSERT + here[TURNED[state]] == cost:
        return "I", TURNED[state]
    initial, truncated = kind
    to = KEPT.get(initial, {}).get(state)
    if to is not None and (TRUNCATED if truncated else 0) + after[to] == cost:
        return "K", to
    return "R", TURNED[state]


def edits(kinds: list[Kind], start: int = EMPTY, after: Vector = END, ends: bool = True) -> Iterator[tuple[str, int, int]]:
    """Edits of a stretch: letter, state after it, index of the row (-1: inserted).

    ``after``: the vector after the stretch; ``ends``: the conversation ends there, so that what lacks is inserted.
    """
    n = len(kinds)
    step = max(1, isqrt(n))
    checkpoints = {n: after}
    v = after
    for i in range(n - 1, -1, -1):
        v = before(kinds[i], v)
        if i % step == 0:
            checkpoints[i] = v
    state = start
    for begin in range(0, n, step):
        end = min(begin + step, n)
        block = [checkpoints[end]]
        for i in range(end - 1, begin, -1):
            block.append(before(kinds[i], block[-1]))
        block.append(checkpoints[begin])
        block.reverse()
        for i in range(begin, end):
            letter = "I"
            while letter == "I":
                letter, state = tight(kinds[i], state, block[i - begin], block[i - begin + 1])
                yield letter, state, -1 if letter == "I" else i
    while ends and after[state]:
        _, state = tight(None, state, after, after)
        yield "I", state, -1


def transfer(kinds: list[Kind]) -> list[int]:
    """The cheapest cost of a stretch from each state to each, in rows."""
    columns = []
    for to in STATES:
        v: Vector = tuple(0 if s == to else FAR for s in STATES)  # type: ignore[assignment]
        for kind in reversed(kinds):
            v = before(kind, v)
        columns.append(v)
    return [min(FAR, columns[b][a]) for a in STATES for b in STATES]


# Stretches of conversations


@dataclass
class Told:
    """What a part is told of a conversation that it shares with others."""

    state: int = EMPTY
    after: Vector = END
    first: bool = True
    last: bool = True
    initial: str | None = None  # of the row before
    turn: int | None = None
    seq: int = 0


@dataclass
class Stretch:
    """The rows of a conversation that lie in one part, in order; equal rows are one with its number of times."""

    part: int = 0
    index: int = 0
    last: bool = False
    rows: list[dict] = field(default_factory=list)

    def each(self) -> Iterator[tuple[dict, str]]:
        """Every row with its first fault."""
        for row in self.rows:
            for i in range(row["times"]):
                blank, copy = row["blank"], i > 0 or row["seen"]
                yield row, "blank" if blank else "duplicate" if copy else "truncated" if row["truncated"] else ""

    def kinds(self) -> list[Kind]:
        return [
            (None if fault in ("blank", "duplicate") else row["role"][:1], fault == "truncated") for row, fault in self.each()
        ]


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[Stretch]:
    held = Stretch()
    for batch in batches:
        for row in batch.to_pylist():
            if held.rows and row["conv"] != held.rows[-1]["conv"]:
                yield held
                held = Stretch(held.part, held.index + 1)
            held.part = row["part"]
            held.rows.append(row)
    if held.rows:
        held.last = True
        yield held


def _parts(rows: DataFrame, n: int, columns: list[str]) -> DataFrame:
    return rows.select("part", "place", *columns).repartitionById(max(1, n), "part").sortWithinPartitions("place")


NARROW = ["conv", "turn", "times", "blank", "seen", "truncated"]


def _edges(rows: DataFrame, n: int, told: dict[tuple[int, int], Told], exits: bool) -> list:
    """Of the first and last conversation of each part the costs, or with ``exits`` the state after it, by that before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for s in _stretches(batches):
            if s.index and not s.last or exits and (s.part, s.index) not in told:
                continue
            kinds = s.kinds()
            if exits:
                one = told[s.part, s.index]
                numbers = []
                for state in STATES:
                    for _, state, _ in edits(kinds, state, one.after, one.last):
                        pass
                    numbers.append(state)
            else:
                numbers = transfer(kinds)
            real = [r for r in s.rows if r["times"]]
            initial, turn = (real[-1]["role"][:1], real[-1]["turn"]) if real else (None, None)
            out.append((s.part, s.index, s.rows[0]["conv"], numbers, bool(real), initial, turn))
        kinds_ = [pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()), pa.bool_(), pa.string(), pa.int64()]
        names = ["part", "index", "conv", "numbers", "real", "initial", "turn"]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds_)], names=names)

    narrow = _parts(rows.withColumn("role", F.substring("role", 1, 1)), n, [*NARROW, "role"])
    schema = "part long, index long, conv string, numbers array<long>, real boolean, initial string, turn long"
    return narrow.mapInArrow(run, schema).collect()


def _tell(rows: DataFrame, n: int) -> dict[tuple[int, int], Told]:
    """What the parts have to know of every conversation that lies in several of them."""
    ends = sorted(_edges(rows, n, {}, False), key=lambda r: (r["part"], r["index"]))
    chains = [c for _, group in groupby(ends, key=lambda r: r["conv"]) if len(c := list(group)) > 1]
    told: dict[tuple[int, int], Told] = {}
    for chain in chains:
        after, initial, turn = END, None, None
        for i, row in enumerate(chain):
            told[row["part"], row["index"]] = Told(first=i == 0, last=i == len(chain) - 1, initial=initial, turn=turn, seq=i)
            if row["real"]:
                initial, turn = row["initial"], row["turn"]
        for row in reversed(chain):
            told[row["part"], row["index"]].after = after
            costs = row["numbers"]
            after = tuple(min(FAR, *(costs[4 * a + b] + after[b] for b in STATES)) for a in STATES)  # type: ignore[assignment]
    if chains:
        exits = {(r["part"], r["index"]): r["numbers"] for r in _edges(rows, n, told, True)}
        for chain in chains:
            state = EMPTY
            for row in chain:
                told[row["part"], row["index"]].state = state
                state = exits[row["part"], row["index"]][state]
    return told


@dataclass
class Tally:
    """What is reported of a stretch, apart from its edits."""

    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    turns: int = 0
    least: int | None = None
    most: int | None = None

    @classmethod
    def of(cls, s: Stretch, told: Told) -> Tally:
        tally, initial, turn = cls(), told.initial, told.turn
        for row, fault in s.each():
            if fault:
                setattr(tally, fault, getattr(tally, fault) + 1)
            now = row["role"][:1]
            tally.illegal += initial is not None and initial + now not in LEGAL
            initial = now
            if row["turn"] is not None:
                tally.turns += turn is None or row["turn"] != turn
                tally.least = row["turn"] if tally.least is None else tally.least
                tally.most = row["turn"]
                turn = row["turn"]
        return tally

    def gaps(self) -> int:
        return self.most - self.least + 1 - self.turns if self.turns else 0


def _repaired(s: Stretch, told: Told) -> Iterator[tuple[str, int, str, str]]:
    """Letter, cost, role and text of every edit; rows that go have an empty role."""
    flat = list(s.each())
    kinds = [(None if f in ("blank", "duplicate") else r["role"][:1], f == "truncated") for r, f in flat]
    for letter, state, i in edits(kinds, told.state, told.after, told.last):
        more = TRUNCATED if i >= 0 and kinds[i][1] else 0
        if letter == "D":
            yield letter, DELETE, "", ""
        elif letter == "I":
            yield letter, INSERT, NAMES[state], ""
        elif letter == "K":
            yield letter, more, flat[i][0]["role"], flat[i][0]["text"]
        else:
            yield letter, REROLE + more, NAMES[state], flat[i][0]["text"]


def placed(rows: DataFrame) -> DataFrame:
    """Rows with their faults, written in order: part, and place within it."""
    order = ["conv", "turn", "role", "head", "hash"]
    found = with_faults(rows).withColumn("head", F.substring("text", 1, 100))
    return written(
        found.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().alias("place"),
            "conv_id",
            "role",
            "text",
            *NARROW,
        ),
        "conversations",
    )


def repaired_rows(conversations: DataFrame) -> DataFrame:
    """The rows of the repaired conversations: conv_id, part, n (order by both), edit, role, text; deleted rows too.

    It takes conversations as they are.
    """
    blank = F.lit(" ")
    rows = placed(
        conversations.select(
            "conv_id",
            "turn",
            F.coalesce("role", blank).alias("role"),
            F.coalesce("text", blank).alias("text"),
            F.lit(1).cast("long").alias("times"),
        )
    )
    n = (rows.agg(F.max("part")).first()[0] or 0) + 1
    told = _tell(rows, n)
    id_type = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None

        def typed() -> Iterator[pa.RecordBatch]:
            nonlocal kind
            for batch in batches:
                kind = batch.schema.field("conv_id").type
                yield batch

        for s in _stretches(typed()):
            one = told.get((s.part, s.index), Told())
            made = list(_repaired(s, one))
            columns = [
                pa.array([s.rows[0]["conv_id"]] * len(made), kind),
                pa.array([s.part] * len(made), pa.int64()),
                pa.array(range(len(made)), pa.int64()),
                *(pa.array([m[i] for m in made], pa.string()) for i in (0, 2, 3)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "part", "n", "edit", "role", "text"])

    schema = f"conv_id {id_type}, part long, n long, edit string, role string, text string"
    return _parts(rows, n, ["conv_id", "role", "text", *NARROW]).mapInArrow(run, schema)


COUNTS = ["blank", "duplicate", "truncated", "illegal"]


def reports(rows: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    rows: conv_id, turn, role, text, times.
    """
    rows = placed(rows)
    n = (rows.agg(F.max("part")).first()[0] or 0) + 1
    told = _tell(rows, n)
    id_type = rows.schema["conv_id"].dataType.simpleString()
    whole = ["conv_id", "gaps", *COUNTS, "cost", "audit", "repaired_sha256"]
    pieces = ["conv", "seq", "k", "turns", "least", "most", "lines", "body", "shared"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None
        out: list[tuple] = []
        size = 0

        def typed() -> Iterator[pa.RecordBatch]:
            nonlocal kind
            for batch in batches:
                kind = batch.schema.field("conv_id").type
                yield batch

        def flush() -> pa.RecordBatch:
            long = pa.int64()
            kinds = [kind, *[long] * 6, pa.string(), pa.string(), pa.string(), *[long] * 6, pa.binary(), pa.bool_()]
            made = pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=whole + pieces)
            out.clear()
            return made

        for s in _stretches(typed()):
            shared = (s.part, s.index) in told
            one = told.get((s.part, s.index), Told())
            tally = Tally.of(s, one)
            counts = [tally.blank, tally.duplicate, tally.truncated, tally.illegal]
            conv_id, conv = s.rows[0]["conv_id"], s.rows[0]["conv"]
            letters, lines, cost, chunk, k = [], [], 0, 0, 0
            made = _repaired(s, one)
            for letter, spent, role, text in made:
                letters.append(letter)
                cost += spent
                if role:
                    lines.append(f"{role}:{text}")
                    chunk += len(lines[-1])
                if shared and chunk >= CHUNK:
                    body = "\n".join(lines).encode()
                    out.append((conv_id, None, 0, 0, 0, 0, cost, "".join(letters), None, conv, one.seq, k, 0, None, None, len(lines), body, True))
                    yield flush()
                    letters, lines, cost, chunk, k = [], [], 0, 0, k + 1
            body = "\n".join(lines).encode()
            if shared:
                out.append(
                    (conv_id, None, *counts, cost, "".join(letters), None, conv, one.seq, k, tally.turns, tally.least, tally.most, len(lines), body, True)
                )
                size += len(body)
            else:
                digest = hashlib.sha256(body).hexdigest()
                out.append((conv_id, tally.gaps(), *counts, cost, "".join(letters), digest, None, 0, 0, 0, None, None, 0, None, False))
            if len(out) >= 5_000 or size >= CHUNK:
                size = 0
                yield flush()
        if out:
            yield flush()

    schema = (
        f"conv_id {id_type}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
        "repaired_sha256 string, conv string, seq long, k long, turns long, least long, most long, lines long, body binary, "
        "shared boolean"
    )
    found = written(_parts(rows, n, ["conv_id", "role", "text", *NARROW]).mapInArrow(run, schema), "repaired", by="shared")

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Stretches in their order; of a conversation it holds the digest so far and the edits, not the text."""
        kind, conv, held, done = None, None, {}, []

        def finish() -> None:
            tally = held["tally"]
            counts = [tally.blank, tally.duplicate, tally.truncated, tally.illegal]
            done.append((held["id"], tally.gaps(), *counts, held["cost"], "".join(held["audit"]), held["sha"].hexdigest()))

        def flush() -> pa.RecordBatch:
            kinds = [kind, *[pa.int64()] * 6, pa.string(), pa.string()]
            made = pa.RecordBatch.from_arrays([pa.array([r[i] for r in done], k) for i, k in enumerate(kinds)], names=whole)
            done.clear()
            return made

        for batch in batches:
            kind = batch.schema.field("conv_id").type
            for row in batch.to_pylist():
                if row["conv"] != conv:
                    if held:
                        finish()
                    conv = row["conv"]
                    held = {"id": row["conv_id"], "tally": Tally(), "cost": 0, "audit": [], "sha": hashlib.sha256(), "lines": 0}
                tally = held["tally"]
                for name in (*COUNTS, "turns"):
                    setattr(tally, name, getattr(tally, name) + row[name])
                tally.least = row["least"] if tally.least is None else tally.least
                tally.most = row["most"] if row["most"] is not None else tally.most
                held["cost"] += row["cost"]
                held["audit"].append(row["audit"])
                if row["lines"]:
                    held["sha"].update((b"\n" if held["lines"] else b"") + row["body"])
                    held["lines"] += row["lines"]
            if done:
                yield flush()
        if held:
            finish()
        if done:
            yield flush()

    split = found.filter("shared").repartition("conv").sortWithinPartitions("conv", "seq", "k")
    result = f"conv_id {id_type}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    return found.filter("NOT shared").select(*whole).unionByName(split.mapInArrow(together, result))


def digests(conversations: DataFrame) -> DataFrame:
    """The reports of the damaged conversations, of every conversation in the table."""
    return reports(damaged(conversations))
