"""Chat formatting: minimum-cost repair of the roles of a conversation, then rendering.

A legal conversation is an optional system turn, then user and assistant in turn, and ends with the assistant. Each turn
keeps its role or is relabelled; it opens a turn, or is merged into the one before if that has the same role; and empty
turns can be inserted. Dynamic programming over the automaton whose state is the last role finds the cheapest repair.
Of several, it takes the one whose first differing turn gets the earlier role (system, user, assistant).

A conversation may hold any share of all rows, so none is gathered as a whole. Rows are range-partitioned by
conversation and turn; a part holds many short conversations, or a stretch of a long one. The cost of a stretch from each
state to each other is a small matrix, and matrices of consecutive stretches multiply (with minimum and sum). So the
driver gets one such matrix for the first and last conversation of each part, and tells each part the costs that follow
and then the state it starts from; what it holds goes with the number of parts.

Cases: a null text is the empty text. Null and unknown roles can take any role, at a lower cost. Rows without a
conversation id are one conversation. Turns are in order of ``turn``, nulls first, ties by role and text; repeated rows
are turns of their own. An empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daytally.llm.common import text_or_empty, written

ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = 0, 1, 2, 3
STATES = range(4)
# Other names of the roles.
ALIASES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "ai": "assistant"}
FAR = 1 << 40

Vector = tuple[int, ...]


@dataclass(frozen=True)
class Costs:
    merge: int = 1
    relabel: int = 2
    name: int = 1  # of a turn whose role is null or unknown
    insert: int = 3


@dataclass(frozen=True)
class Grammar:
    """Costs of going from one state to another with a turn of each role, and what is inserted on the way."""

    step: dict[int, list[list[int]]]  # role (0: unknown) -> from -> to
    inserted: list[list[tuple[int, ...]]]  # from -> to -> empty turns before the turn
    ending: Vector
    closing: list[tuple[int, ...]]

    @classmethod
    def of(cls, costs: Costs) -> Grammar:
        follows = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}

        def way(a: int, b: int) -> tuple[int, ...] | None:
            """The fewest empty turns after which ``b`` may follow ``a``."""
            front: list[tuple[int, tuple[int, ...]]] = [(a, ())]
            for _ in STATES:
                for at, path in front:
                    if b in follows[at]:
                        return path
                front = [(n, (*path, n)) for at, path in front for n in follows[at] if n != SYSTEM]
            return None

        inserted: list[list[tuple[int, ...]]] = [[()] * 4 for _ in STATES]
        move = [[FAR] * 4 for _ in STATES]
        for a in STATES:
            for b in (SYSTEM, USER, ASSISTANT):
                path = way(a, b)
                if path is not None:
                    move[a][b], inserted[a][b] = costs.insert * len(path), path
                if a == b and costs.merge <= move[a][b]:
                    move[a][b], inserted[a][b] = costs.merge, ()
        step = {}
        for role in STATES:
            label = [FAR] + [costs.name if not role else 0 if t == role else costs.relabel for t in (1, 2, 3)]
            step[role] = [[min(FAR, move[a][b] + label[b]) for b in STATES] for a in STATES]
        closing = [() if a == ASSISTANT else (*(way(a, ASSISTANT) or ()), ASSISTANT) for a in STATES]
        return cls(step, inserted, tuple(costs.insert * len(c) for c in closing), closing)

    def matrix(self, roles: list[int]) -> list[Vector]:
        """The cheapest cost of a stretch, from each state to each."""
        rows = [tuple(0 if a == b else FAR for b in STATES) for a in STATES]
        for role in roles:
            m = self.step[role]
            rows = [tuple(min(FAR, min(r[k] + m[k][b] for k in STATES)) for b in STATES) for r in rows]
        return rows

    def walk(self, roles: list[int], start: int, after: Vector) -> list[int]:
        """The states after each turn, on the cheapest way whose rest costs ``after``."""
        rest = [after]
        for role in reversed(roles):
            m, nxt = self.step[role], rest[-1]
            rest.append(tuple(min(FAR, min(m[a][b] + nxt[b] for b in STATES)) for a in STATES))
        out, at = [], start
        for i, role in enumerate(roles):
            nxt = rest[len(roles) - 1 - i]
            m = self.step[role][at]
            at = min(STATES, key=lambda b: (m[b] + nxt[b], b))
            out.append(at)
        return out


def role_code(role: str | None) -> int:
    name = (role or "").strip().lower()
    name = ALIASES.get(name, name)
    return ROLES.index(name) + 1 if name in ROLES else 0


@dataclass
class Stretch:
    """What a part is told of its first or last conversation: where it starts, and what is to follow."""

    state: int = START
    after: Vector | None = None  # None: the conversation ends here
    order: int = 0
    turns: int = 0


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[dict], bool]]:
    """Rows of one conversation in the part, its index in the part, and whether it is the last there."""
    held: list[dict] = []
    index = 0
    for batch in batches:
        for row in batch.to_pylist():
            if held and row["conv"] != held[-1]["conv"]:
                yield index, held, False
                held, index = [], index + 1
            held.append(row)
    if held:
        yield index, held, True


def _parts(rows: DataFrame, n: int, run: Callable, schema: str, columns: list[str]) -> DataFrame:
    placed = rows.select("part", "place", *columns).repartitionById(max(1, n), "part").sortWithinPartitions("place")
    return placed.mapInArrow(run, schema)


def _edges(rows: DataFrame, n: int, told: dict, grammar: Grammar, exits: bool) -> list:
    """For the first and last conversation of each part: its matrix; or with ``exits``, for each state at its start, the
    state at its end, the rows and the turns it makes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, list] = {name: [] for name in ("part", "index", "last", "conv", "numbers")}
        for index, stretch, last in _stretches(batches):
            part = stretch[0]["part"]
            if index and not last:
                continue
            if exits and (part, index) not in told:
                continue
            roles = [role_code(r["role"]) for r in stretch]
            if exits:
                numbers = []
                for start in STATES:
                    states = grammar.walk(roles, start, told[part, index].after or grammar.ending)
                    pieces = list(_pieces(grammar, roles, states, start))
                    numbers += [states[-1], len(pieces), sum(opens for _, _, _, opens, _ in pieces)]
            else:
                numbers = [x for row in grammar.matrix(roles) for x in row]
            for name, value in zip(found, (part, index, last, stretch[0]["conv"], numbers)):
                found[name].append(value)
        kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.string(), pa.list_(pa.int64())]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(found.values(), kinds)], names=list(found))

    schema = "part long, index long, last boolean, conv string, numbers array<long>"
    return _parts(rows, n, run, schema, ["conv", "role"]).collect()


def _pieces(grammar: Grammar, roles: list[int], states: list[int], start: int) -> Iterator[tuple[int, int, str, bool, int]]:
    """Per row of the result: place of the turn (-1: none), role, action, whether it opens a turn, state before."""
    at = start
    for i, (role, state) in enumerate(zip(roles, states)):
        empty = grammar.inserted[at][state]
        for x in empty:
            yield -1, x, "insert", True, at
        merged = at == state and not empty
        relabelled = role != state
        action = "relabel and merge" if merged and relabelled else "merge" if merged else "relabel" if relabelled else "keep"
        yield i, state, action, not merged, at
        at = state


def _tell(rows: DataFrame, n: int, grammar: Grammar) -> dict[tuple[int, int], Stretch]:
    """For every stretch of a conversation that goes over parts: its start and what follows."""
    ends = sorted(_edges(rows, n, {}, grammar, False), key=lambda r: (r["part"], r["index"]))
    chains: list[list] = []
    for before, row in zip([None, *ends], ends):
        if before is not None and before["part"] != row["part"] and before["conv"] == row["conv"]:
            chains[-1].append(row)
        else:
            chains.append([row])
    told: dict[tuple[int, int], Stretch] = {}
    chains = [c for c in chains if len(c) > 1]
    for chain in chains:
        after: Vector | None = None
        for row in reversed(chain):
            told[row["part"], row["index"]] = Stretch(after=after)
            rest, m = after or grammar.ending, row["numbers"]
            after = tuple(min(FAR, min(m[4 * a + b] + rest[b] for b in STATES)) for a in STATES)
    if chains:
        exits = {(r["part"], r["index"]): r["numbers"] for r in _edges(rows, n, told, grammar, True)}
        for chain in chains:
            state, order, turns = START, 0, 0
            for row in chain:
                one = told[row["part"], row["index"]]
                one.state, one.order, one.turns = state, order, turns
                state, made, opened = exits[row["part"], row["index"]][3 * state : 3 * state + 3]
                order, turns = order + made, turns + opened
    return told


def repair(conversations: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """Rows of the repaired conversations: conv_id, order (from 0), turn (of the result, from 0), role, action, text,
    rendered. Joined in order, ``rendered`` is the conversation: ``<|role|>``, text, ``<|end|>``, each on lines of its own.
    """
    grammar = Grammar.of(costs)
    id_type = conversations.schema["conv_id"].dataType.simpleString()
    rows = conversations.select(
        "conv_id", "turn", "role", text_or_empty().alias("text"), F.monotonically_increasing_id().alias("row")
    )
    # Equal rows differ by ``row`` only, so that they too can be dealt over parts.
    order = ["conv_id", "turn", "role", "text", "row"]
    placed = written(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(
            F.spark_partition_id().alias("part"),
            F.monotonically_increasing_id().alias("place"),
            "conv_id",
            F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("conv"),
            "role",
            "text",
        ),
        "chat",
    )
    n = (placed.agg(F.max("part")).first()[0] or 0) + 1
    told = _tell(placed, n, grammar)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "order", "turn", "role", "action", "text", "rendered"]
        kind, out = None, []

        def flush() -> pa.RecordBatch:
            kinds = [kind, pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string()]
            columns = [pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, names=names)

        def typed() -> Iterator[pa.RecordBatch]:
            nonlocal kind
            for batch in batches:
                kind = batch.schema.field("conv_id").type
                yield batch

        for index, stretch, _ in _stretches(typed()):
            one = told.get((stretch[0]["part"], index), Stretch())
            roles = [role_code(r["role"]) for r in stretch]
            states = grammar.walk(roles, one.state, one.after or grammar.ending)
            pieces = list(_pieces(grammar, roles, states, one.state))
            if one.after is None:
                pieces += [(-1, x, "insert", True, 0) for x in grammar.closing[states[-1]]]
            turn = one.turns - 1
            for k, (i, state, action, opens, _) in enumerate(pieces):
                turn += opens
                text, role = stretch[i]["text"] if i >= 0 else "", ROLES[state - 1]
                head = ("<|end|>\n" if turn else "") + f"<|{role}|>\n" if opens else ""
                tail = "<|end|>\n" if one.after is None and k == len(pieces) - 1 else ""
                out.append((stretch[0]["conv_id"], one.order + k, turn, role, action, text, f"{head}{text}\n{tail}"))
                if len(out) >= 10_000:
                    yield flush()
        if out:
            yield flush()

    schema = f"conv_id {id_type}, order long, turn long, role string, action string, text string, rendered string"
    return _parts(placed, n, run, schema, ["conv_id", "conv", "role", "text"])
