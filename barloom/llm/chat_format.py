"""Chat formatting with minimum-cost role repair.

The legal order of turns is an automaton: an optional system turn, then user and assistant in alternation, beginning with the user. A
turn that does not fit is merged into the turn before it, takes another role, or gets an empty turn put in front; each has a
cost. Dynamic programming over the automaton's states finds the cheapest repair of the whole conversation, and the repaired
turns are rendered.

Rows are range-partitioned and sorted by conversation and turn. A conversation that lies within a partition is repaired there and then. One
that crosses a border, or is longer than ``block`` rows, is cut into segments: what a segment does to the automaton is a 4 x 4 matrix of
least costs, and products of matrices (minimum for sum, sum for product) tell each segment the states in which the best repair enters
and leaves it. So a conversation of any length is repaired exactly, a block at a time.

The result has a row per turn of the table and per inserted turn. Joining ``rendered`` in the order of ``place`` and ``piece`` gives the
conversation's text, so none has to fit into one row.

Defined results. Turns are ordered by number (null last), equal numbers by a hash of role and text. Roles are read in lower case
without white space around; some other names of the three roles are known (`ALIASES`); null and unknown roles are relabelled at the usual cost, to the
cheapest role. A null text renders as empty. Among repairs of equal cost the one comes first whose choices, from the last turn
backwards, come first in this order: appended, merged, with an empty turn put in front; roles in the order system, user, assistant.
A null conversation is a conversation. Repeated rows are turns of their own. An empty table gives an empty table. Extra columns are not read. Markers that
occur within a text are broken up by spaces, so that they cannot end its turn.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.llm.common import cut_lineage, map_batches

ROLES = ("system", "user", "assistant")
START = 3
#: Other names of the roles.
ALIASES = {"human": "user", "customer": "user", "bot": "assistant", "ai": "assistant", "gpt": "assistant", "model": "assistant", "developer": "system"}
#: Roles that may follow each state, and states in which a conversation may end.
NEXT = {START: (0, 1), 0: (1,), 1: (2,), 2: (1,)}
ENDS = (1, 2)
NEVER = 1 << 40


@dataclass(frozen=True)
class Costs:
    merge: int = 1
    relabel: int = 2
    insert: int = 3


#: What is done with a turn.
APPEND, MERGE, INSERT = 0, 1, 2


def role_of(role: str | None) -> int:
    name = (role or "").strip().lower()
    name = ALIASES.get(name, name)
    return ROLES.index(name) if name in ROLES else -1


def moves(role: int, costs: Costs) -> list[tuple[int, int, int, int, int]]:
    """Ways to take a turn: state before, state after, cost, action, inserted role (or -1)."""
    found = []
    for to in range(len(ROLES)):
        change = 0 if to == role else costs.relabel
        for state, following in NEXT.items():
            if to in following:
                found.append((state, to, change, APPEND, -1))
            else:
                if state == to:
                    found.append((state, to, change + costs.merge, MERGE, -1))
                between = [x for x in following if to in NEXT[x]]
                if between:
                    found.append((state, to, change + costs.insert, INSERT, between[0]))
    return sorted(found, key=lambda m: (m[3], m[1], m[0]))


def repair(roles: list[int], entry: list[int], leave: int | None, table: dict[int, list]) -> tuple[list[int], list[tuple[int, int, int]]]:
    """Least cost of each final state from the given costs of the entry states, and the best way to ``leave`` (None: not asked)."""
    cost, back = list(entry), []
    for role in roles:
        after, how = [NEVER] * 4, [None] * 4
        for move in table[role]:
            value = cost[move[0]] + move[2]
            if value < after[move[1]]:
                after[move[1]], how[move[1]] = value, move
        back.append(how)
        cost = after
    path: list[tuple[int, int, int]] = []
    if leave is not None:
        for how in reversed(back):
            state, to, _, action, inserted = how[leave]
            path.append((to, action, inserted))
            leave = state
        path.reverse()
    return cost, path


def product(left: list[list[int]], right: list[list[int]]) -> list[list[int]]:
    return [[min(left[i][k] + right[k][j] for k in range(4)) for j in range(4)] for i in range(4)]


def _finish(cost: list[int]) -> int:
    """The final state of least cost in which a conversation may end; without turns the start."""
    return min(ENDS, key=lambda state: cost[state]) if min(cost[s] for s in ENDS) < NEVER else START


def _close_gap(state: int, costs: Costs) -> tuple[int, int]:
    """Cost of ending in a state, and the role of the empty turn that ends it (-1: none)."""
    return (0, -1) if state in ENDS or state == START else (costs.insert, NEXT[state][0])


_MARKS = ("<|im_start|>", "<|im_end|>")


def render(role: int, text: str | None, first: bool, merged: bool) -> str:
    body = text or ""
    for mark in _MARKS:
        body = body.replace(mark, f"<| {mark[2:-2]} |>")
    if merged:
        return f"\n{body}"
    return f"{'' if first else '<|im_end|>' + chr(10)}<|im_start|>{ROLES[role]}\n{body}"


OUT = "place long, piece int, turn_role string, role string, action string, cost int, rendered string"
_OUT_NAMES = [x.split()[0] for x in OUT.split(", ")]
_ACTIONS = {APPEND: "keep", MERGE: "merge", INSERT: "keep"}


def _repaired(rows: list[tuple], place: int, entry: int, leave: int, final: bool, costs: Costs, table: dict[int, list]) -> Iterator[tuple]:
    """Result rows of a run of turns (index, conv, turn, role, text), entered and left in given states."""
    roles = [role_of(row[3]) for row in rows]
    start = [NEVER] * 4
    start[entry] = 0
    _, path = repair(roles, start, leave, table)
    for i, (row, role, (to, action, inserted)) in enumerate(zip(rows, roles, path)):
        first = entry == START and i == 0
        last = final and i == len(rows) - 1
        if inserted >= 0:
            yield row[0], place + i, 0, None, ROLES[inserted], "insert", costs.insert, render(inserted, "", first, False)
        change = costs.relabel if role != to else 0
        name = "+".join(x for x in ("relabel" if change else "", "merge" if action == MERGE else "") if x) or "keep"
        text = render(to, row[4], first and inserted < 0, action == MERGE)
        gap, closing = _close_gap(to, costs) if last else (0, -1)
        yield row[0], place + i, 1, row[3], ROLES[to], name, change + (costs.merge if action == MERGE else 0), text + ("<|im_end|>\n" if last and closing < 0 else "")
        if closing >= 0:
            yield row[0], place + i, 2, None, ROLES[closing], "insert", gap, render(closing, "", False, False) + "<|im_end|>\n"


def _best_end(cost: list[int], costs: Costs) -> int:
    """The state to end in, the cost of an empty last turn included."""
    return min(range(4), key=lambda state: (cost[state] + _close_gap(state, costs)[0], state))


def format_chats(
    turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", costs: Costs = Costs(), block: int = 65_536
) -> DataFrame:
    """conv_id, turn, place, piece, turn_role, role, action, cost, rendered: one row per repaired or inserted turn."""
    rows = turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"), F.col(role).alias("turn_role"), F.col(text).alias("text"))
    ranged = [F.asc_nulls_first("conv_id"), F.asc_nulls_last("turn"), F.xxhash64("turn_role", "text").asc()]
    order = [*ranged, F.asc_nulls_first("turn_role"), F.asc_nulls_first("text")]
    kinds = [rows.schema["conv_id"], rows.schema["turn"]]
    done_fields = T._parse_datatype_string(OUT).fields
    open_fields = T._parse_datatype_string("segment long, number int, text string, matrix array<long>").fields
    schema = T.StructType([*kinds, *done_fields, *open_fields])
    table = {r: moves(r, costs) for r in range(-1, len(ROLES))}
    arrow = [pa.int64(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int32(), pa.string(), pa.list_(pa.int64())]
    names = schema.names

    def batch_of(schema_: pa.Schema, values: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*values))
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, [schema_.field(0).type, schema_.field(1).type, *arrow])], names=names)

    def first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Repair conversations that lie within the partition; cut the others into segments."""
        base = TaskContext.get().partitionId() << 33
        segment, runs, pieces = 0, 0, 0
        held: list[tuple] = []
        schema_ = None

        def segment_rows(whole: bool) -> list[tuple]:
            nonlocal segment
            if whole:
                start = [NEVER] * 4
                start[START] = 0
                cost, _ = repair([role_of(r[3]) for r in held], start, None, table)
                return [(held[r[0]][1], held[r[0]][2], *r[1:], None, None, None, None) for r in _repaired(held, 0, START, _best_end(cost, costs), True, costs, table)]
            roles = [role_of(r[3]) for r in held]
            matrix = []
            for state in range(4):
                start = [NEVER] * 4
                start[state] = 0
                matrix += [min(x, NEVER) for x in repair(roles, start, None, table)[0]]
            segment += 1
            blank = (None,) * 5
            return [(r[1], r[2], None, None, r[3], *blank[:4], base + segment, i, r[4], matrix if i == len(held) - 1 else None) for i, r in enumerate(held)]

        for batch in batches:
            schema_ = batch.schema
            out: list[tuple] = []
            for conv, turn_, role_, text_ in zip(*(column.to_pylist() for column in batch.columns)):
                if held and held[-1][1] != conv:
                    out += segment_rows(whole=runs > 0 and not pieces)
                    held, runs, pieces = [], runs + 1, 0
                elif len(held) >= block:
                    out += segment_rows(whole=False)
                    held, pieces = [], pieces + 1
                held.append((len(held), conv, turn_, role_, text_))
            if out:
                yield batch_of(schema_, out)
        if held:
            yield batch_of(schema_, segment_rows(whole=False))

    first = cut_lineage(rows.repartitionByRange(*ranged).sortWithinPartitions(*order).mapInArrow(first_pass, schema))
    columns = ["conv_id", "turn", *_OUT_NAMES]
    done = first.where("segment IS NULL").select(columns)

    # A conversation has a segment per partition border it crosses and per ``block`` rows.
    segments = first.where("matrix IS NOT NULL").groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("segment", "number", "matrix"))).alias("segments"))
    told = "segment long, place long, entry int, leave int, final boolean"

    def compose(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for parts in batch.column(1).to_pylist():
            matrices = [[x["matrix"][4 * i : 4 * i + 4] for i in range(4)] for x in parts]
            costs_at = [[NEVER, NEVER, NEVER, 0]]
            for matrix in matrices:
                costs_at.append(product([costs_at[-1]] * 4, matrix)[0])
            leave, states = _best_end(costs_at[-1], costs), []
            for before, matrix in zip(reversed(costs_at[:-1]), reversed(matrices)):
                entry = min(range(4), key=lambda s: (before[s] + matrix[s][leave], s))
                states.append((entry, leave))
                leave = entry
            place, out = 0, []
            for i, (part, (entry, leave)) in enumerate(zip(parts, reversed(states))):
                out.append((part["segment"], place, entry, leave, i == len(parts) - 1))
                place += part["number"] + 1
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), types)], names=[x.split()[0] for x in told.split(", ")])

    plan = map_batches(segments, compose, told)
    waiting = first.where("segment IS NOT NULL").select("conv_id", "turn", "turn_role", "text", "segment", "number")
    joined = waiting.join(plan, "segment").select("segment", "number", "place", "entry", "leave", "final", "conv_id", "turn", "turn_role", "text")
    joined = joined.repartition("segment").sortWithinPartitions("segment", "number")
    out_schema = T.StructType([*kinds, *done_fields])
    out_names = out_schema.names

    def second_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        at: tuple | None = None
        types: list | None = None

        def finish() -> pa.RecordBatch:
            _, place, entry, leave, final = at
            values = [(held[r[0]][1], held[r[0]][2], *r[1:]) for r in _repaired(held, place, entry, leave, final, costs, table)]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*values), [*types, *arrow[:7]])], names=out_names)

        for batch in batches:
            types = [batch.column(6).type, batch.column(7).type]
            for segment, _, place, entry, leave, final, conv, turn_, role_, text_ in zip(*(column.to_pylist() for column in batch.columns)):
                if at is not None and at[0] != segment:
                    yield finish()
                    held = []
                at = (segment, place, entry, leave, final)
                held.append((len(held), conv, turn_, role_, text_))
        if held:
            yield finish()

    return done.unionByName(joined.mapInArrow(second_pass, out_schema))
