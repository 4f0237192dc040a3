"""Chat formatting with minimum-cost role repair over a legal-turn automaton."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

ROLES = ("system", "user", "assistant")
#: State 0 is the begin; the others are the role of the last turn. What may follow what:
LEGAL = {0: (1, 2), 1: (2,), 2: (3,), 3: (2,)}
#: A conversation may end after these.
FINAL = (0, 2, 3)
#: Costs of the repairs.
MERGE, RELABEL, INSERT = 1.0, 2.0, 1.5
STATES = range(4)


def _fill(state: int, then: int) -> list[int]:
    """The fewest turns to insert after ``state`` so that ``then`` may follow."""
    paths = [[state]]
    while paths:
        path = paths.pop(0)
        if then in LEGAL[path[-1]]:
            return path[1:]
        paths += [[*path, s] for s in LEGAL[path[-1]] if s not in path[1:] and len(path) <= 4]
    return []


def _reachable(state: int, then: int) -> bool:
    return then in LEGAL[state] or bool(_fill(state, then))


def _moves() -> dict[int, list[tuple[int, int, float, int, str, tuple[int, ...]]]]:
    """Per observed role (0: unknown): (from, to, cost, new turns, action, inserted), in order of preference."""
    moves = {}
    for seen in STATES:
        found = []
        for state in STATES:
            for role in STATES[1:]:
                label = 0.0 if role == seen else RELABEL
                if _reachable(state, role):
                    inserted = tuple(_fill(state, role))
                    action = "keep" if role == seen else "relabel"
                    found.append((state, role, label + INSERT * len(inserted), 1 + len(inserted), action, inserted))
            if state:
                found.append((state, state, MERGE + (0.0 if state == seen else RELABEL), 0, "merge", ()))
        moves[seen] = found
    return moves


MOVES = _moves()


def paths(roles: list[int], entry: int):
    """Cheapest way from ``entry`` through all messages, per exit state: costs, new turns, choices per message."""
    cost, turns, choices = [math.inf] * 4, [0] * 4, []
    cost[entry] = 0.0
    for seen in roles:
        best: list[tuple | None] = [None] * 4
        for move in MOVES[seen]:
            total = cost[move[0]] + move[2]
            if total < math.inf and (best[move[1]] is None or total < best[move[1]][0]):
                best[move[1]] = (total, turns[move[0]] + move[3], move)
        cost = [b[0] if b else math.inf for b in best]
        turns = [b[1] if b else 0 for b in best]
        choices.append([b[2] if b else None for b in best])
    return cost, turns, choices


def _number(role) -> int:
    return ROLES.index(role) + 1 if role in ROLES else 0


def _numbered(batches):
    """Rows as sorted, with the partition and the place in it."""
    part, at = TaskContext.get().partitionId(), 0
    for batch in batches:
        n = batch.num_rows
        columns = [*batch.columns, pa.array([part] * n, pa.int32()), pa.array(range(at, at + n), pa.int64())]
        at += n
        yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "part", "pos"])


def _by_runs(keys: tuple[str, ...], one, schema: pa.Schema):
    """``one`` on every run of rows with equal keys of a sorted partition; a run is all that is held."""

    def run(batches):
        held, out = [], []
        for batch in batches:
            for row in batch.to_pylist():
                if held and any(row[k] != held[0][k] for k in keys):
                    out += one(held)
                    held = []
                held.append(row)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
                out = []
        if held:
            yield pa.RecordBatch.from_pylist(one(held), schema)

    return run


def _summarise(rows: list[dict]) -> list[dict]:
    """One row per chunk of a conversation: cost and new turns for every entry and exit."""
    roles = [_number(r["role"]) for r in rows]
    table = [paths(roles, entry)[:2] for entry in STATES]
    costs, turns = ([x for row in table for x in row[i]] for i in (0, 1))
    return [{"conv": rows[0]["conv"], "part": rows[0]["part"], "costs": costs, "turns": turns}]


def _link(rows: list[dict]) -> list[dict]:
    """Entry, exit and first turn number of every chunk of one conversation; chunks are as few as partitions."""
    forward, back = np.full(4, math.inf), []
    forward[0] = 0
    for row in rows:
        total = forward[:, None] + np.array(row["costs"], float).reshape(4, 4)
        back.append(total.argmin(axis=0))
        forward = total.min(axis=0)
    state = min(FINAL, key=lambda s: (forward[s], s))
    exits = [state]
    for choice in reversed(back):
        exits.append(int(choice[exits[-1]]))
    exits = exits[::-1]
    out, base = [], 0
    for i, (row, entry, leave) in enumerate(zip(rows, exits[:-1], exits[1:], strict=True)):
        last = i == len(rows) - 1
        out.append({"c": row["conv"], "p": row["part"], "entry": entry, "leave": leave, "base": base, "last": last})
        base += row["turns"][4 * entry + leave]
    return out


def _head(role: int) -> str:
    return f"<|im_start|>{ROLES[role - 1]}\n"


def _repair(rows: list[dict]) -> list[dict]:
    first = rows[0]
    choices = paths([_number(r["role"]) for r in rows], first["entry"])[2]
    state, taken = first["leave"], []
    for choice in reversed(choices):
        taken.append(choice[state])
        state = choice[state][0]
    turn, out = first["base"], []
    for (came, role, cost, new, action, inserted), row in zip(reversed(taken), rows, strict=True):
        text = row["text"] or ""
        if action == "merge":
            rendered = "\n" + text
        else:
            rendered = "".join(_head(i) + "<|im_end|>\n" for i in inserted) + _head(role) + text
            rendered = ("<|im_end|>\n" if came else "") + rendered
        turn += new
        out.append(
            {c: row[c] for c in ("conv", "turn", "part", "pos", "role")}
            | {"out_turn": turn - 1, "repaired_role": ROLES[role - 1], "action": action}
            | {"inserted": [ROLES[i - 1] for i in inserted], "cost": cost, "rendered": rendered}
        )
    if first["last"]:
        out[-1]["rendered"] += "<|im_end|>\n"
    return out


def format_chat(
    df: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per message: conversation, turn, ``role``, ``part`` and ``pos`` (the order of the messages),
    ``out_turn``, ``repaired_role``, ``action`` (keep, relabel, merge), ``inserted`` (empty turns put before it),
    ``cost`` and ``rendered``. The ``rendered`` fragments of a conversation, in order, are its repaired text.

    A conversation is legal if it has at most one system turn, at its begin, and then user and assistant in turn,
    beginning with the user. Dynamic programming finds the cheapest mix of merging a message into the turn before,
    relabelling it and inserting empty turns; equal costs are settled by a fixed order.

    Messages are dealt out by ranges of (conversation, turn), so that a long conversation is cut into chunks. A chunk
    is summed up by its cheapest cost from every state to every state; the sums of a conversation are linked into entry
    and exit states, and then each chunk is repaired on its own.

    Messages of equal turn are ordered by role and text, null turns come first; unknown and null roles have to be
    relabelled or merged; null texts count as empty; messages with a null conversation are one conversation. Other
    columns are ignored.
    """
    rows = df.select(
        F.col(conv_col).cast("long").alias("conv"),
        F.col(turn_col).cast("long").alias("turn"),
        F.lower(F.trim(F.col(role_col).cast("string"))).alias("role"),
        F.col(text_col).cast("string").alias("text"),
    )
    order = ["conv", "turn", "role", "h"]
    rows = rows.withColumn("h", F.xxhash64("text")).repartitionByRange(*order).sortWithinPartitions(*order, "text").drop("h")
    plain = "conv long, turn long, role string, text string"
    rows = materialise(rows.mapInArrow(_numbered, f"{plain}, part int, pos long"), "turns")
    whole, text = pa.int64(), pa.string()
    place = [("conv", whole), ("part", pa.int32())]
    sums_of = pa.schema([*place, ("costs", pa.list_(pa.float64())), ("turns", pa.list_(whole))])
    links_of = pa.schema(
        [("c", whole), ("p", pa.int32()), ("entry", pa.int32()), ("leave", pa.int32()), ("base", whole), ("last", pa.bool_())]
    )
    fixed_of = pa.schema(
        [("conv", whole), ("turn", whole), ("part", pa.int32()), ("pos", whole), ("role", text), ("out_turn", whole)]
        + [("repaired_role", text), ("action", text), ("inserted", pa.list_(text)), ("cost", pa.float64()), ("rendered", text)]
    )
    chunk = ("conv", "part")
    sums = rows.select("conv", "part", "pos", "role").repartition(*chunk).sortWithinPartitions(*chunk, "pos")
    sums = sums.mapInArrow(
        _by_runs(chunk, _summarise, sums_of), "conv long, part int, costs array<double>, turns array<long>"
    )
    links = sums.repartition("conv").sortWithinPartitions("conv", "part")
    links = links.mapInArrow(
        _by_runs(("conv",), _link, links_of), "c long, p int, entry int, leave int, base long, last boolean"
    )
    links = materialise(links, "links")
    joined = rows.join(links, F.expr("conv <=> c AND part = p")).drop("c", "p")
    joined = joined.repartition(*chunk).sortWithinPartitions(*chunk, "pos")
    out = joined.mapInArrow(
        _by_runs(chunk, _repair, fixed_of),
        "conv long, turn long, part int, pos long, role string, out_turn long, repaired_role string, action string, "
        "inserted array<string>, cost double, rendered string",
    )
    return out.withColumnsRenamed({"conv": conv_col, "turn": turn_col})
