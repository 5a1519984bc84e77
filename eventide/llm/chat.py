"""Chat formatting: role sequences are repaired at minimum cost, then rendered.

A legal conversation is an optional system turn, then user and assistant turns in alternation, from a user turn on.
Dynamic programming over that automaton chooses for every turn whether to keep or relabel its role, whether to merge
it into the turn before, and where to insert empty turns.

The turns are sorted over the whole table and cut into parts, so a conversation of any length is spread. Of a
conversation that reaches over a cut, each part gives a 4 x 4 matrix of least costs from state to state; these chain
(minimum of sums), which fixes the state at every cut, and the parts then repair their turns independently.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.tables import stored

ROLES = ("system", "user", "assistant")
STATES = ("start", *ROLES)
LEGAL = {("start", "system"), ("start", "user"), ("system", "user"), ("user", "assistant"), ("assistant", "user")}
ENDS = ("user", "assistant")
# Other names of the roles.
ALIASES = {"human": "user", "prompter": "user", "customer": "user", "question": "user", "bot": "assistant",
           "gpt": "assistant", "model": "assistant", "ai": "assistant", "chatbot": "assistant", "answer": "assistant",
           "developer": "system", "instruction": "system"}
RELABEL, MERGE, INSERT = 2.0, 1.0, 3.0
INF = float("inf")


class Automaton:
    """Costs of moving from state to state, and the empty turns that each move inserts."""

    def __init__(self, relabel: float = RELABEL, merge: float = MERGE, insert: float = INSERT):
        self.relabel = relabel
        self.move = np.full((4, 4), INF)
        self.inserted: dict[tuple[int, int], list[str]] = {}
        self.merged: set[tuple[int, int]] = set()
        for p, a in enumerate(STATES):
            for q, b in enumerate(STATES[1:], 1):
                between = self._between(a, b)
                if between is not None:
                    self.move[p, q], self.inserted[p, q] = insert * len(between), between
                if p == q and merge <= self.move[p, q]:
                    self.move[p, q], self.inserted[p, q] = merge, []
                    self.merged.add((p, q))
        self.finish = np.full(4, INF)
        self.added: dict[int, list[str]] = {}
        for p, a in enumerate(STATES[1:], 1):
            options = [[]] if a in ENDS else [self._between(a, b) + [b] for b in ENDS if self._between(a, b) is not None]
            self.added[p] = min(options, key=len)
            self.finish[p] = insert * len(self.added[p])

    @staticmethod
    def _between(a: str, b: str) -> list[str] | None:
        """The fewest roles to insert so that b may follow a."""
        paths = [[a]]
        for _ in STATES:
            for path in paths:
                if (path[-1], b) in LEGAL:
                    return path[1:]
            paths = [p + [r] for p in paths for r in ROLES if (p[-1], r) in LEGAL]
        return None

    def step(self, role: int) -> np.ndarray:
        """Costs of one turn, from state to state; role 0 is an unknown one."""
        label = np.full(4, self.relabel)
        label[0] = INF
        if role:
            label[role] = 0.0
        return self.move + label


def role_number(role: str | None) -> int:
    name = (role or "").strip().lower()
    name = ALIASES.get(name, name)
    return STATES.index(name) if name in ROLES else 0


def chained(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a[:, :, None] + b[None, :, :]).min(axis=1)


#: Costs of the states before a conversation's first turn.
START = [0.0, INF, INF, INF]


def _backs(roles: list[int], rules: Automaton, ahead: list[float]) -> tuple[np.ndarray, np.ndarray]:
    """The state before each turn for every state after it, and the costs of the states after the last turn."""
    steps = [rules.step(r) for r in range(4)]
    cost, back = np.array(ahead, float), np.zeros((len(roles), 4), np.int8)
    for i, role in enumerate(roles):
        all_ = cost[:, None] + steps[role]
        back[i] = all_.argmin(axis=0)
        cost = all_.min(axis=0)
    return back, cost


def repair(roles: list[int], rules: Automaton, ahead: list[float] | None = None,
           end: int | None = None) -> list[tuple[int, int]]:
    """(state before, state after) of each turn on a least-cost path, given the costs of the states before the turns, to
    `end` (None: any fit to finish).

    Of equal costs the state that comes first stays, so a sequence cut anywhere has the path of the whole one.
    """
    back, cost = _backs(roles, rules, ahead or START)
    at = int((cost + rules.finish).argmin()) if end is None else end
    out = []
    for i in range(len(roles) - 1, -1, -1):
        before = int(back[i, at])
        out.append((before, at))
        at = before
    return out[::-1]


#: Text in a part, which one task holds at a time; a longer turn is a part of its own, with what still fits before it.
PART_BYTES = 8 << 20
_TURN_BYTES = 64


def _sorted_parts(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, part_bytes: int) -> DataFrame:
    """Turns in order of (conv_id, turn), with the part they lie in and their place in its range.

    A part is a stretch of about `part_bytes` of one range, however large the ranges are; parts are numbered in order.
    """
    named = turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                         F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    order = ["conv_id", "turn", "role", "tie", "row"]
    ranged = named.withColumn("tie", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())

    def number(batches: Iterable[pa.RecordBatch]):
        first, at, held = TaskContext.get().partitionId() << 32, 0, 0
        for batch in batches:
            sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = held + np.cumsum(sizes + _TURN_BYTES)
            part = first + (ends - 1) // part_bytes
            held = int(ends[-1]) if len(ends) else held
            yield pa.RecordBatch.from_arrays(
                [pa.array(part), pa.array(range(at, at + batch.num_rows), pa.int64()),
                 *(batch.column(c) for c in ("conv_id", "turn", "role", "text"))],
                names=["part", "place", "conv_id", "turn", "role", "text"])
            at += batch.num_rows

    return stored(ranged.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        number, "part long, place long, conv_id long, turn long, role string, text string"), "turns")


def _runs(ids: list) -> list[tuple[int, int]]:
    """Where each conversation of a part starts and stops."""
    cuts = [i for i in range(len(ids)) if not i or ids[i] != ids[i - 1]]
    return list(zip(cuts, [*cuts[1:], len(ids)]))


def _ids(column: pd.Series) -> list:
    return [None if pd.isna(v) else int(v) for v in column]


def format_turns(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", rules: Automaton | None = None,
                 template: str = "<|{role}|>\n{text}<|end|>\n", part_bytes: int = PART_BYTES) -> DataFrame:
    """Per turn: conv_id, turn, seq, role, new_role, action, cost, piece.

    `piece` is what the turn adds to the rendered conversation: inserted empty turns before it, its own header and
    text (joined by a newline to the turn before, if merged), and its end mark unless the next turn is merged into it.
    The pieces of a conversation in order of `seq` are the whole rendering. Turns go by number; equal numbers by role
    and text; a null number comes first. A null text is empty; a null or unknown role can take any, at the price of a
    relabel. Rows with a null conv_id make up one conversation. A very long conversation is rendered in parts of about
    `part_bytes` of text; a very long turn makes one part.
    """
    rules = rules or Automaton()
    parts = _sorted_parts(turns, conv_col, turn_col, role_col, text_col, part_bytes)
    head, tail = template.split("{text}")

    def edges(rows: pd.DataFrame) -> pd.DataFrame:
        """Cost matrices of a part's first and last conversation: only these can reach over a cut."""
        rows = rows.sort_values("place")
        ids, roles = _ids(rows.conv_id), [role_number(r) for r in rows.role]
        steps, out, runs = [rules.step(r) for r in range(4)], [], _runs(ids)
        for start, stop in dict.fromkeys((runs[0], runs[-1])):
            whole = np.where(np.eye(4) > 0, 0.0, INF)
            for r in roles[start:stop]:
                whole = chained(whole, steps[r])
            out.append((int(rows.part.iloc[0]), ids[start], stop - start, whole.ravel().tolist()))
        return pd.DataFrame(out, columns=["part", "conv_id", "size", "costs"]).astype({"conv_id": "Int64"})

    def entered(rows: pd.DataFrame) -> pd.DataFrame:
        """Costs of the states before each part of a conversation."""
        rows = rows.sort_values("part")
        ahead = [np.array(START)]
        for costs in rows.costs:
            ahead.append((ahead[-1][:, None] + np.array(costs, float).reshape(4, 4)).min(axis=0))
        return pd.DataFrame({"part": rows.part, "conv_id": rows.conv_id.astype("Int64"), "ahead": [a.tolist() for a in ahead[:-1]],
                             "first_seq": np.cumsum([0, *rows["size"]])[:-1], "last": [False] * (len(rows) - 1) + [True]})

    def traced(rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        """For every state after a part of a conversation, the state before it; and the state after the last turn."""
        rows = rows.sort_values("place")
        ids, roles = _ids(rows.conv_id), [role_number(r) for r in rows.role]
        where, before, final = dict(zip(ids, [None] * len(ids))), [], []
        for start, stop in _runs(ids):
            where[ids[start]] = roles[start:stop]
        for key, ahead in zip(_ids(known.conv_id), known.ahead):
            back, cost = _backs(where[key], rules, ahead)
            at = np.arange(4)
            for step in back[::-1]:
                at = step[at]
            before.append(at.tolist())
            final.append(int((cost + rules.finish).argmin()))
        return known.assign(conv_id=known.conv_id.astype("Int64"), before=before, final=final)

    def left(rows: pd.DataFrame) -> pd.DataFrame:
        """The state after each part of a conversation, from the last part backwards."""
        rows = rows.sort_values("part")
        leave, at = [], int(rows.final.iloc[-1])
        for before in rows.before.iloc[::-1]:
            leave.append(at)
            at = int(before[at])
        return rows.assign(conv_id=rows.conv_id.astype("Int64"), leave=leave[::-1])[
            ["part", "conv_id", "ahead", "leave", "first_seq", "last"]]

    def render(rows: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("place")
        ids, texts = _ids(rows.conv_id), [t if isinstance(t, str) else "" for t in rows.text]
        roles = [role_number(r) for r in rows.role]
        at_cut = dict(zip(_ids(known.conv_id), zip(known.ahead, known.leave, known.first_seq, known["last"])))
        out: dict[str, list] = {c: [] for c in ("seq", "new_role", "action", "cost", "piece")}
        for start, stop in _runs(ids):
            ahead, leave, seq, last = at_cut.get(ids[start], (START, None, 0, True))
            path = repair(roles[start:stop], rules, list(ahead), leave)
            for i, (p, q) in enumerate(path):
                merged, own = (p, q) in rules.merged, roles[start + i] == q
                gaps = [] if merged else rules.inserted[p, q]
                final = last and i == len(path) - 1
                empty = lambda names: "".join((head + tail).format(role=n) for n in names)
                closed = "" if p == 0 or merged else tail  # the turn before ends here
                body = ("\n" if merged else empty(gaps) + head.format(role=STATES[q])) + texts[start + i]
                after = rules.added[q] if final else []
                out["seq"].append(int(seq) + i)
                out["new_role"].append(STATES[q])
                out["action"].append("+".join(filter(None, [
                    "insert" if gaps or after else "", "merge" if merged else "", "" if own else "relabel"])) or "keep")
                out["cost"].append(float(rules.step(roles[start + i])[p, q] + (rules.finish[q] if final else 0.0)))
                out["piece"].append(closed + body + (tail + empty(after) if final else ""))
        return pd.DataFrame({"conv_id": rows.conv_id.astype("Int64"), "turn": rows.turn.astype("Int64"),
                             "role": rows.role} | {c: v for c, v in out.items()})

    roles = parts.select("part", "place", "conv_id", "role")
    cuts = roles.groupBy("part").applyInPandas(edges, "part long, conv_id long, size long, costs array<double>")
    joint = "part long, conv_id long, ahead array<double>, first_seq long, last boolean"
    ahead = cuts.groupBy("conv_id").applyInPandas(entered, joint)
    ways = roles.groupBy("part").cogroup(ahead.groupBy("part")).applyInPandas(traced, f"{joint}, before array<int>, final int")
    joints = stored(ways.groupBy("conv_id").applyInPandas(
        left, "part long, conv_id long, ahead array<double>, leave int, first_seq long, last boolean"), "turn-states")
    return parts.groupBy("part").cogroup(joints.groupBy("part")).applyInPandas(
        render, "conv_id long, turn long, role string, seq long, new_role string, action string, cost double, piece string")
