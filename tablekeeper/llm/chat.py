"""Chat formatting: the cheapest repair of a sequence of turns, and its rendering."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import stage

RELABEL, NAME, MERGE, INSERT = 2, 1, 1, 3
"""Costs: another role for a known one, a role for an unknown or missing one, a turn joined to the one before, an empty turn."""
PART_ROWS, PART_BYTES = 20_000, 32 << 20
"""A part, which one task repairs in memory, has about so many turns or bytes of text at most."""
ROLES = ("system", "user", "assistant")
START, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
_ALIASES = {
    "human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "ai": "assistant",
    "developer": "system",
}
_FAR = 1 << 40
KEEP, JOIN = 0, 1


def role_code(role: str | None) -> int:
    """1 to 3 for the roles and their other names, 0 for any other."""
    name = (role or "").strip().lower()
    name = _ALIASES.get(name, name)
    return ROLES.index(name) + 1 if name in ROLES else 0


def _empty_turns(state: int, role: int) -> tuple[int, ...] | None:
    """Shortest list of empty turns that lets ``role`` follow ``state``."""
    front = [(state, ())]
    seen = {state}
    while front:
        at, path = front.pop(0)
        if role in _NEXT[at]:
            return path
        for x in _NEXT[at]:
            if x not in seen:
                seen.add(x)
                front.append((x, (*path, x)))
    return None


INSERTED = {(s, r): _empty_turns(s, r) for s in range(4) for r in (1, 2, 3)}
CLOSING = {START: (), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}
"""Empty turns that end a conversation properly."""


def _steps() -> tuple[np.ndarray, np.ndarray]:
    """Cost and way (joined or not) of each step (role in the data, state, next state)."""
    cost, way = np.full((4, 4, 4), _FAR, np.int64), np.zeros((4, 4, 4), np.int64)
    for given in range(4):
        for state in range(4):
            for role in (SYSTEM, USER, ASSISTANT):
                named = 0 if given == role else RELABEL if given else NAME
                options = []
                if state == role:
                    options.append((named + MERGE, JOIN))
                if INSERTED[state, role] is not None:
                    options.append((named + INSERT * len(INSERTED[state, role]), KEEP))
                if options:
                    cost[given, state, role], way[given, state, role] = min(options)
    return cost, way


COST, WAY = _steps()


def forward(codes: np.ndarray, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least cost of each state after the turns, for each row of costs in ``entry``, and the states before (turns x rows x 4)."""
    came = np.zeros((len(codes), *entry.shape), np.int8)
    for t, code in enumerate(codes):
        options = entry[:, :, None] + COST[code][None]
        came[t] = options.argmin(1)
        entry = np.minimum(options.min(1), _FAR)
    return entry, came


def repair(codes: np.ndarray, state: int, last: int | None) -> tuple[list[int], int]:
    """Roles the turns get from ``state`` on, ending in ``last`` (None: where the conversation ends cheapest), and that state."""
    entry = np.full((1, 4), _FAR, np.int64)
    entry[0, state] = 0
    cost, came = forward(codes, entry)
    if last is None:
        last = int(np.argmin(cost[0] + np.array([INSERT * len(CLOSING[s]) for s in range(4)])))
    states, at = [], last
    for t in range(len(codes) - 1, -1, -1):
        states.append(at)
        at = int(came[t, 0, at])
    return states[::-1], last


def escape(text: str) -> str:
    """Text that cannot be taken for a marker."""
    return text.replace("<|", "<\\|")


def rendered(conv: list[tuple[int, str | None]], states: list[int], state: int, ends: bool):
    """(index of the turn or None, role, action, text, piece) of each output row; the pieces in a row are the rendering."""
    out = []

    def open_(role: int, before: int) -> str:
        return ("<|end|>\n" if before != START else "") + f"<|{ROLES[role - 1]}|>\n"

    for k, ((code, text), role) in enumerate(zip(conv, states, strict=True)):
        text = text or ""
        if WAY[code, state, role] == JOIN:
            action, piece = "merge", "\n" + escape(text)
        else:
            for x in INSERTED[state, role]:
                out.append((None, x, "insert", "", open_(x, state)))
                state = x
            action, piece = "keep", open_(role, state) + escape(text)
        if code != role:
            action = "relabel" if action == "keep" else "relabel+merge"
        out.append((k, role, action, text, piece))
        state = role
    if ends:
        for x in CLOSING[state]:
            out.append((None, x, "insert", "", open_(x, state)))
            state = x
        if out:
            out[-1] = (*out[-1][:4], out[-1][4] + "<|end|>\n")
    return out


# --- on DataFrames ---------------------------------------------------------------

def _conversations(conv: pa.Array):
    """(first, last + 1) of the runs of equal ids of a sorted column."""
    ids = conv.to_pylist()
    at = [0, *(i for i in range(1, len(ids)) if ids[i] != ids[i - 1]), len(ids)]
    return [(i, j) for i, j in zip(at[:-1], at[1:], strict=True) if j > i]


def format_chats(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """Repair each conversation at least cost, so that it is [system] (user assistant)*, and render it.

    One row per turn of ``turns`` and per inserted empty turn: ``conv_id``, ``place`` (increasing along the
    conversation), ``turn`` (NULL if inserted), ``role``, ``action`` (keep, relabel, merge, relabel+merge, insert),
    ``text`` and ``piece``; a conversation's pieces one after the other are its rendering. A merge joins a turn to the
    one before with a line break.

    Turns are taken by ``turn`` (NULL last), then role, then text; repeated rows are turns of their own. Unknown and
    NULL roles are given one; NULL texts are empty. Turns without conversation id are one conversation. An empty table
    gives an empty result. Other columns are not read.

    The turns are sorted into ranges, so a conversation of any length lies in several parts. The least costs between
    states over a part form a small matrix; the matrices of one conversation, one per part, are chained to find the
    states at the borders, and then each part is repaired by itself.
    """
    rows = turns.select(
        F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).alias("text")
    )
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()
    parts = 1 + max(size.n // PART_ROWS, size.b // PART_BYTES)
    order = ["conv_id", F.col("turn").isNull(), "turn", "role", F.xxhash64("text")]
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order, "text")
    dealt = dealt.withColumn("part", F.spark_partition_id()).withColumn("pos", F.monotonically_increasing_id())
    dealt = stage(dealt, "turns")
    kinds = {x.name: x.dataType.simpleString() for x in rows.schema}

    def weigh(table: pa.Table) -> pa.Table:
        table = table.sort_by("pos").combine_chunks()
        codes = np.array([role_code(x) for x in table["role"].to_pylist()], np.int64)
        conv = table["conv_id"].combine_chunks()
        unit = np.full((4, 4), _FAR, np.int64)
        np.fill_diagonal(unit, 0)
        found = _conversations(conv)
        first = pa.array([i for i, _ in found], pa.int64())
        costs = [forward(codes[i:j], unit)[0].ravel().tolist() if i == 0 or j == len(codes) else [] for i, j in found]
        return pa.table({"conv_id": conv.take(first), "part": table["part"].combine_chunks().take(first), "costs": pa.array(costs, pa.list_(pa.int64()))})

    weighed = dealt.select("conv_id", "part", "pos", "role").groupBy("part").applyInArrow(weigh, f"conv_id {kinds['conv_id']}, part int, costs array<long>")
    weighed = weighed.where(F.size("costs") > 0)

    def chain(table: pa.Table) -> pa.Table:
        """States at the borders of the parts of one conversation, of which there are at most as many as parts."""
        table = table.sort_by("part").combine_chunks()
        costs = [np.array(x).reshape(4, 4) for x in table["costs"].to_pylist()]
        best, came = np.full(4, _FAR), []
        best[START] = 0
        for c in costs:
            options = best[:, None] + c
            came.append(options.argmin(0))
            best = options.min(0)
        state = int(np.argmin(best + np.array([INSERT * len(CLOSING[s]) for s in range(4)])))
        exits = []
        for x in reversed(came):
            exits.append(state)
            state = int(x[state])
        exits.reverse()
        n = len(costs)
        return pa.table({
            "conv_id": table["conv_id"], "part": table["part"], "entry": pa.array([START, *exits[:-1]], pa.int32()),
            "exit": pa.array(exits, pa.int32()), "ends": pa.array([k == n - 1 for k in range(n)]),
        })

    borders = weighed.groupBy("conv_id").applyInArrow(chain, f"conv_id {kinds['conv_id']}, part int, entry int, exit int, ends boolean")
    borders = stage(borders.groupBy("part").agg(F.collect_list(F.struct("conv_id", "entry", "exit", "ends")).alias("borders")), "borders")

    def mend(key, mine: pa.Table, theirs: pa.Table) -> pa.Table:
        table = mine.sort_by("pos").combine_chunks()
        known = {x["conv_id"]: x for cell in theirs["borders"].to_pylist() for x in cell}
        ids, turn = table["conv_id"].combine_chunks(), table["turn"].combine_chunks()
        codes = np.array([role_code(x) for x in table["role"].to_pylist()], np.int64)
        texts = table["text"].to_pylist()
        taken, places, out = [], [], [[], [], [], []]
        base = key[0].as_py() << 33
        for i, j in _conversations(ids):
            at = known.get(ids[i].as_py()) or {"entry": START, "exit": None, "ends": True}
            states, _ = repair(codes[i:j], at["entry"], at["exit"])
            for k, role, action, text, piece in rendered(list(zip(codes[i:j].tolist(), texts[i:j], strict=True)), states, at["entry"], at["ends"]):
                taken.append((i, None if k is None else i + k))
                places.append(base + len(places))
                for values, x in zip(out, (ROLES[role - 1], action, text, piece), strict=True):
                    values.append(x)
        return pa.table({
            "conv_id": ids.take(pa.array([x for x, _ in taken], pa.int64())), "place": pa.array(places, pa.int64()),
            "turn": turn.take(pa.array([x for _, x in taken], pa.int64())),
            **{name: pa.array(values, pa.string()) for name, values in zip(("role", "action", "text", "piece"), out, strict=True)},
        })

    return dealt.groupBy("part").cogroup(borders.groupBy("part")).applyInArrow(
        mend, f"conv_id {kinds['conv_id']}, place long, turn {kinds['turn']}, role string, action string, text string, piece string"
    )
