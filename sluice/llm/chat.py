"""Chat formatting with minimum-cost role repair.

A conversation is legal if an automaton accepts its roles: an optional system message
first, then user and assistant in turn, ending with the assistant. Dynamic programming over
the automaton's states finds the cheapest way to make it legal: keep a turn, merge it into
the message before it, give it another role, or put an empty message before it or at the
end. Each turn is then rendered as its piece of the repaired sequence.

Costs of a stretch of turns are a small matrix (state before, state after), and matrices of
consecutive stretches combine by (min, +) products. So a conversation may lie in any number
of parts, which are runs of ``PART`` turns of the sorted table: only the matrices of a part's
first and last conversation reach the driver, which picks the states at the borders, and no
task holds more than one part.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluice.session import durable

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
ROLES = {SYSTEM: "system", USER: "user", ASSISTANT: "assistant"}
# The automaton: which message may follow in which state, and where a conversation may end.
LEGAL = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
FINAL = (ASSISTANT,)
MERGE, INSERT, RELABEL = 1, 2, 3
BIG = 1 << 40

# Turns of a part: no conversation is repaired beyond it in one go. Rows that are handed on together.
PART, BATCH = 1 << 16, 4096

OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


@dataclass(frozen=True)
class Move:
    """One way to take a turn: an empty message of role ``empty`` before it (or None), its role, how, the cost."""

    after: int
    empty: int | None
    action: str
    cost: int


def moves(state: int, role: str | None) -> list[Move]:
    """All ways to take a turn of ``role`` in ``state``, in order of preference among equal costs."""
    out = []
    for target in (SYSTEM, USER, ASSISTANT):
        changed = 0 if ROLES[target] == role else RELABEL
        if target in LEGAL[state]:
            out.append(Move(target, None, "relabel" if changed else "keep", changed))
        if target == state:
            out.append(Move(target, None, "relabel+merge" if changed else "merge", changed + MERGE))
        for empty in LEGAL[state]:
            if target in LEGAL[empty]:
                out.append(Move(target, empty, "relabel" if changed else "keep", changed + INSERT))
    return sorted(out, key=lambda m: m.cost)


def best_moves(role: str | None) -> dict[tuple[int, int], Move]:
    """The cheapest move for each state before and after."""
    out: dict[tuple[int, int], Move] = {}
    for state in STATES:
        for move in moves(state, role):
            out.setdefault((state, move.after), move)
    return out


KNOWN = {role: best_moves(role) for role in (*ROLES.values(), None)}


def closing(state: int) -> tuple[int, tuple[int, ...]]:
    """Cost and empty messages that end a conversation in ``state``."""
    empties: tuple[int, ...] = ()
    while state not in FINAL:
        state = LEGAL[state][-1]  # the way on that is not the optional system message
        empties += (state,)
    return INSERT * len(empties), empties


def _costs(role: str | None) -> np.ndarray:
    table = np.full((4, 4), BIG, np.int64)
    for (a, b), move in KNOWN[role].items():
        table[a, b] = move.cost
    return table


COSTS = {role: _costs(role) for role in KNOWN}


def known_role(role: str | None) -> str | None:
    """One of the automaton's roles, white space and case apart; None for any other."""
    name = (role or "").strip().lower()
    return name if name in ROLES.values() else None


def stretch_costs(roles: list[str | None]) -> np.ndarray:
    """The cheapest cost from each state to each state over a stretch of turns."""
    table = np.where(np.eye(4, dtype=bool), 0, BIG).astype(np.int64)
    for role in roles:
        table = np.minimum((table[:, :, None] + COSTS[role][None, :, :]).min(axis=1), BIG)
    return table


def repair(roles: list[str | None], start: int = START, end: int | None = None) -> tuple[int, list[Move]]:
    """The cheapest moves for a stretch of turns, and their cost.

    From state ``start`` to state ``end``; without ``end`` to the end of a conversation.
    Among equally cheap ways the smallest state after each turn is taken, from the last turn back.
    """
    costs = [BIG] * 4
    costs[start] = 0
    back: list[list[int]] = []
    for role in roles:
        table, new, from_ = COSTS[role], [BIG] * 4, [0] * 4
        for b in STATES:
            for a in STATES:
                if costs[a] + table[a][b] < new[b]:
                    new[b], from_[b] = costs[a] + int(table[a][b]), a
        costs = new
        back.append(from_)
    state = end if end is not None else min(STATES, key=lambda s: (costs[s] + closing(s)[0], s))
    total, out = costs[state] + (0 if end is not None else closing(state)[0]), []
    for role, from_ in zip(reversed(roles), reversed(back)):
        out.append(KNOWN[role][from_[state], state])
        state = from_[state]
    return total, out[::-1]


def _clean(text: str | None) -> str:
    """A text whose markers, if any, cannot be taken for ours."""
    return (text or "").replace("<|im_", "< |im_")


def _runs(keys: list) -> list[tuple[int, int]]:
    edges = [0, *[i for i in range(1, len(keys)) if keys[i] != keys[i - 1]], len(keys)]
    return [(a, b) for a, b in zip(edges, edges[1:]) if a < b]


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, int, bool, bool]]:
    """Runs of equal parts and conversations, batch by batch; whether a part begins there, and whether a conversation does."""
    last = None
    for batch in batches:
        keys = list(zip(batch.column("part").to_pylist(), batch.column("conv").to_pylist()))
        for a, b in _runs(keys):
            new_part = last is None or last[0] != keys[a][0]
            yield batch, a, b, new_part, new_part or last[1] != keys[a][1]
            last = keys[a]


NAMES = (*ROLES.values(), None)


def _borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first and the last conversation of each part with their turns and cost matrices."""
    kept: list[list] = []

    def ready() -> pa.RecordBatch:
        ends = kept[:1] + kept[-1:] * (len(kept) > 1)
        return pa.record_batch({
            "part": pa.array([p for p, _, _ in ends], pa.int64()),
            "conv": pa.concat_arrays([c for _, c, _ in ends]),
            "turns": pa.array([len(r) for *_, r in ends], pa.int64()),
            "costs": pa.array([stretch_costs([NAMES[r] for r in roles]).ravel().tolist() for *_, roles in ends], pa.list_(pa.int64())),
        })

    for batch, a, b, new_part, new_conv in _stretches(batches):
        if new_part and kept:
            yield ready()
            kept = []
        if new_conv:
            # Between the first and the last conversation nothing is kept.
            kept = [*kept[:1], [batch.column("part")[a].as_py(), batch.column("conv").slice(a, 1), bytearray()]]
        kept[-1][2].extend(NAMES.index(known_role(r)) for r in batch.column("role").slice(a, b - a).to_pylist())
    if kept:
        yield ready()


@dataclass(frozen=True)
class Place:
    """Where a stretch stands in its conversation: turns before it, its states, whether it begins or ends it."""

    before: int = 0
    start: int = START
    end: int | None = None
    first: bool = True
    last: bool = True
    conv: object = None


def _join_stretches(rows: list) -> dict[tuple[int, bool], Place]:
    """The place of each stretch of a cut conversation, by partition and whether it is the partition's first."""
    stretches: list[list[tuple[int, bool, int, np.ndarray]]] = []
    last_conv, seen, convs = object(), set(), {}
    for r in sorted(rows, key=lambda r: r["part"]):
        is_first = r["part"] not in seen
        seen.add(r["part"])
        item = (r["part"], is_first, r["turns"], np.array(r["costs"]).reshape(4, 4))
        # ``conv`` tells a partition's last conversation from those before it.
        if is_first and stretches and r["conv"] == last_conv:
            stretches[-1].append(item)
        else:
            stretches.append([item])
        last_conv = r["conv"]
        convs[r["part"], is_first] = r["conv"]
    out = {}
    for chain in stretches:
        if len(chain) < 2:
            continue
        costs, back = [0, BIG, BIG, BIG], []
        for *_, table in chain:
            ways = np.array(costs)[:, None] + table
            back.append(ways.argmin(axis=0))
            costs = ways.min(axis=0).tolist()
        state = min(STATES, key=lambda s: (costs[s] + closing(s)[0], s))
        ends = [state]
        for from_ in reversed(back):
            state = int(from_[state])
            ends.append(state)
        ends.reverse()
        before = 0
        for i, (part, is_first, turns, _) in enumerate(chain):
            last = i == len(chain) - 1
            out[part, is_first] = Place(before, ends[i], None if last else ends[i + 1], i == 0, last, convs[part, is_first])
            before += turns
    return out


class _Stretch:
    """The turns of one conversation that lie in one part."""

    def __init__(self, conv, place: Place):
        self.conv, self.place = conv, place
        self.turns, self.roles, self.texts = [], [], []

    def rendered(self) -> list[tuple]:
        state, rank, rows = self.place.start, self.place.before, []

        def begin(role: int) -> str:
            return (CLOSE + "\n") * (state != START) + OPEN + ROLES[role] + "\n"

        _, taken = repair([known_role(r) for r in self.roles], self.place.start, self.place.end)
        for move, turn, text in zip(taken, self.turns, self.texts):
            if move.empty is not None:
                rows.append((self.conv, 2 * rank, None, ROLES[move.empty], "insert", begin(move.empty)))
                state = move.empty
            lead = "\n" if move.action.endswith("merge") else begin(move.after)
            rows.append((self.conv, 2 * rank + 1, turn, ROLES[move.after], move.action, lead + _clean(text)))
            state, rank = move.after, rank + 1
        if self.place.last:
            for i, empty in enumerate(closing(state)[1]):
                rows.append((self.conv, 2 * rank + i, None, ROLES[empty], "insert", CLOSE + "\n" + OPEN + ROLES[empty] + "\n"))
            *rest, piece = rows[-1]
            rows[-1] = (*rest, piece + CLOSE + "\n")
        return rows


def _render(places: dict[tuple[int, bool], Place]):
    """Renders the turns batch by batch; what stays in memory is one conversation of one part."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        stretch, kinds = None, None

        def ready() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["conv", "position", "turn", "role", "action", "rendered"]
            )
            rows.clear()
            return out

        for batch, a, b, new_part, new_conv in _stretches(batches):
            if kinds is None:
                conv_kind, turn_kind = (batch.schema.field(n).type for n in ("conv", "turn"))
                kinds = (conv_kind, pa.int64(), turn_kind, pa.string(), pa.string(), pa.string())
            if new_conv:
                if stretch is not None:
                    rows += stretch.rendered()
                if len(rows) >= BATCH:
                    yield ready()
                part, conv = batch.column("part")[a].as_py(), batch.column("conv")[a].as_py()
                place = places.get((part, new_part), Place())
                # Of a part's later conversations only the last one may go on in the next part.
                stretch = _Stretch(conv, place if new_part or place.conv == conv else Place())
            for held, column in ((stretch.turns, "turn"), (stretch.roles, "role"), (stretch.texts, "text")):
                held += batch.column(column).slice(a, b - a).to_pylist()
        if stretch is not None:
            rows += stretch.rendered()
            yield ready()

    return pieces


def format_chats(
    turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """One row per turn and per inserted empty message of the repaired conversations.

    Columns: conversation, ``position`` (order in the conversation; an odd number for a
    turn, the even number before it for an empty message put in front of it), turn (null
    if inserted), ``role`` after repair, ``action`` (keep, merge, relabel, relabel+merge,
    insert) and ``rendered``. The pieces of a conversation joined in order of ``position``
    are its rendering.

    Turns are ordered by number (null first), then role and text; repeated rows are turns of
    their own. Roles count without case and surrounding white space; null and unknown
    roles have to be relabelled. A null text is empty. Rows without a conversation number
    form one conversation. Markers inside texts are broken with a space. An empty table
    gives no rows.
    """
    kinds = dict(turns.dtypes)
    named = turns.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"),
        F.col(text_col).cast("string").alias("text"),
    )
    # The last key lets a partition border fall between equal rows. Within a partition, parts follow the place of a row.
    keys = ["conv", "turn", "role", "text", "tie"]
    dealt = named.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    place = F.monotonically_increasing_id()
    inside = F.floor(place.bitwiseAND(F.lit((1 << 33) - 1)) / PART).cast("long")
    dealt = durable(dealt.withColumn("part", F.shiftleft(F.shiftright(place, 33), 33) + inside).drop("tie"))
    cut = dealt.select("part", "conv", "role").mapInArrow(
        _borders, f"part long, conv {kinds[conv_col]}, turns long, costs array<long>"
    ).collect()
    pieces = dealt.mapInArrow(
        _render(_join_stretches(cut)),
        f"conv {kinds[conv_col]}, position long, turn {kinds[turn_col]}, role string, action string, rendered string",
    )
    return pieces.select(F.col("conv").alias(conv_col), "position", F.col("turn").alias(turn_col), "role", "action", "rendered")
