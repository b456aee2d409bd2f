"""Repair of conversations: cheapest edits by the auction shortest-path algorithm.

The turns of a conversation and what the repaired text ends with so far span a
lattice; keeping, renaming, deleting and inserting are its arcs, of whole cost.
Every node has a price, at most the cost of any arc out of it plus the price of
the node that the arc leads to. A path from the start is extended along an arc
that makes this an equality, or else the price of its last node rises and the
path contracts by one node. When it has arrived, its length is the price of the
start, every arc of every cheapest path is tight, and of these paths the one
whose edits come first in the alphabet is traced over tight arcs.

Turns come sorted and cut into chunks. Most conversations are one chunk. Of a
longer one, of any length, each chunk gives the costs from each state to each
state; a pass backward over these gives every chunk the costs that still follow,
and a pass forward the state it begins with. Only then are its edits traced, so
no task holds more turns than a chunk has.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bronzeflow.llm.common import SPACE, scratch

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5
#: What the repaired text ends with: nothing, the system's turn, the user's, the assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Role that may follow each state, and the state after it.
NEXT = {START: ("user", USER), SYSTEM: ("user", USER), USER: ("assistant", ASSISTANT), ASSISTANT: ("user", USER)}
#: Cost to end in each state, and what has to be inserted to do so.
ENDING = [0, 2 * INSERT, INSERT, 0]
ADDED = [[], ["user", "assistant"], ["assistant"], []]
LEGAL = {"su", "ua", "au"}
#: Turns of a chunk, and characters from which it is closed.
CHUNK, CHUNK_CHARS = 128, 1 << 20
#: Chunks of a record batch.
BATCH = 256

NEVER = -1  # a cost that cannot be had


class Turn(NamedTuple):
    role: str
    text: str
    first: bool  # of its role and text in the conversation
    copies: int  # equal turns in a row


class Arc(NamedTuple):
    letter: str
    cost: int
    to: int
    role: str | None  # of the turn that the repaired text gets


def is_blank(text: str) -> bool:
    return not text.strip(SPACE)


def is_truncated(text: str) -> bool:
    return text.rstrip(SPACE)[-1:] not in (".", "!", "?")


def lattice(turns: list[Turn]) -> tuple[list[list[Arc]], list[int]]:
    """Arcs out of each node ``4 * layer + state``, and a first price of each layer.

    The copies of a turn after its first are deleted in one arc. The last layer
    has no arcs: it is the first one of what follows.
    """
    arcs: list[list[Arc]] = []
    least: list[int] = []
    for layer, turn in enumerate(turns):
        forced = is_blank(turn.text) or not turn.first
        surplus = turn.copies if forced else turn.copies - 1
        extra = 0 if forced or not is_truncated(turn.text) else CUT_OFF
        least.append(DELETE * surplus + (0 if forced else min(DELETE, extra)))
        for state in range(4):
            role, after = NEXT[state]
            out = [Arc("D" * turn.copies, DELETE * turn.copies, 4 * (layer + 1) + state, None)]
            out.append(Arc("I", INSERT, 4 * layer + after, role))
            if not forced:
                rest, paid = "D" * surplus, extra + DELETE * surplus
                if turn.role[:1] == role[0]:
                    out.append(Arc("K" + rest, KEEP + paid, 4 * (layer + 1) + after, turn.role))
                elif state == START and turn.role[:1] == "s":
                    out.append(Arc("K" + rest, KEEP + paid, 4 * (layer + 1) + SYSTEM, turn.role))
                if turn.role[:1] != role[0]:
                    out.append(Arc("R" + rest, REROLE + paid, 4 * (layer + 1) + after, role))
            arcs.append(out)
    floor = [0]
    for cost in reversed(least):
        floor.append(floor[-1] + cost)
    return arcs, floor[::-1]


class Auction:
    """Cheapest paths through a lattice to its end, which costs ``ending`` by state."""

    def __init__(self, turns: list[Turn], ending: list[int]) -> None:
        arcs, floor = lattice(turns)
        self.goal = len(arcs) + 4
        least = min(c for c in ending if c != NEVER)
        self.base = least
        last = [[Arc("", c - least, self.goal, None)] if c != NEVER else [] for c in ending]
        self.arcs = arcs + last
        # Nodes without a way to the goal would be bid for without end.
        alive = [False] * self.goal + [True]
        for layer in range(len(turns), -1, -1):
            for _ in range(3):  # insertions lead on within a layer
                for node in range(4 * layer, 4 * layer + 4):
                    alive[node] = alive[node] or any(alive[a.to] for a in self.arcs[node])
        self.alive = alive
        self.arcs = [[a for a in out if alive[a.to]] for out in self.arcs]
        self.price = [floor[node // 4] for node in range(self.goal)] + [0]

    def cost(self, state: int) -> int:
        """From a state of the first layer; NEVER if there is no way."""
        if not self.alive[state]:
            return NEVER
        price, path = self.price, [state]
        while path[-1] != self.goal:
            node = path[-1]
            bid, to = min((a.cost + price[a.to], a.to) for a in self.arcs[node])
            if price[node] < bid:
                price[node] = bid
                if len(path) > 1:
                    path.pop()
            else:
                path.append(to)
        return price[state] + self.base

    def trace(self, state: int) -> list[Arc]:
        """The cheapest path whose letters come first in the alphabet, over tight arcs."""
        self.cost(state)
        price = self.price
        good = [False] * self.goal + [True]
        for layer in range(self.goal // 4 - 1, -1, -1):
            for _ in range(3):
                for node in range(4 * layer, 4 * layer + 4):
                    good[node] = good[node] or any(
                        good[a.to] and price[node] == a.cost + price[a.to] for a in self.arcs[node]
                    )
        path, node = [], state
        while node != self.goal:
            tight = [a for a in self.arcs[node] if good[a.to] and price[node] == a.cost + price[a.to]]
            path.append(min(tight, key=lambda a: a.letter[:1]))
            node = path[-1].to
        return path


@dataclass
class Piece:
    """What a chunk adds to its conversation; ``join`` puts the next chunk behind it."""

    rows: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    first_role: str | None = None
    last_role: str | None = None
    turns: int = 0  # different ones that are not null
    least_turn: int | None = None
    most_turn: int | None = None
    cost: int = 0

    def see(self, number: int | None, turn: Turn) -> None:
        initial = turn.role[:1]
        if self.last_role is None:
            self.first_role = initial
        elif self.last_role + initial not in LEGAL:
            self.illegal += 1
        self.illegal += turn.copies - 1  # a role does not follow itself
        self.last_role = initial
        self.rows += turn.copies
        if is_blank(turn.text):
            self.blank += turn.copies
        else:
            self.duplicate += turn.copies - turn.first
            self.truncated += turn.first and is_truncated(turn.text)
        if number is not None and number != self.most_turn:
            self.turns += 1
            self.least_turn = number if self.least_turn is None else self.least_turn
            self.most_turn = number

    def join(self, after: Piece) -> None:
        if after.rows == 0:
            return
        if self.rows and self.last_role + after.first_role not in LEGAL:
            self.illegal += 1
        self.first_role = after.first_role if self.rows == 0 else self.first_role
        self.last_role = after.last_role
        for name in ("rows", "blank", "duplicate", "truncated", "illegal", "cost"):
            setattr(self, name, getattr(self, name) + getattr(after, name))
        if after.turns:
            self.turns += after.turns - (after.least_turn == self.most_turn)
            self.least_turn = after.least_turn if self.least_turn is None else self.least_turn
            self.most_turn = after.most_turn

    @property
    def gaps(self) -> int:
        return self.most_turn - self.least_turn + 1 - self.turns if self.turns else 0


COUNTS = list(Piece.__dataclass_fields__)
_PIECE = ", ".join(f"{c} {'string' if c.endswith('role') else 'long'}" for c in COUNTS)
PIECE_SCHEMA = f"name string, at long, audit string, repaired array<struct<role string, text string>>, {_PIECE}"


def repair(conversations: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """One row per chunk of a conversation, in the order of ``at``: what became of its turns.

    ``conversations`` has ``conv_id, turn, role, text, copies``: rows with no
    copies only say that the conversation is there. ``audit`` holds the edits,
    ``repaired`` the turns that are left, renamed or inserted, and ``cost`` the
    cost of the chunk's edits; the other columns are counts of ``Piece``.

    * Turns are ordered by ``turn``, nulls first; equal ones by role, then by
      text. Repeated rows are turns of their own, next to each other.
    * A null role or text is empty. A null ``conv_id`` is a conversation like any
      other. Other columns are not looked at. An empty table gives no rows.
    * Very long texts close a chunk early; very long conversations have many
      chunks.
    """
    folded = _folded(conversations)
    laid = folded.repartitionByRange("name", "turn", "role", F.left("text", F.lit(64)))
    ordered = laid.sortWithinPartitions("name", "turn", "role", "text").select(
        "name", "turn", "role", "text", "copies"
    )
    chunks = scratch(ordered.mapInArrow(_packer(chunk), _CHUNKS), "dialogues-chunks")
    ways = chunks.select("*", *_no_context()).where("alone")
    some = _with_context(chunks.where("NOT alone"))
    return ways.unionByName(some).mapInArrow(_tracer, PIECE_SCHEMA)


def _named(conversations: DataFrame) -> DataFrame:
    """With a text that names the conversation, a null id too."""
    text = F.concat(F.lit("="), F.col("conv_id").cast("string"))
    return conversations.withColumn("name", F.coalesce(text, F.lit("")))


def _folded(conversations: DataFrame) -> DataFrame:
    """Equal turns as one row, so that a turn repeated any number of times moves once a task."""
    there = F.col("copies") > 0
    rows = _named(conversations.select("conv_id", "turn", "role", "text", "copies")).select(
        "name",
        F.when(there, F.col("turn").cast("long")).alias("turn"),
        F.when(there, F.coalesce("role", F.lit(""))).otherwise("").alias("role"),
        F.when(there, F.coalesce("text", F.lit(""))).otherwise("").alias("text"),
        F.greatest("copies", F.lit(0)).cast("long").alias("copies"),
    )
    return rows.groupBy("name", "turn", "role", "text").agg(F.sum("copies").alias("copies"))


_CHUNKS = (
    "name string, at long, alone boolean,"
    " turns array<struct<turn long, role string, text string, copies long>>"
)
_TURNS = pa.list_(
    pa.struct([("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("copies", pa.int64())])
)


def _batches(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    some: list[dict] = []
    for row in rows:
        some.append(row)
        if len(some) == BATCH:
            yield pa.RecordBatch.from_pylist(some, schema)
            some = []
    if some:
        yield pa.RecordBatch.from_pylist(some, schema)


def _packer(most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Chunks of the sorted turns of a partition.

    ``alone`` is a chunk that is known to hold its whole conversation: the first
    and the last conversation of a partition may go on in others.
    """
    schema = pa.schema(
        [("name", pa.string()), ("at", pa.int64()), ("alone", pa.bool_()), ("turns", _TURNS)]
    )

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        base = TaskContext.get().partitionId() << 40
        made, chars, begun = 0, 0, 0
        name: str | None = None
        turns: list[dict] = []

        def closed(alone: bool) -> dict:
            nonlocal made, chars, turns
            row = {"name": name, "at": base + made, "alone": alone, "turns": turns}
            made, chars, turns = made + 1, 0, []
            return row

        split = False
        for batch in batches:
            for row in batch.to_pylist():
                if row["name"] != name:
                    if turns:
                        yield closed(begun > 1 and not split)
                    name, split, begun = row["name"], False, begun + 1
                elif len(turns) >= most or chars >= CHUNK_CHARS:
                    yield closed(False)
                    split = True
                turns.append({k: row[k] for k in ("turn", "role", "text", "copies")})
                chars += len(row["text"])
        if turns:
            yield closed(False)

    return lambda batches: _batches(chunks(batches), schema)


def _no_context() -> list:
    return [
        F.lit(None).cast("array<binary>").alias("seen"),
        F.array(*[F.lit(c) for c in ENDING]).cast("array<long>").alias("ending"),
        F.lit(START).alias("state"),
        F.lit(True).alias("last"),
    ]


def _with_context(chunks: DataFrame) -> DataFrame:
    """Chunks of conversations that may have several, each with what it has to know.

    ``seen``: names of turns that stand in an earlier chunk. ``ending``: cost of
    what follows, by the state the chunk ends with. ``state``: what it begins with.
    """
    turns = chunks.mapInArrow(_turn_names, "name string, at long, turn binary")
    firsts = turns.groupBy("name", "turn").agg(F.min("at").alias("first"))
    again = turns.join(firsts, ["name", "turn"]).where(F.col("at") > F.col("first"))
    # As many as a chunk has turns, at most.
    seen = again.groupBy("name", "at").agg(F.collect_list("turn").alias("seen"))
    known = scratch(chunks.join(seen, ["name", "at"], "left"), "dialogues-known")

    costs = known.mapInArrow(_crossing, "name string, at long, costs array<long>")
    backward = costs.repartition("name").sortWithinPartitions("name", F.desc("at"))
    endings = scratch(
        backward.mapInArrow(_backward, "name string, at long, ending array<long>, last boolean"),
        "dialogues-endings",
    )
    bound = known.join(endings, ["name", "at"])
    exits = bound.mapInArrow(_exits, "name string, at long, exits array<int>")
    forward = exits.repartition("name").sortWithinPartitions("name", "at")
    states = scratch(
        forward.mapInArrow(_forward, "name string, at long, state int"), "dialogues-states"
    )
    return bound.join(states, ["name", "at"]).select(
        "name", "at", "alone", "turns", "seen", "ending", "state", "last"
    )


def _key(turn: dict) -> bytes:
    role = turn["role"].encode()
    return hashlib.sha256(b"%d:" % len(role) + role + turn["text"].encode()).digest()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for i in range(batch.num_rows):
            yield {n: c[i].as_py() for n, c in zip(batch.schema.names, batch.columns)}


def _turn_names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("name", pa.string()), ("at", pa.int64()), ("turn", pa.binary())])

    def rows() -> Iterator[dict]:
        for chunk in _rows(batches):
            for key in {_key(t) for t in chunk["turns"] if t["copies"]}:
                yield {"name": chunk["name"], "at": chunk["at"], "turn": key}

    return _batches(rows(), schema)


def turns_of(chunk: dict) -> list[Turn]:
    """The turns of a chunk, marked whether they are the first of their kind."""
    known = set(chunk["seen"] or ())
    met: set[tuple[str, str]] = set()
    turns = []
    for t in chunk["turns"]:
        if t["copies"]:
            kind = (t["role"], t["text"])
            first = kind not in met and not (known and _key(t) in known)
            met.add(kind)
            turns.append(Turn(*kind, first, t["copies"]))
    return turns


def _crossing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cost from each state to each state, by auctions for one end state at a time."""
    schema = pa.schema([("name", pa.string()), ("at", pa.int64()), ("costs", pa.list_(pa.int64()))])

    def rows() -> Iterator[dict]:
        for chunk in _rows(batches):
            turns, to = turns_of(chunk), []
            for end in range(4):
                auction = Auction(turns, [0 if s == end else NEVER for s in range(4)])
                to.append([auction.cost(state) for state in range(4)])
            costs = [to[end][state] for state in range(4) for end in range(4)]
            yield {"name": chunk["name"], "at": chunk["at"], "costs": costs}

    return _batches(rows(), schema)


def _backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cost of what follows each chunk; chunks come last one first."""
    kinds = [pa.string(), pa.int64(), pa.list_(pa.int64()), pa.bool_()]
    schema = pa.schema(list(zip(("name", "at", "ending", "last"), kinds)))

    def rows() -> Iterator[dict]:
        name, ending = None, ENDING
        for r in _rows(batches):
            last = r["name"] != name
            name, ending = r["name"], ENDING if last else ending
            yield {"name": name, "at": r["at"], "ending": ending, "last": last}
            ways = [[(r["costs"][4 * s + t], ending[t]) for t in range(4)] for s in range(4)]
            ending = [min(c + e for c, e in way if c != NEVER and e != NEVER) for way in ways]

    return _batches(rows(), schema)


def _exits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state that a chunk ends with, by the state it begins with."""
    schema = pa.schema([("name", pa.string()), ("at", pa.int64()), ("exits", pa.list_(pa.int32()))])

    def rows() -> Iterator[dict]:
        for chunk in _rows(batches):
            turns = turns_of(chunk)
            auction = Auction(turns, chunk["ending"])
            exits = [_last_state(auction.trace(s), s) for s in range(4)]
            yield {"name": chunk["name"], "at": chunk["at"], "exits": exits}

    return _batches(rows(), schema)


def _last_state(path: list[Arc], state: int) -> int:
    return path[-2].to % 4 if len(path) > 1 else state


def _forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("name", pa.string()), ("at", pa.int64()), ("state", pa.int32())])

    def rows() -> Iterator[dict]:
        name, state = None, START
        for r in _rows(batches):
            name, state = r["name"], state if r["name"] == name else START
            yield {"name": name, "at": r["at"], "state": state}
            state = r["exits"][state]

    return _batches(rows(), schema)


def _tracer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    repaired = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
    fields = [("name", pa.string()), ("at", pa.int64()), ("audit", pa.string()), ("repaired", repaired)]
    fields += [(c, pa.string() if c.endswith("role") else pa.int64()) for c in COUNTS]
    schema = pa.schema(fields)

    def rows() -> Iterator[dict]:
        for chunk in _rows(batches):
            turns, piece, kept = turns_of(chunk), Piece(), []
            numbers = [t["turn"] for t in chunk["turns"] if t["copies"]]
            for number, turn in zip(numbers, turns):
                piece.see(number, turn)
            path, layer = Auction(turns, chunk["ending"]).trace(chunk["state"])[:-1], 0
            for arc in path:
                if arc.role is not None:
                    text = "" if arc.letter == "I" else turns[layer].text
                    kept.append({"role": arc.role, "text": text})
                layer = arc.to // 4
            audit = "".join(a.letter for a in path)
            piece.cost = sum(a.cost for a in path)
            if chunk["last"]:
                added = ADDED[path[-1].to % 4 if path else chunk["state"]]
                kept += [{"role": role, "text": ""} for role in added]
                audit += "I" * len(added)
                piece.cost += INSERT * len(added)
            yield {"name": chunk["name"], "at": chunk["at"], "audit": audit, "repaired": kept} | vars(piece)

    return _batches(rows(), schema)


def repaired_turns(pieces: DataFrame) -> DataFrame:
    """``(name, at, position, role, text)``: the repaired turns, in order of the first three."""
    rows = pieces.select("name", "at", F.posexplode("repaired").alias("position", "turn"))
    return rows.select("name", "at", "position", "turn.role", "turn.text")


def summaries(pieces: DataFrame) -> DataFrame:
    """One row per conversation: counts, gaps, cost, whole audit, digest of the repaired turns.

    The digest is that of ``role:text`` of all turns, joined by line feeds. A
    digest is one running state, so the pieces of a conversation pass one task in
    order; it holds none of them but the audit, which is part of the row.
    """
    schema = (
        "name string, gaps long, blank long, duplicate long, truncated long, illegal long,"
        " cost long, audit string, repaired_sha256 string"
    )
    # Only pieces are moved, the repaired turns as one text each.
    slim = pieces.withColumn(
        "repaired", F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    )
    return slim.repartition("name").sortWithinPartitions("name", "at").mapInArrow(_summer, schema)


def _summer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    columns = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    kinds = [("name", pa.string()), *[(c, pa.int64()) for c in columns]]
    schema = pa.schema([*kinds, ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def rows() -> Iterator[dict]:
        name, whole, audit, digest, empty = None, Piece(), [], hashlib.sha256(), True

        def row() -> dict:
            counts = {c: getattr(whole, c) for c in columns}
            return {"name": name, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()} | counts

        for r in _rows(batches):
            if r["name"] != name:
                if name is not None:
                    yield row()
                name, whole, audit, digest, empty = r["name"], Piece(), [], hashlib.sha256(), True
            whole.join(Piece(**{c: r[c] for c in COUNTS}))
            audit.append(r["audit"])
            for turn in r["repaired"]:
                digest.update(turn.encode() if empty else b"\n" + turn.encode())
                empty = False
        if name is not None:
            yield row()

    return _batches(rows(), schema)
