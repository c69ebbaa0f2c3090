"""Conversation repair: the cheapest edits by Knuth's lightest derivation.

A conversation's rows, in order, are to become ``(s?(ua)+)?`` in the initials of their roles.
Edits and costs: Keep 0, Rerole to user or assistant 1, Delete 2 (forced for blank and for
duplicate rows), Insert an empty user or assistant turn 5; a truncated row that stays adds 5.

Deduction items, weights (cost, audit) with the audit the edits' initials so far:

* ``Edit(i, p, q)``: an axiom, row i takes the automaton from state p to q;
* ``Reach(i, q)``: rows before i are repaired and the state is q.  ``Reach(i, p)`` and
  ``Edit(i, p, q)`` derive ``Reach(i + 1, q)``; an insertion derives ``Reach(i, q)`` from
  ``Reach(i, p)``.

Costs add and audits concatenate, so a conclusion weighs no less than what it is derived from
(a superior function), and the agenda, popped by (cost, audit), finalises every item at its
lightest weight.  Of equal costs neither audit is a prefix of the other (what it had more would
be insertions, which cost), so a lighter item stays lighter in all that follows from it.

A conversation may be long: rows arrive sorted, and after ``SEGMENT`` rows the agenda's
last items (cost, rank of the audit, sha256 state, one of each per automaton state) start the next
segment, so a task holds a segment's texts and the audits, not the conversation.

Spark's side: rows are dealt by conversation and sorted in one shuffle; each distinct (role,
text) of a conversation, pre-aggregated to its first turn, is a thin row sorted before the
row that it stands for, so a row without one before it is a duplicate and no task
remembers what it has seen.  One conversation is one task's stream by nature: sha256 is sequential.

Nulls and edge cases: a null text or role is one space (and blank, or no legal initial); a null
conv_id is one conversation; null turns come first; rows of one turn are ordered by role, then by
their text's sha256; repeated rows are duplicates; a conversation without rows has zeros, an
empty audit and the hash of an empty string; an empty table gives no rows; other columns
are ignored, also where their names are those used here.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cyclonespark.llm.common import SPACE, ship

COLUMNS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
#: what a row in the sorted stream is
MARKER, FIRST, TURN = 0, 1, 2
#: rows between two hand-overs of the agenda
SEGMENT = 128
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: automaton states: nothing yet, after s, after u, after a; the role that leads from one to another
NEXT = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
ACCEPT = (0, 3)
ROLES = {"u": "user", "a": "assistant"}

_LEGAL = {"su", "ua", "au"}


class Row(NamedTuple):
    role: str
    text: str
    gone: bool  # blank or duplicate
    truncated: bool


def damage(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text with each row damaged by crc32(``conv_id:turn``) % 20."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    plain = rows.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), (F.crc32(F.encode(F.concat(space("conv_id"), F.lit(":"), space("turn")), "utf-8")) % 20).alias("_kind"))
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    hurt = plain.filter("_kind <> 0").select("conv_id", "turn", F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), "_kind")
    return hurt.withColumn("_copy", F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("_kind", "_copy")


class Agenda:
    """Knuth's generalisation of Dijkstra's algorithm: items are finalised lightest first."""

    def __init__(self) -> None:
        self.queue: list[tuple] = []
        self.done: dict[tuple, tuple] = {}

    def push(self, item: tuple, weight: tuple, why: tuple = ()) -> None:
        if item not in self.done:
            heapq.heappush(self.queue, (weight, item, why))

    def pop(self) -> tuple | None:
        """The next item to be finalised, or None."""
        while self.queue:
            weight, item, why = heapq.heappop(self.queue)
            if item not in self.done:
                self.done[item] = (weight, why)
                return item
        return None


def edits(row: Row) -> Iterator[tuple[int, int, int, str]]:
    """(state before, state after, cost, initial) of what can be done to one row."""
    stays = TRUNCATED if row.truncated else 0
    for p, roles in NEXT.items():
        yield p, p, DELETE, "D"
        if not row.gone:
            for role, q in roles.items():
                if row.role[:1] == role:
                    yield p, q, stays, "K"
                if role in ROLES:
                    yield p, q, REROLE + stays, "R"


def derive(rows: list[Row], starts: dict[int, tuple[int, int]], last: bool) -> dict[int, tuple[int, int, str]]:
    """The lightest (cost, rank at the start, audit from there) of each state after ``rows``.

    ``starts``: (cost, rank) by state.  Insertions after the last row are made only where the conversation
    ends (``last``); elsewhere the next segment makes them.
    """
    agenda, by_state = Agenda(), {}
    for i, row in enumerate(rows):
        for p, q, cost, initial in edits(row):
            agenda.push(("edit", i, p, q), (cost, -1, initial))
            by_state.setdefault((i, p), []).append(("edit", i, p, q))
    for state, (cost, rank) in starts.items():
        agenda.push(("reach", 0, state, state), (cost, rank, ""))

    def conclude(reach: tuple, edit: tuple) -> None:
        (cost, rank, audit), (more, _, initial) = agenda.done[reach][0], agenda.done[edit][0]
        agenda.push(("reach", edit[1] + 1, edit[3], edit[3]), (cost + more, rank, audit + initial))

    goals = {("reach", len(rows), q, q) for q in NEXT}
    while goals and (item := agenda.pop()):
        kind, i, p, q = item
        goals.discard(item)
        if kind == "edit":
            if (reach := ("reach", i, p, p)) in agenda.done:
                conclude(reach, item)
            continue
        for edit in by_state.get((i, p), ()):
            if edit in agenda.done:
                conclude(item, edit)
        if i < len(rows) or last:
            cost, rank, audit = agenda.done[item][0]
            for role, to in NEXT[p].items():
                if role in ROLES:
                    agenda.push(("reach", i, to, to), (cost + INSERT, rank, audit + "I"))
    return {item[2]: agenda.done[item][0] for item in (("reach", len(rows), q, q) for q in NEXT) if item in agenda.done}


def applied(rows: list[Row], audit: str, state: int) -> Iterator[tuple[str, str]]:
    """The (role, text) that an audit makes of ``rows`` from ``state`` on."""
    at = 0
    for initial in audit:
        row = None
        if initial != "I":
            row, at = rows[at], at + 1
        if initial == "D":
            continue
        role = row.role if initial == "K" else next(ROLES[r] for r in NEXT[state] if r in ROLES)
        state = NEXT[state][role[:1]]
        yield role, row.text if row else ""


class Conversation:
    """The running result of one conversation."""

    def __init__(self, conv_id) -> None:
        self.conv_id = conv_id
        self.segment: list[Row] = []
        self.paths = {0: (0, 0, (), hashlib.sha256(), True)}  # state: cost, rank, audit pieces (linked), digest, nothing written yet
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.turn = self.before = None

    def add(self, turn, role: str, text: str, first: bool) -> None:
        if self.before is not None and self.before + role[:1] not in _LEGAL:
            self.illegal += 1
        self.before = role[:1]
        if turn is not None and turn != self.turn:
            self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = self.turn = turn
        end = text.rstrip(SPACE)
        blank, duplicate = not end, bool(end) and not first
        truncated = bool(end) and first and end[-1] not in ".!?"
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        if len(self.segment) >= SEGMENT:
            self.hand_over(False)
        self.segment.append(Row(role, text, blank or duplicate, truncated))

    def hand_over(self, last: bool) -> None:
        starts = {q: (cost, rank) for q, (cost, rank, *_) in self.paths.items()}
        origin = {rank: q for q, (_, rank, *_) in sorted(self.paths.items(), reverse=True)}
        found, paths = derive(self.segment, starts, last), {}
        ranks = {w: r for r, w in enumerate(sorted({(rank, audit) for _, rank, audit in found.values()}))}
        for q, (cost, rank, audit) in found.items():
            _, _, pieces, digest, empty = self.paths[origin[rank]]
            digest = digest.copy()
            for role, text in applied(self.segment, audit, origin[rank]):
                digest.update(f"{'' if empty else chr(10)}{role}:{text}".encode())
                empty = False
            paths[q] = (cost, ranks[rank, audit], (pieces, audit), digest, empty)
        self.paths, self.segment = paths, []

    def result(self) -> tuple:
        self.hand_over(True)
        cost, _, pieces, digest, _ = min((self.paths[q] for q in ACCEPT if q in self.paths), key=lambda x: x[:2])
        audit = []
        while pieces:
            pieces, piece = pieces
            audit.append(piece)
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return self.conv_id, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, "".join(reversed(audit)), digest.hexdigest()


def _stream(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One result a conversation, from rows in the order of ``repair``."""
    now, first, schema, out = None, False, None, []
    for batch in batches:
        schema = batch.schema.field("conv_id").type
        for conv_id, kind, turn, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "kind", "turn", "role", "text")), strict=True):
            if kind == MARKER:
                if now is not None:
                    out.append(now.result())
                now = Conversation(conv_id)
            elif kind == FIRST:
                first = True
            else:
                now.add(turn, role, text, first)
                first = False
        if out:
            yield _batch(out, schema)
            out = []
    if now is not None:
        yield _batch([now.result()], schema)


def _batch(out: list[tuple], conv_id: pa.DataType) -> pa.RecordBatch:
    kinds = [conv_id, *[pa.int64()] * 6, pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=list(COLUMNS))


def repair(rows: DataFrame, hurt: DataFrame | None = None) -> DataFrame:
    """``COLUMNS``, a row for each conv_id of ``rows``, whose turns (conv_id, turn, role, text without nulls
    in the latter two) are those of ``hurt``, by default ``rows`` as they are."""
    ship(rows.sparkSession)
    if hurt is None:
        space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c)
        hurt = rows.select("conv_id", "turn", space("role"), space("text"))
    place = F.when(F.col("turn").isNull(), 1).otherwise(2)
    turns = hurt.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", F.unhex(F.sha2("text", 256)).alias("digest"), "text")
    turns = turns.select("conv_id", place.alias("place"), "turn", "role", "digest", F.lit(TURN).alias("kind"), "text")
    firsts = turns.groupBy("conv_id", "role", "digest").agg(F.min(F.struct("place", "turn")).alias("at"))
    none = F.lit(None)
    firsts = firsts.select("conv_id", "at.place", "at.turn", "role", "digest", F.lit(FIRST).alias("kind"), none.cast("string").alias("text"))
    marks = rows.select("conv_id").distinct().select("conv_id", F.lit(0).alias("place"), none.cast("long").alias("turn"), F.lit("").alias("role"), none.cast("binary").alias("digest"), F.lit(MARKER).alias("kind"), none.cast("string").alias("text"))
    order = ["conv_id", "place", "turn", "role", "digest", "kind"]
    dealt = turns.unionByName(firsts).unionByName(marks).repartition("conv_id").sortWithinPartitions(*order)
    kinds = [rows.schema["conv_id"].dataType.simpleString(), *["long"] * 6, "string", "string"]
    return dealt.mapInArrow(_stream, ", ".join(f"{c} {k}" for c, k in zip(COLUMNS, kinds, strict=True)))
