"""Repair of the turn structure of conversations by an auction for the shortest path.

A conversation should be an optional system turn and then user and assistant turns
in alternation, or nothing. Each row is kept (0), given another role (1) or deleted
(2, the only choice for blank and duplicate rows); empty turns may be inserted (5);
a truncated row that is not deleted costs 5 more. The nodes of a lattice are (rows
read, last role written), its arcs the edits.

The auction gives every node a price, never above arc cost plus price of the arc's
end. The end node of a path either extends it along an arc where both are equal,
or raises its own price to the least such sum and leaves the path. A path that has
reached a node of final price makes the prices along it final. Starting places are
taken from the end of the conversation in steps of `STRIDE` rows, each using the
prices found before it, so the work grows with the number of rows. An arc is tight
if the price of its start is its cost plus the price of its end. Every cheapest
edit consists of tight arcs; among the tight arcs that lead on to the goal the one
of the least letter is followed, from all nodes reached at once.

Rows are dealt by conversation and sorted by turn, null first; rows of one turn are
ordered by role and text. They are read as a stream: of a conversation, a few
numbers a row stay in memory, and its texts beyond `SPOOL_BYTES` wait in a
temporary file of the task. The edits of one conversation are one sequence, so one
task makes them, however long it is.

A null role or text is one space (`damaged` does the same for ids and turns in its
checksum), so a row of null text is blank and one of null role must get another
role. Rows of a null conv_id are one conversation. Repeated rows are duplicates.
Other columns are ignored; an empty table stays empty.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from tempfile import SpooledTemporaryFile

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgermill.llm.arrays import small_batches

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
STRIDE = 16
SPOOL_BYTES = 4 << 20
OUT_ROWS = 2000

_SPACE = "\t\n\x0b\f\r "
_STATES = 4  # nothing written, system, user, assistant
_EMPTY, _SYSTEM, _USER, _ASSISTANT = range(_STATES)
# After each state: the state that a role leads to, where it may stand there.
_NEXT = ({"s": _SYSTEM, "u": _USER}, {"u": _USER}, {"a": _ASSISTANT}, {"u": _USER})
_WRITTEN = (_USER, _USER, _ASSISTANT, _USER)  # the role that a new or changed turn gets after each state
_LAWFUL = {"su", "ua", "au"}


@dataclass
class Rows:
    """What the lattice must know of a conversation's rows: role initial, forced deletion, truncation."""

    initials: list[str] = field(default_factory=list)
    forced: bytearray = field(default_factory=bytearray)
    truncated: bytearray = field(default_factory=bytearray)

    def add(self, initial: str, forced: bool, truncated: bool) -> None:
        self.initials.append(initial)
        self.forced.append(forced)
        self.truncated.append(truncated)

    def arcs(self, node: int) -> list[tuple[int, int, str]]:
        """Cost, end and letter of the arcs from a node; the goal has the number after the last."""
        at, state = divmod(node, _STATES)
        written = _WRITTEN[state]
        out = [(INSERT, node - state + written, "I")]
        if at == len(self.initials):
            if state in (_EMPTY, _ASSISTANT):
                out.append((0, node - state + _STATES, ""))
            return out
        below = (at + 1) * _STATES
        out.append((DELETE, below + state, "D"))
        if not self.forced[at]:
            more = TRUNCATED if self.truncated[at] else 0
            out.append((REROLE + more, below + written, "R"))
            kept = _NEXT[state].get(self.initials[at])
            if kept is not None:
                out.append((KEEP + more, below + kept, "K"))
        return out


def auction_prices(rows: Rows) -> array:
    """Prices at which all arcs of all cheapest paths from the start to the goal are tight."""
    n = len(rows.initials)
    goal = (n + 1) * _STATES
    price = array("q", bytes(8 * (goal + 1)))
    for at in range(n - 1, -1, -1):  # no path can avoid a forced deletion
        for state in range(_STATES):
            price[at * _STATES + state] = price[(at + 1) * _STATES + state] + (DELETE if rows.forced[at] else 0)
    final = bytearray(goal + 1)
    final[goal] = 1
    origins = [at * _STATES + state for at in range(n, 0, -STRIDE) for state in range(_STATES)]
    for origin in [*origins, 0]:
        path = [origin]
        while not final[path[-1]]:
            end = path[-1]
            least, ahead = min((cost + price[to], to) for cost, to, _ in rows.arcs(end))
            if price[end] < least:
                price[end] = least
                if len(path) > 1:
                    path.pop()
            else:
                path.append(ahead)
        for node in path:
            final[node] = 1
    return price


def cheapest_edits(rows: Rows) -> tuple[int, str]:
    """The least cost and, of the edit sequences of that cost, the letters of the least one."""
    price, n = auction_prices(rows), len(rows.initials)
    goal = (n + 1) * _STATES
    leads = bytearray(goal + 1)  # whether tight arcs lead on to the goal
    leads[goal] = 1
    for at in range(n, -1, -1):
        for _ in range(2):  # a second time for the ends of insertions, which are nodes of the same row
            for node in range(at * _STATES, (at + 1) * _STATES):
                leads[node] = leads[node] or any(
                    leads[to] and price[node] == cost + price[to] for cost, to, _ in rows.arcs(node)
                )
    letters, front = [], {0}
    while True:
        ways: dict[str, set[int]] = {}
        for node in front:
            for cost, to, letter in rows.arcs(node):
                if leads[to] and price[node] == cost + price[to]:
                    ways.setdefault(letter, set()).add(to)
        letter = min(ways)
        if not letter:
            return price[0], "".join(letters)
        letters.append(letter)
        front = ways[letter]


class Conversation:
    """The rows of one conversation as they come in; its figures and repaired turns at its end."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.rows = Rows()
        self.seen: set[tuple[int, int]] = set()
        self.texts = SpooledTemporaryFile(SPOOL_BYTES)
        self.sizes = array("q")
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.first = self.last = None
        self.turns = 0

    def add(self, turn, role: str, text: str, blank: bool, open_end: bool, mark: tuple[int, int]) -> None:
        if turn is not None:
            self.turns += turn != self.last
            self.first = turn if self.first is None else self.first
            self.last = turn
        fault = "blank" if blank else "duplicate" if mark in self.seen else "truncated" if open_end else None
        self.seen.add(mark)
        if fault:
            self.counts[fault] += 1
        initial = role[:1]
        before = self.rows.initials
        if before and before[-1] + initial not in _LAWFUL:
            self.counts["illegal"] += 1
        self.rows.add(initial, fault in ("blank", "duplicate"), fault == "truncated")
        for part in (role, text):
            data = part.encode("utf-8", "surrogatepass")
            self.texts.write(data)
            self.sizes.append(len(data))

    def repaired(self, audit: str) -> Iterator[tuple[str, bytes, bytes]]:
        """Edit, role and text of each turn after the edits."""
        written = sum(letter != "D" for letter in audit)
        at, place = 0, written % 2  # with an odd number of turns the first is the system's
        place = -place
        self.texts.seek(0)
        for letter in audit:
            role = text = b""
            if letter != "I":
                role, text = (self.texts.read(self.sizes[at + k]) for k in range(2))
                at += 2
            if letter == "D":
                continue
            yield letter, role if letter == "K" else b"assistant" if place % 2 else b"user", text
            place += 1

    def gaps(self) -> int:
        return 0 if self.first is None else self.last - self.first + 1 - self.turns


_FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[Conversation]:
    """Conversations from sorted rows, one after the other."""
    now: Conversation | None = None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "there", "blank", "open_end", "h1", "h2")]
        for conv_id, turn, role, text, there, blank, open_end, h1, h2 in zip(*columns):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    yield now
                    now.texts.close()
                now = Conversation(conv_id)
            if there:
                now.add(turn, role, text, blank, open_end, (h1, h2))
    if now is not None:
        yield now
        now.texts.close()


def _in_batches(rows: Iterator[tuple], types: list[tuple[str, pa.DataType]]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    names = [n for n, _ in types]

    def made() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*held), types)], names)

    for row in rows:
        held.append(row)
        size += len(row[-1])
        if len(held) == OUT_ROWS or size > SPOOL_BYTES:
            yield made()
            held, size = [], 0
    if held:
        yield made()


def _figures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for conv in _read(batches):
            cost, audit = cheapest_edits(conv.rows)
            digest = hashlib.sha256()
            for k, (_, role, text) in enumerate(conv.repaired(audit)):
                digest.update(b"\n" * (k > 0) + role + b":")
                digest.update(text)
            counts = conv.counts
            yield conv.conv_id, conv.gaps(), *counts.values(), cost, digest.hexdigest(), audit

    numbers = [(n, pa.int64()) for n in ("conv_id", *_FIGURES)]
    yield from _in_batches(rows(), [*numbers, ("repaired_sha256", pa.string()), ("audit", pa.string())])


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for conv in _read(batches):
            _, audit = cheapest_edits(conv.rows)
            for at, (letter, role, text) in enumerate(conv.repaired(audit)):
                yield conv.conv_id, at, letter, role.decode("utf-8", "surrogatepass"), text.decode("utf-8", "surrogatepass")

    types = [("conv_id", pa.int64()), ("at", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())]
    yield from _in_batches(rows(), types)


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and `there`: `rows` with faults dealt by the checksum of `conv_id:turn`.

    Rows that are dropped stay as marks of their conversation, with `there` false."""
    as_text = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fault = F.crc32(F.concat_ws(":", *as_text)) % 20
    text = F.coalesce("text", F.lit(" "))
    return rows.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(fault.isin(0, 1), "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (fault != 0).alias("there"),
        F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_again"),
    ).drop("_again")


def _sorted(rows: DataFrame) -> DataFrame:
    small_batches(rows.sparkSession)
    there = F.col("there") if "there" in rows.columns else F.lit(True)
    plain = rows.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        there.alias("there"),
    )
    solid = F.btrim("text", F.lit(_SPACE))
    flagged = plain.select(
        "*",
        (solid == "").alias("blank"),
        (~F.right(solid, F.lit(1)).isin(".", "!", "?")).alias("open_end"),
        F.xxhash64("role", "text").alias("h1"),
        F.xxhash64(F.lit(1), "role", "text").alias("h2"),
    )
    return flagged.repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")


def repair_figures(rows: DataFrame) -> DataFrame:
    """Per conversation its faults, the least cost, the edits (audit) and the SHA-256 of the repaired turns.

    Rows whose column `there` is false, if there is such a column, only name their conversation."""
    schema = ", ".join(["conv_id bigint", *[f"{n} bigint" for n in _FIGURES], "repaired_sha256 string", "audit string"])
    return _sorted(rows).mapInArrow(_figures, schema)


def repaired_turns(rows: DataFrame) -> DataFrame:
    """conv_id, at, edit (K, R or I), role and text of every turn after the repair."""
    return _sorted(rows).mapInArrow(_turns, "conv_id bigint, at bigint, edit string, role string, text string")
