"""Repair of conversation structure by the cheapest edits, with an audit.

A conversation is well formed if its roles are nothing, or user and assistant in turn,
behind one system row at most. Rows may be kept, given the role that is due (rerole),
deleted, or put in (with an empty text), each at a cost. What is due follows from what
stands so far: four states, in which a row's role and fault, its symbol, decide what each
edit leads to. So a row is a 4 x 4 matrix of costs, rows behind one another multiply in
min-plus arithmetic, and equal rows in a run are a power of one matrix.

Backwards over the runs of equal symbols, cached binary powers give the cheapest way to
the end at every run's border. Forwards, each run is halved until single rows are left, at
which the first edit in ASCII order that is still cheapest is taken: the audit.

Spark brings a conversation's rows together in order and marks the faults; a task reads
them as a stream, first the symbols, then the texts, and holds one byte a row of the
conversation at hand, never its texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# What the edits cost; an undeleted truncated row costs more.
RENAME, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
BLANKS = " \t\n\x0b\f\r"
SENTENCE_ENDS = ".!?"

# states: nothing yet, behind system, behind user, behind assistant
DUE = (2, 2, 3, 2)  # the state behind the role that is due
DUE_ROLE = ("user", "user", "assistant", "user")
KEPT = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (3, 1): 2, (2, 2): 3}  # (state, role) of kept rows
ENDING = (0, 2 * INSERT, INSERT, 0)  # what is missing at the end
NEVER = 1 << 60

# symbols: twice the role (system, user, assistant, other), one more for a truncated row
DELETED = 8  # a row that has to go
FAULTS = ("blank", "duplicate", "truncated")

LARGEST = (1 << 63) - 1
RUNS = 4096  # runs between two vectors that are held
SHORT = 64  # symbols of conversations whose audits are remembered
OUT_BYTES = 4 << 20

Matrix = tuple[tuple[int, ...], ...]


def _product(left: Matrix, right: Matrix) -> Matrix:
    columns = tuple(zip(*right))
    return tuple(
        tuple(min(a + b for a, b in zip(row, column)) for column in columns) for row in left
    )


def _row_matrix(symbol: int) -> Matrix:
    """Insertions, then one edit of a row."""
    insert = [[NEVER] * 4 for _ in range(4)]
    edit = [[NEVER] * 4 for _ in range(4)]
    for state in range(4):
        once = DUE[state]
        insert[state][DUE[once]] = 2 * INSERT
        insert[state][once] = INSERT
        insert[state][state] = 0
        edit[state][state] = DELETE
        if symbol != DELETED:
            role, late = divmod(symbol, 2)
            edit[state][once] = min(edit[state][once], RENAME + late * TRUNCATED)
            if (state, role) in KEPT:
                kept = KEPT[state, role]
                edit[state][kept] = min(edit[state][kept], late * TRUNCATED)
    return _product(tuple(map(tuple, insert)), tuple(map(tuple, edit)))


@lru_cache(maxsize=None)  # nine symbols, at most 63 powers
def _power(symbol: int, doublings: int) -> Matrix:
    if not doublings:
        return _row_matrix(symbol)
    half = _power(symbol, doublings - 1)
    return _product(half, half)


def _before(symbol: int, count: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """Cheapest costs to the end from every state before a run, given those behind it."""
    for doublings in range(count.bit_length()):
        if count >> doublings & 1:
            after = tuple(
                min(a + b for a, b in zip(row, after)) for row in _power(symbol, doublings)
            )
    return after


def _unroll(symbol: int, count: int, state: int, after: tuple[int, ...], out: list[str]) -> int:
    """The edits of a run, and the state behind it."""
    if count > 1:
        half = 1 << (count - 1).bit_length() - 1
        state = _unroll(symbol, half, state, _before(symbol, count - half, after), out)
        return _unroll(symbol, count - half, state, after, out)
    costs = _before(symbol, 1, after)
    role, late = divmod(symbol, 2)
    while True:
        least, due = costs[state], DUE[state]
        if DELETE + after[state] == least:
            out.append("D")
            return state
        if INSERT + costs[due] == least:
            out.append("I")
            state = due
            continue
        kept = KEPT.get((state, role)) if symbol != DELETED else None
        if kept is not None and late * TRUNCATED + after[kept] == least:
            out.append("K")
            return kept
        out.append("R")
        return due


def cheapest_edits(symbols: bytes) -> tuple[int, str]:
    """The cost and the ASCII-least audit of a conversation of these symbols."""
    row = np.frombuffer(symbols, dtype=np.uint8)
    borders = np.flatnonzero(np.diff(row)) + 1
    starts = np.concatenate([[0], borders])[: len(row)]
    lengths = np.diff(np.append(starts, len(row)))
    kinds = row[starts]

    def runs(block: int):
        part = slice(block * RUNS, (block + 1) * RUNS)
        return list(zip(kinds[part].tolist(), lengths[part].tolist()))

    blocks = -(-len(kinds) // RUNS)
    behind = [ENDING]  # costs behind every block, the last block's first
    for block in range(blocks - 1, -1, -1):
        costs = behind[-1]
        for symbol, count in reversed(runs(block)):
            costs = _before(symbol, count, costs)
        behind.append(costs)
    total = behind.pop()[0]
    state, pieces = 0, []
    for block in range(blocks):
        own, costs = runs(block), behind.pop()
        after = [costs]
        for symbol, count in reversed(own[1:]):
            after.append(_before(symbol, count, after[-1]))
        out: list[str] = []
        for (symbol, count), costs in zip(own, reversed(after)):
            state = _unroll(symbol, count, state, costs, out)
        pieces.append("".join(out))
    while ENDING[state]:
        pieces.append("I")
        state = DUE[state]
    return total, "".join(pieces)


_remembered = lru_cache(maxsize=1 << 16)(cheapest_edits)


@dataclass
class _Conversation:
    """One conversation while its rows stream by."""

    id: int | None
    symbols: bytearray = field(default_factory=bytearray)
    faults: list[int] = field(default_factory=lambda: [0, 0, 0])
    illegal: int = 0
    role: int | None = None
    turns: int = 0
    first: int | None = None
    last: int | None = None
    audit: str | None = None
    cost: int = 0
    at: int = 0  # in the audit
    row: int = 0
    state: int = 0
    kept: int = 0
    digest: object = field(default_factory=hashlib.sha256)

    def mark(self, symbol: np.ndarray, role: np.ndarray, fault: np.ndarray, turn: pa.Array) -> None:
        """Take in the symbols of further rows, in order."""
        self.symbols += symbol.tobytes()
        for number in fault[fault >= 0].tolist():
            self.faults[number] += 1
        before = self.role
        for own in role.tolist():
            # legal: system user, user assistant, assistant user
            self.illegal += before is not None and (before, own) not in ((0, 1), (1, 2), (2, 1))
            before = own
        self.role = before
        for value in turn.drop_null().to_pylist():  # ascending
            if value != self.last:
                self.turns += 1
            self.first = value if self.first is None else self.first
            self.last = value

    def solve(self) -> None:
        symbols = bytes(self.symbols)
        solver = _remembered if len(symbols) <= SHORT else cheapest_edits
        self.cost, self.audit = solver(symbols)

    def edits(self, roles: list[str], texts: list[str]) -> Iterator[tuple[str, str, str]]:
        """The edits up to the last of these rows: those of rows that had not to go."""
        for role, text in zip(roles, texts):
            while True:
                edit = self.audit[self.at]
                self.at += 1
                if edit == "I":
                    yield self._edited("I", DUE_ROLE[self.state], "", DUE[self.state])
                    continue
                symbol = self.symbols[self.row]
                self.row += 1
                if symbol == DELETED:
                    continue
                if edit == "K":
                    yield self._edited("K", role, text, KEPT[self.state, symbol // 2])
                elif edit == "R":
                    yield self._edited("R", DUE_ROLE[self.state], text, DUE[self.state])
                break

    def rest(self) -> Iterator[tuple[str, str, str]]:
        """The edits behind the last row that had not to go."""
        for edit in self.audit[self.at :]:
            if edit == "I":
                yield self._edited("I", DUE_ROLE[self.state], "", DUE[self.state])

    def _edited(self, edit: str, role: str, text: str, state: int) -> tuple[str, str, str]:
        self.digest.update(f"{chr(10) if self.kept else ''}{role}:{text}".encode())
        self.kept += 1
        self.state = state
        return edit, role, text

    def report(self) -> tuple:
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return (
            self.id, min(gaps, LARGEST), *self.faults, self.illegal, self.cost, self.audit,
            self.digest.hexdigest(),
        )


_REPORT = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, "
    "cost long, audit string, repaired_sha256 string"
)
_ROWS = "conv_id long, position long, edit string, role string, text string"


def _repair(batches: Iterator[pa.RecordBatch], rows: bool) -> Iterator[pa.RecordBatch]:
    """Rows (conv_id, kind, turn, symbol, role, fault, name, text) in order: of every
    conversation the symbols (kind 0), then the texts (kind 1) of rows that had not to go."""
    names = [part.split()[0] for part in (_ROWS if rows else _REPORT).split(", ")]
    kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3]
    if not rows:
        kinds = [*[pa.int64()] * 7, pa.string(), pa.string()]
    out: list[tuple] = []
    held = 0
    current: _Conversation | None = None

    def flush() -> pa.RecordBatch:
        columns = [pa.array(list(c), kind) for c, kind in zip(zip(*out), kinds)]
        return pa.RecordBatch.from_arrays(columns, names)

    def take(edits) -> None:
        nonlocal held
        for edit, role, text in edits:
            if rows:
                out.append((current.id, current.kept - 1, edit, role, text))
                held += len(text) + 64

    def finish() -> None:
        nonlocal held
        if current.audit is None:
            current.solve()
        take(current.rest())
        if not rows:
            out.append(current.report())
            held += len(current.audit) + 256

    for batch in batches:
        kind, symbol, role, fault = (
            batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 3, 4, 5)
        )
        ids = batch.column(0)
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        number = ids.fill_null(0).to_numpy(zero_copy_only=False)
        change = np.ones(batch.num_rows, dtype=bool)
        change[1:] = (np.diff(number) != 0) | (np.diff(known) != 0) | (np.diff(kind) != 0)
        edges = np.append(np.flatnonzero(change), batch.num_rows).tolist()
        for first, end in zip(edges[:-1], edges[1:]):
            own = int(number[first]) if known[first] else None
            if current is None or own != current.id:
                if current is not None:
                    finish()
                current = _Conversation(own)
            if kind[first] == 0:
                there = first + np.flatnonzero(symbol[first:end] >= 0)  # not only an id
                current.mark(
                    symbol[there].astype(np.uint8), role[there], fault[there],
                    batch.column(2).take(pa.array(there)),
                )
            else:
                if current.audit is None:
                    current.solve()
                take(
                    current.edits(
                        batch.column(6).slice(first, end - first).to_pylist(),
                        batch.column(7).slice(first, end - first).to_pylist(),
                    )
                )
            if held >= OUT_BYTES:
                yield flush()
                out, held = [], 0
    if current is not None:
        finish()
    if out:
        yield flush()


def damaged(
    conversations: DataFrame,
    conv_column: str = "conv_id",
    turn_column: str = "turn",
    role_column: str = "role",
    text_column: str = "text",
) -> DataFrame:
    """(conv_id, turn, role, text, present): rows damaged by the checksum of ``conv_id:turn``.

    Of twenty remainders 0 drops the row (it stays, not present, for its conversation's
    sake), 1 empties the text, 2 takes the ends of its sentences, 3 repeats the row, 4 makes
    its role user. A null is one space, in the checksum's text too; null ids and turns stay.
    """
    conv, turn = F.col(conv_column).cast("long"), F.col(turn_column).cast("long")
    name = F.concat(
        F.coalesce(conv.cast("string"), F.lit(" ")), F.lit(":"),
        F.coalesce(turn.cast("string"), F.lit(" ")),
    )
    fate = F.crc32(name) % 20
    text = F.coalesce(text_column, F.lit(" "))
    return conversations.select(
        conv.alias("conv_id"),
        turn.alias("turn"),
        F.when(fate == 4, "user").otherwise(F.coalesce(role_column, F.lit(" "))).alias("role"),
        F.when(fate == 1, "")
        .when(fate == 2, F.translate(text, SENTENCE_ENDS, ""))
        .otherwise(text)
        .alias("text"),
        (fate != 0).alias("present"),
        F.explode(F.when(fate == 3, F.array(F.lit(0), F.lit(0))).otherwise(F.array(F.lit(0)))),
    ).drop("col")


def _marked(conversations: DataFrame, columns: tuple[str, str, str, str], present: Column) -> DataFrame:
    """Rows with their faults, in order, as ``_repair`` reads them.

    One shuffle, by conversation. The sorts spill, so a conversation of any length can be
    read; it is still one task's, as one digest goes over its texts one after another.
    """
    conv, turn, role, text = columns
    rows = conversations.select(
        F.col(conv).cast("long").alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit(" ")).alias("name"),
        F.coalesce(F.col(text).cast("string"), F.lit(" ")).alias("text"),
        F.coalesce(present, F.lit(False)).alias("present"),
    )
    body = F.rtrim("text", F.lit(BLANKS))
    digest = F.unhex(F.md5(F.concat(F.octet_length("name").cast("string"), F.lit(":"), "name", "text")))
    letter = F.substring("name", 1, 1)
    roles = F.when(letter == "s", 0).when(letter == "u", 1).when(letter == "a", 2).otherwise(3)
    again = F.row_number().over(
        Window.partitionBy("conv_id", "present", "digest").orderBy(F.col("turn").asc_nulls_first())
    )
    # of a row only the first fault counts
    fault = (
        F.when(~F.col("present"), -1)
        .when(F.col("body_bytes") == 0, 0)
        .when(F.col("again") > 1, 1)
        .when(~F.col("ended"), 2)
        .otherwise(-1)
    )
    symbol = (
        F.when(~F.col("present"), -1)
        .when(F.col("fault").isin(0, 1), DELETED)
        .otherwise(2 * F.col("role") + (F.col("fault") == 2).cast("int"))
    )
    gone = (F.col("symbol") < 0) | (F.col("symbol") == DELETED)
    kinds = F.when(gone, F.array(F.lit(0))).otherwise(F.array(F.lit(0), F.lit(1)))
    return (
        rows.withColumn("body_bytes", F.octet_length(body))
        .withColumn("ended", F.substring(body, -1, 1).isin(*SENTENCE_ENDS))
        .withColumn("role", roles)
        .withColumn("digest", digest)
        .repartition("conv_id")
        .withColumn("again", again)
        .withColumn("fault", fault)
        .withColumn("symbol", symbol)
        .withColumn("kind", F.explode(kinds))
        .select(
            "conv_id", "kind", "turn", "symbol", "role", "fault",
            F.when(F.col("kind") == 1, F.col("name")).alias("name"),
            F.when(F.col("kind") == 1, F.col("text")).alias("text"),
            "digest", "again",
        )
        .sortWithinPartitions("conv_id", "kind", F.col("turn").asc_nulls_first(), "digest", "again")
        .drop("digest", "again")
    )


def repair(
    conversations: DataFrame,
    columns: tuple[str, str, str, str] = ("conv_id", "turn", "role", "text"),
    present: Column | None = None,
) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 for
    every conversation.

    Rows are read by turn, null first; rows of one turn by a digest of role and text. Each
    row's first fault counts: blank, duplicate (role and text of an earlier row), truncated
    (no sentence ends at its end). ``gaps``: turns between the first and the last that have
    no row; null turns are left out. ``illegal``: neighbours whose roles may not follow one
    another. ``audit``: initials of the cheapest edits, ASCII-least among equals; the digest
    is over the repaired ``role:text`` lines.

    Null roles and texts are one space; a role that begins with neither s, u nor a is never
    kept. A null conversation id is a conversation of its own. Rows that are not ``present``
    only give their conversation a row, with zeros, an empty audit and the digest of an
    empty text if nothing else is left. An empty table gives no rows. Other columns are not
    read. Texts of any length are held one Arrow batch at a time.
    """
    marked = _marked(conversations, columns, F.lit(True) if present is None else present)
    return marked.mapInArrow(partial(_repair, rows=False), _REPORT)


def repaired(
    conversations: DataFrame,
    columns: tuple[str, str, str, str] = ("conv_id", "turn", "role", "text"),
    present: Column | None = None,
) -> DataFrame:
    """conv_id, position, edit, role, text: the rows of the repaired conversations.

    ``edit`` is K for a kept row, R for one that was given another role, I for one that was
    put in. Conversations without rows left give none; the rest as in ``repair``.
    """
    marked = _marked(conversations, columns, F.lit(True) if present is None else present)
    return marked.mapInArrow(partial(_repair, rows=True), _ROWS)
