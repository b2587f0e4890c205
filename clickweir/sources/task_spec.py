"""What part of a topic to read: ``partitions:offset:limit[,...]``.

    *:0:1000          all partitions from offset 0, 1000 rows in total
    %:-1000:1000000   whatever the group is assigned, from where it stopped
    3:500:20          partition 3 from offset 500, 20 rows
    0-3:-2:100        partitions 0 to 3 from the earliest row, 100 rows in total
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweir.operators.limits import OffsetRange, select_ranges

# Symbolic partitions and offsets.
ALL = "*"
ASSIGNED = "%"
LATEST = -1
EARLIEST = -2
STORED = -1000

_SYMBOLIC_OFFSETS = (LATEST, EARLIEST, STORED)


@dataclass(frozen=True)
class Clause:
    """One part of a task; ``first``/``last`` are None for ``*`` and ``%``."""

    partitions: str
    first: int | None
    last: int | None
    offset: int
    limit: int

    @property
    def own_limit(self) -> bool:
        """The limit belongs to a single partition."""
        return self.first is not None and self.first == self.last


@dataclass(frozen=True)
class TaskSpec:
    clauses: tuple[Clause, ...]

    @classmethod
    def parse(cls, text: str) -> TaskSpec:
        clauses = tuple(_clause(part.strip()) for part in text.split(","))
        if len(clauses) > 1 and any(c.first is None for c in clauses):
            raise ValueError(f"{ALL!r} and {ASSIGNED!r} must be the only clause")
        taken: set[int] = set()
        for clause in clauses:
            if clause.first is None:
                continue
            mine = set(range(clause.first, clause.last + 1))
            if taken & mine:
                raise ValueError(f"partitions named twice: {sorted(taken & mine)}")
            taken |= mine
        return cls(clauses)

    @property
    def total_limit(self) -> int:
        return sum(clause.limit for clause in self.clauses)

    @property
    def commits(self) -> bool:
        """Progress is recorded only for symbolic offsets: an explicit one asks for
        a re-read that must not move the group."""
        return all(clause.offset < 0 for clause in self.clauses)

    def select(
        self,
        messages: DataFrame,
        stored: Mapping[int, int] | None = None,
        start_earliest: bool = False,
    ) -> DataFrame:
        """The rows this task names out of a stored envelope, limits exact.

        ``stored`` gives the next offset per partition for ``-1000``; partitions
        without one fail, or start at the beginning with ``start_earliest``. For ``*`` and
        ``%`` that is found when the rows are read: a partition without a position stops
        the job instead of being left out. ``-1`` has no meaning here: a stored envelope
        ends where it ends.
        """
        return select_ranges(*self.ranged(messages, stored, start_earliest))

    def ranged(
        self,
        messages: DataFrame,
        stored: Mapping[int, int] | None = None,
        start_earliest: bool = False,
    ) -> tuple[DataFrame, list[OffsetRange]]:
        """The messages, checked, and the ranges of them that ``select`` takes."""
        if any(clause.offset == LATEST for clause in self.clauses):
            raise ValueError("offset -1 (latest) needs a stream; a bounded run has nothing behind it")
        ranges = [
            _stored_range(clause, stored or {}, start_earliest)
            if clause.offset == STORED
            else OffsetRange(
                clause.first,
                clause.last,
                max(clause.offset, 0),
                clause.limit,
            )
            for clause in self.clauses
        ]
        for clause in self.clauses:
            if clause.offset == STORED and clause.first is None and not start_earliest:
                messages = _only_known(messages, stored)
        return messages, ranges

    def options(
        self,
        topic: str,
        stored: Mapping[int, int] | None = None,
        start_earliest: bool = False,
        partition_count: int | None = None,
        streaming: bool = False,
        has_checkpoint: bool = False,
        counted: bool = False,
    ) -> dict[str, str]:
        """Connector options for this task.

        ``*`` with an explicit offset needs ``partition_count``. A checkpoint takes
        over from ``stored`` once it exists. A stream gets the total limit as the
        size of one micro-batch, unless its limits are ``counted`` by the reader
        (``plans.positions``), which is exact and takes any number of clauses.
        """
        options = {"failOnDataLoss": "true"}
        symbolic = self.clauses[0].first is None
        if symbolic:
            options["subscribe"] = topic
        else:
            numbers = [
                n for c in self.clauses for n in range(c.first, c.last + 1)
            ]
            options["assign"] = json.dumps({topic: numbers})
        starts: dict[str, int] = {}
        for clause in self.clauses:
            if clause.first is not None:
                numbers = range(clause.first, clause.last + 1)
            elif clause.offset == STORED and stored:
                numbers = sorted(stored)
            elif clause.offset >= 0:
                if partition_count is None:
                    raise ValueError("an explicit offset for '*' needs partition_count")
                numbers = range(partition_count)
            else:
                numbers = ()
            for number in numbers:
                starts[str(number)] = _start_of(clause, number, stored, start_earliest,
                                                has_checkpoint)
        if starts:
            options["startingOffsets"] = json.dumps({topic: starts})
        else:
            options["startingOffsets"] = _named_start(
                self.clauses[0].offset, start_earliest, has_checkpoint
            )
        if streaming and not counted:
            if len(self.clauses) > 1:
                raise ValueError("a stream has one limit in all: give a task of one clause")
            if not self.total_limit:
                raise ValueError("a limit of 0 reads nothing: a stream needs a larger one")
            options["maxOffsetsPerTrigger"] = str(self.total_limit)
        elif not streaming and not symbolic and all(c.own_limit and c.offset >= 0 for c in self.clauses):
            options["endingOffsets"] = json.dumps(
                {topic: {str(c.first): c.offset + c.limit for c in self.clauses}}
            )
        return options


def _clause(text: str) -> Clause:
    parts = text.split(":")
    if len(parts) != 3:
        raise ValueError(f"expected partitions:offset:limit, got {text!r}")
    where, offset_text, limit_text = (part.strip() for part in parts)
    if where in (ALL, ASSIGNED):
        first = last = None
    else:
        span = re.fullmatch(r"(\d+)(?:-(\d+))?", where)
        if not span:
            raise ValueError(f"partitions must be '*', '%', n or n-m, got {where!r}")
        first = int(span[1])
        last = int(span[2] or span[1])
        if last < first:
            raise ValueError(f"empty partition range {where!r}")
    if not re.fullmatch(r"-?\d+", offset_text):
        raise ValueError(f"offset must be an integer, got {offset_text!r}")
    offset = int(offset_text)
    if offset < 0 and offset not in _SYMBOLIC_OFFSETS:
        raise ValueError("offset must be >= 0, -1 latest, -2 earliest or -1000 stored")
    if where == ASSIGNED and offset != STORED:
        raise ValueError("'%' continues from stored positions: its offset must be -1000")
    if not re.fullmatch(r"\d+", limit_text):
        raise ValueError(f"limit must be an integer >= 0, got {limit_text!r}")
    return Clause(where, first, last, offset, int(limit_text))


def _stored_range(
    clause: Clause, stored: Mapping[int, int], start_earliest: bool
) -> OffsetRange:
    wanted = (
        None if clause.first is None else range(clause.first, clause.last + 1)
    )
    known = {n: o for n, o in stored.items() if wanted is None or n in wanted}
    if not start_earliest:
        if wanted is not None:
            missing = sorted(set(wanted) - set(known))
            if missing:
                raise ValueError(f"no stored offset for partitions {missing}")
        elif not known:
            raise ValueError("no stored offsets; pass start_earliest to begin anew")
    return OffsetRange(clause.first, clause.last, 0, clause.limit, tuple(sorted(known.items())))


def _only_known(messages: DataFrame, stored: Mapping[int, int]) -> DataFrame:
    """Fail on the first row of a partition without a stored position."""
    unknown = F.concat(F.lit("no stored offset for partition "), F.col("partition"))
    known = F.col("partition").isin(*stored)
    checked = F.when(known, F.col("partition")).otherwise(F.raise_error(unknown).cast("int"))
    return messages.withColumn("partition", checked)


def _start_of(clause, number, stored, start_earliest, has_checkpoint) -> int:
    if clause.offset != STORED:
        return clause.offset
    if stored and number in stored:
        return stored[number]
    if start_earliest or has_checkpoint:
        return EARLIEST
    raise ValueError(f"no stored offset for partition {number}")


def _named_start(offset: int, start_earliest: bool, has_checkpoint: bool) -> str:
    if offset == LATEST:
        return "latest"
    if offset == STORED and not (start_earliest or has_checkpoint):
        raise ValueError("no stored offsets; pass start_earliest to begin anew")
    return "earliest"
