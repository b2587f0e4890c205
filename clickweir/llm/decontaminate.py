"""Benchmark passages in documents, found by an Aho-Corasick automaton over words.

Items and texts are normalised to words: A-Z lower-cased, split at everything that is
neither a letter, a digit nor beyond ASCII. Every run of ten words of an item is a pattern
(a shorter item is one pattern), and a word is one symbol of the automaton's alphabet: its
number among the items' words, or 0. The automaton reads a text once and reports every
pattern at its last word; the words' byte spans map that back to the original text.

The items never pass through the driver: tasks number their words, deal them out to blocks
of bounded size and write each block to the shared folder, from where workers build its
automaton. A usual benchmark is one block, so texts are read once; of a larger one, every
worker takes a portion of texts through block after block.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweir.llm.ngram_lm import _place, _write
from clickweir.llm.words import (
    NOT_ALPHANUMERIC,
    portions,
    span_hashes,
    text_bytes,
    word_spans,
)
from clickweir.session import fresh_folder

SYMBOLS = 0x10000  # the first code point used for words, beyond the surrogates
MOST_WORDS = 0x110000 - SYMBOLS - 1  # different words that a block can have


@dataclass(frozen=True)
class DecontaminationSettings:
    """``block_words``: words of items to an automaton, about 1 kB of memory each."""

    window: int = 10
    block_words: int = 60_000
    portion_bytes: int = 16 << 20


_PIECE = "block long, item string, words binary"


def _pieces(
    batches: Iterator[pa.RecordBatch], blocks: int, settings: DecontaminationSettings
) -> Iterator[pa.RecordBatch]:
    """The word hashes of every item, long items in overlapping pieces, and their blocks."""
    most = settings.block_words
    for batch in portions(batches):
        data, offsets = text_bytes(batch.column(1))
        starts, ends = word_spans(data, offsets, NOT_ALPHANUMERIC)
        hashes = span_hashes(data, starts, ends)
        edges = np.searchsorted(starts, offsets)
        block, item, words = [], [], []
        for i, name in enumerate(batch.column(0).to_pylist()):
            own = hashes[edges[i] : edges[i + 1]]
            # every window lies whole in one piece
            last = max(len(own) - settings.window + 1, 1)
            for first in range(0, last if len(own) else 0, most):
                part = own[first : min(first + most, last) + settings.window - 1]
                block.append(int(np.bitwise_xor.reduce(part)) % blocks)
                item.append(name)
                words.append(part.tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(block, pa.int64()), pa.array(item, pa.string()), pa.array(words, pa.binary())],
            ["block", "item", "words"],
        )


def _store(table: pa.Table, folder: str) -> pa.Table:
    """Write a block: words, the pieces' ends among them, and their items' names."""
    number = table["block"][0].as_py()
    words = [np.frombuffer(w.as_py(), dtype=np.uint64) for w in table["words"]]
    names = [name.encode() for name in table["item"].to_pylist()]
    _write(
        folder, f"block-{number}",
        [
            np.concatenate(words), np.cumsum([len(w) for w in words], dtype=np.int64),
            np.cumsum([len(n) for n in names], dtype=np.int64),
            np.frombuffer(b"".join(names), dtype=np.uint8),
        ],
    )
    return pa.table({"block": pa.array([number], pa.int64())})


@dataclass(frozen=True)
class Benchmark:
    """Where the blocks of a benchmark's windows are."""

    folder: str
    blocks: tuple[int, ...]
    settings: DecontaminationSettings


def prepare(
    spark: SparkSession,
    items: DataFrame,
    settings: DecontaminationSettings = DecontaminationSettings(),
    id_column: str = "item_id",
    text_column: str = "text",
) -> Benchmark:
    """Store the windows of all items in blocks. Null and empty items have none; rows that
    repeat an id are one item with several texts; a null id is an item named by an empty
    text. Other columns are not read."""
    texts = items.select(
        F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("item"),
        F.col(text_column).alias("text"),
    )
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    # a word has two bytes at least; half-full blocks leave room for uneven ones
    blocks = max(1, -(-size // settings.block_words))
    folder = fresh_folder(spark, "benchmark")

    def store(table: pa.Table) -> pa.Table:
        return _store(table, folder)

    stored = (
        texts.mapInArrow(partial(_pieces, blocks=blocks, settings=settings), _PIECE)
        .groupBy("block")
        .applyInArrow(store, "block long")
    )
    return Benchmark(folder, tuple(sorted(r["block"] for r in stored.collect())), settings)


@dataclass
class _Block:
    """An automaton with the tables that its patterns point into."""

    words: np.ndarray
    automaton: ahocorasick.Automaton
    lengths: np.ndarray
    items: list[tuple[int, ...]]
    names: list[str]

    @classmethod
    def read(cls, folder: str, number: int, window: int) -> _Block:
        files, path = _place(folder)
        with files.open_input_stream(f"{path}/block-{number}") as source:
            data = source.read()
        lengths = np.frombuffer(data[:32], dtype=np.int64).tolist()
        arrays, at = [], 32
        for kind, length in zip(("u8", "i8", "i8", "u1"), lengths):
            arrays.append(np.frombuffer(data, dtype=kind, count=length, offset=at))
            at += arrays[-1].nbytes + (-arrays[-1].nbytes % 8)
        sequence, ends, name_ends, letters = arrays
        words, codes = np.unique(sequence, return_inverse=True)
        if len(words) > MOST_WORDS:
            raise ValueError("a block has too many different words: lower block_words")
        symbols = _symbols(codes.ravel() + 1)
        names: dict[str, int] = {}
        found: dict[str, list[int]] = {}
        first = name_first = 0
        for end, name_end in zip(ends.tolist(), name_ends.tolist()):
            name = letters[name_first:name_end].tobytes().decode()
            item = names.setdefault(name, len(names))
            length = min(window, end - first)
            for begin in range(first, end - length + 1):
                owners = found.setdefault(symbols[begin : begin + length], [])
                if not owners or owners[-1] != item:
                    owners.append(item)
            first, name_first = end, name_end
        automaton = ahocorasick.Automaton()
        for place, pattern in enumerate(found):
            automaton.add_word(pattern, place)
        automaton.make_automaton()
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
        return cls(words, automaton, sizes, [tuple(x) for x in found.values()], list(names))

    def hits(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Last words and patterns of all occurrences in a sequence of words."""
        at = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        known = self.words[at] == hashes
        text = _symbols(np.where(known, at + 1, 0))
        found = np.array(list(self.automaton.iter(text)), dtype=np.int64).reshape(-1, 2)
        return found[:, 0], found[:, 1]


def _symbols(codes: np.ndarray) -> str:
    """One character for each word."""
    return (codes + SYMBOLS).astype("<u4").tobytes().decode("utf-32-le")


_blocks: dict[tuple[str, int], _Block] = {}


def _block(benchmark: Benchmark, number: int) -> _Block:
    """A block's automaton; a process keeps the last one."""
    key = (benchmark.folder, number)
    if key not in _blocks:
        _blocks.clear()
        _blocks[key] = _Block.read(benchmark.folder, number, benchmark.settings.window)
    return _blocks[key]


_FOUND = (
    "doc_id long, n_words long, n_hit long, items array<string>, "
    "spans array<struct<start:int,end:int>>"
)
_SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))


def _find(batches: Iterator[pa.RecordBatch], benchmark: Benchmark) -> Iterator[pa.RecordBatch]:
    for batch in portions(batches, most=benchmark.settings.portion_bytes):
        data, offsets = text_bytes(batch.column(1))
        starts, ends = word_spans(data, offsets, NOT_ALPHANUMERIC)
        hashes = span_hashes(data, starts, ends)
        edges = np.searchsorted(starts, offsets)
        # a word that no item has ends every row, so that no pattern runs on into the next
        rows = batch.num_rows
        row_of = np.repeat(np.arange(rows), np.diff(edges))
        line = np.zeros(len(hashes) + rows, dtype=np.uint64)
        line[np.arange(len(hashes)) + row_of] = hashes
        covered = np.zeros(len(line) + 1, dtype=np.int64)
        owners: list[set[str]] = [set() for _ in range(rows)]
        breaks = edges[1:] + np.arange(rows)  # where each row's last symbol is
        for number in benchmark.blocks:
            block = _block(benchmark, number)
            last, pattern = block.hits(line)
            np.add.at(covered, last - block.lengths[pattern] + 1, 1)
            np.add.at(covered, last + 1, -1)
            pairs = np.unique(np.searchsorted(breaks, last) * len(block.items) + pattern)
            for pair in pairs.tolist():
                row, place = divmod(pair, len(block.items))
                owners[row].update(block.names[i] for i in block.items[place])
        hit = (np.cumsum(covered[:-1]) > 0)[np.arange(len(hashes)) + row_of]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(np.diff(edges)),
                pa.array(np.bincount(row_of[hit], minlength=rows)),
                pa.array([sorted(x) for x in owners], pa.list_(pa.string())),
                pa.array(_spans(data, offsets, starts, ends, hit, row_of, rows), _SPANS),
            ],
            ["doc_id", "n_words", "n_hit", "items", "spans"],
        )


def _spans(data, offsets, starts, ends, hit, row_of, rows: int) -> list[list[dict]]:
    """Runs of hit words as character positions in the row's own text."""
    out: list[list[dict]] = [[] for _ in range(rows)]
    places = np.flatnonzero(hit)
    if not len(places):
        return out
    fresh = np.ones(len(places), dtype=bool)
    fresh[1:] = (np.diff(places) > 1) | (np.diff(row_of[places]) > 0)
    first = places[fresh]
    last = places[np.append(fresh[1:], True)]
    letters: np.ndarray | None = None
    current = -1
    for row, a, b in zip(row_of[first].tolist(), first.tolist(), last.tolist()):
        if row != current:
            text = data[offsets[row] : offsets[row + 1]]
            letters = np.concatenate([[0], np.cumsum((text & 0xC0) != 0x80)])
            current = row
        base = offsets[row]
        out[row].append({"start": int(letters[starts[a] - base]), "end": int(letters[ends[b] - base])})
    return out


def find_passages(
    documents: DataFrame,
    benchmark: Benchmark,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """doc_id, n_words, n_hit, items, spans for every row of documents.

    ``n_hit``: words inside any occurrence of a window; ``items``: names of the items whose
    windows occur, sorted; ``spans``: runs of hit words, as character positions in the
    text. Null and empty texts have no words and no hits. Texts are read whole, in portions
    of bounded size or one text; repeated rows and null ids each give their row. Without
    items nothing is hit. Other columns are not read.
    """
    return documents.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    ).mapInArrow(partial(_find, benchmark=benchmark), _FOUND)
