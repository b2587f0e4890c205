"""Language-model scoring with an interpolated modified Kneser-Ney model of any order.

Words first: tasks count the words of their texts and deal them out by their hash. A shard
merges its part and numbers its words, the most frequent ones first, with numbers that no
other shard gives; n-grams are rows of these numbers, so they are exact and small.

Counting: tasks reduce their texts to n-grams with counts and deal them out by their
context (all words but the last). A shard of the longest n-grams merges its part, writes it
as a tree into the shared folder, and deals out the n-grams without their first word: as
often as one arrives, so many different words stand before it. That is the count of the
next shorter order, down to single words. N-grams that begin a text have nothing before
them; they keep their own count at every order. All the rest of the model is a few totals
for each order.

Scoring: workers map the shards' files into memory and search them for the n-grams
of a portion of text at a time, so a worker's memory does not grow with the model.

What is stored and sent is kept small, for it is many times the texts: sorted n-grams are
sent as steps from one to the next; a tree has each word in as many bytes as its largest
needs, the places of a node's children within a block, and sums only for large nodes.
"""

from __future__ import annotations

import math
import os
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweir.llm.words import SPACE, mix, portions, word_hashes
from clickweir.session import fresh_folder

BEGIN = np.uint64(0x2545F4914F6CDD1D)  # context of a text's first word; its number is 0
END = np.uint64(0x6A09E667F3BCC909)  # the token behind a text's last word
ORDER = 3
TOKENS_AT_ONCE = 3_000_000  # words of n-grams that are scored together
COUNTED_AT_ONCE = 6_000_000  # words of n-grams held before they are reduced
WORDS_AT_ONCE = 1_000_000  # different words held before they are dealt out
SHARD_BYTES = 24 << 20  # of text times order, to a shard
LEAST_SHARDS = 64
OPEN_FILES = 4096
BLOCK_BITS = 8  # 256 nodes of a tree count the places of their children from one base
FEW = 8  # children that are summed up when a node is looked up
MOST_NUMBERS = (1 << 32) - 2


def _keys(words: np.ndarray) -> np.ndarray:
    """One number for each n-gram (a column), in the order of their words."""
    bits = max(int(words.max()).bit_length(), 1) if words.size else 1
    key, used = words[0].astype(np.uint64), bits
    for following in words[1:]:
        if used + bits > 64:
            names, key = np.unique(key, return_inverse=True)
            key, used = key.astype(np.uint64), len(names).bit_length()
        key = (key << np.uint64(bits)) | following.astype(np.uint64)
        used += bits
    return key


def _shard_of(contexts: np.ndarray, shards: int) -> np.ndarray:
    out = mix(contexts[0].astype(np.uint64))
    for following in contexts[1:]:
        out = mix(out * np.uint64(0xD6E8FEB86659FD93) + following.astype(np.uint64))
    return (out % np.uint64(shards)).astype(np.int64)


def _firsts(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal ones begins."""
    return np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])


def _runs(shard: np.ndarray, shards: int):
    """(shard, indices) for every shard that occurs; the indices in order."""
    order = np.argsort(shard.astype(np.min_scalar_type(shards)), kind="stable")
    edges = np.append(0, np.cumsum(np.bincount(shard, minlength=shards)))
    for number in np.flatnonzero(np.diff(edges)).tolist():
        yield number, order[edges[number] : edges[number + 1]]


def _sequences(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Begin, words and end of each row, and the place of each in its row."""
    words, offsets = word_hashes(column, SPACE)
    rows = np.arange(len(offsets) - 1)
    begins, ends = offsets[:-1] + 2 * rows, offsets[1:] + 2 * rows + 1
    line = np.empty(len(words) + 2 * len(rows), dtype=np.uint64)
    inner = np.ones(len(line), dtype=bool)
    inner[begins] = inner[ends] = False
    line[begins], line[ends], line[inner] = BEGIN, END, words
    return line, np.arange(len(line)) - np.repeat(begins, ends - begins + 1)


def _grams_at(line: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """The n-grams whose last words are there."""
    return np.stack([line[at - back] for back in range(length - 1, -1, -1)])


def _planes(values: np.ndarray) -> bytes:
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def _coded(columns: list[np.ndarray]) -> bytes:
    """Columns of equal length, not empty, of no negative numbers, compressed."""
    columns = [np.ascontiguousarray(c, np.min_scalar_type(int(c.max()))) for c in columns]
    body = b"".join(map(_planes, columns))
    head = [len(columns), len(columns[0]), len(body), *[c.itemsize for c in columns]]
    return np.array(head, dtype=np.uint32).tobytes() + pa.Codec("zstd").compress(body, asbytes=True)


def _decoded(data: bytes) -> list[np.ndarray]:
    number, size, whole = np.frombuffer(data, np.uint32, 3).tolist()
    widths = np.frombuffer(data, np.uint32, number, offset=12).tolist()
    body = pa.Codec("zstd").decompress(data[12 + 4 * number :], whole, asbytes=True)
    out, at = [], 0
    for width in widths:
        planes = np.frombuffer(body, dtype=np.uint8, count=size * width, offset=at)
        out.append(np.ascontiguousarray(planes.reshape(width, size).T).view(f"u{width}").ravel())
        at += size * width
    return out


def _packed(words: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted n-grams and counts: a word as the step from the n-gram before, where all words
    before it are the same."""
    fresh = np.arange(words.shape[1]) == 0
    steps = []
    for word in words.astype(np.int64):
        steps.append(np.where(fresh, word, np.diff(word, prepend=0)))
        fresh = fresh | (steps[-1] != 0)
    return _coded([*steps, counts])


def _unpacked(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    *steps, counts = _decoded(data)
    fresh = np.arange(len(counts)) == 0
    words = []
    for step in steps:
        sums, starts = np.cumsum(step, dtype=np.int64), np.flatnonzero(fresh)
        base = sums[starts] - step[starts].astype(np.int64)
        words.append(sums - np.repeat(base, np.diff(np.append(starts, len(sums)))))
        fresh = fresh | (step != 0)
    return np.stack(words).astype(np.uint32), counts.astype(np.int64)


def _summed(words: np.ndarray, counts: np.ndarray | None = None):
    """Equal n-grams added up (without counts: counted), in the order of their words."""
    keys = _keys(words)
    order = np.argsort(keys)
    at = _firsts(keys[order])
    if counts is None:
        counts = np.diff(np.append(at, len(keys)))
    elif len(at):
        counts = np.add.reduceat(counts[order], at)
    return words[:, order[at]], counts


def _count_words(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    """(shard, words) with the different words of runs of texts, sorted, and their counts."""

    def merged(parts):
        names, counts = (np.concatenate(p) for p in zip(*parts))
        order = np.argsort(names)
        at = _firsts(names[order])
        return names[order[at]], np.add.reduceat(counts[order], at)

    def dealt(parts):
        names, counts = merged(parts)
        rows = []
        for number, own in _runs((names % np.uint64(shards)).astype(np.int64), shards):
            steps = np.diff(names[own], prepend=np.uint64(0))
            rows.append((number, _coded([steps, counts[own]])))
        numbers, words = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(numbers, pa.int64()), pa.array(words, pa.binary())], ["shard", "words"]
        )

    parts, held = [], 0
    for batch in portions(batches, text=0):
        line, place = _sequences(batch.column(0))
        parts.append(np.unique(line[place > 0], return_counts=True))
        held += len(parts[-1][0])
        if held >= WORDS_AT_ONCE:
            parts = [merged(parts)]
            held = len(parts[0][0])
            if 2 * held >= WORDS_AT_ONCE:
                yield dealt(parts)
                parts, held = [], 0
    if held:
        yield dealt(parts)


def _number_words(table: pa.Table, folder: str, shards: int) -> pa.Table:
    """Write one shard of words with their numbers; return how many there are."""
    number = int(table["shard"][0].as_py())
    parts = [_decoded(data.as_py()) for data in table["words"]]
    names = np.concatenate([np.cumsum(steps, dtype=np.uint64) for steps, _ in parts])
    counts = np.concatenate([own for _, own in parts]).astype(np.int64)
    order = np.argsort(names)
    at = _firsts(names[order])
    names, counts = names[order[at]], np.add.reduceat(counts[order], at)
    order = np.argsort(-counts, kind="stable")
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    _write(folder, f"words-{number}", [names, *_narrow(rank), *_small(counts[order])])
    found = [int(counts.sum()), len(names), (len(names) - 1) * shards + number + 1]
    return pa.table({k: pa.array([v], pa.int64()) for k, v in zip(("tokens", "types", "last"), found)})


_DEALT = "shard long, kind int, grams binary, totals array<long>"  # kind: length of the n-grams
_ROW = pa.schema(
    [
        ("shard", pa.int64()), ("kind", pa.int32()), ("grams", pa.binary()),
        ("totals", pa.list_(pa.int64())),
    ]
)


def _dealt(kind: int, words: np.ndarray, counts: np.ndarray, shards: int) -> list[tuple]:
    """A row for each shard that they touch."""
    shard = _shard_of(words[:-1], shards) if kind > 1 else (words[0].astype(np.int64) - 1) % shards
    return [
        (number, kind, _packed(words[:, own], counts[own]), None)
        for number, own in _runs(shard, shards)
    ]


def _table(rows: list[tuple]) -> pa.Table:
    columns = zip(*rows) if rows else [[]] * len(_ROW)
    return pa.table([pa.array(list(c), f.type) for c, f in zip(columns, _ROW)], schema=_ROW)


def _count(
    batches: Iterator[pa.RecordBatch], order: int, vocabulary: Vocabulary
) -> Iterator[pa.RecordBatch]:
    """N-gram counts of runs of texts: for each token the longest n-gram that it ends."""

    def flush(parts):
        hashes, place = (np.concatenate(p) for p in zip(*parts))
        line, _, _ = _looked_up(vocabulary, hashes, place)
        if (line > vocabulary.last).any():
            raise RuntimeError("the texts have changed since their words were counted")
        for length in range(2, order + 1):
            whole = place >= length - 1 if length == order else place == length - 1
            at = np.flatnonzero(whole)
            if len(at):
                words, counts = _summed(_grams_at(line, at, length))
                yield from _table(_dealt(length, words, counts, vocabulary.shards)).to_batches()

    parts, held = [], 0
    for batch in portions(batches, text=0):
        parts.append(_sequences(batch.column(0)))
        held += len(parts[-1][0])
        if held * order >= COUNTED_AT_ONCE:
            yield from flush(parts)
            parts, held = [], 0
    if held:
        yield from flush(parts)


def _place(folder: str) -> tuple[fs.FileSystem, str]:
    if "://" not in folder and not folder.startswith("file:"):
        return fs.LocalFileSystem(), folder
    if folder.startswith("file:") and not folder.startswith("file://"):
        folder = "file://" + folder.removeprefix("file:")
    return fs.FileSystem.from_uri(folder)


def _write(folder: str, name: str, arrays: list[np.ndarray]) -> None:
    """Arrays behind one another, their lengths first; renamed into place when complete."""
    files, path = _place(folder)
    files.create_dir(path, recursive=True)
    partial_name = f"{path}/.{name}-{uuid.uuid4().hex}"
    with files.open_output_stream(partial_name) as out:
        out.write(np.array([len(a) for a in arrays], dtype=np.int64).tobytes())
        for array in arrays:
            out.write(array.tobytes())
            out.write(b"\0" * (-array.nbytes % 8))
    files.move(partial_name, f"{path}/{name}")


_open: dict[str, list[np.ndarray]] = {}


def _mapped(folder: str, name: str, kinds: list[str]) -> list[np.ndarray]:
    """The arrays of a shard's file, mapped into memory."""
    key = f"{folder}/{name}"
    if key not in _open:
        if len(_open) >= OPEN_FILES:
            _open.clear()
        files, path = _place(folder)
        if isinstance(files, fs.LocalFileSystem):
            whole = np.memmap(f"{path}/{name}", dtype=np.uint8, mode="r")
        else:  # a store that cannot be mapped: through a file that is gone once mapped
            handle, local = tempfile.mkstemp()
            try:
                with files.open_input_stream(f"{path}/{name}") as source, os.fdopen(handle, "wb") as out:
                    while piece := source.read(1 << 22):
                        out.write(piece)
                whole = np.memmap(local, dtype=np.uint8, mode="r")
            finally:
                os.unlink(local)
        whole = whole.view(np.ndarray)  # slices of a memmap cost more than they hold
        lengths = np.frombuffer(whole[: 8 * len(kinds)], dtype=np.int64)
        at, arrays = 8 * len(kinds), []
        for kind, length in zip(kinds, lengths.tolist()):
            size = length * np.dtype(kind).itemsize
            arrays.append(whole[at : at + size].view(kind))
            at += size + (-size % 8)
        _open[key] = arrays
    return _open[key]


# numbers below 2^32 in as many bytes as the largest needs
_NARROW = ["u2", "u1", "u1"]
# counts up to 255, and place and count of the larger ones
_SMALL = ["u1", "i8", "i8"]
_WORD_FILE = ["u8", *_NARROW, *_SMALL]  # hash and rank of each word; counts by rank
_FOLLOW_FILE = _SMALL  # by rank: words that it follows


def _gram_file(length: int) -> list[str]:
    """Trees of n-grams. First words and where their children begin; the same of the nodes
    below; last words and counts; which nodes have many of these, with their total count
    and those seen once, twice, more often."""
    places = ["i8", *_NARROW]
    nodes = [*_NARROW, *places] * (length - 2)
    return ["u4", *places, *nodes, *_NARROW, *_SMALL, "i8", "i8", "i8", "i8", "i8"]


_FIRST_TOTALS = 1  # follows; then four counts of counts for each order


def _narrow(values: np.ndarray) -> list[np.ndarray]:
    higher = [(values >> 16).astype(np.uint8), (values >> 24).astype(np.uint8)]
    return [values.astype(np.uint16), *[part if part.any() else part[:0] for part in higher]]


def _narrow_at(arrays: list[np.ndarray], at: np.ndarray) -> np.ndarray:
    out = arrays[0][at].astype(np.int64)
    for shift, more in zip((16, 24), arrays[1:]):
        if len(more):
            out |= more[at].astype(np.int64) << shift
    return out


def _small(counts: np.ndarray) -> list[np.ndarray]:
    large = np.flatnonzero(counts >= 255)
    return [np.minimum(counts, 255).astype(np.uint8), large.astype(np.int64), counts[large]]


def _small_at(arrays: list[np.ndarray], at: np.ndarray) -> np.ndarray:
    out = arrays[0][at].astype(np.int64)
    full = np.flatnonzero(out == 255)
    if len(full):
        out[full] = arrays[2][np.searchsorted(arrays[1], at[full])]
    return out


def _begins(starts: np.ndarray) -> list[np.ndarray]:
    bases = starts[:: 1 << BLOCK_BITS]
    return [bases, *_narrow(starts - np.repeat(bases, 1 << BLOCK_BITS)[: len(starts)])]


def _begin_at(arrays: list[np.ndarray], at: np.ndarray) -> np.ndarray:
    return arrays[0][at >> BLOCK_BITS] + _narrow_at(arrays[1:], at)


def _spectrum(counts: np.ndarray) -> list[int]:
    return [int((counts == n).sum()) for n in (1, 2, 3, 4)]


def _write_grams(folder: str, name: str, words: np.ndarray, counts: np.ndarray) -> None:
    arrays = []
    fresh = np.arange(words.shape[1]) == 0
    nodes = None  # the n-gram that each node of the level above begins with
    for level, word in enumerate(words):
        fresh = fresh | (np.diff(word, prepend=word[:1]) != 0)
        own = np.flatnonzero(fresh)
        if level:
            above = np.searchsorted(own, np.append(nodes, len(word))).astype(np.int64)
            arrays += _begins(above)
        arrays += [word[own]] if level == 0 else _narrow(word[own].astype(np.int64))
        nodes, parents = own, nodes
    children = np.diff(np.append(parents, len(counts)))
    many = np.flatnonzero(children > FEW)
    node = np.repeat(np.arange(len(parents)), children)
    sums = [np.bincount(node, counts, len(parents))]
    for n in (1, 2, 3):
        sums.append(np.bincount(node, counts == n if n < 3 else counts >= 3, len(parents)))
    arrays += [*_small(counts), many.astype(np.int64), *[s[many].astype(np.int64) for s in sums]]
    _write(folder, name, arrays)


def _merge(table: pa.Table, kind: int, order: int, folder: str, shards: int) -> pa.Table:
    """Write one shard of n-grams of this length; return the next shorter ones and the totals.

    What belongs to shorter orders of the same shard is added up and passed on.
    """
    number = int(table["shard"][0].as_py())
    totals = np.zeros(_FIRST_TOTALS + 4 * order, dtype=np.int64)
    held: dict[int, list] = {}
    for of, data, others in zip(table["kind"], table["grams"], table["totals"]):
        if others.is_valid:
            totals += np.array(others.as_py(), dtype=np.int64)
        else:
            held.setdefault(of.as_py(), []).append(_unpacked(data.as_py()))
    merged = {}
    for of in list(held):
        words, counts = zip(*held.pop(of))
        merged[of] = _summed(np.concatenate(words, axis=1), np.concatenate(counts))
    rows = []
    if kind in merged:
        words, counts = merged.pop(kind)
        at = _FIRST_TOTALS + 4 * (kind - 1)
        totals[at : at + 4] += _spectrum(counts)
        if kind > 1:
            _write_grams(folder, f"grams{kind}-{number}", words, counts)
            rows = _dealt(kind - 1, *_summed(words[1:]), shards)
        else:
            rank = (words[0].astype(np.int64) - 1) // shards
            follows = np.zeros(rank[-1] + 1, dtype=np.int64)
            follows[rank] = counts
            _write(folder, f"follows-{number}", _small(follows))
            totals[0] += int(counts.sum())
    rows += [(number, of, _packed(words, counts), None) for of, (words, counts) in merged.items()]
    return _table([*rows, (number, 0, None, totals.tolist())])


@dataclass(frozen=True)
class Vocabulary:
    """Where the shards are, and the largest number of a word."""

    folder: str
    shards: int
    last: int


@dataclass(frozen=True)
class NgramModel:
    """The words, and the totals of the corpus."""

    vocabulary: Vocabulary
    tokens: int
    types: int
    follows: int
    discounts: tuple[tuple[float, float, float], ...]  # of words, pairs and so on
    rest: float  # share of the uniform distribution in the words' one


def discounts(n1: int, n2: int, n3: int, n4: int) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts of counts 1, 2 and more, from the counts of counts."""
    if not n1 or not n2:
        return 0.5, 0.75, 0.9  # too few counts to estimate from
    y = n1 / (n1 + 2 * n2)
    raw = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 1.5)
    return tuple(min(max(d, 0.05), k - 0.05) for k, d in zip((1, 2, 3), raw))


def train(
    spark: SparkSession, documents: DataFrame, text_column: str = "text", order: int = ORDER
) -> NgramModel:
    """Count all rows of documents; null and empty texts count as an end after the begin.

    ``order`` is the length of the longest n-grams, 2 or more. The rows are read twice and
    have to be the same both times.
    """
    if order < 2:
        raise ValueError(f"order is {order}; 2 is the least")
    texts = documents.select(F.col(text_column).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text")).alias("bytes")).first()["bytes"] or 0
    shards = max(LEAST_SHARDS, -(-size * order // SHARD_BYTES))
    folder = fresh_folder(spark, "ngram-model")

    def numbered(table: pa.Table) -> pa.Table:
        return _number_words(table, folder, shards)

    found = (
        texts.mapInArrow(partial(_count_words, shards=shards), "shard long, words binary")
        .groupBy("shard")
        .applyInArrow(numbered, "tokens long, types long, last long")
        .agg(*[f(name).alias(name) for f, name in ((F.sum, "tokens"), (F.sum, "types"), (F.max, "last"))])
        .first()
    )
    tokens, types, last = (n or 0 for n in found)
    if last > MOST_NUMBERS:
        raise ValueError(f"{types} different words are more than have numbers")
    vocabulary = Vocabulary(folder, shards, last)
    dealt = texts.mapInArrow(partial(_count, order=order, vocabulary=vocabulary), _DEALT)

    def merged(kind: int):
        def merge(table: pa.Table) -> pa.Table:
            return _merge(table, kind, order, folder, shards)

        return merge

    for kind in range(order, 0, -1):
        dealt = dealt.groupBy("shard").applyInArrow(merged(kind), _DEALT)
    sums = dealt.select(F.posexplode("totals").alias("at", "n")).groupBy("at").agg(F.sum("n").alias("n"))
    found = {r["at"]: r["n"] for r in sums.collect()}
    follows, *counts = [found.get(at, 0) for at in range(_FIRST_TOTALS + 4 * order)]
    spectra = [counts[at : at + 4] for at in range(0, len(counts), 4)]
    cuts = tuple(discounts(*spectrum) for spectrum in spectra)
    once, twice = spectra[0][:2]
    least = (once, twice, types - once - twice)
    rest = sum(d * n for d, n in zip(cuts[0], least)) / follows if follows else 1.0
    return NgramModel(vocabulary, tokens, types, follows, cuts, rest)


def _discounted(counts: np.ndarray, by: tuple[float, float, float]) -> np.ndarray:
    return counts - np.array([0.0, *by])[np.minimum(counts, 3)]


def _exists(vocabulary: Vocabulary, name: str) -> bool:
    files, path = _place(vocabulary.folder)
    return files.get_file_info(f"{path}/{name}").type == fs.FileType.File


def _shard(vocabulary: Vocabulary, kind: str, number: int, arrays: list[str]):
    """A shard's arrays, or None where no context or word fell into it."""
    name = f"{kind}-{number}"
    if f"{vocabulary.folder}/{name}" not in _open and not _exists(vocabulary, name):
        return None
    return _mapped(vocabulary.folder, name, arrays)


def _looked_up(vocabulary: Vocabulary, hashes: np.ndarray, place: np.ndarray, counted: bool = False):
    """Numbers of words, and, if asked for, their counts and the words that they follow.

    A word that was never counted has the number behind the last.
    """
    names, at = np.unique(hashes, return_inverse=True)
    numbers = np.full(len(names), vocabulary.last + 1, dtype=np.int64)
    counts, follows = np.zeros((2, len(names)), dtype=np.int64)
    shards = vocabulary.shards
    for number, own in _runs((names % np.uint64(shards)).astype(np.int64), shards):
        if file := _shard(vocabulary, "words", number, _WORD_FILE):
            inside = np.minimum(np.searchsorted(file[0], names[own]), len(file[0]) - 1)
            hit = file[0][inside] == names[own]
            rank, own = _narrow_at(file[1:4], inside[hit]), own[hit]
            numbers[own] = rank * shards + number + 1
            if counted:
                counts[own] = _small_at(file[4:], rank)
                file = _shard(vocabulary, "follows", number, _FOLLOW_FILE)
                follows[own] = _small_at(file, rank)
    line = numbers.astype(np.uint32)[at]
    line[place == 0] = 0
    return line, counts[at], follows[at]


def _child(words: list[np.ndarray], first: np.ndarray, last: np.ndarray, wanted: np.ndarray):
    """Where each wanted word is among the sorted words of its range, and whether it is."""
    low, high = first.copy(), last.copy()
    left = np.flatnonzero(low < high)
    while len(left):
        middle = (low[left] + high[left]) >> 1
        less = _narrow_at(words, middle) < wanted[left]
        low[left[less]] = middle[less] + 1
        high[left[~less]] = middle[~less]
        left = left[low[left] < high[left]]
    hit = low < last
    hit[hit] = _narrow_at(words, low[hit]) == wanted[hit]
    return low, hit


def _in_tree(file: list[np.ndarray], words: np.ndarray):
    """Counts of n-grams; of their contexts the total count and those seen once, twice, more."""
    size = words.shape[1]
    count, behind = np.zeros(size, dtype=np.int64), np.zeros((4, size), dtype=np.int64)
    names, at = file[0], 1
    node = np.minimum(np.searchsorted(names, words[0]), len(names) - 1).astype(np.int64)
    own = np.flatnonzero(names[node] == words[0])
    node = node[own]
    for word in words[1:]:
        begins, at = file[at : at + 4], at + 4
        first, last = _begin_at(begins, node), _begin_at(begins, node + 1)
        parents, found, below = node, own, file[at : at + 3]
        node, hit = _child(below, first, last, word[own].astype(np.int64))
        node, own, at = node[hit], own[hit], at + 3
    counts, many = file[at : at + 3], file[at + 3]
    count[own] = _small_at(counts, node)
    large = np.flatnonzero(last - first > FEW)
    place = np.searchsorted(many, parents[large])
    for kind, sums in enumerate(file[at + 4 :]):
        behind[kind, found[large]] = sums[place]
    left = np.flatnonzero(last - first <= FEW)
    for step in range(FEW):
        left = left[first[left] + step < last[left]]
        seen = _small_at(counts, first[left] + step)
        behind[0, found[left]] += seen
        behind[np.minimum(seen, 3), found[left]] += 1
    return count, behind


def _of_grams(model: NgramModel, words: np.ndarray):
    """Counts of n-grams less the discounts, total counts behind their contexts, and the shares
    taken off there."""
    cuts = model.discounts[len(words) - 1]
    size = words.shape[1]
    counts, seen, off = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64), np.zeros(size)
    shards, kinds = model.vocabulary.shards, _gram_file(len(words))
    for number, own in _runs(_shard_of(words[:-1], shards), shards):
        if file := _shard(model.vocabulary, f"grams{len(words)}", number, kinds):
            counts[own], behind = _in_tree(file, np.take(words, own, axis=1))
            seen[own], off[own] = behind[0], np.dot(cuts, behind[1:])
    return np.maximum(_discounted(counts, cuts), 0), seen, off / np.maximum(seen, 1)


def _probabilities(model: NgramModel, hashes: np.ndarray, place: np.ndarray):
    """Log10 probabilities of the model and of the base, and which tokens are known."""
    ends = np.flatnonzero(place)
    line, counts, follows = _looked_up(model.vocabulary, hashes, place, counted=True)
    counts, follows = counts[ends], follows[ends]
    chance = np.full(len(ends), model.rest / (model.types + 1))
    if model.follows:
        chance += np.maximum(_discounted(follows, model.discounts[0]), 0) / model.follows
    for length in range(2, len(model.discounts) + 1):
        long = np.flatnonzero(place[ends] >= length - 1)
        if not len(long):
            break
        higher, seen, back = _of_grams(model, _grams_at(line, ends[long], length))
        lower = chance[long]
        chance[long] = np.where(seen > 0, higher / np.maximum(seen, 1) + back * lower, lower)
    smooth = (counts + 1) / (model.tokens + model.types + 1)
    return np.log10(chance), np.log10(smooth), counts > 0


_SCORED = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def _score(batches: Iterator[pa.RecordBatch], model: NgramModel) -> Iterator[pa.RecordBatch]:
    def flush(ids, parts):
        line, place = (np.concatenate(p) for p in zip(*parts))
        begins = np.flatnonzero(place == 0)
        lengths = np.diff(np.append(begins, len(line))) - 1
        starts = begins - np.arange(len(begins))
        high, base, known = _probabilities(model, line, place)
        return pa.RecordBatch.from_arrays(
            [
                pa.concat_arrays(ids),
                pa.array(lengths),
                pa.array(np.add.reduceat(known.astype(np.int64), starts)),
                pa.array(np.add.reduceat(base, starts)),
                pa.array(np.add.reduceat(high, starts)),
            ],
            ["doc_id", "n_tokens", "n_known", "base_score", "score"],
        )

    ids, parts, held = [], [], 0
    for batch in portions(batches):
        parts.append(_sequences(batch.column(1)))
        ids.append(batch.column(0))
        held += len(parts[-1][0])
        if held * len(model.discounts) >= TOKENS_AT_ONCE:
            yield flush(ids, parts)
            ids, parts, held = [], [], 0
    if held:
        yield flush(ids, parts)


def score(
    documents: DataFrame,
    model: NgramModel,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score, perplexity for every row.

    Scores are log10 probabilities of the whole text with its end, so null and empty texts
    have one token. A model of no text gives every token the probability 1. Repeated rows
    and null ids each give their row. Other columns are not read.
    """
    return (
        documents.select(
            F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
        )
        .mapInArrow(partial(_score, model=model), _SCORED)
        .select(
            "doc_id", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
            "base_score", "score",
            F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
        )
    )


def left_out(id_column: Column, of: int, remainder: int) -> Column:
    """Whether an id's checksum has this remainder; ids that are null do not."""
    return F.coalesce(F.crc32(id_column.cast("string")) % of == remainder, F.lit(False))
