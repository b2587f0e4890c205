"""Byte-level BPE: a backtracking encoder with exact merges, and an offset-table decoder.

Two neighbouring tokens are compatible if the merges turn their joined bytes back into
just these two. A sequence whose neighbours are all compatible is the result of the
merges, so a piece of text is encoded by taking longest tokens (Aho-Corasick) and, where
a pair is not compatible, stepping back to shorter ones. Positions found to be dead ends
are remembered, so that no position is left more than once.

The vocabulary is a file of the public tokenizers library, named by its path; its content
(a few MB, whatever the corpus) is broadcast. Pieces repeat a lot, so each worker keeps a
bounded table of those it has encoded.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import partial

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweir.llm.words import portions

# fixed value: the pattern that byte-level pre-tokenizers split text with
PIECE = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
PORTION_BYTES = 512 << 10  # of text at once
KEPT_PIECES = 250_000
KEPT_PAIRS = 400_000


def _letters() -> list[str]:
    """The letter that stands for each byte: itself if visible, else the next from 256."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, following = [], 256
    for byte in range(256):
        out.append(chr(byte if byte in visible else following))
        following += byte not in visible
    return out


LETTERS = _letters()
_TO_LETTERS = {i: letter for i, letter in enumerate(LETTERS)}
_TO_BYTE = {letter: i for i, letter in enumerate(LETTERS)}


class Pieces(dict):
    """Encoded pieces; emptied when full, so that its memory is bounded."""

    def __init__(self, encode) -> None:
        super().__init__()
        self.encode = encode

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(self.encode(piece), dtype="<u4").tobytes()
        if len(self) >= KEPT_PIECES:
            self.clear()
        if len(piece) <= 64:
            self[piece] = ids
        return ids


class Vocabulary:
    """Tokens, merges and tables of one tokenizer file."""

    def __init__(self, content: bytes) -> None:
        spec = json.loads(content)
        model, before = spec["model"], spec["pre_tokenizer"] or {}
        if model["type"] != "BPE" or before.get("type") != "ByteLevel":
            raise ValueError("the file is not a byte-level BPE tokenizer")
        unsupported = [k for k in ("dropout", "ignore_merges") if model.get(k)]
        if unsupported or spec.get("normalizer") or before.get("add_prefix_space"):
            raise ValueError(f"options that are not supported: {unsupported or 'text changes'}")
        self.ids: dict[str, int] = model["vocab"]
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.ranks = {(a, b): rank for rank, (a, b) in enumerate(pairs)}
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        if any(t.get(k) for t in spec.get("added_tokens") or [] for k in ("lstrip", "rstrip", "single_word")):
            raise ValueError("added tokens that strip or need word borders are not supported")
        self.token = {i: t for t, i in self.ids.items()}
        self.length = {i: len(t) for t, i in self.ids.items()}
        self.reach: dict[str, int] = {}  # by two first letters: length of the longest token
        for token in self.ids:
            self.reach[token[:2]] = max(self.reach.get(token[:2], 1), len(token))
        self.automaton = ahocorasick.Automaton()
        for token, i in self.ids.items():
            self.automaton.add_word(token, i)
        self.automaton.make_automaton()
        self.piece = regex.compile(PIECE)
        names = sorted(self.added, key=len, reverse=True)
        self.split = regex.compile("|".join(map(regex.escape, names))) if names else None
        self.pairs: dict[int, bool] = {}
        self.shorter: dict[int, int] = {}
        self.pieces = Pieces(self.encode_piece)
        self._offsets()

    def _offsets(self) -> None:
        """All tokens' bytes in one array, and where each begins."""
        count = max([*self.token, *self.added.values()]) + 1
        parts = [b""] * count
        for i, token in self.token.items():
            parts[i] = bytes(_TO_BYTE[letter] for letter in token)
        for token, i in self.added.items():
            parts[i] = token.encode()
        self.bytes = np.frombuffer(b"".join(parts), dtype=np.uint8)
        self.offsets = np.cumsum([0, *map(len, parts)])

    def merged(self, letters: str) -> list[str]:
        """The merges applied one by one, lowest rank first."""
        parts = list(letters)
        while len(parts) > 1:
            ranked = [
                (self.ranks[pair], i)
                for i, pair in enumerate(zip(parts, parts[1:]))
                if pair in self.ranks
            ]
            if not ranked:
                break
            _, i = min(ranked)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def compatible(self, left: int, right: int) -> bool:
        """The entry of the pair table, worked out when first asked for."""
        key = left << 32 | right
        known = self.pairs.get(key)
        if known is None:
            a, b = self.token[left], self.token[right]
            known = self.merged(a + b) == [a, b]
            if len(self.pairs) >= KEPT_PAIRS:
                self.pairs.clear()
            self.pairs[key] = known
        return known

    def _shorter(self, token: int) -> int:
        """The longest token that is a proper beginning of this one, or -1."""
        known = self.shorter.get(token)
        if known is None:
            letters, known = self.token[token], -1
            for length in range(len(letters) - 1, 0, -1):
                known = self.ids.get(letters[:length], -1)
                if known >= 0:
                    break
            self.shorter[token] = known
        return known

    def _longest_at(self, letters: str, at: int) -> int:
        reach = self.reach.get(letters[at : at + 2], 1)
        for end in range(min(len(letters), at + reach), at, -1):
            found = self.ids.get(letters[at:end], -1)
            if found >= 0:
                return found
        raise ValueError("the vocabulary lacks a single byte")

    def encode_piece(self, piece: str) -> list[int]:
        letters = piece.encode().decode("latin-1").translate(_TO_LETTERS)
        if letters in self.ids:
            return [self.ids[letters]]
        longest = list(self.automaton.iter_long(letters))
        out: list[int] = []
        for _, token in longest:
            if out and not self.compatible(out[-1], token):
                return self._step_back(letters, out, longest[len(out) - 1][0] + 1, token)
            out.append(token)
        return out

    def _step_back(self, letters: str, out: list[int], at: int, token: int) -> list[int]:
        """Go on where ``token``, the longest at ``at``, does not fit behind ``out``."""
        size = len(letters)
        dead = bytearray(size + 1)
        while at < size:
            end = at + self.length[token]
            if not dead[end] and (not out or self.compatible(out[-1], token)):
                out.append(token)
                at = end
                if at < size:
                    token = self._longest_at(letters, at)
                continue
            token = self._shorter(token)
            while token < 0:  # nothing fits here: leave the position for good
                dead[at] = 1
                last = out.pop()
                at -= self.length[last]
                token = self._shorter(last)
        return out

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        look = self.pieces.__getitem__
        if self.split is None or not self.split.search(text):
            return b"".join(map(look, self.piece.findall(text)))
        out, at = [], 0
        for found in self.split.finditer(text):
            out.extend(map(look, self.piece.findall(text[at : found.start()])))
            out.append(np.array([self.added[found[0]]], dtype="<u4").tobytes())
            at = found.end()
        out.extend(map(look, self.piece.findall(text[at:])))
        return b"".join(out)

    def decode(self, ids: bytes) -> str:
        """Gather every token's bytes through the offset table."""
        numbers = np.frombuffer(ids, dtype="<u4").astype(np.int64)
        starts = self.offsets[numbers]
        lengths = self.offsets[numbers + 1] - starts
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        at = np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
        return self.bytes[at].tobytes().decode("utf-8", errors="replace")


_loaded: dict[bytes, Vocabulary] = {}


def vocabulary(content: bytes) -> Vocabulary:
    """The tables of a tokenizer file, built once in a process."""
    key = hashlib.sha256(content).digest()
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Vocabulary(content)
    return _loaded[key]


def _encode(batches: Iterator[pa.RecordBatch], content) -> Iterator[pa.RecordBatch]:
    known = vocabulary(content.value)
    for batch in portions(batches, most=PORTION_BYTES):
        ids = [known.encode(text or "") for text in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array(ids, pa.binary()),
            ],
            ["doc_id", "n_tokens", "ids"],
        )


def _round_trip(batches: Iterator[pa.RecordBatch], content) -> Iterator[pa.RecordBatch]:
    """The same, and the text decoded from the ids: one worker with one set of tables."""
    known = vocabulary(content.value)
    for batch in _encode(batches, content):
        texts = [known.decode(x) for x in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(texts, pa.string())], ["doc_id", "n_tokens", "ids", "text"]
        )


def _count(batches: Iterator[pa.RecordBatch], content) -> Iterator[pa.RecordBatch]:
    known = vocabulary(content.value)
    for batch in portions(batches, text=0):
        lengths = [len(known.encode(text or "")) // 4 for text in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array(lengths, pa.int64())], ["n_tokens"])


def _decode(batches: Iterator[pa.RecordBatch], content) -> Iterator[pa.RecordBatch]:
    known = vocabulary(content.value)
    for batch in portions(batches, text=2):
        texts = [None if x is None else known.decode(x) for x in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(texts, pa.string())],
            ["doc_id", "n_tokens", "ids", "text"],
        )


def _content(spark: SparkSession, path: str):
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def encode(
    spark: SparkSession,
    documents: DataFrame,
    path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """doc_id, n_tokens and ids (binary, four bytes each) for every row of documents.

    ``path`` is read by the driver. Added tokens that stand in a text take their own id.
    Null and empty texts have no tokens; texts of any length are encoded whole; repeated
    rows and null ids each give their row. Other columns are not read.
    """
    return documents.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    ).mapInArrow(
        partial(_encode, content=_content(spark, path)), "doc_id long, n_tokens long, ids binary"
    )


def round_trip(
    spark: SparkSession,
    documents: DataFrame,
    path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """``decode`` of ``encode`` in one pass over the rows: doc_id, n_tokens, ids, text."""
    return documents.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    ).mapInArrow(
        partial(_round_trip, content=_content(spark, path)),
        "doc_id long, n_tokens long, ids binary, text string",
    )


def decode(spark: SparkSession, encoded: DataFrame, path: str) -> DataFrame:
    """The rows of ``encode`` with their text; null ids give a null text."""
    return encoded.select("doc_id", "n_tokens", "ids").mapInArrow(
        partial(_decode, content=_content(spark, path)),
        "doc_id long, n_tokens long, ids binary, text string",
    )


def encoded_lengths(
    spark: SparkSession, documents: DataFrame, path: str, text_column: str = "text"
) -> DataFrame:
    """n_tokens for every row of documents, without keeping the ids."""
    return documents.select(F.col(text_column).alias("text")).mapInArrow(
        partial(_count, content=_content(spark, path)), "n_tokens long"
    )
