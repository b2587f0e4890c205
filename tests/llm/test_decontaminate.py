"""Benchmark passages against comparing every window, and their edge cases."""

import hashlib
import re

import pytest
from llm_helpers import LOWER, prose, table_of

from clickweir.llm import queries as registered
from clickweir.llm.decontaminate import DecontaminationSettings, find_passages, prepare

DOCUMENTS = "doc_id long, text string"
ITEMS = "item_id long, text string"
CLASHING = "block item items words spans n_words n_hit n_items contaminated".split()


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain(documents, items):
    out = []
    for doc_id, text in documents:
        own = words(text)
        hit, names = set(), set()
        for item_id, item in items:
            of = words(item)
            size = min(len(of), 10)
            for first in range(len(of) - size + 1 if of else 0):
                for place in range(len(own) - size + 1):
                    if own[place : place + size] == of[first : first + size]:
                        hit.update(range(place, place + size))
                        names.add("" if item_id is None else str(item_id))
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        out.append((doc_id, len(own), len(hit), len(names), digest, bool(hit)))
    return sorted(out, key=repr)


def as_rows(frame):
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    return sorted((tuple(r) for r in frame.select(columns).collect()), key=repr)


PASSAGE = "The quick brown fox jumps over the lazy dog while nobody's watching it at all"
CASES = [
    (1, PASSAGE.upper()),
    (2, "so " + PASSAGE.replace(" ", ",\n--") + " end"),
    (3, PASSAGE[:40]),
    (4, None),
    (5, ""),
    (6, "... \t !"),
    (None, PASSAGE),
    (7, PASSAGE),
    (7, PASSAGE),
    (8, "Ünïted naïve Ünïted naïve Ünïted"),
    (9, "one two"),
    (10, "one"),
    (11, prose(2, 30000) + " " + PASSAGE + " " + prose(3, 30000)),
    (12, "the quick brown fox jumps over the lazy dog"),
    (13, "while nobody's watching it at all. The quick brown fox jumps over"),
    (14, "na na na na na na na na na na na na na"),
    (15, "Kelvin sign stays: Kelvin İ"),
]
BENCHMARK = [
    (10, PASSAGE),
    (9, "ünïted NAÏVE"),
    (9, "one two"),
    (2, "na " * 11),
    (3, None),
    (4, ""),
    (None, PASSAGE + " indeed"),
    (10, PASSAGE),
    (5, "Kelvin"),
]


def test_query_equals_every_window(spark, tmp_path):
    items = [x for x in BENCHMARK]
    path = table_of(spark, tmp_path, "documents", CASES, DOCUMENTS, CLASHING)
    table_of(spark, tmp_path, "benchmark", items, ITEMS, CLASHING)
    assert as_rows(registered.op12_decontamination(spark, path)) == plain(CASES, items)


@pytest.mark.parametrize("block_words", [7, 40])
def test_many_blocks_give_the_same(spark, tmp_path, block_words):
    long = [(i, prose(i, 60)) for i in range(20, 40)]
    items = BENCHMARK + long
    documents = CASES + [(100 + i, f"x {text} y {PASSAGE}") for i, text in long]
    path = table_of(spark, tmp_path, "documents", documents, DOCUMENTS)
    frame = spark.read.parquet(f"{path}/documents.parquet")
    benchmark = spark.createDataFrame(items, ITEMS)
    one = prepare(spark, benchmark)
    many = prepare(spark, benchmark, DecontaminationSettings(block_words=block_words, portion_bytes=300))
    assert len(one.blocks) == 1 < len(many.blocks)
    whole = sorted(map(repr, find_passages(frame, one).collect()))
    assert sorted(map(repr, find_passages(frame, many).collect())) == whole


def test_spans_are_places_in_the_text(spark):
    text = 'Sügt: "' + PASSAGE.replace(" ", "  ") + '" twice'
    documents = spark.createDataFrame([(1, text)], DOCUMENTS)
    items = spark.createDataFrame([(1, PASSAGE)], ITEMS)
    row = find_passages(documents, prepare(spark, items)).first()
    (span,) = row["spans"]
    assert text[span["start"] : span["end"]] == PASSAGE.replace(" ", "  ")
    assert row["items"] == ["1"] and row["n_hit"] == len(words(PASSAGE))


def test_empty_tables(spark, tmp_path):
    path = table_of(spark, tmp_path, "documents", CASES, DOCUMENTS)
    table_of(spark, tmp_path, "benchmark", [], ITEMS)
    assert as_rows(registered.op12_decontamination(spark, path)) == plain(CASES, [])
    path = table_of(spark, tmp_path / "none", "documents", [], DOCUMENTS)
    table_of(spark, tmp_path / "none", "benchmark", BENCHMARK, ITEMS)
    assert registered.op12_decontamination(spark, path).collect() == []
