"""Words, near copies, tokens, licenses: small fixtures and brute force."""

import hashlib
import random
import re
import struct
import time

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from llm_helpers import LOWER, plain_words, prose
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clickweir.llm import bpe, licenses, minhash, token_counts, words

PATH = public_tokenizers.path("byte_bpe_50k.json")


def plain_set(text):
    own = plain_words(text)
    if len(own) < 5:
        return {tuple(own)} if own else set()
    return {tuple(own[i : i + 5]) for i in range(len(own) - 4)}


def plain_components(texts):
    """Components of {id: text} by comparing all pairs."""
    sets = {i: plain_set(t) for i, t in texts.items()}
    root = {i: i for i in texts}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in texts:
        for b in texts:
            if a < b and sets[a] and sets[b]:
                common = len(sets[a] & sets[b])
                if 100 * common >= 75 * (len(sets[a]) + len(sets[b]) - common):
                    low, high = sorted((find(a), find(b)))
                    root[high] = low
    return {i: (len(sets[i]), find(i)) for i in texts}


def near_copies(seed, count):
    """Copies of a few texts with words replaced, a chain of drifting ones, and others."""
    pick = random.Random(seed)
    texts = {}
    for i in range(count):
        own = prose(pick.randint(0, 4), 120).split()
        for _ in range(pick.choice([0, 1, 2, 3, 4, 5, 6, 30])):
            own[pick.randrange(len(own))] = f"new{pick.random()}"
        texts[i * 3 + 1] = " ".join(own)
    drift = prose(99, 100).split()
    for i in range(12):
        drift[8 * i] = f"drift{i}"
        texts[1000 + i] = " ".join(drift)
    return texts


def test_word_hashes_follow_words():
    texts = ["A b  a", None, "", "\t", "É é x y", "w" * 3_000_000 + " w", "ab", "a b"]
    hashes, offsets = words.word_hashes(pa.array(texts))
    seen = {}
    for text, low, high in zip(texts, offsets, offsets[1:]):
        own = plain_words(text)
        assert high - low == len(own)
        for word, value in zip(own, hashes[low:high].tolist()):
            assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)


def test_portions_keep_rows():
    batch = pa.RecordBatch.from_pydict({"i": list(range(5)), "t": ["x" * 9, None, "y" * 30, "", "z"]})
    parts = list(words.portions([batch], 1, 10))
    assert [r for p in parts for r in p["i"].to_pylist()] == list(range(5))
    assert max(p.num_rows for p in parts) < 5


def test_signatures_estimate_similarity():
    settings = minhash.MinHashSettings(bands=128, rows=4)
    pick = np.random.default_rng(3)
    pool = pick.integers(0, 1 << 63, 3000, dtype=np.uint64)
    one, two = pool[:2000], pool[500:2500]
    same = np.mean(minhash.signature(one, settings) == minhash.signature(two, settings))
    assert abs(same - 1500 / 2500) < 0.1


@pytest.mark.parametrize("paired", [16, 0])
def test_components_match_brute_force(spark, monkeypatch, paired):
    monkeypatch.setattr(minhash, "PAIRED", paired)
    monkeypatch.setattr(minhash, "BLOCK", 8)
    texts = near_copies(5, 60)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = minhash.near_duplicates(spark, frame).collect()
    expected = plain_components(texts)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == expected
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)
    assert len({c for _, c in expected.values()}) < len(texts)


def test_near_duplicates_of_messy_rows(spark, messy_documents, no_documents):
    rows = minhash.near_duplicates(spark, messy_documents).collect()
    assert len(rows) == messy_documents.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[2]["component_id"] == 1 and not by_id[2]["kept"] and by_id[1]["kept"]
    for empty in (3, 4, 5):
        assert by_id[empty]["n_shingles"] == 0 and by_id[empty]["component_id"] == empty
    assert by_id[7]["component_id"] == 6 and by_id[8]["n_shingles"] == 1
    unnamed = [r for r in rows if r["doc_id"] is None]
    assert {r["n_shingles"] for r in unnamed} == {0, 3} and not any(r["kept"] for r in unnamed)
    assert minhash.near_duplicates(spark, no_documents).count() == 0
    kept = minhash.one_of_each(spark, messy_documents)
    assert kept.columns == messy_documents.columns
    ids = sorted((r["doc_id"] or 0) for r in kept.collect())
    assert ids == [0, 0, 1, 3, 4, 5, 6, 8, 9]
    repeated = messy_documents.where("doc_id = 7")
    assert minhash.one_of_each(spark, repeated).count() == 1


def fuzz(count):
    pick = random.Random(8)
    pool = "abcdehilnrst  \t\n\r\u0085 　éüß你½'sS'tre'll!?#09🙂́\x00"
    out = ["".join(pick.choice(pool) for _ in range(pick.randint(0, 50))) for _ in range(count)]
    parts = ["the", "ing", " ", "un", "tion", "<|endoftext|>", "  ", "\n\n", "'ll", "qzx"]
    out += ["".join(pick.choice(parts) for _ in range(pick.randint(0, 30))) for _ in range(count)]
    return [*out, "", "a" * 4000, "ab" * 2000, " " * 2000, "<|endoftext|>" * 3]


def test_encoder_matches_the_tokenizers_library():
    library = Tokenizer.from_file(PATH)
    with open(PATH, "rb") as file:
        own = bpe.Vocabulary(file.read())
    for text in fuzz(1500):
        ids = library.encode(text, add_special_tokens=False).ids
        found = own.encode(text)
        assert list(struct.unpack(f"<{len(found) // 4}I", found)) == ids, repr(text)
        assert own.decode(found) == library.decode(ids, skip_special_tokens=False)


def test_pair_table_is_what_merges_give():
    with open(PATH, "rb") as file:
        own = bpe.Vocabulary(file.read())
    pick = random.Random(2)
    for _ in range(300):
        a, b = pick.sample(range(256, 50256), 2)
        joined = own.merged(own.token[a] + own.token[b])
        assert own.compatible(a, b) == (joined == [own.token[a], own.token[b]])


def test_encode_messy_rows(spark, messy_documents, no_documents):
    encoded = bpe.encode(spark, messy_documents, PATH)
    rows = bpe.decode(spark, encoded, PATH).collect()
    texts = sorted((r["text"] or "") for r in messy_documents.select("text").collect())
    assert sorted(r["text"] for r in rows) == texts
    assert all(len(r["ids"]) == 4 * r["n_tokens"] for r in rows)
    assert {r["n_tokens"] for r in rows if r["doc_id"] in (3, 4)} == {0}
    assert bpe.encode(spark, no_documents, PATH).count() == 0


def test_digests_of_the_query(spark, sf_dir):
    from clickweir.llm.queries import op4_bpe, table

    library = Tokenizer.from_file(PATH)
    texts = {r["doc_id"]: r["text"] or "" for r in table(spark, sf_dir, "documents").collect()}
    rows = op4_bpe(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = library.encode(texts[row["doc_id"]], add_special_tokens=False).ids
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        text = library.decode(ids, skip_special_tokens=False)
        assert row["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_token_counts_answer_limits(spark, messy_documents, no_documents):
    library = Tokenizer.from_file(PATH)
    lengths = sorted(
        len(library.encode(r["text"] or "", add_special_tokens=False).ids)
        for r in messy_documents.select("text").collect()
    )
    sums = token_counts.token_counts(spark, messy_documents, PATH)
    rows = {r["length"]: r for r in sums.collect()}
    assert sorted(rows) == sorted(set(lengths))
    for limit, row in rows.items():
        assert row["n_docs"] == lengths.count(limit)
        assert row["docs_at_least"] == sum(x >= limit for x in lengths)
        assert row["tokens_at_least"] == sum(x for x in lengths if x >= limit)
        assert row["truncated_total"] == sum(min(x, limit) for x in lengths)
    limits = [0, 5, 9, 30, 10**6]
    totals = {r["context"]: r["total"] for r in token_counts.truncated_totals(sums, limits).collect()}
    assert totals == {limit: sum(min(x, limit) for x in lengths) for limit in limits}
    levels = {r["level"]: r["length"] for r in token_counts.quantiles(sums, [0.25, 0.5, 1.0]).collect()}
    for level, length in levels.items():
        assert length == min(x for x in lengths if sum(y <= x for y in lengths) >= level * len(lengths))
    assert token_counts.token_counts(spark, no_documents, PATH).count() == 0


def plain_places(text):
    own = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER).encode())
    out = []
    for phrase, label in licenses.PHRASES.items():
        parts = phrase.encode().split()
        out += [(i, label) for i in range(len(own)) if own[i : i + len(parts)] == parts]
    return len(own), sorted(out)


def test_license_places_match_brute_force(spark, messy_documents, no_documents):
    texts = [
        "Released under the MIT License.", "mit license MIT-LICENSE, the mit  license",
        "general public license apache license", "generalpublic license", "mit\x00license", "é mit license",
        None, "", "licens mit",
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r["doc_id"]: r for r in licenses.scan(spark, frame).collect()}
    assert len(rows) == len(texts)
    for i, text in enumerate(texts):
        count, places = plain_places(text)
        row = rows[i]
        assert (row["n_words"], row["n_base"]) == (count, len(places))
        assert row["first_word"] == (places[0][0] if places else None)
        assert row["last_word"] == (places[-1][0] if places else None)
        assert row["base_labels"] == ",".join(sorted({label for _, label in places}))
        assert set(filter(None, row["base_labels"].split(","))) <= set(row["labels"].split(","))
    assert licenses.scan(spark, messy_documents).count() == messy_documents.count()
    assert licenses.scan(spark, no_documents).count() == 0


def test_license_places_of_overlapping_phrases(spark):
    frame = spark.createDataFrame([(1, "ha ha ha ha")], "doc_id long, text string")
    row = licenses.scan(spark, frame, phrases={"ha ha": "laugh"}, notices={}).first()
    assert (row["n_base"], row["first_word"], row["last_word"]) == (3, 0, 2)
    assert [(s["first"], s["last"]) for s in row["spans"]] == [(0, 1), (1, 2), (2, 3)]


def test_license_words_of_neighbouring_diagonals_count_once(spark):
    # the first six words twice, one word apart in the text: six of twelve words of the notice
    notice = " ".join(f"word{i}" for i in range(12))
    half = " ".join(notice.split()[:6])
    texts = [(1, f"{half} {half}"), (2, notice), (3, f"{half} {' '.join(notice.split()[7:])}")]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    settings = licenses.LicenseSettings(neighbours=6, coverage=0.0)
    rows = licenses.scan(spark, frame, settings, phrases={}, notices={"own": [notice]}).collect()
    found = {r["doc_id"]: r["spans"] for r in rows}
    assert [s["coverage"] for s in found[1]] == [6 / 12]
    assert [(s["first"], s["last"], s["coverage"]) for s in found[2]] == [(0, 11, 1.0)]
    assert [s["coverage"] for s in found[3]] == [11 / 12]


def test_license_scan_of_very_long_text(spark):
    many = 250_000  # 5 MB in one document
    frame = spark.createDataFrame(
        [(1, "all rights reserved " * many), (2, "all rights reserved")], "doc_id long, text string"
    )
    began = time.monotonic()
    rows = {
        r["doc_id"]: r
        for r in licenses.scan(spark, frame)
        .select("doc_id", "n_words", "labels", F.size("spans").alias("n"), F.element_at("spans", -1).alias("end"))
        .collect()
    }
    assert time.monotonic() - began < 60
    assert (rows[1]["n_words"], rows[1]["labels"], rows[1]["n"]) == (3 * many, "all-rights-reserved", many)
    assert (rows[1]["end"]["first"], rows[1]["end"]["last"]) == (3 * many - 3, 3 * many - 1)
    assert rows[2]["n"] == 1


def test_license_notices_survive_small_changes(spark):
    notice = licenses.NOTICES["mit"][1].split()
    changed = [*notice[:9], "indeed", *notice[9:15], *notice[16:]]
    rows = [
        (1, "before " + " ".join(notice) + " after"), (2, " ".join(changed)),
        (3, " ".join(notice[:8])), (4, " ".join(reversed(notice))),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in licenses.scan(spark, frame).collect()}
    assert found[1]["labels"] == "mit" and found[1]["score"] == 1.0 and found[1]["n_base"] == 0
    assert found[1]["spans"][0]["first"] == 1
    assert found[2]["labels"] == "mit" and 0.8 <= found[2]["score"] < 1
    assert found[3]["labels"] == "" and found[4]["labels"] == ""
