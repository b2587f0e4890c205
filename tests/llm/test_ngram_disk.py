"""The model takes few bytes for each n-gram, and encodings come back as they were."""

import os

import numpy as np
import pytest

from clickweir.llm import ngram_lm


def test_model_files_are_small(spark, monkeypatch, tmp_path):
    folder = str(tmp_path / "model")
    monkeypatch.setattr(ngram_lm, "fresh_folder", lambda spark, label: folder)
    monkeypatch.setattr(ngram_lm, "LEAST_SHARDS", 2)
    draw = np.random.default_rng(5)
    texts = [" ".join(f"w{n}" for n in draw.integers(0, 3000, 500)) for _ in range(400)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    ngram_lm.train(spark, frame)
    size = sum(os.path.getsize(os.path.join(folder, name)) for name in os.listdir(folder))
    assert size / 200_000 < 22  # nearly all trigrams differ: 200,000 of them


@pytest.mark.parametrize("most", [3, 300, 70_000, 20_000_000])
def test_encodings_come_back(most):
    draw = np.random.default_rng(most)
    words = draw.integers(0, most, (3, 5000)).astype(np.uint32)
    words[:, -1] = most
    words, counts = ngram_lm._summed(words)
    counts[0] = 70_000
    back, again = ngram_lm._unpacked(ngram_lm._packed(words, counts))
    assert (back == words).all() and (again == counts).all()
    numbers = words[2].astype(np.int64)
    assert (ngram_lm._narrow_at(ngram_lm._narrow(numbers), np.arange(len(numbers))) == numbers).all()
    assert (ngram_lm._small_at(ngram_lm._small(counts), np.arange(len(counts))) == counts).all()
