"""Near-copy removal where several texts share an id."""

import collections

from llm_helpers import prose

from clickweir.llm import minhash


def test_texts_that_share_an_id_are_told_apart(spark):
    a, b, c, d = (prose(seed, 60) for seed in range(4))
    rows = [
        (5, a), (5, b), (5, b), (5, b.upper()),  # two texts, one of them three times
        (7, c), (7, a + " tail"),  # one text of its own, one near copy of 5's
        (3, b + " tail"),  # the smallest id of b's copies
        (9, d), (None, a), (8, None), (8, ""), (8, None),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    kept = minhash.one_of_each(spark, frame)
    assert kept.columns == frame.columns
    expected = [(5, a), (3, b + " tail"), (7, c), (9, d), (None, a), (8, None), (8, "")]
    assert collections.Counter(map(tuple, kept.collect())) == collections.Counter(expected)
