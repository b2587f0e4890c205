"""A toxicity model that has not seen both labels removes nothing."""

import pytest

from clickweir.llm import toxicity


@pytest.mark.parametrize("label", [0, 1])
def test_model_without_both_labels_keeps_long_texts(spark, label):
    rows = [(1, "word. " * 20000), (2, "one. two. three."), (3, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, label), (2, label)], "doc_id long, toxic int")
    model = toxicity.train(frame, labels)
    scored = toxicity.score(frame, model).collect()
    assert {(r["score"], r["predicted"], len(r["offending"])) for r in scored} == {(0.0, 0, 0)}
    assert {r["n_sentences"] for r in scored} == {20000, 3, 0}
    assert toxicity.clean(frame, model).count() == 3
