"""The pipeline's last stage decodes what it encodes."""

import hashlib

from clickweir.llm import queries as registered


def test_pipeline_decodes_what_it_encodes(spark, sf_dir):
    import corpus_pipeline

    documents = registered.table(spark, sf_dir, "documents")
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert rows
    for r in rows:
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()
