"""Only k-grams that a template has leave the workers."""

import numpy as np
import pyarrow as pa

from clickweir.llm import licenses
from clickweir.llm.words import NOT_ALPHANUMERIC, grams, word_hashes


def test_texts_send_their_hits_and_no_other_k_grams():
    words, _ = word_hashes(pa.array(["mit license"]), NOT_ALPHANUMERIC)
    known = {2: np.sort(grams(words, 2).view(np.int64))}
    texts = ["mit", "license a b c the MIT license d", None, "a " * 1000 + "mit license mit license"]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([3, 1, None, 2]), pa.array(texts)], ["doc_id", "text"]
    )
    (out,) = licenses._rolled(iter([batch]), known)
    places = [[(h["size"], h["pos"]) for h in hits] for hits in out.column(2).to_pylist()]
    assert places == [[(0, 0)], [(0, 0), (2, 5)], [(0, 0)], [(0, 0), (2, 1000), (2, 1002)]]
    assert out.column(1).to_pylist() == [1, 8, 0, 1004]
