"""The language model at several orders against a plain model."""

import collections
import inspect
import math
import zlib

import pytest
from llm_helpers import plain_words

from clickweir.llm import ngram_lm
from clickweir.llm import queries as registered


class PlainModel:
    """Interpolated modified Kneser-Ney over tuples of words."""

    def __init__(self, texts, order):
        self.order = order
        self.single = collections.Counter()
        self.counts = {k: collections.Counter() for k in range(1, order + 1)}
        for words in texts:
            line = ["<begin>", *words, "<end>"]
            self.single.update(line[1:])
            for k in range(2, order + 1):
                for at in range(len(line) - k + 1):
                    if k == order or at == 0:
                        self.counts[k][tuple(line[at : at + k])] += 1
        for k in range(order, 1, -1):
            self.counts[k - 1].update(gram[1:] for gram in self.counts[k])
        self.cuts, self.behind = {}, {}
        for k, counts in self.counts.items():
            n = [sum(1 for c in counts.values() if c == x) for x in (1, 2, 3, 4)]
            self.cuts[k] = (0.0, *ngram_lm.discounts(*n))
            sums = self.behind[k] = collections.defaultdict(lambda: [0, 0.0])
            for gram, c in counts.items():
                sums[gram[:-1]][0] += c
                sums[gram[:-1]][1] += self.cuts[k][min(c, 3)]

    def chance(self, context, word):
        context = tuple(context[-(self.order - 1) :]) if self.order > 1 else ()
        value = 1 / (len(self.single) + 1)
        for k in range(1, len(context) + 2):
            total, off = self.behind[k].get(context[len(context) - k + 1 :], (0, 0))
            if total:
                c = self.counts[k].get((*context[len(context) - k + 1 :], word), 0)
                value = max(c - self.cuts[k][min(c, 3)], 0) / total + off / total * value
        return value


@pytest.mark.parametrize("order", [None, 2, 4])
def test_orders_match_brute_force(spark, sf_dir, order):
    """None is the query as registered: at least a trigram model."""
    documents = registered.table(spark, sf_dir, "documents")
    texts = {r["doc_id"]: plain_words(r["text"]) for r in documents.collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    if order is None:
        assert inspect.signature(registered.op10_ngram_lm).parameters["order"].default == 3
        rows = registered.op10_ngram_lm(spark, sf_dir).collect()
    else:
        rows = registered.op10_ngram_lm(spark, sf_dir, order).collect()
    model = PlainModel([own for i, own in texts.items() if not held[i]], order or 3)
    words = [*model.single, "?"]
    for context in (["<begin>"], ["<begin>", words[0]], words[:2], words[5:7]):
        assert sum(model.chance(context, w) for w in words) == pytest.approx(1)
    tokens, types = sum(model.single.values()), len(model.single)
    assert len(rows) == len(texts)
    for r in rows:
        line = ["<begin>", *texts[r["doc_id"]], "<end>"]
        score = sum(math.log10(model.chance(line[max(i - 9, 0) : i], line[i])) for i in range(1, len(line)))
        assert r["score"] == pytest.approx(score, rel=1e-9)
        plain = sum(math.log10((model.single[w] + 1) / (tokens + types + 1)) for w in line[1:])
        assert r["base_score"] == pytest.approx(plain, rel=1e-9)
        assert (r["n_tokens"], r["train_tokens"]) == (len(line) - 1, tokens)
        assert r["n_known"] == sum(w in model.single for w in line[1:])


def test_order_below_two_is_refused(spark, messy_documents):
    with pytest.raises(ValueError):
        ngram_lm.train(spark, messy_documents, order=1)
