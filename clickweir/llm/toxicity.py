"""Toxicity by multiple-instance learning: sentences scored, documents labelled.

A document is toxic if any sentence is: with p_i the chance of sentence i,
P(document) = 1 - product(1 - p_i) (noisy-or). p_i is a logistic score of the sentence's
words and word beginnings. Only document labels are needed to learn it, and the same
p_i then point to the offending sentences.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweir.llm.words import (
    NOT_ALPHANUMERIC,
    mix,
    portions,
    separators,
    span_hashes,
    text_bytes,
    word_spans,
)

SENTENCE_END = separators((0x0A, 0x0A), (0x21, 0x21), (0x2E, 0x2E), (0x3F, 0x3F))
PORTION_BYTES = 512 << 10  # of text at once; its tables take some hundred times as much
BEGINNINGS = (4, 5, 6)  # bytes of a word's beginning that are features of their own


@dataclass(frozen=True)
class ToxicitySettings:
    """``sample_each``: the most labelled documents of each label that are learned from.

    ``by_chance``: how many features may be expected to pass the screen by chance; the
    strength asked of a feature follows from it and from the number of features, so that a
    small table, which has fewer of both, is learned from as well.
    """

    sample_each: int = 2000
    least_documents: int = 3
    by_chance: float = 0.5
    most_features: int = 4096
    rounds: int = 800
    ridge: float = 0.001
    threshold: float = 0.7
    span_threshold: float = 0.5


@dataclass(frozen=True)
class ToxicityModel:
    """Sorted feature hashes with weights, and the score of a sentence without features."""

    features: np.ndarray
    weights: np.ndarray
    base: float


def _features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A row of feature hashes for every word: the word and its beginnings, 0 where too short."""
    table = np.zeros((len(starts), 1 + len(BEGINNINGS)), dtype=np.uint64)
    table[:, 0] = span_hashes(data, starts, ends)
    for place, length in enumerate(BEGINNINGS, 1):
        longer = np.flatnonzero(ends - starts > length)
        cut = span_hashes(data, starts[longer], starts[longer] + length)
        table[longer, place] = mix(cut + np.uint64(length))
    return table


def _sentences(data: np.ndarray, starts: np.ndarray, offsets: np.ndarray):
    """The running number of each word's sentence; rows end sentences too."""
    breaks = SENTENCE_END[data].astype(np.int64)
    number = np.cumsum(breaks)[starts] if len(starts) else np.zeros(0, dtype=np.int64)
    row = np.searchsorted(offsets, starts, side="right")
    return number, row - 1


def _seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, context, toxic) for every feature of every document, once a document.

    The context is the word before and the word behind the first occurrence.
    """
    for batch in portions(batches, most=PORTION_BYTES):
        data, offsets = text_bytes(batch.column(1))
        starts, ends = word_spans(data, offsets, NOT_ALPHANUMERIC)
        row = np.searchsorted(offsets, starts, side="right") - 1
        found = _features(data, starts, ends)
        around = np.zeros(len(starts) + 2, dtype=np.uint64)
        around[1:-1] = found[:, 0]
        context = mix(around[:-2] * np.uint64(3) + around[2:])
        width = found.shape[1]
        found = found.ravel()
        # a feature's first place in each document
        pairs = mix(found + np.repeat(row, width).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        _, first = np.unique(pairs, return_index=True)
        first = first[found[first] != 0]
        word = first // width
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(found[first].view(np.int64)),
                pa.array(context[word].view(np.int64)),
                pa.array(batch.column(0).to_numpy()[row[word]]),
            ],
            ["feature", "context", "toxic"],
        )


def _hits(batches: Iterator[pa.RecordBatch], names: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Per document: its label, sentences, and where it has the chosen features."""
    for batch in batches:
        for i in range(batch.num_rows):
            data, offsets = text_bytes(batch.column(1).slice(i, 1))
            starts, ends = word_spans(data, offsets, NOT_ALPHANUMERIC)
            number, _ = _sentences(data, starts, offsets)
            found = _features(data, starts, ends)
            at = np.minimum(np.searchsorted(names, found), max(len(names) - 1, 0))
            hit = names[at] == found if len(names) else np.zeros(found.shape, dtype=bool)
            word, _ = np.nonzero(hit)
            pairs = np.unique(np.stack([at[hit], number[word]]), axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(i, 1),
                    pa.array([len(np.unique(number))], pa.int32()),
                    pa.array([pairs[0].tobytes()], pa.binary()),
                    pa.array([pairs[1].tobytes()], pa.binary()),
                ],
                ["toxic", "n_sentences", "features", "sentences"],
            )


def learn(
    names: np.ndarray, sample, weight_toxic: float, settings: ToxicitySettings
) -> ToxicityModel:
    """Fit the sentence model by noisy-or likelihood to (toxic, n_sentences, features,
    sentences) rows, whose features are places in ``names``."""
    toxic = np.array([row[0] for row in sample], dtype=np.float64)
    counts = np.array([row[1] for row in sample], dtype=np.float64)
    if not 0 < toxic.sum() < len(toxic):
        return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), -np.inf)
    found = [np.frombuffer(row[2], dtype=np.int32) for row in sample]
    feature = np.concatenate(found).astype(np.int64)
    sentence = np.concatenate([np.frombuffer(row[3], dtype=np.int32) for row in sample])
    document = np.repeat(np.arange(len(sample)), [len(x) for x in found])
    # sentences that have a feature; the others of a document all score sigmoid(base)
    keys, of = np.unique(np.stack([document, sentence]), axis=1, return_inverse=True)
    of, owner = of.ravel(), keys[0].astype(np.int64)
    plain = counts - np.bincount(owner, minlength=len(sample))
    weight = np.where(toxic == 1, weight_toxic, 1.0)
    weight /= weight.sum()
    theta = np.zeros(len(names) + 1)
    theta[-1] = -5.0
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, settings.rounds + 1):
        scores = np.bincount(of, weights=theta[feature], minlength=len(owner)) + theta[-1]
        chance = 1 / (1 + np.exp(-np.clip(scores, -30, 30)))
        base = 1 / (1 + np.exp(-np.clip(theta[-1], -30, 30)))
        clean = np.bincount(owner, weights=np.log1p(-np.minimum(chance, 1 - 1e-12)), minlength=len(sample))
        clean = np.minimum(clean + plain * np.log1p(-base), -1e-12)
        # d loss / d log(clean): +1 for a clean document, -clean/(1-clean) for a toxic one
        slope = weight * np.where(toxic == 1, np.exp(clean) / -np.expm1(clean), -1.0)
        to_scores = -slope[owner] * chance
        gradient = np.empty_like(theta)
        gradient[:-1] = np.bincount(feature, weights=to_scores[of], minlength=len(names))
        gradient[-1] = to_scores.sum() - (slope * plain).sum() * base
        gradient[:-1] += settings.ridge * theta[:-1] / max(len(names), 1)
        first = 0.9 * first + 0.1 * -gradient
        second = 0.99 * second + 0.01 * gradient**2
        theta = theta + 0.1 * (first / (1 - 0.9**step)) / (
            np.sqrt(second / (1 - 0.99**step)) + 1e-9
        )
    return ToxicityModel(names, theta[:-1], float(theta[-1]))


def train(
    documents: DataFrame,
    labels: DataFrame,
    settings: ToxicitySettings = ToxicitySettings(),
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
) -> ToxicityModel:
    """Learn from at most ``sample_each`` labelled documents of either label.

    The sample is the rows with the smallest hash of the id, so it does not depend on the
    order of the rows; the classes are weighted back to their shares of all labels. Rows
    without id, text or a label of 0 or 1 are not learned from. Without both labels the
    model has nothing to tell texts by: every sentence and document scores 0.
    """
    usable = (
        labels.select(
            F.col(id_column).cast("long").alias("doc_id"),
            F.col(label_column).cast("int").alias("toxic"),
        )
        .where("doc_id is not null and toxic in (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    order = F.xxhash64("doc_id")
    picked = None
    for label in (0, 1):
        part = usable.where(F.col("toxic") == label).orderBy(order, "doc_id")
        part = part.limit(settings.sample_each)
        picked = part if picked is None else picked.union(part)
    texts = documents.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    ).where("text is not null")
    shares = {row["toxic"]: row["count"] for row in usable.groupBy("toxic").count().collect()}
    sampled = texts.join(F.broadcast(picked), "doc_id").select("toxic", "text")
    taken = {row["toxic"]: row["count"] for row in sampled.groupBy("toxic").count().collect()}
    positive, negative = taken.get(1, 0), taken.get(0, 0)
    names = np.zeros(0, dtype=np.uint64)
    weight = 1.0
    if positive and negative:
        weight = (shares[1] / positive) / (shares[0] / negative)
        names = _screened(sampled, positive, negative, settings)
    sample = sampled.mapInArrow(
        partial(_hits, names=names),
        "toxic int, n_sentences int, features binary, sentences binary",
    ).collect()
    sample.sort(key=tuple)
    return learn(names, sample, weight, settings)


def _screened(
    sampled: DataFrame, positive: int, negative: int, settings: ToxicitySettings
) -> np.ndarray:
    """The features that go with a label more than chance would have it, sorted.

    Documents in which a feature stands between the same words count once, so that the
    chance words of a document with many copies are not taken for a sign of its label.
    """
    rate = positive / (positive + negative)
    own = F.col("marked") / F.col("having")
    # likelihood ratio against the labels' own rate; holds for rare features too
    apart = F.when(own > 0, own * F.log(own / rate)).otherwise(0.0) + F.when(
        own < 1, (1 - own) * F.log((1 - own) / (1 - rate))
    ).otherwise(0.0)
    strength = F.sqrt(F.greatest(2 * F.col("having") * apart, F.lit(0.0)))
    measured = (
        sampled.mapInArrow(_seen, "feature long, context long, toxic int")
        .groupBy("feature", "context")
        .agg(F.max("toxic").alias("toxic"))  # copies of a passage count once
        .groupBy("feature")
        .agg(F.count(F.lit(1)).alias("having"), F.sum("toxic").alias("marked"))
        .where(F.col("having") >= settings.least_documents)
        .select("feature", strength.alias("z"))
    )
    chosen = (
        measured.orderBy(F.desc("z"), "feature")
        .limit(settings.most_features)
        .select("feature", "z")
        .collect()
    )
    tested = len(chosen) if len(chosen) < settings.most_features else measured.count()
    if not tested:
        return np.zeros(0, dtype=np.uint64)
    share = min(settings.by_chance / tested, 0.5)
    least = NormalDist().inv_cdf(1 - share)
    passed = [row["feature"] for row in chosen if row["z"] >= least]
    return np.sort(np.array(passed, dtype=np.int64).view(np.uint64))


_SCORED = (
    "doc_id long, score double, predicted int, n_sentences long, worst_sentence int, "
    "offending array<struct<start:int,end:int,score:double>>"
)


def _word_scores(data, starts, ends, number, row, model: ToxicityModel) -> np.ndarray:
    """What each word adds to its sentence; a feature counts once in a sentence."""
    added = np.zeros(len(starts))
    if len(model.features):
        for column in _features(data, starts, ends).T:
            at = np.minimum(np.searchsorted(model.features, column), len(model.features) - 1)
            hit = np.flatnonzero(model.features[at] == column)
            if len(hit):
                triple = np.stack([row[hit], number[hit], at[hit]])
                _, once = np.unique(triple, axis=1, return_index=True)
                added[hit[once]] += model.weights[at[hit[once]]]
    return added


def _documents(column: pa.Array, model: ToxicityModel):
    """Document scores, and the sentences: first word, chance and row of each."""
    data, offsets = text_bytes(column)
    starts, ends = word_spans(data, offsets, NOT_ALPHANUMERIC)
    number, row = _sentences(data, starts, offsets)
    added = _word_scores(data, starts, ends, number, row, model)
    fresh = np.ones(len(starts), dtype=bool)
    fresh[1:] = (number[1:] != number[:-1]) | (row[1:] != row[:-1])
    first = np.flatnonzero(fresh)
    sums = np.add.reduceat(added, first) if len(first) else np.zeros(0)
    chance = 1 / (1 + np.exp(-np.clip(sums + model.base, -30, 30)))
    if np.isneginf(model.base):  # an unlearned model
        chance[:] = 0.0
    owner = row[first]
    clean = np.log1p(-np.minimum(chance, 1 - 1e-12))
    keep = np.bincount(owner, weights=clean, minlength=len(column))
    score = np.clip(-np.expm1(keep), 0.0, 1.0) + 0.0  # no negative zero
    return score, (data, offsets, starts, ends, first, chance, owner)


def _score(
    batches: Iterator[pa.RecordBatch], model: ToxicityModel, settings: ToxicitySettings
) -> Iterator[pa.RecordBatch]:
    kind = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
    for batch in portions(batches, most=PORTION_BYTES):
        score, found = _documents(batch.column(1), model)
        data, offsets, starts, ends, first, chance, owner = found
        sentences = np.bincount(owner, minlength=batch.num_rows)
        begin = np.searchsorted(owner, np.arange(batch.num_rows + 1))
        after = np.append(first[1:], len(starts)) - 1  # the last word of each sentence
        worst: list[int | None] = []
        spans: list[list[dict]] = []
        for i, (low, high) in enumerate(zip(begin[:-1].tolist(), begin[1:].tolist())):
            if low == high:
                worst.append(None)
                spans.append([])
                continue
            worst.append(int(np.argmax(chance[low:high])))
            found = low + np.flatnonzero(chance[low:high] >= settings.span_threshold)
            if len(found):
                text = data[offsets[i] : offsets[i + 1]]
                letters = np.concatenate([[0], np.cumsum((text & 0xC0) != 0x80)])
                spans.append(
                    [
                        {
                            "start": int(letters[starts[first[s]] - offsets[i]]),
                            "end": int(letters[ends[after[s]] - offsets[i]]),
                            "score": float(chance[s]),
                        }
                        for s in found
                    ]
                )
            else:
                spans.append([])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(score),
                pa.array((score >= settings.threshold).astype(np.int32)),
                pa.array(sentences.astype(np.int64)),
                pa.array(worst, pa.int32()),
                pa.array(spans, pa.list_(kind)),
            ],
            ["doc_id", "score", "predicted", "n_sentences", "worst_sentence", "offending"],
        )


def score(
    documents: DataFrame,
    model: ToxicityModel,
    settings: ToxicitySettings = ToxicitySettings(),
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """doc_id, score, predicted, n_sentences, worst_sentence, offending for every row.

    ``offending``: character spans of the sentences at or above ``span_threshold``, their
    punctuation left out. Null and empty texts have no sentences: score 0, worst_sentence
    null. Repeated rows and null ids each give their own row. Other columns are not read.
    """
    return documents.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    ).mapInArrow(partial(_score, model=model, settings=settings), _SCORED)


def _clean(
    batches: Iterator[pa.RecordBatch], text: int, model: ToxicityModel, settings: ToxicitySettings
) -> Iterator[pa.RecordBatch]:
    for batch in portions(batches, text, PORTION_BYTES):
        score, _ = _documents(batch.column(text), model)
        yield batch.filter(pa.array(score < settings.threshold))


def clean(
    documents: DataFrame,
    model: ToxicityModel,
    settings: ToxicitySettings = ToxicitySettings(),
    text_column: str = "text",
) -> DataFrame:
    """The rows of documents, with all their columns, that score below the threshold."""
    text = documents.columns.index(text_column)
    return documents.mapInArrow(
        partial(_clean, text=text, model=model, settings=settings), documents.schema
    )
