"""The whole pipeline, and the fit of its first stage, against plain versions."""

import collections
import hashlib
import math
import random
import re

import duckdb
import numpy as np
import pytest
from llm_helpers import LOWER, plain_words, prose
from pyspark.sql import functions as F

from clickweir.llm import sql, toxicity

DOCUMENTS = "doc_id long, text string, lang string, source string"


def corpus():
    """Clean texts, toxic ones, copies with a few words changed, nulls and repeated rows."""
    pick = random.Random(3)
    rows, labels = [], []

    def add(text, toxic=None, source=None):
        number = len(rows) + 1
        rows.append((number, text, "en", source or pick.choice("abcd")))
        labels.append((number, toxic))

    for i in range(60):
        bad = i % 4 == 0
        parts = [prose(1000 + 7 * i + k, 12) for k in range(4)]
        if bad:
            parts[pick.randrange(4)] += f" you {pick.choice(['vile', 'rotten'])} scoundrelz"
        add(". ".join(parts) + "!", int(bad), "hot" if i % 3 == 1 else None)
    for i in range(12):
        words = prose(50 + i, 80).split()
        add(" ".join(words), 0)
        add(" ".join([*words[:-1], "changed"]).upper(), 0)  # near: one shingle of 76 differs
        add(" ".join(words[:40]), 0)  # not near
    add(None, None)
    add("", 0)
    add(" \t ", 0)
    add("few words", 0)
    add("few words", 0)
    rows.append(rows[-1])
    return rows, labels


def plain_score(text, model):
    """Noisy-or over sentences split at their ends, word by word."""
    known = dict(zip(model.features.tolist(), model.weights.tolist()))
    clean = 1.0
    for sentence in re.split(r"[\n!.?]", (text or "").translate(LOWER)):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", sentence)
        if not words:
            continue
        found = set()
        for word in words:
            data = np.frombuffer(word.encode(), dtype=np.uint8)
            own = toxicity._features(data, np.array([0]), np.array([len(data)]))
            found |= {x for x in own.ravel().tolist() if x in known}
        total = model.base + sum(known[x] for x in found)
        clean *= 1 - 1 / (1 + math.exp(-max(-30, min(30, total))))
    return 1 - clean


def plain_near_copies(rows):
    """One row of each id and text, the smallest id of each component."""
    rows = sorted(set(rows), key=lambda r: r[0])
    sets = []
    for row in rows:
        words = plain_words(row[1])
        spans = [words[i : i + 5] for i in range(max(1, len(words) - 4))] if words else []
        sets.append({" ".join(span) for span in spans})
    parent = list(range(len(rows)))

    def find(x):
        return x if parent[x] == x else find(parent[x])

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                low, high = sorted((find(i), find(j)))
                parent[high] = low
    return [row for i, row in enumerate(rows) if find(i) == i]


def plain_mix(rows):
    """Each row as often as the SQL of the mix takes its words, rounded."""
    import pandas as pd

    con = duckdb.connect()
    con.register("given", pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source"]))
    con.execute("create view documents as select doc_id::bigint as doc_id, text, lang, source from given")
    taken = {r["doc_id"]: (r["size"], r["taken"]) for r in con.sql(sql.MIXING).df().to_dict("records")}
    out = []
    for row in rows:
        size, words = taken[row[0]]
        out += [row] * (math.floor(words / size + 0.5) if size else 0)
    return out


def test_pipeline_matches_a_plain_version(spark, tmp_path):
    import corpus_pipeline
    import tokenizers

    rows, labels = corpus()
    spark.createDataFrame(rows, DOCUMENTS).withColumn("n_chars", F.length("text").cast("long")).write.parquet(
        f"{tmp_path}/documents.parquet"
    )
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    given = spark.read.parquet(f"{tmp_path}/documents.parquet")
    model = toxicity.train(given, spark.read.parquet(f"{tmp_path}/labels.parquet"))

    def ids(some):
        return collections.Counter(r[0] for r in some)

    def stage(number, some):
        frame = spark.createDataFrame(some, DOCUMENTS)
        return corpus_pipeline.STAGES[number][1](spark, frame, str(tmp_path))

    clean = [r for r in rows if plain_score(r[1], model) < 0.7]
    toxic = {i for i, label in labels if label == 1}
    assert toxic and not toxic & set(ids(clean)) and len(clean) >= len(rows) - len(toxic) - 1
    assert ids(stage(0, rows).select("doc_id").collect()) == ids(clean)
    for row in toxicity.score(given, model).collect():
        text = {r[0]: r[1] for r in rows}[row["doc_id"]]
        assert row["score"] == pytest.approx(plain_score(text, model), abs=1e-9)

    single = plain_near_copies(clean)
    assert len(clean) - len(single) >= 13  # twelve near copies, a repeated text and a row
    assert ids(stage(1, clean).select("doc_id").collect()) == ids(single)

    mixed = plain_mix(single)
    assert ids(stage(2, single).select("doc_id").collect()) == ids(mixed)
    assert max(ids(mixed).values()) == 2

    library = tokenizers.Tokenizer.from_file(str(corpus_pipeline.TOKENIZER))
    library.no_truncation()
    library.no_padding()
    expected = collections.Counter()
    for number, text, *_ in mixed:
        found = library.encode(text, add_special_tokens=False).ids
        back = library.decode(found, skip_special_tokens=False)
        packed = np.array(found, dtype="<u4").tobytes()
        expected[(number, len(found), packed, hashlib.sha256(back.encode()).hexdigest())] += 1
    got = collections.Counter(
        (r["doc_id"], r["n_tokens"], bytes(r["ids"]), r["decoded_sha256"])
        for r in corpus_pipeline.run(spark, str(tmp_path)).collect()
    )
    assert got == expected and sum(got.values()) > 50


def plain_loss(theta, sample, weight_toxic, ridge):
    """Weighted negative log likelihood of noisy-or over sentences, and the ridge."""
    total = weights = 0.0
    for toxic, sentences, features, at in sample:
        own = collections.defaultdict(float)
        for feature, sentence in zip(np.frombuffer(features, np.int32), np.frombuffer(at, np.int32)):
            own[int(sentence)] += theta[int(feature)]
        clean = 1.0
        for score in [*own.values(), *[0.0] * (sentences - len(own))]:
            clean *= 1 - 1 / (1 + math.exp(-(score + theta[-1])))
        weight = weight_toxic if toxic else 1.0
        weights += weight
        total -= weight * math.log(1 - clean if toxic else clean)
    return total / weights + ridge / 2 * sum(t * t for t in theta[:-1]) / (len(theta) - 1)


def test_fit_reaches_the_least_loss():
    """Labels that no weights can part, so the best weights are finite; found by search."""

    def row(toxic, sentences, *hits):
        places = np.array([h[0] for h in hits], np.int32), np.array([h[1] for h in hits], np.int32)
        return toxic, sentences, places[0].tobytes(), places[1].tobytes()

    sample = [
        row(1, 3, (0, 0)), row(1, 2, (0, 1), (1, 0)), row(0, 2, (0, 0)), row(1, 1), row(0, 4),
        row(0, 2, (1, 1)), row(0, 3, (1, 0)), row(1, 2, (1, 0)), row(0, 1), row(1, 2, (0, 0), (0, 1)),
    ]
    settings = toxicity.ToxicitySettings()
    model = toxicity.learn(np.array([5, 9], np.uint64), sample, 1.5, settings)
    learned = plain_loss([*model.weights, model.base], sample, 1.5, settings.ridge)
    theta, step = [0.0, 0.0, 0.0], 1.0
    best = plain_loss(theta, sample, 1.5, settings.ridge)
    while step > 1e-6:
        moved = False
        for place in range(3):
            for sign in (1, -1):
                other = list(theta)
                other[place] += sign * step
                loss = plain_loss(other, sample, 1.5, settings.ridge)
                if loss < best:
                    theta, best, moved = other, loss, True
        step = step if moved else step / 2
    assert learned == pytest.approx(best, abs=1e-4)
    assert [*model.weights, model.base] == pytest.approx(theta, abs=0.05)
