"""Vectors, mixing, shards, toxicity, language model, pipeline: brute force and edges."""

import collections
import math
import random
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import plain_words, table_of
from pyspark.sql import functions as F

from checks.compare import differences, duckdb_session
from clickweir.llm import ann, embed_dedup, mixing, ngram_lm, sharding, sql, toxicity
from clickweir.llm import queries as registered

VECTORS = "vec_id long, embedding array<float>, label int, same string, key string, leaf string"


def vector_rows(seed=4, count=300, size=16):
    pick = np.random.default_rng(seed)
    base = pick.normal(size=(count // 6, size))
    rows = []
    for i in range(count):
        v = base[i % len(base)] + pick.normal(size=size) * pick.choice([0.0, 0.05, 0.12, 1.0])
        rows.append((i * 2, [float(np.float32(x)) for x in v], int(i % 3), "x", "y", "z"))
    odd = [
        (1001, None, 1), (1003, [], 1), (1005, [0.0] * size, 1), (1007, [math.nan] * size, 1),
        (1009, [None] + [1.0] * (size - 1), 1), (1011, [1.0] * size, None), (None, [1.0] * size, 1),
        (1013, [1.0] * size, 1), (1013, [1.0] * size, 1), (1015, [2.0] * size, 1), (1017, [1.0] * 3, 1),
    ]
    return rows + [(*row, "x", "y", "z") for row in odd]


def usable(vector):
    return bool(vector) and all(x is not None and math.isfinite(x) for x in vector) and any(vector)


def cosine(a, b):
    a, b = np.array(a), np.array(b)
    return float(a @ b / math.sqrt((a @ a) * (b @ b)))


@pytest.mark.parametrize("small", [64, 1])
def test_vector_links_match_brute_force(spark, monkeypatch, small):
    monkeypatch.setattr(embed_dedup, "SMALL", small)
    monkeypatch.setattr(embed_dedup, "BLOCK", 4 if small == 1 else 1024)
    rows = vector_rows()
    found = embed_dedup.near_vectors(spark, spark.createDataFrame(rows, VECTORS)).collect()
    assert len(found) == len(rows)
    nodes = [r for r in rows if r[0] is not None]
    links, root = collections.Counter(), {r[0]: r[0] for r in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(nodes):
        for j, b in enumerate(nodes):
            if i != j and a[2] is not None and a[2] == b[2] and usable(a[1]) and usable(b[1]):
                if len(a[1]) == len(b[1]) and cosine(a[1], b[1]) >= 0.98:
                    links[i] += 1
                    low, high = sorted((find(a[0]), find(b[0])))
                    root[high] = low
    expected = collections.Counter(
        (r[0], links[i], find(r[0]), find(r[0]) == r[0]) for i, r in enumerate(nodes)
    )
    expected[(None, 0, None, False)] += 1
    got = collections.Counter((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in found)
    assert got == expected
    assert sum(links.values()) > 50


def test_vector_links_match_sql(spark, tmp_path, sf_dir):
    """Planted links, odd vectors and repeated ids; then the given table."""
    path = table_of(spark, tmp_path, "embeddings", vector_rows(), VECTORS)
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{path}/embeddings.parquet/*.parquet'")
    frame = registered.op2_embedding_dedup(spark, path)
    assert differences(con, frame, sql.EMBEDDING_DEDUP) == []
    assert sum(row[1] > 0 for row in con.execute(sql.EMBEDDING_DEDUP).fetchall()) > 50
    given = registered.op2_embedding_dedup(spark, sf_dir)
    assert differences(duckdb_session(sf_dir), given, sql.EMBEDDING_DEDUP) == []


def test_code_estimates_are_unbiased_and_bounded():
    pick = np.random.default_rng(1)
    settings = embed_dedup.EmbedSettings()
    one = pick.normal(size=(4000, 64))
    two = one + pick.normal(size=one.shape) * 0.15
    left, right = embed_dedup.encode(one, 3), embed_dedup.encode(two, 3)
    signs = np.unpackbits(right.signs, axis=1) * 2.0 - 1
    estimate = (left.steps * signs).sum(axis=1) * left.scales / 8 / right.factors
    true = np.array([cosine(a, b) for a, b in zip(one, two)])
    assert abs((estimate - true).mean()) < 0.002
    reached = embed_dedup.may_reach(left, right, settings)
    assert reached[true >= settings.threshold].all()
    other = embed_dedup.encode(pick.normal(size=one.shape), 3)
    assert embed_dedup.may_reach(left, other, settings).mean() < 0.01


@pytest.mark.parametrize("size", [1, 3, 13])
def test_codes_of_any_length_reach_what_is_near(size):
    pick = np.random.default_rng(2)
    one = pick.normal(size=(2000, size))
    two = one + pick.normal(size=one.shape) * 0.05
    settings = embed_dedup.EmbedSettings()
    near = np.array([cosine(a, b) for a, b in zip(one, two)]) >= settings.threshold
    reached = embed_dedup.may_reach(embed_dedup.encode(one, 3), embed_dedup.encode(two, 3), settings)
    assert near.sum() > 500 and reached[near].all()


def test_codes_spare_most_exact_cosines():
    """One bucket of 600 vectors, 100 of them in close pairs: codes leave few to compute."""
    pick = np.random.default_rng(5)
    vectors = pick.normal(size=(600, 64))
    vectors[50:100] = vectors[:50] + pick.normal(size=(50, 64)) * 0.05
    codes = embed_dedup.encode(vectors, 11)
    count = len(vectors)
    table = pa.table({
        "key": pa.array([7] * count, pa.int64()),
        "same": pa.array([i.to_bytes(4, "big") for i in range(count)]),
        "block": pa.array([0] * count, pa.int32()), "lo": pa.array([0] * count, pa.int32()),
        "hi": pa.array([0] * count, pa.int32()), "task": pa.array([0] * count, pa.int64()),
        "rep": pa.array(range(count), pa.int64()),
        "signs": [x.tobytes() for x in codes.signs], "factor": codes.factors,
        "steps": [x.tobytes() for x in codes.steps], "scale": codes.scales,
    })
    settings = embed_dedup.EmbedSettings()
    (_, found), = embed_dedup._candidates(table, settings)
    pairs = sum(len(one) for one, _ in found)
    assert 50 <= pairs < count * (count - 1) // 2 // 100
    kept = embed_dedup._screen(table, settings)["same"].to_pylist()
    assert {i.to_bytes(4, "big") for i in range(100)} <= set(kept) and len(kept) < 300


def test_no_vectors(spark):
    frame = spark.createDataFrame([], VECTORS)
    assert embed_dedup.near_vectors(spark, frame).count() == 0
    assert ann.nearest(spark, frame, F.col("vec_id") % 50 == 0).count() == 0


def test_nearest_matches_brute_force(spark):
    rows = vector_rows()
    frame = spark.createDataFrame(rows, VECTORS)
    found = collections.defaultdict(list)
    for r in sorted(ann.nearest(spark, frame, F.col("vec_id") % 50 == 0).collect(), key=lambda r: r["rank"]):
        found[r["query_id"]].append((r["vec_id"], r["score"]))
    vectors = {r[0]: r[1] for r in rows if r[0] is not None and usable(r[1]) and len(r[1]) == 16}
    asked = [i for i in vectors if i % 50 == 0]
    assert sorted(found) == sorted(asked)
    hits = 0
    for q in asked:
        best = sorted((-round(cosine(vectors[q], v), 12), i) for i, v in vectors.items() if i != q)[:5]
        assert len(found[q]) == 5
        hits += len({i for _, i in best} & {i for i, _ in found[q]})
        for i, value in found[q]:
            assert value == pytest.approx(cosine(vectors[q], vectors[i]), abs=1e-12)
    assert hits >= 0.9 * 5 * len(asked)


def test_nearest_of_few_and_equal_rows(spark):
    same = [(i, [1.0, 2.0], 0, "", "", "") for i in range(9)]
    rows = ann.nearest(spark, spark.createDataFrame(same, VECTORS), F.col("vec_id") == 3).collect()
    assert [r["vec_id"] for r in sorted(rows, key=lambda r: r["rank"])] == [0, 1, 2, 4, 5]
    few = ann.nearest(spark, spark.createDataFrame(same[:3], VECTORS), F.col("vec_id") == 0).collect()
    assert [r["rank"] for r in sorted(few, key=lambda r: r["rank"])] == [1, 2]


@pytest.mark.parametrize(
    "name, text", [("op1_minhash_dedup", sql.MINHASH_DEDUP), ("op5_mixing", sql.MIXING)]
)
def test_query_matches_sql(spark, sf_dir, name, text):
    assert registered.oracle_sql()[name] == text
    frame = registered.queries()[name](spark, sf_dir)
    assert differences(duckdb_session(sf_dir), frame, text) == []


def test_sainte_lague_matches_brute_force(spark):
    pick = random.Random(6)
    rows = [(g, k, float(pick.choice([0, 1, 1, 7, 30, 500]))) for g in range(8) for k in range(12)]
    seats = {g: pick.randint(0, 90) for g in range(8)}
    frame = spark.createDataFrame([(*r, seats[r[0]]) for r in rows], "g int, k int, votes double, seats long")
    found = {(r["g"], r["k"]): r["quota"] for r in mixing.sainte_lague(frame, ["g"], "k", "votes", "seats").collect()}
    for g in range(8):
        given = {k: 0 for h, k, _ in rows if h == g}
        votes = {k: v for h, k, v in rows if h == g}
        for _ in range(seats[g] if any(votes.values()) else 0):
            best = max(given, key=lambda k: (votes[k] / (2 * given[k] + 1), -k))
            given[best] += 1
        assert {k: found[(g, k)] for k in given} == given


def test_mix_reaches_targets(spark, messy_documents, no_documents):
    rows = [(i, "w " * (20 + i % 50), f"s{i * i % 7}") for i in range(900)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mixing.mix(spark, frame).collect()
    assert len(out) == 900 and all(0 <= r["taken"] <= 2 * r["size"] for r in out)
    taken, target = collections.Counter(), {}
    for r in out:
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert all(abs(taken[s] - target[s]) <= 40 for s in target)
    assert sum(target.values()) == pytest.approx(1.5 * sum(r["size"] for r in out))
    again = mixing.mix(spark, frame.orderBy(F.desc("doc_id")).repartition(5)).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, out))
    odd = mixing.mix(spark, messy_documents).collect()
    assert len(odd) == messy_documents.count()
    assert all(r["taken"] == 0 for r in odd if r["size"] == 0)
    assert mixing.mix(spark, no_documents).count() == 0
    assert mixing.mixed(spark, messy_documents).columns == messy_documents.columns
    assert mixing.mixed(spark, no_documents).count() == 0


def test_shards_are_even_and_numbered(spark, messy_documents, no_documents):
    pick = random.Random(9)
    rows = [(i, "x" * pick.randint(0, 90), f"s{min(i % 9, 3)}", "en", i % 5) for i in range(3000)]
    rows += [(i, "copy" * 10, "s0", "en", 40) for i in range(3000, 4500)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars int")
    out = sharding.shard(spark, frame).collect()
    size, slots, together = collections.Counter(), collections.defaultdict(list), collections.defaultdict(set)
    for r in out:
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        together[r["text_crc32"]].add(r["shard"])
    assert len(out) == len(rows) and set(size) == set(range(24))
    assert max(size.values()) - min(size.values()) <= 4 * 98
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    texts = {r[0]: r[1] for r in rows}
    assert all(r["text_crc32"] == zlib.crc32(texts[r["doc_id"]].encode()) for r in out)
    odd = sharding.shard(spark, messy_documents).collect()
    assert len(odd) == messy_documents.count()
    assert {r["size"] for r in odd if r["doc_id"] in (3, 4)} == {8}
    assert sharding.shard(spark, no_documents).count() == 0


def test_equal_texts_stay_together(spark):
    # copies with ids, sources and languages far apart; one group of a third of all rows
    pick = random.Random(4)
    rows = [(i, f"text {pick.randint(0, 4000)} " + "y" * (i % 60)) for i in range(0, 60_000, 10)]
    rows += [(pick.randint(0, 60_000), f"group {i % 40} " + "z" * 30) for i in range(400)]
    rows += [(pick.randint(0, 60_000), "hot " * 9) for _ in range(3000)]
    rows += [(None, None)] * 5
    frame = spark.createDataFrame(
        [(i, t, f"s{pick.randint(0, 5)}", pick.choice(["en", "de", None])) for i, t in rows],
        "doc_id long, text string, source string, lang string",
    )
    out = sharding.shard(spark, frame).collect()
    assert collections.Counter(r["doc_id"] for r in out) == collections.Counter(i for i, _ in rows)
    size, groups = collections.Counter(), collections.defaultdict(list)
    for r in out:
        size[r["shard"]] += r["size"]
        groups[r["text_crc32"], r["size"]].append(r)
    share = sum(size.values()) / 24
    settings = sharding.ShardSettings()
    small = [g for g in groups.values() if sum(r["size"] for r in g) <= settings.whole * share]
    assert len(groups) - len(small) == 1 and any(len(g) > 5 for g in small)
    assert all(len({r["shard"] for r in g}) == 1 for g in small)
    assert max(size.values()) - min(size.values()) <= 2 * settings.whole * share


def toxic_documents(count=600):
    pick = random.Random(12)
    rows, labels = [], []
    for i in range(count):
        sentences = [" ".join(f"word{pick.randint(0, 300)}" for _ in range(8)) for _ in range(pick.randint(1, 12))]
        toxic = i % 4 == 0
        if toxic:
            at = pick.randrange(len(sentences))
            sentences[at] += " " + pick.choice(["Idiot", "stupid", "loser"])
        rows.append((i, ". ".join(sentences) + "."))
        labels.append((i, int(toxic)))
    return rows, labels


def test_toxicity_is_learned_from_document_labels(spark, messy_documents, no_documents):
    rows, labels = toxic_documents()
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(documents, marks.where("doc_id % 3 <> 1"))
    texts, truth = dict(rows), dict(labels)
    found = toxicity.score(documents, model).collect()
    held = [r for r in found if r["doc_id"] % 3 == 1]
    assert sum(r["predicted"] == truth[r["doc_id"]] for r in held) >= 0.97 * len(held)
    for r in held:
        if r["predicted"]:
            spans = [texts[r["doc_id"]][s["start"] : s["end"]] for s in r["offending"]]
            assert any(word in span for span in spans for word in ("Idiot", "stupid", "loser"))
    odd = toxicity.score(messy_documents, model).collect()
    assert len(odd) == messy_documents.count()
    assert all(r["score"] == 0.0 for r in odd if r["doc_id"] in (3, 4, 5))
    kept = toxicity.clean(messy_documents, model)
    assert kept.columns == messy_documents.columns
    assert kept.where("doc_id in (1, 3, 6)").count() == 3 and kept.where("doc_id = 9").count() == 0
    assert toxicity.score(no_documents, model).count() == 0
    unlearned = toxicity.train(no_documents, marks.limit(0))
    assert {r["predicted"] for r in toxicity.score(documents, unlearned).collect()} == {0}
    nulls = spark.createDataFrame([(None, 1), (2, None), (3, 5)], "doc_id long, toxic int")
    assert len(toxicity.train(documents, nulls).features) == 0


def test_language_model_matches_brute_force(spark, sf_dir):
    documents = registered.table(spark, sf_dir, "documents")
    texts = {r["doc_id"]: plain_words(r["text"]) for r in documents.collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    pairs, single = collections.Counter(), collections.Counter()
    for i, own in texts.items():
        if not held[i]:
            single.update([*own, "<end>"])
            pairs.update(zip(["<begin>", *own], [*own, "<end>"]))
    follows = collections.Counter(b for _, b in pairs)
    total, behind = collections.Counter(), collections.defaultdict(lambda: [0, 0, 0])
    for (a, _), c in pairs.items():
        total[a] += c
        behind[a][min(c, 3) - 1] += 1

    def cut(counts):
        n = [sum(1 for c in counts if c == k) for k in (1, 2, 3, 4)]
        return (0.0, *ngram_lm.discounts(*n))

    high, low = cut(pairs.values()), cut(follows.values())
    types, spread = len(single), sum(follows.values())
    rest = sum(low[min(c, 3)] for c in follows.values()) / spread

    def chance(a, b):
        c = follows.get(b, 0)
        lower = max(c - low[min(c, 3)], 0) / spread + rest / (types + 1)
        if not total[a]:
            return lower
        c = pairs.get((a, b), 0)
        back = sum(high[k + 1] * behind[a][k] for k in range(3)) / total[a]
        return max(c - high[min(c, 3)], 0) / total[a] + back * lower

    assert sum(chance("<begin>", b) for b in single) + chance("<begin>", "?") == pytest.approx(1)
    rows = registered.op10_ngram_lm(spark, sf_dir, order=2).collect()
    assert len(rows) == len(texts)
    tokens = sum(single.values())
    for r in rows:
        own = texts[r["doc_id"]]
        steps = list(zip(["<begin>", *own], [*own, "<end>"]))
        assert r["score"] == pytest.approx(sum(math.log10(chance(a, b)) for a, b in steps), rel=1e-9)
        plain = sum(math.log10((single.get(b, 0) + 1) / (tokens + types + 1)) for _, b in steps)
        assert r["base_score"] == pytest.approx(plain, rel=1e-9)
        assert (r["n_tokens"], r["train_tokens"], r["held_out"]) == (len(steps), tokens, held[r["doc_id"]])
        assert r["n_known"] == sum(b in single for _, b in steps)
    held_rows = [r for r in rows if r["held_out"]]
    assert sum(r["score"] for r in held_rows) > sum(r["base_score"] for r in held_rows)


def test_language_model_of_messy_and_no_rows(spark, messy_documents, no_documents):
    model = ngram_lm.train(spark, messy_documents)
    rows = ngram_lm.score(messy_documents, model).collect()
    assert len(rows) == messy_documents.count()
    assert all(math.isfinite(r["score"]) and r["n_tokens"] >= 1 for r in rows)
    assert ngram_lm.score(no_documents, model).count() == 0
    nothing = ngram_lm.train(spark, no_documents)
    assert {r["score"] for r in ngram_lm.score(messy_documents, nothing).collect()} == {0.0}


def test_large_counts_are_kept(spark):
    frame = spark.createDataFrame([(1, "a b " * 5000)], "doc_id long, text string")
    model = ngram_lm.train(spark, frame)
    row = ngram_lm.score(frame, model).first()
    assert row["n_known"] == 10001 and row["perplexity"] < 1.1


def test_pipeline_runs_over_all_documents(spark, sf_dir, messy_documents, no_documents):
    import corpus_pipeline

    documents = registered.table(spark, sf_dir, "documents")
    labels = {r["doc_id"]: r["toxic"] for r in registered.table(spark, sf_dir, "labels").collect()}
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    ids = {r["doc_id"] for r in rows}
    assert ids <= {r["doc_id"] for r in documents.select("doc_id").collect()}
    assert sum(labels.get(i) == 1 for i in ids) <= 0.5 * sum(v == 1 for v in labels.values())
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, messy_documents, sf_dir)
        assert out.columns == messy_documents.columns, name
        out.count()
        assert stage(spark, no_documents, sf_dir).count() == 0, name
    assert corpus_pipeline.STAGES[-1][1](spark, messy_documents, sf_dir).count() == messy_documents.count()


def test_vectors_of_extreme_length_are_compared(spark):
    one, other = [1.0, 2.0, 3.0, 4.0], [4.0, -3.0, 2.0, -1.0]
    rows = [
        (1, [x * 1e200 for x in one], 1), (2, [x * 1e-200 for x in one], 1), (3, one, 1),
        (4, [x * 1e-320 for x in one], 1), (5, [x * 1e307 for x in other], 1), (50, other, 1),
        (100, [0.0] * 4, 1), (101, [float("nan")] + one[1:], 1), (102, [float("inf")] + one[1:], 1),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embed_dedup.near_vectors(spark, frame).collect()}
    assert [found[i] for i in (1, 2, 3, 4)] == [(3, 1)] * 4
    assert found[5] == (1, 5) and found[50] == (1, 5)
    assert [found[i] for i in (100, 101, 102)] == [(0, i) for i in (100, 101, 102)]
    near = [tuple(r) for r in ann.nearest(spark, frame, F.col("vec_id") == 50).collect()]
    assert len(near) == 5 and near[0][2] == 5 and near[0][3] == pytest.approx(1.0)
