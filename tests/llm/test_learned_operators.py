"""Toxicity, importance resampling and nearest vectors: accuracy, exactness and edge cases."""

from __future__ import annotations

import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from faultline.llm import neighbours, resampling, toxicity
from faultline.llm.common import stored, table
from tests.oracle_check import DATA

TABLES = f"{DATA}/sf0.1"
have_tables = pytest.mark.skipif(not os.path.isdir(TABLES), reason="test tables not present")


def slow_kernel(a: str, b: str) -> float:
    def features(word):
        marked, found = f"\x1e{word}\x1f", {}
        for i in range(len(marked)):
            for j in range(i + 1, len(marked)):
                for k in range(j + 1, min(len(marked), i + toxicity.STRETCH + 1)):
                    key = marked[i] + marked[j] + marked[k]
                    found[key] = found.get(key, 0) + toxicity.DECAY ** (k - i - 2)
        return found

    x, y = features(a), features(b)
    dot = sum(v * y.get(key, 0) for key, v in x.items())
    return dot / (sum(v * v for v in x.values()) * sum(v * v for v in y.values())) ** 0.5


def test_kernel_and_folded_scores():
    words = ["idiot", "id1ot", "idiiot", "banana", "a", "ab", "äöü"]
    marks = ["idiot", "ananas"]
    got = toxicity.kernel_rows(words, toxicity.landmark_table(marks))
    for i, word in enumerate(words):
        for j, mark in enumerate(marks):
            assert abs(got[i, j] - slow_kernel(word, mark)) < 1e-9
    assert got[2, 0] > 0.6 > got[3, 0]


def test_spans():
    assert toxicity.spans("You I D I O T! you")["you"] == 2 and toxicity.spans("You I D I O T!")["idiot"] == 1
    assert "idiot" in toxicity.spans("an i.d.i.o.t, no")
    assert toxicity.spans(None) == toxicity.spans(" \n") == {}
    long = "x" * 100 + "idiot" + "y" * 100
    assert any("idiot" in span for span in toxicity.spans(long)) and max(map(len, toxicity.spans(long))) <= 24


def test_misspelled_insults_are_found():
    rng = random.Random(1)
    words = ["".join(rng.choices("aeiourstlnmdp", k=rng.randint(3, 9))) for _ in range(900)]
    texts, flags = [], []
    for i in range(400):
        body = rng.choices(words, k=40)
        if i % 2:
            body[rng.randrange(40)] = rng.choice(["worthless", "pathetic"])
            body[rng.randrange(40)] = rng.choice(["worthless", "pathetic"])
        texts.append(" ".join(body))
        flags.append(i % 2)
    model = toxicity.train(texts, flags)
    table_ = model.table()

    def score(text):
        bag = toxicity.spans(text)
        return model.of_text(
            toxicity.best_spans(bag, dict(zip(bag, toxicity.span_scores(list(bag), table_, model.offset).tolist())), model.neutral))

    clean = [" ".join(rng.choices(words, k=40)) for _ in range(100)]
    assert sum(score(text) < 0.7 for text in clean) >= 95
    for insult in ("worthless", "wor-thless", "worthlesss", "patheetic", "p.a.t.h.e.t.i.c", "w o r t h l e s s"):
        assert sum(score(f"{text} {insult} and {insult}") >= 0.7 for text in clean[:20]) >= 18, insult
    assert toxicity.train(texts, [0] * 400) is None


@have_tables
def test_held_out_accuracy(spark):
    docs, labels = table(spark, TABLES, "documents"), table(spark, TABLES, "labels")
    odd = [(None, "x"), (7_000_000, None), (7_000_001, ""), (7_000_002, "word " * 300_000), (7_000_002, "word")]
    docs = docs.select("doc_id", "text").union(spark.createDataFrame(odd, "doc_id long, text string")).withColumn("score", F.lit("mine"))
    got = toxicity.toxicity(docs, labels).toPandas()
    assert len(got) == docs.count() and got.score.between(0, 1).all()
    ids = got[got.doc_id.notna()]
    assert (ids.held_out == [zlib.crc32(str(int(i)).encode()) % 3 == 1 for i in ids.doc_id]).all()
    assert ((got.score >= 0.7) == (got.predicted == 1)).all()
    both = got.merge(labels.toPandas(), on="doc_id")
    held = both[both.held_out]
    assert held[held.toxic == 1].predicted.mean() > 0.75 and held[held.toxic == 0].predicted.mean() < 0.02
    none = toxicity.toxicity(docs.limit(3), labels.limit(0)).collect()
    assert [r.score for r in none] == [0.0] * 3
    assert toxicity.toxicity(docs.limit(0), labels).count() == 0


@have_tables
def test_resampling_prefers_good_documents(spark):
    docs, labels = table(spark, TABLES, "documents"), table(spark, TABLES, "labels")
    half = labels.filter("doc_id % 2 = 0")
    got = resampling.resampled(docs.withColumn("key", F.lit(1)), half).toPandas()
    assert len(got) == docs.count()
    unseen = got.merge(labels.filter("doc_id % 2 = 1").toPandas(), on="doc_id")
    assert unseen[unseen.quality == 1].kept.mean() > 0.93 > 0.3 > unseen[unseen.quality == 0].kept.mean()
    assert resampling.resampled(docs, labels.limit(0)).filter("kept").count() == docs.count()
    assert resampling.resampled(docs.limit(0), labels).count() == 0


def test_log_ratio_against_plain_counts(spark):
    rng = random.Random(4)
    texts = [" ".join(rng.choices("ab cd Ef gh é ij\tkl".split(" "), k=rng.randint(0, 40))) for _ in range(120)]
    docs = [(i % 100 if i % 9 else None, t if i % 17 else None) for i, t in enumerate(texts)]
    labels = [(i, i % 3 == 0, 0) for i in range(0, 100, 2)] + [(6, True, 0), (None, True, 0), (500, True, 0)]
    labels = spark.createDataFrame([(i, int(q), t) for i, q, t in labels], "doc_id long, quality int, toxic int")
    frame = spark.createDataFrame(docs, "doc_id long, text string").withColumn("good", F.lit("mine"))
    good = {r.doc_id for r in labels.filter("quality = 1").collect()} - {None}
    raw, target = np.ones(64), np.ones(64)
    for doc_id, text in docs:
        for feature in resampling.hashed_ngrams(text, 64):
            raw[feature] += 1
            target[feature] += doc_id in good
    expected = np.concatenate([
        np.log(target[p] / target[p].sum()) - np.log(raw[p] / raw[p].sum()) for p in (slice(0, 32), slice(32, 64))
    ])
    assert np.allclose(resampling.log_ratio(frame, labels, features=64), expected, atol=1e-12)
    got = resampling.resampled(frame, labels, keep=(1, 4), features=64).collect()
    weights = sorted(round(float(expected[resampling.hashed_ngrams(t, 64)].sum()), 9) for _, t in docs)
    assert sorted(round(r.log_weight, 9) for r in got) == weights and sum(r.kept for r in got) == 30
    assert min(r.key for r in got if r.kept) >= max(r.key for r in got if not r.kept)


def test_weights_of_texts(spark):
    docs = spark.createDataFrame([(1, "a b a"), (2, None), (3, " "), (None, "a b a"), (1, "a b a")], "doc_id long, text string")
    ratio = np.random.default_rng(0).normal(size=resampling.FEATURES)
    got = sorted(((r.doc_id or 0, r.log_weight) for r in resampling.log_weights(docs, ratio).collect()))
    words = resampling.hashed_ngrams("a b a")
    assert len(words) == 5 and words[0] == words[2] < resampling.FEATURES // 2 <= words[3]
    assert [i for i, _ in got] == [0, 1, 1, 2, 3] and got[3][1] == got[4][1] == 0
    assert abs(got[0][1] - ratio[words].sum()) < 1e-9 and got[1] == got[2]


@pytest.mark.parametrize("small", [1, 5, 10_000])
def test_largest_keys_are_exact(spark, small):
    rng = random.Random(2)
    rows = [(i, rng.choice([rng.random(), 0.5, float(rng.randint(0, 3))])) for i in range(500)] + [(3, 0.5)] * 20
    frame = stored(spark.createDataFrame(rows, "doc_id long, key double"), "rows")
    for count in (0, 1, 99, 260, 519, 520, 900):
        got = resampling.mark_largest(frame, count, "key", small).collect()
        assert len(got) == len(rows) and sum(r.kept for r in got) == min(count, len(rows))
        kept, left = [r.key for r in got if r.kept], [r.key for r in got if not r.kept]
        assert not kept or not left or min(kept) >= max(left)


def brute(ids, vectors, own, k):
    q = vectors[ids == own][0]
    score = (vectors * q).sum(1)
    order = [i for i in np.lexsort((ids, -score)) if ids[i] != own][:k]
    return [(int(ids[i]), float(score[i])) for i in order]


def test_nearest_against_brute_force(spark):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(30, 24))
    vectors = (centres[rng.integers(0, 30, 1500)] + 0.6 * rng.normal(size=(1500, 24))) * rng.uniform(0.2, 3, (1500, 1))
    vectors = vectors.astype(np.float32).astype(float)
    vectors[40] = vectors[41]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    inf, nan = float("inf"), float("nan")
    odd = [(20_000, None), (20_020, []), (20_040, [0.0] * 24), (20_060, [inf] + [1.0] * 23), (20_080, [nan] + [1.0] * 23),
           (20_100, [None] + [1.0] * 23), (None, [1.0] * 24), (20_120, [1.0, 2.0]), (20_121, [2.0, 1.0]), rows[0], rows[3]]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>").withColumn("score", F.lit("mine"))
    got = neighbours.nearest(frame, F.col("vec_id") % 20 == 0, k=10, block=400).collect()
    found = {}
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(found[r.query_id]) == r["rank"]
    assert set(found) == {*range(0, 1500, 20), 20_120}
    assert [v for v, _ in found.pop(20_120)] == [20_121]
    ids, hits = np.arange(1500), 0
    for own, pairs in found.items():
        assert pairs == sorted(pairs, key=lambda p: (-p[1], p[0])) and len(pairs) == 10
        exact = brute(ids, vectors, own, 10)
        hits += len({v for v, _ in exact} & {v for v, _ in pairs})
        q = vectors[own]
        assert all(abs(s - float((vectors[v] * q).sum())) < 1e-9 for v, s in pairs)
    assert hits >= 0.95 * 10 * len(found)
    assert neighbours.nearest(frame.limit(0), F.lit(True)).count() == 0
    few = neighbours.nearest(frame.filter("vec_id < 5"), F.col("vec_id") == 0, k=10).collect()
    assert sorted(r.vec_id for r in few) == [1, 2, 3, 4]


def test_very_small_and_repeated_vectors(spark):
    rows = [(i, [1e-170 * (i + 1), 1e-170]) for i in range(6)] + [(7, [0.0, 0.0])] + [(3, [4e-170, 1e-170])] * 500
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.nearest(frame, F.col("vec_id") % 5 == 0, k=3, block=4).collect()
    assert {(r.query_id, r["rank"]) for r in got} == {(q, n) for q in (0, 5) for n in (1, 2, 3)}
    assert [r.vec_id for r in sorted(got, key=lambda r: (r.query_id, r["rank"]))] == [1, 2, 3, 0, 1, 2]
