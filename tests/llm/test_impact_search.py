"""Ranked search against scores computed for every document."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from faultline.llm import impact_search
from faultline.llm.impact_search import ImpactLists, best_of_block, impacts

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
DOCS = "doc_id long, text string, item_id string, score long, rank string"


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items, k):
    counted = [(doc_id, Counter(terms(text))) for doc_id, text in rows]
    counted = [(doc_id, c, sum(c.values())) for doc_id, c in counted if c]
    docs, length = len(counted), sum(n for *_, n in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, c, n in counted:
            m = 100 - 75 + (75 * n * docs) // length
            score = sum(
                math.floor(1000 * math.log((2 * docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in terms(text) if t in c
            )
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, rank, doc_id, -low) for rank, (low, _, _, doc_id) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=repr)


def corpus(seed, count=400):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)] + ["über", "Über", "Zoo", "zoo", "你好", "naive"]
    weights = [1 / (i + 1) for i in range(len(words))]
    rows = []
    for i in range(count):
        text = rng.choice([" ", ", ", "-"]).join(rng.choices(words, weights, k=rng.choice([0, 1, 5, 40, 300])))
        rows.append((i if rng.random() < 0.97 else None, text))
    items = [(i, " ".join(rng.choices(words, k=rng.choice([1, 3, 12, 40])))) for i in range(30)]
    return [*rows, *rows[:9], (5, None), (6, "...")], [*items, (30, None), (31, "?!"), (32, "unknown"), (3, "w1 w1 zoo")]


@pytest.mark.parametrize("block, item_block", [(1_000_000, 1000), (37, 1000), (64, 7)])
def test_equals_all_scores(spark, block, item_block):
    rows, items = corpus(block)
    docs = spark.createDataFrame([(*r, "own", 1, "x") for r in rows], DOCS).repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string")
    got = impact_search.ranked(docs, asked, 10, item_block, block)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, items, 10)


def test_bounds_stop_before_the_lists_end():
    """A document that leads by far is found without reading a frequent term's list to its end."""
    rng = np.random.default_rng(2)
    size = 20_000
    rare, common = rng.choice(size, 40, replace=False), np.arange(size)
    rows = np.concatenate((rare, common))
    term = np.concatenate((np.zeros(len(rare), int), np.ones(size, int)))
    impact = np.concatenate((rng.integers(500_000, 900_000, len(rare)), rng.integers(100_000, 900_000, size)))
    impact[len(rare) + rare] = 890_000
    lists = ImpactLists(rows, term, impact, 2)
    weights = [(0, 9000), (1, 3)]
    at, scores, reads = best_of_block(lists, size, weights, 5, 0)
    full = np.zeros(size, np.int64)
    np.add.at(full, rows, np.where(term == 0, 9000, 3) * impact)
    top = np.argsort(-full, kind="stable")[:5]
    assert [int(a) for a in at[np.argsort(-scores, kind="stable")][:5]] == top.tolist()
    assert (full[at] == scores).all() and reads < len(rows) / 2


def test_ties_and_floors():
    lists = ImpactLists(np.arange(50), np.zeros(50, int), np.full(50, 7), 1)
    at, scores, _ = best_of_block(lists, 50, [(0, 2)], 3, 0)
    assert len(at) == 50 and set(scores.tolist()) == {14}
    assert len(best_of_block(lists, 50, [(0, 2)], 3, 14)[0]) == 50
    assert len(best_of_block(lists, 50, [(0, 2)], 3, 15)[0]) == 0
    assert len(best_of_block(lists, 50, [(0, 0)], 3, 0)[0]) == 0


def test_long_documents_do_not_overflow():
    n = np.array([10**9, 3], dtype=np.int64)
    docs, length = 10**12, 10**14
    exact = [(10**9 * 4) // (1000 * 4 + 8 * (25 + 75 * int(x) * docs // length)) for x in n]
    assert impacts(n, np.array([4, 4]), docs, length).tolist() == exact


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert impact_search.ranked(docs, items.limit(0)).collect() == []
    assert impact_search.ranked(docs.limit(0), items).collect() == []
