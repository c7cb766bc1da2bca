"""Mixing, packing and sharding against brute force, with edge cases."""

from __future__ import annotations

import itertools
import random
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from faultline.llm import mixing, packing, sharding

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def documents(count=120, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        source = "src0" if rng.random() < 0.4 else f"src{rng.randint(1, 12)}"
        text = " ".join(rng.choices(["a", "bb", "ccc"], k=rng.randint(1, 60)))
        rows.append((i, text, rng.choice(["en", "de", "xx", None]), rng.choice([source, source, None]), len(text)))
    return [*rows, *rows[:5], (900, None, "en", "src1", 0), (901, " \n", None, None, 2), (None, "x y z", "en", "src2", 5)]


def shared(budget, weights, caps):
    """Water filling by repeated passes over exact fractions."""
    got, open_, left = {}, set(weights), Fraction(budget)
    while open_:
        level = left / sum(weights[c] for c in open_)
        full = {c for c in open_ if caps[c] <= level * weights[c]}
        if not full:
            got |= {c: level * weights[c] for c in open_}
            break
        for c in full:
            got[c] = Fraction(caps[c])
            left -= caps[c]
        open_ -= full
    return got


def test_budgets_equal_water_filling(spark):
    rng = random.Random(4)
    recipe = mixing.Recipe()
    leaves = [(d, g, o, rng.randint(1, 5000)) for d, g, o in itertools.product(["web", "books", "z"], ["en", "fr"], ["a", "b", "c"])]
    frame = spark.createDataFrame(leaves, "domain string, language string, origin string, supply long")
    for budget in (0, 1, 777, 20_000, sum(s for *_, s in leaves) * 2, 10**12):
        got = {(r.domain, r.language, r.origin): r for r in mixing.leaf_budgets(frame, recipe, budget).collect()}
        supply = {(d, g, o): s for d, g, o, s in leaves}
        cap = defaultdict(int)
        for path, s in supply.items():
            for depth in (1, 2, 3):
                cap[path[:depth]] += 2 * s
        weight = lambda level, name: recipe.weights[level].get(name, 1)
        exact = {(): Fraction(budget)}
        for depth, level in enumerate(mixing.LEVELS, 1):
            for parent in {p[: depth - 1] for p in supply}:
                children = {p[:depth] for p in supply if p[: depth - 1] == parent}
                total = sum(r.budget for p, r in got.items() if p[: depth - 1] == parent) if depth > 1 else budget
                exact |= shared(total, {c: weight(level, c[-1]) for c in children}, cap)
                for c in children:
                    mine = sum(r.budget for p, r in got.items() if p[:depth] == c)
                    assert abs(mine - exact[c]) <= 1 and mine <= cap[c], (budget, c)
        assert sum(r.budget for r in got.values()) == min(budget, cap_total := 2 * sum(supply.values())) <= cap_total
        assert all(r.epochs * r.supply + r.rest == r.budget for r in got.values())


def test_mixture_takes_prefixes_of_epochs(spark):
    rows = documents()
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("tokens", F.lit("mine")).withColumn("epoch", F.lit(9))
    taken = mixing.mixture(docs).collect()
    total = sum(len((r[1] or "").split()) for r in rows)
    assert sum(r.taken for r in taken) == total * 7 // 10
    assert max(r.epoch for r in taken) <= 1
    assert sum(r.taken < r.tokens for r in taken) <= len({(r.domain, r.language, r.origin) for r in taken})
    by_leaf = defaultdict(list)
    for r in taken:
        by_leaf[r.domain, r.language, r.origin, r.epoch].append(r)
    for (domain, language, origin, epoch), part in by_leaf.items():
        later = by_leaf.get((domain, language, origin, epoch + 1))
        if later:
            assert all(r.taken == r.tokens for r in part)
    assert sorted(map(str, mixing.mixture(docs).collect())) == sorted(map(str, taken))
    mixed = mixing.mixed_documents(docs)
    assert mixed.columns == docs.columns
    texts = mixed.collect()
    assert sum(len(r.text.split()) for r in texts) == total * 7 // 10
    assert all(r.n_chars == len(r.text) for r in texts)
    assert mixing.mixture(docs.limit(0)).count() == 0
    everything = mixing.mixture(docs, budget=10**9).collect()
    assert sum(r.taken for r in everything) == 2 * total


def test_bounds_are_optimal():
    rng = random.Random(3)
    for _ in range(40):
        lengths = rng.sample(range(1, 40), rng.randint(1, 7))
        counts = [rng.randint(1, 9) for _ in lengths]
        for buckets in (1, 2, 3, 9):
            def padding(bounds):
                return sum(c * (min(b for b in bounds if b >= n) - n) for n, c in zip(lengths, counts))

            best = min(
                padding((*chosen, max(lengths)))
                for size in range(min(buckets, len(lengths)))
                for chosen in itertools.combinations(lengths, size)
            )
            bounds = packing.best_bounds(lengths, counts, buckets)
            assert len(bounds) <= buckets and bounds == sorted(bounds) and padding(bounds) == best
    assert packing.best_bounds([], [], 4) == []


def test_packed_batches(spark, monkeypatch):
    monkeypatch.setattr("faultline.llm.common.BUCKET_ROWS", 16)
    rows = documents(200, 8) + [(5000, "w " * 5003, "en", "src0", 1)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("piece", F.lit(1))
    got = packing.packed(docs, max_length=50, buckets=4, token_budget=400).collect()
    pieces = Counter()
    for doc_id, text, *_ in rows:
        n = len((text or "").split())
        pieces.update((doc_id, k, 50 * k, min(50, n - 50 * k)) for k in range(-(-n // 50)))
    assert Counter((r.doc_id, r.piece, r.first_token, r.n_tokens) for r in got) == pieces
    assert len({r.padded_length for r in got}) <= 4
    assert all(r.n_tokens <= r.padded_length for r in got)
    batches = defaultdict(list)
    for r in got:
        batches[r.bucket, r.batch].append(r)
    for (bucket, batch), part in batches.items():
        rows_each = max(1, 400 // part[0].padded_length)
        assert len(part) * part[0].padded_length <= 400 and sorted(r.slot for r in part) == list(range(len(part)))
        assert len(part) == rows_each or batch == max(b for k, b in batches if k == bucket)
    assert packing.packed(docs.limit(0)).count() == 0


def test_matrix_sums_and_law():
    parts, shards = [5, 0, 7, 3], [4, 4, 4, 3]
    seen = Counter()
    for seed in range(3000):
        matrix = sharding.communication_matrix(parts, shards, seed)
        assert matrix.sum(1).tolist() == parts and matrix.sum(0).tolist() == shards
        seen[int(matrix[0, 0])] += 1
    from math import comb

    for k in range(5):
        exact = comb(4, k) * comb(11, 5 - k) / comb(15, 5)
        assert abs(seen[k] / 3000 - exact) < 0.03


def test_large_draws_have_the_right_mean():
    rng = np.random.default_rng(1)
    draws = [sharding.draw_good(2 * 10**9, 6 * 10**9, 10**6, rng) for _ in range(60)]
    assert abs(np.mean(draws) - 250_000) < 6 * 433 / 60**0.5
    assert 200 < np.std(draws) < 800


def test_shards_are_exact_and_gapless(spark, monkeypatch):
    monkeypatch.setattr(sharding, "bucket_bits", lambda rows: 3)
    rows = [(i % 90 if i % 11 else None, "same" if i % 3 else f"text é {i}" if i % 5 else None) for i in range(301)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("shard", F.lit("x")).repartition(5)
    got = sharding.shuffled_shards(docs, 16).collect()
    import zlib

    wanted = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == wanted
    for shard in range(16):
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots))) and len(slots) in (18, 19)
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}
    assert sharding.shuffled_shards(docs.limit(0)).count() == 0


def test_places_do_not_depend_on_the_source(spark):
    docs = spark.range(0, 160, 1, 4).select(F.col("id").alias("doc_id"), F.lit("text").alias("text"))
    seen, places = Counter(), defaultdict(list)
    for seed in range(6):
        for r in sharding.shuffled_shards(docs, 4, seed).collect():
            seen[r.doc_id // 40, r.shard] += 1
            places[r.doc_id // 40].append(r.slot)
    # 240 rows of each source partition: 60 a shard, spread below 6; slots 0 to 39.
    assert len(seen) == 16 and all(abs(n - 60) < 5 * 6 for n in seen.values())
    assert all(abs(np.mean(slots) - 19.5) < 5 * 11.6 / 240**0.5 for slots in places.values())


@pytest.mark.parametrize("rows", [0, 1, 15, 16, 1000])
def test_sizes(rows):
    sizes = sharding.shard_sizes(rows, 16)
    assert sum(sizes) == rows and max(sizes) - min(sizes) <= 1
