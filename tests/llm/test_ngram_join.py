"""N-gram join: routing guarantee, tree join and components against brute force."""

from __future__ import annotations

import random
from collections import Counter
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest

from faultline.llm import ngram_join
from faultline.llm.common import TEXT_ROWS
from faultline.llm.components import components
from faultline.llm.ngram_join import THRESHOLD, beginning, dropped, join_block, ngram_components, shingle_set

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def links(a, b, threshold=Fraction(9, 10)):
    common = len(set(a) & set(b))
    union = len(set(a) | set(b))
    return bool(union) and common * threshold.denominator >= union * threshold.numerator


def smallest_reachable(ids, linked):
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return label


@pytest.mark.parametrize("threshold", [Fraction(9, 10), Fraction(8, 10), Fraction(1, 2), Fraction(1)])
def test_linking_sets_keep_a_common_sign(threshold):
    """Whatever the frequencies are, after both sets dropped their most frequent routed shingles."""
    rng = np.random.default_rng(1)
    up, down = threshold.numerator, threshold.denominator
    for size in [*range(1, 70), 150, 400, 2000]:
        for _ in range(40 if size < 200 else 6):
            pool = np.unique(rng.integers(0, 2**64, 3 * size + 9, dtype=np.uint64))
            frequency = dict(zip(pool.tolist(), rng.integers(1, 6, len(pool)).tolist()))
            x = np.sort(rng.choice(pool, size, replace=False))
            keep = int(rng.integers(-(-up * size // down), size + 1))
            add, rest = 0, np.setdiff1d(pool, x)
            while keep * down >= up * (size + add + 1) and rng.random() < 0.95:
                add += 1
            y = np.sort(np.concatenate((rng.choice(x, keep, replace=False), rng.choice(rest, add, replace=False))))
            assert links(x.tolist(), y.tolist(), threshold)
            kept = []
            for tokens in (x, y):
                routed = sorted(beginning(tokens, threshold).tolist(), key=lambda t: (frequency[t], np.uint64(t).view(np.int64)))
                kept.append(set(routed[: len(routed) - dropped(len(tokens), threshold)]))
            assert kept[0] & kept[1], (size, keep, add)


@pytest.mark.parametrize("long_run", [20_000, 30])
def test_rare_signs_equal_a_plain_count(spark, long_run):
    rng = random.Random(long_run)
    rows = {(rep, sign) for rep in range(900) for sign in rng.choices([0, 1, 2, *range(-400, 400)], [300, 90, 9, *[1] * 800], k=6)}
    drop = {rep: rng.randint(0, 3) for rep in range(900)}
    frame = spark.createDataFrame([(r, s, drop[r]) for r, s in rows], "rep long, sign long, drop int").repartition(7)
    frequency = Counter(s for _, s in rows)
    expected = set()
    for rep in range(900):
        own = sorted((min(frequency[s], long_run), s) for r, s in rows if r == rep)
        expected |= {(rep, s) for n, s in own[: max(0, len(own) - drop[rep])] if n > 1}
    got = ngram_join.rare_signs(frame, long_run).collect()
    assert len(got) == len(expected) and {(r.rep, r.sign) for r in got} == expected


@pytest.mark.parametrize("long_run", [20_000, 3, 2])
def test_run_lengths_across_batches(long_run):
    rng = random.Random(long_run)
    for _ in range(200):
        sizes = [rng.choice([1, 1, 2, 3, 9]) for _ in range(rng.randint(1, 12))]
        rows = [(rep, sign, 0) for sign, size in enumerate(sizes) for rep in range(size)]
        cuts = sorted(rng.sample(range(len(rows) + 1), min(len(rows), rng.randint(0, 5))))
        frame = pd.DataFrame(rows, columns=["rep", "sign", "drop"])
        parts = [frame.iloc[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]
        out = pd.concat(list(ngram_join._sized(iter(parts), long_run)))
        for sign, part in out.groupby("sign"):
            assert len(part) == sizes[sign] and part["rep"].is_unique
            edge = sign in (0, len(sizes) - 1)
            told = set(part["size"].dropna())
            assert told <= {min(sizes[sign], long_run)} and (edge or not part["size"].isna().any())
            assert not edge or part["size"].isna().all() or sizes[sign] > long_run
        inner = set(range(1, len(sizes) - 1))
        assert {s for s in inner if sizes[s] > 1} | {0, len(sizes) - 1} <= set(out["sign"])


@pytest.mark.parametrize("two_blocks", [False, True])
def test_tree_join_finds_every_component(two_blocks):
    rng = random.Random(3)
    for _ in range(60):
        pool = [rng.getrandbits(64) for _ in range(60)]
        sets = []
        for _ in range(rng.randint(2, 25)):
            base = set(rng.sample(pool[:30], rng.randint(8, 30))) if not sets or rng.random() < 0.3 else set(rng.choice(sets))
            for _ in range(rng.randint(0, 3)):
                base.discard(rng.choice(sorted(base)))
                base.add(rng.choice(pool))
            sets.append(sorted(base))
        sides = [two_blocks and rng.random() < 0.5 for _ in sets] if two_blocks else [True] * len(sets)
        arrays = [np.array(s, dtype=np.uint64) for s in sets]
        got = join_block(list(range(len(sets))), arrays, sides, THRESHOLD)
        pairs = [(i, j) for i in range(len(sets)) for j in range(i) if links(sets[i], sets[j])]
        if two_blocks and any(sides) and not all(sides):
            pairs = [(i, j) for i, j in pairs if sides[i] or sides[j]]
        assert all(links(sets[a], sets[b]) for a, b in got if (max(a, b), min(a, b)) in pairs)
        assert smallest_reachable(range(len(sets)), got) == smallest_reachable(range(len(sets)), pairs)


def corpus(seed=5):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(200)]
    rows, texts = [], []
    for i in range(160):
        if texts and rng.random() < 0.6:
            tokens = rng.choice(texts).split()
            for _ in range(rng.randint(0, 2)):
                tokens[rng.randrange(len(tokens))] = rng.choice(words)
        else:
            tokens = rng.choices(words, k=rng.choice([1, 2, 5, 12, 13, 40, 90, 300]))
        texts.append(" ".join(tokens))
        rows.append((1000 - i, texts[-1], "en", "s", 1))
    rows += [(i, "\t".join(texts[0].upper().split()), None, None, None) for i in range(2000, 2030)]
    return rows + [(3000, None, "en", "s", 0), (3001, " \n\t ", "en", "s", 3), (3002, "é É É", "fr", "s", 5)]


def expected(rows):
    sets = {}
    for doc_id, text, *_ in rows:
        words = (text or "").encode().lower().split()
        grams = {tuple(words[k : k + 3]) for k in range(len(words) - 2)} if len(words) > 2 else {tuple(words)} if words else set()
        sets.setdefault(doc_id, []).append(grams)
    ids = sorted(sets)
    linked = [
        (a, b) for n, a in enumerate(ids) for b in ids[:n] if any(links(x, y) for x in sets[a] for y in sets[b])
    ]
    label = smallest_reachable(ids, linked)
    return sorted((i, len(s), label[i]) for i in ids for s in sets[i])


@pytest.mark.parametrize("block", [2000, 7])
def test_components_against_brute_force(spark, block):
    rows = corpus()
    got = ngram_components(spark.createDataFrame(rows, SCHEMA), block=block).collect()
    assert sorted(map(tuple, got)) == expected(rows)


@pytest.mark.parametrize("block", [2000, 7])
def test_every_link_is_counted(spark, block):
    rows = corpus() + [(1000, corpus()[0][1], "en", "s", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    sets = {doc_id: set(shingle_set(text).tolist()) for doc_id, text, *_ in rows}
    pairs = {(a, b) for a in sets for b in sets if a != b and links(sets[a], sets[b])}
    got = ngram_join.ngram_links(docs, block=block).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == expected(rows)
    assert {r.doc_id: r.n_links for r in got} == {a: sum(x == a for x, _ in pairs) for a in sets}
    found, members = ngram_join.class_pairs(docs, block=block)
    rep = {r.doc_id: r.rep for r in members.collect()}
    got = [(min(r.a, r.b), max(r.a, r.b)) for r in found.collect()]
    assert len(got) == len(set(got))
    assert set(got) == {(rep[a], rep[b]) for a, b in pairs if rep[a] < rep[b]}


def test_links_of_a_document_with_two_texts(spark):
    text, other = (" ".join(f"{c}{i}" for i in range(60)) for c in "tu")
    near = other + " more"
    rows = [(3, text), (5, text), (5, other), (6, near), (6, near), (None, text)]
    docs = spark.createDataFrame([(*r, None, None, None) for r in rows], SCHEMA)
    got = sorted((tuple(r) for r in ngram_join.ngram_links(docs).collect()), key=str)
    assert got == sorted([(3, 58, 3, 1), (5, 58, 3, 1), (5, 58, 3, 1), (6, 59, 3, 1), (6, 59, 3, 1), (None, 58, None, 0)], key=str)


def test_repeated_doc_id_ties_all_its_texts(spark):
    text, other = (" ".join(f"{c}{i}" for i in range(40)) for c in "tu")
    rows = [(3, text), (4, other), (5, text), (5, other)]
    docs = spark.createDataFrame([(*r, None, None, None) for r in rows], SCHEMA)
    assert {tuple(r) for r in ngram_components(docs).collect()} == {(3, 38, 3), (4, 38, 3), (5, 38, 3)}


def test_equal_rows_stay_once(spark):
    text, other = (" ".join(f"{c}{i}" for i in range(40)) for c in "tu")
    rows = [(3, text), (3, text), (3, other), (4, text), (None, text), (None, text), (None, other)]
    docs = spark.createDataFrame([(*r, None, None, None) for r in rows], SCHEMA)
    got = ngram_join.first_of_each_component(docs).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted([(3, text), (3, other), (None, text), (None, other)], key=str)


def test_defined_cases(spark):
    text = " ".join(f"t{i}" for i in range(40))
    other = " ".join(f"u{i}" for i in range(40))
    rows = [(5, text, None, None, None), (5, other, None, None, None), (7, text, None, None, None),
            (9, other, None, None, None), (9, other, None, None, None), (None, text, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS rep", "2 AS sign", "3 AS component")
    got = sorted((tuple(r) for r in ngram_components(docs).collect()), key=str)
    assert got == sorted([(5, 38, 5), (5, 38, 5), (7, 38, 5), (9, 38, 5), (9, 38, 5), (None, 38, None)], key=str)
    assert ngram_components(docs.limit(0)).count() == 0
    kept = ngram_join.first_of_each_component(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == [5, 5, None]


@pytest.mark.parametrize("threshold", [Fraction(9, 10), Fraction(8, 10)])
def test_sketches_untie_no_linking_sets(threshold):
    """Ties connect whatever links within a sign, and nothing that only shares the sign by chance."""
    rng = np.random.default_rng(2)
    up, down = threshold.numerator, threshold.denominator
    rows, sets, rep = [], {}, 0
    for size in (1, 3, 20, 150, 160, 900, 1000, 2500):
        for _ in range(4):
            base = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
            for change in range(4):
                gone = rng.choice(len(base), min(len(base) - 1, change * len(base) // 40), replace=False)
                more = rng.integers(0, 2**64, change * len(base) // 50, dtype=np.uint64)
                sets[rep] = np.union1d(np.delete(base, gone), more)
                rows += [(rep, sign, len(sets[rep]), ngram_join.sketch(sets[rep], threshold)) for sign in (size % 7, 50 + rep % 2)]
                rep += 1
    rows.sort(key=lambda row: (row[1], row[2], row[0]))
    frame = pd.DataFrame(rows, columns=["rep", "sign", "n", "sketch"])
    cuts = [0, 5, 6, 40, 41, 90, 200, len(frame)]
    parts = [frame.iloc[a:b] for a, b in zip(cuts, cuts[1:])]
    ties = pd.concat(list(ngram_join._near_ties(iter(parts), threshold)))
    got = smallest_reachable(sets, list(zip(ties["a"].tolist(), ties["b"].tolist())))
    signs = {}
    for r, sign, *_ in rows:
        signs.setdefault(r, set()).add(sign)
    linked = [(a, b) for a in sets for b in range(a) if signs[a] & signs[b] and links(sets[a].tolist(), sets[b].tolist(), threshold)]
    assert linked and all(got[a] == got[b] for a, b in linked)
    assert max(Counter(got.values()).values()) == 4


def test_chance_meetings_make_no_group(spark):
    """Texts of a small vocabulary meet in many rare phrases; without links they stay apart."""
    rng = random.Random(8)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(40)], k=rng.randint(150, 170))) for _ in range(120)]
    docs = spark.createDataFrame([(i, t, None, None, None) for i, t in enumerate([*texts, texts[0] + " more"])], SCHEMA)
    groups = ngram_join._classes(docs, 3, THRESHOLD)[-1].collect()
    assert {tuple(r) for r in groups} == {(0, 0), (120, 0)}


def test_long_text_is_read_whole():
    text = "a b c d " * 200_000
    assert len(shingle_set(text)) == 4
    assert len(shingle_set(text + "end")) == 5


def test_chain_and_star_components(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7)]
    got = components(spark.createDataFrame(edges, "a long, b long"))
    assert {tuple(r) for r in got.collect()} == {(i, 1) for i in range(1, 61)} | {(100 + i, 100) for i in range(40)}


def test_texts_are_cut_into_shingles_in_small_batches(spark, monkeypatch):
    """A task's texts reach the workers by a few hundred rows, and the session's own setting comes back."""
    whole, rows = ngram_join._digests, TEXT_ROWS
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"

    def checked(frames, *options):
        def small():
            for frame in frames:
                assert len(frame) <= rows, len(frame)
                yield frame

        return whole(small(), *options)

    monkeypatch.setattr(ngram_join, "_digests", checked)
    docs = spark.createDataFrame([(i // 2 * 2, f"a b c d{i // 4}", "en", "s", 8) for i in range(4 * rows)], SCHEMA)
    before = spark.conf.get(name, None)
    got = ngram_components(docs.coalesce(1)).collect()
    assert spark.conf.get(name, None) == before
    assert Counter((r.doc_id, r.component_id) for r in got) == Counter((i // 2 * 2, i // 4 * 4) for i in range(4 * rows))
