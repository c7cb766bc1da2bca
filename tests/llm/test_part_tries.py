"""Product codes against plain loops over all entries."""

from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from faultline.llm import part_tries
from faultline.llm.part_tries import nearest_entries

SCHEMA = "vec_id long, embedding array<double>, label int, code string, error string"


def plain_codes(rows, parts, entries, rounds):
    """rows: (vec_id, whole numbers, label) that take part, in the order of vec_id."""
    width = len(rows[0][1]) // parts
    cut = lambda v, p: tuple(v[p * width : (p + 1) * width])
    books = [[cut(v, p) for _, v, _ in rows[:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        new = []
        for p in range(parts):
            groups = defaultdict(list)
            for _, v, _ in rows:
                groups[nearest(p, cut(v, p))[1]].append(cut(v, p))
            new.append([tuple(sum(c) // len(c) for c in zip(*groups[i])) if groups[i] else e for i, e in enumerate(books[p])])
        books = new
    out = []
    for vec_id, v, label in rows:
        found = [nearest(p, cut(v, p)) for p in range(parts)]
        out.append((vec_id, label, "".join(f"{i:02x}" for _, i in found), sum(d for d, _ in found)))
    total = defaultdict(int)
    for _, label, _, error in out:
        total[label] += error
    numbers = ",".join(str(x) for book in books for e in book for x in e)
    return [(*row, total[row[1]]) for row in out], hashlib.sha256(numbers.encode()).hexdigest()


@pytest.mark.parametrize("leaves", [1, 2, 16, 1000])
def test_trie_finds_the_nearest_entry(leaves):
    rng = np.random.default_rng(leaves)
    for width, span in ((1, 40), (3, 4), (5, 2), (8, 1000)):
        parts = np.unique(rng.integers(-span, span, (300, width)), axis=0)
        entries = rng.integers(-span, span, (17, width))
        entries[5] = entries[2]
        index, distance = nearest_entries(parts, entries, leaves)
        full = ((parts[:, None] - entries[None]) ** 2).sum(2)
        assert (index == full.argmin(1)).all() and (distance == full.min(1)).all()


def test_codes_equal_plain_loops(spark):
    rng = random.Random(8)
    rows = [(i * 2, [rng.choice([-0.7, 0.25, rng.gauss(0, 1)]) for _ in range(8)], rng.choice([1, 2, None])) for i in range(150)]
    rows += [(400 + i, rows[3][1], 1) for i in range(40)] + [(2, [0.5] * 8, 2)]
    odd = [
        (900, None, 1), (901, [], 1), (902, [1.0] * 7 + [float("nan")], 1), (903, [float("inf")] + [0.0] * 7, 2),
        (904, [None] + [0.0] * 7, 2), (905, [1.0] * 4, 1), (906, [1.0] * 9, 1),
    ]
    frame = spark.createDataFrame([(*r, "c", "e") for r in rng.sample(rows + odd, len(rows + odd))], SCHEMA).repartition(4)
    coded, books = part_tries.compressed(frame, entries=16, rounds=3)
    whole = sorted(((i, [int(np.floor(1024 * x)) for x in v], label) for i, v, label in rows), key=lambda r: r[:2])
    expected, digest = plain_codes(whole, 4, 16, 3)
    assert sorted((tuple(r) for r in coded.collect()), key=repr) == sorted(expected, key=repr)
    assert books.digest() == digest


def test_salted_label_sums_are_the_same(spark, monkeypatch):
    frame = spark.createDataFrame([(i, i % 3 or None, f"{i:02x}", i) for i in range(50)], "vec_id long, label int, code string, error long")
    sent = sorted(map(tuple, part_tries.with_label_error(frame).collect()), key=repr)
    monkeypatch.setattr(part_tries, "LABELS_SENT", 1)
    assert sorted(map(tuple, part_tries.with_label_error(frame).collect()), key=repr) == sent


def test_few_huge_and_no_vectors(spark):
    schema = "vec_id long, embedding array<double>, label int"
    few = spark.createDataFrame([(None, [1e300, -1e300, 0.0, 0.0], None), (1, [1e300, 0.0, 0.0, 0.0], 1)], schema)
    coded, books = part_tries.compressed(few)
    assert {(r.vec_id, r.code, r.error) for r in coded.collect()} == {(1, "00000000", 0), (None, "00010000", 0)}
    assert max(int(abs(b).max()) for b in books.entries) == part_tries.COMPONENT_BOUND
    coded, books = part_tries.compressed(few.filter("vec_id = 5"))
    assert coded.collect() == [] and coded.columns == ["vec_id", "label", "code", "error", "label_error"]
    assert books.digest() == hashlib.sha256(b"").hexdigest()


def test_tasks_without_a_position_give_no_sums():
    import pandas as pd
    import pyarrow as pa

    books = part_tries.Codebooks([np.array([[0], [9]])] * 4)
    frame = pd.DataFrame({"position": [2], "part": [np.array([8], dtype=np.int32)], "rows": [5]})
    out = list(part_tries._sums(iter([frame]), books))
    schema = pa.schema([("position", pa.int32()), ("entry", pa.int32()), ("rows", pa.int64()), ("sums", pa.list_(pa.int64()))])
    rows = [r for f in out for r in pa.RecordBatch.from_pandas(f, schema, preserve_index=False).to_pylist()]
    assert rows == [{"position": 2, "entry": 1, "rows": 5, "sums": [40]}]
