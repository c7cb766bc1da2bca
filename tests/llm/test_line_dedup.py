"""Line deduplication against a plain program, over all ways to cut the sorted rows into tasks."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from faultline.llm import line_dedup
from faultline.llm.line_dedup import CARRIED, DOCUMENT, DROPPED, FREQUENT, HASH

SCHEMA = "doc_id long, text string, document string, keep long, n_lines string"
BLANKS = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(BLANKS))


def brute(rows, min_docs, keep_first):
    """(doc_id, text) to (kept text, lines, dropped lines)."""
    documents = {(doc_id, text): (text or "").split("\n") for doc_id, text in rows}
    found = defaultdict(set)
    for document, lines in documents.items():
        for line in lines:
            found[key_of(line)].add(document)
    out = {}
    order = sorted(documents, key=lambda d: (d[0] is not None, d[0] or 0))
    seen = set()
    for document in order:
        kept = []
        for line in documents[document]:
            key = key_of(line)
            drop = key != "" and len(found[key]) >= min_docs and not (keep_first and key not in seen)
            seen.add(key)
            kept += [] if drop else [line]
        out[document] = ("\n".join(kept), len(documents[document]), len(documents[document]) - len(kept))
    return out


def documents(seed, count=60):
    rng = random.Random(seed)
    pool = [f"line {i}" for i in range(30)] + ["", "  ", "Ärger", "ärger"]
    rows = []
    for i in range(count):
        lines = [rng.choice(pool[: rng.choice([3, 12, 34])]) for _ in range(rng.randint(0, 9))]
        lines = [rng.choice(["", " ", "\t"]) + rng.choice([s, s.upper()]) + rng.choice(["", "\r"]) for s in lines]
        rows.append((i * 3, "\n".join(lines)))
    return [*rows, *rows[:6], (7000, None), (7001, ""), (None, "line 1\nown"), (None, "line 1\nown")]


@pytest.mark.parametrize("min_docs, keep_first", [(1, True), (2, True), (3, False), (10, False), (10, True)])
def test_equals_a_plain_program(spark, min_docs, keep_first):
    rows = documents(min_docs)
    frame = spark.createDataFrame([(*r, "mine", 5, "x") for r in rows], SCHEMA).repartition(5)
    cut = line_dedup.without_lines(frame, line_dedup.line_bitmaps(frame, min_docs, keep_first))
    got = cut.select("document.*", F.col("text").alias("kept"), F.col("n_lines").alias("n"), "n_dropped").toPandas()
    assert len(got) == len(rows) and set(got["document"]) == {"mine"} and set(got["keep"]) == {5}
    expected = brute(rows, min_docs, keep_first)
    for doc_id, text, kept, n, dropped in got[["doc_id", "text", "kept", "n", "n_dropped"]].itertuples(index=False):
        document = (None if pd.isna(doc_id) else int(doc_id), text)
        assert (kept or "", n, dropped) == expected[document], document


@pytest.mark.parametrize("keep_first", [False, True])
def test_runs_across_batches_and_tasks(keep_first):
    rng = random.Random(3)
    rows = []
    for high, size in ((1, 1), (2, 9), (3, 3), (4, 25), (5, 2), (6, 40), (7, 4)):
        rows += [(high, 0, True, doc, 7, 3, np.array([0, 2], "<i4").tobytes()) for doc in range(size)]
    rows = sorted(rows + rng.sample(rows, 15))
    frame = pd.DataFrame(rows, columns=CARRIED)
    sizes = frame.drop_duplicates([*HASH, *DOCUMENT]).groupby("high").size()
    expected = {
        (high, doc): [2] if keep_first and doc == 0 else [0, 2] for high, size in sizes.items() if size >= 4 for doc in range(size)
    }
    for tasks in range(1, 9):
        for _ in range(12):
            cuts = sorted(rng.sample(range(1, len(rows)), tasks - 1))
            found = []
            for low, high in zip([0, *cuts], [*cuts, len(rows)]):
                batches = sorted(rng.sample(range(low + 1, high), min(3, high - low - 1)))
                frames = [frame.iloc[a:b] for a, b in zip([low, *batches], [*batches, high])]
                found += list(line_dedup._settle(iter(frames), 4, keep_first))
            out = pd.concat(found)
            gone = defaultdict(set)
            opened = out[out["state"] != DROPPED]
            for row in out[out["state"] == DROPPED].itertuples():
                gone[row.high, row.doc] |= set(np.frombuffer(row.lines, "<i4").tolist())
            for high, part in opened.groupby("high"):
                if part["state"].max() == FREQUENT or part["doc"].nunique() >= 4:
                    least = part["doc"].min()
                    for row in part.itertuples():
                        lines = np.frombuffer(row.lines, "<i4")
                        gone[high, row.doc] |= set((lines[1:] if keep_first and row.doc == least else lines).tolist())
            assert {k: sorted(v) for k, v in gone.items() if v} == expected


def test_bitmaps_round_trip():
    rng = np.random.default_rng(1)
    for size in (1, 7, 8, 9, 1000):
        kept = rng.random(size) < 0.5
        assert (line_dedup.unpack(line_dedup.pack(kept), size) == kept).all()


def test_long_texts_empty_tables_and_limits(spark):
    long_text = "\n".join(["same"] * 50_000 + [f"only {i}" for i in range(50_000)])
    frame = spark.createDataFrame([(i, long_text if i == 3 else "Same \nb%d" % i) for i in range(10)], "doc_id long, text string")
    bitmaps = line_dedup.line_bitmaps(frame)
    assert {r.doc: r.n_dropped for r in bitmaps.collect()} == {i: 50_000 if i == 3 else 1 for i in range(10)}
    assert max(len(r.keep) for r in bitmaps.collect()) < 1000
    nothing = frame.filter("doc_id < 0")
    assert line_dedup.without_lines(nothing, line_dedup.line_bitmaps(nothing)).count() == 0
    with pytest.raises(ValueError):
        line_dedup.line_bitmaps(frame, 0)
