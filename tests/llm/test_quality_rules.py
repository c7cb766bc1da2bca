"""Quality ledger: measures against plain Python, policies and ablations."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from faultline.llm import quality_rules as q

SCHEMA = "doc_id long, text string, lang string"


def measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines),
            len(lines) - len(set(lines)), len(covered))


def texts():
    rng = random.Random(2)
    words = ["a", "b", "é", "c#", "😀", "long" * 4]
    made = [rng.choice([" ", "\n", "\t", "\r\n", "\x0b \x0c"]).join(rng.choices(words, k=rng.randint(0, 40))) for _ in range(150)]
    return [None, "", " \n\t", "one", "one two", "a b c a b c", "x\nx\n x\nx", "   ", "w " * 30000, *made, *made[:9]]


@pytest.mark.parametrize("hash_bits", [64, 3])
def test_measures(spark, hash_bits):
    rows = [(i if i % 7 else None, t, "en") for i, t in enumerate(texts()) if hash_bits == 64 or len(t or "") < 1000]
    got = q.ledger(spark.createDataFrame(rows, SCHEMA), hash_bits=hash_bits).select("doc_id", *q.MEASURES).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(str((i, *measures(t))) for i, t, _ in rows)


def test_policies_and_clashing_columns(spark):
    good = " ".join(f"w{i}" for i in range(60))
    rows = [(1, good, "en"), (2, "few words", "en"), (3, good + " # $ %" * 30, "en"), (4, (good + "\n") * 3, "en"), (5, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("n_words", F.lit("mine")).withColumn("_words", F.lit(1))
    ledger = q.with_ledger(docs)
    assert set(docs.columns) < set(ledger.columns) and len(ledger.columns) == len(set(ledger.columns))
    kept = {
        policy.version: {r.doc_id for r in q.apply_policy(ledger, policy).filter("kept").collect()} for policy in q.POLICIES
    }
    assert kept == {1: {1, 3}, 2: {1}, 3: {1}} or kept == {1: {1}, 2: {1}, 3: {1}}
    assert {r.doc_id for r in q.apply_policy(ledger).filter("base_failed").collect()} >= {2, 4, 5}
    assert q.ledger(docs.limit(0)).count() == 0


def test_ablations(spark):
    masks = [0, 1, 1, 2, 3, 4, 6, 16, 17]
    entries = spark.createDataFrame([(m,) for m in masks], "failed_rules long")
    policy = q.Policy(9, ("few_words", "repeated_words", "many_symbols"))
    got = {r.rule: (r.n_failed, r.n_failed_alone, r.n_kept_without) for r in q.ablations(entries, policy).collect()}
    for rule in q.RULES[:3]:
        bit, seen = 1 << rule.bit, [m & 7 for m in masks]
        assert got[rule.name] == (
            sum(bool(m & bit) for m in seen), sum(m == bit for m in seen), sum(not m & ~bit for m in seen))
