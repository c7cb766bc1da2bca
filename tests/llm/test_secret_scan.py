"""Secret scanner: automaton against Python's regular expressions, contract columns, redaction."""

from __future__ import annotations

import hashlib
import random
import re
import time
import tracemalloc

import pyarrow as pa
import pytest

from faultline.llm import secret_scan as s

BASE = {
    "assign": re.compile(r"""((?a:(?i:password|passwd|secret|token|api_?key)))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}


def base_spans(text):
    """The base rules as the contract words them: search, then drop failing matches."""
    found = []
    for place, (kind, pattern) in enumerate(BASE.items()):
        for m in pattern.finditer(text or ""):
            fits = {"assign": lambda m: len(m[2]) >= 6, "access": lambda m: len(m[0]) >= 20, "hex": lambda m: len(m[0]) >= 24}
            if fits[kind](m):
                found.append((m.start(), place, kind, m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


PIECES = [
    "password", "PassWd", "token", "secretoken", "api_key", "ApiKey", "AKIA", "AKIAKIA", "0f", "deadbeef" * 3, "=", ":", " ",
    "  ", '"', "'", "é", "😀", "abc", "abcdef", "ABCDEFGH12345678", "-", ".", "\n", "ſecret", "toKen", "x" * 5, "eyJ", "_",
    "-----BEGIN RSA PRIVATE KEY-----", "/", "1234567",
]


def random_texts(count, seed=4):
    rng = random.Random(seed)
    return ["".join(rng.choices(PIECES, k=rng.randint(0, 30))) for _ in range(count)]


def test_base_spans_equal_regular_expressions():
    for text in random_texts(4000):
        got = [span for span in s.spans_of(text) if span[0] in s.BASE_KINDS]
        assert got == base_spans(text), text


@pytest.mark.parametrize("pattern", ["ab+c?", "(ab|a)c{2,3}d*", "x[a-c]{2}y|x[b-d]+z", "a?b?c", "(a|b)*abb"])
def test_any_rule_is_leftmost_longest(pattern):
    rng = random.Random(pattern)
    rule = (s.Rule("k", pattern),)
    exact = re.compile(pattern)
    for _ in range(400):
        text = "".join(rng.choices("abcdxyz", k=rng.randint(0, 25)))
        expected, at = [], 0
        while at < len(text):
            ends = [end for end in range(len(text), at, -1) if exact.fullmatch(text, at, end)]
            if ends:
                expected.append(("k", at, ends[0]))
                at = ends[0]
            else:
                at += 1
        assert s.spans_of(text, rule) == expected, text


def test_automaton_is_minimal():
    one = s.Automaton((s.Rule("a", "abc|abd|ab[cd]"),), False)
    assert one.n_states == 5
    assert s.Automaton((s.Rule("a", "(a|b)*abb"),), False).n_states == 5  # four and the dead state


def test_scan_and_redact(spark):
    long = "word " * 100_000 + "token=abcdef123 " + "é" * 10 + "AKIA" + "B" * 16
    texts = [None, "", "password: short", "password: longer1", "a secret = 'x=y=z=1' b", long, *random_texts(60, 9)]
    rows = [(i if i != 3 else None, t, "en") for i, t in enumerate(texts)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = sorted((tuple(r) for r in s.scan(docs).collect()), key=str)
    expected = []
    for doc_id, text, _ in rows:
        base, spans = base_spans(text), s.spans_of(text)
        assert [x for x in spans if x[0] in s.BASE_KINDS] == base
        counts = [sum(x[0] == kind for x in base) for kind in s.BASE_KINDS]
        expected.append((doc_id, *counts, hashlib.sha256(s.written(base).encode()).hexdigest(), s.written(spans), len(spans)))
    assert got == sorted(expected, key=str)
    assert s.scan(docs.limit(0)).count() == 0
    clean = s.redact(docs)
    assert clean.schema.names == docs.schema.names and clean.count() == len(rows)
    for row in clean.collect():
        assert row.text is None or not [x for x in base_spans(row.text) if x[0] != "assign"]


def test_redaction_keeps_the_rest():
    text = "é AKIA" + "C" * 16 + " and token='abcdef1' end"
    assert s.redacted(text) == "é [secret] and [secret]' end"
    assert s.redacted("nothing") == "nothing" and s.redacted(None) is None


@pytest.mark.parametrize("piece", ["token=abcdefgh é ", "password: x1y2z3w4;AKIA" + "Q" * 16 + " ", "0123456789abcdef01234567 ", "secret=ab "])
def test_time_grows_with_the_text(piece):
    """50,000 secrets or more take their share of time, not the square."""
    text = piece * max(50_000, 1_000_000 // len(piece))
    assert [span for span in s.spans_of(text[:20_000]) if span[0] in s.BASE_KINDS] == base_spans(text[:20_000])
    start = time.process_time()
    found = s.spans_of(text)
    seconds = time.process_time() - start
    assert [span for span in found if span[0] in s.BASE_KINDS] == base_spans(text)
    assert seconds < 6 * len(text) / 1_000_000, seconds


def test_redaction_holds_a_piece_of_a_batch():
    """The objects of a batch of 40 MB are never held at once, and every text comes back in its place."""
    plain, secret = "word " * 800, "token=abcdef123 " + "word " * 800
    texts = [None if i % 7 == 3 else secret if i % 1000 == 5 else f"{i} {plain}" for i in range(10_000)]
    batch = pa.array(texts)
    expected = pa.array([text and text.replace("token=abcdef123", s.MASK) for text in texts])
    s.compiled(s.RULES)
    seen = 0
    tracemalloc.start()
    for piece in s._cleaned(iter([batch, batch.slice(0, 0)]), (s.Rule("assign", "token=[a-z0-9]+"),), s.MASK):
        assert 0 < len(piece) <= s.TEXT_ROWS and piece.equals(expected.slice(seen, len(piece)))
        seen += len(piece)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen == len(batch) and peak < batch.nbytes / 4, (seen, peak)


def test_redaction_of_more_rows_than_a_batch(spark):
    """Null and repeated ids and texts, in one task of several batches."""
    texts = [None, "", "é token=abcdef123 ü", "nothing"]
    rows = [(None if i % 5 == 0 else i // 2, texts[i % 4], i) for i in range(25_003)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, place int").coalesce(1)
    expected = [(doc_id, "é [secret] ü" if text and "token" in text else text, i) for doc_id, text, i in rows]
    assert [tuple(row) for row in s.redact(docs).collect()] == expected
