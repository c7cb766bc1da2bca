"""Secret scanner: all rules in one deterministic automaton, one pass over a text's bytes.

Each rule is a regular expression over bytes.  The rules are parsed into one non-deterministic
automaton with a searching start, determinised by subset construction and minimised by partition
refinement; the result is one array of transitions over byte classes and one mask of accepting
rules per state.  A pass over the bytes gives every position at which some rule accepts.  Only
there, the rule's reversed automaton finds the leftmost start after the rule's last span and its
anchored automaton the longest end, which is what a leftmost, greedy search gives for these rules.
A rule's condition then looks at the span's bytes and drops spans that fail it.

Defined cases: a null text counts as empty and has no spans; rows are scanned one by one, so null
or repeated ids need no care; a text of any length with any number of secrets takes time in
proportion and a few bytes per accepting position; further columns of the documents are ignored by ``scan`` and kept by
``redact``.
"""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import TEXT_ROWS, in_pandas, send_package


@dataclass(frozen=True)
class Rule:
    """``pattern`` knows literals, classes, groups, | and the quantifiers ? + * {n} {n,} {n,m};
    ``fold`` makes its letters match in either case; ``tail`` is the least length of what follows
    the separator of an assignment and ``least`` that of the whole span (0: no condition)."""

    kind: str
    pattern: str
    fold: bool = False
    tail: int = 0
    least: int = 0


RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""", True, 6),
    Rule("access", r"AKIA[A-Z0-9]+", least=20),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", least=40),
)
BASE_KINDS = ("assign", "access", "hex")
MASK = "[secret]"


# --- from patterns to one automaton -------------------------------------------------------------

class _Parser:
    """Recursive descent over a pattern; gives nested tuples."""

    def __init__(self, pattern: str, fold: bool):
        self.text, self.at, self.fold = pattern, 0, fold

    def parse(self):
        node = self.either()
        if self.at != len(self.text):
            raise ValueError(f"unexpected {self.text[self.at]!r} at {self.at} of {self.text!r}")
        return node

    def peek(self) -> str:
        return self.text[self.at] if self.at < len(self.text) else ""

    def either(self):
        options = [self.sequence()]
        while self.peek() == "|":
            self.at += 1
            options.append(self.sequence())
        return ("or", options) if len(options) > 1 else options[0]

    def sequence(self):
        parts = []
        while self.peek() not in ("", "|", ")"):
            parts.append(self.repeated())
        return ("then", parts)

    def repeated(self):
        node = self.atom()
        sign = self.peek()
        if sign and sign in "?*+":
            self.at += 1
            return ("repeat", node, int(sign == "+"), 1 if sign == "?" else None)
        if sign == "{":
            end = self.text.index("}", self.at)
            low, comma, high = self.text[self.at + 1 : end].partition(",")
            self.at = end + 1
            return ("repeat", node, int(low), int(high) if high else None if comma else int(low))
        return node

    def atom(self):
        sign = self.peek()
        if sign == "(":
            self.at += 1
            node = self.either()
            self.at += 1
            return node
        if sign == "[":
            return ("set", self.members())
        return ("set", self.cased(frozenset([self.byte()])))

    def byte(self) -> int:
        sign = self.text[self.at]
        self.at += 1
        if sign == "\\":
            sign = self.text[self.at]
            self.at += 1
            if sign == "x":
                self.at += 2
                return int(self.text[self.at - 2 : self.at], 16)
        return ord(sign)

    def members(self) -> frozenset[int]:
        self.at += 1
        found: set[int] = set()
        while self.peek() != "]":
            low = self.byte()
            high = low
            if self.peek() == "-" and self.text[self.at + 1] != "]":
                self.at += 1
                high = self.byte()
            found.update(range(low, high + 1))
        self.at += 1
        return self.cased(frozenset(found))

    def cased(self, found: frozenset[int]) -> frozenset[int]:
        if not self.fold:
            return found
        return found | {b ^ 32 for b in found if 65 <= b & ~32 <= 90}


class _Nfa:
    def __init__(self):
        self.free: list[list[int]] = []
        self.steps: list[list[tuple[frozenset[int], int]]] = []

    def state(self) -> int:
        self.free.append([])
        self.steps.append([])
        return len(self.free) - 1

    def add(self, node, start: int, reverse: bool) -> int:
        """Adds a node behind ``start`` and returns the state after it."""
        kind = node[0]
        if kind == "set":
            end = self.state()
            self.steps[start].append((node[1], end))
            return end
        if kind == "then":
            for part in reversed(node[1]) if reverse else node[1]:
                start = self.add(part, start, reverse)
            return start
        if kind == "or":
            end = self.state()
            for option in node[1]:
                begin = self.state()
                self.free[start].append(begin)
                self.free[self.add(option, begin, reverse)].append(end)
            return end
        _, inner, least, most = node
        for _ in range(least):
            start = self.add(inner, start, reverse)
        if most is None:
            loop = self.state()
            self.free[start].append(loop)
            self.free[self.add(inner, loop, reverse)].append(loop)
            return loop
        ends = [start]
        for _ in range(most - least):
            start = self.add(inner, start, reverse)
            ends.append(start)
        end = self.state()
        for one in ends:
            self.free[one].append(end)
        return end

    def closure(self, states: set[int]) -> frozenset[int]:
        pending = list(states)
        while pending:
            for other in self.free[pending.pop()]:
                if other not in states:
                    states.add(other)
                    pending.append(other)
        return frozenset(states)


class Automaton:
    """Minimal deterministic automaton of some rules.

    ``classes`` maps a byte to its class, ``steps`` holds ``state * width + class`` -> the next
    state's row, already multiplied by ``width``.  States that accept come last, from ``accepting``
    on; ``masks`` says which rules accept there.  ``start`` is the first row, ``dead`` the row from
    which nothing is accepted any more (-1: none).
    """

    def __init__(self, rules: tuple[Rule, ...], search: bool, reverse: bool = False):
        nfa = _Nfa()
        begin = nfa.state()
        final: dict[int, int] = {}
        for i, rule in enumerate(rules):
            first = nfa.state()
            nfa.free[begin].append(first)
            final[nfa.add(_Parser(rule.pattern, rule.fold).parse(), first, reverse)] = 1 << i
        signs: dict[tuple, int] = {}
        sets = sorted({s for steps in nfa.steps for s, _ in steps}, key=sorted)
        classes = [signs.setdefault(tuple(b in s for s in sets), len(signs)) for b in range(256)]
        self.classes, width = bytes(classes), len(signs)
        sample = [classes.index(c) for c in range(width)]
        root = nfa.closure({begin})
        known, order, rows = {root: 0}, [root], []
        for states in order:
            row = []
            for byte in sample:
                moved = {end for s in states for chars, end in nfa.steps[s] if byte in chars}
                if search:
                    moved.add(begin)
                target = nfa.closure(moved)
                if target not in known:
                    known[target] = len(order)
                    order.append(target)
                row.append(known[target])
            rows.append(row)
        accept = [sum({final[s] for s in states if s in final}) for states in order]
        part = self._refined(rows, accept)
        members: dict[int, int] = {}
        for state, block in enumerate(part):
            members.setdefault(block, state)
        blocks = sorted(members, key=lambda block: (accept[members[block]] > 0, members[block]))
        place = {block: i for i, block in enumerate(blocks)}
        self.steps = [place[part[t]] * width for block in blocks for t in rows[members[block]]]
        self.masks = [accept[members[block]] for block in blocks]
        self.width = width
        self.n_states = len(blocks)
        self.start = place[part[0]] * width
        self.accepting = next((i for i, m in enumerate(self.masks) if m), len(blocks)) * width
        self.dead = next(
            (i * width for i in range(len(blocks))
             if not self.masks[i] and set(self.steps[i * width : (i + 1) * width]) == {i * width}), -1)

    @staticmethod
    def _refined(rows: list[list[int]], accept: list[int]) -> list[int]:
        """The block of each state in the coarsest partition that the transitions respect."""
        part, count = accept, 0
        while True:
            names: dict[tuple, int] = {}
            part = [names.setdefault((part[s], *[part[t] for t in row]), len(names)) for s, row in enumerate(rows)]
            if len(names) == count:
                return part
            count = len(names)

    def last_end(self, coded: bytes, start: int) -> int | None:
        """The end of the longest match that begins at ``start``."""
        steps, accepting, dead, row, found = self.steps, self.accepting, self.dead, self.start, None
        for offset in range(start, len(coded)):
            row = steps[row + coded[offset]]
            if row >= accepting:
                found = offset + 1
            elif row == dead:
                break
        return found

    def first_start(self, coded: bytes, end: int, least: int) -> int | None:
        """For a reversed automaton: the start, at ``least`` or behind, of the longest match that ends at ``end``."""
        steps, accepting, dead, row, found = self.steps, self.accepting, self.dead, self.start, None
        for offset in range(end - 1, least - 1, -1):
            row = steps[row + coded[offset]]
            if row >= accepting:
                found = offset
            elif row == dead:
                break
        return found


@lru_cache(maxsize=8)
def compiled(rules: tuple[Rule, ...]) -> tuple[Automaton, list[tuple[Automaton, Automaton]]]:
    """The searching automaton of all rules; per rule its anchored and its reversed automaton."""
    single = [(Automaton((rule,), False), Automaton((rule,), False, reverse=True)) for rule in rules]
    return Automaton(rules, True), single


# --- scanning -----------------------------------------------------------------------------------

_SEPARATOR = re.compile(rb"""[:=]\x20*["']?""")


def _holds(rule: Rule, span: bytes) -> bool:
    if len(span) < rule.least or not rule.tail:
        return len(span) >= rule.least
    separator = _SEPARATOR.search(span)
    return separator is not None and len(span) - separator.end() >= rule.tail


def byte_spans(data: bytes, rules: tuple[Rule, ...] = RULES) -> list[tuple[int, int, int]]:
    """(start, end, rule number) in bytes, ordered by start and then by rule."""
    searching, single = compiled(rules)
    steps, row, accepting = searching.steps, searching.start, searching.accepting
    ends, states = array("q"), array("i")
    at = 0
    for code in data.translate(searching.classes):
        row = steps[row + code]
        at += 1
        if row >= accepting:
            ends.append(at)
            states.append(row)
    if not ends:
        return []
    spans = []
    masks = np.array(searching.masks, dtype=np.int64)[np.frombuffer(states, np.int32) // searching.width]
    all_ends = np.frombuffer(ends, np.int64)
    for number, rule in enumerate(rules):
        hits = all_ends[masks & (1 << number) != 0]
        if not len(hits):
            continue
        forward, backward = single[number]
        onward, back = data.translate(forward.classes), data.translate(backward.classes)
        done = place = 0
        while place < len(hits):
            start = backward.first_start(back, int(hits[place]), done)
            place += 1
            if start is None:
                continue
            done = forward.last_end(onward, start)
            if _holds(rule, data[start:done]):
                spans.append((start, done, number))
            place = max(place, int(np.searchsorted(hits, done, side="right")))
    return sorted(spans, key=lambda span: (span[0], span[2]))


def spans_of(text: str | None, rules: tuple[Rule, ...] = RULES) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, end exclusive, by start and then in the rules' order."""
    data = (text or "").encode("utf-8", "surrogatepass")
    found = byte_spans(data, rules)
    if found and len(data) != len(text):
        points, at, count = {}, 0, 0
        for offset in sorted({o for start, end, _ in found for o in (start, end)}):
            count += len(data[at:offset].decode("utf-8", "surrogatepass"))
            at = offset
            points[offset] = count
        return [(rules[n].kind, points[start], points[end]) for start, end, n in found]
    return [(rules[n].kind, start, end) for start, end, n in found]


def written(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def redacted(text: str | None, rules: tuple[Rule, ...] = RULES, mask: str = MASK) -> str | None:
    """The text with every run of overlapping spans replaced by the mask."""
    spans = spans_of(text, rules)
    if not spans:
        return text
    out, at = [], 0
    begin, end = spans[0][1:]
    for _, start, stop in [*spans[1:], ("", len(text) + 1, 0)]:
        if start < end:
            end = max(end, stop)
            continue
        out += [text[at:begin], mask]
        at, begin, end = end, start, stop
    return "".join([*out, text[at:]])


def _map_text(function: Callable[[pd.DataFrame], pd.DataFrame]):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield function(frame)

    return run


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Per document: doc_id, spans by base kind (n_*), base_sha256, spans, n_spans."""

    def rows(frame: pd.DataFrame) -> pd.DataFrame:
        out = []
        for doc_id, text in zip(frame["doc_id"], frame["text"]):
            spans = spans_of(text, rules)
            base = [span for span in spans if span[0] in BASE_KINDS]
            counts = [sum(span[0] == kind for span in base) for kind in BASE_KINDS]
            out.append((doc_id, *counts, hashlib.sha256(written(base).encode()).hexdigest(), written(spans), len(spans)))
        return pd.DataFrame(out, columns=["doc_id", *[f"n_{k}" for k in BASE_KINDS], "base_sha256", "spans", "n_spans"]).astype(
            {"doc_id": "Int64"})

    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_spans long"
    return in_pandas(docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text"), _map_text(rows), schema)


def _cleaned(texts: Iterator[pa.Array], rules: tuple[Rule, ...], mask: str, rows: int = TEXT_ROWS) -> Iterator[pa.Array]:
    """The redacted texts in pieces of at most ``rows``; a piece without secrets is passed on as it came."""
    for batch in texts:
        for at in range(0, len(batch), rows):
            piece = batch.slice(at, rows)
            before = piece.to_pylist()
            after = [redacted(text, rules, mask) for text in before]
            yield piece if after == before else pa.array(after, piece.type)


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mask: str = MASK) -> DataFrame:
    """The documents, with the same columns, and every secret in ``text`` replaced by the mask.

    A worker holds one Arrow batch and the objects of one piece of it, the JVM gets piece by piece.
    """
    send_package(docs.sparkSession)

    @F.arrow_udf("string")
    def clean(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from _cleaned(texts, rules, mask)

    return docs.withColumn("text", clean("text"))
