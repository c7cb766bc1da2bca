"""Toxicity by a support vector machine with a gapped subsequence string kernel.

A labelled text is a bag of sentences and a sentence a bag of spans: its words without marks,
windows over very long words, and runs of single characters joined into one word.  Two spans are compared by the
three-character subsequences they share, where a subsequence counts less the more it is stretched;
so an insult with inserted or left-out characters stays close to its plain form.  Kernel values
against a few landmark spans give Nyström features, on which a linear machine with squared hinge
loss is trained.  As only texts are labelled, the spans that make a toxic text toxic are chosen in
rounds: the best two of each toxic text are positive, the spans of clean texts are negative.
Seeded misspellings of the positive spans (one character put in, left out or replaced) are positive
too.  A text's score is a logistic function of its best
three spans, where a repeated span counts as often as it occurs.

As the kernel is a product of explicit feature vectors, landmarks and weights fold into one weight
per subsequence; scoring a span is then a sum over its subsequences divided by its norm, with the
same value.  That table is all the workers get.

The machine is fitted on a bounded, seeded sample of labelled texts (``MAX_TOXIC``, ``MAX_CLEAN``,
none longer than ``MAX_TRAIN_CHARS``).  Every text is scored whole.

Defined cases: null and blank texts have no spans and get the score of a text whose best spans are
neutral; without labels of both kinds every score is 0; rows with one doc_id are scored each; other
columns are never read.
"""

from __future__ import annotations

import re
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import in_pandas

MAX_TOXIC = 1500
MAX_CLEAN = 3000
MAX_TRAIN_CHARS = 20_000
LANDMARKS = 240
FREQUENT_NEGATIVES = 20_000
OTHER_NEGATIVES = 10_000
AT_ONCE = 4000
ROUNDS = 3
MISSPELLINGS = 6
DECAY = 0.6
STRETCH = 5
CLASSES = 128
WINDOW = 24
CACHE = 400_000
DOCS_AT_ONCE = 500
FLAGGED = 0.7
BEST = 3

_MARKS = str.maketrans("", "", ".,;:!?\"'()[]{}<>*#$%&|-_/\\…«»„“”+=~^@")
_SPELLED = re.compile(r"(?<!\S)(?:\S[ \t]+){2,}\S(?=[.,;:!?\"')]*(?:\s|$))")
_PAIRS = [(j, k) for k in range(2, STRETCH + 1) for j in range(1, k)]


def spans(text: str | None) -> Counter[str]:
    """The spans of all sentences of a text and how often each occurs."""
    lowered = (text or "").lower()
    found: Counter[str] = Counter()
    for word, count in Counter(lowered.split()).items():
        found[word.translate(_MARKS)] += count
    found.update("".join(run.split()).translate(_MARKS) for run in _SPELLED.findall(lowered))
    found.pop("", None)
    for word in [w for w in found if len(w) > WINDOW]:
        count = found.pop(word)
        for i in range(0, len(word) - WINDOW // 2, WINDOW // 2):
            found[word[i : i + WINDOW]] += count
    return found


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Parallel arrays (word, subsequence code, weight), one entry per pair, ordered by word.

    Characters fall into ``CLASSES`` classes; a word is framed by a mark at either end.
    """
    marked = [f"\x1e{word}\x1f" for word in words]
    lengths = np.array([len(m) for m in marked])
    points = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    classes = np.where(points < 128, np.where(points >= 32, points - 32, 96 + points % 32), 96 + points % 30)
    owner = np.repeat(np.arange(len(words)), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(points))
    keys, weights = [], []
    for j, k in _PAIRS:
        at = np.flatnonzero(left > k)
        code = (classes[at] * CLASSES + classes[at + j]) * CLASSES + classes[at + k]
        keys.append(owner[at] * CLASSES**3 + code)
        weights.append(np.full(len(at), DECAY ** (k - 2)))
    key, where = np.unique(np.concatenate(keys), return_inverse=True)
    weight = np.bincount(where, np.concatenate(weights), len(key))
    return key // CLASSES**3, key % CLASSES**3, weight


def kernel_rows(words: list[str], others: np.ndarray) -> np.ndarray:
    """Normalised kernel of each word with landmarks given as a (codes x landmarks) table."""
    owner, code, weight = subsequences(words)
    norm = np.sqrt(np.bincount(owner, weight**2, len(words)))
    codes, table = others
    place = np.searchsorted(codes, code)
    place = np.minimum(place, len(codes) - 1)
    hit = codes[place] == code
    out = np.zeros((len(words), table.shape[1]))
    owner, place, weight = owner[hit], place[hit], weight[hit]
    for begin in range(0, len(owner), 20_000):
        part = slice(begin, begin + 20_000)
        starts = np.flatnonzero(np.concatenate(([True], owner[part][1:] != owner[part][:-1])))
        out[owner[part][starts]] += np.add.reduceat(table[place[part]] * weight[part, None], starts, axis=0)
    return out / norm[:, None]


def landmark_table(landmarks: list[str]) -> tuple[np.ndarray, np.ndarray]:
    owner, code, weight = subsequences(landmarks)
    norm = np.sqrt(np.bincount(owner, weight**2, len(landmarks)))
    codes, place = np.unique(code, return_inverse=True)
    table = np.zeros((len(codes), len(landmarks)))
    table[place, owner] = weight / norm[owner]
    return codes, table


def nystrom(words: list[str], table: tuple[np.ndarray, np.ndarray], root: np.ndarray) -> np.ndarray:
    """Nystrom features of the words, some at a time."""
    parts = [kernel_rows(words[i : i + AT_ONCE], table) @ root for i in range(0, len(words), AT_ONCE)]
    return np.concatenate(parts) if parts else np.empty((0, root.shape[1]))


def squared_hinge(features: np.ndarray, sign: np.ndarray, weight: np.ndarray, ridge: float = 1e-4) -> np.ndarray:
    """Weights of the linear machine (the last one is the offset), by Newton steps."""
    x = np.column_stack((features, np.ones(len(features))))
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-8
    for _ in range(25):
        margin = 1 - sign * (x @ w)
        active = margin > 0
        a = x[active] * weight[active, None]
        gradient = penalty * w - a.T @ (sign[active] * margin[active])
        step = np.linalg.solve(a.T @ x[active] + np.diag(penalty), gradient)
        w -= step
        if np.abs(step).max() < 1e-7:
            break
    return w


@dataclass
class Model:
    """Weight of each subsequence, the machine's offset and the logistic function of a text's best
    spans.  ``neutral`` stands in for the spans that a text does not have."""

    codes: np.ndarray
    weights: np.ndarray
    offset: float
    neutral: float
    scale: np.ndarray

    def table(self) -> np.ndarray:
        table = np.zeros(CLASSES**3, dtype=np.float32)
        table[self.codes] = self.weights
        return table

    def of_text(self, best: list[float]) -> float:
        value = self.scale[0] + float(self.scale[1:] @ best)
        return float(1 / (1 + np.exp(-np.clip(value, -60, 60))))


def span_scores(words: list[str], table: np.ndarray, offset: float) -> np.ndarray:
    out = np.empty(len(words))
    for begin in range(0, len(words), AT_ONCE):
        part = words[begin : begin + AT_ONCE]
        owner, code, weight = subsequences(part)
        norm = np.sqrt(np.bincount(owner, weight**2, len(part)))
        out[begin : begin + len(part)] = np.bincount(owner, table[code] * weight, len(part)) / norm + offset
    return out


def best_spans(bag: dict[str, int], values: dict[str, float], neutral: float) -> list[float]:
    """The ``BEST`` largest values of a bag's spans, clipped, each as often as the span occurs."""
    top: list[float] = []
    for word in sorted(bag, key=lambda w: -values[w])[:BEST]:
        top += [values[word]] * bag[word]
    return np.clip((top + [neutral] * BEST)[:BEST], -1.0, 2.0).tolist()


def misspelled(word: str, rng: np.random.Generator) -> str:
    """The word with one inner character put in, left out or replaced."""
    at, kind = int(rng.integers(1, max(2, len(word) - 1))), int(rng.integers(3))
    other = "*.-_0134xqz"[int(rng.integers(11))]
    return word[:at] + (other if kind != 1 else "") + word[at + (kind > 0) :]


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.3) -> np.ndarray:
    x = np.column_stack((np.ones(len(x)), x))
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = x.T @ (x * (p * (1 - p))[:, None]) + ridge * np.eye(len(w))
        w += np.linalg.solve(curve, x.T @ (y - p) - ridge * w)
    return w


def train(texts: list[str], toxic: list[int], seed: int = 3) -> Model | None:
    """Fit on labelled texts; None without texts of both kinds."""
    rng = np.random.default_rng(seed)
    bags = [{sys.intern(w): n for w, n in spans(text).items()} for text in texts]
    is_toxic = np.array(toxic) == 1
    bad, good = int(is_toxic.sum()), int((~is_toxic).sum())
    if not bad or not good:
        return None
    inside: dict[bool, Counter] = {True: Counter(), False: Counter()}
    for bag, flag in zip(bags, is_toxic.tolist()):
        inside[flag].update(bag)
    expected = {w: (n + inside[False][w]) * bad / (bad + good) for w, n in inside[True].items()}
    score = {w: (n - expected[w]) / np.sqrt(expected[w]) for w, n in inside[True].items()}
    clean = sorted(inside[False])
    frequent = sorted(clean, key=lambda w: (-inside[False][w], w))
    others = frequent[FREQUENT_NEGATIVES:]
    picked = rng.permutation(len(others))[:OTHER_NEGATIVES].tolist()
    negatives = sorted(frequent[:FREQUENT_NEGATIVES] + [others[i] for i in picked])
    toxic_bags = [sorted(bag) for bag, flag in zip(bags, is_toxic.tolist()) if flag and bag]
    words = sorted(inside[True])
    ranked = sorted(words, key=lambda w: (-score[w], w))
    half = LANDMARKS // 2
    rest = [w for w in negatives if w not in set(ranked[:half])]
    landmarks = ranked[:half] + [rest[i] for i in rng.permutation(len(rest))[: LANDMARKS - half].tolist()]
    table = landmark_table(landmarks)
    gram = kernel_rows(landmarks, table)
    values, vectors = np.linalg.eigh((gram + gram.T) / 2)
    keep = values > 1e-6 * values.max()
    root = vectors[:, keep] / np.sqrt(values[keep])
    below = nystrom(negatives, table, root)
    often = np.sqrt([inside[False][w] for w in negatives])
    for _ in range(ROUNDS):
        chosen = Counter()
        for bag in toxic_bags:
            chosen.update(sorted(bag, key=lambda w: (-score[w], w))[:2])
        chosen = Counter({w: n for w, n in chosen.items() if inside[False][w] * bad <= inside[True][w] * good})
        picked = sorted(chosen)
        plain = np.array([chosen[w] for w in picked]) / sum(chosen.values())
        noisy = [misspelled(w, rng) for w in picked for _ in range(MISSPELLINGS) if len(w) > 3]
        above = nystrom(picked + noisy, table, root)
        weight = np.concatenate((
            plain,
            np.repeat(plain[[len(w) > 3 for w in picked]], MISSPELLINGS) / MISSPELLINGS,
            4 * often / often.sum(),
        ))
        sign = np.concatenate((np.ones(len(above)), -np.ones(len(negatives))))
        machine = squared_hinge(np.vstack((above, below)), sign, weight)
        folded = (table[1] @ (root @ machine[:-1])).astype(np.float32)
        model = Model(table[0], folded, float(machine[-1]), float(machine[-1]), np.zeros(BEST + 1))
        score = dict(zip(words, span_scores(words, model.table(), model.offset).tolist()))
    every = {**dict(zip(clean, span_scores(clean, model.table(), model.offset).tolist())), **score}
    best = np.array([best_spans(bag, every, model.neutral) for bag in bags])
    model.scale = _logistic(best, is_toxic.astype(float))
    return model


def training_sample(docs: DataFrame, labels: DataFrame, usable: Column, toxic: int = MAX_TOXIC, clean: int = MAX_CLEAN) -> DataFrame:
    """(text, toxic) of the bounded sample: the first labels of each kind in seeded order."""
    known = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").filter(usable).select("doc_id", "toxic").distinct()
    order = [F.xxhash64("doc_id", F.lit(1)), "doc_id"]
    chosen = known.filter("toxic = 1").orderBy(*order).limit(toxic).union(known.filter("toxic = 0").orderBy(*order).limit(clean))
    # At most ``toxic`` + ``clean`` pairs of numbers, whatever the input.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return rows.filter(f"length(text) BETWEEN 1 AND {MAX_TRAIN_CHARS}").select("doc_id", "text", "toxic")


def scored(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id and score of every row."""
    narrow = docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text")
    if model is None:
        return narrow.select("doc_id", F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fitted = shared.value
        table, known = fitted.table(), {}
        for frame in frames:
            out: list[float] = []
            for begin in range(0, len(frame), DOCS_AT_ONCE):
                bags = [spans(text) for text in frame["text"].iloc[begin : begin + DOCS_AT_ONCE]]
                if len(known) > CACHE:
                    known.clear()
                new = list(set().union(*bags).difference(known))
                known.update(zip(new, span_scores(new, table, fitted.offset).tolist()))
                out += [fitted.of_text(best_spans(bag, known, fitted.neutral)) for bag in bags]
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "score": out})

    return in_pandas(narrow, score, "doc_id long, score double")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted; labels of held-out rows are never read."""
    sample = training_sample(docs, labels, ~held_out(F.col("doc_id"))).collect()
    rows = sorted((r.doc_id, r.text, r.toxic) for r in sample)
    model = train([text for _, text, _ in rows], [flag for _, _, flag in rows])
    return scored(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= FLAGGED).cast("int").alias("predicted")
    )
