"""Ranked lexical search without random access (NRA) over impact-sorted lists.

Texts are tokenised once; only the terms that some item asks for are stored, with their counts, as
one narrow row per document.  Corpus statistics (documents, terms, document frequencies) come from
that table.  Documents are then taken in blocks where they lie, without a shuffle: a block holds an
impact-sorted list per term and answers every item with the ``k`` best of its documents; each task
merges its blocks, and the lists of the tasks are merged by a window.

*One item in one block.*  Lists are only read from the front.  A document's lower bound is the sum
of the impacts read for it, its upper bound adds, for each list in which it has not been met, the
impact at which that list stands.  While a document not met at all could still enter, the lists
whose next stretch lowers that bound most for its length are read on.  Then no new documents are
admitted, those whose upper bound lies below the ``k``-th lower bound go, and a list is read on
only while some remaining document has not been met in it, until every remaining document's bounds
meet.  Membership, ties and scores are then exact.  The ``k``-th score of a task's earlier blocks
bounds the later ones.

Items are the query set: they are taken in blocks of ``item_block`` rows, whose terms are sent to
the tasks.

Defined cases: null texts have no terms; every row is a document or an item of its own, equal ids
and equal rows included; null doc_ids are ordinary documents that come last among ties; an item
without terms, or without a document that scores above 0, has no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from faultline.llm.common import in_pandas, stored

K = 10
DOC_BLOCK = 16384
ITEM_BLOCK = 2000
# The first stretch read from a list, and how much of the bound a round takes off.
STRETCH = 64
ROUND_SHARE = 0.8

# The constants of the score.
IMPACT_SCALE, TF_SCALE, M_SCALE = 1_000_000_000, 1000, 8
M_BASE, M_SLOPE = 25, 75
LARGEST = 2**63 - 1

# Bytes 00-2F, 3A-40, 5B-60 and 7B-7F separate terms, A to Z become a to z; all others stay.
_DIGITS, _UPPER, _LOWER = range(0x30, 0x3A), range(0x41, 0x5B), range(0x61, 0x7B)
TERM_BYTES = bytes(
    b + 32 if b in _UPPER else b if b >= 0x80 or b in _DIGITS or b in _LOWER else 0x20 for b in range(256)
)


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(TERM_BYTES).split()


def _doc_rows(frames: Iterator[pd.DataFrame], vocabulary: dict[bytes, int]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        sizes, terms, counts = [], [], []
        for text in frame["text"]:
            words = terms_of(text)
            found = Counter(filter(None.__ne__, map(vocabulary.get, words)))
            sizes.append(len(words))
            terms.append(np.fromiter(found.keys(), "<i4", len(found)).tobytes())
            counts.append(np.fromiter(found.values(), "<i4", len(found)).tobytes())
        yield pd.DataFrame(
            {"doc": frame["doc"], "has_id": frame["has_id"], "n": sizes, "terms": terms, "counts": counts}
        )


def _frequencies(frames: Iterator[pd.DataFrame], size: int) -> Iterator[pd.DataFrame]:
    """Document frequencies by term, one row for a task's documents."""
    total, docs, length = np.zeros(size, np.int64), 0, 0
    for frame in frames:
        joined = np.frombuffer(b"".join(frame["terms"]), "<i4")
        total += np.bincount(joined, minlength=size)
        docs += int((frame["n"] > 0).sum())
        length += int(frame["n"].sum())
    met = np.flatnonzero(total)
    yield pd.DataFrame({"term": np.append(met, -1), "df": np.append(total[met], docs), "length": np.append(0 * met, length)})


def weight(docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def impacts(n: np.ndarray, tf: np.ndarray, docs: int, length: int) -> np.ndarray:
    """The integer impact of counts ``tf`` in documents of ``n`` terms."""
    limit = LARGEST // (M_SLOPE * docs)
    if n.size and int(n.max()) > limit:
        # Products beyond 64 bits are taken as whole numbers of any length.
        m = np.array([M_BASE + (M_SLOPE * int(x) * docs) // length for x in n], dtype=np.int64)
    else:
        m = M_BASE + (M_SLOPE * n * docs) // length
    return (IMPACT_SCALE * tf) // (TF_SCALE * tf + M_SCALE * m)


class ImpactLists:
    """Per term the documents of one block, largest impact first."""

    def __init__(self, rows: np.ndarray, terms: np.ndarray, impact: np.ndarray, size: int):
        order = np.lexsort((rows, -impact, terms))
        self.rows, self.impact = rows[order], impact[order]
        self.start = np.searchsorted(terms[order], np.arange(size + 1))

    def of(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        part = slice(self.start[term], self.start[term + 1])
        return self.rows[part], self.impact[part]


class _Reader:
    """The lists of one item, read from the front; ``reads`` counts the entries read."""

    def __init__(self, lists: ImpactLists, weights: list[tuple[int, int]]):
        found = [(w, *lists.of(term)) for term, w in weights]
        self.lists = [(w, rows, impact) for w, rows, impact in found if w > 0 and len(rows)]
        self.at = [0] * len(self.lists)
        self.reads = 0

    def bound(self, i: int, at: int | None = None) -> int:
        """What list ``i`` can still add to a document not met in it."""
        w, _, impact = self.lists[i]
        place = self.at[i] if at is None else at
        return w * int(impact[place]) if place < len(impact) else 0

    def stretch(self, i: int) -> int:
        return min(len(self.lists[i][1]), max(self.at[i] * 2, self.at[i] + STRETCH))

    def worth(self, i: int) -> float:
        """How much the next stretch, or the whole rest, lowers the bound per entry."""
        rest = len(self.lists[i][1]) - self.at[i]
        if not rest:
            return -1.0
        now, upto = self.bound(i), self.stretch(i)
        return max((now - self.bound(i, upto)) / (upto - self.at[i]), now / rest)

    def upto(self, i: int) -> int:
        """The end of the better of the next stretch and the whole rest."""
        size, upto, now = len(self.lists[i][1]), self.stretch(i), self.bound(i)
        whole = now / (size - self.at[i]) >= (now - self.bound(i, upto)) / (upto - self.at[i])
        return size if whole else upto

    def read(self, i: int, upto: int) -> tuple[np.ndarray, np.ndarray]:
        w, rows, impact = self.lists[i]
        part = slice(self.at[i], upto)
        self.reads += upto - self.at[i]
        self.at[i] = upto
        return rows[part], w * impact[part]


def _kth(scores: np.ndarray, k: int) -> int:
    """The k-th largest of ``scores``, 0 if there are fewer above 0."""
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


def best_of_block(
    lists: ImpactLists, n_rows: int, weights: list[tuple[int, int]], k: int, floor: int
) -> tuple[np.ndarray, np.ndarray, int]:
    """Rows and exact scores of all documents that may be among the ``k`` best and score at least
    ``floor``, and the number of entries read.  ``weights`` holds (term, weight times repeats)."""
    reader = _Reader(lists, weights)
    number = range(len(reader.lists))
    lower = np.zeros(n_rows, np.int64)
    threshold = floor
    unseen = sum(map(reader.bound, number))
    worth = list(map(reader.worth, number))
    while unseen and unseen >= threshold:
        goal = max(int(unseen * ROUND_SHARE), threshold - 1)
        while unseen > goal:
            best = worth.index(max(worth))
            before = reader.bound(best)
            rows, gains = reader.read(best, reader.upto(best))
            lower[rows] += gains
            unseen += reader.bound(best) - before
            worth[best] = reader.worth(best)
        threshold = max(floor, _kth(lower, k))
    # No new documents from here on: close the bounds of those that may still belong.
    alive = np.flatnonzero((lower > 0) & (lower + unseen >= threshold))
    index = np.full(n_rows, -1)
    index[alive] = np.arange(len(alive))
    met = np.zeros((len(reader.lists), len(alive)), bool)
    for i in number:
        places = index[reader.lists[i][1][: reader.at[i]]]
        met[i, places[places >= 0]] = True
    scores = lower[alive]
    while len(alive):
        bounds = np.array([reader.bound(i) for i in number], dtype=np.int64)
        upper = scores + (bounds[:, None] * ~met).sum(0)
        threshold = max(threshold, _kth(scores, k))
        stays = upper >= threshold
        if not stays.all():
            alive, scores, met = alive[stays], scores[stays], met[:, stays]
            index[:] = -1
            index[alive] = np.arange(len(alive))
        waiting = [i for i in number if bounds[i] and not met[i].all()]
        if not waiting:
            break
        for i in sorted(waiting, key=lambda i: -bounds[i])[: max(1, len(waiting) // 2)]:
            rows, gains = reader.read(i, reader.stretch(i))
            places = index[rows]
            inside = places >= 0
            scores[places[inside]] += gains[inside]
            met[i, places[inside]] = True
    return alive, scores, reader.reads


def _cut(best: pd.DataFrame, k: int) -> pd.DataFrame:
    ordered = best.sort_values(["item", "score", "has_id", "doc"], ascending=[True, False, False, True])
    return ordered.groupby("item", sort=False).head(k)


def _search(
    frames: Iterator[pd.DataFrame], items: list[list[tuple[int, int]]], size: int, docs: int, length: int, k: int, block: int
) -> Iterator[pd.DataFrame]:
    held: list[pd.DataFrame] = []
    best = pd.DataFrame({"item": [], "has_id": [], "doc": [], "score": []}).astype({"has_id": bool})

    def answered(best: pd.DataFrame, part: pd.DataFrame) -> pd.DataFrame:
        lengths = np.fromiter(map(len, part["terms"]), np.int64, len(part)) // 4
        rows = np.repeat(np.arange(len(part)), lengths)
        terms = np.frombuffer(b"".join(part["terms"]), "<i4").astype(np.int64)
        tf = np.frombuffer(b"".join(part["counts"]), "<i4").astype(np.int64)
        lists = ImpactLists(rows, terms, impacts(part["n"].to_numpy(np.int64)[rows], tf, docs, length), size)
        ids, has_id = part["doc"].to_numpy(np.int64), part["has_id"].to_numpy(bool)
        full = best.groupby("item")["score"].agg(["size", "min"])
        floors = {int(i): int(low) for i, n, low in full.itertuples() if n >= k}
        found = [best]
        for item, weights in enumerate(items):
            at, scores, _ = best_of_block(lists, len(part), weights, k, floors.get(item, 0))
            if len(at):
                top = np.lexsort((ids[at], ~has_id[at], -scores))[:k]
                found.append(
                    pd.DataFrame({"item": item, "has_id": has_id[at[top]], "doc": ids[at[top]], "score": scores[top]})
                )
        return _cut(pd.concat([f for f in found if len(f)], ignore_index=True), k) if any(map(len, found)) else best

    waiting = 0
    for frame in frames:
        held.append(frame)
        waiting += len(frame)
        while waiting >= block:
            rows = pd.concat(held, ignore_index=True)
            best = answered(best, rows.iloc[:block])
            held, waiting = [rows.iloc[block:]], waiting - block
    if waiting:
        best = answered(best, pd.concat(held, ignore_index=True))
    yield best.astype({"item": "int64", "doc": "int64", "score": "int64"})


def _item_blocks(items: DataFrame, size: int) -> Iterator[list[tuple[int | None, Counter]]]:
    held: list[tuple[int | None, Counter]] = []
    for row in items.select(F.col("item_id").cast("long").alias("item_id"), "text").toLocalIterator():
        held.append((row.item_id, Counter(terms_of(row.text))))
        if len(held) == size:
            yield held
            held = []
    if held:
        yield held


def _search_items(
    docs: DataFrame, items: list[tuple[int | None, Counter]], k: int, block: int
) -> DataFrame:
    spark = docs.sparkSession
    vocabulary = {term: i for i, term in enumerate(sorted(set().union(*(wanted for _, wanted in items))))}
    size = len(vocabulary)
    doc_id = F.col("doc_id").cast("long")
    texts = docs.select(F.coalesce(doc_id, F.lit(0)).alias("doc"), doc_id.isNotNull().alias("has_id"), "text")
    rows = stored(
        in_pandas(
            texts, lambda frames: _doc_rows(frames, vocabulary),
            "doc long, has_id boolean, n long, terms binary, counts binary",
        ),
        "terms",
    )
    counted = in_pandas(rows.select("n", "terms"), lambda frames: _frequencies(frames, size), "term int, df long, length long")
    totals = {r.term: (r.df, r.length) for r in counted.groupBy("term").agg(F.sum("df").alias("df"), F.sum("length").alias("length")).collect()}
    n_docs, length = totals.get(-1, (0, 0))
    weights = {term: weight(n_docs, df) for term, (df, _) in totals.items() if term >= 0}
    asked = [
        [(vocabulary[t], weights[vocabulary[t]] * repeats) for t, repeats in wanted.items() if vocabulary[t] in weights]
        for _, wanted in items
    ]
    matching = rows.filter("length(terms) > 0")
    best = in_pandas(
        matching, lambda frames: _search(frames, asked, size, n_docs, length, k, block),
        "item long, has_id boolean, doc long, score long",
    )
    names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(items)], "item long, item_id long")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.desc("has_id"), "doc")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.join(F.broadcast(names), "item").select(
        "item_id", "rank", F.when(F.col("has_id"), F.col("doc")).alias("doc_id"), "score"
    )


def ranked(
    docs: DataFrame, items: DataFrame, k: int = K, item_block: int = ITEM_BLOCK, doc_block: int = DOC_BLOCK
) -> DataFrame:
    """Per row of ``items`` and rank: item_id, rank (from 1), doc_id, score."""
    found = [_search_items(docs, part, k, doc_block) for part in _item_blocks(items, item_block)]
    if not found:
        return empty_result(docs.sparkSession)
    return reduce(DataFrame.union, found)


def empty_result(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
