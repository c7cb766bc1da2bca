"""Product codes of integer vectors by tries over their distinct parts.

Vectors become whole numbers, floor(1024 x), and are cut into equal parts; each part position has a
codebook trained by Lloyd rounds.  Distinct parts are counted once, range-partitioned by position
and part and written, so each task holds a run of parts in lexicographic order: the leaves of a
trie whose inner nodes are common beginnings.  A walk goes down the trie depth first and carries,
per node, the distances of the beginning to all entries; children add one component to them.
Subtrees below ``LEAVES`` leaves are walked level by level in arrays, so memory is bounded by
``LEAVES`` times the entries.  Leaves take the nearest entry, ties to the lower index, and add their
count and their count times part to its sums.  Only sums per entry are shuffled; the codebooks, of
a size fixed by entries and dimensions, go through the driver.  Codes are assigned by tries over
each batch's distinct parts, without a shuffle.

Defined cases: vectors that are null, empty or hold null or non-finite components take no part, nor
do vectors whose length differs from that of the vector with the smallest vec_id or cannot be cut
equally; components beyond +-2**26 after scaling count as that bound, which keeps all sums within 64
bits; null vec_ids come last in the order; equal rows stay separate rows; fewer vectors than entries
give smaller codebooks; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from faultline.llm.common import in_pandas, send_package, stored

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
COMPONENT_BOUND = 2**26
LEAVES = 1024
# Label sums up to this many rows are sent to all tasks; more are joined by a salted shuffle.
LABELS_SENT = 10_000
SALTS = 16


def _shared_beginnings(parts: np.ndarray) -> np.ndarray:
    """Per row of sorted distinct parts, how many components it shares with the row before."""
    differ = parts[1:] != parts[:-1]
    return np.concatenate(([0], differ.argmax(1))) if len(parts) else np.empty(0, np.int64)


def nearest_entries(parts: np.ndarray, entries: np.ndarray, leaves: int = LEAVES) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry and squared distance of each of the sorted distinct ``parts``."""
    index, distance = np.empty(len(parts), np.int64), np.empty(len(parts), np.int64)
    width = parts.shape[1]
    shared = _shared_beginnings(parts)
    pending = [(0, len(parts), 0, np.zeros(len(entries), np.int64))] if len(parts) else []
    while pending:
        low, high, depth, sums = pending.pop()
        if high - low <= leaves or depth == width:
            sums = _below(parts, shared, entries, low, high, depth, sums)
            index[low:high] = sums.argmin(1)
            distance[low:high] = sums[np.arange(high - low), index[low:high]]
            continue
        starts = np.append(low, low + 1 + np.flatnonzero(shared[low + 1 : high] <= depth))
        ends = np.append(starts[1:], high)
        for start, end in zip(starts.tolist(), ends.tolist()):
            pending.append((start, end, depth + 1, sums + (parts[start, depth] - entries[:, depth]) ** 2))
    return index, distance


def _below(
    parts: np.ndarray, shared: np.ndarray, entries: np.ndarray, low: int, high: int, depth: int, sums: np.ndarray
) -> np.ndarray:
    """The distances of all leaves of one subtree, its nodes taken level by level."""
    nodes, sums = np.array([low]), sums[None, :]
    for level in range(depth, parts.shape[1]):
        starts = np.append(low, low + 1 + np.flatnonzero(shared[low + 1 : high] <= level))
        steps = parts[starts, level][:, None] - entries[:, level]
        sums = sums[np.searchsorted(nodes, starts, side="right") - 1] + steps * steps
        nodes = starts
    return sums


@dataclass(frozen=True)
class Codebooks:
    """Entries by part position, each an array of (entry, component)."""

    entries: list[np.ndarray]

    def digest(self) -> str:
        numbers = (str(x) for book in self.entries for x in book.ravel().tolist())
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def _usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(True))


def whole_vectors(vectors: DataFrame, parts: int = PARTS) -> DataFrame:
    """vec_id, label and the components as whole numbers (``whole``) of all vectors that take part."""
    bound = F.lit(float(COMPONENT_BOUND))
    whole = F.transform(
        "embedding", lambda x: F.floor(F.greatest(-bound, F.least(bound, x.cast("double") * SCALE))).cast("int")
    )
    rows = vectors.filter(_usable(F.col("embedding"))).select(F.col("vec_id").cast("long").alias("vec_id"), "label", whole.alias("whole"))
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "whole").select(F.size("whole").alias("size")).first()
    size = first.size if first and first.size % parts == 0 else 0
    return rows.filter((F.size("whole") == size) & F.lit(size > 0))


def _stacked(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(np.int64)


def _sums(frames: Iterator[pd.DataFrame], books: Codebooks) -> Iterator[pd.DataFrame]:
    """Counts and component sums of the entries over one task's distinct parts."""
    counts = [np.zeros(len(book), np.int64) for book in books.entries]
    sums = [np.zeros_like(book) for book in books.entries]
    for frame in frames:
        for position, rows in frame.groupby("position", sort=False):
            parts, rows_of = _stacked(rows["part"]), rows["rows"].to_numpy(np.int64)
            index, _ = nearest_entries(parts, books.entries[position])
            np.add.at(counts[position], index, rows_of)
            np.add.at(sums[position], index, parts * rows_of[:, None])
    for position, count in enumerate(counts):
        used = np.flatnonzero(count)
        totals = pd.Series(list(sums[position][used]), dtype=object)
        yield pd.DataFrame({"position": position, "entry": used, "rows": count[used], "sums": totals})


def distinct_parts(whole: DataFrame, parts: int = PARTS) -> DataFrame:
    """(position, part, rows) in lexicographic order within each task."""
    width = F.size("whole") / parts
    cut = F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda i: F.slice("whole", (i * width + 1).cast("int"), width.cast("int")))
    counted = whole.select(F.posexplode(cut).alias("position", "part")).groupBy("position", "part").agg(F.count(F.lit(1)).alias("rows"))
    return counted.repartitionByRange("position", "part").sortWithinPartitions("position", "part")


def train(whole: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks that start at the parts of the ``entries`` smallest vec_ids."""
    seeds = [row.whole for row in whole.orderBy(F.asc_nulls_last("vec_id"), "whole").limit(entries).collect()]
    if not seeds:
        return Codebooks([])
    books = Codebooks([np.ascontiguousarray(b) for b in np.split(np.array(seeds, np.int64), parts, axis=1)])
    counted = stored(distinct_parts(whole, parts), "parts")
    for _ in range(rounds):
        found = in_pandas(counted, lambda frames, books=books: _sums(frames, books), "position int, entry int, rows long, sums array<long>")
        total = (
            found.select("position", "entry", "rows", F.posexplode("sums").alias("place", "sum"))
            .groupBy("position", "entry", "place")
            .agg(F.sum("sum").alias("sum"), F.sum("rows").alias("rows"))
        )
        moved = [book.copy() for book in books.entries]
        for row in total.collect():
            moved[row.position][row.entry, row.place] = row.sum // row.rows
        books = Codebooks(moved)
    return books


def codes(whole: DataFrame, books: Codebooks) -> DataFrame:
    """vec_id, label, code and error of every row of ``whole``."""
    send_package(whole.sparkSession)

    @pandas_udf("code string, error long")
    def coded(column: pd.Series) -> pd.DataFrame:
        if not len(column):
            return pd.DataFrame({"code": pd.Series([], dtype=str), "error": pd.Series([], dtype="int64")})
        error = np.zeros(len(column), np.int64)
        digits = []
        for part, entries in zip(np.split(_stacked(column), len(books.entries), axis=1), books.entries):
            distinct, place = np.unique(part, axis=0, return_inverse=True)
            index, distance = nearest_entries(distinct, entries)
            place = place.reshape(-1)
            error += distance[place]
            digits.append(index[place])
        width = max(2, max(len(f"{len(e) - 1:x}") for e in books.entries))
        code = ["".join(f"{x:0{width}x}" for x in row) for row in zip(*(d.tolist() for d in digits))]
        return pd.DataFrame({"code": code, "error": error})

    return whole.withColumn("_coded", coded("whole")).select("vec_id", "label", "_coded.code", "_coded.error")


def with_label_error(coded: DataFrame) -> DataFrame:
    """``coded``, which should be stored, with the errors summed over equal labels, nulls together."""
    summed = coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    same = F.col("label").eqNullSafe(F.col("_label"))
    if coded.select("label").distinct().limit(LABELS_SENT + 1).count() <= LABELS_SENT:
        joined = coded.join(F.broadcast(summed), same)
    else:
        salted = summed.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        dealt = coded.withColumn("_at", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int"))
        joined = dealt.join(salted, same & (F.col("_at") == F.col("_salt")))
    return joined.select("vec_id", "label", "code", "error", "label_error")


def compressed(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> tuple[DataFrame, Codebooks]:
    """vec_id, label, code, error and label_error of all vectors that take part, and the codebooks."""
    whole = whole_vectors(vectors, parts)
    books = train(whole, parts, entries, rounds)
    if not books.entries:
        empty = whole.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return empty.limit(0).withColumn("label_error", F.lit(0).cast("long")), books
    return with_label_error(stored(codes(whole, books), "codes")), books
