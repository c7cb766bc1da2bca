"""Line deduplication by range-partitioned hashes; the result is a keep bitmap per document.

A line's key is the line without blanks at both ends and with A to Z lower-cased.  Every document
gives one narrow row per distinct key: the key's 128-bit hash, the document and the line numbers.
These rows, never texts, are range-partitioned and sorted by hash and document, so all documents of
a key stand one after another and a very frequent key is spread over as many tasks as it needs.
Each task streams its rows and holds at most ``min_docs - 1`` rows of the run it is in.  A run that
may go on in another task is settled afterwards from the few rows that each task returns for its
first and last run.

Only dropped lines are returned, folded into one compressed bitmap per document that loses lines.
With ``keep_first`` the first occurrence of a dropped key, by document and position, stays.

Defined cases: a null or empty text is one empty line; lines with an empty key always stay; a
document is a pair of doc_id and text, so equal rows count once and share their bitmap, and rows of
one doc_id with different texts are different documents; a null doc_id is an ordinary value that
sorts first; other columns are carried along untouched, whatever their names; an empty table gives
empty tables.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from faultline.llm.common import in_pandas, send_package, stored

MIN_DOCS = 10

# What becomes of a row of a run: dropped for sure, open until all tasks are known, or open and
# the first of at least ``min_docs`` documents in its task.
DROPPED, OPEN, FREQUENT = 0, 1, 2
HASH = ["high", "low"]
DOCUMENT = ["has_id", "doc", "digest"]
CARRIED = [*HASH, *DOCUMENT, "n_lines", "lines"]


def line_keys(text: str | None) -> list[bytes]:
    """The key of every line; bytes.strip and bytes.lower know exactly the blanks and letters meant."""
    return [line.strip().lower() for line in (text or "").encode("utf-8", "surrogatepass").split(b"\n")]


def document_key(docs: DataFrame) -> list[Column]:
    doc_id = docs["doc_id"].cast("long")
    return [
        doc_id.isNotNull().alias("has_id"),
        F.coalesce(doc_id, F.lit(0)).cast("long").alias("doc"),
        F.xxhash64(F.coalesce(docs["text"], F.lit(""))).alias("digest"),
    ]


def _occurrences(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        out: list[tuple] = []
        for has_id, doc, digest, text in frame[[*DOCUMENT, "text"]].itertuples(index=False):
            keys = line_keys(text)
            places: dict[bytes, list[int]] = {}
            for place, key in enumerate(keys):
                if key:
                    places.setdefault(key, []).append(place)
            for key, at in places.items():
                full = xxhash.xxh3_128_intdigest(key)
                out.append(
                    (full >> 64, full & 0xFFFFFFFFFFFFFFFF, has_id, doc, digest, len(keys), np.array(at, "<i4").tobytes())
                )
            if len(out) > 50000:
                yield _frame(out)
                out = []
        yield _frame(out)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    frame = pd.DataFrame(rows, columns=CARRIED)
    for name in HASH:
        frame[name] = frame[name].to_numpy(np.uint64).view(np.int64)
    return frame


class _Runs:
    """Streams rows sorted by hash and document and settles run after run."""

    def __init__(self, min_docs: int, keep_first: bool):
        self.min_docs, self.keep_first = min_docs, keep_first
        self.held: pd.DataFrame | None = None
        # Rows of the current run that have left already; more than none once it is frequent.
        self.gone = 0
        self.last: tuple | None = None
        self.at_start = True

    def feed(self, frame: pd.DataFrame | None) -> Iterator[pd.DataFrame]:
        """The rows that are settled with the next rows, or with the end of the task (None)."""
        end = frame is None
        parts = [part for part in (self.held, frame) if part is not None]
        self.held = None
        if not parts:
            return
        rows = pd.concat(parts, ignore_index=True) if len(parts) > 1 else parts[0].reset_index(drop=True)
        if len(rows):
            keys = np.column_stack([rows[name].to_numpy(np.int64) for name in (*HASH, *DOCUMENT)])
            same = np.zeros(len(rows), bool)
            same[1:] = (keys[1:] == keys[:-1]).all(1)
            same[0] = self.last is not None and tuple(keys[0]) == self.last
            rows, keys = rows[~same], keys[~same]
        if not len(rows):
            return
        starts = np.flatnonzero(np.concatenate(([True], (keys[1:, :2] != keys[:-1, :2]).any(1))))
        ends = np.append(starts[1:], len(rows))
        continued = self.gone > 0 and tuple(keys[0, :2]) == self.last[:2]
        if self.gone and not continued:
            self.gone, self.at_start = 0, False
        sizes = ends - starts
        before = np.zeros(len(starts), np.int64)
        before[0] = self.gone
        frequent = before + sizes >= self.min_docs
        open_run = np.zeros(len(starts), bool)
        open_run[0] = self.at_start
        open_run[-1] |= end
        settled = np.ones(len(starts), bool)
        settled[-1] = end or bool(frequent[-1])
        state = np.full(len(rows), DROPPED)
        leaves = np.repeat(settled & (frequent | open_run), sizes)
        lone = np.repeat(open_run & ~frequent, sizes)
        state[lone] = OPEN
        # A frequent run at the end of a batch may turn out to be the last of its task, so its first
        # row stays open as well.
        edge = open_run.copy()
        edge[-1] = True
        new = (before == 0) & frequent
        state[starts[new & edge]] = FREQUENT
        out = rows.assign(state=state)
        if self.keep_first:
            inner = starts[new & ~edge]
            out.loc[out.index[inner], "lines"] = [b[4:] for b in out["lines"].iloc[inner]]
        if leaves.any():
            some = np.fromiter(map(len, out["lines"]), np.int64, len(out)) > 0
            yield out[leaves & ((state != DROPPED) | some)]
        if frequent[-1]:
            self.gone, self.last = int(before[-1] + sizes[-1]), tuple(keys[-1])
        else:
            self.gone, self.last = 0, None
            if not end:
                self.held = rows.iloc[starts[-1] :]
        if len(starts) > 1:
            self.at_start = False


def _settle(frames: Iterator[pd.DataFrame], min_docs: int, keep_first: bool) -> Iterator[pd.DataFrame]:
    runs = _Runs(min_docs, keep_first)
    for frame in frames:
        yield from runs.feed(frame)
    yield from runs.feed(None)


def dropped_lines(docs: DataFrame, min_docs: int, keep_first: bool) -> DataFrame:
    """Per document and dropped key: the document's key, n_lines and the dropped line numbers."""
    texts = docs.select(*document_key(docs), "text")
    schema = "high long, low long, has_id boolean, doc long, digest long, n_lines int, lines binary"
    found = stored(in_pandas(texts, _occurrences, schema), "lines")
    order = [*HASH, *DOCUMENT]
    sorted_rows = found.repartitionByRange(*order).sortWithinPartitions(*order)
    settled = stored(
        in_pandas(sorted_rows, lambda frames: _settle(frames, min_docs, keep_first), f"{schema}, state int"), "settled"
    )
    still_open = settled.filter(F.col("state") != DROPPED)
    runs = still_open.groupBy(*HASH).agg(
        F.max("state").alias("worst"),
        F.countDistinct(F.struct(*DOCUMENT)).alias("docs"),
        F.min(F.struct(*DOCUMENT)).alias("least"),
    )
    frequent = still_open.join(runs.filter((F.col("worst") == FREQUENT) | (F.col("docs") >= min_docs)), HASH)
    if keep_first:
        kept = F.struct(*DOCUMENT) == F.col("least")
        frequent = frequent.withColumn("lines", F.when(kept, F.expr("substring(lines, 5)")).otherwise(F.col("lines")))
    result = [*DOCUMENT, "n_lines", "lines"]
    return settled.filter(F.col("state") == DROPPED).select(*result).union(frequent.select(*result)).filter("length(lines) > 0")


def pack(kept: np.ndarray) -> bytes:
    """A compressed bitmap, the first line in the lowest bit."""
    return zlib.compress(np.packbits(kept, bitorder="little").tobytes(), 6)


def unpack(keep: bytes, n_lines: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=n_lines, bitorder="little").astype(bool)


def _bitmaps(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in frames:
        keeps, counts = [], []
        for n_lines, parts in zip(frame["n_lines"], frame["parts"]):
            gone = np.unique(np.frombuffer(b"".join(parts), "<i4"))
            kept = np.ones(n_lines, bool)
            kept[gone] = False
            keeps.append(pack(kept))
            counts.append(len(gone))
        yield frame[[*DOCUMENT, "n_lines"]].assign(n_dropped=counts, keep=keeps)


def line_bitmaps(docs: DataFrame, min_docs: int = MIN_DOCS, keep_first: bool = False) -> DataFrame:
    """has_id, doc, digest, n_lines, n_dropped and keep of every document that loses lines."""
    if min_docs < 1:
        raise ValueError("min_docs starts at 1")
    lost = dropped_lines(docs, min_docs, keep_first).groupBy(*DOCUMENT, "n_lines").agg(F.collect_list("lines").alias("parts"))
    return in_pandas(lost, _bitmaps, "has_id boolean, doc long, digest long, n_lines int, n_dropped int, keep binary")


def kept_lines(text: str, keep: bytes) -> str:
    lines = text.split("\n")
    return "\n".join([line for line, stays in zip(lines, unpack(keep, len(lines))) if stays])


def without_lines(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``document`` (a row of ``docs``), its ``text`` without the dropped lines, n_lines and n_dropped.
    A text without a bitmap does not pass through Python."""
    send_package(docs.sparkSession)

    @pandas_udf("string")
    def cut(texts: pd.Series, keeps: pd.Series) -> pd.Series:
        return pd.Series([None if k is None else kept_lines(t, k) for t, k in zip(texts, keeps)], dtype=object)

    keyed = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("_row"), F.struct(*document_key(docs)).alias("_key"))
    marks = bitmaps.select(F.struct(*DOCUMENT).alias("_key"), F.col("n_dropped").alias("_dropped"), F.col("keep").alias("_keep"))
    joined = keyed.join(marks, "_key", "left")
    text = F.col("_row.text")
    touched = joined.withColumn("_cut", cut(F.when(F.col("_keep").isNotNull(), text), "_keep"))
    n_lines = F.size(F.split(F.coalesce(text, F.lit("")), "\n", -1)).cast("long")
    return touched.select(
        F.col("_row").alias("document"),
        F.coalesce("_cut", text).alias("text"),
        n_lines.alias("n_lines"),
        F.coalesce("_dropped", F.lit(0)).cast("long").alias("n_dropped"),
    )
