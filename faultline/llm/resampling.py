"""Quality by importance resampling over hashed n-grams.

Two generative models count hashed unigrams and bigrams: one over documents labelled good, one over
all documents.  A document's log weight is the log-likelihood ratio of the two.  Adding
Gumbel noise, seeded by the document, and keeping the largest keys samples documents without
replacement in proportion to their weights.

The good model is fitted on a bounded sample of labelled documents (``MAX_TARGET``); the raw model
counts every word of every document.  Both are vectors of ``FEATURES`` counts, whatever the input.

Defined cases: a null or blank text has log weight 0; rows with one doc_id are separate rows with
the same noise; without good labels all weights are 0 and the sample is uniform; without any labels
everything is kept; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from faultline.llm.common import in_pandas, stored, uniform_key

FEATURES = 1 << 14
MAX_TARGET = 20_000
SEED = 17
# Rows among which the last key is looked up by sorting instead of by bins.
SMALL = 20_000
BINS = 4096


def hashed_ngrams(text: str | None, features: int = FEATURES) -> np.ndarray:
    """Feature numbers of all words and word pairs of a text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    pairs = hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) ^ (hashes[1:] >> np.uint64(7))
    pairs = (pairs ^ (pairs >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    half = np.uint64(features // 2)
    return np.concatenate((hashes % half, (pairs >> np.uint64(20)) % half + half)).astype(np.int64)


def _count(frames: Iterator[pd.DataFrame], features: int) -> Iterator[pd.DataFrame]:
    counts = np.zeros((2, features), dtype=np.int64)
    for frame in frames:
        for text, good in zip(frame["text"], frame["good"]):
            found = np.bincount(hashed_ngrams(text, features), minlength=features)
            counts[0] += found
            if good:
                counts[1] += found
    used = np.flatnonzero(counts[0])
    yield pd.DataFrame({"feature": used, "raw": counts[0][used], "target": counts[1][used]})


def log_ratio(docs: DataFrame, labels: DataFrame, features: int = FEATURES, max_target: int = MAX_TARGET) -> np.ndarray:
    """Log of the good over the raw probability of each feature, with add-one smoothing."""
    chosen = (
        labels.filter("quality = 1 AND doc_id IS NOT NULL").select("doc_id").distinct()
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_target)
    )
    # At most ``max_target`` longs, so this side is small whatever the input.
    marked = docs.select("doc_id", "text").join(
        F.broadcast(chosen.withColumn("good", F.lit(True))), "doc_id", "left"
    ).select("text", F.coalesce("good", F.lit(False)).alias("good"))
    counts = in_pandas(marked, lambda frames: _count(frames, features), "feature long, raw long, target long")
    raw, target = np.ones(features), np.ones(features)
    for row in counts.groupBy("feature").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).collect():
        raw[row.feature] += row.raw
        target[row.feature] += row.target
    if target.sum() == features:
        return np.zeros(features)
    ratio = np.zeros(features)
    for part in (slice(0, features // 2), slice(features // 2, features)):
        ratio[part] = np.log(target[part] / target[part].sum()) - np.log(raw[part] / raw[part].sum())
    return ratio


def log_weights(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """doc_id and log_weight of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    def score(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weight = shared.value
        for frame in frames:
            values = [float(weight[hashed_ngrams(text, len(weight))].sum()) for text in frame["text"]]
            yield pd.DataFrame({"doc_id": frame["doc_id"].astype("Int64"), "log_weight": values})

    narrow = docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text")
    return in_pandas(narrow, score, "doc_id long, log_weight double")


def mark_largest(rows: DataFrame, count: int, key: str, small: int = SMALL) -> DataFrame:
    """Adds ``kept``: true for exactly ``count`` rows, those with the largest keys, ties by doc_id.

    ``rows`` is a stored table.  Histograms of at most ``BINS`` bins narrow the range of the last
    kept key until few rows, or one value, are left; only those are sorted.
    """
    above, left = F.lit(False), count
    span = rows.agg(F.min(key), F.max(key), F.count(F.lit(1))).first()
    low, high, inside = span[0], span[1], span[2]
    if count >= inside:
        return rows.withColumn("kept", F.lit(True))
    range_ = F.lit(True)
    while inside > small and low < high:
        step = (high - low) / BINS
        bin_ = F.least(F.floor((F.col(key) - low) / step), F.lit(BINS - 1))
        found = {
            r.bin: r for r in rows.filter(range_).groupBy(bin_.alias("bin"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("low"), F.max(key).alias("high")).collect()
        }
        for name in sorted(found, reverse=True):
            if left <= found[name].n:
                break
            left -= found[name].n
        hit = found[name]
        above = F.col(key) > hit.high
        range_ = F.col(key).between(hit.low, hit.high)
        low, high, inside = hit.low, hit.high, hit.n
    order = Window.partitionBy("_open").orderBy(F.desc(key), F.xxhash64("doc_id"), "doc_id")
    cut = rows.withColumn("_open", range_)
    ranked = cut.filter("_open").withColumn("kept", F.row_number().over(order) <= left)
    return ranked.union(cut.filter("NOT _open").withColumn("kept", above)).drop("_open")


def good_share(labels: DataFrame) -> tuple[int, int]:
    """Good labels and all labels."""
    row = labels.agg(F.count_if(F.col("quality") == 1), F.count("quality")).first()
    return (row[0], row[1]) if row[0] else (1, 1) if not row[1] else (row[1], row[1])


def resampled(
    docs: DataFrame, labels: DataFrame, keep: tuple[int, int] | None = None, seed: int = SEED, features: int = FEATURES
) -> DataFrame:
    """Per row: doc_id, log_weight, key (log weight plus Gumbel noise) and kept.

    ``keep`` is the share of all rows to keep; by default the share of good ones among the labels.
    """
    keep = keep or good_share(labels)
    weights = log_weights(docs, log_ratio(docs, labels, features))
    uniform = (uniform_key(seed, F.col("doc_id")) + 0.5) / F.lit(2.0**63)
    rows = stored(weights.withColumn("key", F.col("log_weight") - F.ln(-F.ln(uniform))), "weights")
    return mark_largest(rows, -(-rows.count() * keep[0] // keep[1]), "key")
