"""Uniform shuffle into shards of exact sizes by a hypergeometric communication matrix.

How many rows of each source partition go to each shard is drawn once: shard sizes are fixed, and
the counts follow the multivariate hypergeometric law that a uniform permutation of all rows would
show.  Each source partition is permuted by itself and cut by its row of the matrix, the pieces are
exchanged, and each shard is permuted again.  Every assignment with these shard sizes and every
order inside a shard is then equally likely, up to the seeded hashes that stand for randomness.

The source partition is the scan partition in which a row was read, modulo ``MAX_PARTS``; it is
stored with the row, so a task that runs again finds the same.  The driver sees one count per
source partition.

Defined cases: a null text has no bytes and the checksum of the empty text; equal rows are separate
rows; null ids are ordinary values; with fewer rows than shards some shards are empty; other
columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import bucket_bits, spread_rank, stored, uniform_key

SHARDS = 16
SEED = 31
MAX_PARTS = 4096


def _log_choose(n: int, k: np.ndarray) -> np.ndarray:
    lgamma = np.vectorize(math.lgamma, otypes=[float])
    return math.lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1)


def draw_good(good: int, bad: int, taken: int, rng: np.random.Generator) -> int:
    """Hypergeometric draw; beyond numpy's limit by inversion around the mode."""
    if taken == 0 or good == 0:
        return 0
    if bad == 0:
        return taken
    if good < 10**9 and bad < 10**9:
        return int(rng.hypergeometric(good, bad, taken))
    total = good + bad
    mean = taken * good / total
    spread = 12 * math.sqrt(mean * (bad / total) * (total - taken) / max(1, total - 1)) + 40
    low = max(0, taken - bad, int(mean - spread))
    high = min(taken, good, int(mean + spread))
    values = np.arange(low, high + 1)
    log = _log_choose(good, values) + _log_choose(bad, taken - values)
    weight = np.exp(log - log.max())
    return int(values[np.searchsorted(np.cumsum(weight), rng.random() * weight.sum(), side="right").clip(0, len(values) - 1)])


def communication_matrix(parts: list[int], shards: list[int], seed: int) -> np.ndarray:
    """Counts by source partition and shard with the given row and column sums."""
    rng = np.random.default_rng(seed)
    left = list(shards)
    matrix = np.zeros((len(parts), len(shards)), dtype=np.int64)
    for i, size in enumerate(parts):
        rest = sum(left)
        for j in range(len(shards)):
            rest -= left[j]
            matrix[i, j] = draw_good(left[j], rest, size, rng)
            size -= int(matrix[i, j])
        for j in range(len(shards)):
            left[j] -= int(matrix[i, j])
    return matrix


def shard_sizes(rows: int, shards: int) -> list[int]:
    return [rows // shards + (j < rows % shards) for j in range(shards)]


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, size and text_crc32 of each row and the partition in which it was read."""
    text = F.coalesce("text", F.lit(""))
    return docs.select(
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        (F.spark_partition_id() % MAX_PARTS).alias("part"),
    )


def shuffled_shards(docs: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard (int), slot (long) and grown_shard (null)."""
    ties = ["doc_id", "text_crc32", "size"]
    rows = stored(digests(docs), "digests")
    counted = sorted((r.part, r["count"]) for r in rows.groupBy("part").count().collect())
    total = sum(count for _, count in counted)
    # A group of ranks is one source partition, then one shard: its buckets follow the largest of them.
    part_bits = bucket_bits(max((count for _, count in counted), default=0))
    shard_bits = bucket_bits(-(-total // shards))
    matrix = communication_matrix([count for _, count in counted], shard_sizes(total, shards), seed)
    cuts = [(part, np.cumsum(line)[:-1].tolist()) for (part, _), line in zip(counted, matrix)]
    table = docs.sparkSession.createDataFrame(cuts, "part int, cuts array<long>")
    keyed = rows.withColumn("key", uniform_key(seed, *[F.col(c) for c in ties]))
    local = spread_rank(keyed, ["part"], "key", ties, part_bits, "place").join(table, "part")
    dealt = local.select(*ties, F.size(F.filter("cuts", lambda cut: cut <= F.col("place"))).cast("int").alias("shard"))
    exchanged = stored(dealt.withColumn("key", uniform_key(seed + 1, *[F.col(c) for c in ties])), "dealt")
    return spread_rank(exchanged, ["shard"], "key", ties, shard_bits, "slot").select(
        *ties,
        F.lit("rows").alias("law"),
        "shard",
        F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    ).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
