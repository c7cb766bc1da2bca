"""Packing by optimal length buckets.

Documents become pieces of at most ``max_length`` tokens (words between blanks).  Dynamic
programming over the global histogram of piece lengths, which has at most ``max_length`` rows,
chooses the bucket lengths with the least padding in total.  Each piece is padded to its bucket's
length, and batches of as many pieces as the token budget allows are formed inside each bucket, in
a seeded order.

Defined cases: a text without tokens, null included, gives no piece; rows with one doc_id are
separate rows; a piece longer than the budget's share is alone in its batch; the last batch of a
bucket may be smaller; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import bucket_bits, spread_rank, stored, uniform_key

MAX_LENGTH = 2048
BUCKETS = 8
TOKEN_BUDGET = 16384
SEED = 23
WORD = r"[^\x20\x09-\x0D]+"


def pieces(docs: DataFrame, max_length: int = MAX_LENGTH) -> DataFrame:
    """doc_id, piece (int), first_token, n_tokens."""
    tokens = docs.select("doc_id", F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("long").alias("tokens"))
    cut = F.sequence(F.lit(0), F.expr(f"cast((tokens - 1) div {max_length} AS int)"))
    return tokens.filter("tokens > 0").select("doc_id", "tokens", F.explode(cut).alias("piece")).select(
        "doc_id",
        "piece",
        (F.col("piece").cast("long") * max_length).alias("first_token"),
        F.least(F.lit(max_length).cast("long"), F.col("tokens") - F.col("piece") * max_length).alias("n_tokens"),
    )


def best_bounds(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """Bucket lengths, ascending, with the least padding of all choices of at most ``buckets``."""
    length = np.array(lengths, dtype=np.int64)
    order = np.argsort(length)
    length, count = length[order], np.array(counts, dtype=np.int64)[order]
    rows = np.concatenate(([0], np.cumsum(count)))
    tokens = np.concatenate(([0], np.cumsum(count * length)))
    n = len(length)
    best = np.full(n + 1, np.iinfo(np.int64).max // 4)
    best[0] = 0
    chosen = []
    for _ in range(min(buckets, n)):
        now, where = best.copy(), np.arange(n + 1)
        for end in range(1, n + 1):
            cost = best[:end] + length[end - 1] * (rows[end] - rows[:end]) - (tokens[end] - tokens[:end])
            begin = int(cost.argmin())
            if cost[begin] < now[end]:
                now[end], where[end] = cost[begin], begin
        best = now
        chosen.append(where)
    bounds, end = [], n
    for where in reversed(chosen):
        if where[end] < end:
            bounds.append(int(length[end - 1]))
            end = int(where[end])
    return bounds[::-1]


def packed(
    docs: DataFrame, max_length: int = MAX_LENGTH, buckets: int = BUCKETS, token_budget: int = TOKEN_BUDGET,
    seed: int = SEED,
) -> DataFrame:
    """Per piece: doc_id, piece, first_token, n_tokens, bucket, padded_length, batch, slot."""
    rows = stored(pieces(docs, max_length).withColumn("key", uniform_key(seed, F.col("doc_id"), F.col("piece"))), "pieces")
    histogram = rows.groupBy("n_tokens").count().collect()
    bounds = best_bounds([r.n_tokens for r in histogram], [r["count"] for r in histogram], buckets)
    bucket = F.lit(len(bounds) - 1)
    padded = F.lit(bounds[-1] if bounds else max_length)
    for i in range(len(bounds) - 2, -1, -1):
        bucket = F.when(F.col("n_tokens") <= bounds[i], F.lit(i)).otherwise(bucket)
        padded = F.when(F.col("n_tokens") <= bounds[i], F.lit(bounds[i])).otherwise(padded)
    placed = rows.withColumns({"bucket": bucket.cast("int"), "padded_length": padded.cast("int")})
    bits = bucket_bits(sum(r["count"] for r in histogram))
    ranked = spread_rank(placed, ["bucket"], "key", ["doc_id", "piece", "n_tokens"], bits, "place")
    return (
        ranked.withColumn("_rows", F.greatest(F.lit(1), F.expr(f"{token_budget} div padded_length")))
        .withColumn("batch", F.expr("cast(place div _rows AS bigint)"))
        .withColumn("slot", F.expr("cast(place % _rows AS int)"))
        .select("doc_id", "piece", "first_token", "n_tokens", "bucket", "padded_length", "batch", "slot")
    )
