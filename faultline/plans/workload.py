"""Fingerprints, timing summaries and comparison of workload profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STATISTICS = ("minimum", "median", "p95", "mean", "maximum", "stdev")


def table_fingerprint(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count("*").alias("rows"),
        F.coalesce(F.sum("duration_seconds"), F.lit(0)).alias("duration_sum"),
        F.coalesce(F.sum("priority_code"), F.lit(0)).alias("priority_sum"),
    )


def output_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counted = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def summarize_samples(samples: DataFrame, keys: str | list[str], value: str) -> DataFrame:
    """Exact order statistics per key: nearest-rank p95, median of the two middle values.

    Equal values are counted first, with map-side combining; the running count then sorts
    distinct values only, on disk if need be, instead of holding a group in memory.
    """
    key = [keys] if isinstance(keys, str) else list(keys)
    counted = samples.groupBy(*key, value).agg(F.count("*").alias("n"))
    ordered = Window.partitionBy(*key).orderBy(value)
    whole = Window.partitionBy(*key)
    placed = counted.withColumns(
        {"last": F.sum("n").over(ordered), "size": F.sum("n").over(whole)}
    )

    def at_rank(rank: Column) -> Column:
        """Value at a one-based rank: the smallest whose running count reaches it."""
        return F.min(F.when(F.col("last") >= rank, F.col(value)))

    half = F.col("size") / 2
    weighted = F.col(value) * F.col("n")
    stats = placed.groupBy(*key).agg(
        F.min(value).alias("minimum"),
        ((at_rank(F.ceil(half)) + at_rank(F.floor(half) + 1)) / 2).alias("median"),
        at_rank(F.ceil(F.col("size") * 0.95)).alias("p95"),
        (F.sum(weighted) / F.sum("n")).alias("mean"),
        F.max(value).alias("maximum"),
        F.sqrt(
            F.sum(F.col(value) * weighted) / F.sum("n") - F.pow(F.sum(weighted) / F.sum("n"), F.lit(2.0))
        ).alias("stdev"),
    )
    return stats.select(*key, *(F.round(F.col(s).cast("double"), 4).alias(s) for s in STATISTICS))


FINGERPRINT = ("rows", "duration_sum", "priority_sum")


def summarize_profiles(runs: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Timing statistics, fingerprint and its stability per profile, for every comparison in ``by``.

    ``runs`` has one row per measured run: profile, total_seconds and the fingerprint.
    """
    keys = [*(by or []), "profile"]
    prints = runs.groupBy(*keys).agg(
        *(F.min(c).alias(c) for c in FINGERPRINT),
        *(F.max(c).alias(f"max_{c}") for c in FINGERPRINT),
    )
    stable = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"max_{c}")) for c in FINGERPRINT))
    timing = summarize_samples(runs, keys, "total_seconds")
    return timing.join(prints.select(*keys, *FINGERPRINT, stable.alias("stable")), keys)


def compare_profiles(
    summary: DataFrame, baseline: str, optimized: str, minimum_pct: float = 10.0, by: list[str] | None = None
) -> DataFrame:
    """Improvement, speed-up and verdict; one row per comparison in which both profiles were measured."""

    def of(profile: str, column: str) -> Column:
        return F.max(F.when(F.col("profile") == profile, F.col(column)))

    sides = {"b": baseline, "o": optimized}
    wide = summary.groupBy(*(by or [])).agg(
        *(of(p, c).alias(f"{s}_{c}") for s, p in sides.items() for c in ("median", "stable", *FINGERPRINT))
    ).filter((F.col("b_median") > 0) & (F.col("o_median") > 0))
    same = reduce(lambda a, b: a & b, (F.col(f"b_{c}").eqNullSafe(F.col(f"o_{c}")) for c in FINGERPRINT))
    matches = same & F.col("b_stable") & F.col("o_stable")
    improvement = (F.col("b_median") - F.col("o_median")) / F.col("b_median") * 100
    return wide.select(
        *(by or []),
        F.when(matches, "MATCH").otherwise("MISMATCH").alias("correctness_status"),
        F.round(F.lit(minimum_pct), 2).alias("minimum_improvement_pct"),
        F.round(improvement, 2).alias("median_improvement_pct"),
        F.round(F.col("b_median") / F.col("o_median"), 3).alias("speedup"),
        F.when(~matches, "REJECT_OPTIMIZATION")
        .when(improvement >= minimum_pct, "ADOPT_OPTIMIZED_PROFILE")
        .otherwise("KEEP_BASELINE_AND_RETEST")
        .alias("recommendation"),
    )
