"""Explainable risk ranking per dimension value.

One scan serves all four dimensions: incidents are first summed at the grain of the four
dimensions together, only those sums are unpivoted, and a second small aggregation brings
them to one row per dimension value.  A dominant product or team therefore reaches the
second shuffle as partial sums, never as its incidents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.config import RISK, RiskPolicy
from faultline.functions.measures import share_pct
from faultline.functions.ranking import range_ranked
from faultline.functions.text import blank_to_null
from faultline.operators.aggregates import are_cells, count_of
from faultline.schema import RISK_DIMENSIONS


def dimension_sums(df: DataFrame, dimensions: dict[str, str] = RISK_DIMENSIONS) -> DataFrame:
    keys = [blank_to_null(F.col(column).cast("string")).alias(kind) for kind, column in dimensions.items()]
    if are_cells(df):
        duration = [F.sum("duration_sum").alias("seconds"), F.sum("duration_count").alias("timed")]
    else:
        duration = [F.sum("duration_seconds").alias("seconds"), F.count("duration_seconds").alias("timed")]
    return df.groupBy(*keys).agg(
        count_of(df, "total_incidents", "volume"),
        count_of(df, "evaluated_kpi_incidents"),
        count_of(df, "calculated_kpi_violations", "kpi_violations"),
        *duration,
    )


def risk_aggregate(df: DataFrame, dimensions: dict[str, str] = RISK_DIMENSIONS) -> DataFrame:
    sums = ("volume", "evaluated_kpi_incidents", "kpi_violations", "seconds", "timed")
    long = dimension_sums(df, dimensions).unpivot(
        list(sums), list(dimensions), "dimension_type", "dimension_value"
    )
    table = long.groupBy("dimension_type", "dimension_value").agg(*(F.sum(name).alias(name) for name in sums))
    return table.select(
        "dimension_type",
        "dimension_value",
        F.col("dimension_value").isNull().alias("is_unknown"),
        "volume",
        "evaluated_kpi_incidents",
        "kpi_violations",
        share_pct(F.col("kpi_violations"), F.col("evaluated_kpi_incidents")).alias("kpi_violation_rate_pct"),
        F.round(F.col("seconds") / F.nullif(F.col("timed"), F.lit(0)), 2).alias("avg_duration_seconds"),
    )


COMPONENTS = {
    "volume_normalized": "volume",
    "violation_rate_normalized": "kpi_violation_rate_pct",
    "avg_duration_normalized": "avg_duration_seconds",
}


def component_maxima(df: DataFrame) -> DataFrame:
    """The largest known value of every component, one row per dimension."""
    known = ~F.col("is_unknown")
    return df.groupBy("dimension_type").agg(*(F.max(F.when(known, F.col(v))).alias(f"top_{v}") for v in COMPONENTS.values()))


def scaled(value: str) -> Column:
    """Share of the largest known value of the dimension, at most 1; 0 without a maximum."""
    top = F.col(f"top_{value}")
    share = F.least(F.coalesce(F.col(value), F.lit(0)) / F.nullif(top, F.lit(0)), F.lit(1.0))
    return F.round(F.when(top > 0, share).otherwise(F.lit(0.0)), 4)


def add_components(df: DataFrame) -> DataFrame:
    """The maxima, one row per dimension, are joined back; the sums below are shared by both sides."""
    placed = df.join(F.broadcast(component_maxima(df)), "dimension_type")
    return placed.withColumns({name: scaled(value) for name, value in COMPONENTS.items()}).drop(
        *(f"top_{value}" for value in COMPONENTS.values())
    )


def add_score(df: DataFrame, policy: RiskPolicy = RISK) -> DataFrame:
    weighted = (
        F.col("volume_normalized") * policy.volume_weight
        + F.col("violation_rate_normalized") * policy.rate_weight
        + F.col("avg_duration_normalized") * policy.duration_weight
    )
    return df.withColumn("risk_score", F.round(weighted * 100, 2))


def add_rank(df: DataFrame) -> DataFrame:
    """Position among the known values of a dimension; unknown values stay unranked."""
    worst_first = [
        F.col("is_unknown").asc(),
        F.col("risk_score").desc(),
        F.col("volume").desc(),
        F.col("dimension_value").asc(),
    ]
    ranked = range_ranked(df, "dimension_type", worst_first, "rank")
    return ranked.withColumn("rank", F.when(~F.col("is_unknown"), F.col("rank").cast("int")))


def risk_scores(df: DataFrame, policy: RiskPolicy = RISK) -> DataFrame:
    return risk_aggregate(df).transform(add_components).transform(add_score, policy)


def risk_summary(df: DataFrame, policy: RiskPolicy = RISK) -> DataFrame:
    return risk_scores(df, policy).transform(add_rank)


def risk_order() -> list[Column]:
    return [
        F.col("dimension_type").asc(),
        F.col("is_unknown").asc(),
        F.col("rank").asc_nulls_last(),
        F.col("dimension_value").asc(),
    ]
