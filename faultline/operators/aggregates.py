"""Gold aggregates.

Every count in these tables is additive, so each table can be computed from incidents or
from *cells* - incidents pre-aggregated by day, priority, product, category and team (see
``daily_cells``).  ``count_of`` and ``mean_duration`` hide the difference: on incidents they
count rows, on cells they add counters.

Percentiles are not additive.  Tables with one are computed from *duration cells*: the same
counters by the table's keys and the duration.  Equal durations are counted once in the map tasks;
the value at the rank is then found by a running count, exactly.  What a group sorts is its distinct
durations, bounded by the span of durations in seconds and not by its tickets, and it sorts on disk
if need be; no sketch or value list is held per group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.config import TARGETS, TargetPolicy
from faultline.functions.measures import nearest_rank_95, share_pct

CELL_KEYS = (
    "date",
    "opened_year",
    "opened_month",
    "priority_code",
    "priority_name",
    "product",
    "category",
    "assigned_group",
)


def counters() -> dict[str, Column]:
    """Name -> condition of every additive counter (a null condition does not count)."""
    eligible = F.col("kpi_eligible_by_rule")
    violated = F.col("kpi_violated_by_rule")
    entered_match = F.col("entered_kpi_rule_matches_source")
    violated_match = F.col("kpi_violated_rule_matches_source")
    return {
        "total_incidents": F.lit(True),
        "monitoring_incidents": F.col("opened_by") == "Monitoramento",
        "manual_incidents": F.col("opened_by") == "Manual",
        "source_kpi_incidents": F.col("entered_kpi"),
        "source_kpi_violations": F.col("kpi_violated"),
        "calculated_kpi_incidents": eligible,
        "evaluated_kpi_incidents": eligible & violated.isNotNull(),
        "calculated_kpi_violations": violated,
        "calculated_kpi_compliant": ~violated,
        "not_evaluable_kpi_incidents": eligible & violated.isNull(),
        "eligibility_comparisons": entered_match.isNotNull(),
        "eligibility_mismatches": ~entered_match,
        "violation_comparisons": violated_match.isNotNull(),
        "violation_mismatches": ~violated_match,
    }


def are_cells(df: DataFrame) -> bool:
    return "duration_sum" in df.columns


def count_of(df: DataFrame, counter: str, alias: str | None = None) -> Column:
    value = F.sum(counter) if are_cells(df) else F.count_if(counters()[counter])
    return value.alias(alias or counter)


def counts(df: DataFrame, *names: str, **renamed: str) -> list[Column]:
    """``counts(df, "a", b="c")`` gives counter a, and counter c under the name b."""
    return [count_of(df, name) for name in names] + [count_of(df, old, new) for new, old in renamed.items()]


def mean_duration(df: DataFrame) -> Column:
    if are_cells(df):
        mean = F.sum("duration_sum") / F.nullif(F.sum("duration_count"), F.lit(0))
    else:
        mean = F.avg("duration_seconds")
    return F.round(mean, 2).alias("avg_duration_seconds")


def additive(incidents: DataFrame) -> list[Column]:
    """Everything a cell holds: the counters, the sum of durations and the number of known ones."""
    return [
        *counts(incidents, *counters()),
        F.coalesce(F.sum("duration_seconds"), F.lit(0)).alias("duration_sum"),
        F.count("duration_seconds").alias("duration_count"),
    ]


def daily_cells(incidents: DataFrame) -> DataFrame:
    """All additive counters by day and dimension: the small table other tables roll up from."""
    return incidents.withColumn("date", F.to_date("opened_at")).groupBy(*CELL_KEYS).agg(*additive(incidents))


def duration_cells(incidents: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cells by ``keys`` and duration; ``at_p95`` is the duration where it reaches the 95th percentile.

    Unknown durations sort first and do not count, so the least ``at_p95`` of a group is its
    nearest-rank percentile and null without known durations.
    """
    cells = incidents.groupBy(*keys, "duration_seconds").agg(*additive(incidents))
    group = Window.partitionBy(*keys)
    reached = F.sum("duration_count").over(group.orderBy(F.asc_nulls_first("duration_seconds")))
    rank = nearest_rank_95(F.sum("duration_count").over(group))
    return cells.withColumn("at_p95", F.when(reached >= rank, F.col("duration_seconds")))


def p95_duration() -> Column:
    return F.min("at_p95").alias("p95_duration_seconds")


def daily_cells_with_p95(incidents: DataFrame) -> DataFrame:
    dated = duration_cells(incidents.withColumn("date", F.to_date("opened_at")), CELL_KEYS)
    kept = [F.sum(name).alias(name) for name in (*counters(), "duration_sum", "duration_count")]
    return dated.groupBy(*CELL_KEYS).agg(*kept, p95_duration())


def with_source_compliance(df: DataFrame) -> DataFrame:
    kept = F.col("kpi_incidents") - F.col("kpi_violations")
    return df.withColumn("kpi_compliance_pct", share_pct(kept, F.col("kpi_incidents")))


def source_kpis(df: DataFrame) -> list[Column]:
    return counts(df, kpi_incidents="source_kpi_incidents", kpi_violations="source_kpi_violations")


def monthly_kpis(incidents: DataFrame) -> DataFrame:
    keys = ("opened_year", "opened_month")
    cells = duration_cells(incidents, keys)
    return with_source_compliance(
        cells.groupBy(*keys).agg(
            *counts(cells, "total_incidents", "monitoring_incidents", "manual_incidents"),
            *source_kpis(cells),
            mean_duration(cells),
            p95_duration(),
        )
    )


def priority_summary(incidents: DataFrame) -> DataFrame:
    keys = ("priority_code", "priority_name")
    cells = duration_cells(incidents, keys)
    return with_source_compliance(
        cells.groupBy(*keys).agg(
            *counts(cells, "total_incidents"), *source_kpis(cells), mean_duration(cells), p95_duration()
        )
    )


def team_summary(df: DataFrame) -> DataFrame:
    return with_source_compliance(
        df.groupBy("assigned_group").agg(*counts(df, "total_incidents"), *source_kpis(df), mean_duration(df))
    )


def dashboard_summary(df: DataFrame) -> DataFrame:
    keys = ("opened_year", "opened_month", "priority_code", "priority_name", "assigned_group")
    return df.groupBy(*keys).agg(
        *counts(df, "total_incidents"),
        *source_kpis(df),
        *counts(df, "monitoring_incidents", "manual_incidents"),
    )


OPERATIONAL_COUNTERS = (
    "total_incidents",
    "source_kpi_incidents",
    "source_kpi_violations",
    "calculated_kpi_incidents",
    "evaluated_kpi_incidents",
    "calculated_kpi_violations",
    "calculated_kpi_compliant",
    "not_evaluable_kpi_incidents",
    "eligibility_comparisons",
    "eligibility_mismatches",
    "violation_comparisons",
    "violation_mismatches",
)

OPERATIONAL_RATES = {
    "calculated_compliance_pct": ("calculated_kpi_compliant", "evaluated_kpi_incidents"),
    "eligibility_mismatch_pct": ("eligibility_mismatches", "eligibility_comparisons"),
    "violation_mismatch_pct": ("violation_mismatches", "violation_comparisons"),
}


def with_rates(df: DataFrame, rates: dict[str, tuple[str, str]]) -> DataFrame:
    return df.withColumns({name: share_pct(F.col(part), F.col(whole)) for name, (part, whole) in rates.items()})


def operational_kpi_summary(incidents: DataFrame) -> DataFrame:
    keys = ("opened_year", "opened_month", "priority_code", "priority_name", "assigned_group")
    cells = duration_cells(incidents, keys)
    table = cells.groupBy(*keys).agg(*counts(cells, *OPERATIONAL_COUNTERS), mean_duration(cells), p95_duration())
    return with_rates(table, OPERATIONAL_RATES)


TREND_KEYS = ("date", "priority_code", "priority_name", "product", "category", "assigned_group")
TREND_COUNTERS = {
    "total_incidents": "total_incidents",
    "kpi_incidents": "calculated_kpi_incidents",
    "evaluated_kpi_incidents": "evaluated_kpi_incidents",
    "kpi_violations": "calculated_kpi_violations",
    "kpi_compliant": "calculated_kpi_compliant",
}
TREND_RATES = {"kpi_compliance_pct": ("kpi_compliant", "evaluated_kpi_incidents")}


def daily_trends(incidents: DataFrame) -> DataFrame:
    cells = duration_cells(incidents.withColumn("date", F.to_date("opened_at")), TREND_KEYS)
    table = cells.groupBy(*TREND_KEYS).agg(*counts(cells, **TREND_COUNTERS), mean_duration(cells), p95_duration())
    return with_rates(table, TREND_RATES)


def daily_trends_from_cells(cells: DataFrame) -> DataFrame:
    """Trends are the cells themselves when the cells were built with their percentile."""
    mean = F.round(F.col("duration_sum") / F.nullif(F.col("duration_count"), F.lit(0)), 2)
    table = cells.select(
        *TREND_KEYS,
        *(F.col(old).alias(new) for new, old in TREND_COUNTERS.items()),
        mean.alias("avg_duration_seconds"),
        "p95_duration_seconds",
    )
    return with_rates(table, TREND_RATES)


def banded_points(value: Column, bounds: Sequence[int], points: Sequence[int]) -> Column:
    ladder = F.when(value < bounds[0], points[0])
    for bound, score in zip(bounds[1:], points[1:]):
        ladder = ladder.when(value <= bound, score)
    return ladder.otherwise(0)


def add_attainment(df: DataFrame, policy: TargetPolicy = TARGETS) -> DataFrame:
    """Points per band of violations and of treated volume; null for other priorities."""

    def points_for(value: str, bands: dict[int, tuple[int, ...]]) -> Column:
        per_priority = [
            F.when(F.col("priority_code") == code, banded_points(F.col(value), bounds, policy.points))
            for code, bounds in bands.items()
        ]
        return F.coalesce(*per_priority).cast("int")

    return df.withColumns(
        {
            "violation_target_attainment_pct": points_for("calculated_kpi_violations", policy.violation_bands),
            "volume_target_attainment_pct": points_for("treated_volume", policy.volume_bands),
        }
    )


def annual_ola_summary(df: DataFrame, policy: TargetPolicy = TARGETS) -> DataFrame:
    scoped = df.filter(F.col("priority_code").isin(*policy.priorities))
    table = scoped.groupBy("opened_year", "priority_code", "priority_name").agg(
        *counts(scoped, treated_volume="total_incidents"),
        *counts(
            scoped,
            "calculated_kpi_incidents",
            "evaluated_kpi_incidents",
            "calculated_kpi_violations",
            "calculated_kpi_compliant",
        ),
    )
    rates = {"calculated_compliance_pct": OPERATIONAL_RATES["calculated_compliance_pct"]}
    return with_rates(table, rates).transform(add_attainment, policy)
