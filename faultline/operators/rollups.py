"""Consumer views: slicers and re-aggregations over the published tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NOT_INFORMED = "Não informado"
TOP = 10
RISK_BANDS = ((50, "critical"), (25, "high"), (10, "medium"))


def sliced(df: DataFrame, **chosen) -> DataFrame:
    """Keep rows equal to every chosen value; None or empty means all."""
    for column, value in chosen.items():
        if value not in (None, ""):
            df = df.filter(F.col(column) == value)
    return df


def trends_sliced(trends: DataFrame, year=None, month=None, **chosen) -> DataFrame:
    """The calendar part becomes a date range, so it reaches file statistics and partitions."""
    if year and month:
        first = F.make_date(F.lit(year), F.lit(month), F.lit(1))
        trends = trends.filter((F.col("date") >= first) & (F.col("date") <= F.last_day(first)))
    elif year:
        bounds = F.make_date(F.lit(year), F.lit(1), F.lit(1)), F.make_date(F.lit(year), F.lit(12), F.lit(31))
        trends = trends.filter(F.col("date").between(*bounds))
    elif month:
        trends = trends.filter(F.month("date") == month)
    return sliced(trends, **chosen)


def compliance_share(kpi: Column, violations: Column) -> Column:
    return F.when(kpi > 0, (kpi - violations) / kpi * 100)


def total_of(name: str) -> Column:
    return F.coalesce(F.sum(name), F.lit(0)).alias(name)


def overview_totals(dashboard: DataFrame) -> DataFrame:
    sums = dashboard.agg(*(total_of(c) for c in ("total_incidents", "kpi_incidents", "kpi_violations")))
    return sums.withColumn("compliance_pct", compliance_share(F.col("kpi_incidents"), F.col("kpi_violations")))


def overview_monthly(dashboard: DataFrame) -> DataFrame:
    return dashboard.groupBy("opened_year", "opened_month").agg(total_of("total_incidents"), total_of("kpi_incidents"))


def overview_priority(dashboard: DataFrame) -> DataFrame:
    return dashboard.groupBy("priority_code").agg(
        F.min("priority_name").alias("priority_name"), total_of("total_incidents")
    )


def named(column: str) -> Column:
    return F.coalesce(F.nullif(F.col(column), F.lit("")), F.lit(NOT_INFORMED))


def top_by_volume(df: DataFrame, name: Column, limit: int = TOP) -> DataFrame:
    totals = df.groupBy(name.alias("name")).agg(total_of("total_incidents"))
    return totals.orderBy(F.desc("total_incidents"), F.asc("name")).limit(limit)


def top_teams(dashboard: DataFrame, limit: int = TOP) -> DataFrame:
    return top_by_volume(dashboard, named("assigned_group"), limit)


def top_dimension(trends: DataFrame, dimension: str, limit: int = TOP) -> DataFrame:
    if dimension == "priority":
        label = F.concat_ws(" - ", F.col("priority_code").cast("string"), "priority_name")
    else:
        label = named({"team": "assigned_group"}.get(dimension, dimension))
    return top_by_volume(trends, label, limit)


def trend_rollup(trends: DataFrame, *keys: Column) -> DataFrame:
    """Sums plus the volume-weighted mean of daily means.

    Daily means have two decimals, so the weighted sum is kept as an exact decimal: the
    result does not depend on the order in which executors deliver partial sums.
    """
    mean = F.col("avg_duration_seconds")
    weight = F.when(mean.isNotNull(), F.col("total_incidents"))
    exact = (mean.cast("decimal(18,2)") * weight.cast("decimal(18,0)")).cast("decimal(38,2)")
    sums = trends.groupBy(*keys).agg(
        *(total_of(c) for c in ("total_incidents", "kpi_incidents", "kpi_violations")),
        F.sum(exact).cast("double").alias("_weighted"),
        F.sum(weight).alias("_weight"),
    )
    return sums.withColumns(
        {
            "compliance_pct": compliance_share(F.col("kpi_incidents"), F.col("kpi_violations")),
            "avg_duration_seconds": F.when(F.col("_weight") > 0, F.col("_weighted") / F.col("_weight")),
        }
    ).drop("_weighted", "_weight")


def trend_totals(trends: DataFrame) -> DataFrame:
    return trend_rollup(trends)


def trend_daily(trends: DataFrame) -> DataFrame:
    return trend_rollup(trends, F.col("date"))


def trend_weekly(trends: DataFrame) -> DataFrame:
    return trend_rollup(trends, F.date_trunc("week", "date").cast("date").alias("week_start"))


def forecast_timeline(history: DataFrame, forecast: DataFrame) -> DataFrame:
    past = history.select("date", "actual_incidents")
    ahead = forecast.select(
        F.col("forecast_date").alias("date"), "predicted_incidents", "lower_bound", "upper_bound"
    )
    return past.unionByName(ahead, allowMissingColumns=True)


def risk_band(score: Column) -> Column:
    (bound, band), *rest = RISK_BANDS
    ladder = F.when(score >= bound, band)
    for bound, band in rest:
        ladder = ladder.when(score >= bound, band)
    return ladder.otherwise("low")


def risk_top(risk: DataFrame, dimension: str, limit: int = TOP) -> DataFrame:
    known = risk.filter((F.col("dimension_type") == dimension) & ~F.col("is_unknown"))
    view = known.select("dimension_type", "dimension_value", "volume", "risk_score", "rank")
    return view.withColumn("band", risk_band(F.col("risk_score"))).orderBy("rank").limit(limit)


def severity_counts(recommendations: DataFrame) -> DataFrame:
    return recommendations.groupBy("severity").agg(F.count("*").alias("recommendations"))


def risk_dimensions(risk: DataFrame) -> DataFrame:
    return risk.select("dimension_type").distinct()


def newest_month(trends: DataFrame, index: DataFrame) -> DataFrame:
    """Records of the latest month of trends stored by ``year`` and ``month``.

    The published index names the month; joined to the folder names as one row, it prunes the
    folders that are read when the query runs.
    """
    newest = index.filter("record_count > 0").agg(F.max(F.struct("year", "month")).alias("m"))
    folder = newest.filter("m.month > 0").select("m.year", "m.month")
    return trends.join(F.broadcast(folder), ["year", "month"], "left_semi")
