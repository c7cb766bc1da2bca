"""Seven-day volume forecast from a dense 28-day history.

Incidents are read once and counted by day in the map tasks; the newest days, at most as many as
the history holds, are then one row.  Calendar, statistics, weekday profile and horizon are array
expressions on that row, without joins and without a second look at the incidents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.config import FORECAST, ForecastPolicy
from faultline.operators.aggregates import are_cells, count_of


def in_scope(df: DataFrame, policy: ForecastPolicy = FORECAST) -> DataFrame:
    day = "date" if are_cells(df) else "opened_at"
    return df.filter(F.col("priority_code").isin(*policy.priorities) & F.col(day).isNotNull())


def daily_counts(df: DataFrame, policy: ForecastPolicy = FORECAST) -> DataFrame:
    """Incidents per day, newest days only: at most ``history_days`` rows, perhaps some too old."""
    scoped = in_scope(df, policy)
    if not are_cells(df):
        scoped = scoped.withColumn("date", F.to_date("opened_at"))
    by_day = scoped.groupBy("date").agg(count_of(df, "total_incidents", "actual_incidents"))
    return by_day.orderBy(F.desc("date")).limit(policy.history_days)


def history_bounds(df: DataFrame, policy: ForecastPolicy = FORECAST) -> DataFrame:
    """One row with the window and its counts by day; the dates are null when nothing is in scope."""
    return daily_counts(df, policy).agg(
        F.date_sub(F.max("date"), policy.history_days - 1).alias("history_start_date"),
        F.max("date").alias("history_end_date"),
        F.map_from_entries(F.collect_list(F.struct("date", "actual_incidents"))).alias("by_day"),
    )


def forecast_history(df: DataFrame, policy: ForecastPolicy = FORECAST) -> DataFrame:
    """One row per day of the window, zero where nothing was opened; empty without data."""
    window = history_bounds(df, policy).filter(F.col("history_end_date").isNotNull())
    days = window.withColumn("date", F.explode(F.sequence("history_start_date", "history_end_date")))
    return days.select(
        "date",
        "history_start_date",
        "history_end_date",
        F.coalesce(F.try_element_at("by_day", F.col("date")), F.lit(0)).cast("bigint").alias("actual_incidents"),
        F.dayofweek("date").alias("day_of_week"),
        F.lit(policy.history_days).alias("history_days"),
        F.lit(policy.scope).alias("scope_description"),
        F.lit(policy.scope_codes).alias("scope_priority_codes"),
    )


def is_recent(policy: ForecastPolicy = FORECAST) -> Column:
    return F.datediff("history_end_date", "date") < policy.recent_days


def history_statistics(history: DataFrame, policy: ForecastPolicy = FORECAST) -> DataFrame:
    """One row: the window, the recent average, the spread and the average of every weekday met."""
    row = history.agg(
        F.max("history_start_date").alias("history_start_date"),
        F.max("history_end_date").alias("history_end_date"),
        F.avg(F.when(is_recent(policy), F.col("actual_incidents"))).alias("recent_average"),
        F.stddev_pop("actual_incidents").alias("history_stddev"),
        F.collect_list(F.struct("day_of_week", "actual_incidents")).alias("days"),
    )

    def average(weekday: Column) -> Column:
        same = F.filter("days", lambda day: day["day_of_week"] == weekday)
        total = F.aggregate(same, F.lit(0).cast("bigint"), lambda sum_, day: sum_ + day["actual_incidents"])
        mean = total / F.nullif(F.size(same), F.lit(0))
        return F.struct(weekday.alias("day_of_week"), mean.alias("same_weekday_average"))

    weekdays = F.array_distinct(F.transform("days", lambda day: day["day_of_week"]))
    return row.withColumn("profile", F.transform(weekdays, average)).drop("days")


def weekday_profile(statistics: DataFrame) -> DataFrame:
    """One row per weekday of the history."""
    return statistics.select(F.inline("profile"))


def forecast_summary(history: DataFrame, policy: ForecastPolicy = FORECAST) -> DataFrame:
    """Horizon rows with bounds and totals; no rows for an empty history."""
    stats = history_statistics(history, policy).filter(F.col("history_end_date").isNotNull())

    def prediction(step: Column) -> Column:
        target = F.dayofweek(F.date_add("history_end_date", step))
        same = F.filter("profile", lambda entry: entry["day_of_week"] == target)
        weekday = F.try_element_at(same, F.lit(1))["same_weekday_average"]
        recent = F.coalesce(F.col("recent_average"), F.lit(0.0))
        blend = F.coalesce(weekday, recent) * policy.weekday_weight + recent * policy.recent_weight
        return F.greatest(F.round(blend, 0), F.lit(0.0)).cast("bigint")

    steps = F.sequence(F.lit(1), F.lit(policy.horizon_days))
    margin = F.greatest(F.round(F.coalesce(F.col("history_stddev"), F.lit(0.0)), 0), F.lit(0.0)).cast("bigint")
    rows = (
        stats.withColumn("predictions", F.transform(steps, prediction))
        .withColumns(
            {
                "risk_range": margin,
                "forecast_d1": F.element_at("predictions", 1),
                "forecast_d7": F.aggregate("predictions", F.lit(0).cast("bigint"), lambda acc, n: acc + n),
            }
        )
        .select("*", F.posexplode("predictions").alias("step", "predicted_incidents"))
        .withColumn("horizon_day", F.col("step") + 1)
    )
    return rows.select(
        F.date_add("history_end_date", F.col("horizon_day")).alias("forecast_date"),
        "horizon_day",
        "predicted_incidents",
        F.greatest(F.col("predicted_incidents") - F.col("risk_range"), F.lit(0).cast("bigint")).alias("lower_bound"),
        (F.col("predicted_incidents") + F.col("risk_range")).alias("upper_bound"),
        "forecast_d1",
        "forecast_d7",
        "risk_range",
        "history_start_date",
        "history_end_date",
        F.lit(policy.method).alias("method"),
        F.lit(policy.version).alias("method_version"),
        F.lit(policy.history_days).alias("history_days"),
        F.lit(policy.recent_days).alias("recent_days"),
        F.lit(policy.weekday_weight).alias("same_weekday_weight"),
        F.lit(policy.recent_weight).alias("recent_average_weight"),
        F.lit(policy.scope).alias("scope_description"),
        F.lit(policy.scope_codes).alias("scope_priority_codes"),
    )
