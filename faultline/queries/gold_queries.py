"""Queries over the Gold tables and their building blocks."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.operators import aggregates, forecast, recommend, risk
from faultline.queries import frames
from faultline.queries.frames import valid
from faultline.queries.registry import query
from faultline.queries.sqlbase import finished


@query("monthly_kpis", "SELECT * FROM v_monthly")
def monthly_kpis(spark, sf_dir):
    return aggregates.monthly_kpis(valid(spark, sf_dir))


@query("priority_summary", "SELECT * FROM v_priority")
def priority_summary(spark, sf_dir):
    return aggregates.priority_summary(valid(spark, sf_dir))


@query("team_summary", "SELECT * FROM v_team")
def team_summary(spark, sf_dir):
    return aggregates.team_summary(valid(spark, sf_dir))


@query("dashboard_summary", "SELECT * FROM v_dashboard")
def dashboard_summary(spark, sf_dir):
    return frames.dashboard(spark, sf_dir)


@query("operational_kpi_summary", "SELECT * FROM v_operational")
def operational_kpi_summary(spark, sf_dir):
    return aggregates.operational_kpi_summary(valid(spark, sf_dir))


@query("daily_trends", "SELECT * FROM v_trends")
def daily_trends(spark, sf_dir):
    return frames.trends(spark, sf_dir)


@query("annual_ola", "SELECT * FROM v_annual")
def annual_ola(spark, sf_dir):
    return frames.annual(spark, sf_dir)


@query(
    "annual_attainment",
    """SELECT opened_year, priority_code, violation_target_attainment_pct, volume_target_attainment_pct
       FROM v_annual""",
)
def annual_attainment(spark, sf_dir):
    return frames.annual(spark, sf_dir).select(
        "opened_year", "priority_code", "violation_target_attainment_pct", "volume_target_attainment_pct"
    )


@query("risk_aggregate", "SELECT * FROM v_risk_base")
def risk_aggregate(spark, sf_dir):
    return risk.risk_aggregate(valid(spark, sf_dir))


@query("risk_normalized", "SELECT * FROM v_risk_scaled")
def risk_normalized(spark, sf_dir):
    return risk.risk_aggregate(valid(spark, sf_dir)).transform(risk.add_components)


@query("risk_scores", "SELECT * FROM v_risk_scored")
def risk_scores(spark, sf_dir):
    return risk.risk_scores(valid(spark, sf_dir))


@query("risk_ranked", "SELECT dimension_type, dimension_value, is_unknown, risk_score, rank FROM v_risk")
def risk_ranked(spark, sf_dir):
    scored = risk.risk_scores(valid(spark, sf_dir))
    return risk.add_rank(scored).select("dimension_type", "dimension_value", "is_unknown", "risk_score", "rank")


@query("risk_summary", "SELECT * FROM v_risk")
def risk_summary(spark, sf_dir):
    return frames.risk_table(spark, sf_dir).orderBy(*risk.risk_order())


@query("forecast_scope", "SELECT incident_id, priority_code, opened_at FROM v_valid WHERE priority_code IN (1, 2, 3)")
def forecast_scope(spark, sf_dir):
    scoped = forecast.in_scope(valid(spark, sf_dir))
    return scoped.select("incident_id", "priority_code", frames.plain_time("opened_at"))


@query(
    "forecast_bounds",
    "SELECT CAST(max(d) - INTERVAL 27 DAY AS DATE) AS history_start_date, max(d) AS history_end_date FROM v_scope",
)
def forecast_bounds(spark, sf_dir):
    return forecast.history_bounds(valid(spark, sf_dir)).drop("by_day")


@query("forecast_history", "SELECT * FROM v_history")
def forecast_history(spark, sf_dir):
    return frames.history(spark, sf_dir).orderBy("date")


@query(
    "forecast_stats",
    """SELECT history_start_date, history_end_date, round(recent_average, 6) AS recent_average,
              round(history_stddev, 6) AS history_stddev FROM v_stats""",
)
def forecast_stats(spark, sf_dir):
    return forecast.history_statistics(frames.history(spark, sf_dir)).select(
        "history_start_date",
        "history_end_date",
        F.round("recent_average", 6).alias("recent_average"),
        F.round("history_stddev", 6).alias("history_stddev"),
    )


@query("weekday_profile", "SELECT * FROM v_weekday")
def weekday_profile(spark, sf_dir):
    return forecast.weekday_profile(forecast.history_statistics(frames.history(spark, sf_dir)))


@query("forecast_summary", "SELECT * FROM v_forecast")
def forecast_summary(spark, sf_dir):
    return frames.outlook(spark, sf_dir).orderBy("horizon_day")


@query("rec_risk_score", finished("v_rec_score"))
def rec_risk_score(spark, sf_dir):
    return recommend.from_risk(frames.risk_table(spark, sf_dir), ["RISK_SCORE_HIGH"])


@query("rec_violation_rate", finished("v_rec_rate"))
def rec_violation_rate(spark, sf_dir):
    return recommend.from_risk(frames.risk_table(spark, sf_dir), ["KPI_VIOLATION_RATE_HIGH"])


@query("rec_volume_concentration", finished("v_rec_volume"))
def rec_volume_concentration(spark, sf_dir):
    return recommend.from_risk(frames.risk_table(spark, sf_dir), ["VOLUME_CONCENTRATION"])


@query("rec_compliance", finished("v_rec_compliance"))
def rec_compliance(spark, sf_dir):
    return recommend.from_targets(frames.annual(spark, sf_dir))


@query("rec_forecast_growth", finished("v_rec_growth"))
def rec_forecast_growth(spark, sf_dir):
    past = frames.stored_history(spark, sf_dir)
    return recommend.from_forecast(forecast.forecast_summary(past), past)


@query("recommendations", "SELECT * FROM v_recommendations")
def recommendations(spark, sf_dir):
    return frames.advice(spark, sf_dir).orderBy(*recommend.recommendation_order())


@query(
    "report_top_teams",
    "SELECT * FROM v_team ORDER BY total_incidents DESC, assigned_group LIMIT 10",
)
def report_top_teams(spark, sf_dir):
    teams = aggregates.team_summary(valid(spark, sf_dir))
    return teams.orderBy(F.desc("total_incidents"), F.asc_nulls_last("assigned_group")).limit(10)


@query("report_latest_months", "SELECT * FROM v_monthly ORDER BY opened_year DESC, opened_month DESC LIMIT 12")
def report_latest_months(spark, sf_dir):
    months = aggregates.monthly_kpis(valid(spark, sf_dir))
    return months.orderBy(F.desc("opened_year"), F.desc("opened_month")).limit(12)


@query(
    "report_top_risks",
    "SELECT dimension_type, dimension_value, risk_score, rank FROM v_risk WHERE rank <= 3",
)
def report_top_risks(spark, sf_dir):
    top = frames.risk_table(spark, sf_dir).filter("rank <= 3").orderBy(*risk.risk_order())
    return top.select("dimension_type", "dimension_value", "risk_score", "rank")


@query("gold_cells", f"""
    SELECT CAST(opened_at AS DATE) AS date, opened_year, opened_month, priority_code, priority_name, product, category,
           assigned_group, count(*) AS total_incidents, CAST(sum(duration_seconds) AS BIGINT) AS duration_sum,
           count(duration_seconds) AS duration_count,
           count(*) FILTER (WHERE kpi_violated_by_rule) AS calculated_kpi_violations
    FROM v_valid GROUP BY ALL""")
def gold_cells(spark, sf_dir):
    return aggregates.daily_cells(valid(spark, sf_dir)).select(
        *aggregates.CELL_KEYS, "total_incidents", "duration_sum", "duration_count", "calculated_kpi_violations"
    )
