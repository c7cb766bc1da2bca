"""Queries of the consumer views."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.operators import forecast, rollups
from faultline.plans import publish
from faultline.queries import frames
from faultline.queries.disk_queries import STORED_TRENDS, stored_trends
from faultline.queries.frames import advice, dashboard, risk_table, trends
from faultline.queries.registry import query
from faultline.session import new_run_dir
from faultline.sinks import payloads

SHARE = """CASE WHEN kpi_incidents > 0
    THEN (kpi_incidents - kpi_violations)::DOUBLE / kpi_incidents::DOUBLE * 100 END AS compliance_pct"""


def sums(*names):
    return ", ".join(f"CAST(coalesce(sum({n}), 0) AS BIGINT) AS {n}" for n in names)


@query("overview_sliced", "SELECT * FROM v_dashboard WHERE opened_year = 1997 AND priority_code = 2")
def overview_sliced(spark, sf_dir):
    return rollups.sliced(dashboard(spark, sf_dir), opened_year=1997, opened_month=None, priority_code=2)


@query(
    "trends_sliced",
    "SELECT * FROM v_trends WHERE year(date) = 1998 AND month(date) = 3 AND category = 'PROMO'",
)
def trends_sliced(spark, sf_dir):
    return rollups.trends_sliced(trends(spark, sf_dir), year=1998, month=3, category="PROMO", product="")


@query(
    "overview_totals",
    f"SELECT *, {SHARE} FROM (SELECT {sums('total_incidents', 'kpi_incidents', 'kpi_violations')} FROM v_dashboard)",
)
def overview_totals(spark, sf_dir):
    return rollups.overview_totals(dashboard(spark, sf_dir))


@query(
    "overview_monthly",
    f"SELECT opened_year, opened_month, {sums('total_incidents', 'kpi_incidents')} FROM v_dashboard GROUP BY ALL",
)
def overview_monthly(spark, sf_dir):
    return rollups.overview_monthly(dashboard(spark, sf_dir)).orderBy("opened_year", "opened_month")


@query(
    "overview_priority",
    f"""SELECT priority_code, min(priority_name) AS priority_name, {sums('total_incidents')}
        FROM v_dashboard GROUP BY priority_code""",
)
def overview_priority(spark, sf_dir):
    return rollups.overview_priority(dashboard(spark, sf_dir)).orderBy("priority_code")


def top_sql(label, view):
    return f"""SELECT {label} AS name, {sums('total_incidents')} FROM {view}
               GROUP BY 1 ORDER BY total_incidents DESC, name LIMIT 10"""


@query("top_teams", top_sql("coalesce(nullif(assigned_group, ''), 'Não informado')", "v_dashboard"))
def top_teams(spark, sf_dir):
    return rollups.top_teams(dashboard(spark, sf_dir))


@query("top_dimension", top_sql("coalesce(nullif(product, ''), 'Não informado')", "v_trends"))
def top_dimension(spark, sf_dir):
    return rollups.top_dimension(trends(spark, sf_dir), "product")


@query("top_priority", top_sql("priority_code || ' - ' || priority_name", "v_trends"))
def top_priority(spark, sf_dir):
    return rollups.top_dimension(trends(spark, sf_dir), "priority")


def trend_sql(key):
    weight = "CASE WHEN avg_duration_seconds IS NOT NULL THEN total_incidents END"
    exact = f"CAST(avg_duration_seconds AS DECIMAL(18, 2)) * CAST({weight} AS DECIMAL(18, 0))"
    columns = f"{key}, " if key else ""
    name = f"{key.rsplit(' ', 1)[-1]}, " if key else ""
    return f"""
        SELECT {name}total_incidents, kpi_incidents, kpi_violations, {SHARE},
               CASE WHEN weight > 0 THEN weighted / weight END AS avg_duration_seconds
        FROM (SELECT {columns}{sums('total_incidents', 'kpi_incidents', 'kpi_violations')},
                     CAST(sum({exact}) AS DOUBLE) AS weighted, CAST(sum({weight}) AS DOUBLE) AS weight
              FROM v_trends {'GROUP BY 1' if key else ''})"""


@query("trend_totals", trend_sql(""))
def trend_totals(spark, sf_dir):
    return rollups.trend_totals(trends(spark, sf_dir))


@query("trend_daily", trend_sql("date AS date"))
def trend_daily(spark, sf_dir):
    return rollups.trend_daily(trends(spark, sf_dir)).orderBy("date")


@query("trend_weekly", trend_sql("CAST(date_trunc('week', date) AS DATE) AS week_start"))
def trend_weekly(spark, sf_dir):
    return rollups.trend_weekly(trends(spark, sf_dir)).orderBy("week_start")


@query(
    "forecast_timeline",
    """SELECT date, actual_incidents, CAST(NULL AS BIGINT) AS predicted_incidents,
              CAST(NULL AS BIGINT) AS lower_bound, CAST(NULL AS BIGINT) AS upper_bound FROM v_history
       UNION ALL
       SELECT forecast_date, NULL, predicted_incidents, lower_bound, upper_bound FROM v_forecast""",
)
def forecast_timeline(spark, sf_dir):
    past = frames.stored_history(spark, sf_dir)
    return rollups.forecast_timeline(past, forecast.forecast_summary(past)).orderBy("date")


@query(
    "risk_top",
    """SELECT dimension_type, dimension_value, volume, risk_score, rank,
              CASE WHEN risk_score >= 50 THEN 'critical' WHEN risk_score >= 25 THEN 'high'
                   WHEN risk_score >= 10 THEN 'medium' ELSE 'low' END AS band
       FROM v_risk WHERE dimension_type = 'assigned_group' AND NOT is_unknown AND rank <= 10""",
)
def risk_top(spark, sf_dir):
    return rollups.risk_top(risk_table(spark, sf_dir), "assigned_group")


@query("rec_severity_counts", "SELECT severity, count(*) AS recommendations FROM v_recommendations GROUP BY severity")
def rec_severity_counts(spark, sf_dir):
    return rollups.severity_counts(advice(spark, sf_dir))


@query("rec_critical", "SELECT recommendation_id, rule_id, target FROM v_recommendations WHERE severity = 'CRITICAL'")
def rec_critical(spark, sf_dir):
    chosen = rollups.sliced(advice(spark, sf_dir), severity="CRITICAL")
    return chosen.select("recommendation_id", "rule_id", "target")


@query("risk_dimensions", "SELECT DISTINCT dimension_type FROM v_risk")
def risk_dimensions(spark, sf_dir):
    return rollups.risk_dimensions(risk_table(spark, sf_dir))


@query(
    "trends_default_month",
    """SELECT date, priority_code, product, category, assigned_group, total_incidents FROM v_trends
       WHERE date_trunc('month', date) = (SELECT date_trunc('month', max(date)) FROM v_trends)""",
)
def trends_default_month(spark, sf_dir):
    """The default view reads one stored month folder, which the join with the newest month picks."""
    folder, index = stored_trends(spark, sf_dir), new_run_dir(spark, "index")
    publish.partition_index(spark, folder, STORED_TRENDS).write.parquet(index)
    stored = payloads.read_trend_partitions(spark, folder, STORED_TRENDS)
    newest = rollups.newest_month(stored, spark.read.parquet(index))
    return newest.select("date", "priority_code", "product", "category", "assigned_group", "total_incidents")


@query(
    "trend_coverage",
    "SELECT min(date) AS first_day, max(date) AS last_day, count(DISTINCT date) AS days FROM v_trends",
)
def trend_coverage(spark, sf_dir):
    days = rollups.trend_daily(trends(spark, sf_dir))
    return days.agg(F.min("date").alias("first_day"), F.max("date").alias("last_day"), F.count("*").alias("days"))
