"""Queries of published payloads, contracts, index, manifest and gates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline.operators import aggregates, contracts, forecast, risk
from faultline.plans import publish
from faultline.queries import frames
from faultline.queries.frames import advice, risk_table, trends, valid
from faultline.queries.registry import query
from faultline.queries.sqlbase import VIEWS
from faultline.sinks.payloads import in_export_order

MONTHS = "['Janeiro','Fevereiro','Março','Abril','Maio','Junho','Julho','Agosto','Setembro','Outubro','Novembro','Dezembro']"
NO_CODE = "CAST(NULL AS INTEGER)"
VIEWS["v_options"] = f"""
    SELECT 'year' AS kind, opened_year AS code, CAST(opened_year AS VARCHAR) AS label FROM v_dashboard
    UNION SELECT 'month', opened_month, {MONTHS}[opened_month] FROM v_dashboard
    UNION SELECT 'priority', priority_code, priority_name FROM v_dashboard
          WHERE priority_code IS NOT NULL AND priority_name IS NOT NULL
    UNION SELECT 'product', {NO_CODE}, trim(product) FROM v_trends WHERE trim(product) <> ''
    UNION SELECT 'category', {NO_CODE}, trim(category) FROM v_trends WHERE trim(category) <> ''
    UNION SELECT 'team', {NO_CODE}, trim(assigned_group) FROM v_trends WHERE trim(assigned_group) <> ''
"""
BAD_DATE = "(NOT regexp_full_match(date, '\\d{4}-\\d{2}-\\d{2}') OR TRY_CAST(date AS DATE) IS NULL)"
VIEWS["v_trend_payload"] = """
    SELECT strftime(date, '%Y-%m-%d') AS date, priority_code, priority_name, product, category, assigned_group,
           total_incidents, kpi_incidents, kpi_violations, avg_duration_seconds, p95_duration_seconds FROM v_trends
"""


def options_from(cells):
    return publish.filter_options(aggregates.dashboard_summary(cells), aggregates.daily_trends_from_cells(cells))


@query("filter_options", "SELECT * FROM v_options")
def filter_options(spark, sf_dir):
    return options_from(frames.stored_cells(spark, sf_dir)).orderBy(*publish.option_order())


@query("export_monthly", "SELECT * FROM v_monthly ORDER BY opened_year, opened_month")
def export_monthly(spark, sf_dir):
    return in_export_order(aggregates.monthly_kpis(valid(spark, sf_dir)), "monthly_kpis")


@query("publish_trends", "SELECT * FROM v_trend_payload")
def publish_trends(spark, sf_dir):
    return publish.trends_payload(trends(spark, sf_dir)).orderBy(*publish.trends_order())


@query(
    "publish_risk",
    """SELECT dimension_type, dimension_value, is_unknown, volume, kpi_violation_rate_pct, avg_duration_seconds,
              risk_score, rank FROM v_risk""",
)
def publish_risk(spark, sf_dir):
    return publish.risk_payload(risk_table(spark, sf_dir).orderBy(*publish.risk_order()))


@query(
    "publish_forecast",
    """SELECT 'weighted_explainable_baseline' AS method, '1.0' AS method_version,
              max(scope_description) AS scope_description, max(scope_priority_codes) AS scope_codes,
              max(forecast_d1) AS forecast_d1, max(forecast_d7) AS forecast_d7, max(risk_range) AS risk_range,
              (SELECT string_agg(strftime(date, '%Y-%m-%d') || '=' || actual_incidents, ';' ORDER BY date) FROM v_history)
                AS history,
              string_agg(strftime(forecast_date, '%Y-%m-%d') || '=' || predicted_incidents || ' [' || lower_bound || '..'
                || upper_bound || ']', ';' ORDER BY horizon_day) AS forecast
       FROM v_forecast""",
)
def publish_forecast(spark, sf_dir):
    past = frames.stored_history(spark, sf_dir)
    document = publish.forecast_document(past, forecast.forecast_summary(past))

    def day_text(d):
        return F.concat_ws("=", d["date"], d["actual_incidents"].cast("string"))

    def outlook_text(d):
        return F.concat(
            d["date"], F.lit("="), d["predicted_incidents"].cast("string"), F.lit(" ["), d["lower_bound"].cast("string"),
            F.lit(".."), d["upper_bound"].cast("string"), F.lit("]"),
        )

    return document.select(
        "method", "method_version", "scope_description",
        F.array_join(F.col("scope_priority_codes").cast("array<string>"), ",").alias("scope_codes"),
        "forecast_d1", "forecast_d7", "risk_range",
        F.array_join(F.transform("history", day_text), ";").alias("history"),
        F.array_join(F.transform("forecast", outlook_text), ";").alias("forecast"),
    )


@query(
    "publish_recommendations",
    """SELECT recommendation_id, dimension_type, target, severity, title, recommendation, evidence, metric_name,
              metric_value, metric_unit FROM v_recommendations""",
)
def publish_recommendations(spark, sf_dir):
    rows = publish.recommendations_payload(advice(spark, sf_dir))
    return rows.orderBy(*publish.payload_order("recommendations"))


# Trend payload with planted defects, to see every kind of rule report something.
VIEWS["v_flawed"] = """
    SELECT CASE WHEN substr(date, 9, 2) = '17' THEN replace(date, '-', '/') WHEN substr(date, 9, 2) = '19'
             THEN substr(date, 1, 8) || '32' ELSE date END AS date,
           CASE WHEN substr(date, 9, 2) = '02' THEN 0 ELSE priority_code END AS priority_code,
           CASE WHEN substr(date, 9, 2) = '01' AND priority_code = 5 THEN '' ELSE priority_name END AS priority_name,
           CASE WHEN substr(date, 9, 2) = '03' THEN '' ELSE product END AS product, category, assigned_group,
           CASE WHEN substr(date, 9, 2) = '13' THEN -total_incidents ELSE total_incidents END AS total_incidents,
           kpi_incidents, CASE WHEN substr(date, 9, 2) = '21' THEN NULL ELSE kpi_violations END AS kpi_violations,
           avg_duration_seconds, p95_duration_seconds
    FROM v_trend_payload
"""


def flawed_trends(spark, sf_dir) -> DataFrame:
    return with_flaws(publish.trends_payload(trends(spark, sf_dir)))


def with_flaws(payload: DataFrame) -> DataFrame:
    day = F.substring("date", 9, 2)
    slashed, no_day = F.replace("date", F.lit("-"), F.lit("/")), F.concat(F.substring("date", 1, 8), F.lit("32"))
    return payload.withColumns(
        {
            "date": F.when(day == "17", slashed).when(day == "19", no_day).otherwise(F.col("date")),
            "priority_name": F.when((day == "01") & (F.col("priority_code") == 5), "").otherwise(F.col("priority_name")),
            "priority_code": F.when(day == "02", 0).otherwise(F.col("priority_code")),
            "product": F.when(day == "03", "").otherwise(F.col("product")),
            "total_incidents": F.when(day == "13", -F.col("total_incidents")).otherwise(F.col("total_incidents")),
            "kpi_violations": F.when(day != "21", F.col("kpi_violations")),
        }
    )


@query(
    "contract_violations",
    f"""SELECT 'daily_trends' AS table_name, column_name, rule, violations FROM (
           SELECT 'date' AS column_name, 'date_format' AS rule, count(*) AS violations FROM v_flawed WHERE {BAD_DATE}
           UNION ALL SELECT 'priority_code' AS column_name, 'minimum' AS rule, count(*) AS violations FROM v_flawed
             WHERE priority_code < 1
           UNION ALL SELECT 'priority_name', 'min_length', count(*) FROM v_flawed WHERE length(priority_name) < 1
           UNION ALL SELECT 'product', 'min_length', count(*) FROM v_flawed WHERE length(product) < 1
           UNION ALL SELECT 'total_incidents', 'minimum', count(*) FROM v_flawed WHERE total_incidents < 0
           UNION ALL SELECT 'kpi_violations', 'required', count(*) FROM v_flawed WHERE kpi_violations IS NULL)
       WHERE violations > 0""",
)
def contract_violations(spark, sf_dir):
    return contracts.contract_violations(flawed_trends(spark, sf_dir), "daily_trends")


@query(
    "contract_report",
    f"""SELECT date, priority_code, product, category, assigned_group, broken_rules,
              greatest((count(*) OVER ()) - 10, 0) AS not_shown
       FROM (SELECT *, concat_ws('|',
                 CASE WHEN {BAD_DATE} THEN 'date:date_format' END,
                 CASE WHEN priority_code < 1 THEN 'priority_code:minimum' END,
                 CASE WHEN length(priority_name) < 1 THEN 'priority_name:min_length' END,
                 CASE WHEN length(product) < 1 THEN 'product:min_length' END,
                 CASE WHEN total_incidents < 0 THEN 'total_incidents:minimum' END,
                 CASE WHEN kpi_violations IS NULL THEN 'kpi_violations:required' END) AS broken_rules FROM v_flawed)
       WHERE broken_rules <> ''
       ORDER BY date, priority_code, product NULLS FIRST, category NULLS FIRST, assigned_group NULLS FIRST LIMIT 10""",
)
def contract_report(spark, sf_dir):
    report = contracts.violation_report(flawed_trends(spark, sf_dir), "daily_trends", publish.trends_order())
    return report.select(*publish.trends_order(), "broken_rules", "not_shown")


def payload_tables(spark, sf_dir) -> dict[str, DataFrame]:
    cells = frames.stored_cells(spark, sf_dir)
    past = forecast.forecast_history(cells)
    return {
        "filter_options": options_from(cells),
        "daily_trends": publish.trends_payload(aggregates.daily_trends_from_cells(cells)),
        "risk_summary": publish.risk_payload(risk.risk_summary(cells)),
        "forecast": publish.forecast_rows_payload(forecast.forecast_summary(past)),
        "recommendations": publish.recommendations_payload(frames.advice_from(cells)),
    }


@query(
    "contracts_clean",
    """SELECT 0 AS violations, count(*) AS payloads
       FROM (VALUES ('filter_options'), ('daily_trends'), ('risk_summary'), ('forecast'), ('recommendations')) t(name)
       WHERE (SELECT count(*) FROM v_trends WHERE total_incidents < 0) = 0""",
)
def contracts_clean(spark, sf_dir):
    """All payloads as they are published keep their contracts."""
    parts = [contracts.contract_outcomes(df, name) for name, df in payload_tables(spark, sf_dir).items()]
    return reduce(DataFrame.unionByName, parts).agg(
        F.sum("violations").cast("int").alias("violations"), F.countDistinct("table_name").alias("payloads")
    )


VIEWS["v_items"] = """
    SELECT 'filter_options' AS name, count(*) AS item_count FROM v_options
    UNION ALL SELECT 'daily_trends', count(*) FROM v_trends
    UNION ALL SELECT 'risk_summary', count(*) FROM v_risk
    UNION ALL SELECT 'forecast', count(*) FROM v_forecast
    UNION ALL SELECT 'recommendations', count(*) FROM v_recommendations
"""


@query("item_counts", "SELECT * FROM v_items")
def item_counts(spark, sf_dir):
    return publish.item_counts(payload_tables(spark, sf_dir))


@query(
    "partition_index",
    """SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, count(*) AS record_count
       FROM v_trends GROUP BY ALL""",
)
def partition_index(spark, sf_dir):
    return publish.partition_counts(trends(spark, sf_dir))


# The two manifests of the drift query: fields by name, as text, and their heads under a null name.
DRIFT_FIELDS = {
    "path": "'risk/' || dimension_type",
    "schema_path": "'contracts/risk_summary'",
    "contract_status": "CASE WHEN max(risk_score) >= 75 THEN 'INVALID' ELSE 'VALID' END",
    "schema_version": "'1.0'",
    "data_generated_at": "CAST(max(volume) AS VARCHAR)",
    "mock": "CASE WHEN min(risk_score) < 1 THEN 'true' ELSE 'false' END",
    "item_count": "CAST(count(*) AS VARCHAR)",
    "item_count_source": "'items'",
    "size_bytes": "CAST(CAST(sum(length(dimension_value)) AS BIGINT) AS VARCHAR)",
    "sha256": "sha256(max(dimension_value))",
}
RECORDED = "FROM v_risk WHERE dimension_type <> 'product' GROUP BY dimension_type"
LATER = "FROM v_risk WHERE dimension_type <> 'priority' AND risk_score >= 20 GROUP BY dimension_type"


def drift_side(rows: str, order: str, time: str) -> str:
    """Entries and head of one manifest as (name, field, value)."""
    columns = ", ".join(f"{sql} AS {name}" for name, sql in DRIFT_FIELDS.items())
    placed = f"SELECT dimension_type AS name, {columns}, CAST(row_number() OVER (ORDER BY dimension_type {order}) AS VARCHAR) AS position {rows}"
    healthy = "count(*) FILTER (contract_status = 'VALID')"
    return f"""
        SELECT name, field, value FROM (UNPIVOT ({placed}) ON COLUMNS(* EXCLUDE name) INTO NAME field VALUE value)
        UNION ALL SELECT NULL, field, value FROM (UNPIVOT (
            SELECT '1.0' AS schema_version, '{time}' AS generated_at, CAST(count(*) AS VARCHAR) AS files_total,
                   CASE WHEN {healthy} = count(*) THEN 'HEALTHY' ELSE 'UNHEALTHY' END AS status,
                   CAST({healthy} AS VARCHAR) AS files_valid, CAST(bool_or(mock = 'true') AS VARCHAR) AS contains_mock_data
            FROM ({placed})) ON COLUMNS(*) INTO NAME field VALUE value)"""


@query(
    "manifest_drift",
    f"""SELECT * FROM (WITH e AS ({drift_side(RECORDED, 'ASC', 'first')}), a AS ({drift_side(LATER, 'DESC', 'second')}),
        one AS (SELECT coalesce(e.name, a.name) AS name, CASE WHEN e.name IS NULL THEN 'present' END AS actual,
                       CASE WHEN a.name IS NULL THEN 'present' END AS expected
                FROM (SELECT DISTINCT name FROM e WHERE name IS NOT NULL) e
                FULL JOIN (SELECT DISTINCT name FROM a WHERE name IS NOT NULL) a ON e.name = a.name
                WHERE e.name IS NULL OR a.name IS NULL)
        SELECT name, 'entry' AS field, expected, actual FROM one
        UNION ALL
        SELECT e.name, e.field, e.value, a.value
        FROM e JOIN a ON e.name IS NOT DISTINCT FROM a.name AND e.field = a.field WHERE e.value IS DISTINCT FROM a.value)""",
)
def manifest_drift(spark, sf_dir):
    """A recorded manifest against a later one: other, missing and new entries, another order, another head."""
    ranked = risk_table(spark, sf_dir)

    def manifest(df, order):
        entries = df.groupBy(F.col("dimension_type").alias("name")).agg(
            F.max("risk_score").alias("worst"), F.min("risk_score").alias("least"), F.max("volume").alias("volume"),
            F.count("*").alias("item_count"), F.sum(F.length("dimension_value")).alias("size_bytes"),
            F.sha2(F.max("dimension_value"), 256).alias("sha256"),
        )
        return entries.select(
            "name", F.concat(F.lit("risk/"), "name").alias("path"), F.lit("contracts/risk_summary").alias("schema_path"),
            F.when(F.col("worst") >= 75, "INVALID").otherwise("VALID").alias("contract_status"),
            F.lit(publish.SCHEMA_VERSION).alias("schema_version"), F.col("volume").cast("string").alias("data_generated_at"),
            (F.col("least") < 1).alias("mock"), "item_count", F.lit("items").alias("item_count_source"), "size_bytes", "sha256",
            F.row_number().over(Window.orderBy(order)).alias("position"),
        )

    recorded = manifest(ranked.filter("dimension_type <> 'product'"), F.asc("name"))
    later = manifest(ranked.filter("dimension_type <> 'priority' AND risk_score >= 20"), F.desc("name"))
    heads = publish.manifest_head(recorded, "first"), publish.manifest_head(later, "second")
    return publish.manifest_drift(recorded, later, heads=heads)


def gate_entries(spark, sf_dir) -> DataFrame:
    """Manifest rows of one clean and one flawed payload, dated by their newest record with a readable day."""
    clean = publish.trends_payload(aggregates.daily_trends_from_cells(frames.stored_cells(spark, sf_dir)))
    parts = []
    for name, df in (("daily_trends", clean), ("flawed_trends", with_flaws(clean))):
        broken = contracts.contract_outcomes(df, "daily_trends").agg(F.sum("violations")).scalar()
        parts.append(
            df.agg(F.max(contracts.dated(F.col("date"))).alias("data_generated_at")).select(
                F.lit(name).alias("name"),
                F.when(broken == 0, "VALID").otherwise("INVALID").alias("contract_status"),
                F.lit(False).alias("mock"),
                "data_generated_at",
            )
        )
    return parts[0].unionByName(parts[1])


VIEWS["v_flaws"] = f"""
    SELECT count(*) AS flaws FROM v_flawed
    WHERE priority_code < 1 OR length(priority_name) < 1 OR length(product) < 1 OR total_incidents < 0
          OR kpi_violations IS NULL OR {BAD_DATE}
"""


@query(
    "publication_gate",
    """SELECT CASE WHEN flaws = 0 THEN 'HEALTHY' ELSE 'UNHEALTHY' END AS status, CAST(2 AS BIGINT) AS files_total,
              CAST(CASE WHEN flaws = 0 THEN 2 ELSE 1 END AS BIGINT) AS files_valid, false AS contains_mock_data,
              flaws = 0 AS publishable FROM v_flaws""",
)
def publication_gate(spark, sf_dir):
    return publish.publication_gate(gate_entries(spark, sf_dir))


@query("publication_freshness", "SELECT strftime(max(date), '%Y-%m-%d') AS latest_data_at FROM v_trends")
def publication_freshness(spark, sf_dir):
    return publish.freshness(gate_entries(spark, sf_dir))


@query(
    "risk_methodology",
    """SELECT dimension_type, 'weighted_operational_risk' AS name, '1.0' AS version, '0-100' AS score_scale,
              CAST(0.45 AS DOUBLE) AS volume, CAST(0.35 AS DOUBLE) AS kpi_violation_rate, CAST(0.2 AS DOUBLE) AS avg_duration,
              count(*) AS items, count(rank) AS ranked, max(risk_score) AS top_score FROM v_risk GROUP BY dimension_type""",
)
def risk_methodology(spark, sf_dir):
    return publish.risk_methodology(risk_table(spark, sf_dir))
