"""Queries of the workload comparison and the synthetic incidents."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from faultline.operators.aggregates import daily_cells_with_p95
from faultline.plans import workload
from faultline.plans.gold import gold_tables
from faultline.queries.frames import silver, stored_valid, valid
from faultline.queries.registry import query
from faultline.queries.sqlbase import VIEWS, rounded
from faultline.session import held, new_run_dir
from faultline.sources.synthetic import DUPLICATE_SHARE, synthetic_rows
from faultline.sources.testbed import table


@query(
    "table_fingerprint",
    """SELECT count(*) AS rows, CAST(sum(duration_seconds) AS BIGINT) AS duration_sum,
              CAST(sum(priority_code) AS BIGINT) AS priority_sum FROM v_valid""",
)
def table_fingerprint(spark, sf_dir):
    return workload.table_fingerprint(valid(spark, sf_dir))


GOLD_VIEWS = {
    "monthly_kpis": "v_monthly", "priority_summary": "v_priority", "team_summary": "v_team",
    "dashboard_summary": "v_dashboard", "daily_trends": "v_trends", "operational_kpi_summary": "v_operational",
    "annual_ola_summary": "v_annual", "risk_summary": "v_risk", "forecast_history": "v_history",
    "forecast_summary": "v_forecast", "recommendations": "v_recommendations",
}


@query(
    "output_counts",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {view}" for name, view in GOLD_VIEWS.items()
    ),
)
def output_counts(spark, sf_dir):
    rows = stored_valid(spark, sf_dir)
    with held(daily_cells_with_p95(rows)) as (cells,):
        cells.count()
        counts = new_run_dir(spark, "counts")
        workload.output_counts(gold_tables(rows, cells)).write.parquet(counts)
    return spark.read.parquet(counts)


VIEWS["v_samples"] = "SELECT priority_name AS profile, CAST(duration_seconds AS DOUBLE) AS v FROM v_silver"


@query(
    "bench_summary",
    f"""SELECT profile, min(v) AS minimum, {rounded("median(v)", 4)} AS median, quantile_disc(v, 0.95) AS p95,
               {rounded("avg(v)", 4)} AS mean, max(v) AS maximum, {rounded("stddev_pop(v)", 4)} AS stdev
        FROM v_samples GROUP BY profile""",
)
def bench_summary(spark, sf_dir):
    samples = silver(spark, sf_dir).select(F.col("priority_name").alias("profile"), "duration_seconds")
    return workload.summarize_samples(samples, "profile", "duration_seconds")


# Neighbouring teams of the alphabet are compared: a team is the baseline of one pair and the
# alternative of the next.  A run is a month's mean duration; the fingerprint counts the team's items.
VIEWS["v_runs"] = """
    SELECT assigned_group AS team, opened_year, opened_month, avg(duration_seconds) AS seconds
    FROM v_valid WHERE assigned_group IS NOT NULL GROUP BY ALL
"""
VIEWS["v_pairs"] = f"""
    SELECT team, items, priorities, years, b, lead(team) OVER w AS other, lead(items) OVER w AS other_items,
           lead(priorities) OVER w AS other_priorities, lead(years) OVER w AS other_years, lead(b) OVER w AS o
    FROM (SELECT team, {rounded("median(seconds)", 4)} AS b FROM v_runs GROUP BY team)
    JOIN (SELECT assigned_group AS team, count(DISTINCT configuration_item) AS items,
                 count(DISTINCT priority_code) AS priorities, count(DISTINCT opened_year) AS years
          FROM v_valid GROUP BY ALL) USING (team)
    WINDOW w AS (ORDER BY team)
"""
LEAST_IMPROVEMENT = 0.25


def measured_runs(spark, sf_dir):
    """(comparison, profile, total_seconds, fingerprint) of the months of all neighbouring teams."""
    rows = stored_valid(spark, sf_dir).filter("assigned_group IS NOT NULL").withColumnRenamed("assigned_group", "team")
    runs = rows.groupBy("team", "opened_year", "opened_month").agg(F.avg("duration_seconds").alias("total_seconds"))
    prints = rows.groupBy("team").agg(
        F.countDistinct("configuration_item").alias("rows"), F.countDistinct("priority_code").alias("duration_sum"),
        F.countDistinct("opened_year").alias("priority_sum"),
    )
    # One row per team.
    before = prints.withColumn("previous", F.lag("team").over(Window.orderBy("team")))
    roles = F.array(
        F.struct(F.col("team").alias("comparison"), F.lit("baseline").alias("profile")),
        F.struct(F.col("previous").alias("comparison"), F.lit("optimized").alias("profile")),
    )
    sides = before.select("team", *workload.FINGERPRINT, F.inline(roles)).filter("comparison IS NOT NULL")
    return runs.join(sides, "team").select("comparison", "profile", "total_seconds", *workload.FINGERPRINT)


@query(
    "bench_compare",
    f"""SELECT team AS comparison, CASE WHEN same THEN 'MATCH' ELSE 'MISMATCH' END AS correctness_status,
               CAST({LEAST_IMPROVEMENT} AS DOUBLE) AS minimum_improvement_pct,
               {rounded("(b - o) / b * 100")} AS median_improvement_pct, {rounded("b / o", 3)} AS speedup,
               CASE WHEN NOT same THEN 'REJECT_OPTIMIZATION' WHEN (b - o) / b * 100 >= {LEAST_IMPROVEMENT}
                    THEN 'ADOPT_OPTIMIZED_PROFILE' ELSE 'KEEP_BASELINE_AND_RETEST' END AS recommendation
        FROM (SELECT *, items = other_items AND priorities = other_priorities AND years = other_years AS same
              FROM v_pairs WHERE other IS NOT NULL)""",
)
def bench_compare(spark, sf_dir):
    summary = workload.summarize_profiles(measured_runs(spark, sf_dir), ["comparison"])
    return workload.compare_profiles(summary, "baseline", "optimized", LEAST_IMPROVEMENT, ["comparison"])


VIEWS["v_synthetic"] = f"""
    SELECT id, CAST(id % 5 + 1 AS INTEGER) AS code, id * 97 % 200000 + 600 AS seconds,
           make_timestamp((1672531200 + id * 3601 % 94608000) * 1000000) AS opened,
           id % (n - greatest(1, n // {DUPLICATE_SHARE})) + 1 AS number
    FROM (SELECT o_orderkey AS id, (SELECT count(*) FROM orders) AS n FROM orders)
"""


@query(
    "synthetic_incidents",
    """SELECT printf('INC%07d', number) AS incident_id,
              code || ' - ' || ['Crítica', 'Alta', 'Média', 'Baixa', 'Muito Baixa'][code] AS priority,
              'Produto' || id % 12 AS product, 'Categoria' || id % 18 AS category, 'Subcategoria' || id % 24 AS subcategory,
              'Team' || lpad(CAST(id % 17 + 1 AS VARCHAR), 2, '0') AS assigned_group, 'CI-' || id % 30 AS configuration_item,
              strftime(opened, '%Y-%m-%d %H:%M:%S') AS opened_at,
              strftime(opened + to_seconds(seconds), '%Y-%m-%d %H:%M:%S') AS closed_at,
              CAST(seconds AS VARCHAR) AS duration_seconds,
              CASE WHEN id % 3 = 0 THEN 'Monitoramento' ELSE 'Manual' END AS opened_by,
              CASE WHEN code <= 3 THEN 'SIM' ELSE 'NAO' END AS entered_kpi,
              CASE WHEN code <= 3 AND seconds > 14400 THEN 'SIM' ELSE 'NAO' END AS kpi_violated
       FROM v_synthetic""",
)
def synthetic_incidents(spark, sf_dir):
    """The generator driven by the order numbers, so its size follows the table."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    total = orders.agg(F.count("*").alias("n")).scalar()
    distinct = total - F.greatest(F.lit(1), F.floor(total / DUPLICATE_SHARE))
    raw = synthetic_rows(orders, distinct)
    return raw.select(
        F.col("Número").alias("incident_id"), F.col("Prioridade").alias("priority"), F.col("Produto").alias("product"),
        F.col("Categoria").alias("category"), F.col("Subcategoria").alias("subcategory"),
        F.col("Grupo designado").alias("assigned_group"), F.col("Item de configuração").alias("configuration_item"),
        F.col("Aberto").alias("opened_at"), F.col("Encerrado").alias("closed_at"),
        F.col("Duração").alias("duration_seconds"), F.col("Aberto por").alias("opened_by"),
        F.col("`Entrou para KPI?`").alias("entered_kpi"), F.col("`KPI Violado?`").alias("kpi_violated"),
    )
