"""Column names and schemas of the tables the engine reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

# Header of the incident extract -> column name used from Silver onwards.
SOURCE_COLUMNS = {
    "Número": "incident_id",
    "Prioridade": "priority",
    "Produto": "product",
    "Categoria": "category",
    "Subcategoria": "subcategory",
    "Grupo designado": "assigned_group",
    "Item de configuração": "configuration_item",
    "Aberto": "opened_at",
    "Resolvido": "resolved_at",
    "Encerrado": "closed_at",
    "Duração": "duration_seconds",
    "Código de fechamento": "close_code",
    "Descrição resumida": "short_description",
    "Solução": "solution",
    "Aberto por": "opened_by",
    "Incidente Pai": "parent_incident_id",
    "Status": "status",
    "Entrou para KPI?": "entered_kpi",
    "KPI Violado?": "kpi_violated",
}

RAW_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in SOURCE_COLUMNS])

# One row per (layer, batch, attempt); measures a layer does not have stay null.
LEDGER_SCHEMA = (
    """
    layer string, batch_id string, status string, source_file string, file_hash string,
    records_written bigint, records_received bigint, valid_records_received bigint,
    invalid_records_received bigint, silver_total_records bigint,
    quarantine_total_records bigint, gold_snapshot_records bigint,
    error string, processed_at timestamp
    """
)

RUN_SCHEMA = (
    "run_id string, status string, started_at timestamp, finished_at timestamp, "
    "stages array<struct<name:string,status:string>>, landing_files bigint, "
    "bronze_batches bigint, bronze_records bigint, silver_batches bigint, silver_records bigint, "
    "quarantine_records bigint, gold_batches bigint, gold_records bigint"
)

RISK_DIMENSIONS = {
    "priority": "priority_name",
    "product": "product",
    "category": "category",
    "assigned_group": "assigned_group",
}

GOLD_TABLES = (
    "monthly_kpis",
    "priority_summary",
    "team_summary",
    "dashboard_summary",
    "daily_trends",
    "operational_kpi_summary",
    "annual_ola_summary",
    "risk_summary",
    "forecast_history",
    "forecast_summary",
    "recommendations",
)
