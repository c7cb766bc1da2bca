"""Queries over single cleaning, audit and quality operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.functions.text import fold_text
from faultline.operators import quality
from faultline.operators.clean import rename_source
from faultline.queries.frames import LINE_KEYS, cleaned, current, plain_time, raw, silver, typed, valid
from faultline.queries.registry import query
from faultline.schema import SOURCE_COLUMNS
from faultline.sources.testbed import VERSION_TIEBREAK

KEYS_SQL = "incident_id, batch_id, l_linenumber, l_partkey, l_suppkey, l_extendedprice"
TEXT_COLUMNS = tuple(SOURCE_COLUMNS.values())


def with_keys(df, *columns):
    keys = [F.col(old).alias(new) for old, new in LINE_KEYS.items()]
    return df.select("incident_id", *keys, *(c for c in columns if not (isinstance(c, str) and c == "incident_id")))


@query("rename_columns", f"SELECT {KEYS_SQL}, {', '.join(TEXT_COLUMNS[1:])} FROM v_raw")
def rename_columns(spark, sf_dir):
    return with_keys(rename_source(raw(spark, sf_dir)), *TEXT_COLUMNS)


@query("clean_strings", f"SELECT {KEYS_SQL}, {', '.join(TEXT_COLUMNS[1:])} FROM v_clean")
def clean_strings(spark, sf_dir):
    return with_keys(cleaned(spark, sf_dir), *TEXT_COLUMNS)


@query("parse_priority", f"SELECT {KEYS_SQL}, priority, priority_code, priority_name FROM v_typed")
def parse_priority(spark, sf_dir):
    return with_keys(typed(spark, sf_dir), "priority", "priority_code", "priority_name")


@query("parse_timestamps", f"SELECT {KEYS_SQL}, opened_at, resolved_at, closed_at FROM v_typed")
def parse_timestamps(spark, sf_dir):
    return with_keys(typed(spark, sf_dir), *map(plain_time, ("opened_at", "resolved_at", "closed_at")))


@query("parse_duration", f"SELECT {KEYS_SQL}, duration_seconds FROM v_typed")
def parse_duration(spark, sf_dir):
    return with_keys(typed(spark, sf_dir), "duration_seconds")


@query("decode_flags", f"SELECT {KEYS_SQL}, entered_kpi, kpi_violated FROM v_typed")
def decode_flags(spark, sf_dir):
    return with_keys(typed(spark, sf_dir), "entered_kpi", "kpi_violated")


@query("opened_parts", f"SELECT {KEYS_SQL}, opened_year, opened_month FROM v_typed")
def opened_parts(spark, sf_dir):
    return with_keys(typed(spark, sf_dir), "opened_year", "opened_month")


SILVER_SQL = (
    "priority, product, category, subcategory, assigned_group, configuration_item, opened_at, resolved_at, "
    "closed_at, duration_seconds, close_code, short_description, solution, opened_by, parent_incident_id, "
    "status, entered_kpi, kpi_violated, priority_code, priority_name, opened_year, opened_month, "
    "kpi_rule_version, kpi_limit_seconds, kpi_eligible_by_rule, kpi_violated_by_rule, kpi_rule_reason, "
    "entered_kpi_rule_matches_source, kpi_violated_rule_matches_source, dq_issues, dq_status"
)


def silver_columns():
    times = ("opened_at", "resolved_at", "closed_at")
    return [plain_time(c) if c in times else c for c in SILVER_SQL.split(", ")]


@query("silver_records", f"SELECT {KEYS_SQL}, {SILVER_SQL} FROM v_silver")
def silver_rows(spark, sf_dir):
    return with_keys(silver(spark, sf_dir), *silver_columns())


@query(
    "normalize_text",
    f"SELECT {KEYS_SQL}, status, "
    "regexp_replace(translate(upper(trim(status)), 'ÁÀÃÂÄÉÈÊËÍÌÎÏÓÒÕÔÖÚÙÛÜÇ', 'AAAAAEEEEIIIIOOOOOUUUUC'), "
    "'\\s+', ' ', 'g') AS status_folded FROM v_clean",
)
def normalize_text(spark, sf_dir):
    return with_keys(cleaned(spark, sf_dir), "status", fold_text(F.col("status")).alias("status_folded"))


@query("sla_limit", f"SELECT {KEYS_SQL}, priority_code, kpi_limit_seconds FROM v_silver")
def sla_limit(spark, sf_dir):
    return with_keys(silver(spark, sf_dir), "priority_code", "kpi_limit_seconds")


@query("sla_eligibility", f"SELECT {KEYS_SQL}, kpi_eligible_by_rule FROM v_silver")
def sla_eligibility(spark, sf_dir):
    return with_keys(silver(spark, sf_dir), "kpi_eligible_by_rule")


@query("sla_violation", f"SELECT {KEYS_SQL}, kpi_violated_by_rule FROM v_silver")
def sla_violation(spark, sf_dir):
    return with_keys(silver(spark, sf_dir), "kpi_violated_by_rule")


@query("sla_reason", f"SELECT {KEYS_SQL}, kpi_rule_reason FROM v_silver")
def sla_reason(spark, sf_dir):
    return with_keys(silver(spark, sf_dir), "kpi_rule_reason")


MATCHES = ("entered_kpi_rule_matches_source", "kpi_violated_rule_matches_source")
AUDIT = (
    "kpi_rule_version", "kpi_limit_seconds", "kpi_eligible_by_rule", "kpi_violated_by_rule", "kpi_rule_reason",
    *MATCHES,
)


@query("sla_source_match", f"SELECT {KEYS_SQL}, {', '.join(MATCHES)} FROM v_silver")
def sla_source_match(spark, sf_dir):
    return with_keys(silver(spark, sf_dir), *MATCHES)


@query("sla_audit", f"SELECT {KEYS_SQL}, {', '.join(AUDIT)} FROM v_silver")
def sla_audit(spark, sf_dir):
    return with_keys(silver(spark, sf_dir), *AUDIT)


@query("dq_flags", f"SELECT {KEYS_SQL}, dq_issues FROM v_silver")
def dq_flags(spark, sf_dir):
    return with_keys(silver(spark, sf_dir), "dq_issues")


@query("dq_status", f"SELECT {KEYS_SQL}, dq_issues, dq_status FROM v_silver")
def dq_status(spark, sf_dir):
    return with_keys(silver(spark, sf_dir), "dq_issues", "dq_status")


@query(
    "dq_profile",
    """SELECT (SELECT count(*) FROM v_silver) AS records_in,
              (SELECT count(*) FROM v_silver) - count(*) AS duplicates_removed,
              count(*) FILTER (WHERE dq_status = 'INVALID') AS invalid_records
       FROM v_latest""",
)
def dq_profile(spark, sf_dir):
    return quality.quality_profile(silver(spark, sf_dir), VERSION_TIEBREAK)


@query("dedup_latest", f"SELECT {KEYS_SQL}, closed_at, dq_status FROM v_latest")
def dedup_latest(spark, sf_dir):
    return with_keys(current(spark, sf_dir), plain_time("closed_at"), "dq_status")


@query("valid_incidents", f"SELECT {KEYS_SQL}, dq_status FROM v_valid")
def valid_incidents(spark, sf_dir):
    return with_keys(valid(spark, sf_dir), "dq_status")


@query(
    "batch_dq_metrics",
    """SELECT batch_id, count(*) FILTER (WHERE dq_status = 'VALID') AS valid_records,
              count(*) FILTER (WHERE dq_status = 'INVALID') AS invalid_records
       FROM v_silver GROUP BY batch_id""",
)
def batch_dq_metrics(spark, sf_dir):
    return quality.batch_quality(silver(spark, sf_dir)).withColumnRenamed("_batch_id", "batch_id")
