"""Cleaning, service-level audit, quality rules and version choice on hand-made rows."""

from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from faultline.config import SlaPolicy
from faultline.functions.text import fold_text, matches_folded, yes_no_flag
from faultline.operators import clean, quality, sla
from faultline.plans.silver import current_records, silver_records
from faultline.schema import RAW_SCHEMA, SOURCE_COLUMNS

TYPED = (
    "priority string, opened_at string, resolved_at string, closed_at string, duration_seconds string, "
    "entered_kpi string, kpi_violated string, product string"
)


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_rename_ignores_missing_columns(spark):
    df = spark.createDataFrame([("INC1", "x")], "`Número` string, other string")
    assert clean.rename_source(df).columns == ["incident_id", "other"]


def test_strip_trims_spaces_only_and_skips_lineage(spark):
    df = spark.createDataFrame([("  a ", "   ", "\tb", " keep ")], "a string, b string, c string, _d string")
    assert tuple(one(clean.strip_blanks(df))) == ("a", None, "\tb", " keep ")


def test_typing(spark):
    row = ("3 - Média", "2026-01-01 10:00:00", None, "2026-01-02 11:30:00", "3600.9", "sim", "Nao", "Email")
    typed = one(clean.type_columns(spark.createDataFrame([row], TYPED)))
    assert (typed.priority_code, typed.priority_name) == (3, "Média")
    assert typed.closed_at == dt.datetime(2026, 1, 2, 11, 30)
    assert typed.duration_seconds == 3600
    assert (typed.entered_kpi, typed.kpi_violated) == (True, False)
    assert (typed.opened_year, typed.opened_month) == (2026, 1)


@pytest.mark.parametrize("text", ["x", "", None, "- Alta"])
def test_unreadable_values_become_null_instead_of_aborting(spark, text):
    typed = one(clean.type_columns(spark.createDataFrame([(text, text, text, text, text, text, text, text)], TYPED)))
    assert typed.priority_code is None and typed.duration_seconds is None and typed.opened_at is None


@pytest.mark.parametrize("text,flag", [("SIM", True), ("sim", True), ("NAO", False), ("NÃO", None), ("N/A", None), (None, None)])
def test_flags(spark, text, flag):
    df = spark.createDataFrame([(text,)], "v string").select(yes_no_flag(F.col("v")).alias("f"))
    assert one(df).f is flag


AUDIT = (
    "case_id string, priority_code int, parent_incident_id string, status string, duration_seconds bigint, "
    "entered_kpi boolean, kpi_violated boolean"
)


@pytest.mark.parametrize(
    "priority,parent,status,seconds,eligible,violated,reason",
    [
        (1, None, "Encerrado", 14_400, True, False, "eligible"),
        (2, None, "Encerrado", 14_401, True, True, "eligible"),
        (3, " ", "Encerrado", 43_200, True, False, "eligible"),
        (3, None, None, 43_201, True, True, "eligible"),
        (4, "INC1", "Encerrado", 1, False, None, "priority_not_eligible"),
        (5, None, "Encerrado", 1, False, None, "priority_not_eligible"),
        (1, "INC0000001", "Sem intervenção", 1, False, None, "parent_incident"),
        (2, None, "  sem   INTERVENÇÃO ", 1, False, None, "status_without_intervention"),
        (2, None, "Encerrado", None, True, None, "missing_duration"),
        (2, None, "Encerrado", -1, True, None, "eligible"),
        (9, None, "Encerrado", 1, None, None, "invalid_priority"),
        (None, "INC1", "Sem intervenção", 1, None, None, "invalid_priority"),
    ],
)
def test_audit_cases(spark, priority, parent, status, seconds, eligible, violated, reason):
    df = spark.createDataFrame([("c", priority, parent, status, seconds, True, False)], AUDIT)
    row = one(sla.audit_sla(df))
    assert (row.kpi_eligible_by_rule, row.kpi_violated_by_rule, row.kpi_rule_reason) == (eligible, violated, reason)
    assert row.entered_kpi_rule_matches_source == (None if eligible is None else eligible is True)
    assert row.kpi_violated_rule_matches_source == (None if violated is None else violated is False)
    assert row.kpi_rule_version == "1.0"


def test_limits_and_rerun(spark):
    df = spark.createDataFrame([(str(c), c, None, "x", 1, None, None) for c in range(7)], AUDIT)
    once = sla.audit_sla(df)
    limits = {row.priority_code: row.kpi_limit_seconds for row in once.collect()}
    assert limits == {0: None, 1: 14_400, 2: 14_400, 3: 43_200, 4: 86_400, 5: 345_600, 6: None}
    again = sla.audit_sla(once, SlaPolicy(version="2.0"))
    assert sorted(again.columns) == sorted(once.columns)
    assert {row.kpi_rule_version for row in again.collect()} == {"2.0"}


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="sSeEmMéÊ iIíntTerRvVeEnNçÇcãAaÃoÕ \t", max_size=20), min_size=20, max_size=40))
def test_folded_match_equals_folding(spark, texts):
    texts = [*texts, "Sem Intervenção", "SEM  INTERVENCAO", " sem intervencão ", "sem intervencao\n", "Sem\tIntervençâo"]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    both = df.select((fold_text(F.col("v")) == "SEM INTERVENCAO").alias("a"), matches_folded(F.col("v"), "SEM INTERVENCAO").alias("b"))
    assert [r for r in both.collect() if r.a != r.b] == []


QUALITY = (
    "incident_id string, priority_code int, assigned_group string, opened_at timestamp, closed_at timestamp, "
    "duration_seconds bigint"
)
OPEN, CLOSE = dt.datetime(2026, 1, 2), dt.datetime(2026, 1, 3)


@pytest.mark.parametrize(
    "row,issues",
    [
        (("INC0000001", 1, "T", OPEN, CLOSE, 0), ""),
        ((None, 1, "T", OPEN, CLOSE, 1), "missing_incident_id"),
        (("INC001", 1, "T", OPEN, CLOSE, 1), "invalid_incident_id"),
        (("INC0000001", None, "T", OPEN, CLOSE, 1), ""),
        (("INC0000001", 6, None, None, None, None),
         "invalid_priority|missing_assigned_group|invalid_opened_at|invalid_closed_at|invalid_duration"),
        (("BAD", 9, None, CLOSE, OPEN, -100),
         "invalid_incident_id|invalid_priority|missing_assigned_group|negative_duration|closed_before_opened"),
    ],
)
def test_quality_rules(spark, row, issues):
    found = one(quality.add_quality(spark.createDataFrame([row], QUALITY)))
    assert (found.dq_issues, found.dq_status) == (issues, "INVALID" if issues else "VALID")


def test_unreadable_priority_text_is_an_issue(spark):
    df = spark.createDataFrame([("x", "INC0000001", None, "T", OPEN, CLOSE, 1)], f"priority string, {QUALITY}")
    assert one(quality.add_quality(df)).dq_issues == "invalid_priority"


VERSION = "incident_id string, closed_at timestamp, _ingested_at timestamp, version string"


def test_latest_version(spark):
    early, late = dt.datetime(2026, 1, 1), dt.datetime(2026, 2, 1)
    rows = [
        ("A", early, late, "old"), ("A", late, early, "new"),
        ("B", late, early, "first"), ("B", late, late, "second"),
        ("C", None, late, "open"), ("C", early, None, "closed"),
        (None, early, early, "n1"), (None, late, early, "n2"),
    ]
    kept = quality.latest_versions(spark.createDataFrame(rows, VERSION)).collect()
    assert {(r.incident_id, r.version) for r in kept} == {("A", "new"), ("B", "second"), ("C", "closed"), (None, "n2")}


def test_hot_incident_is_reduced_before_the_shuffle(spark):
    df = spark.range(50_000).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.col("id").cast("string")).alias("incident_id"),
        F.timestamp_seconds("id").alias("closed_at"),
        F.col("id").alias("seq"),
    )
    kept = quality.latest_versions(df, ["seq"])
    assert kept.filter("incident_id = 'HOT'").first().seq == 49_998
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


RAW_ROWS = [
    ("INC9999998", "3 - Média", "2026-01-01 10:00:00", "2026-01-01 11:00:00", "3600", "Time"),
    ("INC9999998", "3 - Média", "2026-01-01 10:00:00", "2026-01-01 12:00:00", "7200", "Time"),
    ("BAD-ID", "9 - Inválida", "2026-01-02 10:00:00", "2026-01-01 10:00:00", "-100", ""),
]


def raw_rows(spark, rows=RAW_ROWS):
    """Raw frame with the given id, priority, opened, closed, duration and team."""
    names = {v: k for k, v in SOURCE_COLUMNS.items()}
    short = ["incident_id", "priority", "opened_at", "closed_at", "duration_seconds", "assigned_group"]
    table = [tuple(dict(zip((names[s] for s in short), row)).get(f, "x") for f in RAW_SCHEMA.names) for row in rows]
    return spark.createDataFrame(table, RAW_SCHEMA)


def test_silver_end_to_end(spark):
    raw = raw_rows(spark)
    assert silver_records(raw).count() == 3
    current = {r.incident_id: r for r in current_records(raw).collect()}
    assert current["INC9999998"].duration_seconds == 7200 and current["INC9999998"].dq_status == "VALID"
    assert current["BAD-ID"].dq_issues.count("|") == 4
    profile = one(quality.quality_profile(silver_records(raw)))
    assert tuple(profile) == (3, 1, 1)


def test_newer_invalid_version_replaces_valid_one(spark):
    rows = [RAW_ROWS[0], ("INC9999998", "3 - Média", "2026-01-01 10:00:00", "2026-01-05 11:00:00", "-5", "Time")]
    assert one(current_records(raw_rows(spark, rows))).dq_status == "INVALID"


def test_newest_version_is_chosen_before_typing(spark):
    """Ids and closing times are compared as cleaned, and superseded versions reach no typed column."""
    rows = [(" INC0000001 ", "1 - A", "2026-01-01", "2026-01-09 10:00:00", "5", "T"), ("INC0000001", "2 - B", "2026-01-01", "  2026-01-10 ", "5", "T"),
            ("INC0000001", "3 - C", "2026-01-01", "soon", "5", "T"), ("  ", "4 - D", "2026-01-01", "2026-01-02", "5", "T"), (None, "5 - E", "2026-01-01", "", "5", "T")]
    found = current_records(raw_rows(spark, rows))
    assert {(r.incident_id, r.priority_code) for r in found.collect()} == {("INC0000001", 2), (None, 4)}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("regexp_extract") < plan.index("Window")
