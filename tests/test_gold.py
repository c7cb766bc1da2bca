"""Gold aggregates, risk, forecast and recommendations on hand-made rows."""

from __future__ import annotations

import datetime as dt
import hashlib

import pytest
from pyspark.sql import functions as F

from faultline.operators import aggregates, forecast, recommend, risk
from faultline.operators.aggregates import daily_cells_with_p95
from faultline.plans.gold import gold_tables

SILVER = (
    "incident_id string, opened_at timestamp, opened_year int, opened_month int, priority_code int, priority_name string, "
    "assigned_group string, product string, category string, duration_seconds bigint, opened_by string, entered_kpi boolean, "
    "kpi_violated boolean, kpi_eligible_by_rule boolean, kpi_violated_by_rule boolean, "
    "entered_kpi_rule_matches_source boolean, kpi_violated_rule_matches_source boolean"
)


def incident(i, day, code, team, product, seconds, entered, violated, eligible, over, by="Manual"):
    opened = dt.datetime.combine(day, dt.time(9))
    match = [None if a is None or b is None else a == b for a, b in ((eligible, entered), (over, violated))]
    return (f"INC{i:07d}", opened, day.year, day.month, code, f"P{code}", team, product, "c", seconds, by, entered,
            violated, eligible, over, *match)


DAY = dt.date(2025, 1, 10)
ROWS = [
    incident(1, DAY, 2, "A", "Hosting", 10_000, True, False, True, False, "Monitoramento"),
    incident(2, DAY, 2, "A", "Hosting", 20_000, True, True, True, True),
    incident(3, DAY, 3, None, "Email", 50_000, None, None, True, True),
    incident(4, dt.date(2025, 2, 1), 5, "B", None, 100, False, None, False, None),
    incident(5, dt.date(2025, 2, 1), 1, "B", "Email", None, True, True, True, None),
]


@pytest.fixture(scope="module")
def silver(spark):
    return spark.createDataFrame(ROWS, SILVER).cache()


def by(df, *keys):
    return {tuple(row[k] for k in keys) if len(keys) > 1 else row[keys[0]]: row for row in df.collect()}


def test_monthly(silver):
    months = by(aggregates.monthly_kpis(silver), "opened_month")
    january = months[1]
    assert (january.total_incidents, january.monitoring_incidents, january.manual_incidents) == (3, 1, 2)
    assert (january.kpi_incidents, january.kpi_violations, january.kpi_compliance_pct) == (2, 1, 50.0)
    assert january.avg_duration_seconds == 26_666.67 and january.p95_duration_seconds == 50_000
    assert months[2].kpi_compliance_pct == 0.0 and months[2].avg_duration_seconds == 100.0


def test_priority_without_kpi_has_no_rate(silver):
    assert by(aggregates.priority_summary(silver), "priority_code")[5].kpi_compliance_pct is None


def test_null_team_is_its_own_group(silver):
    assert by(aggregates.team_summary(silver), "assigned_group")[None].total_incidents == 1


def test_daily_trends_by_rule(silver):
    row = by(aggregates.daily_trends(silver), "date", "priority_code")[DAY, 2]
    assert (row.total_incidents, row.kpi_violations, row.kpi_compliance_pct) == (2, 1, 50.0)
    assert (row.avg_duration_seconds, row.p95_duration_seconds) == (15_000.0, 20_000)


def test_operational_counts(silver):
    row = by(aggregates.operational_kpi_summary(silver), "opened_month", "priority_code")[2, 1]
    assert (row.calculated_kpi_incidents, row.evaluated_kpi_incidents, row.not_evaluable_kpi_incidents) == (1, 0, 1)
    assert row.calculated_compliance_pct is None and row.violation_comparisons == 0
    assert (row.eligibility_comparisons, row.eligibility_mismatches, row.eligibility_mismatch_pct) == (1, 0, 0.0)


@pytest.mark.parametrize(
    "code,violations,volume,expected",
    [
        (2, 30, 4584, (150, 150)), (2, 31, 4585, (125, 125)), (2, 35, 5388, (125, 125)), (2, 36, 5389, (100, 100)),
        (2, 39, 6168, (100, 100)), (2, 45, 6252, (75, 75)), (2, 53, 6336, (50, 50)), (2, 54, 6337, (0, 0)),
        (3, 200, 19_488, (150, 150)), (3, 201, 22_116, (125, 125)), (3, 263, 22_524, (100, 100)),
        (3, 290, 23_892, (75, 75)), (3, 320, 24_276, (50, 50)), (3, 321, 24_277, (0, 0)), (1, 1, 1, (None, None)),
    ],
)
def test_attainment_bands(spark, code, violations, volume, expected):
    df = spark.createDataFrame([(code, violations, volume)], "priority_code int, calculated_kpi_violations bigint, treated_volume bigint")
    row = aggregates.add_attainment(df).first()
    assert (row.violation_target_attainment_pct, row.volume_target_attainment_pct) == expected


def test_additive_tables_are_the_same_from_cells(silver):
    cells = daily_cells_with_p95(silver)
    pairs = [
        (aggregates.team_summary, None), (aggregates.dashboard_summary, None), (aggregates.annual_ola_summary, None),
        (risk.risk_summary, None), (forecast.forecast_history, None),
    ]
    for build, _ in pairs:
        assert sorted(map(str, build(silver).collect())) == sorted(map(str, build(cells).collect()))
    trends = aggregates.daily_trends_from_cells(cells).select(*aggregates.daily_trends(silver).columns)
    assert sorted(map(str, trends.collect())) == sorted(map(str, aggregates.daily_trends(silver).collect()))


def test_gold_is_complete(silver):
    tables = gold_tables(silver, daily_cells_with_p95(silver))
    assert len(tables) == 11 and tables["monthly_kpis"].count() == 2


RISK_INPUT = (
    "priority_name string, product string, category string, assigned_group string, duration_seconds bigint, "
    "kpi_eligible_by_rule boolean, kpi_violated_by_rule boolean"
)


def test_risk_scores_and_unknown_values(spark):
    rows = [
        ("P", "Hosting", "c", "t", 100, True, True), ("P", " Hosting ", "c", "t", 200, True, False),
        ("P", "Email", "c", "t", 400, True, True), ("P", None, "c", "t", 900, True, True), ("P", "  ", "c", "t", 900, True, True),
    ]
    ranked = by(risk.risk_summary(spark.createDataFrame(rows, RISK_INPUT)).filter("dimension_type = 'product'"), "dimension_value")
    hosting, email, unknown = ranked["Hosting"], ranked["Email"], ranked[None]
    assert (hosting.volume_normalized, hosting.violation_rate_normalized, hosting.avg_duration_normalized) == (1.0, 0.5, 0.375)
    assert (hosting.risk_score, hosting.rank) == (70.0, 2)
    assert (email.risk_score, email.rank) == (77.5, 1)
    assert unknown.is_unknown and unknown.rank is None and unknown.volume == 2 and unknown.risk_score == 100.0


FORECAST_INPUT = "incident_id string, opened_at timestamp, priority_code int"


def daily(spark, per_day, start=dt.datetime(2026, 1, 1, 8)):
    rows = [
        (f"I{d}-{n}", start + dt.timedelta(days=d), 1) for d, count in enumerate(per_day) for n in range(count)
    ]
    return spark.createDataFrame(rows, FORECAST_INPUT)


def test_constant_volume_forecast(spark):
    history = forecast.forecast_history(daily(spark, [1] * 40))
    rows = forecast.forecast_summary(history).orderBy("horizon_day").collect()
    assert history.count() == 28 and [r.predicted_incidents for r in rows] == [1] * 7
    assert {(r.risk_range, r.lower_bound, r.upper_bound, r.forecast_d1, r.forecast_d7) for r in rows} == {(0, 1, 1, 1, 7)}
    assert rows[0].forecast_date == dt.date(2026, 2, 10)


def test_history_ends_at_newest_day_in_scope_and_fills_gaps(spark):
    df = daily(spark, [2, 0, 3]).union(
        spark.createDataFrame([("x", dt.datetime(2026, 6, 1), 4), ("y", None, 1)], FORECAST_INPUT)
    )
    rows = forecast.forecast_history(df).orderBy("date").collect()
    assert [r.actual_incidents for r in rows[-3:]] == [2, 0, 3] and rows[-1].date == dt.date(2026, 1, 3)
    assert len(rows) == 28 and rows[0].date == dt.date(2025, 12, 7)


def test_empty_forecast(spark):
    history = forecast.forecast_history(spark.createDataFrame([], FORECAST_INPUT))
    assert history.count() == 0 and forecast.forecast_summary(history).count() == 0


def test_forecast_against_plain_arithmetic(spark):
    counts = [(7 * d * d + 3 * d) % 23 for d in range(28)]
    history = forecast.forecast_history(daily(spark, [*counts[:-1], counts[-1] + 1]))
    counts[-1] += 1
    end = dt.date(2026, 1, 28)
    recent = sum(counts[-7:]) / 7
    expected = []
    for step in range(1, 8):
        weekday = (end + dt.timedelta(days=step)).weekday()
        same = [c for d, c in enumerate(counts) if (dt.date(2026, 1, 1) + dt.timedelta(days=d)).weekday() == weekday]
        expected.append(int(sum(same) / len(same) * 0.6 + recent * 0.4 + 0.5))
    rows = forecast.forecast_summary(history).orderBy("horizon_day").collect()
    assert [r.predicted_incidents for r in rows] == expected


RISK_TABLE = (
    "dimension_type string, dimension_value string, is_unknown boolean, volume bigint, evaluated_kpi_incidents bigint, "
    "kpi_violations bigint, kpi_violation_rate_pct double, avg_duration_seconds double, risk_score double, rank int"
)


def risk_rows(spark, *rows):
    return spark.createDataFrame(rows, RISK_TABLE)


def test_score_rule(spark):
    table = risk_rows(
        spark,
        ("priority", "a", False, 1, 0, 0, None, 1.0, 75.0, 1), ("priority", "b", False, 1, 0, 0, None, 1.0, 50.0, 2),
        ("priority", "c", False, 1, 0, 0, None, 1.0, 49.99, 3), ("priority", "d", False, 1, 0, 0, None, 1.0, 90.0, 4),
        ("priority", None, True, 1, 0, 0, None, 1.0, 99.0, None),
    )
    rows = by(recommend.from_risk(table, ["RISK_SCORE_HIGH"]), "target")
    assert {t: r.severity for t, r in rows.items()} == {"a": "CRITICAL", "b": "HIGH"}
    digest = hashlib.sha256(b"RISK_SCORE_HIGH|priority|a").hexdigest()
    assert rows["a"].recommendation_id == "REC-" + digest[:12].upper()
    assert rows["a"].evidence == "Posição 1 no ranking de priority, com score de risco 75.00."


def test_rate_rule_ranks_only_candidates(spark):
    table = risk_rows(
        spark,
        ("product", "few", False, 9, 4, 4, 100.0, 1.0, 1.0, 1), ("product", "a", False, 9, 10, 5, 50.0, 1.0, 1.0, 2),
        ("product", "b", False, 9, 20, 9, 45.0, 1.0, 1.0, 3), ("product", "c", False, 9, 30, 13, 45.0, 1.0, 1.0, 4),
        ("product", "d", False, 9, 10, 2, 20.0, 1.0, 1.0, 5),
    )
    rows = by(recommend.from_risk(table, ["KPI_VIOLATION_RATE_HIGH"]), "target")
    assert {t: r.severity for t, r in rows.items()} == {"a": "CRITICAL", "b": "HIGH", "c": "HIGH"}


def test_volume_rule(spark):
    table = risk_rows(
        spark,
        ("product", "b", False, 1000, 0, 0, None, 1.0, 1.0, 1), ("product", "a", False, 1000, 0, 0, None, 1.0, 1.0, 2),
        ("priority", "P1", False, 9000, 0, 0, None, 1.0, 1.0, 1), ("category", "x", False, 999, 0, 0, None, 1.0, 1.0, 1),
        ("assigned_group", None, True, 5000, 0, 0, None, 1.0, 1.0, None),
    )
    rows = recommend.from_risk(table, ["VOLUME_CONCENTRATION"]).collect()
    assert [(r.dimension_type, r.target, r.severity, r.metric_value) for r in rows] == [("product", "a", "MEDIUM", 1000.0)]


def test_compliance_rule(spark):
    annual = spark.createDataFrame(
        [(2024, 2, "Alta", 74.99), (2025, 3, None, 75.0), (2025, 2, "Alta", 90.0), (2023, 2, "Alta", None)],
        "opened_year int, priority_code int, priority_name string, calculated_compliance_pct double",
    )
    rows = by(recommend.from_targets(annual), "target")
    assert {t: r.severity for t, r in rows.items()} == {"2024 | Alta": "CRITICAL", "2025": "HIGH"}


@pytest.mark.parametrize("expected,recent,severity,growth", [(140, 70, "HIGH", 100.0), (110, 100, "MEDIUM", 10.0), (109, 100, None, None), (5, 0, None, None)])
def test_growth_rule(spark, expected, recent, severity, growth):
    end = dt.date(2026, 1, 28)
    summary = spark.createDataFrame([(1, expected), (2, expected)], "horizon_day int, forecast_d7 bigint")
    history = spark.createDataFrame(
        [(end, end, recent), (end - dt.timedelta(days=7), end, 500)], "date date, history_end_date date, actual_incidents bigint"
    )
    rows = recommend.from_forecast(summary, history).collect()
    assert [(r.severity, r.metric_value) for r in rows] == ([(severity, growth)] if severity else [])


def test_recommendation_order(spark):
    df = spark.createDataFrame(
        [("LOW", "a"), ("MEDIUM", "b"), ("CRITICAL", "c"), ("HIGH", "d")], "severity string, rule_id string"
    ).withColumns({"dimension_type": F.lit("x"), "target": F.lit("y")})
    assert [r.rule_id for r in df.orderBy(*recommend.recommendation_order()).collect()] == ["c", "d", "b", "a"]
