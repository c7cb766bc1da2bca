"""Ledger, reconciliation, contracts, publication, rollups and workload summaries."""

from __future__ import annotations

import datetime as dt
import statistics

import pytest
from pyspark.sql import functions as F

from faultline.operators import contracts, ledger, reconcile, rollups
from faultline.plans import publish, workload
from faultline.schema import LEDGER_SCHEMA
from faultline.sinks.payloads import write_json, write_trend_partitions
from faultline.sources.lines import file_hashes
from faultline.sources.synthetic import synthetic_incidents


def entry(layer, batch, when=1, **fields):
    base = {
        "layer": layer, "batch_id": batch, "status": "SUCCESS", "source_file": f"{batch}.csv", "file_hash": f"h{batch}",
        "processed_at": dt.datetime(2026, 1, when),
    }
    if layer == "bronze":
        base |= {"records_written": 10}
    if layer == "silver":
        base |= {"records_received": 10, "valid_records_received": 8, "invalid_records_received": 2,
                 "silver_total_records": 15, "quarantine_total_records": 3}
    if layer == "gold":
        base |= {"gold_snapshot_records": 15}
    return base | fields


def book(spark, entries):
    names = [part.split()[0] for part in LEDGER_SCHEMA.replace("\n", " ").split(",")]
    return spark.createDataFrame([tuple(e.get(n) for n in names) for e in entries], LEDGER_SCHEMA)


def complete():
    return [entry(layer, batch, day) for batch in ("a", "b") for day, layer in enumerate(ledger.LAYERS, 1)]


def changed(layer, **fields):
    return [e | fields if (e["layer"], e["batch_id"]) == (layer, "a") else e for e in complete()]


STATE = {"bronze_records": 20, "silver_records": 15, "quarantine_records": 3, "missing_bronze_paths": 0, "missing_gold_outputs": 0}


def statuses(spark, entries, **physical):
    stored = STATE | physical
    row = spark.createDataFrame([tuple(stored.values())], ", ".join(f"{n} bigint" for n in stored))
    checks = reconcile.reconciliation_checks(book(spark, entries), row)
    return {r.check_name: r.status for r in checks.collect()}


def test_all_checks_pass(spark):
    found = statuses(spark, complete())
    assert list(found) == list(reconcile.CHECK_TEXTS) and set(found.values()) == {"PASS"}


@pytest.mark.parametrize(
    "name,entries,physical",
    [
        ("batch_sets_match", [e for e in complete() if (e["layer"], e["batch_id"]) != ("gold", "a")], {}),
        ("batch_metadata_match", changed("silver", file_hash="other"), {}),
        ("batch_intake_counts_match", changed("bronze", records_written=9), {"bronze_records": 19}),
        ("batch_dq_split_matches", changed("silver", valid_records_received=7), {}),
        ("snapshot_conservation", [e | {"quarantine_total_records": 6} if e["layer"] == "silver" else e for e in complete()],
         {"quarantine_records": 6}),
        ("gold_snapshot_matches_silver", [e | {"gold_snapshot_records": 14} if e["layer"] == "gold" else e for e in complete()], {}),
        ("bronze_paths_exist", complete(), {"missing_bronze_paths": 1}),
        ("bronze_control_matches_storage", complete(), {"bronze_records": 21}),
        ("silver_control_matches_storage", complete(), {"silver_records": 14}),
        ("quarantine_control_matches_storage", complete(), {"quarantine_records": 2}),
        ("gold_outputs_exist", complete(), {"missing_gold_outputs": 2}),
    ],
)
def test_each_check_can_fail_alone(spark, name, entries, physical):
    found = statuses(spark, entries, **physical)
    assert [n for n, s in found.items() if s == "FAIL"] == [name]


def test_empty_ledger_fails_the_batch_sets(spark):
    assert statuses(spark, [])["batch_sets_match"] == "FAIL"


def test_difference_rows(spark):
    matrix = reconcile.batch_matrix(ledger.effective_batches(book(spark, changed("gold", source_file="x.csv"))))
    rows = [tuple(r) for r in reconcile.metadata_differences(matrix).collect()]
    assert rows == [("a", "gold", "source_file", "a.csv", "x.csv")]


def test_effective_and_pending(spark):
    rows = book(spark, [
        entry("bronze", "a", 1, status="FAILED"), entry("bronze", "a", 2, records_written=5), entry("bronze", "a", 3),
        entry("bronze", "b", 1), entry("silver", "b", 2), entry("bronze", "c", 1, status="FAILED"),
    ])
    assert ledger.effective_batches(rows).filter("layer = 'bronze' AND batch_id = 'a'").first().records_written == 10
    assert [r.batch_id for r in ledger.pending_batches(rows, "bronze", "silver").collect()] == ["a"]
    assert [r.batch_id for r in ledger.pending_batches(rows, "silver", "gold").collect()] == ["b"]
    snapshot = ledger.control_snapshot(rows, spark.range(4)).first()
    assert (snapshot.bronze_batches, snapshot.bronze_records, snapshot.gold_batches, snapshot.landing_files) == (2, 20, 0, 4)
    assert ledger.control_snapshot(book(spark, [])).first().silver_records == 0


TREND = (
    "date date, priority_code int, priority_name string, product string, category string, assigned_group string, "
    "total_incidents bigint, kpi_incidents bigint, kpi_violations bigint, avg_duration_seconds double, p95_duration_seconds bigint"
)
TRENDS = [
    (dt.date(2026, 1, 5), 1, "Alta", "A", "c", "t", 3, 2, 1, 10.5, 12), (dt.date(2026, 1, 11), 2, "Média", None, "c", "", 1, 0, 0, None, None),
    (dt.date(2026, 2, 2), 1, "Alta", "B", "c", None, 2, 2, 0, 30.0, 31),
]


@pytest.fixture(scope="module")
def trends(spark):
    return spark.createDataFrame(TRENDS, TREND).cache()


def test_contract_kept_and_broken(spark, trends):
    payload = publish.trends_payload(trends)
    assert contracts.contract_violations(payload.filter("assigned_group IS NULL OR assigned_group <> ''"), "daily_trends").count() == 0
    bad = payload.withColumn("extra", F.lit(1)).drop("category").withColumn("priority_code", F.col("priority_code") - 1)
    found = {(r.column_name, r.rule): r.violations for r in contracts.contract_violations(bad, "daily_trends").collect()}
    assert found == {
        ("assigned_group", "min_length"): 1, ("category", "missing_column"): 1, ("extra", "extra_column"): 1,
        ("priority_code", "minimum"): 2,
    }
    report = contracts.violation_report(bad, "daily_trends", ["date"], limit=1).first()
    assert report.not_shown == 2 and report.broken_rules == "priority_code:minimum"


def test_partition_index_and_manifest(spark, trends, tmp_path):
    path = str(tmp_path / "daily_trends")
    write_trend_partitions(trends, path)
    write_trend_partitions(trends.filter("date > '2026-01-08'"), path)
    schema = f"{TREND}, year int, month int"
    index = publish.partition_index(spark, path, schema)
    assert [(r.year, r.month, r.record_count) for r in index.orderBy("month").collect()] == [(2026, 1, 1), (2026, 2, 1)]
    summary = publish.index_summary(index).first()
    assert (summary.total_records, summary.default_year, summary.default_month) == (2, 2026, 2)
    assert publish.index_problems(index, index).count() == 0
    moved = index.withColumn("month", F.col("month") + 1)
    assert {r.field for r in publish.index_problems(index, moved).collect()} >= {"entry"}

    flat = str(tmp_path / "payload")
    payload = publish.trends_payload(trends.filter("product IS NOT NULL"))
    write_json(payload, flat)
    stored = spark.read.schema(payload.schema).json(flat)
    made = publish.manifest_entry(
        spark, "daily_trends", flat, stored, contracts.contract_outcomes(stored, "daily_trends"), F.lit("2026-02-02")
    )
    row = made.first()
    assert (row.contract_status, row.item_count, row.path) == ("VALID", 2, "payload")
    assert publish.publication_gate(made).first().publishable
    assert publish.manifest_drift(made, made).count() == 0
    drift = publish.manifest_drift(made, made.withColumn("item_count", F.col("item_count") + 1)).collect()
    assert [(d.name, d.field, d.expected, d.actual) for d in drift] == [("daily_trends", "item_count", "2", "3")]
    assert not publish.publication_gate(made.withColumn("mock", F.lit(True))).first().publishable


def test_line_ends_do_not_change_hashes(spark, tmp_path):
    for name, text in (("unix", b"a\nb\n"), ("dos", b"a\r\nb\r\n"), ("old", b"a\rb\n")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.json").write_bytes(text)
    rows = [file_hashes(spark, str(tmp_path / n)).select("size_bytes", "sha256").first() for n in ("unix", "dos", "old")]
    assert rows[0] == rows[1] == rows[2] and rows[0].size_bytes == 4


def test_empty_forecast_document(spark):
    history = spark.createDataFrame([], "date date, actual_incidents bigint")
    summary = spark.createDataFrame(
        [], "forecast_date date, predicted_incidents bigint, lower_bound bigint, upper_bound bigint, forecast_d1 bigint, "
        "forecast_d7 bigint, risk_range bigint, scope_description string, scope_priority_codes string"
    )
    row = publish.forecast_document(history, summary).first()
    assert row.forecast_d1 is None and row.scope_priority_codes == [] and row.history == [] and row.forecast == []


def test_trend_rollups(trends):
    total = rollups.trend_totals(trends).first()
    assert (total.total_incidents, total.kpi_incidents, total.compliance_pct) == (6, 4, 75.0)
    assert total.avg_duration_seconds == pytest.approx((10.5 * 3 + 30 * 2) / 5)
    weeks = {r.week_start: r.total_incidents for r in rollups.trend_weekly(trends).collect()}
    assert weeks == {dt.date(2026, 1, 5): 4, dt.date(2026, 2, 2): 2}
    teams = {r.name: r.total_incidents for r in rollups.top_dimension(trends, "team").collect()}
    assert teams == {"t": 3, "Não informado": 3}
    assert rollups.top_dimension(trends, "priority").first().name == "1 - Alta"
    by_month = trends.withColumns({"year": F.year("date"), "month": F.month("date")})
    index = by_month.groupBy("year", "month").agg(F.count("*").alias("record_count"))
    assert rollups.newest_month(by_month, index).count() == 1
    assert rollups.trends_sliced(trends, year=2026, month=1, priority_code=None).count() == 2
    assert rollups.trends_sliced(trends, month=2).count() == 1


def test_empty_slice_has_no_rates(trends):
    row = rollups.trend_totals(trends.filter("total_incidents > 99")).first()
    assert (row.total_incidents, row.compliance_pct, row.avg_duration_seconds) == (0, None, None)


def test_filter_options(spark, trends):
    dashboard = spark.createDataFrame(
        [(2026, 1, 1, "Alta", "t"), (2026, 13, 2, None, "t"), (None, 2, None, "x", "u")],
        "opened_year int, opened_month int, priority_code int, priority_name string, assigned_group string",
    )
    rows = publish.filter_options(dashboard, trends).orderBy(*publish.option_order()).collect()
    assert [(r.kind, r.code, r.label) for r in rows] == [
        ("year", 2026, "2026"), ("month", 1, "Janeiro"), ("month", 2, "Fevereiro"), ("priority", 1, "Alta"),
        ("product", None, "A"), ("product", None, "B"), ("category", None, "c"), ("team", None, "t"),
    ]


@pytest.mark.parametrize("values", [[5.0], [1.0, 2.0], [3.0, 1.0, 2.0, 2.0], [float(n * n % 101) for n in range(100)]])
def test_sample_summary(spark, values):
    df = spark.createDataFrame([("p", v) for v in values], "profile string, total_seconds double")
    row = workload.summarize_samples(df, "profile", "total_seconds").first()
    ordered = sorted(values)
    assert row.median == round(statistics.median(values), 4) and row.stdev == pytest.approx(statistics.pstdev(values), abs=1e-4)
    assert row.p95 == ordered[-(-95 * len(ordered) // 100) - 1]
    assert (row.minimum, row.maximum) == (ordered[0], ordered[-1])


@pytest.mark.parametrize(
    "optimized,same,verdict",
    [(4.0, True, "ADOPT_OPTIMIZED_PROFILE"), (9.5, True, "KEEP_BASELINE_AND_RETEST"), (4.0, False, "REJECT_OPTIMIZATION")],
)
def test_profile_comparison(spark, optimized, same, verdict):
    rows = [("baseline", 10.0, 1, 2, 3), ("optimized", optimized, 1, 2, 3 if same else 4)]
    runs = spark.createDataFrame(rows, "profile string, total_seconds double, rows bigint, duration_sum bigint, priority_sum bigint")
    row = workload.compare_profiles(workload.summarize_profiles(runs), "baseline", "optimized").first()
    assert row.recommendation == verdict and row.speedup == pytest.approx(10 / optimized, abs=1e-3)


def test_synthetic_rows(spark):
    df = synthetic_incidents(spark, 1000)
    assert df.count() == 1000 and df.select("Número").distinct().count() == 950
    first = df.filter("`Número` = 'INC0000001'").orderBy("Aberto").first()
    assert (first["Prioridade"], first["Aberto"], first["Duração"]) == ("1 - Crítica", "2023-01-01 00:00:00", "600")
    with pytest.raises(ValueError):
        synthetic_incidents(spark, 99)


def test_freshness_passes_over_texts_that_are_no_time(spark):
    """Flawed days such as 1998/12/17 sort behind every day of their year as texts."""
    times = ["1998-11-30", "1998/12/17", "1998-12-32", "soon", None, "1998-12-31T08:00:00", "1998-12-311"]
    entries = spark.createDataFrame([(t,) for t in times], "data_generated_at string")
    assert publish.freshness(entries).first().latest_data_at == "1998-12-31T08:00:00"
    assert publish.freshness(entries.filter("data_generated_at = 'soon'")).first().latest_data_at is None
