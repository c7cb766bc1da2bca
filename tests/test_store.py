"""Landing to Gold on disk: idempotence, corrections, failures, stream."""

from __future__ import annotations

import csv
import gzip
import re

import pytest
from pyspark.sql import functions as F

from faultline.operators import quality
from faultline.plans import incremental
from faultline.plans.silver import silver_records
from faultline.plans.store import Store
from faultline.schema import GOLD_TABLES, SOURCE_COLUMNS
from faultline.session import settings
from faultline.sinks import payloads, tables
from faultline.sources import testbed
from faultline.sources.incident_csv import read_incident_csv
from faultline.sources.landing import content_digests, landed_files, landing_inventory, pending_files
from faultline.streaming.landing_stream import start_landing_stream
from tests.test_silver import RAW_ROWS, raw_rows

HEADER = list(SOURCE_COLUMNS)
SHORT = ["incident_id", "priority", "opened_at", "closed_at", "duration_seconds", "assigned_group"]
NAMES = {v: k for k, v in SOURCE_COLUMNS.items()}


def land(folder, name, rows, header=HEADER):
    folder.mkdir(exist_ok=True)
    with open(folder / name, "w", encoding="utf-8", newline="") as file:
        writer = csv.writer(file)
        writer.writerow(header)
        for row in rows:
            values = dict(zip((NAMES[s] for s in SHORT), row)) | {"Status": "Encerrado", "Entrou para KPI?": "SIM"}
            writer.writerow([values.get(column, "") for column in HEADER])
    return folder / name


@pytest.fixture
def store(spark, tmp_path):
    return Store.create(spark, str(tmp_path / "store"))


def state(store):
    return {r.incident_id: (r.dq_status, r.duration_seconds) for r in store.records().collect()}


def test_whole_run_twice(spark, store, tmp_path):
    landing = tmp_path / "landing"
    path = land(landing, "incidents_2026_01.csv", RAW_ROWS)
    assert incremental.run_incremental(store, str(landing)) == "SUCCESS"
    assert state(store) == {"INC9999998": ("VALID", 7200), "BAD-ID": ("INVALID", -100)}
    month = store.gold("monthly_kpis").first()
    assert (month.total_incidents, month.kpi_incidents, month.kpi_violations, month.kpi_compliance_pct) == (1, 1, 0, 100.0)
    for name in ("priority_summary", "team_summary", "dashboard_summary"):
        assert store.gold(name).count() == 1
    digest = content_digests(spark, str(path)).first().file_hash
    bronze = store.control("ledger").filter("layer = 'bronze'").first()
    assert (bronze.file_hash, bronze.batch_id, bronze.records_written) == (digest, digest[:16], 3)

    before = {t: store.control(t).count() for t in ("ledger", "slices", "gold_runs")}
    assert incremental.run_incremental(store, str(landing)) == "SUCCESS"
    assert before == {t: store.control(t).count() for t in ("ledger", "slices", "gold_runs")}
    runs = store.control("runs").collect()
    assert [r.status for r in runs] == ["SUCCESS", "SUCCESS"] and runs[0].silver_records == 1
    assert {r.status for r in incremental.reconcile(store).collect()} == {"PASS"}
    assert incremental.stored_gold_tables(store).count() == len(GOLD_TABLES) + 1  # and the cells
    checks = store.control("checks")
    assert checks.count() == 22 and checks.select("run_id").distinct().count() == 2
    assert checks.filter("status <> 'PASS'").count() == 0
    assert {r.run_id for r in checks.collect()} == {r.run_id for r in store.control("runs").collect()}
    orphan = store.bronze().limit(1).withColumn("_batch_id", F.lit("dead"))
    orphan.write.mode("append").partitionBy("_batch_id").parquet(store.path("bronze"))
    assert [(r.batch_id, r.records) for r in incremental.orphan_batches(store).collect()] == [("dead", 1)]
    assert incremental.physical_state(store).first().bronze_records == 3


def test_corrections_move_between_tables_and_months(spark, store, tmp_path):
    landing = tmp_path / "landing"
    first = ("INC0000001", "1 - Alta", "2026-01-05 10:00:00", "2026-01-05 11:00:00", "-1", "T")
    other = ("INC0000002", "1 - Alta", "2026-01-06 10:00:00", "2026-01-06 11:00:00", "60", "T")
    land(landing, "a.csv", [first, other])
    incremental.ingest_landing(store, str(landing))
    incremental.refresh_silver(store)
    assert state(store) == {"INC0000001": ("INVALID", -1), "INC0000002": ("VALID", 60)}

    fixed = ("INC0000001", "1 - Alta", "2026-02-05 10:00:00", "2026-02-06 11:00:00", "70", "T")
    worse = ("INC0000002", "1 - Alta", "2026-01-06 10:00:00", "2026-01-07 11:00:00", "80", "")
    land(landing, "b.csv", [fixed, worse])
    incremental.ingest_landing(store, str(landing))
    totals = incremental.refresh_silver(store)
    assert state(store) == {"INC0000001": ("VALID", 70), "INC0000002": ("INVALID", 80)}
    assert (totals["silver_total"], totals["quarantine_total"], totals["duplicates"]) == (1, 1, 2)

    late = ("INC0000001", "1 - Alta", "2026-01-05 10:00:00", "2026-01-05 12:00:00", "99", "T")
    untouched = ("INC0000003", "1 - Alta", "2026-03-01 10:00:00", "2026-03-01 12:00:00", "5", "T")
    land(landing, "c.csv", [late, untouched])
    incremental.ingest_landing(store, str(landing))
    incremental.refresh_silver(store)
    assert state(store)["INC0000001"] == ("VALID", 70) and len(state(store)) == 3


def test_only_touched_months_are_rewritten(spark, store):
    def load(rows):
        raw = raw_rows(spark, rows).withColumns(
            {"_batch_id": F.lit("b"), "_source_file": F.lit("f"), "_source_hash": F.lit("h"), "_ingested_at": F.current_timestamp()}
        )
        return incremental.upsert(store, silver_records(incremental.with_digest(raw)))

    load([("INC0000001", "1 - A", "2026-01-05 10:00:00", "2026-01-05 11:00:00", "1", "T"),
          ("INC0000002", "1 - A", "2026-02-05 10:00:00", "2026-02-05 11:00:00", "1", "T")])
    first = {part.key: part.run for part in store.slices()}
    load([("INC0000003", "1 - A", "2026-02-07 10:00:00", "2026-02-07 11:00:00", "1", "T")])
    second = {part.key: part.run for part in store.slices()}
    assert first[2026, 1] == second[2026, 1] and first[2026, 2] != second[2026, 2]
    assert store.records().count() == 3
    plan = store.records([p for p in store.slices() if p.key == (2026, 1)])
    assert plan.count() == 1


def test_rule_version_change_rewrites_everything(spark, store, tmp_path):
    from faultline.config import SlaPolicy

    land(tmp_path / "landing", "a.csv", [RAW_ROWS[0]])
    incremental.ingest_landing(store, str(tmp_path / "landing"))
    incremental.refresh_silver(store)
    land(tmp_path / "landing", "b.csv", [("INC0000009", "1 - A", "2026-05-05 10:00:00", "2026-05-05 11:00:00", "1", "T")])
    incremental.ingest_landing(store, str(tmp_path / "landing"))
    incremental.refresh_silver(store, SlaPolicy(version="2.0"))
    assert {r.kpi_rule_version for r in store.records().collect()} == {"2.0"}


def test_batches_one_by_one_equal_one_load(spark, tmp_path):
    rows = [
        (f"INC{n % 7:07d}", f"{n % 5 + 1} - P", f"2026-0{n % 3 + 1}-05 10:00:00", f"2026-0{n % 4 + 1}-1{n % 9} 0{n % 8}:00:00", str(n), "T")
        for n in range(40)
    ]
    whole = quality.latest_versions(silver_records(raw_rows(spark, rows)), ["duration_seconds"])
    store = Store.create(spark, str(tmp_path / "parts"))
    for part in range(4):
        raw = raw_rows(spark, rows[part::4]).withColumns(
            {"_batch_id": F.lit("b"), "_source_file": F.lit("f"), "_source_hash": F.lit("h"),
             "_ingested_at": F.lit("2026-06-01").cast("timestamp")}
        )
        incremental.upsert(store, silver_records(incremental.with_digest(raw)), tiebreak=["duration_seconds"])
    expected = {r.incident_id: (r.dq_status, r.duration_seconds) for r in whole.collect()}
    assert state(store) == expected


def test_broken_file_is_named_and_earlier_files_stay(spark, store, tmp_path):
    landing = tmp_path / "landing"
    land(landing, "a.csv", [RAW_ROWS[0]])
    land(landing, "b.csv", [RAW_ROWS[1]], header=["wrong", *HEADER[1:]])
    with pytest.raises(Exception):
        incremental.ingest_landing(store, str(landing))
    entries = {r.source_file: r.status for r in store.control("ledger").orderBy("processed_at").collect()}
    assert entries == {"a.csv": "SUCCESS", "b.csv": "FAILED"} and store.bronze().count() == 1


def test_empty_file_is_a_failure(spark, store, tmp_path):
    land(tmp_path / "landing", "a.csv", [])
    with pytest.raises(incremental.EmptyBatch):
        incremental.ingest_landing(store, str(tmp_path / "landing"))
    assert store.control("ledger").first().status == "FAILED"


def test_failed_run_is_recorded(spark, store, tmp_path):
    land(tmp_path / "landing", "a.csv", [])
    with pytest.raises(incremental.EmptyBatch):
        incremental.run_incremental(store, str(tmp_path / "landing"))
    run = store.control("runs").first()
    assert run.status == "FAILED" and [tuple(s) for s in run.stages] == [("bronze", "FAILED")]


def test_csv_rules(spark, tmp_path):
    folder = tmp_path / "csv"
    land(folder, "a.csv", [("INC0000001", "1 - A", "2026-01-01", "2026-01-01", "1", 'line "one"\nline two, end')])
    assert read_incident_csv(spark, str(folder)).first()["Grupo designado"] == 'line "one"\nline two, end'
    (folder / "short.csv").write_text(",".join(HEADER) + "\nonly,three,values\n", encoding="utf-8")
    with pytest.raises(Exception):
        read_incident_csv(spark, str(folder)).collect()


def test_landing_functions(spark, tmp_path):
    folder = tmp_path / "landing"
    land(folder, "a.csv", [RAW_ROWS[0]])
    land(folder, "copy_of_a.csv", [RAW_ROWS[0]])
    land(folder, "b.csv", [RAW_ROWS[1]])
    (folder / "notes.txt").write_text("no")
    inventory = landing_inventory(spark, str(folder)).first()
    assert (inventory.file_count, inventory.file_names, inventory.status) == (3, ["a.csv", "b.csv", "copy_of_a.csv"], "READY")
    files = landed_files(spark, str(folder))
    done = files.filter("source_file = 'b.csv'").selectExpr("'bronze' layer", "'SUCCESS' status", "file_hash")
    assert pending_files(files, done).count() == 1
    assert pending_files(files, done).first().source_file == "a.csv"
    assert files.select("file_hash").distinct().count() == 2


def test_names_with_blanks_and_percent_signs(spark, store, tmp_path):
    landing = tmp_path / "landing"
    for name, row in (("incidentes março 2024.csv", RAW_ROWS[0]), ("p%q+r.csv", RAW_ROWS[1]), ("p%20q.csv", RAW_ROWS[2])):
        land(landing, name, [row])
    land(landing, "zz copy.csv", [RAW_ROWS[0]])
    assert incremental.ingest_landing(store, str(landing)) == 3
    stored = {r._source_file for r in store.bronze().collect()}
    assert store.bronze().count() == 3 and stored == {"incidentes março 2024.csv", "p%q+r.csv", "p%20q.csv"}
    assert incremental.ingest_landing(store, str(landing)) == 0


def test_batch_and_stream_agree_on_a_file(spark, store, tmp_path):
    landing = tmp_path / "landing"
    land(landing, "a b.csv", RAW_ROWS[:2])
    start_landing_stream(store, str(landing), gold=False).awaitTermination()
    assert store.bronze().count() == 2
    assert incremental.ingest_landing(store, str(landing)) == 0


def test_migration_stops_on_damage(spark, tmp_path):
    schema = "date date, n int"
    for name, text in (("broken", '{"records": [{"date": "2024-01-01", "n": 1}'), ("bad", '{"records": [{"date": "2024-13-99", "n": 1}]}'),
                       ("none", '{"generated_at": "t", "records": [{"n": 1}]}'), ("norecords", '{"generated_at": "t", "rows": []}'),
                       ("nolist", '{"generated_at": "t", "records": "x"}'), ("notime", '{"records": [{"date": "2024-01-01", "n": 1}]}')):
        (tmp_path / name).mkdir()
        (tmp_path / name / "x.json").write_text(text)
        with pytest.raises(Exception):
            payloads.migrate_trends(spark, str(tmp_path / name), schema, str(tmp_path / f"{name}-out"))


def test_order_keys_above_seven_digits_stay_apart(spark):
    from faultline.operators.quality import quality_rules
    from faultline.sources.testbed import POLICY

    keys = spark.createDataFrame([(12345678,), (12345679,), (5,)], "o_orderkey long")
    ids = [r[0] for r in keys.select(F.format_string("INC%07d", "o_orderkey")).collect()]
    assert ids == ["INC12345678", "INC12345679", "INC0000005"]
    frame = spark.createDataFrame([(i, 1, None, "g", 1) for i in ids],
                                  "incident_id string, priority_code int, assigned_group string, closed_at string, duration_seconds int")
    frame = frame.withColumns({"opened_at": F.lit("2026"), "closed_at": F.lit("2026")})
    assert frame.filter(quality_rules(frame, POLICY)["invalid_incident_id"]).count() == 0
    assert frame.filter(quality_rules(frame)["invalid_incident_id"]).count() == 2


def test_monthly_split_aborts_on_bad_dates(spark, tmp_path):
    good = raw_rows(spark, [("A", "1", "2026-01-03", "", "", ""), ("B", "1", "2026-01-04", "", "", ""), ("C", "1", "2026-02-01", "", "", "")])
    payloads.write_monthly_batches(good, str(tmp_path / "months"))
    assert sorted(p.name for p in (tmp_path / "months").iterdir() if p.is_dir()) == ["batch_month=2026_01", "batch_month=2026_02"]
    bad = raw_rows(spark, [("A", "1", "03/01/2026", "", "", "")])
    with pytest.raises(Exception, match="unreadable opening date"):
        payloads.write_monthly_batches(bad, str(tmp_path / "bad"))


def test_writers_verify(spark, tmp_path):
    df = spark.range(10).withColumn("dq_status", F.when(F.col("id") < 3, "INVALID").otherwise("VALID"))
    assert tables.write_split(spark, df, str(tmp_path / "split")) == {"rows": 10, "valid": 7, "invalid": 3}
    assert tables.verified_write(spark, df, str(tmp_path / "v")) == 10
    with pytest.raises(tables.WriteMismatch):
        tables.verified_write(spark, df.filter("id < 0"), str(tmp_path / "e"), allow_empty=False)


def test_stream_equals_batch_and_replays_nothing(spark, store, tmp_path):
    landing = tmp_path / "landing"
    land(landing, "a.csv", RAW_ROWS[:1])
    land(landing, "b.csv", RAW_ROWS[1:])
    start_landing_stream(store, str(landing), gold=False, files_per_batch=1).awaitTermination()
    assert state(store) == {"INC9999998": ("VALID", 7200), "BAD-ID": ("INVALID", -100)}
    entries = store.control("ledger").count()
    start_landing_stream(store, str(landing), gold=False).awaitTermination()
    assert store.control("ledger").count() == entries
    land(landing, "c.csv", [("BAD-ID", "1 - A", "2026-01-02 10:00:00", "2026-01-09 10:00:00", "5", "T")])
    query = start_landing_stream(store, str(landing), gold=True)
    query.awaitTermination()
    assert query.exception() is None and state(store)["BAD-ID"] == ("INVALID", 5)
    assert store.gold("monthly_kpis").count() == 1


def test_rows_without_a_date_live_in_the_null_month(spark, store, tmp_path):
    landing = tmp_path / "landing"
    land(landing, "a.csv", [("INC0000001", "1 - A", "soon", "2026-01-05 11:00:00", "1", "T")])
    incremental.ingest_landing(store, str(landing))
    incremental.refresh_silver(store)
    assert [part.key for part in store.slices()] == [(None, None)]
    assert store.quarantine().first().dq_issues == "invalid_opened_at"
    land(landing, "b.csv", [("INC0000001", "1 - A", "2026-01-05 10:00:00", "2026-01-06 11:00:00", "1", "T")])
    incremental.ingest_landing(store, str(landing))
    incremental.refresh_silver(store)
    assert state(store) == {"INC0000001": ("VALID", 1)} and store.quarantine().count() == 0


def test_stored_records_prune_and_push_down(spark, store, tmp_path):
    from faultline.operators.forecast import forecast_history

    rows = [(f"INC{n:07d}", "1 - A", f"2026-0{n % 3 + 1}-05 10:00:00", f"2026-0{n % 3 + 1}-06 10:00:00", "5", "T") for n in range(30)]
    land(tmp_path / "landing", "a.csv", rows)
    incremental.ingest_landing(store, str(tmp_path / "landing"))
    incremental.refresh_silver(store)
    plan = forecast_history(store.valid_records())._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert len(scans) == 1 and "dq_status" in scans[0].split("PartitionFilters")[1]
    assert "short_description" not in plan and "assigned_group" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_names_with_glob_characters_keep_every_row(spark, store, tmp_path):
    """In batch and stream alike; a1.csv is what the pattern a[1].csv would match."""
    names = ["a[1].csv", "a1.csv", "b{x,y}.csv", "bx.csv", "c*.csv", "cd?.csv"]
    rows = [(f"INC{n:07d}", "1 - A", "2026-01-05 10:00:00", "2026-01-06 10:00:00", str(n), "T") for n in range(len(names))]
    for folder, stream in (("batch", False), ("stream", True)):
        landing = tmp_path / folder
        for n, name in enumerate(names):
            land(landing, name, [rows[n]] * (n + 1))
        target = Store.create(spark, str(tmp_path / f"store-{folder}"))
        if stream:
            start_landing_stream(target, str(landing), gold=False).awaitTermination()
        else:
            assert incremental.ingest_landing(target, str(landing)) == len(names)
        held = {r._source_file: r.n for r in target.bronze().groupBy("_source_file").agg(F.count("*").alias("n")).collect()}
        assert held == {name: n + 1 for n, name in enumerate(names)}
        assert target.control("ledger").filter("layer = 'bronze' AND status <> 'SUCCESS'").count() == 0


def test_a_second_load_reads_only_new_files(spark, store, tmp_path, monkeypatch):
    landing, read = tmp_path / "landing", []

    def noted(session, paths, *more):
        read.append(sorted(p.rsplit("/", 1)[-1] for p in paths))
        return content_digests(session, paths, *more)

    monkeypatch.setattr(incremental, "content_digests", noted)
    for n in range(3):
        land(landing, f"f{n}.csv", [(f"INC000000{n}", "1 - A", "2026-01-05 10:00:00", "2026-01-06 10:00:00", "1", "T")])
    assert incremental.ingest_landing(store, str(landing)) == 3
    assert incremental.ingest_landing(store, str(landing)) == 0
    land(landing, "f9.csv", [("INC0000009", "1 - A", "2026-01-05 10:00:00", "2026-01-06 10:00:00", "1", "T")])
    land(landing, "f1.csv", [("INC0000011", "1 - A", "2026-01-05 10:00:00", "2026-01-06 10:00:00", "12", "T")])
    assert incremental.ingest_landing(store, str(landing)) == 2
    assert read == [["f0.csv", "f1.csv", "f2.csv"], ["f1.csv", "f9.csv"]]
    assert store.bronze().count() == 5 and store.catalogue().count() == 5


def test_catalogue_is_compacted(spark, store, monkeypatch):
    import datetime

    from faultline.plans import store as stores

    monkeypatch.setattr(stores, "COMPACT_AFTER", 4)
    moment = datetime.datetime(2026, 1, 1)
    for n in range(9):
        store.catalogue_files(store.catalogue_rows([(f"f{n}", n, moment, "h"), (f"f{n}", n, moment, "h")]))
    assert store.generation("catalogue") != "0" and store.control("generations").count() >= 2
    assert store.catalogue().count() == 9 and len(store.catalogue().inputFiles()) < 9


def test_content_is_lines_in_order_and_does_not_depend_on_blocks(spark, tmp_path):
    lines = [f"line {n % 700}," + "x" * (n % 90) for n in range(4000)]
    texts = {
        "a.csv": "\n".join(lines), "same.csv": "\n".join(lines), "swapped.csv": "\n".join([lines[1], lines[0], *lines[2:]]),
        "far.csv": "\n".join([lines[-1], *lines[1:-1], lines[0]]), "crlf.csv": "\r\n".join(lines), "end.csv": "\n".join(lines) + "\n",
        "one.csv": "x", "empty.csv": "",
    }
    folder = tmp_path / "texts"
    folder.mkdir()
    for name, text in texts.items():
        (folder / name).write_text(text, newline="")
    found = []
    for size in ("128m", "7k", "900"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "0" if size == "900" else "4m")
        try:
            rows = content_digests(spark, str(folder)).collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        found.append({r.source_path.rsplit("/", 1)[-1]: r.file_hash for r in rows})
    assert found[0] == found[1] == found[2]
    hashes = found[0]
    assert hashes["a.csv"] == hashes["same.csv"] and len(set(hashes.values())) == len(hashes) - 1
    assert set(texts) - set(hashes) == {"empty.csv"}


def test_contents_that_share_a_batch_id_stop_the_load(spark, store, tmp_path, monkeypatch):
    from faultline.sources import landing as landed

    monkeypatch.setattr(landed, "BATCH_ID_DIGITS", 0)
    for n in range(2):
        land(tmp_path / "landing", f"f{n}.csv", [(f"INC000000{n}", "1 - A", "2026-01-05 10:00:00", "2026-01-06 10:00:00", "1", "T")])
    with pytest.raises(RuntimeError, match="2 contents"):
        incremental.ingest_landing(store, str(tmp_path / "landing"))


def test_stream_stores_equal_files_once_and_names_empty_ones(spark, store, tmp_path):
    landing = tmp_path / "landing"
    land(landing, "a.csv", RAW_ROWS[:1])
    land(landing, "b copy.csv", RAW_ROWS[:1])
    land(landing, "c.csv", [])
    land(landing, "d.csv", RAW_ROWS[1:])
    query = start_landing_stream(store, str(landing), gold=False)
    query.awaitTermination()
    assert query.exception() is None and store.bronze().count() == len(RAW_ROWS)
    entries = {(r.source_file, r.status) for r in store.control("ledger").filter("layer = 'bronze'").collect()}
    assert entries == {("a.csv", "SUCCESS"), ("c.csv", "FAILED"), ("d.csv", "SUCCESS")}


def test_broken_file_among_many_is_found_by_halves(spark, store, tmp_path, monkeypatch):
    landing, tried = tmp_path / "landing", []
    whole = incremental.ingest_files
    monkeypatch.setattr(incremental, "ingest_files", lambda s, files: (tried.append(len(files)), whole(s, files))[1])
    for n in range(8):
        header = ["wrong", *HEADER[1:]] if n == 6 else HEADER
        land(landing, f"f{n}.csv", [(f"INC000000{n}", "1 - A", "2026-01-05 10:00:00", "2026-01-06 10:00:00", "1", "T")], header)
    with pytest.raises(Exception):
        incremental.ingest_landing(store, str(landing))
    entries = {r.source_file: r.status for r in store.control("ledger").collect()}
    assert entries == {f"f{n}.csv": "SUCCESS" for n in range(6)} | {"f6.csv": "FAILED"}
    assert tried == [8, 4, 4, 2, 2, 1]


def test_pending_batches_prune_the_folders(spark, store, tmp_path):
    landing = tmp_path / "landing"
    for n in range(4):
        land(landing, f"f{n}.csv", [(f"INC000000{n}", "1 - A", "2026-01-05 10:00:00", "2026-01-06 10:00:00", "1", "T")])
    incremental.ingest_landing(store, str(landing))
    wanted = store.control("ledger").filter("source_file = 'f2.csv'")
    rows = store.bronze(wanted)
    assert [r._source_file for r in rows.collect()] == ["f2.csv"]
    assert "dynamicpruning" in rows._jdf.queryExecution().executedPlan().toString().lower()


def test_upsert_searches_only_months_that_may_hold_an_id(spark, store, monkeypatch):
    """And gives the same state as one load over everything."""
    searched = []
    whole = Store.records
    monkeypatch.setattr(Store, "records", lambda self, slices=None: (searched.append(None if slices is None else len(slices)), whole(self, slices))[1])
    rows = [(f"INC{n:07d}", "1 - A", f"20{20 + n % 2}-{n // 2 % 12 + 1:02d}-05 10:00:00", "2026-01-06 10:00:00", "5", "T") for n in range(480)]

    def load(part, moment):
        raw = raw_rows(spark, part).withColumns(
            {"_batch_id": F.lit("b"), "_source_file": F.lit("f"), "_source_hash": F.lit("h"), "_ingested_at": F.lit(moment).cast("timestamp")}
        )
        searched.clear()
        incremental.upsert(store, silver_records(incremental.with_digest(raw)))
        return searched[0]

    assert load(rows, "2026-01-01") == 0
    assert len(store.slices()) == 24
    # A correction that moves one incident of 2020-01 to 2027-01, a new incident, and one without an id.
    moved = ("INC0000000", "1 - A", "2027-01-05 10:00:00", "2027-01-06 10:00:00", "7", "T")
    new = ("INC9990000", "1 - A", "2027-01-05 10:00:00", "2027-01-06 10:00:00", "8", "T")
    nobody = ("", "1 - A", "2027-02-05 10:00:00", "2027-02-06 10:00:00", "9", "T")
    assert load([moved, new, nobody], "2026-02-01") <= 3
    found = state(store)
    assert len(found) == 482 and found["INC0000000"] == ("VALID", 7) and found["INC9990000"] == ("VALID", 8)
    assert load([("", "1 - A", "2027-03-05 10:00:00", "2027-03-06 10:00:00", "3", "T")], "2026-03-01") <= 2
    assert state(store)[None] == ("INVALID", 3) and len(state(store)) == 482


def test_id_filters_have_no_false_negatives(spark):
    from faultline.plans import membership

    ids = spark.range(3000).select(F.format_string("INC%07d", "id").alias("incident_id"), F.lit(2020).alias("opened_year"),
                                   (F.col("id") % 3 + 1).cast("int").alias("opened_month"))
    powers = spark.createDataFrame([(2020, m, membership.power_for(1000)) for m in (1, 2, 3)], "opened_year int, opened_month int, power int")
    members = membership.member_bitmaps(ids, powers, "r")
    for wanted, months in ((range(0, 3000, 3), {1}), ((4,), {2}), ((5, 7), {2, 3})):
        probe = spark.createDataFrame([(f"INC{n:07d}",) for n in wanted], "incident_id string")
        assert months <= {r.opened_month for r in membership.possible_months(members, probe).collect()}
    strangers = spark.range(9000, 9400).select(F.format_string("INC%07d", "id").alias("incident_id"))
    matched = membership.possible_months(members, strangers).count()
    assert matched <= 1


def test_plain_session_gets_and_loses_the_profile(spark, store, tmp_path, monkeypatch):
    from faultline.session import ADAPTIVE_CONF

    land(tmp_path / "landing", "a.csv", RAW_ROWS)
    seen = {}
    gold = incremental.refresh_gold
    monkeypatch.setattr(incremental, "refresh_gold", lambda s: (seen.update({k: s.spark.conf.get(k) for k in ADAPTIVE_CONF}), gold(s))[1])
    before = {key: spark.conf.get(key) for key in ADAPTIVE_CONF}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
        incremental.run_incremental(store, str(tmp_path / "landing"))
        assert seen == ADAPTIVE_CONF
        assert spark.conf.get("spark.sql.adaptive.enabled") == "false" and spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "65535"
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_compressed_files_are_landed_files(spark, store, tmp_path):
    """In batch and stream; a compressed copy of an ingested text is known by its content."""
    landing, streamed = tmp_path / "landing", Store.create(spark, str(tmp_path / "streamed"))
    plain = land(landing, "a.csv", RAW_ROWS)
    (landing / "b.csv.gz").write_bytes(gzip.compress(plain.read_bytes()))
    other = land(tmp_path / "other", "c.csv", RAW_ROWS[:1])
    (landing / "c.csv.gz").write_bytes(gzip.compress(other.read_bytes()))
    hashes = {r.source_file: r.file_hash for r in landed_files(spark, str(landing)).collect()}
    assert set(hashes) == {"a.csv", "b.csv.gz", "c.csv.gz"} and hashes["a.csv"] == hashes["b.csv.gz"] != hashes["c.csv.gz"]
    assert landing_inventory(spark, str(landing)).first().file_count == 3
    assert incremental.ingest_landing(store, str(landing)) == 2
    start_landing_stream(streamed, str(landing), gold=False).awaitTermination()
    for each in (store, streamed):
        found = {r._source_file: r["count"] for r in each.bronze().groupBy("_source_file").count().collect()}
        assert found == {"a.csv": len(RAW_ROWS), "c.csv.gz": 1}


def test_monthly_batches_are_compressed(spark, tmp_path):
    rows = raw_rows(spark, [(f"INC{n:07d}", "1", f"2026-0{n % 2 + 1}-03", "", "", "") for n in range(500)])
    payloads.write_monthly_batches(rows, str(tmp_path))
    files = list(tmp_path.rglob("part-*"))
    assert files and all(file.name.endswith(".csv.gz") for file in files)
    assert read_incident_csv(spark, str(tmp_path)).count() == 500


def test_rows_of_landed_files_are_not_shuffled(spark, store, tmp_path, monkeypatch):
    """Their batch ids are broadcast even where Spark would not, and files are read a few at a time."""
    land(tmp_path / "landing", "a.csv", RAW_ROWS)
    plans = []

    def watched(store, rows):
        plans.append((rows._jdf.queryExecution().executedPlan().toString(), spark.conf.get("spark.sql.files.maxPartitionBytes")))
        return write_bronze(store, rows)

    write_bronze = incremental.write_bronze
    monkeypatch.setattr(incremental, "write_bronze", watched)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        incremental.ingest_landing(store, str(tmp_path / "landing"))
    plan, size = plans[0]
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and size == incremental.BYTES_PER_TASK
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_large_tables_are_dealt_into_tasks_of_bounded_size(spark, monkeypatch):
    """The number of tasks follows the rows; an order that would fill a task is left to adaptive execution."""
    monkeypatch.setattr(testbed, "ROWS_PER_TASK", 100)
    monkeypatch.setattr(testbed, "MOST_ROWS", 400)

    def tasks(lines):
        orders = lines.select(F.col("l_orderkey").alias("o_orderkey")).distinct()
        dealt = testbed.by_order(lines, orders)
        joined = dealt[0].join(dealt[1], F.col("l_orderkey") == F.col("o_orderkey"))
        assert joined.count() == lines.count()
        return [df.rdd.getNumPartitions() for df in dealt] if dealt[0] is not lines else None

    spread = spark.range(3000).select((F.col("id") % 700).alias("l_orderkey"))
    assert tasks(spread) == [30, 30]
    assert tasks(spread.limit(300)) is None
    assert tasks(spread.withColumn("l_orderkey", F.when(F.col("l_orderkey") % 3 == 0, 1).otherwise(F.col("l_orderkey")))) is None


def test_incident_ids_keep_their_format(spark):
    keys = spark.createDataFrame([(0,), (7,), (9_999_999,), (10_000_000,), (-5,)], "k bigint")
    rows = keys.select(testbed.incident_id("k").alias("id"), F.format_string("INC%07d", "k").alias("formatted")).collect()
    assert all(r.id == r.formatted for r in rows)


def test_upsert_and_gold_read_small_splits(spark, store, tmp_path, monkeypatch):
    """What sorts stored rows takes splits that fit in a task's memory; the session's settings come back."""
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.parquet.compression.codec")
    before, seen, written = [spark.conf.get(key) for key in keys], [], tables.write_counted

    def watched(df, path, *args, **kwargs):
        seen.append((path.removeprefix(store.root).split("/")[1], spark.conf.get(keys[0])))
        return written(df, path, *args, **kwargs)

    monkeypatch.setattr(incremental, "write_counted", watched)
    monkeypatch.setattr("faultline.plans.gold.write_counted", watched)
    landing = tmp_path / "landing"
    land(landing, "incidents_2026_01.csv", RAW_ROWS)
    assert incremental.run_incremental(store, str(landing)) == "SUCCESS"
    assert {size for folder, size in seen if folder in ("staging", "records", "gold")} == {"16m"}
    assert all(name.endswith(".zstd.parquet") for name in store.records().inputFiles()) and before == [spark.conf.get(key) for key in keys]
