"""Queries over the batch ledger, reconciliation and audit.

The ledger is derived from the given tables: one batch per shipping month with failed,
superseded, pending and deliberately inconsistent attempts.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.operators import ledger as L
from faultline.operators import quality, reconcile
from faultline.queries.frames import current, silver
from faultline.queries.registry import query
from faultline.queries.sqlbase import VIEWS
from faultline.session import new_run_dir
from faultline.sinks.tables import write_counted

HASH_SQL = "sha256('batch-' || batch_id)"
VIEWS["v_batch"] = f"""
    SELECT batch_id, count(*) AS n,
           count(*) FILTER (WHERE dq_status = 'VALID') AS valid, count(*) FILTER (WHERE dq_status = 'INVALID') AS invalid,
           CAST(substr(batch_id, 6, 2) AS INTEGER) AS m,
           CAST(strptime(batch_id || '_01', '%Y_%m_%d') + INTERVAL 1 MONTH AS TIMESTAMP) AS t0,
           'incidents_' || batch_id || '.csv' AS source_file, {HASH_SQL} AS file_hash
    FROM v_silver GROUP BY batch_id
"""
VIEWS["v_totals"] = """
    SELECT count(*) FILTER (WHERE dq_status = 'VALID') AS s, count(*) FILTER (WHERE dq_status = 'INVALID') AS q
    FROM v_latest
"""
EMPTY = "CAST(NULL AS BIGINT)"
VIEWS["v_ledger"] = f"""
    SELECT 'bronze' AS layer, batch_id, 'FAILED' AS status, source_file, file_hash, {EMPTY} AS records_written,
           {EMPTY} AS records_received, {EMPTY} AS valid_records_received, {EMPTY} AS invalid_records_received,
           {EMPTY} AS silver_total_records, {EMPTY} AS quarantine_total_records, {EMPTY} AS gold_snapshot_records,
           t0 AS processed_at FROM v_batch WHERE m % 5 = 0
    UNION ALL
    SELECT 'bronze', batch_id, 'SUCCESS', source_file, file_hash, n - 1, NULL, NULL, NULL, NULL, NULL, NULL,
           t0 + INTERVAL 6 HOUR FROM v_batch WHERE m % 7 = 0
    UNION ALL
    SELECT 'bronze', batch_id, 'SUCCESS', source_file, file_hash, n, NULL, NULL, NULL, NULL, NULL, NULL,
           t0 + INTERVAL 1 DAY FROM v_batch
    UNION ALL
    SELECT 'silver', batch_id, 'SUCCESS', source_file, CASE WHEN m = 9 THEN 'stale' ELSE file_hash END, NULL,
           n - CASE WHEN m = 11 THEN 1 ELSE 0 END, valid + CASE WHEN m = 10 THEN 1 ELSE 0 END, invalid, s, q, NULL,
           t0 + INTERVAL 2 DAY FROM v_batch, v_totals WHERE m <> 12
    UNION ALL
    SELECT 'gold', batch_id, 'SUCCESS', CASE WHEN m = 6 THEN 'renamed.csv' ELSE source_file END, file_hash, NULL,
           NULL, NULL, NULL, NULL, NULL, s, t0 + INTERVAL 3 DAY FROM v_batch, v_totals WHERE m NOT IN (8, 12)
"""
VIEWS["v_effective"] = """
    SELECT * FROM v_ledger WHERE status = 'SUCCESS'
    QUALIFY row_number() OVER (PARTITION BY layer, batch_id ORDER BY processed_at DESC) = 1
"""
VIEWS["v_matrix"] = """
    SELECT batch_id, bool_or(layer = 'bronze') AS in_bronze, bool_or(layer = 'silver') AS in_silver,
           bool_or(layer = 'gold') AS in_gold
    FROM v_effective GROUP BY batch_id
"""
VIEWS["v_meta_diff"] = """
    SELECT b.batch_id, o.layer, f.field, CASE f.field WHEN 'source_file' THEN b.source_file ELSE b.file_hash END AS expected,
           CASE f.field WHEN 'source_file' THEN o.source_file ELSE o.file_hash END AS actual
    FROM v_effective b JOIN v_effective o ON b.batch_id = o.batch_id AND b.layer = 'bronze' AND o.layer <> 'bronze'
    JOIN v_matrix m ON m.batch_id = b.batch_id AND m.in_silver AND m.in_gold
    JOIN (VALUES ('source_file'), ('file_hash')) f(field) ON true
    WHERE CASE f.field WHEN 'source_file' THEN b.source_file ELSE b.file_hash END
          IS DISTINCT FROM CASE f.field WHEN 'source_file' THEN o.source_file ELSE o.file_hash END
"""
VIEWS["v_intake_diff"] = """
    SELECT b.batch_id, b.records_written AS expected, s.records_received AS actual
    FROM v_effective b JOIN v_effective s ON b.batch_id = s.batch_id AND b.layer = 'bronze' AND s.layer = 'silver'
    WHERE b.records_written <> s.records_received
"""
VIEWS["v_split_diff"] = """
    SELECT batch_id, records_received AS expected, valid_records_received + invalid_records_received AS actual
    FROM v_effective
    WHERE layer = 'silver' AND records_received <> valid_records_received + invalid_records_received
"""
VIEWS["v_layer_totals"] = """
    SELECT count(*) FILTER (WHERE layer = 'bronze') AS bronze_batches,
           CAST(sum(records_written) FILTER (WHERE layer = 'bronze') AS BIGINT) AS bronze_records,
           count(*) FILTER (WHERE layer = 'silver') AS silver_batches,
           max(silver_total_records) AS silver_records, max(quarantine_total_records) AS quarantine_records,
           count(*) FILTER (WHERE layer = 'gold') AS gold_batches, max(gold_snapshot_records) AS gold_snapshot_records
    FROM v_effective
"""


def batches(spark, sf_dir):
    counted = quality.batch_quality(silver(spark, sf_dir)).withColumnRenamed("_batch_id", "batch_id")
    first = F.to_date(F.concat("batch_id", F.lit("_01")), "yyyy_MM_dd")
    return counted.select(
        "batch_id",
        "valid_records",
        "invalid_records",
        F.expr("valid_records + invalid_records").alias("n"),
        F.month(first).alias("m"),
        F.add_months(first, 1).cast("timestamp").alias("t0"),
        F.concat(F.lit("incidents_"), "batch_id", F.lit(".csv")).alias("source_file"),
        F.sha2(F.concat(F.lit("batch-"), "batch_id"), 256).alias("file_hash"),
    )


def table_totals(spark, sf_dir):
    return current(spark, sf_dir).agg(
        F.count_if(F.col("dq_status") == "VALID").alias("s"), F.count_if(F.col("dq_status") == "INVALID").alias("q")
    )


def ledger(spark, sf_dir):
    """Every batch with its attempts; the attempts of a batch are one array, so one scan does."""
    month, rows = F.col("m"), F.col("n")
    nothing = F.lit(None).cast("bigint")

    def attempt(layer, status, hours, when, **fields):
        values = {
            "source_file": F.col("source_file"), "file_hash": F.col("file_hash"), "records_written": nothing,
            "records_received": nothing, "valid_records_received": nothing, "invalid_records_received": nothing,
            "silver_total_records": nothing, "quarantine_total_records": nothing, "gold_snapshot_records": nothing,
        } | fields
        row = F.struct(
            F.lit(layer).alias("layer"),
            F.lit(status).alias("status"),
            *(column.alias(name) for name, column in values.items()),
            (F.col("t0") + F.make_dt_interval(hours=F.lit(hours))).alias("processed_at"),
        )
        return F.when(when, row)

    off = {m: (month == m).cast("int") for m in (10, 11)}
    totals = table_totals(spark, sf_dir).select(F.struct("s", "q")).scalar()
    attempts = [
        attempt("bronze", "FAILED", 0, month % 5 == 0),
        attempt("bronze", "SUCCESS", 6, month % 7 == 0, records_written=rows - 1),
        attempt("bronze", "SUCCESS", 24, F.lit(True), records_written=rows),
        attempt(
            "silver", "SUCCESS", 48, month != 12,
            file_hash=F.when(month == 9, "stale").otherwise(F.col("file_hash")),
            records_received=rows - off[11],
            valid_records_received=F.col("valid_records") + off[10],
            invalid_records_received=F.col("invalid_records"),
            silver_total_records=F.col("totals.s"),
            quarantine_total_records=F.col("totals.q"),
        ),
        attempt(
            "gold", "SUCCESS", 72, ~month.isin(8, 12),
            source_file=F.when(month == 6, "renamed.csv").otherwise(F.col("source_file")),
            gold_snapshot_records=F.col("totals.s"),
        ),
    ]
    with_totals = batches(spark, sf_dir).withColumn("totals", totals)
    rows = with_totals.select("batch_id", F.inline(F.array_compact(F.array(*attempts))))
    # A ledger is a stored table; the checks read it several times.
    folder = new_run_dir(spark, "ledger")
    write_counted(rows, folder)
    return spark.read.parquet(folder)


BATCH_SQL = "layer, batch_id, source_file, file_hash, records_written, records_received, processed_at"


@query("effective_batches", f"SELECT {BATCH_SQL} FROM v_effective")
def effective_batches(spark, sf_dir):
    rows = L.effective_batches(ledger(spark, sf_dir))
    return rows.withColumn("processed_at", F.col("processed_at").cast("timestamp_ntz")).select(*BATCH_SQL.split(", "))


@query(
    "pending_batches",
    """SELECT 'silver' AS for_layer, batch_id FROM v_matrix WHERE in_bronze AND NOT in_silver
       UNION ALL SELECT 'gold', batch_id FROM v_matrix WHERE in_silver AND NOT in_gold""",
)
def pending_batches(spark, sf_dir):
    book = ledger(spark, sf_dir)
    parts = [
        L.pending_batches(book, up, down).select(F.lit(down).alias("for_layer"), "batch_id")
        for up, down in (("bronze", "silver"), ("silver", "gold"))
    ]
    return parts[0].union(parts[1])


@query(
    "latest_batch",
    """SELECT layer, batch_id, silver_total_records, quarantine_total_records, gold_snapshot_records FROM v_effective
       QUALIFY row_number() OVER (PARTITION BY layer ORDER BY processed_at DESC, batch_id DESC) = 1""",
)
def latest_batch(spark, sf_dir):
    return L.latest_batch(L.effective_batches(ledger(spark, sf_dir))).drop("processed_at")


@query("control_snapshot", "SELECT *, (SELECT count(*) FROM v_batch) AS landing_files FROM v_layer_totals")
def control_snapshot(spark, sf_dir):
    return L.control_snapshot(ledger(spark, sf_dir), batches(spark, sf_dir).select("source_file"))


@query(
    "silver_ledger",
    """SELECT layer, batch_id, status, source_file, file_hash, n AS records_received, valid AS valid_records_received,
              invalid AS invalid_records_received, s AS silver_total_records, q AS quarantine_total_records
       FROM (SELECT 'silver' AS layer, 'SUCCESS' AS status, * FROM v_batch, v_totals)""",
)
def silver_ledger(spark, sf_dir):
    rows = batches(spark, sf_dir)
    totals = table_totals(spark, sf_dir)
    entries = L.silver_entries(
        rows.select("batch_id", "source_file", "file_hash"),
        rows.select("batch_id", "valid_records", "invalid_records"),
        totals.select("s").scalar(),
        totals.select("q").scalar(),
    )
    return entries.drop("processed_at")


def matrix(spark, sf_dir):
    return reconcile.batch_matrix(L.effective_batches(ledger(spark, sf_dir)))


@query("reconcile_batches", "SELECT *, in_bronze AND in_silver AND in_gold AS in_all_layers FROM v_matrix")
def reconcile_batches(spark, sf_dir):
    return reconcile.batch_presence(matrix(spark, sf_dir))


@query("reconcile_metadata", "SELECT * FROM v_meta_diff")
def reconcile_metadata(spark, sf_dir):
    return reconcile.metadata_differences(matrix(spark, sf_dir))


@query("reconcile_intake", "SELECT * FROM v_intake_diff")
def reconcile_intake(spark, sf_dir):
    return reconcile.intake_differences(matrix(spark, sf_dir))


@query("reconcile_dq_split", "SELECT * FROM v_split_diff")
def reconcile_dq_split(spark, sf_dir):
    return reconcile.split_differences(matrix(spark, sf_dir))


VIEWS["v_checks"] = """
    SELECT check_name, CASE WHEN ok THEN 'PASS' ELSE 'FAIL' END AS status, CAST(expected AS VARCHAR) AS expected,
           CAST(actual AS VARCHAR) AS actual
    FROM (
        SELECT 'batch_sets_match' AS check_name, count(*) = 0 AS ok, '0' AS expected, CAST(count(*) AS VARCHAR) AS actual
        FROM v_matrix WHERE NOT (in_bronze AND in_silver AND in_gold)
        UNION ALL SELECT 'batch_metadata_match', count(*) = 0, '0', CAST(count(*) AS VARCHAR) FROM v_meta_diff
        UNION ALL SELECT 'batch_intake_counts_match', count(*) = 0, '0', CAST(count(*) AS VARCHAR) FROM v_intake_diff
        UNION ALL SELECT 'batch_dq_split_matches', count(*) = 0, '0', CAST(count(*) AS VARCHAR) FROM v_split_diff
        UNION ALL SELECT 'snapshot_conservation', bronze_records - silver_records - quarantine_records >= 0,
                         'valor maior ou igual a zero', CAST(bronze_records - silver_records - quarantine_records AS VARCHAR)
                  FROM v_layer_totals
        UNION ALL SELECT 'gold_snapshot_matches_silver', silver_records = gold_snapshot_records,
                         CAST(silver_records AS VARCHAR), CAST(gold_snapshot_records AS VARCHAR) FROM v_layer_totals
        UNION ALL SELECT 'bronze_paths_exist', true, '0', '0'
        UNION ALL SELECT 'bronze_control_matches_storage', bronze_records = n, CAST(bronze_records AS VARCHAR),
                         CAST(n AS VARCHAR) FROM v_layer_totals, (SELECT count(*) AS n FROM v_silver)
        UNION ALL SELECT 'silver_control_matches_storage', silver_records = s, CAST(silver_records AS VARCHAR),
                         CAST(s AS VARCHAR) FROM v_layer_totals, v_totals
        UNION ALL SELECT 'quarantine_control_matches_storage', quarantine_records = q,
                         CAST(quarantine_records AS VARCHAR), CAST(q AS VARCHAR) FROM v_layer_totals, v_totals
        UNION ALL SELECT 'gold_outputs_exist', true, '0', '0')
"""


def checks(spark, sf_dir):
    totals = table_totals(spark, sf_dir)
    stored = silver(spark, sf_dir).agg(F.count("*").alias("bronze_records")).scalar()
    physical = totals.select(
        stored.alias("bronze_records"),
        F.col("s").alias("silver_records"),
        F.col("q").alias("quarantine_records"),
        F.lit(0).cast("bigint").alias("missing_bronze_paths"),
        F.lit(0).cast("bigint").alias("missing_gold_outputs"),
    )
    return reconcile.reconciliation_checks(ledger(spark, sf_dir), physical)


@query("reconcile_report", "SELECT * FROM v_checks")
def reconcile_report(spark, sf_dir):
    return checks(spark, sf_dir).drop("message")


@query(
    "reconcile_verdict",
    """SELECT CASE WHEN count(*) FILTER (WHERE status = 'FAIL') = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
              count(*) AS checks_total, count(*) FILTER (WHERE status = 'PASS') AS checks_passed,
              count(*) FILTER (WHERE status = 'FAIL') AS checks_failed FROM v_checks""",
)
def reconcile_verdict(spark, sf_dir):
    return reconcile.reconciliation_verdict(checks(spark, sf_dir))
