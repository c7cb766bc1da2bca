"""Incremental load: landed files -> Bronze batches -> upserted records -> Gold -> checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.config import SLA, SlaPolicy
from faultline.operators.ledger import control_snapshot, effective_batches, pending_batches, silver_entries
from faultline.operators.quality import batch_quality, latest_versions, version_order
from faultline.operators.reconcile import missing_gold, reconciliation_checks
from faultline.operators.sla import AUDIT_COLUMNS, audit_sla
from faultline.plans.gold import write_gold
from faultline.plans.membership import BITMAP_BITS, has_bit, member_bitmaps, possible_months, power_for
from faultline.plans.silver import silver_records
from faultline.plans.store import FILE_KEYS, SLICE_COLUMNS, STORE_TIEBREAK, Slice, Store
from faultline.schema import RAW_SCHEMA
from faultline.session import COMPACT_CONF, adaptive_profile, compact_profile
from faultline.sinks.tables import WriteMismatch, balanced_by, write_counted
from faultline.sources.incident_csv import add_source_file, read_incident_csv
from faultline.sources.landing import (
    content_digests, file_listing, hashed_files, identified, listed_files, literal_path, pending_files, shared_batch_ids,
)


# Landed files that one task reads together, by their stored size.
BYTES_PER_TASK = COMPACT_CONF["spark.sql.files.maxPartitionBytes"]


class EmptyBatch(RuntimeError):
    """A landed file has no rows; the ledger already says so."""


# ---------------------------------------------------------------------------------- bronze
def with_digest(raw: DataFrame) -> DataFrame:
    return raw.withColumn("_row_digest", F.xxhash64(*(F.col(f"`{c}`") for c in RAW_SCHEMA.names)))


def write_bronze(store: Store, rows: DataFrame) -> int:
    """Write batches to their own folders and return the number of rows, observed on the way.

    Dynamic overwrite makes a repeated batch replace itself instead of doubling.
    """
    columns = rows.select(*store.bronze_schema().names)
    return write_counted(columns, store.path("bronze"), ["_batch_id"], replace_partitions=True)["rows"]


def stored_counts(store: Store, batches: DataFrame) -> DataFrame:
    """(batch_id, records_written) of the given batches, from the footers of their folders."""
    found = store.bronze(batches).groupBy(F.col("_batch_id").alias("batch_id"))
    return found.agg(F.count("*").alias("records_written"))


def bronze_ledger(files: DataFrame, counts: DataFrame) -> DataFrame:
    """Ledger rows of ingested files; a file without rows is a failure."""
    filled = F.col("records_written") > 0
    return files.join(counts, "batch_id", "left").select(
        F.lit("bronze").alias("layer"),
        "batch_id",
        F.when(filled, "SUCCESS").otherwise("FAILED").alias("status"),
        "source_file",
        "file_hash",
        F.coalesce("records_written", F.lit(0)).alias("records_written"),
        F.when(~filled | filled.isNull(), F.lit("empty batch")).alias("error"),
        F.current_timestamp().alias("processed_at"),
    )


def ingest_files(store: Store, files: list) -> None:
    spark = store.spark
    listed = spark.createDataFrame(files)
    raw = add_source_file(read_incident_csv(spark, [literal_path(file.path) for file in files]))
    lineage = listed.select(
        F.col("source_path").alias("_source_path"),
        F.col("source_file").alias("_source_file"),
        F.col("batch_id").alias("_known_batch"),
        F.col("file_hash").alias("_source_hash"),
    )
    unlisted = F.raise_error(F.concat(F.lit("row of a file that was not listed: "), F.col("_source_path")))
    rows = (
        raw.drop("_source_file")
        # One row a file, in a list that the driver holds already: the rows of the files stay where they are read.
        .join(F.broadcast(lineage), "_source_path", "left")
        .withColumn("_batch_id", F.coalesce("_known_batch", unlisted.cast("string")))
        .withColumn("_ingested_at", F.current_timestamp())
    )
    # A task sorts what it writes, so few compressed files go to one task.
    with compact_profile(spark):
        written = write_bronze(store, with_digest(rows))
    counts = stored_counts(store, listed)
    stored = counts.agg(F.coalesce(F.sum("records_written"), F.lit(0))).first()[0]
    if stored != written:
        raise WriteMismatch(f"{written} Bronze rows written, {stored} stored")
    entries = bronze_ledger(listed, counts)
    store.append("ledger", entries)
    empty = [row.source_file for row in entries.filter("status = 'FAILED'").select("source_file").collect()]
    if empty:
        raise EmptyBatch(", ".join(empty))


def record_failure(store: Store, file, error: Exception) -> None:
    row = store.spark.createDataFrame([file]).select(
        F.lit("bronze").alias("layer"),
        "batch_id",
        F.lit("FAILED").alias("status"),
        "source_file",
        "file_hash",
        F.lit(str(error)).alias("error"),
        F.current_timestamp().alias("processed_at"),
    )
    store.append("ledger", row)


def catalogued(store: Store, listed: DataFrame) -> DataFrame:
    """The listed files with their hashes; only files the catalogue does not know are read."""
    keys = list(FILE_KEYS)
    # As with any read of many files, their names are on the driver; their contents are not.
    fresh = [row.path for row in listed.join(store.catalogue(), keys, "left_anti").select("path").collect()]
    if fresh:
        named = store.spark.createDataFrame([(path,) for path in fresh], "path string")
        new = listed.join(named, "path", "left_semi")
        store.catalogue_files(hashed_files(new, content_digests(store.spark, fresh)))
    return identified(listed.join(store.catalogue(), keys))


def ingest_listed(store: Store, listed: DataFrame) -> int:
    """Ingest every listed file whose content was never ingested and return their number.

    If the job over all of them fails, halves of the list are tried until the broken file is alone
    and the ledger can name it; files before it, in name order, stay ingested, and the error is raised.
    """
    ledger = store.control("ledger")
    found = pending_files(catalogued(store, listed), ledger)
    files = found.orderBy("source_file", "path").collect()
    if not files:
        return 0
    clash = shared_batch_ids(store.spark.createDataFrame(files), ledger).first()
    if clash is not None:
        raise RuntimeError(f"batch id {clash.batch_id} stands for {clash.contents} contents")
    ingest_or_name(store, files)
    return len(files)


def ingest_or_name(store: Store, files: list) -> None:
    try:
        ingest_files(store, files)
    except EmptyBatch:
        raise
    except Exception as error:  # noqa: BLE001 - attributed to a file, then raised again
        if len(files) == 1:
            record_failure(store, files[0], error)
            raise
        half = len(files) // 2
        ingest_or_name(store, files[:half])
        ingest_or_name(store, files[half:])


def ingest_landing(store: Store, landing: str) -> int:
    return ingest_listed(store, listed_files(file_listing(store.spark, landing)))


# ---------------------------------------------------------------------------------- silver
# Loads above this share of the stored incidents look at all months instead of asking the filters.
FILTERED_SHARE = 1 / 16


def months_to_search(store: Store, ids: DataFrame, slices: list[Slice]) -> list[Slice]:
    """Months that may hold one of the ids, by their filters; all of them for a large load."""
    filled = [part for part in slices if part.valid + part.invalid]
    stored = sum(part.valid + part.invalid for part in filled)
    most = int(stored * FILTERED_SHARE)
    if ids.limit(most + 1).count() > most:
        return filled
    matched = {(r.opened_year, r.opened_month) for r in possible_months(store.members(filled), ids).collect()}
    return [part for part in filled if part.key in matched]


def touched_months(store: Store, staged: DataFrame, slices: list[Slice], policy: SlaPolicy) -> set[tuple]:
    """Months whose stored rows can change.

    These are the months of the incoming rows, the months that hold an older version of an
    incoming incident, and months audited under another rule version.
    """
    months = staged.select("opened_year", "opened_month").distinct()
    ids = staged.select("incident_id").distinct()
    # Adaptive execution broadcasts the incoming ids only if they turn out to be small.
    searched = store.records(months_to_search(store, ids, slices)).select("incident_id", "opened_year", "opened_month")
    named = ids.select(F.col("incident_id").alias("_id"))
    older = searched.join(named, F.col("incident_id").eqNullSafe(F.col("_id")), "left_semi")
    both = months.union(older.select("opened_year", "opened_month").distinct()).distinct()
    touched = {tuple(row) for row in both.collect()}
    return touched | {part.key for part in slices if part.rule_version != policy.version}


def write_members(store: Store, stored: DataFrame, counts: dict[tuple, tuple[int, int]], run: str) -> None:
    """The id filters of the months that a run wrote."""
    sizes = [(*key, power_for(sum(held))) for key, held in counts.items()]
    powers = store.spark.createDataFrame(sizes, "opened_year int, opened_month int, power int")
    rows = member_bitmaps(stored, powers, run).drop("run")
    rows.write.mode("overwrite").parquet(store.path("members", f"run={run}"))


# Where a row is stored: its file, a block of rows in it and its bit in the block's bitmap.
PLACE = ("_file", "_block", "_bit")
# Bitmaps up to this size, a bit a row, are sent to all tasks; larger ones are joined by a shuffle.
BITMAPS_SENT = 1 << 28


def placed(rows: DataFrame) -> DataFrame:
    """Rows of a plain read of Parquet files with their places."""
    index = F.col("_metadata.row_index")
    places = (F.col("_metadata.file_path"), F.floor(index / BITMAP_BITS), (index % BITMAP_BITS))
    return rows.withColumns(dict(zip(PLACE, places)))


def newest_places(versions: DataFrame, tiebreak) -> DataFrame:
    """Bitmaps, by file and block, of the rows that are the newest version of their incident."""
    narrow = versions.select("incident_id", *version_order(versions, tiebreak), *PLACE)
    newest = latest_versions(narrow, tiebreak).select(*PLACE).repartition("_file", "_block")
    return newest.groupBy("_file", "_block").agg(F.bitmap_construct_agg("_bit").alias("_newest"))


def merge_versions(store: Store, frames: list[DataFrame], policy: SlaPolicy, tiebreak) -> DataFrame:
    """Newest version per incident of the stored and incoming rows, audited again and grouped by month.

    The choice is made on ids, ages and places, so whole rows cross one shuffle only, to their months.
    """
    versions = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (placed(rows) for rows in frames))
    folder = store.path("staging", store.new_run())
    blocks = write_counted(newest_places(versions, tiebreak), folder)["rows"]
    places = store.spark.read.schema("_file string, _block bigint, _newest binary").parquet(folder)
    if blocks * BITMAP_BITS // 8 <= BITMAPS_SENT:
        places = F.broadcast(places)
    newest = versions.join(places, ["_file", "_block"]).filter(has_bit("_newest", "_bit"))
    names = [name for name in versions.columns if name not in PLACE]
    carried = newest.select(*(name for name in names if name not in AUDIT_COLUMNS))
    audited = audit_sla(balanced_by(carried, "opened_year", "opened_month"), policy)
    return audited.select(*names, *(name for name in AUDIT_COLUMNS if name not in names))


def upsert(
    store: Store, staged: DataFrame, policy: SlaPolicy = SLA, tiebreak=STORE_TIEBREAK, filed: bool = False
) -> dict[str, int]:
    """Merge staged rows into the current records; rewrites only the touched months.

    ``filed`` says that the rows are a plain read of Parquet files; others are written to such files first.
    """
    with compact_profile(store.spark):
        if not filed:
            folder, schema = store.path("staging", store.new_run()), staged.schema
            write_counted(staged, folder)
            staged = store.spark.read.schema(schema).parquet(folder)
        return upsert_staged(store, staged, policy, tiebreak)


def upsert_staged(store: Store, staged: DataFrame, policy: SlaPolicy, tiebreak) -> dict[str, int]:
    spark, run = store.spark, store.new_run()
    slices = store.slices()
    touched = touched_months(store, staged, slices, policy)
    affected = [part for part in slices if part.key in touched]
    before = sum(part.valid + part.invalid for part in affected)
    received = staged.count()

    merged = merge_versions(store, [store.records(affected), staged] if before else [staged], policy, tiebreak)
    target = store.path("records", f"run={run}")
    written = write_counted(
        merged,
        target,
        SLICE_COLUMNS,
        extra={
            "valid": F.count_if(F.col("dq_status") == "VALID"),
            "invalid": F.count_if(F.col("dq_status") == "INVALID"),
        },
    )
    rewritten = spark.read.schema(store.record_schema()).parquet(target)
    stored = (
        rewritten
        .groupBy("opened_year", "opened_month")
        .agg(
            F.count_if(F.col("dq_status") == "VALID").alias("valid_records"),
            F.count_if(F.col("dq_status") == "INVALID").alias("invalid_records"),
        )
    ).collect()
    found = sum(row.valid_records + row.invalid_records for row in stored)
    if not (found == written["rows"] == written["valid"] + written["invalid"] <= before + received):
        raise WriteMismatch(f"upsert {run}: {before} + {received} rows in, {written} written, {found} stored")

    counts = {(row.opened_year, row.opened_month): (row.valid_records, row.invalid_records) for row in stored}
    write_members(store, rewritten, counts, run)
    sequence = store.next_sequence("slices")
    index = [
        (*key, run, sequence, policy.version, *counts.get(key, (0, 0))) for key in sorted(touched | set(counts), key=str)
    ]
    store.append("slices", spark.createDataFrame(index, store.control_tables()["slices"]))
    now = store.slices()
    return {
        "received": received,
        "merged": found,
        "duplicates": before + received - found,
        "silver_total": sum(part.valid for part in now),
        "quarantine_total": sum(part.invalid for part in now),
    }


def refresh_silver(store: Store, policy: SlaPolicy = SLA, tiebreak=STORE_TIEBREAK) -> dict[str, int] | None:
    """Apply batches that Bronze finished and Silver did not; None when there are none."""
    spark = store.spark
    ledger = store.control("ledger")
    pending = pending_batches(ledger, "bronze", "silver").select("batch_id", "source_file", "file_hash", "records_written")
    batches = pending.collect()
    if not batches:
        return None
    staging = store.path("staging", store.new_run())
    transformed = silver_records(store.bronze(pending), policy)
    with compact_profile(spark):
        count = write_counted(transformed, staging)["rows"]
    expected = sum(b.records_written for b in batches)
    if count != expected:
        raise WriteMismatch(f"{expected} Bronze rows, {count} transformed")
    staged = spark.read.schema(transformed.schema).parquet(staging)
    totals = upsert(store, staged, policy, tiebreak, filed=True)
    quality = batch_quality(staged).withColumnRenamed("_batch_id", "batch_id")
    rows = silver_entries(
        spark.createDataFrame(batches), quality, totals["silver_total"], totals["quarantine_total"]
    )
    store.append("ledger", rows)
    return totals


# ------------------------------------------------------------------------------------ gold
def refresh_gold(store: Store) -> dict[str, int] | None:
    """Rebuild Gold if Silver has batches Gold has not seen; None when there are none."""
    spark = store.spark
    pending = pending_batches(store.control("ledger"), "silver", "gold").select("batch_id", "source_file", "file_hash")
    batches = pending.collect()
    if not batches:
        return None
    run = store.new_run()
    valid = store.valid_records()
    counts = write_gold(spark, valid, store.path("gold", f"run={run}"))
    snapshot = sum(part.valid for part in store.slices())
    sequence = store.next_sequence("gold_runs")
    store.append("gold_runs", spark.createDataFrame([(run, sequence)], store.control_tables()["gold_runs"]))
    rows = spark.createDataFrame(batches).select(
        F.lit("gold").alias("layer"),
        "batch_id",
        F.lit("SUCCESS").alias("status"),
        "source_file",
        "file_hash",
        F.lit(snapshot).cast("bigint").alias("gold_snapshot_records"),
        F.current_timestamp().alias("processed_at"),
    )
    store.append("ledger", rows)
    return counts


# ---------------------------------------------------------------------------------- checks
def stored_gold_tables(store: Store) -> DataFrame:
    """Names of the Gold tables present in the current run, from a file listing."""
    path = store.gold_path()
    if path is None:
        return store.spark.createDataFrame([], "table_name string")
    files = store.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.select(F.element_at(F.split("path", "/"), -2).alias("table_name")).distinct()


def physical_state(store: Store) -> DataFrame:
    """One row with what is stored, independent of the ledger."""
    spark = store.spark
    done = effective_batches(store.control("ledger")).filter("layer = 'bronze'").select("batch_id")
    stored = store.bronze().groupBy(F.col("_batch_id").alias("batch_id")).agg(F.count("*").alias("n"))
    bronze = stored.join(done, "batch_id", "left_semi").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    missing = done.join(stored, "batch_id", "left_anti").agg(F.count("*").alias("n"))
    by_status = store.records().agg(
        F.count_if(F.col("dq_status") == "VALID").alias("silver_records"),
        F.count_if(F.col("dq_status") == "INVALID").alias("quarantine_records"),
    )
    absent = missing_gold(stored_gold_tables(store)).agg(F.count("*").alias("n"))
    return by_status.select(
        bronze.scalar().alias("bronze_records"),
        "silver_records",
        "quarantine_records",
        missing.scalar().alias("missing_bronze_paths"),
        absent.scalar().alias("missing_gold_outputs"),
    )


def reconcile(store: Store) -> DataFrame:
    return reconciliation_checks(store.control("ledger"), physical_state(store))


def record_checks(store: Store, run_id: str) -> None:
    """Append the report to the history; a failed check then fails the run."""
    report = reconcile(store).withColumns({"run_id": F.lit(run_id), "processed_at": F.current_timestamp()})
    store.append("checks", report)
    require_pass(store.control("checks").filter(F.col("run_id") == run_id))


def orphan_batches(store: Store) -> DataFrame:
    """Bronze folders of dead jobs: stored batches that the ledger does not know as ingested."""
    done = effective_batches(store.control("ledger")).filter("layer = 'bronze'").select("batch_id")
    stored = store.bronze().groupBy(F.col("_batch_id").alias("batch_id")).agg(F.count("*").alias("records"))
    return stored.join(done, "batch_id", "left_anti")


# ------------------------------------------------------------------------------- whole run
def run_incremental(store: Store, landing: str, policy: SlaPolicy = SLA) -> str:
    """One run over all stages, recorded in the run history even when a stage fails.

    The runtime settings of the library hold during the run and are restored afterwards.
    """
    with adaptive_profile(store.spark):
        return run_stages(store, landing, policy)


def run_stages(store: Store, landing: str, policy: SlaPolicy) -> str:
    stages: list[tuple[str, str]] = []
    run_id = store.new_run()
    started = F.lit(store.spark.sql("SELECT current_timestamp()").first()[0])
    steps = {
        "bronze": lambda: ingest_landing(store, landing),
        "silver": lambda: refresh_silver(store, policy),
        "gold": lambda: refresh_gold(store),
        "reconciliation": lambda: record_checks(store, run_id),
    }
    status = "FAILED"
    try:
        for name, step in steps.items():
            stages.append((name, "FAILED"))
            step()
            stages[-1] = (name, "SUCCESS")
        status = "SUCCESS"
    finally:
        record_run(store, run_id, landing, status, started, stages)
    return status


def require_pass(checks: DataFrame) -> None:
    failed = [row.check_name for row in checks.filter("status = 'FAIL'").collect()]
    if failed:
        raise RuntimeError(f"reconciliation failed: {', '.join(failed)}")


def record_run(
    store: Store, run_id: str, landing: str, status: str, started, stages: list[tuple[str, str]]
) -> None:
    spark = store.spark
    snapshot = control_snapshot(store.control("ledger"), file_listing(spark, landing).select("path"))
    done = F.array(*(F.struct(F.lit(n).alias("name"), F.lit(s).alias("status")) for n, s in stages))
    row = snapshot.withColumnRenamed("gold_snapshot_records", "gold_records").select(
        F.lit(run_id).alias("run_id"),
        F.lit(status).alias("status"),
        started.alias("started_at"),
        F.current_timestamp().alias("finished_at"),
        done.alias("stages"),
        "landing_files", "bronze_batches", "bronze_records", "silver_batches", "silver_records", "quarantine_records",
        "gold_batches", "gold_records",
    )
    store.append("runs", row)
