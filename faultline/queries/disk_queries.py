"""Queries that write to the shared folder and read back what was stored.

Every run takes a new folder, so a repeated or concurrent run never meets another's files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from faultline.operators import aggregates, contracts
from faultline.operators.quality import latest_versions
from faultline.plans import incremental, publication, publish
from faultline.plans.gold import write_gold
from faultline.plans.store import Store
from faultline.queries.frames import current, plain_time, raw, silver, stored_valid, trends, valid
from faultline.queries.registry import query
from faultline.queries.silver_queries import KEYS_SQL, with_keys
from faultline.queries.sqlbase import VIEWS
from faultline.queries.workload_queries import GOLD_VIEWS
from faultline.schema import RAW_SCHEMA, SOURCE_COLUMNS
from faultline.session import compact_profile, new_run_dir, settings
from faultline.sinks import payloads, tables
from faultline.sources.incident_csv import READ_OPTIONS, WRITE_OPTIONS, add_lineage, add_source_file, read_incident_csv
from faultline.sources.landing import LANDED, landed_files, landing_inventory, pending_files
from faultline.sources.lines import CHUNK, folded
from faultline.sources.testbed import POLICY, VERSION_TIEBREAK
from faultline.streaming.landing_stream import start_landing_stream

TIEBREAK_DDL = "_line_number int, _part_key bigint, _supplier_key bigint, _extended_price double"


def extract(spark, sf_dir) -> DataFrame:
    """Raw versions with just the columns of the incident extract."""
    return of_extract(raw(spark, sf_dir))


def of_extract(rows: DataFrame) -> DataFrame:
    return rows.select(*(F.col(f"`{name}`") for name in RAW_SCHEMA.names))


def landing(spark, sf_dir) -> str:
    """Landing folder with the CSV files of every opening month; dealt to months in columnar files, not in a shuffle."""
    folder, dealt = new_run_dir(spark, "landing"), new_run_dir(spark, "dealt")
    months = F.replace(F.substring("Aberto", 1, 7), F.lit("-"), F.lit("_")).alias("_month")
    with compact_profile(spark), settings(spark, tables.SCAN_CONF):
        rows = tables.stored_by(spark, of_extract(raw(spark, sf_dir)).select("*", months), dealt, "_month")
        payloads.write_monthly_batches(of_extract(rows), folder, dealt=True)
    return folder


def store_for(spark, label, extra=None) -> Store:
    return Store.create(spark, new_run_dir(spark, label), extra)


# ---------------------------------------------------------------------------------- scans
CSV_COLUMNS = [name for name in SOURCE_COLUMNS.values() if name != "solution"]


@query("scan_incident_csv", f"SELECT {', '.join(CSV_COLUMNS)} FROM v_raw")
def scan_incident_csv(spark, sf_dir):
    folder = new_run_dir(spark, "extract")
    extract(spark, sf_dir).write.options(**WRITE_OPTIONS).csv(folder)
    return read_incident_csv(spark, folder).withColumnsRenamed(SOURCE_COLUMNS).select(*CSV_COLUMNS)


@query("scan_incidents", f"SELECT {KEYS_SQL}, closed_at, duration_seconds, dq_status FROM v_latest")
def scan_incidents(spark, sf_dir):
    folder = new_run_dir(spark, "incidents")
    tables.write_counted(current(spark, sf_dir), folder)
    return with_keys(spark.read.parquet(folder), plain_time("closed_at"), "duration_seconds", "dq_status")


def bronze_store(spark, sf_dir) -> Store:
    """Bronze batches written from the versions, one folder per shipping month, and their ledger."""
    store = store_for(spark, "bronze", TIEBREAK_DDL)
    rows = raw(spark, sf_dir).withColumns(
        {"_source_file": F.concat(F.lit("incidents_"), "_batch_id", F.lit(".csv")), "_source_hash": F.sha2("_batch_id", 256)}
    )
    incremental.write_bronze(store, incremental.with_digest(rows))
    batches = store.bronze().select(F.col("_batch_id").alias("batch_id"), F.col("_source_file").alias("source_file"),
                                    F.col("_source_hash").alias("file_hash")).distinct()
    store.append("ledger", incremental.bronze_ledger(batches, incremental.stored_counts(store, batches)))
    return store


@query(
    "scan_pending_batches",
    f"SELECT {KEYS_SQL} FROM v_raw WHERE batch_id > (SELECT max(batch_id) FROM v_raw WHERE batch_id LIKE '%_12')",
)
def scan_pending_batches(spark, sf_dir):
    """Only the folders of batches after the last December are read: the ledger's ids prune them."""
    store = bronze_store(spark, sf_dir)
    december = store.control("ledger").filter("batch_id LIKE '%_12'").agg(F.max("batch_id")).scalar()
    later = store.control("ledger").filter(F.col("batch_id") > december)
    return with_keys(store.bronze(later).withColumnRenamed("Número", "incident_id"))


@query(
    "add_lineage",
    "SELECT count(*) AS rows, count(*) AS with_time, count(*) AS with_file FROM v_raw",
)
def lineage(spark, sf_dir):
    files = read_incident_csv(spark, landing(spark, sf_dir))
    tagged = add_lineage(files, F.sha2(F.col("_metadata.file_path"), 256), F.lit("hash"))
    return tagged.agg(
        F.count("*").alias("rows"),
        F.count("_ingested_at").alias("with_time"),
        F.count_if(F.col("_source_file").rlike(r"\.csv(\.gz)?$")).alias("with_file"),
    )


# -------------------------------------------------------------------------------- landing
OPENING_MONTHS = "SELECT strftime(opened_at, '%Y_%m') AS batch_month, count(*) AS rows FROM v_typed GROUP BY ALL"


def batch_month(path: str):
    return F.regexp_extract(path, r"batch_month=(\d{4}_\d{2})", 1)


@query("pending_files", f"SELECT * FROM ({OPENING_MONTHS}) WHERE batch_month > '1995_12'")
def files_pending(spark, sf_dir):
    """Opening months, with their rows, that are left after the ledger knows those up to 1995."""
    folder = landing(spark, sf_dir)
    files = landed_files(spark, folder)
    known = files.filter(batch_month("path") <= "1995_12").select(
        F.lit("bronze").alias("layer"), F.lit("SUCCESS").alias("status"), "file_hash"
    )
    left = pending_files(files, known).select("source_path")
    rows = add_source_file(read_incident_csv(spark, folder)).join(left, F.col("_source_path") == F.col("source_path"))
    return rows.groupBy(batch_month("source_path").alias("batch_month")).agg(F.count("*").alias("rows"))


@query(
    "landing_inventory",
    "SELECT 'READY' AS status, count(DISTINCT strftime(opened_at, '%Y_%m')) AS months, true AS names_complete,"
    " true AS bytes_complete FROM v_typed",
)
def inventory(spark, sf_dir):
    folder = landing(spark, sf_dir)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", LANDED).load(folder)
    seen = files.agg(
        F.count_distinct(batch_month("path")).alias("months"),
        F.count("*").alias("n"),
        F.sum(F.octet_length("content")).alias("bytes"),
    )
    return landing_inventory(spark, folder).select(
        "status",
        seen.select("months").scalar().alias("months"),
        ((F.col("file_count") == seen.select("n").scalar()) & (F.size("file_names") == F.col("file_count"))).alias("names_complete"),
        (F.col("total_bytes") == seen.select("bytes").scalar()).alias("bytes_complete"),
    )


@query("monthly_batches", OPENING_MONTHS)
def monthly_batches(spark, sf_dir):
    schema = StructType([*RAW_SCHEMA.fields, StructField("batch_month", StringType())])
    stored = spark.read.options(**READ_OPTIONS).schema(schema).csv(landing(spark, sf_dir))
    return stored.groupBy("batch_month").agg(F.count("*").alias("rows"))


# ---------------------------------------------------------------------------------- sinks
@query("write_table_count", "SELECT count(*) AS written, count(*) AS stored FROM v_team")
def write_table_count(spark, sf_dir):
    folder = new_run_dir(spark, "table")
    written = tables.write_counted(aggregates.team_summary(valid(spark, sf_dir)), folder)["rows"]
    return spark.read.parquet(folder).agg(F.lit(written).cast("bigint").alias("written"), F.count("*").alias("stored"))


@query("write_partitioned", "SELECT opened_year, opened_month, count(*) AS rows FROM v_latest GROUP BY ALL")
def write_partitioned(spark, sf_dir):
    folder = new_run_dir(spark, "months")
    tables.write_by_month(current(spark, sf_dir), folder)
    return spark.read.parquet(folder).groupBy("opened_year", "opened_month").agg(F.count("*").alias("rows"))


@query("verified_write", f"SELECT {KEYS_SQL}, dq_issues FROM v_silver")
def verified_write(spark, sf_dir):
    folder = new_run_dir(spark, "verified")
    tables.verified_write(spark, silver(spark, sf_dir), folder, allow_empty=False)
    return with_keys(spark.read.parquet(folder), "dq_issues")


@query("split_valid_invalid", f"SELECT {KEYS_SQL}, dq_status, dq_issues FROM v_latest")
def split_valid_invalid(spark, sf_dir):
    folder = new_run_dir(spark, "split")
    tables.write_split(spark, current(spark, sf_dir), folder)
    return with_keys(spark.read.parquet(folder), "dq_status", "dq_issues")


TREND_FILE_SCHEMA = ", ".join(
    f"{name} {kind}"
    for name, kind in {
        "date": "date", "priority_code": "int", "priority_name": "string", "product": "string", "category": "string",
        "assigned_group": "string", "total_incidents": "bigint", "kpi_incidents": "bigint",
        "evaluated_kpi_incidents": "bigint", "kpi_violations": "bigint", "kpi_compliant": "bigint",
        "avg_duration_seconds": "double", "p95_duration_seconds": "bigint", "kpi_compliance_pct": "double",
    }.items()
)
STORED_TRENDS = TREND_FILE_SCHEMA + ", year int, month int"
TRENDS_SQL = "SELECT *, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month FROM v_trends"


def stored_trends(spark, sf_dir) -> str:
    folder = new_run_dir(spark, "daily_trends")
    payloads.write_trend_partitions(trends(spark, sf_dir), folder)
    return folder


@query("trend_partitions", TRENDS_SQL)
def trend_partitions(spark, sf_dir):
    return payloads.read_trend_partitions(spark, stored_trends(spark, sf_dir), STORED_TRENDS)


@query("trends_month_scan", f"SELECT * FROM ({TRENDS_SQL}) WHERE year = 1999 AND month = 5")
def trends_month_scan(spark, sf_dir):
    stored = payloads.read_trend_partitions(spark, stored_trends(spark, sf_dir), STORED_TRENDS)
    return stored.filter("year = 1999 AND month = 5")


@query("migrate_trends", TRENDS_SQL)
def migrate_trends(spark, sf_dir):
    """Documents of one day and product each, as one writer left them, split into monthly folders."""
    legacy, folder = new_run_dir(spark, "legacy"), new_run_dir(spark, "daily_trends")
    rows = trends(spark, sf_dir)
    # Bounded by the other dimensions of a day and product, not by tickets.
    documents = rows.groupBy("date", "product").agg(F.collect_list(F.struct(*rows.columns)).alias("records"))
    stamped = documents.select(F.date_format("date", "yyyy-MM-dd").alias("generated_at"), "records")
    stamped.write.option("ignoreNullFields", "false").json(legacy)
    payloads.migrate_trends(spark, legacy, TREND_FILE_SCHEMA, folder, multiline=False)
    return payloads.read_trend_partitions(spark, folder, STORED_TRENDS)


# ------------------------------------------------------------------------ index, manifest
@query(
    "stored_index_totals",
    """SELECT count(*) AS total_records, count(DISTINCT (year(date), month(date))) AS partition_count,
              CAST(year(max(date)) AS INTEGER) AS default_year, CAST(month(max(date)) AS INTEGER) AS default_month
       FROM v_trends""",
)
def stored_index_totals(spark, sf_dir):
    index = publish.partition_index(spark, stored_trends(spark, sf_dir), STORED_TRENDS)
    return publish.index_summary(index).drop("total_size_bytes")


TRENDS_BY_MONTH = """
    SELECT CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, count(*) AS n FROM v_trends GROUP BY ALL
"""


@query(
    "validate_partitions",
    f"""SELECT * FROM (WITH m AS ({TRENDS_BY_MONTH}), newest AS (SELECT max(year * 100 + month) AS p FROM m),
        t AS (SELECT strftime(max(date), '%Y-%m-%d') AS g FROM v_trends), n AS (SELECT NULL::INTEGER AS year, NULL::INTEGER AS month)
        SELECT year, month, 'record_count' AS field, CAST(n + 1 AS VARCHAR) AS expected, CAST(n AS VARCHAR) AS actual
          FROM m WHERE month = 4
        UNION ALL SELECT year, month, 'header.record_count', CAST(n + 1 AS VARCHAR), CAST(n AS VARCHAR) FROM m WHERE month = 4
        UNION ALL SELECT year, month, 'header.generated_at', g, '1900-01-01' FROM m, t WHERE month = 3
        UNION ALL SELECT year, month, 'header.mock', 'false', 'true' FROM m WHERE month = 5
        UNION ALL SELECT n.*, 'total_records', CAST((SELECT sum(n) FROM m) AS VARCHAR),
          CAST((SELECT sum(n) + count(*) FILTER (month = 4) FROM m) AS VARCHAR) FROM n
        UNION ALL SELECT n.*, 'default_year', CAST(p // 100 + 1 AS VARCHAR), CAST(p // 100 AS VARCHAR) FROM n, newest
        UNION ALL SELECT n.*, 'default_partition', printf('%d-%02d', p // 100 + 1, p % 100), NULL FROM n, newest
        UNION ALL SELECT n.*, 'generated_at', g || 'T', g FROM n, t)""",
)
def validate_partitions(spark, sf_dir):
    """A stored index with one fault of every kind: counts of April, header times of March, headers
    of May, a total, the default month and the time of the whole index."""
    folder, saved = stored_trends(spark, sf_dir), new_run_dir(spark, "index")
    rows = payloads.read_trend_partitions(spark, folder, STORED_TRENDS)
    newest = rows.agg(F.date_format(F.max("date"), "yyyy-MM-dd")).first()[0]
    publish.partition_index(spark, folder, STORED_TRENDS, newest).write.parquet(saved)
    payloads.write_json(publish.partition_headers(rows, newest), f"{saved}-headers")
    index = spark.read.parquet(saved)
    headers = spark.read.schema(publish.HEADER_SCHEMA).json(f"{saved}-headers")
    summary = publish.index_summary(index, newest).withColumns(
        {"default_year": F.col("default_year") + 1, "generated_at": F.concat("generated_at", F.lit("T"))}
    )
    recorded = index.withColumn("record_count", F.col("record_count") + (F.col("month") == 4).cast("int"))
    wrong = headers.withColumns(
        {
            "generated_at": F.when(F.col("month") == 3, "1900-01-01").otherwise(F.col("generated_at")),
            "mock": F.col("mock") | (F.col("month") == 5),
        }
    )
    return publish.validate_partitions(recorded, summary, index, wrong)


@query("misplaced_records", "SELECT 0 AS misplaced, count(*) AS records FROM v_trends")
def misplaced_records(spark, sf_dir):
    stored = payloads.read_trend_partitions(spark, stored_trends(spark, sf_dir), STORED_TRENDS)
    wrong = publish.misplaced_records(stored).agg(F.count("*")).scalar()
    return stored.agg(wrong.cast("int").alias("misplaced"), F.count("*").alias("records"))


@query(
    "manifest",
    "SELECT name, 'VALID' AS contract_status, false AS mock, item_count, true AS hash_holds,"
    " (SELECT strftime(max(date), '%Y-%m-%d') FROM v_trends) AS data_generated_at FROM v_items",
)
def manifest(spark, sf_dir):
    """Stored payloads; physical sizes and hashes differ by run, so they are taken again and compared."""
    from faultline.queries.publish_queries import payload_tables

    root, entries, payload = new_run_dir(spark, "publication"), None, payload_tables(spark, sf_dir)
    # From the stored cells, as the payloads: the incidents are not read again.
    newest = payload["daily_trends"].agg(F.max("date")).scalar()
    for name, df in payload.items():
        path = f"{root}/{name}"
        payloads.write_json(df.orderBy(*publish.payload_order(name)), path)
        stored = spark.read.schema(df.schema).json(path)
        broken = contracts.contract_outcomes(stored, name)
        entry = publish.manifest_entry(spark, name, path, stored, broken, newest)
        # The hash tree again, folded from lines numbered by a window instead of by blocks.
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.json").load(path)
        lines = files.select("path", F.posexplode(F.split(F.decode("content", "UTF-8"), "\n")).alias("number", "value"))
        lines = lines.filter("value <> ''").select(
            "path", "number", F.sha2("value", 256).alias("hash"), F.octet_length("value").cast("bigint").alias("size_bytes")
        )
        for _ in range(3):
            lines = folded(lines, ["path"], CHUNK)
        again = lines.agg(publish.combined_hash("hash").alias("hash"))
        bytes_ = files.agg(F.sum("length")).scalar()
        holds = (F.col("sha256") == again.scalar()) & (F.col("size_bytes") == bytes_)
        entry = entry.select("name", "contract_status", "mock", "item_count", holds.alias("hash_holds"), "data_generated_at")
        entries = entry if entries is None else entries.unionByName(entry)
    return entries


VIEWS["v_publication"] = """
    SELECT 'filter_options' AS name, 0 AS position, 'year+month+priority+product+category+team' AS item_count_source,
           count(*) AS item_count FROM v_options
    UNION ALL SELECT 'daily_trends', 1, 'total_records', count(*) FROM v_trends
    UNION ALL SELECT 'risk_summary', 2, 'items', count(*) FROM v_risk
    UNION ALL SELECT 'forecast_history', 3, 'history', count(*) FROM v_history
    UNION ALL SELECT 'forecast', 4, 'forecast', count(*) FROM v_forecast
    UNION ALL SELECT 'recommendations', 5, 'items', count(*) FROM v_recommendations
"""


@query(
    "publish_store",
    """SELECT name, position, 'contracts/' || name AS schema_path, item_count_source, item_count, 'VALID' AS contract_status,
              (SELECT strftime(max(date), '%Y-%m-%d') FROM v_trends) AS data_generated_at,
              (SELECT sum(total_incidents)::BIGINT FROM v_trends) AS incidents, 1::BIGINT AS publications, 1 AS refused
       FROM v_publication""",
)
def publish_store(spark, sf_dir):
    """A publication, then one whose trends count some incidents below zero, which is refused: the
    first stays visible, with its manifest and its trends."""
    store = store_for(spark, "store")
    write_gold(spark, stored_valid(spark, sf_dir), store.path("gold", "run=one"))
    store.append("gold_runs", spark.createDataFrame([("one", 1)], store.control_tables()["gold_runs"]))
    newest = store.gold("daily_trends").agg(F.date_format(F.max("date"), "yyyy-MM-dd")).first()[0]
    publication.publish_gold(store, newest)
    flawed = publication.payload_tables(publication.gold_of(store))
    below = F.when(F.dayofmonth("date") == 13, -F.col("total_incidents")).otherwise(F.col("total_incidents"))
    flawed["daily_trends"] = flawed["daily_trends"].withColumn("total_incidents", below)
    refused = 0
    try:
        publication.publish_gold(store, newest, tables=flawed)
    except publication.PublicationRefused:
        refused = 1
    rows = publication.published(store, "daily_trends", STORED_TRENDS)
    shown = publication.published(store, "manifest", publish.MANIFEST_SCHEMA).select(
        "name", "position", "schema_path", "item_count_source", "item_count", "contract_status", "data_generated_at"
    )
    return shown.withColumns(
        {
            "incidents": rows.agg(F.sum("total_incidents")).scalar(),
            "publications": store.control("publications").agg(F.count("*")).scalar(),
            "refused": F.lit(refused),
        }
    )


@query(
    "json_safe_values",
    """SELECT assigned_group, CASE WHEN total_incidents % 3 = 2 THEN avg_duration_seconds END AS avg_duration_seconds,
              CASE WHEN total_incidents % 3 = 2 THEN kpi_compliance_pct END AS compliance FROM v_team""",
)
def json_safe_values(spark, sf_dir):
    """Team figures with NaN and infinities planted, as they come back from a JSON payload."""
    folder, kind = new_run_dir(spark, "safe"), F.col("total_incidents") % 3
    team = aggregates.team_summary(valid(spark, sf_dir))
    bad = F.when(kind == 0, F.lit(float("nan"))).when(kind == 1, F.lit(float("-inf")))
    planted = team.select(
        "assigned_group",
        F.coalesce(bad, F.col("avg_duration_seconds")).alias("avg_duration_seconds"),
        F.array(F.struct(F.coalesce(bad, F.col("kpi_compliance_pct")).alias("compliance"))).alias("rates"),
    )
    payloads.write_json(planted, folder)
    stored = spark.read.schema(planted.schema).option("mode", "FAILFAST").json(folder)
    return stored.select("assigned_group", "avg_duration_seconds", F.col("rates")[0]["compliance"].alias("compliance"))


@query("export_tables", "SELECT * FROM v_dashboard")
def export_tables(spark, sf_dir):
    source, target = new_run_dir(spark, "gold"), new_run_dir(spark, "export")
    table = aggregates.dashboard_summary(valid(spark, sf_dir))
    tables.write_counted(table, source)
    payloads.export_table(spark, "dashboard_summary", source, target)
    return spark.read.schema(table.schema).json(target)


# ----------------------------------------------------------------------------- incremental
@query(
    "ingest_batch",
    f"SELECT 'bronze' AS layer, 'SUCCESS' AS status, batch_month, rows AS records, true AS as_ledger FROM ({OPENING_MONTHS})",
)
def ingest_batch(spark, sf_dir):
    """Ledger of one load by opening month of the batches, against what Bronze holds."""
    store = store_for(spark, "store")
    incremental.ingest_landing(store, landing(spark, sf_dir))
    held = store.bronze().groupBy(F.col("_batch_id").alias("batch_id")).agg(
        F.replace(F.substring(F.min("Aberto"), 1, 7), F.lit("-"), F.lit("_")).alias("batch_month"), F.count("*").alias("held")
    )
    same = (F.col("records_written") == F.col("held")) & F.col("file_hash").startswith(F.col("batch_id"))
    return (
        store.control("ledger").join(held, "batch_id", "full_outer").groupBy("layer", "status", "batch_month")
        .agg(F.sum("records_written").alias("records"), F.bool_and(same).alias("as_ledger"))
    )


@query("ingest_totals", "SELECT 'bronze' AS layer, 'SUCCESS' AS status, count(*) AS records FROM v_raw")
def ingest_totals(spark, sf_dir):
    store = store_for(spark, "store")
    incremental.ingest_landing(store, landing(spark, sf_dir))
    return store.control("ledger").groupBy("layer", "status").agg(F.sum("records_written").alias("records"))


def upserted(spark, sf_dir) -> tuple[Store, list[dict]]:
    """Versions shipped before 1998 first, the others as a second load; both are staged by one write."""
    store = store_for(spark, "store", TIEBREAK_DDL)
    versions, staging = silver(spark, sf_dir), store.path("staging", store.new_run())
    with compact_profile(spark):
        versions.withColumn("load", (F.col("_batch_id") >= "1998_01").cast("int")).write.partitionBy("load").parquet(staging)
    metrics = []
    for load in range(2):
        staged = spark.read.schema(versions.schema).parquet(f"{staging}/load={load}")
        metrics.append(incremental.upsert(store, staged, tiebreak=VERSION_TIEBREAK, filed=True))
    return store, metrics


@query("upsert_state", f"SELECT {KEYS_SQL}, closed_at, kpi_violated_by_rule, dq_status, dq_issues FROM v_latest")
def upsert_state(spark, sf_dir):
    store, _ = upserted(spark, sf_dir)
    return with_keys(store.records(), plain_time("closed_at"), "kpi_violated_by_rule", "dq_status", "dq_issues")


VIEWS["v_first_load"] = """
    SELECT * FROM v_silver WHERE batch_id < '1998_01'
    QUALIFY row_number() OVER (PARTITION BY incident_id
        ORDER BY closed_at DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1
"""


@query(
    "upsert_metrics",
    """SELECT CAST(1 AS INTEGER) AS load, (SELECT count(*) FROM v_silver WHERE batch_id < '1998_01') AS received,
              (SELECT count(*) FROM v_silver WHERE batch_id < '1998_01') - count(*) AS duplicates,
              count(*) FILTER (WHERE dq_status = 'VALID') AS silver_total,
              count(*) FILTER (WHERE dq_status = 'INVALID') AS quarantine_total FROM v_first_load
       UNION ALL
       SELECT 2, (SELECT count(*) FROM v_silver WHERE batch_id >= '1998_01'),
              (SELECT count(*) FROM v_silver WHERE batch_id >= '1998_01') + (SELECT count(*) FROM v_first_load) - count(*),
              count(*) FILTER (WHERE dq_status = 'VALID'), count(*) FILTER (WHERE dq_status = 'INVALID') FROM v_latest""",
)
def upsert_metrics(spark, sf_dir):
    _, metrics = upserted(spark, sf_dir)
    names = ("received", "duplicates", "silver_total", "quarantine_total")
    rows = [(i + 1, *(m[n] for n in names)) for i, m in enumerate(metrics)]
    return spark.createDataFrame(rows, "load int, " + ", ".join(f"{n} bigint" for n in names))


@query(
    "merge_inputs",
    f"""SELECT {KEYS_SQL}, CAST(NULL AS VARCHAR) AS kpi_rule_version, dq_status FROM v_first_load
        UNION ALL SELECT {KEYS_SQL}, kpi_rule_version, dq_status FROM v_silver WHERE batch_id >= '1998_01'""",
)
def merge_inputs(spark, sf_dir):
    """Older state without the rule column, united with new rows that have it."""
    versions = silver(spark, sf_dir)
    older = latest_versions(versions.filter("_batch_id < '1998_01'"), VERSION_TIEBREAK).drop("kpi_rule_version")
    newer = versions.filter("_batch_id >= '1998_01'")
    return with_keys(older.unionByName(newer, allowMissingColumns=True), "kpi_rule_version", "dq_status")


@query(
    "rerun_noop",
    """SELECT 'first' AS run, count(*) AS bronze_records, 1 AS silver_runs, 1 AS gold_runs FROM v_raw
       UNION ALL SELECT 'second', count(*), 1, 1 FROM v_raw""",
)
def rerun_noop(spark, sf_dir):
    store, files = store_for(spark, "store"), landing(spark, sf_dir)
    rows = []
    for run in ("first", "second"):
        incremental.ingest_landing(store, files)
        incremental.refresh_silver(store)
        incremental.refresh_gold(store)
        runs = [store.control(t).select("sequence").distinct().count() for t in ("slices", "gold_runs")]
        rows.append((run, store.bronze().count(), *runs))
    return spark.createDataFrame(rows, "run string, bronze_records bigint, silver_runs int, gold_runs int")


@query(
    "gold_refresh",
    " UNION ALL ".join(f"SELECT '{name}' AS table_name, count(*) AS rows FROM {view}" for name, view in GOLD_VIEWS.items()),
)
def gold_refresh(spark, sf_dir):
    """Gold written from stored incidents; counts of the stored tables."""
    folder = new_run_dir(spark, "gold")
    source = new_run_dir(spark, "silver")
    tables.write_by_month(current(spark, sf_dir), source)
    counts = write_gold(spark, spark.read.parquet(source).filter("dq_status = 'VALID'"), folder)
    return spark.createDataFrame(list(counts.items()), "table_name string, rows bigint")


@query("gold_refresh_trends", "SELECT * FROM v_trends")
def gold_refresh_trends(spark, sf_dir):
    folder = new_run_dir(spark, "gold")
    write_gold(spark, stored_valid(spark, sf_dir), folder)
    return spark.read.parquet(f"{folder}/daily_trends")




# Every Silver column; the times are compared without a zone.
SILVER_TIMES = ("opened_at", "resolved_at", "closed_at")
SILVER_COLUMNS = (
    "priority", "product", "category", "subcategory", "assigned_group", "configuration_item", "duration_seconds", "close_code",
    "short_description", "opened_by", "parent_incident_id", "status", "entered_kpi", "kpi_violated", "priority_code",
    "priority_name", "opened_year", "opened_month", "kpi_rule_version", "kpi_limit_seconds", "kpi_eligible_by_rule",
    "kpi_violated_by_rule", "entered_kpi_rule_matches_source", "kpi_violated_rule_matches_source", "dq_status", "dq_issues",
    "opened_at", "resolved_at",
)
VIEWS["v_newest"] = """
    SELECT *, count(*) OVER (PARTITION BY incident_id) AS newest_versions
    FROM (SELECT * FROM v_silver QUALIFY rank() OVER (PARTITION BY incident_id ORDER BY closed_at DESC NULLS LAST) = 1)
"""


@query(
    "stream_upsert",
    "SELECT incident_id, closed_at, newest_versions, "
    + ", ".join(f"any_value(CASE WHEN newest_versions = 1 THEN {c} END) AS {c}" for c in SILVER_COLUMNS)
    + " FROM v_newest GROUP BY ALL",
)
def stream_upsert(spark, sf_dir):
    """The landing files as a stream in several micro-batches, with every Silver column.

    Where versions closed at one moment, the store takes the one with the largest row digest, which
    SQL does not know: such incidents are compared by their time and their number of versions.
    """
    store, files = store_for(spark, "stream"), landing(spark, sf_dir)
    start_landing_stream(store, files, POLICY, gold=False, files_per_batch=48).awaitTermination()
    versions = silver(spark, sf_dir).groupBy("incident_id", "closed_at").agg(F.count("*").alias("newest_versions"))
    state = store.records().withColumnsRenamed({"incident_id": "_id", "closed_at": "_closed"})
    same = (F.col("_id") == F.col("incident_id")) & F.col("_closed").eqNullSafe(F.col("closed_at"))
    columns = [plain_time(c) if c in SILVER_TIMES else F.col(c) for c in SILVER_COLUMNS]
    shown = [F.when(F.col("newest_versions") == 1, c).alias(name) for c, name in zip(columns, SILVER_COLUMNS)]
    return state.join(versions, same).select("incident_id", plain_time("closed_at"), "newest_versions", *shown)


@query(
    "physical_state",
    """SELECT (SELECT count(*) FROM v_raw) AS bronze_records,
              (SELECT count(DISTINCT incident_id) FROM v_raw) AS incident_records,
              CAST(0 AS BIGINT) AS missing_bronze_paths, CAST(0 AS BIGINT) AS missing_gold_outputs""",
)
def physical_state(spark, sf_dir):
    store = store_for(spark, "store")
    incremental.run_incremental(store, landing(spark, sf_dir))
    state = incremental.physical_state(store)
    return state.select(
        "bronze_records",
        F.expr("silver_records + quarantine_records").alias("incident_records"),
        "missing_bronze_paths",
        "missing_gold_outputs",
    )


@query("run_history", "SELECT 'SUCCESS' AS status, 4 AS stages, count(*) AS bronze_records FROM v_raw")
def run_history(spark, sf_dir):
    store = store_for(spark, "store")
    incremental.run_incremental(store, landing(spark, sf_dir))
    return store.control("runs").select("status", F.size("stages").alias("stages"), "bronze_records")
