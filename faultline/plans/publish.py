"""Published payloads, their index, manifest and gates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.config import FORECAST, MONTH_NAMES, RISK, ForecastPolicy, RiskPolicy
from faultline.functions.text import blank_to_null
from faultline.operators.contracts import dated
from faultline.operators.recommend import severity_rank
from faultline.operators.risk import risk_order
from faultline.sources.lines import file_hashes

SCHEMA_VERSION = "1.0"
MANIFEST_VERSION = "1.0"


def iso_day(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


# ------------------------------------------------------------------------------- payloads
def filter_options(dashboard: DataFrame, trends: DataFrame) -> DataFrame:
    """Distinct slicer values as (kind, code, label).

    Each source is read once: its row is turned into one entry per kind before the distinct,
    which then combines in the map tasks.
    """

    def entries(df: DataFrame, *parts: tuple[str, Column, Column]) -> DataFrame:
        structs = [
            F.struct(F.lit(kind).alias("kind"), code.cast("int").alias("code"), label.alias("label"))
            for kind, code, label in parts
        ]
        return df.select(F.inline(F.array(*structs))).filter(F.col("label").isNotNull()).distinct()

    none = F.lit(None)
    month, year = F.col("opened_month"), F.col("opened_year")
    month_name = F.try_element_at(F.lit(list(MONTH_NAMES)), month)
    valid_month = F.when(month.between(1, 12), month)
    priority_label = F.when(F.col("priority_code").isNotNull(), F.col("priority_name"))
    calendar = entries(
        dashboard,
        ("year", year, year.cast("string")),
        ("month", valid_month, F.when(valid_month.isNotNull(), month_name)),
        ("priority", F.col("priority_code"), priority_label),
    )
    texts = entries(
        trends,
        ("product", none, blank_to_null(F.col("product"))),
        ("category", none, blank_to_null(F.col("category"))),
        ("team", none, blank_to_null(F.col("assigned_group"))),
    )
    return calendar.unionByName(texts)


def option_order() -> list[Column]:
    kinds = ["year", "month", "priority", "product", "category", "team"]
    return [F.array_position(F.lit(kinds), F.col("kind")), F.col("code"), F.col("label")]


TREND_PAYLOAD = (
    "priority_code", "priority_name", "product", "category", "assigned_group", "total_incidents", "kpi_incidents",
    "kpi_violations", "avg_duration_seconds", "p95_duration_seconds",
)


def trends_payload(trends: DataFrame) -> DataFrame:
    return trends.select(iso_day("date").alias("date"), *TREND_PAYLOAD)


def trends_order() -> list[str]:
    return ["date", "priority_code", "product", "category", "assigned_group"]


def risk_payload(risk: DataFrame) -> DataFrame:
    return risk.select(
        "dimension_type", "dimension_value", "is_unknown", "volume", "kpi_violation_rate_pct", "avg_duration_seconds",
        "risk_score", "rank",
    )


def risk_methodology(risk: DataFrame, policy: RiskPolicy = RISK) -> DataFrame:
    """How every dimension was scored and what came out: items, ranked items and the largest score."""
    constants = {
        "name": policy.name, "version": policy.version, "score_scale": "0-100", "volume": policy.volume_weight,
        "kpi_violation_rate": policy.rate_weight, "avg_duration": policy.duration_weight,
    }
    found = risk.groupBy("dimension_type").agg(
        F.count("*").alias("items"), F.count("rank").alias("ranked"), F.max("risk_score").alias("top_score")
    )
    return found.withColumns({name: F.lit(value) for name, value in constants.items()})


def history_payload(history: DataFrame) -> DataFrame:
    return history.select(iso_day("date").alias("date"), "actual_incidents")


def forecast_rows_payload(forecast: DataFrame) -> DataFrame:
    return forecast.select(
        iso_day("forecast_date").alias("date"), "predicted_incidents", "lower_bound", "upper_bound"
    )


def forecast_document(history: DataFrame, forecast: DataFrame, policy: ForecastPolicy = FORECAST) -> DataFrame:
    """One row with scope, totals and both series; nulls and empty lists without a forecast.

    The series hold at most the history and horizon lengths of the policy.
    """
    past = history_payload(history).agg(
        F.sort_array(F.collect_list(F.struct("date", "actual_incidents"))).alias("history")
    )
    rows = forecast.withColumn("date", iso_day("forecast_date"))
    ahead = rows.agg(
        F.max("scope_description").alias("scope_description"),
        F.max("scope_priority_codes").alias("codes"),
        F.max("forecast_d1").alias("forecast_d1"),
        F.max("forecast_d7").alias("forecast_d7"),
        F.max("risk_range").alias("risk_range"),
        F.sort_array(
            F.collect_list(F.struct("date", "predicted_incidents", "lower_bound", "upper_bound"))
        ).alias("forecast"),
    )
    codes = F.coalesce(F.split("codes", ",").cast("array<int>"), F.array().cast("array<int>"))
    return ahead.select(
        F.lit(policy.method).alias("method"),
        F.lit(policy.version).alias("method_version"),
        "scope_description",
        codes.alias("scope_priority_codes"),
        F.array().cast("array<string>").alias("filters_applied"),
        "forecast_d1",
        "forecast_d7",
        "risk_range",
        past.scalar().alias("history"),
        "forecast",
    )


def recommendations_payload(recommendations: DataFrame) -> DataFrame:
    return recommendations.select(
        "recommendation_id", "dimension_type", "target", "severity", "title", "recommendation", "evidence",
        "metric_name", "metric_value", "metric_unit",
    )


def payload_order(name: str) -> list:
    return {
        "daily_trends": trends_order(),
        "risk_summary": risk_order(),
        "forecast_history": ["date"],
        "forecast": ["date"],
        "recommendations": [severity_rank(), F.col("recommendation_id")],
        "filter_options": option_order(),
    }[name]


# ------------------------------------------------------------------- index and manifest
def item_counts(payloads: dict[str, DataFrame]) -> DataFrame:
    """Number of items per payload."""
    counted = [
        df.agg(F.count("*").alias("item_count")).select(F.lit(name).alias("name"), "item_count")
        for name, df in payloads.items()
    ]
    return reduce(DataFrame.unionByName, counted)


def partition_counts(trends: DataFrame) -> DataFrame:
    return trends.groupBy(F.year("date").alias("year"), F.month("date").alias("month")).agg(
        F.count("*").alias("record_count")
    )


def combined_hash(column: str = "sha256") -> Column:
    """Hash of a dataset of several files: the hash of its sorted file hashes, one per file of up to
    ``LINES_PER_FILE`` lines."""
    return F.sha2(F.array_join(F.sort_array(F.collect_list(column)), ""), 256)


INDEX_SCHEMA = (
    "year int, month int, path string, record_count bigint, size_bytes bigint, sha256 string, generated_at string, mock boolean"
)
HEADER_SCHEMA = "year int, month int, record_count bigint, generated_at string, mock boolean"
SUMMARY_SCHEMA = (
    "total_records bigint, total_size_bytes bigint, partition_count bigint, default_year int, default_month int, "
    "generated_at string, mock boolean"
)
INDEX_FIELDS = ["record_count", "size_bytes", "sha256"]
HEADER_FIELDS = ["record_count", "generated_at", "mock"]
TOTAL_FIELDS = ["total_records", "total_size_bytes", "partition_count", "default_year", "default_month"]


def partition_headers(trends: DataFrame, generated_at: str, mock: bool = False) -> DataFrame:
    """What every month says about itself, known without reading its records."""
    return partition_counts(trends).select(
        "year", "month", "record_count", F.lit(generated_at).alias("generated_at"), F.lit(mock).alias("mock")
    )


def partition_index(
    spark: SparkSession, trends_path: str, schema, generated_at: str | None = None, mock: bool = False
) -> DataFrame:
    """Count, size and hash of every stored month; with ``generated_at`` also its time and mock flag."""
    records = spark.read.schema(schema).json(trends_path)
    counts = records.groupBy("year", "month").agg(F.count("*").alias("record_count"))
    part = r"year=(\d+)/month=(\d+)"
    files = (
        file_hashes(spark, trends_path)
        .withColumns(
            {
                "year": F.regexp_extract("path", part, 1).try_cast("int"),
                "month": F.regexp_extract("path", part, 2).try_cast("int"),
            }
        )
        .groupBy("year", "month")
        .agg(F.sum("size_bytes").alias("size_bytes"), combined_hash().alias("sha256"))
    )
    index = counts.join(files, ["year", "month"], "left").select(
        "year",
        "month",
        F.format_string("daily_trends/year=%d/month=%d", "year", "month").alias("path"),
        "record_count",
        "size_bytes",
        "sha256",
    )
    if generated_at is None:
        return index
    return index.withColumns({"generated_at": F.lit(generated_at), "mock": F.lit(mock)})


def index_summary(index: DataFrame, generated_at: str | None = None, mock: bool = False) -> DataFrame:
    newest = F.max(F.struct("year", "month"))
    summary = index.agg(
        F.coalesce(F.sum("record_count"), F.lit(0)).alias("total_records"),
        F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("total_size_bytes"),
        F.count("*").alias("partition_count"),
        newest["year"].alias("default_year"),
        newest["month"].alias("default_month"),
    )
    if generated_at is None:
        return summary
    return summary.withColumns({"generated_at": F.lit(generated_at), "mock": F.lit(mock)})


def index_problems(recorded: DataFrame, stored: DataFrame) -> DataFrame:
    """Differences between a recorded index and what is stored now, one row per field."""
    return field_differences(recorded, stored, ["year", "month"], INDEX_FIELDS)


def validate_partitions(recorded: DataFrame, summary: DataFrame, stored: DataFrame, headers: DataFrame) -> DataFrame:
    """Every difference of a recorded index from the stored months, their headers and its own totals.

    Rows of totals have no year and month.  Headers are read without the records they describe.
    """
    keys = ["year", "month"]
    of_headers = field_differences(recorded, headers, keys, HEADER_FIELDS).withColumn(
        "field", F.concat(F.lit("header."), F.col("field"))
    )
    nowhere = {name: F.lit(None).cast("int") for name in keys}
    totals = field_differences(
        summary.withColumns(nowhere), index_summary(recorded).withColumns(nowhere), keys, TOTAL_FIELDS
    )
    default = summary.filter("default_year IS NOT NULL").select(
        F.col("default_year").alias("year"), F.col("default_month").alias("month")
    )
    missing = default.join(recorded.select(*keys), keys, "left_anti").select(
        *(column.alias(name) for name, column in nowhere.items()),
        F.lit("default_partition").alias("field"),
        F.format_string("%d-%02d", "year", "month").alias("expected"),
        F.lit(None).cast("string").alias("actual"),
    )
    times = recorded.select("generated_at", "mock").distinct().withColumns(nowhere)
    own = field_differences(summary.select("generated_at", "mock").withColumns(nowhere), times, keys, ["generated_at", "mock"])
    return index_problems(recorded, stored).unionByName(of_headers).unionByName(totals).unionByName(missing).unionByName(own)


def misplaced_records(records: DataFrame) -> DataFrame:
    """Records whose date does not belong to their month folder."""
    day = F.try_to_date(F.col("date").cast("string"))
    return records.filter((F.year(day) != F.col("year")) | (F.month(day) != F.col("month")) | day.isNull())


def field_differences(expected: DataFrame, actual: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """Field-by-field comparison of two keyed tables, with missing entries on either side."""

    def tagged(df: DataFrame, side: str) -> DataFrame:
        return df.select(*keys, F.struct(*(F.col(f).cast("string").alias(f) for f in fields)).alias("entry")).select(
            *keys, F.lit(side).alias("side"), "entry"
        )

    both = tagged(expected, "expected").unionByName(tagged(actual, "actual")).groupBy(*keys).agg(
        F.max(F.when(F.col("side") == "expected", F.col("entry"))).alias("e"),
        F.max(F.when(F.col("side") == "actual", F.col("entry"))).alias("a"),
    )
    compared = [
        F.struct(F.lit(f).alias("field"), F.col(f"e.{f}").alias("expected"), F.col(f"a.{f}").alias("actual"))
        for f in fields
    ]
    presence = F.struct(
        F.lit("entry").alias("field"),
        F.when(F.col("e").isNotNull(), "present").alias("expected"),
        F.when(F.col("a").isNotNull(), "present").alias("actual"),
    )
    one_sided = F.col("e").isNull() | F.col("a").isNull()
    rows = F.when(one_sided, F.array(presence)).otherwise(F.array(*compared))
    return both.select(*keys, F.inline(rows)).filter(~F.col("expected").eqNullSafe(F.col("actual")))


# What the items of a published table are.
ITEM_SOURCES = {
    "filter_options": "year+month+priority+product+category+team",
    "daily_trends": "total_records",
    "risk_summary": "items",
    "forecast_history": "history",
    "forecast": "forecast",
    "recommendations": "items",
}
MANIFEST_SCHEMA = (
    "name string, path string, schema_path string, contract_status string, schema_version string, data_generated_at string, "
    "mock boolean, item_count bigint, item_count_source string, size_bytes bigint, sha256 string, position int"
)


def manifest_entry(
    spark: SparkSession, name: str, path: str, items: DataFrame, violations: DataFrame, generated_at: Column,
    position: int | None = None, mock: bool = False,
) -> DataFrame:
    """Manifest row of one stored payload; with ``position`` also its place in the manifest."""
    files = file_hashes(spark, path).agg(
        F.coalesce(F.sum("size_bytes"), F.lit(0)).alias("size_bytes"), combined_hash().alias("sha256")
    )
    broken = violations.agg(F.coalesce(F.sum("violations"), F.lit(0)).alias("n")).scalar()
    entry = files.select(
        F.lit(name).alias("name"),
        F.lit(path.rsplit("/", 1)[-1]).alias("path"),
        F.lit(f"contracts/{name}").alias("schema_path"),
        F.when(broken == 0, "VALID").otherwise("INVALID").alias("contract_status"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        generated_at.alias("data_generated_at"),
        F.lit(mock).alias("mock"),
        items.agg(F.count("*").alias("n")).scalar().alias("item_count"),
        F.lit(ITEM_SOURCES.get(name, "items")).alias("item_count_source"),
        "size_bytes",
        "sha256",
    )
    return entry if position is None else entry.withColumn("position", F.lit(position))


def manifest_summary(entries: DataFrame) -> DataFrame:
    valid = F.count_if(F.col("contract_status") == "VALID")
    return entries.agg(
        F.when(valid == F.count("*"), "HEALTHY").otherwise("UNHEALTHY").alias("status"),
        F.count("*").alias("files_total"),
        valid.alias("files_valid"),
        F.coalesce(F.bool_or("mock"), F.lit(False)).alias("contains_mock_data"),
    )


def manifest_head(entries: DataFrame, generated_at: str) -> DataFrame:
    """The manifest's own row: version, time and summary."""
    return manifest_summary(entries).withColumns(
        {"schema_version": F.lit(MANIFEST_VERSION), "generated_at": F.lit(generated_at)}
    )


MANIFEST_FIELDS = [
    "path", "schema_path", "contract_status", "schema_version", "data_generated_at", "mock", "item_count", "item_count_source",
    "size_bytes", "sha256",
]


SUMMARY_FIELDS = ["status", "files_total", "files_valid", "contains_mock_data"]
HEAD_FIELDS = ["schema_version", "generated_at", *SUMMARY_FIELDS]


def manifest_drift(
    recorded: DataFrame, current: DataFrame, fields: list[str] | None = None,
    heads: tuple[DataFrame, DataFrame] | None = None,
) -> DataFrame:
    """Field differences, missing entries and changed positions between two manifests.

    Without ``fields`` the heads are compared too, under a null name (without ``heads`` only their
    summaries), and the positions where either manifest has the column ``position``.
    """
    if fields:
        return field_differences(recorded, current, ["name"], fields)
    # A field that an older manifest does not have is null there.
    compared = [name for name in (*MANIFEST_FIELDS, "position") if name in recorded.columns or name in current.columns]
    recorded, current = (
        df.withColumns({name: F.lit(None).cast("string") for name in compared if name not in df.columns}) for df in (recorded, current)
    )
    top = [manifest_summary(df) for df in (recorded, current)] if heads is None else heads
    top = [df.withColumn("name", F.lit(None).cast("string")) for df in top]
    return field_differences(recorded, current, ["name"], compared).unionByName(
        field_differences(*top, ["name"], SUMMARY_FIELDS if heads is None else HEAD_FIELDS)
    )


def publication_gate(entries: DataFrame) -> DataFrame:
    """May a consumer show this publication?"""
    summary = manifest_summary(entries)
    allowed = (F.col("status") == "HEALTHY") & ~F.col("contains_mock_data") & (F.col("files_valid") == F.col("files_total"))
    return summary.withColumn("publishable", allowed)


def freshness(entries: DataFrame) -> DataFrame:
    """Newest time of the entries; one that is not a time, as of a flawed payload, is no newer than any."""
    return entries.agg(F.max(dated(F.col("data_generated_at"))).alias("latest_data_at"))
