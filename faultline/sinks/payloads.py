"""JSON sinks for publication and the monthly CSV splitter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.functions.measures import finite_or_null
from faultline.operators.aggregates import TREND_KEYS
from faultline.operators.contracts import TREND_DOCUMENT, enforced
from faultline.sinks.tables import WriteMismatch, balanced_by
from faultline.sources.incident_csv import WRITE_OPTIONS

EXPORT_ORDER = {
    "monthly_kpis": ["opened_year", "opened_month"],
    "priority_summary": ["priority_code"],
    "team_summary": ["-total_incidents"],
    "dashboard_summary": ["opened_year", "opened_month", "priority_code", "assigned_group"],
}


def export_order(name: str) -> list[Column]:
    return [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in EXPORT_ORDER.get(name, [])]


def in_export_order(df: DataFrame, name: str) -> DataFrame:
    order = export_order(name)
    return df.orderBy(*order) if order else df


def json_safe(value: Column, kind: T.DataType) -> Column:
    """The value with NaN and infinities, which JSON does not know, as null, at any depth."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return finite_or_null(value)
    if isinstance(kind, T.ArrayType) and holds_numbers(kind.elementType):
        return F.transform(value, lambda item: json_safe(item, kind.elementType))
    if isinstance(kind, T.StructType) and holds_numbers(kind):
        parts = [json_safe(value[field.name], field.dataType).alias(field.name) for field in kind.fields]
        return F.when(value.isNotNull(), F.struct(*parts))
    return value


def holds_numbers(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(holds_numbers(field.dataType) for field in kind.fields)
    if isinstance(kind, T.ArrayType):
        return holds_numbers(kind.elementType)
    return isinstance(kind, (T.DoubleType, T.FloatType))


def json_safe_rows(df: DataFrame) -> DataFrame:
    return df.select(*(json_safe(F.col(f"`{field.name}`"), field.dataType).alias(field.name) for field in df.schema.fields))


# No published file holds more lines.
LINES_PER_FILE = 1_000_000


def write_json(df: DataFrame, path: str, lines_per_file: int = LINES_PER_FILE) -> None:
    """JSON lines keeping null fields; a sorted frame gives files sorted by name and content."""
    writer = json_safe_rows(df).write.mode("overwrite").option("ignoreNullFields", "false")
    writer.option("maxRecordsPerFile", lines_per_file).json(path)


def export_table(spark: SparkSession, name: str, source: str, target: str) -> None:
    write_json(in_export_order(spark.read.parquet(source), name), target)


def write_trend_partitions(trends: DataFrame, path: str) -> int:
    """Year/month folders of sorted JSON records, replacing every earlier folder; the rows written.

    Range partitioning on month and day keeps the order across files and cuts a month with a
    large share of the records into several files.
    """
    undated = F.raise_error(F.lit("trend record without a date"))
    trends = json_safe_rows(trends).withColumn("date", F.coalesce("date", undated.cast("date")))
    dated = trends.withColumns({"year": F.year("date"), "month": F.month("date")})
    order = ["year", "month", "date", *(key for key in TREND_KEYS if key != "date")]
    seen = Observation()
    ranged = dated.repartitionByRange(*order).sortWithinPartitions(*order).observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = ranged.write.mode("overwrite").option("ignoreNullFields", "false").option("maxRecordsPerFile", LINES_PER_FILE)
    writer.partitionBy("year", "month").json(path)
    return seen.get["rows"]


def read_trend_partitions(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def migrate_trends(spark: SparkSession, legacy: str, schema: str, path: str, multiline: bool = True) -> int:
    """Split documents with a ``records`` list into the monthly folders; the number of records.

    A malformed document, one without a list of records or without ``generated_at``, and a record
    with an unreadable or missing date stop the migration, as does any record that gets lost.
    ``multiline`` reads one pretty-printed document per file; otherwise one per line.
    """
    shape = f"generated_at string, records array<struct<{schema}>>"
    reader = spark.read.schema(shape).option("multiLine", str(multiline).lower()).option("mode", "FAILFAST")
    documents = enforced(reader.json(legacy), TREND_DOCUMENT)
    listed = documents.select(F.when(F.col("generated_at").isNotNull(), F.size("records")).alias("n"))
    expected = listed.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    records = documents.filter("generated_at IS NOT NULL").select(F.inline("records"))
    written = write_trend_partitions(records, path)
    if written != expected:
        raise WriteMismatch(f"{expected} records in the documents, {written} written")
    return written


MONTH_PREFIX = r"^\d{4}-\d{2}"


def with_batch_month(raw: DataFrame) -> DataFrame:
    """Month of the opening text; a text that is not ``YYYY-MM...`` aborts the job."""
    opened = F.col("Aberto")
    month = F.replace(F.regexp_extract(opened, MONTH_PREFIX, 0), F.lit("-"), F.lit("_"))
    bad = F.raise_error(F.concat(F.lit("unreadable opening date: "), F.coalesce(opened, F.lit("null"))))
    return raw.withColumn("batch_month", F.when(opened.rlike(MONTH_PREFIX), month).otherwise(bad))


def write_monthly_batches(raw: DataFrame, path: str, dealt: bool = False) -> None:
    """Landing files per opening month, compressed: their texts repeat and take a multiple of the tables they come from.

    With ``dealt`` the rows of a month are together already.
    """
    by_month = with_batch_month(raw) if dealt else balanced_by(with_batch_month(raw), "batch_month")
    by_month.write.mode("overwrite").options(**WRITE_OPTIONS, compression="gzip").partitionBy("batch_month").csv(path)
