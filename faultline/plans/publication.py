"""A whole publication from one Gold run: payloads, index, headers, manifest and gate.

Everything is written to a folder of its own and checked there as it was stored.  Only then one
row is appended that makes it the visible publication; a refused or broken one leaves the earlier
publication as it was.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.operators import contracts
from faultline.plans import publish
from faultline.plans.store import Store
from faultline.sinks import payloads
from faultline.sinks.tables import WriteMismatch

TRENDS = "daily_trends"


class PublicationRefused(RuntimeError):
    """The stored payloads break a contract or disagree with their index."""


def payload_tables(gold: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Published tables by name, in the manifest's order; trends keep their date for the folders."""
    return {
        "filter_options": publish.filter_options(gold["dashboard_summary"], gold["daily_trends"]),
        TRENDS: gold["daily_trends"],
        "risk_summary": publish.risk_payload(gold["risk_summary"]),
        "forecast_history": publish.history_payload(gold["forecast_history"]),
        "forecast": publish.forecast_rows_payload(gold["forecast_summary"]),
        "recommendations": publish.recommendations_payload(gold["recommendations"]),
    }


def gold_of(store: Store) -> dict[str, DataFrame]:
    names = ("dashboard_summary", "daily_trends", "risk_summary", "forecast_history", "forecast_summary", "recommendations")
    return {name: store.gold(name) for name in names}


def write_trends(store: Store, trends: DataFrame, folder: str, generated_at: str, mock: bool) -> DataFrame:
    """Month folders, their headers and their index; the index as stored."""
    spark = store.spark
    written = payloads.write_trend_partitions(trends, f"{folder}/{TRENDS}")
    headers = publish.partition_headers(trends, generated_at, mock)
    payloads.write_json(headers, f"{folder}/{TRENDS}_headers")
    schema = stored_trend_schema(trends)
    index = publish.partition_index(spark, f"{folder}/{TRENDS}", schema, generated_at, mock)
    payloads.write_json(index, f"{folder}/{TRENDS}_index")
    stored = spark.read.schema(index.schema).json(f"{folder}/{TRENDS}_index")
    summary = publish.index_summary(stored, generated_at, mock)
    payloads.write_json(summary, f"{folder}/{TRENDS}_index_summary")
    total = stored.agg(F.coalesce(F.sum("record_count"), F.lit(0))).first()[0]
    if total != written:
        raise WriteMismatch(f"{written} trend records written, {total} in the index")
    return stored


def stored_trend_schema(trends: DataFrame) -> str:
    columns = [f"{field.name} {field.dataType.simpleString()}" for field in trends.schema.fields if field.name not in ("year", "month")]
    return ", ".join([*columns, "year int", "month int"])


def partition_problems(store: Store, folder: str, schema: str) -> DataFrame:
    """The stored index against what is stored beside it."""
    spark = store.spark
    read = lambda name, kind: spark.read.schema(kind).json(f"{folder}/{TRENDS}{name}")
    recorded = read("_index", publish.INDEX_SCHEMA)
    return publish.validate_partitions(
        recorded,
        read("_index_summary", publish.SUMMARY_SCHEMA),
        publish.partition_index(spark, f"{folder}/{TRENDS}", schema),
        read("_headers", publish.HEADER_SCHEMA),
    )


def publish_gold(
    store: Store, generated_at: str | None = None, mock: bool = False, tables: dict[str, DataFrame] | None = None
) -> str:
    """Publish the current Gold run (or the given tables) and return the publication's name."""
    spark, run = store.spark, store.new_run()
    folder = store.path("published", f"run={run}")
    moment = generated_at or spark.sql("SELECT date_format(current_timestamp(), \"yyyy-MM-dd'T'HH:mm:ss'Z'\")").first()[0]
    named = payload_tables(gold_of(store)) if tables is None else tables
    entries = []
    schema = stored_trend_schema(named[TRENDS])
    for position, (name, table) in enumerate(named.items()):
        path = f"{folder}/{name}"
        if name == TRENDS:
            write_trends(store, table, folder, moment, mock)
            stored = publish.trends_payload(payloads.read_trend_partitions(spark, path, schema))
        else:
            payloads.write_json(table.orderBy(*publish.payload_order(name)), path)
            stored = spark.read.schema(table.schema).json(path)
        broken = contracts.contract_outcomes(stored, name)
        entries.append(publish.manifest_entry(spark, name, path, stored, broken, F.lit(moment), position, mock))
    payloads.write_json(reduce(DataFrame.unionByName, entries), f"{folder}/manifest")
    manifest = spark.read.schema(publish.MANIFEST_SCHEMA).json(f"{folder}/manifest")
    payloads.write_json(publish.manifest_head(manifest, moment), f"{folder}/manifest_head")
    problems = partition_problems(store, folder, schema).count()
    if problems or not publish.publication_gate(manifest).first().publishable:
        invalid = [row.name for row in manifest.filter("contract_status <> 'VALID'").select("name").collect()]
        raise PublicationRefused(f"{problems} differences from the index, broken contracts: {', '.join(invalid) or 'none'}")
    row = [(run, store.next_sequence("publications"), moment)]
    store.append("publications", spark.createDataFrame(row, store.control_tables()["publications"]))
    return run


def published(store: Store, name: str, schema: str) -> DataFrame:
    """A part of the visible publication."""
    return store.spark.read.schema(schema).json(f"{published_folder(store)}/{name}")


def published_folder(store: Store) -> str:
    last = store.control("publications").orderBy(F.desc("sequence")).first()
    if last is None:
        raise FileNotFoundError("nothing is published yet")
    return store.path("published", f"run={last.run}")
