"""Frames the registered queries start from, all derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.operators import aggregates, forecast, recommend, risk
from faultline.operators.clean import rename_source, strip_blanks, type_columns
from faultline.operators.quality import only_valid
from faultline.plans.silver import current_records, silver_records
from faultline.session import compact_profile, new_run_dir
from faultline.sinks.tables import write_counted
from faultline.sources.testbed import POLICY, VERSION_TIEBREAK, described, incident_versions, joined_orders, rendered, with_ages

LINE_KEYS = {
    "_batch_id": "batch_id",
    "_line_number": "l_linenumber",
    "_part_key": "l_partkey",
    "_supplier_key": "l_suppkey",
    "_extended_price": "l_extendedprice",
}


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return incident_versions(spark, sf_dir)


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir).transform(rename_source).transform(strip_blanks)


def typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleaned(spark, sf_dir).transform(type_columns)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_records(raw(spark, sf_dir), POLICY)


def current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the newest versions meet parts, suppliers and nations: that join scatters the versions of an incident."""
    versions = with_ages(joined_orders(spark, sf_dir))
    return current_records(versions, VERSION_TIEBREAK, POLICY, lambda chosen: rendered(described(chosen, sf_dir, once=True)))


def valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return only_valid(current(spark, sf_dir))


def stored_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The valid incidents written to the shared folder, for queries that build several tables."""
    folder = new_run_dir(spark, "valid")
    with compact_profile(spark):
        write_counted(valid(spark, sf_dir), folder)
    return spark.read.parquet(folder)


def plain_time(name: str) -> Column:
    return F.col(name).cast("timestamp_ntz").alias(name)


def trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.daily_trends(valid(spark, sf_dir))


def dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.dashboard_summary(valid(spark, sf_dir))


def risk_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return risk.risk_summary(valid(spark, sf_dir))


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.forecast_history(valid(spark, sf_dir))


def stored_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The history written to the shared folder, for queries that need it and the forecast from it."""
    folder = new_run_dir(spark, "history")
    write_counted(history(spark, sf_dir), folder)
    return spark.read.parquet(folder)


def outlook(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forecast.forecast_summary(history(spark, sf_dir))


def annual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.annual_ola_summary(valid(spark, sf_dir))


def stored_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily cells written to the shared folder, for queries that need several tables from them."""
    folder = new_run_dir(spark, "cells")
    write_counted(aggregates.daily_cells_with_p95(valid(spark, sf_dir)), folder)
    return spark.read.parquet(folder)


def advice_from(cells: DataFrame) -> DataFrame:
    past = forecast.forecast_history(cells)
    return recommend.recommendations(
        risk.risk_summary(cells), aggregates.annual_ola_summary(cells), forecast.forecast_summary(past), past
    )


def advice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return advice_from(stored_cells(spark, sf_dir))
