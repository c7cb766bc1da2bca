"""All Gold tables from the valid incidents.

Only the cells and the three other tables with a percentile read incidents; the additive ones roll
up from the daily cells, whose size is bounded by days x dimension combinations, not by tickets.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

from faultline.operators import aggregates, forecast, recommend, risk
from faultline.session import compact_profile, held
from faultline.sinks.tables import write_counted

CONCURRENT_WRITES = 6


def base_tables(valid: DataFrame, cells: DataFrame) -> dict[str, DataFrame]:
    """Tables read from incidents or cells; ``cells`` should be stored or persisted."""
    return {
        "monthly_kpis": aggregates.monthly_kpis(valid),
        "priority_summary": aggregates.priority_summary(valid),
        "team_summary": aggregates.team_summary(cells),
        "dashboard_summary": aggregates.dashboard_summary(cells),
        "daily_trends": aggregates.daily_trends_from_cells(cells),
        "operational_kpi_summary": aggregates.operational_kpi_summary(valid),
        "annual_ola_summary": aggregates.annual_ola_summary(cells),
        "risk_summary": risk.risk_summary(cells),
        "forecast_history": forecast.forecast_history(cells),
    }


def derived_tables(base: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Tables read from other Gold tables only."""
    outlook = forecast.forecast_summary(base["forecast_history"])
    advice = recommend.recommendations(
        base["risk_summary"], base["annual_ola_summary"], outlook, base["forecast_history"]
    )
    return {"forecast_summary": outlook, "recommendations": advice}


SOURCES_OF_DERIVED = ("risk_summary", "annual_ola_summary", "forecast_history")


def gold_tables(valid: DataFrame, cells: DataFrame) -> dict[str, DataFrame]:
    base = base_tables(valid, cells)
    return base | derived_tables(base)


def run_together(jobs: dict, workers: int = CONCURRENT_WRITES) -> dict:
    """Run independent actions side by side so small jobs fill idle executors."""
    with ThreadPoolExecutor(workers) as pool:
        running = {name: pool.submit(job) for name, job in jobs.items()}
        return {name: future.result() for name, future in running.items()}


def write_gold(spark: SparkSession, valid: DataFrame, path: str) -> dict[str, int]:
    """Write the cells, the tables from them and the tables from those; row count of each table."""

    def write_all(tables: dict[str, DataFrame]) -> dict[str, int]:
        def writer(df: DataFrame, target: str):
            return lambda: write_counted(df, target)["rows"]

        return run_together({name: writer(df, f"{path}/{name}") for name, df in tables.items()})

    def stored(name: str) -> DataFrame:
        return spark.read.parquet(f"{path}/{name}")

    with compact_profile(spark):
        write_counted(aggregates.daily_cells_with_p95(valid), f"{path}/daily_cells")
        counts = write_all(base_tables(valid, stored("daily_cells")))
        return counts | write_all(derived_tables({name: stored(name) for name in SOURCES_OF_DERIVED}))


def count_gold(valid: DataFrame) -> dict[str, float]:
    """Count every Gold table without storing it; seconds per stage."""
    start = time.perf_counter()
    with held(aggregates.daily_cells_with_p95(valid)) as (cells,):
        cells.count()
        cells_done = time.perf_counter()
        base = base_tables(valid, cells)
        with held(*(base[name] for name in SOURCES_OF_DERIVED)) as kept:
            base |= dict(zip(SOURCES_OF_DERIVED, kept))
            run_together({name: df.count for name, df in base.items()})
            run_together({name: df.count for name, df in derived_tables(base).items()})
    return {"gold_cells": cells_done - start, "gold_tables": time.perf_counter() - cells_done}
