"""Benchmark: the published synthetic workload and headline queries on the given tables.

reports (50,000 synthetic rows, Silver and dedup, then every Gold output counted); ``queries``
holds its stages and, prefixed by ``sf:``, queries over $BENCH_SF_DIR.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from faultline.operators.quality import latest_versions, only_valid  # noqa: E402
from faultline.plans.gold import count_gold  # noqa: E402
from faultline.plans.silver import silver_records  # noqa: E402
from faultline.queries import QUERIES  # noqa: E402
from faultline.session import build_session, held  # noqa: E402
from faultline.sources.synthetic import synthetic_incidents  # noqa: E402

ROWS = 50_000
RUNS = 3
HEADLINES = (
    "silver_records",
    "dedup_latest",
    "monthly_kpis",
    "dashboard_summary",
    "daily_trends",
    "operational_kpi_summary",
    "risk_summary",
    "forecast_summary",
    "recommendations",
    "trend_weekly",
    "filter_options",
    "reconcile_report",
    "gold_refresh",
    "upsert_state",
)


def workload(spark: SparkSession) -> dict[str, float]:
    """One measured run; generating and caching the input is not part of it, as published."""
    stages: dict[str, float] = {}
    with held(synthetic_incidents(spark, ROWS)) as (raw,):
        raw.count()
        start = time.perf_counter()
        with held(only_valid(latest_versions(silver_records(raw)))) as (valid,):
            stages["valid_rows"] = valid.count()
            stages["silver_transform_and_dedup"] = time.perf_counter() - start
            begin = time.perf_counter()
            stages |= count_gold(valid)
            stages["gold"] = time.perf_counter() - begin
        stages["total"] = time.perf_counter() - start
    return stages


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "faultline-bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")

    workload(spark)
    runs = [workload(spark) for _ in range(RUNS)]
    median = {stage: statistics.median(run[stage] for run in runs) for stage in runs[0]}
    rows = int(median.pop("valid_rows"))
    timed = {f"workload:{stage}": round(seconds, 3) for stage, seconds in median.items()}

    for name in HEADLINES:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timed[f"sf:{name}"] = round(time.perf_counter() - start, 3)

    print(
        json.dumps(
            {
                "metric": "published_workload_median_seconds",
                "value": round(median["total"], 3),
                "unit": "sec",
                "queries": timed,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
                "rows_per_second": round(rows / median["total"], 1),
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
