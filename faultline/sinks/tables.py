"""Parquet sinks that report or verify what they wrote."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


# Rows of a task that reads one value of a column back.
ROWS_PER_TASK = 600_000
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
# Scans of one task each stay tasks of their own in a union, instead of becoming one task together.
SCAN_CONF = {"spark.sql.unionOutputPartitioning": "false"}


class WriteMismatch(RuntimeError):
    """Rows read back differ from the rows handed to the writer."""


def write_counted(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    extra: dict | None = None,
    replace_partitions: bool = False,
) -> dict[str, int]:
    """Write once and return the row count (and further aggregates) observed on the way.

    The observation sits directly below the writer, in the result stage, where Spark counts
    every task once even if executors are lost and earlier stages run again.  With
    ``replace_partitions`` only the partitions that are written replace what they held.
    """
    seen = Observation()
    measures = {"rows": F.count(F.lit(1)), **(extra or {})}
    watched = df.observe(seen, *(column.alias(name) for name, column in measures.items()))
    writer = watched.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if replace_partitions:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    return dict(seen.get)


def balanced_by(df: DataFrame, *columns: str) -> DataFrame:
    """Bring rows of a target partition together before a partitioned write.

    Unlike a plain repartition, adaptive execution may split a partition value that holds a
    large share of the rows over several tasks, and merge the small ones.
    """
    return df.hint("rebalance", *(F.col(name) for name in columns))


def stored_by(spark: SparkSession, df: DataFrame, path: str, column: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The rows written by the values of a text column and read back so that a task holds rows of one value.

    Columnar files take a third of the room of shuffled rows.  There is a scan for every value, so
    the column must have few plain values, as months are.  Use the rows under ``SCAN_CONF``.
    """
    write_counted(df, path, [column])
    reader = spark.read.schema(df.schema).option("basePath", path)
    sizes = reader.parquet(path).groupBy(column).count().collect()
    scans = [
        reader.parquet(f"{path}/{column}={NULL_PARTITION if value is None else value}").coalesce(math.ceil(n / rows_per_task))
        for value, n in sorted(sizes, key=str)
    ]
    return reduce(DataFrame.union, scans) if scans else reader.parquet(path)


def write_by_month(df: DataFrame, path: str, mode: str = "overwrite") -> int:
    """Overwrite partitioned by opened year and month; rows without a date get the null partition."""
    months = ("opened_year", "opened_month")
    return write_counted(balanced_by(df, *months), path, months, mode)["rows"]


def verified_write(
    spark: SparkSession, df: DataFrame, path: str, partition_by: Sequence[str] = (), allow_empty: bool = True
) -> int:
    """Write, count what is stored (Parquet footers only) and fail on any difference."""
    written = write_counted(df, path, partition_by)["rows"]
    if written == 0 and not allow_empty:
        raise WriteMismatch(f"nothing to write to {path}")
    stored = spark.read.schema(df.schema).parquet(path).count()
    if stored != written:
        raise WriteMismatch(f"{path}: wrote {written} rows, found {stored}")
    return written


def write_split(spark: SparkSession, df: DataFrame, path: str) -> dict[str, int]:
    """Valid and invalid rows side by side (``dq_status=...``) in one pass, both verified."""
    checks = {
        "valid": F.count_if(F.col("dq_status") == "VALID"),
        "invalid": F.count_if(F.col("dq_status") == "INVALID"),
    }
    counted = write_counted(df, path, ["dq_status"], extra=checks)
    stored = spark.read.schema(df.schema).parquet(path).groupBy("dq_status").count()
    found = {row["dq_status"]: row["count"] for row in stored.collect()}
    for status in ("valid", "invalid"):
        if found.get(status.upper(), 0) != counted[status]:
            raise WriteMismatch(f"{path}: {status} rows {counted[status]}, found {found.get(status.upper(), 0)}")
    return counted
