"""Positions in a given order without one task per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.session import new_run_dir

# The bits below a task's number in Spark's increasing row ids.
TASK_BITS = 33


def range_ranked(df: DataFrame, group: str, order: list[Column], out: str) -> DataFrame:
    """``df`` with the position, from 1, of every row within its group.

    Rows are range-partitioned by group and order, so a group may spread over many tasks, and are
    written with their place in that order.  A row's position is its place within its task plus the
    rows of the group in earlier tasks; only one row per group and task is summed up for that.
    """
    spark, path = df.sparkSession, new_run_dir(df.sparkSession, "ranked")
    keys = [F.col(group), *order]
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_place", F.monotonically_increasing_id())
    ranged.write.parquet(path)
    placed = spark.read.schema(ranged.schema).parquet(path).withColumn("_task", F.shiftright("_place", TASK_BITS))
    tasks = placed.groupBy(group, "_task").agg(F.min("_place").alias("_first"), F.count("*").alias("_rows"))
    earlier = Window.partitionBy(group).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = tasks.withColumn("_before", F.coalesce(F.sum("_rows").over(earlier), F.lit(0))).drop("_rows")
    position = F.col("_place") - F.col("_first") + F.col("_before") + 1
    return placed.join(offsets, [group, "_task"]).select(*df.columns, position.cast("bigint").alias(out))
