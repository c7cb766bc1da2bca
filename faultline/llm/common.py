"""Shared folder, stored intermediates and ranks that never gather a whole group in one task."""

from __future__ import annotations

import math
import shutil
import tempfile
import uuid
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# One rank bucket holds about this many rows; a larger group gets more buckets.
BUCKET_ROWS = 4096
MAX_BUCKET_BITS = 20

# What the contracts call a blank: space and the controls 09 to 0D.
BLANKS = " \t\n\x0b\x0c\r"

# Rows of texts that Python holds as objects at once.  Spark's own batches are up to 10,000 rows or 64 MB,
# and every reused worker keeps the room that its largest batch took.
TEXT_ROWS = 512
TEXT_CONF = {"spark.sql.execution.arrow.maxRecordsPerBatch": str(TEXT_ROWS)}


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a local session without one gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stored(frame: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back: cuts the lineage, survives lost executors."""
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def send_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per Spark context."""
    context = spark.sparkContext
    if not getattr(context, "_llm_sent", False):
        package = Path(__file__).resolve().parent.parent
        archive = shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent, package.name)
        context.addPyFile(archive)
        context._llm_sent = True


def in_pandas(frame: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``mapInPandas`` with this package on the workers."""
    send_package(frame.sparkSession)
    return frame.mapInPandas(function, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def uniform_key(seed: int, *columns: Column) -> Column:
    """A seeded pseudo-random long from 0 to 2**63 - 1."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 1)


def bucket_bits(rows: int, bucket_rows: int = BUCKET_ROWS) -> int:
    return min(MAX_BUCKET_BITS, max(0, math.ceil(math.log2(max(1, rows / bucket_rows)))))


def spread_rank(
    frame: DataFrame, groups: list[str], key: str, ties: list[str], bits: int, out: str
) -> DataFrame:
    """Rank from 0 within each group by a uniform key, without one task per group.

    The key's leading bits cut every group into buckets.  Rows are ranked inside their bucket and
    shifted by the number of rows in the group's earlier buckets.  ``frame`` is read twice, so it
    should be a stored table.
    """
    bucketed = frame.withColumn("_bucket", F.shiftright(F.col(key), 63 - bits).cast("int"))
    places = [*groups, "_bucket"]
    before = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        bucketed.groupBy(*places)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*places, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy(*places).orderBy(key, *ties)
    ranked = bucketed.withColumn("_rank", F.row_number().over(inside) - 1)
    return (
        ranked.join(offsets, places)
        .withColumn(out, F.col("_rank") + F.col("_offset"))
        .drop("_bucket", "_rank", "_offset")
    )


def blank_to_space(text: Column) -> Column:
    """Null becomes empty, every blank a space."""
    result = F.coalesce(text, F.lit(""))
    for blank in BLANKS[1:]:
        result = F.replace(result, F.lit(blank), F.lit(" "))
    return result


def words_of(spaced: Column) -> Column:
    """The words of a text whose blanks are all spaces."""
    return F.array_remove(F.split(spaced, " "), "")
