"""Batch ledger: one append-only table with a row per (layer, batch, attempt)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LAYERS = ("bronze", "silver", "gold")


def effective_batches(ledger: DataFrame) -> DataFrame:
    """Last successful attempt of every batch in every layer."""
    last_first = Window.partitionBy("layer", "batch_id").orderBy(F.col("processed_at").desc())
    return (
        ledger.filter(F.col("status") == "SUCCESS")
        .withColumn("_attempt", F.row_number().over(last_first))
        .filter("_attempt = 1")
        .drop("_attempt")
    )


def pending_batches(ledger: DataFrame, upstream: str, downstream: str) -> DataFrame:
    """Batches finished upstream that the downstream layer has not processed."""
    done = effective_batches(ledger)
    ready = done.filter(F.col("layer") == upstream)
    taken = done.filter(F.col("layer") == downstream).select("batch_id")
    return ready.join(taken, "batch_id", "left_anti")


def latest_batch(batches: DataFrame) -> DataFrame:
    """Newest effective batch of each layer with the table totals recorded then.

    All batches of one run carry the same totals, so a tie on the time does not matter for
    them; the batch id only makes the choice repeatable.
    """
    newest = F.max_by(
        F.struct(
            "batch_id", "silver_total_records", "quarantine_total_records", "gold_snapshot_records", "processed_at"
        ),
        F.struct("processed_at", "batch_id"),
    )
    return batches.groupBy("layer").agg(newest.alias("b")).select("layer", "b.*")


def layer_totals(batches: DataFrame) -> DataFrame:
    """One row with batch counts and record totals of all layers."""

    def of(layer: str):
        return F.col("layer") == layer

    def newest(layer: str, column: str):
        # Unlisted layers have no newest row: max_by over nulls gives null, reported as zero.
        when = F.when(of(layer), F.struct("processed_at", "batch_id"))
        return F.coalesce(F.max_by(column, when), F.lit(0))

    return batches.agg(
        F.count_if(of("bronze")).alias("bronze_batches"),
        F.coalesce(F.sum(F.when(of("bronze"), F.col("records_written"))), F.lit(0)).alias("bronze_records"),
        F.count_if(of("silver")).alias("silver_batches"),
        newest("silver", "silver_total_records").alias("silver_records"),
        newest("silver", "quarantine_total_records").alias("quarantine_records"),
        F.count_if(of("gold")).alias("gold_batches"),
        newest("gold", "gold_snapshot_records").alias("gold_snapshot_records"),
    )


def control_snapshot(ledger: DataFrame, landing_files: DataFrame | None = None) -> DataFrame:
    totals = layer_totals(effective_batches(ledger))
    if landing_files is None:
        return totals
    return totals.withColumn("landing_files", landing_files.agg(F.count("*").alias("n")).scalar())


def silver_entries(batches: DataFrame, quality: DataFrame, silver_total, quarantine_total) -> DataFrame:
    """Ledger rows of a Silver run: counts per batch and the table totals after the run."""
    return batches.join(quality, "batch_id", "left").select(
        F.lit("silver").alias("layer"),
        "batch_id",
        F.lit("SUCCESS").alias("status"),
        "source_file",
        "file_hash",
        (F.col("valid_records") + F.col("invalid_records")).alias("records_received"),
        F.col("valid_records").alias("valid_records_received"),
        F.col("invalid_records").alias("invalid_records_received"),
        F.lit(silver_total).cast("bigint").alias("silver_total_records"),
        F.lit(quarantine_total).cast("bigint").alias("quarantine_total_records"),
        F.current_timestamp().alias("processed_at"),
    )
