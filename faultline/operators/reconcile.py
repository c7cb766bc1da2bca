"""Cross-layer checks on the ledger and on stored counts.

A batch's rows of all layers meet in one aggregation by batch id, so every check reads the
ledger with a single shuffle instead of joining the layers pairwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.operators.ledger import LAYERS, effective_batches, layer_totals
from faultline.schema import GOLD_TABLES

COMPARED_FIELDS = ("source_file", "file_hash")

# Names and explanations of the checks, in reporting order.
CHECK_TEXTS = {
    "batch_sets_match": "Os mesmos batches SUCCESS devem existir nas três camadas.",
    "batch_metadata_match": "Arquivo de origem e hash devem permanecer iguais entre camadas.",
    "batch_intake_counts_match": "Cada batch Silver deve receber o volume gravado na Bronze.",
    "batch_dq_split_matches": "Válidos e inválidos recebidos devem totalizar o batch.",
    "snapshot_conservation": "Bronze menos Silver e quarentena define duplicidades removidas.",
    "gold_snapshot_matches_silver": "O snapshot processado pela Gold deve corresponder à Silver válida.",
    "bronze_paths_exist": "Todos os Parquets Bronze registrados devem existir.",
    "bronze_control_matches_storage": "A contagem física da Bronze deve corresponder ao controle.",
    "silver_control_matches_storage": "A contagem física da Silver deve corresponder ao controle.",
    "quarantine_control_matches_storage": "A contagem física da quarentena deve corresponder ao controle.",
    "gold_outputs_exist": "Todos os produtos Gold incrementais devem existir.",
}


def in_layer(layer: str, value: Column) -> Column:
    return F.max(F.when(F.col("layer") == layer, value))


def batch_matrix(batches: DataFrame) -> DataFrame:
    """One row per batch with the fields of every layer side by side."""
    columns = [F.bool_or(F.col("layer") == layer).alias(f"in_{layer}") for layer in LAYERS]
    for layer in LAYERS:
        columns += [in_layer(layer, F.col(field)).alias(f"{layer}_{field}") for field in COMPARED_FIELDS]
    columns.append(in_layer("bronze", F.col("records_written")).alias("records_written"))
    for field in ("records_received", "valid_records_received", "invalid_records_received"):
        columns.append(in_layer("silver", F.col(field)).alias(field))
    return batches.groupBy("batch_id").agg(*columns)


def batch_presence(matrix: DataFrame) -> DataFrame:
    everywhere = F.col("in_bronze") & F.col("in_silver") & F.col("in_gold")
    return matrix.select("batch_id", "in_bronze", "in_silver", "in_gold", everywhere.alias("in_all_layers"))


def metadata_differences(matrix: DataFrame) -> DataFrame:
    """One row per (batch, layer, field) that differs from Bronze, for batches in all layers."""
    pairs = [
        F.struct(
            F.lit(layer).alias("layer"),
            F.lit(field).alias("field"),
            F.col(f"bronze_{field}").alias("expected"),
            F.col(f"{layer}_{field}").alias("actual"),
        )
        for layer in ("silver", "gold")
        for field in COMPARED_FIELDS
    ]
    common = matrix.filter("in_bronze AND in_silver AND in_gold")
    return common.select("batch_id", F.inline(F.array(*pairs))).filter(~F.col("expected").eqNullSafe(F.col("actual")))


def intake_differences(matrix: DataFrame) -> DataFrame:
    both = matrix.filter("in_bronze AND in_silver")
    return both.select(
        "batch_id", F.col("records_written").alias("expected"), F.col("records_received").alias("actual")
    ).filter(~F.col("expected").eqNullSafe(F.col("actual")))


def split_differences(matrix: DataFrame) -> DataFrame:
    split = F.col("valid_records_received") + F.col("invalid_records_received")
    return (
        matrix.filter("in_silver")
        .select("batch_id", F.col("records_received").alias("expected"), split.alias("actual"))
        .filter(~F.col("expected").eqNullSafe(F.col("actual")))
    )


def missing_gold(present: DataFrame) -> DataFrame:
    """Expected Gold tables without output; ``present`` has one ``table_name`` per stored table."""
    expected = present.sparkSession.createDataFrame([(name,) for name in GOLD_TABLES], "table_name string")
    return expected.join(present.select("table_name").distinct(), "table_name", "left_anti")


def check(name: str, passed: Column, expected: Column, actual: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check_name"),
        F.when(passed, "PASS").otherwise("FAIL").alias("status"),
        expected.cast("string").alias("expected"),
        actual.cast("string").alias("actual"),
        F.lit(CHECK_TEXTS[name]).alias("message"),
    )


def reconciliation_checks(ledger: DataFrame, physical: DataFrame) -> DataFrame:
    """The eleven checks, one row each.

    ``physical`` is one row: bronze_records, silver_records, quarantine_records,
    missing_bronze_paths, missing_gold_outputs (counts of what is stored or missing).
    """
    batches = effective_batches(ledger)
    matrix = batch_matrix(batches)
    apart = ~F.col("in_bronze") | ~F.col("in_silver") | ~F.col("in_gold")

    def differs(layer: str, field: str) -> Column:
        everywhere = F.col("in_bronze") & F.col("in_silver") & F.col("in_gold")
        return everywhere & ~F.col(f"bronze_{field}").eqNullSafe(F.col(f"{layer}_{field}"))

    split = F.col("valid_records_received") + F.col("invalid_records_received")
    found = matrix.agg(
        F.count_if("in_bronze").alias("bronze_ids"),
        F.count_if(apart).alias("unmatched_ids"),
        sum(F.count_if(differs(layer, f)) for layer in ("silver", "gold") for f in COMPARED_FIELDS).alias("metadata"),
        F.count_if(
            F.col("in_bronze")
            & F.col("in_silver")
            & ~F.col("records_written").eqNullSafe(F.col("records_received"))
        ).alias("intake"),
        F.count_if(F.col("in_silver") & ~F.col("records_received").eqNullSafe(split)).alias("split"),
    )
    # Each one-row input is one scalar subquery: nothing is cross joined or computed twice.
    totals = layer_totals(batches)
    stored = [F.col(f"_stored.{name}").alias(f"stored_{name}") for name in physical.columns]
    facts = (
        found.select(
            "*",
            totals.select(F.struct("*")).scalar().alias("_totals"),
            physical.select(F.struct("*")).scalar().alias("_stored"),
        )
        .select("*", "_totals.*", *stored)
        .withColumn("removed", F.expr("bronze_records - silver_records - quarantine_records"))
    )

    zero, c = F.lit(0), F.col

    def same(name: str, expected: str, actual: str) -> Column:
        return check(name, c(expected) == c(actual), c(expected), c(actual))

    def none_of(name: str, count: str) -> Column:
        return check(name, c(count) == 0, zero, c(count))

    checks = [
        check("batch_sets_match", (c("bronze_ids") > 0) & (c("unmatched_ids") == 0), zero, c("unmatched_ids")),
        none_of("batch_metadata_match", "metadata"),
        none_of("batch_intake_counts_match", "intake"),
        none_of("batch_dq_split_matches", "split"),
        check("snapshot_conservation", c("removed") >= 0, F.lit("valor maior ou igual a zero"), c("removed")),
        same("gold_snapshot_matches_silver", "silver_records", "gold_snapshot_records"),
        none_of("bronze_paths_exist", "stored_missing_bronze_paths"),
        same("bronze_control_matches_storage", "bronze_records", "stored_bronze_records"),
        same("silver_control_matches_storage", "silver_records", "stored_silver_records"),
        same("quarantine_control_matches_storage", "quarantine_records", "stored_quarantine_records"),
        none_of("gold_outputs_exist", "stored_missing_gold_outputs"),
    ]
    return facts.select(F.inline(F.array(*checks)))


def reconciliation_verdict(checks: DataFrame) -> DataFrame:
    failed = F.count_if(F.col("status") == "FAIL")
    return checks.agg(
        F.when(failed == 0, "PASS").otherwise("FAIL").alias("status"),
        F.count("*").alias("checks_total"),
        F.count_if(F.col("status") == "PASS").alias("checks_passed"),
        failed.alias("checks_failed"),
    )
