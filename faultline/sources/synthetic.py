"""Deterministic synthetic incidents derived from a row number.

Used to repeat the published workload; every value is arithmetic on the id, so any number of
executors generates the same rows without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --------------------------------------------------------------------------- fixed values
PRIORITY_NAMES = ("Crítica", "Alta", "Média", "Baixa", "Muito Baixa")
PRODUCTS, CATEGORIES, SUBCATEGORIES, TEAMS, ITEMS = 12, 18, 24, 17, 30
FIRST_EPOCH = 1_672_531_200
PERIOD_SECONDS = 3 * 365 * 86_400
OPENING_STEP = 3_601
DURATION_STEP, DURATION_RANGE, DURATION_MIN = 97, 200_000, 600
DUPLICATE_SHARE = 20
MIN_ROWS, MAX_ROWS = 100, 9_000_000
SOURCE_FILE = "synthetic-benchmark.csv"
# ----------------------------------------------------------------------------------------


def numbered(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def synthetic_rows(ids: DataFrame, distinct_incidents: int | Column) -> DataFrame:
    """Raw incident rows for a frame with a bigint ``id``."""
    row = F.col("id")
    code = (row % 5 + 1).cast("int")
    seconds = row * DURATION_STEP % DURATION_RANGE + DURATION_MIN
    opened = FIRST_EPOCH + row * OPENING_STEP % PERIOD_SECONDS
    distinct = distinct_incidents if isinstance(distinct_incidents, Column) else F.lit(distinct_incidents)
    base = ids.select(
        "id",
        code.alias("code"),
        seconds.alias("seconds"),
        F.timestamp_seconds(opened).alias("opened"),
        F.timestamp_seconds(opened + seconds).alias("closed"),
        (row % distinct + 1).alias("number"),
    )
    stamp = "yyyy-MM-dd HH:mm:ss"
    opened_text, closed_text = F.date_format("opened", stamp), F.date_format("closed", stamp)
    in_scope = F.col("code") <= 3
    return base.select(
        F.format_string("INC%07d", "number").alias("Número"),
        F.concat_ws(" - ", F.col("code").cast("string"), F.element_at(F.lit(list(PRIORITY_NAMES)), F.col("code"))).alias(
            "Prioridade"
        ),
        numbered("Produto", row % PRODUCTS).alias("Produto"),
        numbered("Categoria", row % CATEGORIES).alias("Categoria"),
        numbered("Subcategoria", row % SUBCATEGORIES).alias("Subcategoria"),
        F.format_string("Team%02d", row % TEAMS + 1).alias("Grupo designado"),
        numbered("CI-", row % ITEMS).alias("Item de configuração"),
        opened_text.alias("Aberto"),
        closed_text.alias("Resolvido"),
        closed_text.alias("Encerrado"),
        F.col("seconds").cast("string").alias("Duração"),
        F.lit("Resolvido").alias("Código de fechamento"),
        F.lit("Incidente sintético de benchmark").alias("Descrição resumida"),
        F.lit("Solução sintética").alias("Solução"),
        F.when(row % 3 == 0, "Monitoramento").otherwise("Manual").alias("Aberto por"),
        F.lit(None).cast("string").alias("Incidente Pai"),
        F.lit("Encerrado").alias("Status"),
        F.when(in_scope, "SIM").otherwise("NAO").alias("Entrou para KPI?"),
        F.when(in_scope & (F.col("seconds") > 14_400), "SIM").otherwise("NAO").alias("KPI Violado?"),
        F.col("opened").alias("_ingested_at"),
        F.lit(SOURCE_FILE).alias("_source_file"),
    )


def synthetic_incidents(spark: SparkSession, rows: int) -> DataFrame:
    """``rows`` raw rows of which one in twenty repeats an incident number."""
    if not MIN_ROWS <= rows <= MAX_ROWS:
        raise ValueError(f"row count must lie between {MIN_ROWS} and {MAX_ROWS}")
    return synthetic_rows(spark.range(rows), rows - max(1, rows // DUPLICATE_SHARE))
