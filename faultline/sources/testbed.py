"""Incident versions read out of a star schema of orders and line items.

One version per line item; several line items of an order are versions of one incident.
Values are rendered as text under the headers of the incident extract, with some padding and
empty texts, so the whole cleaning path is exercised.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.config import SlaPolicy

# Order keys above seven digits make longer ids; they are ids all the same.
POLICY = SlaPolicy(incident_id=r"^INC\d{7,}$")

# Lineage columns that order versions closed in the same second (fixed by the extract).
VERSION_TIEBREAK = ("_line_number", "_part_key", "_supplier_key", "_extended_price")

# Line items of a task of the join with their orders, and the most before it is left to adaptive execution.
ROWS_PER_TASK = 250_000
MOST_ROWS = 4 * ROWS_PER_TASK


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def by_order(lines: DataFrame, orders: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Large tables dealt by order key into tasks of about ``ROWS_PER_TASK`` line items.

    What a task sorts does not grow with the tables then, whatever number of partitions the session
    has.  Small tables, and tables with an order that would fill a task of its own, are left to
    adaptive execution, which splits such a task.
    """
    parts = lines.count() // ROWS_PER_TASK
    if parts < lines.sparkSession.sparkContext.defaultParallelism:
        return lines, orders
    sizes = lines.groupBy(F.pmod(F.hash("l_orderkey"), F.lit(parts))).count()
    if sizes.agg(F.max("count")).first()[0] > MOST_ROWS:
        return lines, orders
    return lines.repartition(parts, "l_orderkey"), orders.repartition(parts, "o_orderkey")


def incident_id(key: str) -> Column:
    """``INC`` and the key in seven digits at least."""
    number, digits = F.col(key), F.col(key).cast("string")
    padded = F.when(number >= 10_000_000, digits).when(number >= 0, F.lpad(digits, 7, "0"))
    return F.concat(F.lit("INC"), padded.otherwise(F.format_string("%07d", key)))


def incident_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rendered(joined_lines(spark, sf_dir))


def joined_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their orders; no join hints: the optimizer broadcasts a side only while its measured size allows it."""
    lines, orders = by_order(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"))
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey)


def described(lines: DataFrame, sf_dir: str, once: bool = False) -> DataFrame:
    """Lines with part, supplier and nation; with ``once`` each stays one row where keys of these tables repeat."""
    parts, suppliers, nations = (table(lines.sparkSession, sf_dir, name) for name in ("part", "supplier", "nation"))
    if once:
        parts, suppliers, nations = (
            rows.dropDuplicates([key]) for rows, key in ((parts, "p_partkey"), (suppliers, "s_suppkey"), (nations, "n_nationkey"))
        )
    return (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"), "left")
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"), "left")
    )


def joined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return described(joined_orders(spark, sf_dir), sf_dir)


STAMP = "yyyy-MM-dd HH:mm:ss"


def ages() -> list[Column]:
    """The lineage columns that order versions, after the closing time."""
    return [
        F.add_months(F.trunc("l_shipdate", "month"), 1).cast("timestamp").alias("_ingested_at"),
        F.col("l_linenumber").alias("_line_number"),
        F.col("l_partkey").alias("_part_key"),
        F.col("l_suppkey").alias("_supplier_key"),
        F.col("l_extendedprice").alias("_extended_price"),
    ]


def with_ages(lines: DataFrame) -> DataFrame:
    """Lines with their orders and what the choice of the newest version needs, under the headers of the extract."""
    closed = F.date_format("l_shipdate", STAMP)
    return lines.select("*", incident_id("o_orderkey").alias("Número"), closed.alias("Encerrado"), *ages())


def rendered(joined: DataFrame) -> DataFrame:
    """Joined lines as texts under the headers of the extract."""
    line = F.col("l_linenumber")
    shipped = F.date_format("l_shipdate", STAMP)
    return joined.select(
        incident_id("o_orderkey").alias("Número"),
        F.col("o_orderpriority").alias("Prioridade"),
        F.when(line == 2, F.concat(F.lit("  "), F.col("p_brand"), F.lit(" ")))
        .otherwise(F.col("p_brand"))
        .alias("Produto"),
        F.col("p_type").alias("Categoria"),
        F.when(line == 3, F.lit("  ")).otherwise(F.col("p_size").cast("string")).alias("Subcategoria"),
        F.when(F.col("l_suppkey") % 97 != 0, F.col("n_name")).alias("Grupo designado"),
        F.col("s_name").alias("Item de configuração"),
        F.date_format("o_orderdate", STAMP).alias("Aberto"),
        shipped.alias("Resolvido"),
        shipped.alias("Encerrado"),
        F.floor(F.col("l_extendedprice") / 2).cast("string").alias("Duração"),
        F.col("l_returnflag").alias("Código de fechamento"),
        F.col("p_name").alias("Descrição resumida"),
        F.lit("").alias("Solução"),
        F.when(F.col("l_linestatus") == "O", "Monitoramento").otherwise("Manual").alias("Aberto por"),
        F.when(line == 7, "INC0000000").alias("Incidente Pai"),
        F.when(F.col("o_orderstatus") == "P", "Sem Intervenção").otherwise("Encerrado").alias("Status"),
        F.when(F.col("l_returnflag") == "R", "SIM")
        .when(F.col("l_returnflag") == "N", "NAO")
        .otherwise("N/A")
        .alias("Entrou para KPI?"),
        F.when(F.col("l_discount") >= 0.08, "sim")
        .when(F.col("l_discount") >= 0.02, "Nao")
        .otherwise("N/A")
        .alias("KPI Violado?"),
        F.date_format("l_shipdate", "yyyy_MM").alias("_batch_id"),
        *ages(),
    )
