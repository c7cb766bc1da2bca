"""From raw text rows to typed incident columns.

Each step is one projection, so Catalyst folds the chain into a single stage over the scan.
All casts are the ``try_`` kind: an unreadable value becomes null and the quality rules
report it, whatever the session's ANSI setting is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.functions.text import blank_to_null, yes_no_flag
from faultline.schema import SOURCE_COLUMNS

LEADING_CODE = r"^(\d+)"
CODE_AND_DASH = r"^\d+\s*-\s*"


def rename_source(df: DataFrame) -> DataFrame:
    return df.withColumnsRenamed(SOURCE_COLUMNS)


def strip_blanks(df: DataFrame) -> DataFrame:
    """Trim every business column; lineage columns (leading underscore) pass untouched."""
    return df.select(
        *(
            F.col(f"`{name}`") if name.startswith("_") else blank_to_null(F.col(f"`{name}`")).alias(name)
            for name in df.columns
        )
    )


def split_priority(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "priority_code": F.regexp_extract("priority", LEADING_CODE, 1).try_cast("int"),
            "priority_name": F.trim(F.regexp_replace("priority", CODE_AND_DASH, "")),
        }
    )


def parse_times(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {name: F.try_to_timestamp(name) for name in ("opened_at", "resolved_at", "closed_at")}
    )


def parse_duration(df: DataFrame) -> DataFrame:
    seconds = F.col("duration_seconds").try_cast("double").try_cast("bigint")
    return df.withColumn("duration_seconds", seconds)


def decode_flags(df: DataFrame) -> DataFrame:
    return df.withColumns({name: yes_no_flag(F.col(name)) for name in ("entered_kpi", "kpi_violated")})


def add_opened_parts(df: DataFrame) -> DataFrame:
    return df.withColumns({"opened_year": F.year("opened_at"), "opened_month": F.month("opened_at")})


def type_columns(df: DataFrame) -> DataFrame:
    steps = (split_priority, parse_times, parse_duration, decode_flags, add_opened_parts)
    for step in steps:
        df = df.transform(step)
    return df
