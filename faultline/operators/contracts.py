"""Publication contracts as table expectations: one aggregation per table, any size."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.config import SEVERITIES


@dataclass(frozen=True)
class Field:
    """Expectation on one published column."""

    name: str
    types: tuple[str, ...]
    nullable: bool = False
    minimum: float | None = None
    maximum: float | None = None
    min_length: int | None = None
    allowed: tuple[str, ...] = ()
    pattern: str | None = None
    is_day: bool = False

    def rules(self) -> dict[str, Column]:
        """Rule name -> broken-when condition."""
        value = F.col(self.name)
        broken: dict[str, Column] = {}
        if not self.nullable:
            broken["required"] = value.isNull()
        if self.minimum is not None:
            broken["minimum"] = value < self.minimum
        if self.maximum is not None:
            broken["maximum"] = value > self.maximum
        if self.min_length is not None:
            broken["min_length"] = F.length(value) < self.min_length
        if self.allowed:
            broken["allowed"] = ~value.isin(*self.allowed)
        if self.pattern is not None:
            broken["pattern"] = ~value.rlike(self.pattern)
        if self.is_day:
            broken["date_format"] = ~value.rlike(DAY_PATTERN) | F.try_to_date(value).isNull()
        return broken


# Fixed value: a calendar day as published.
DAY_PATTERN = r"^\d{4}-\d{2}-\d{2}$"
DAY_START = r"^\d{4}-\d{2}-\d{2}(?!\d)"


def dated(text: Column) -> Column:
    """The text if it starts with a calendar day, else null: only such texts sort by time."""
    return F.when(text.rlike(DAY_START) & F.try_to_date(F.substring(text, 1, 10)).isNotNull(), text)
WHOLE, NUMBER, TEXT, FLAG = ("int", "bigint"), ("int", "bigint", "double"), ("string",), ("boolean",)


def name(column: str, nullable: bool = False) -> Field:
    return Field(column, TEXT, nullable, min_length=1)


def day(column: str, nullable: bool = False) -> Field:
    return Field(column, TEXT, nullable, min_length=1, is_day=True)


def amount(column: str, nullable: bool = False, whole: bool = False, maximum: float | None = None) -> Field:
    return Field(column, WHOLE if whole else NUMBER, nullable, minimum=0, maximum=maximum)


def code(column: str, nullable: bool = False) -> Field:
    return Field(column, WHOLE, nullable, minimum=1)


# Columns, types and bounds of the published tables.
CONTRACTS: dict[str, tuple[Field, ...]] = {
    "daily_trends": (
        day("date"), code("priority_code"), name("priority_name"), name("product", True), name("category", True),
        name("assigned_group", True), amount("total_incidents", whole=True), amount("kpi_incidents", whole=True),
        amount("kpi_violations", whole=True), amount("avg_duration_seconds", True), amount("p95_duration_seconds", True),
    ),
    "risk_summary": (
        name("dimension_type"), name("dimension_value", True), Field("is_unknown", FLAG), amount("volume", whole=True),
        amount("kpi_violation_rate_pct", True), amount("avg_duration_seconds", True),
        amount("risk_score", maximum=100), code("rank", True),
    ),
    "forecast_history": (day("date"), amount("actual_incidents", whole=True)),
    "forecast": (
        day("date"), amount("predicted_incidents", whole=True), amount("lower_bound", whole=True),
        amount("upper_bound", whole=True),
    ),
    "recommendations": (
        name("recommendation_id"), name("dimension_type"), name("target", True), Field("severity", TEXT, allowed=SEVERITIES),
        name("title"), name("recommendation"), name("evidence"), name("metric_name"), Field("metric_value", NUMBER, True),
        name("metric_unit"),
    ),
    "filter_options": (
        Field("kind", TEXT, allowed=("year", "month", "priority", "product", "category", "team")),
        Field("code", WHOLE, True, minimum=1), name("label"),
    ),
}


# A legacy document of trend records: a time and a list.
TREND_DOCUMENT = (name("generated_at"), Field("records", ()))


def broken_rules(fields: tuple[Field, ...]) -> Column:
    """The broken rules of a row as ``column:rule`` names joined by ``|``; empty if none is."""
    found = [F.when(broken, F.lit(f"{f.name}:{rule}")) for f in fields for rule, broken in f.rules().items()]
    return F.concat_ws("|", *found)


def enforced(df: DataFrame, fields: tuple[Field, ...]) -> DataFrame:
    """The same rows; a row that breaks a rule stops the job, which names the rules."""
    broken = broken_rules(fields)
    stop = F.raise_error(F.concat(F.lit("document breaks "), broken))
    first = fields[0].name
    checked = F.when(F.length(broken) > 0, stop.cast(df.schema[first].dataType)).otherwise(F.col(first))
    return df.withColumn(first, checked)


def shape_rows(df: DataFrame, fields: tuple[Field, ...]) -> list[Column]:
    """Missing, extra or wrongly typed columns, known without reading data."""
    have, want = dict(df.dtypes), {field.name: field for field in fields}
    found = [(column, "missing_column") for column in want if column not in have]
    found += [(column, "extra_column") for column in have if column not in want]
    found += [(c, "type") for c, f in want.items() if c in have and have[c] not in f.types]
    return [outcome(column, rule, F.lit(1)) for column, rule in found]


def outcome(column: str, rule: str, violations: Column) -> Column:
    return F.struct(
        F.lit(column).alias("column_name"), F.lit(rule).alias("rule"), violations.cast("bigint").alias("violations")
    )


def contract_outcomes(df: DataFrame, table: str) -> DataFrame:
    """Every rule of the table with its number of violating rows."""
    fields = CONTRACTS[table]
    checked = [field for field in fields if field.name in df.columns]
    rules = {(f.name, rule): broken for f in checked for rule, broken in f.rules().items()}
    counted = df.agg(*(F.count_if(broken).alias(f"{c}__{rule}") for (c, rule), broken in rules.items()))
    rows = shape_rows(df, fields) + [outcome(c, rule, F.col(f"{c}__{rule}")) for c, rule in rules]
    return counted.select(F.lit(table).alias("table_name"), F.inline(F.array(*rows)))


def contract_violations(df: DataFrame, table: str) -> DataFrame:
    return contract_outcomes(df, table).filter("violations > 0")


def violating_rows(df: DataFrame, table: str) -> DataFrame:
    """Rows that break a rule, with the broken rules as ``column:rule`` names."""
    fields = tuple(field for field in CONTRACTS[table] if field.name in df.columns)
    return df.withColumn("broken_rules", broken_rules(fields)).filter("broken_rules <> ''")


def violation_report(df: DataFrame, table: str, order: list[str], limit: int = 10) -> DataFrame:
    """First violating rows in order, each with the number of violations not shown."""
    wrong = violating_rows(df, table)
    total = wrong.agg(F.count("*").alias("n")).scalar()
    hidden = F.greatest(total - limit, F.lit(0)).alias("not_shown")
    return wrong.orderBy(*order).limit(limit).select("*", hidden)
