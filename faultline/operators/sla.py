"""Service-level audit: limit, eligibility, violation, reason and comparison with the source.

Eligibility and reason come from one ordered ladder of cases, so they cannot disagree.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.config import SLA, SlaPolicy
from faultline.functions.text import matches_folded


AUDIT_COLUMNS = (
    "kpi_rule_version", "kpi_limit_seconds", "kpi_rule_reason", "kpi_eligible_by_rule", "kpi_violated_by_rule",
    "entered_kpi_rule_matches_source", "kpi_violated_rule_matches_source",
)


@dataclass(frozen=True)
class Case:
    reason: str
    applies: Column
    eligible: bool | None


def case_ladder(policy: SlaPolicy) -> list[Case]:
    """Cases in order of precedence; a case whose condition is null does not apply."""
    code = F.col("priority_code")
    return [
        Case("invalid_priority", code.isNull() | ~code.isin(*policy.limits), None),
        Case("priority_not_eligible", ~code.isin(*policy.eligible_priorities), False),
        Case("parent_incident", F.trim("parent_incident_id") != "", False),
        Case("status_without_intervention", matches_folded(F.col("status"), policy.excluded_status), False),
        Case("missing_duration", F.col("duration_seconds").isNull(), True),
        Case("eligible", F.lit(True), True),
    ]


def limit_seconds(policy: SlaPolicy) -> Column:
    pairs = list(policy.limits.items())
    limit = F.when(F.col("priority_code") == pairs[0][0], F.lit(pairs[0][1]))
    for code, seconds in pairs[1:]:
        limit = limit.when(F.col("priority_code") == code, F.lit(seconds))
    return limit.cast("bigint")


def add_limit(df: DataFrame, policy: SlaPolicy = SLA) -> DataFrame:
    return df.withColumns({"kpi_rule_version": F.lit(policy.version), "kpi_limit_seconds": limit_seconds(policy)})


def add_reason(df: DataFrame, policy: SlaPolicy = SLA) -> DataFrame:
    first, *rest = case_ladder(policy)
    ladder = F.when(first.applies, first.reason)
    for case in rest:
        ladder = ladder.when(case.applies, case.reason)
    return df.withColumn("kpi_rule_reason", ladder)


def add_eligibility(df: DataFrame, policy: SlaPolicy = SLA) -> DataFrame:
    """Needs the reason: the ladder's conditions are evaluated once, not once per output."""
    cases = case_ladder(policy)
    refused = [case.reason for case in cases if case.eligible is False]
    accepted = [case.reason for case in cases if case.eligible]
    reason = F.col("kpi_rule_reason")
    eligible = F.when(reason.isin(*accepted), True).when(reason.isin(*refused), False)
    return df.withColumn("kpi_eligible_by_rule", eligible)


def add_violation(df: DataFrame) -> DataFrame:
    """Needs the limit and the eligibility; null where the question does not apply."""
    measured = F.col("kpi_eligible_by_rule") & (F.col("duration_seconds") >= 0)
    over = F.col("duration_seconds") > F.col("kpi_limit_seconds")
    return df.withColumn("kpi_violated_by_rule", F.when(measured, over))


def add_source_match(df: DataFrame) -> DataFrame:
    """``=`` is already null when a side is null, which is what the audit wants."""
    return df.withColumns(
        {
            "entered_kpi_rule_matches_source": F.col("kpi_eligible_by_rule") == F.col("entered_kpi"),
            "kpi_violated_rule_matches_source": F.col("kpi_violated_by_rule") == F.col("kpi_violated"),
        }
    )


def audit_sla(df: DataFrame, policy: SlaPolicy = SLA) -> DataFrame:
    """All seven audit columns; running it again on audited rows overwrites them."""
    return (
        df.transform(add_limit, policy)
        .transform(add_reason, policy)
        .transform(add_eligibility, policy)
        .transform(add_violation)
        .transform(add_source_match)
    )
