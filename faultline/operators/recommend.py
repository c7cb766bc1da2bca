"""Deterministic recommendations with evidence.

The three risk rules are evaluated in one pass over the risk table: every row yields an array
of at most three findings that is exploded, so the risk plan is computed once, not per rule.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.config import ADVICE, FORECAST, RULE_TEXTS, SEVERITIES, AdvicePolicy, ForecastPolicy
from faultline.functions.text import stable_key
from faultline.operators.forecast import is_recent

RISK_RULES = ("RISK_SCORE_HIGH", "KPI_VIOLATION_RATE_HIGH", "VOLUME_CONCENTRATION")


def finding(rule: str, kind: Column, target: Column, severity: Column, value: Column, evidence: Column) -> Column:
    return F.struct(
        F.lit(rule).alias("rule_id"),
        kind.alias("dimension_type"),
        target.alias("target"),
        severity.alias("severity"),
        evidence.alias("evidence"),
        value.cast("double").alias("metric_value"),
    )


def graded(value: Column, threshold: float, above: str, below: str) -> Column:
    return F.when(value >= threshold, F.lit(above)).otherwise(F.lit(below))


def with_texts(findings: DataFrame, policy: AdvicePolicy) -> DataFrame:
    """Findings completed with the texts of their rule and a stable identifier."""

    def text(part: str) -> Column:
        rules = list(RULE_TEXTS.items())
        ladder = F.when(F.col("rule_id") == rules[0][0], F.lit(rules[0][1][part]))
        for rule, texts in rules[1:]:
            ladder = ladder.when(F.col("rule_id") == rule, F.lit(texts[part]))
        return ladder

    target = F.coalesce(F.col("target"), F.lit("UNKNOWN"))
    key = stable_key("REC-", F.col("rule_id"), F.col("dimension_type"), target)
    return findings.select(
        key.alias("recommendation_id"),
        F.lit(policy.version).alias("rules_version"),
        "rule_id",
        text("type").alias("recommendation_type"),
        "dimension_type",
        "target",
        "severity",
        text("title").alias("title"),
        text("advice").alias("recommendation"),
        "evidence",
        text("metric").alias("metric_name"),
        "metric_value",
        text("unit").alias("metric_unit"),
    )


def from_risk(risk: DataFrame, rules: Iterable[str] = RISK_RULES, policy: AdvicePolicy = ADVICE) -> DataFrame:
    known = ~F.col("is_unknown")
    kind, value = F.col("dimension_type"), F.col("dimension_value")
    score, rate, volume = F.col("risk_score"), F.col("kpi_violation_rate_pct"), F.col("volume")
    evaluated = F.col("evaluated_kpi_incidents")

    rate_candidate = known & (evaluated >= policy.rate_min_evaluated) & (rate >= policy.rate_high)
    volume_candidate = known & kind.isin(*policy.volume_dimensions) & (volume >= policy.volume_min)

    # Only rows that may become a finding are kept before they are ranked.
    high = known & (F.col("rank") <= policy.risk_top) & (score >= policy.risk_high)
    flags = {"_high": high, "_rate": rate_candidate, "_volume": volume_candidate}
    candidates = risk.withColumns({name: F.coalesce(flag, F.lit(False)) for name, flag in flags.items()}).filter(
        "_high OR _rate OR _volume"
    )

    def place(flag: str, *order: Column) -> Column:
        """Position among the candidates of the same dimension."""
        return F.row_number().over(Window.partitionBy("dimension_type", flag).orderBy(*order))

    ranked = candidates.withColumns(
        {
            "_rate_place": place("_rate", rate.desc(), evaluated.desc(), value.asc()),
            "_volume_place": place("_volume", volume.desc(), value.asc()),
        }
    )
    findings = {
        "RISK_SCORE_HIGH": F.when(
            F.col("_high"),
            finding(
                "RISK_SCORE_HIGH", kind, value,
                graded(score, policy.risk_critical, "CRITICAL", "HIGH"),
                score,
                F.concat(
                    F.lit("Posição "), F.col("rank").cast("string"), F.lit(" no ranking de "), kind,
                    F.lit(", com score de risco "), F.format_number(score, 2), F.lit("."),
                ),
            ),
        ),
        "KPI_VIOLATION_RATE_HIGH": F.when(
            F.col("_rate") & (F.col("_rate_place") <= policy.rate_top),
            finding(
                "KPI_VIOLATION_RATE_HIGH", kind, value,
                graded(rate, policy.rate_critical, "CRITICAL", "HIGH"),
                rate,
                F.concat(
                    F.lit("Taxa calculada de violação de "), F.format_number(rate, 2), F.lit("% em "),
                    evaluated.cast("string"), F.lit(" incidentes avaliados."),
                ),
            ),
        ),
        "VOLUME_CONCENTRATION": F.when(
            F.col("_volume") & (F.col("_volume_place") == 1),
            finding(
                "VOLUME_CONCENTRATION", kind, value, F.lit("MEDIUM"), volume,
                F.concat(F.lit("Maior volume da dimensão, com "), volume.cast("string"), F.lit(" incidentes.")),
            ),
        ),
    }
    chosen = F.array_compact(F.array(*(findings[rule] for rule in rules)))
    return ranked.select(F.inline(chosen)).transform(with_texts, policy)


def from_targets(annual: DataFrame, policy: AdvicePolicy = ADVICE) -> DataFrame:
    compliance = F.col("calculated_compliance_pct")
    # concat_ws skips a missing priority name, leaving the year alone.
    target = F.concat_ws(" | ", F.col("opened_year").cast("string"), "priority_name")
    row = finding(
        "ANNUAL_COMPLIANCE_LOW",
        F.lit("annual_priority"),
        target,
        graded(compliance, policy.compliance_critical, "HIGH", "CRITICAL"),
        compliance,
        F.concat(F.lit("Compliance calculado de "), F.format_number(compliance, 2), F.lit("% no ano.")),
    )
    low = annual.filter(compliance < policy.compliance_low)
    return low.select(F.inline(F.array(row))).transform(with_texts, policy)


def from_forecast(
    forecast: DataFrame,
    history: DataFrame,
    policy: AdvicePolicy = ADVICE,
    horizon: ForecastPolicy = FORECAST,
) -> DataFrame:
    """Growth of the next seven days against the last seven; one row at most."""
    recent_volume = history.filter(is_recent(horizon)).agg(F.sum("actual_incidents").alias("n")).scalar()
    first_day = forecast.filter(F.col("horizon_day") == 1).select(
        F.col("forecast_d7").alias("expected"), recent_volume.alias("recent")
    )
    change = F.round((F.col("expected") - F.col("recent")) / F.col("recent") * 100, 2)
    growing = first_day.withColumn("growth", F.when(F.col("recent") > 0, change)).filter(
        F.col("growth") >= policy.growth_medium
    )
    growth = F.col("growth")
    row = finding(
        "FORECAST_D7_GROWTH",
        F.lit("forecast"),
        F.lit("next_7_days"),
        graded(growth, policy.growth_high, "HIGH", "MEDIUM"),
        growth,
        F.concat(
            F.lit("Previsão D+7 de "), F.col("expected").cast("string"), F.lit(" incidentes, "),
            F.format_number(growth, 2), F.lit("% acima dos sete dias recentes."),
        ),
    )
    return growing.select(F.inline(F.array(row))).transform(with_texts, policy)


def severity_rank() -> Column:
    position = F.array_position(F.lit(list(SEVERITIES[:3])), F.col("severity"))
    return F.when(position > 0, position).otherwise(len(SEVERITIES))


def recommendations(
    risk: DataFrame,
    annual: DataFrame,
    forecast: DataFrame,
    history: DataFrame,
    policy: AdvicePolicy = ADVICE,
) -> DataFrame:
    parts = [
        from_risk(risk, policy=policy),
        from_targets(annual, policy),
        from_forecast(forecast, history, policy),
    ]
    return reduce(DataFrame.unionByName, parts).dropDuplicates(["recommendation_id"])


def recommendation_order() -> list[Column]:
    return [severity_rank().asc(), F.col("rule_id"), F.col("dimension_type"), F.col("target")]
