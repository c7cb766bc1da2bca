"""Business constants of the engine, grouped in frozen policies.

Every operator takes its policy as an argument, so a deployment can change a limit
without touching the code.  The defaults below are fixed values: they decide results
(limits, weights, texts, identifiers) and are stated plainly.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --------------------------------------------------------------------------- fixed values
# Service-level limits in seconds per priority code.
SLA_LIMIT_SECONDS = {1: 14_400, 2: 14_400, 3: 43_200, 4: 86_400, 5: 345_600}

# Character map used to compare status texts without accents (upper case only).
ACCENTS_FROM = "ÁÀÃÂÄÉÈÊËÍÌÎÏÓÒÕÔÖÚÙÛÜÇ"
ACCENTS_TO = "AAAAAEEEEIIIIOOOOOUUUUC"

# Upper limits of the annual target bands; the first bound is exclusive, the rest inclusive.
TARGET_POINTS = (150, 125, 100, 75, 50)
VIOLATION_BANDS = {2: (31, 35, 39, 45, 53), 3: (201, 230, 263, 290, 320)}
VOLUME_BANDS = {2: (4585, 5388, 6168, 6252, 6336), 3: (19489, 22116, 22524, 23892, 24276)}

# Texts of the recommendation rules.
RULE_TEXTS = {
    "RISK_SCORE_HIGH": {
        "type": "RISK_MITIGATION",
        "title": "Investigar dimensão com risco elevado",
        "advice": (
            "Revisar causas recorrentes, capacidade operacional "
            "e ações preventivas para reduzir o risco."
        ),
        "metric": "risk_score",
        "unit": "score",
    },
    "KPI_VIOLATION_RATE_HIGH": {
        "type": "KPI_COMPLIANCE",
        "title": "Reduzir violações de KPI",
        "advice": (
            "Analisar os incidentes violados, identificar causas "
            "comuns e definir um plano de correção."
        ),
        "metric": "kpi_violation_rate_pct",
        "unit": "percent",
    },
    "VOLUME_CONCENTRATION": {
        "type": "CAPACITY_REVIEW",
        "title": "Avaliar concentração de volume",
        "advice": (
            "Revisar capacidade, distribuição da demanda e "
            "oportunidades de automação preventiva."
        ),
        "metric": "volume",
        "unit": "incidents",
    },
    "ANNUAL_COMPLIANCE_LOW": {
        "type": "OLA_COMPLIANCE",
        "title": "Recuperar compliance anual de OLA",
        "advice": (
            "Priorizar análise das violações e acompanhar um plano "
            "de recuperação para a prioridade."
        ),
        "metric": "calculated_compliance_pct",
        "unit": "percent",
    },
    "FORECAST_D7_GROWTH": {
        "type": "FORECAST_CAPACITY",
        "title": "Preparar capacidade para aumento previsto",
        "advice": (
            "Revisar escala e capacidade operacional para os "
            "próximos sete dias."
        ),
        "metric": "forecast_growth_pct",
        "unit": "percent",
    },
}

MONTH_NAMES = (
    "Janeiro", "Fevereiro", "Março", "Abril", "Maio", "Junho",
    "Julho", "Agosto", "Setembro", "Outubro", "Novembro", "Dezembro",
)

SEVERITIES = ("CRITICAL", "HIGH", "MEDIUM", "LOW")
# ----------------------------------------------------------------------------------------


@dataclass(frozen=True)
class SlaPolicy:
    version: str = "1.0"
    limits: dict[int, int] = field(default_factory=lambda: dict(SLA_LIMIT_SECONDS))
    eligible_priorities: tuple[int, ...] = (1, 2, 3)
    excluded_status: str = "SEM INTERVENCAO"
    incident_id: str = r"^INC\d{7}$"


@dataclass(frozen=True)
class TargetPolicy:
    priorities: tuple[int, ...] = (2, 3)
    points: tuple[int, ...] = TARGET_POINTS
    violation_bands: dict[int, tuple[int, ...]] = field(default_factory=lambda: dict(VIOLATION_BANDS))
    volume_bands: dict[int, tuple[int, ...]] = field(default_factory=lambda: dict(VOLUME_BANDS))


@dataclass(frozen=True)
class RiskPolicy:
    name: str = "weighted_operational_risk"
    version: str = "1.0"
    volume_weight: float = 0.45
    rate_weight: float = 0.35
    duration_weight: float = 0.20


@dataclass(frozen=True)
class ForecastPolicy:
    method: str = "weighted_explainable_baseline"
    version: str = "1.0"
    history_days: int = 28
    recent_days: int = 7
    horizon_days: int = 7
    weekday_weight: float = 0.60
    recent_weight: float = 0.40
    priorities: tuple[int, ...] = (1, 2, 3)
    scope: str = "Incidentes válidos P1, P2 e P3 consolidados"

    @property
    def scope_codes(self) -> str:
        return ",".join(str(code) for code in self.priorities)


@dataclass(frozen=True)
class AdvicePolicy:
    version: str = "1.0"
    risk_top: int = 3
    risk_high: float = 50.0
    risk_critical: float = 75.0
    rate_high: float = 20.0
    rate_critical: float = 50.0
    rate_min_evaluated: int = 5
    rate_top: int = 3
    volume_min: int = 1000
    volume_dimensions: tuple[str, ...] = ("product", "category", "assigned_group")
    compliance_low: float = 90.0
    compliance_critical: float = 75.0
    growth_medium: float = 10.0
    growth_high: float = 25.0


SLA = SlaPolicy()
TARGETS = TargetPolicy()
RISK = RiskPolicy()
FORECAST = ForecastPolicy()
ADVICE = AdvicePolicy()
