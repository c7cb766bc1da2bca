"""Shared SQL views of the oracle, written independently of the Spark operators.

``with_ctes`` prefixes a statement with just the views it refers to.  Rounding goes through
the decimal reading of the double (half up), which is how Spark rounds doubles.
"""

from __future__ import annotations

import re

from faultline.config import RULE_TEXTS


def rounded(expr: str, digits: int = 2) -> str:
    return f"CAST(round(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38, 16)), {digits}) AS DOUBLE)"


def pct(part: str, whole: str) -> str:
    ratio = f"CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE) * 100"
    return f"CASE WHEN {whole} > 0 THEN {rounded(ratio)} END"


def count_if(condition: str) -> str:
    return f"CAST(count(*) FILTER (WHERE {condition}) AS BIGINT)"


MEAN = rounded("CAST(sum(duration_seconds) AS DOUBLE) / count(duration_seconds)")
P95 = "CAST(quantile_disc(duration_seconds, 0.95) AS BIGINT)"


def points(value: str, bounds: tuple[int, ...]) -> str:
    scores = (150, 125, 100, 75, 50)
    ladder = f"WHEN {value} < {bounds[0]} THEN {scores[0]} "
    ladder += " ".join(f"WHEN {value} <= {b} THEN {s}" for b, s in zip(bounds[1:], scores[1:]))
    return f"CASE {ladder} ELSE 0 END"


def text_of(part: str) -> str:
    cases = " ".join(f"WHEN '{rule}' THEN '{texts[part]}'" for rule, texts in RULE_TEXTS.items())
    return f"CASE rule_id {cases} END"


ACCENTS = ("ÁÀÃÂÄÉÈÊËÍÌÎÏÓÒÕÔÖÚÙÛÜÇ", "AAAAAEEEEIIIIOOOOOUUUUC")
FOLDED = "regexp_replace(translate(upper(trim(status)), '{}', '{}'), '\\s+', ' ', 'g')".format(*ACCENTS)

SILVER_TEXT = (
    "incident_id", "priority", "product", "category", "subcategory", "assigned_group",
    "configuration_item", "opened_at", "resolved_at", "closed_at", "duration_seconds", "close_code",
    "short_description", "solution", "opened_by", "parent_incident_id", "status", "entered_kpi",
    "kpi_violated",
)

VIEWS: dict[str, str] = {}

VIEWS["v_raw"] = """
    SELECT printf('INC%07d', o_orderkey) AS incident_id,
           o_orderpriority AS priority,
           CASE WHEN l_linenumber = 2 THEN '  ' || p_brand || ' ' ELSE p_brand END AS product,
           p_type AS category,
           CASE WHEN l_linenumber = 3 THEN '  ' ELSE CAST(p_size AS VARCHAR) END AS subcategory,
           CASE WHEN l_suppkey % 97 <> 0 THEN n_name END AS assigned_group,
           s_name AS configuration_item,
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS opened_at,
           strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS resolved_at,
           strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS closed_at,
           CAST(CAST(floor(l_extendedprice / 2) AS BIGINT) AS VARCHAR) AS duration_seconds,
           l_returnflag AS close_code,
           p_name AS short_description,
           '' AS solution,
           CASE WHEN l_linestatus = 'O' THEN 'Monitoramento' ELSE 'Manual' END AS opened_by,
           CASE WHEN l_linenumber = 7 THEN 'INC0000000' END AS parent_incident_id,
           CASE WHEN o_orderstatus = 'P' THEN 'Sem Intervenção' ELSE 'Encerrado' END AS status,
           CASE l_returnflag WHEN 'R' THEN 'SIM' WHEN 'N' THEN 'NAO' ELSE 'N/A' END AS entered_kpi,
           CASE WHEN l_discount >= 0.08 THEN 'sim' WHEN l_discount >= 0.02 THEN 'Nao' ELSE 'N/A' END AS kpi_violated,
           strftime(l_shipdate, '%Y_%m') AS batch_id,
           l_linenumber, l_partkey, l_suppkey, l_extendedprice
    FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey
    LEFT JOIN part ON l_partkey = p_partkey
    LEFT JOIN supplier ON l_suppkey = s_suppkey
    LEFT JOIN nation ON s_nationkey = n_nationkey
"""

VIEWS["v_clean"] = (
    "SELECT "
    + ", ".join(f"nullif(trim({name}), '') AS {name}" for name in SILVER_TEXT)
    + ", batch_id, l_linenumber, l_partkey, l_suppkey, l_extendedprice FROM v_raw"
)

VIEWS["v_typed"] = """
    SELECT incident_id, priority, product, category, subcategory, assigned_group, configuration_item,
           CAST(opened_at AS TIMESTAMP) AS opened_at,
           CAST(resolved_at AS TIMESTAMP) AS resolved_at,
           CAST(closed_at AS TIMESTAMP) AS closed_at,
           CAST(trunc(TRY_CAST(duration_seconds AS DOUBLE)) AS BIGINT) AS duration_seconds,
           close_code, short_description, solution, opened_by, parent_incident_id, status,
           CASE upper(entered_kpi) WHEN 'SIM' THEN true WHEN 'NAO' THEN false END AS entered_kpi,
           CASE upper(kpi_violated) WHEN 'SIM' THEN true WHEN 'NAO' THEN false END AS kpi_violated,
           TRY_CAST(regexp_extract(priority, '^(\\d+)', 1) AS INTEGER) AS priority_code,
           trim(regexp_replace(priority, '^\\d+\\s*-\\s*', '')) AS priority_name,
           CAST(year(CAST(opened_at AS TIMESTAMP)) AS INTEGER) AS opened_year,
           CAST(month(CAST(opened_at AS TIMESTAMP)) AS INTEGER) AS opened_month,
           batch_id, l_linenumber, l_partkey, l_suppkey, l_extendedprice
    FROM v_clean
"""

VIEWS["v_eligible"] = f"""
    SELECT *, '1.0' AS kpi_rule_version,
           CAST(CASE priority_code WHEN 1 THEN 14400 WHEN 2 THEN 14400 WHEN 3 THEN 43200
                                   WHEN 4 THEN 86400 WHEN 5 THEN 345600 END AS BIGINT) AS kpi_limit_seconds,
           CASE WHEN priority_code IS NULL OR priority_code NOT BETWEEN 1 AND 5 THEN NULL
                WHEN priority_code IN (4, 5) THEN false
                WHEN trim(coalesce(parent_incident_id, '')) <> '' THEN false
                WHEN {FOLDED} = 'SEM INTERVENCAO' THEN false
                ELSE true END AS kpi_eligible_by_rule,
           CASE WHEN priority_code IS NULL OR priority_code NOT BETWEEN 1 AND 5 THEN 'invalid_priority'
                WHEN priority_code IN (4, 5) THEN 'priority_not_eligible'
                WHEN trim(coalesce(parent_incident_id, '')) <> '' THEN 'parent_incident'
                WHEN {FOLDED} = 'SEM INTERVENCAO' THEN 'status_without_intervention'
                WHEN duration_seconds IS NULL THEN 'missing_duration'
                ELSE 'eligible' END AS kpi_rule_reason
    FROM v_typed
"""

VIEWS["v_violated"] = """
    SELECT *, CASE WHEN kpi_eligible_by_rule AND duration_seconds >= 0
                   THEN duration_seconds > kpi_limit_seconds END AS kpi_violated_by_rule
    FROM v_eligible
"""

VIEWS["v_silver"] = """
    SELECT *, CASE WHEN length(dq_issues) = 0 THEN 'VALID' ELSE 'INVALID' END AS dq_status
    FROM (
        SELECT *,
               kpi_eligible_by_rule = entered_kpi AS entered_kpi_rule_matches_source,
               kpi_violated_by_rule = kpi_violated AS kpi_violated_rule_matches_source,
               concat_ws('|',
                   CASE WHEN incident_id IS NULL THEN 'missing_incident_id' END,
                   CASE WHEN NOT regexp_full_match(incident_id, 'INC\\d{7}') THEN 'invalid_incident_id' END,
                   CASE WHEN priority_code NOT BETWEEN 1 AND 5 OR (priority IS NOT NULL AND priority_code IS NULL)
                        THEN 'invalid_priority' END,
                   CASE WHEN assigned_group IS NULL THEN 'missing_assigned_group' END,
                   CASE WHEN opened_at IS NULL THEN 'invalid_opened_at' END,
                   CASE WHEN closed_at IS NULL THEN 'invalid_closed_at' END,
                   CASE WHEN duration_seconds IS NULL THEN 'invalid_duration' END,
                   CASE WHEN duration_seconds < 0 THEN 'negative_duration' END,
                   CASE WHEN closed_at < opened_at THEN 'closed_before_opened' END) AS dq_issues
        FROM v_violated
    )
"""

VERSION_ORDER = (
    "closed_at DESC NULLS LAST, l_linenumber DESC NULLS LAST, l_partkey DESC NULLS LAST, "
    "l_suppkey DESC NULLS LAST, l_extendedprice DESC NULLS LAST"
)
VIEWS["v_latest"] = f"""
    SELECT * FROM v_silver
    QUALIFY row_number() OVER (PARTITION BY incident_id ORDER BY {VERSION_ORDER}) = 1
"""
VIEWS["v_valid"] = "SELECT * FROM v_latest WHERE dq_status = 'VALID'"

COMPLIANCE = pct("(kpi_incidents - kpi_violations)", "kpi_incidents")
SOURCE = f"{count_if('entered_kpi')} AS kpi_incidents, {count_if('kpi_violated')} AS kpi_violations"
OPENED_BY = (
    f"""{count_if("opened_by = 'Monitoramento'")} AS monitoring_incidents, """
    f"""{count_if("opened_by = 'Manual'")} AS manual_incidents"""
)
EVALUATED = count_if("kpi_eligible_by_rule AND kpi_violated_by_rule IS NOT NULL")

VIEWS["v_monthly"] = f"""
    SELECT *, {COMPLIANCE} AS kpi_compliance_pct FROM (
        SELECT opened_year, opened_month, count(*) AS total_incidents, {OPENED_BY}, {SOURCE},
               {MEAN} AS avg_duration_seconds, {P95} AS p95_duration_seconds
        FROM v_valid GROUP BY ALL)
"""
VIEWS["v_priority"] = f"""
    SELECT *, {COMPLIANCE} AS kpi_compliance_pct FROM (
        SELECT priority_code, priority_name, count(*) AS total_incidents, {SOURCE},
               {MEAN} AS avg_duration_seconds, {P95} AS p95_duration_seconds
        FROM v_valid GROUP BY ALL)
"""
VIEWS["v_team"] = f"""
    SELECT *, {COMPLIANCE} AS kpi_compliance_pct FROM (
        SELECT assigned_group, count(*) AS total_incidents, {SOURCE}, {MEAN} AS avg_duration_seconds
        FROM v_valid GROUP BY ALL)
"""
VIEWS["v_dashboard"] = f"""
    SELECT opened_year, opened_month, priority_code, priority_name, assigned_group,
           count(*) AS total_incidents, {SOURCE}, {OPENED_BY}
    FROM v_valid GROUP BY ALL
"""
VIEWS["v_operational"] = f"""
    SELECT *, {pct("calculated_kpi_compliant", "evaluated_kpi_incidents")} AS calculated_compliance_pct,
           {pct("eligibility_mismatches", "eligibility_comparisons")} AS eligibility_mismatch_pct,
           {pct("violation_mismatches", "violation_comparisons")} AS violation_mismatch_pct
    FROM (
        SELECT opened_year, opened_month, priority_code, priority_name, assigned_group,
               count(*) AS total_incidents,
               {count_if("entered_kpi")} AS source_kpi_incidents,
               {count_if("kpi_violated")} AS source_kpi_violations,
               {count_if("kpi_eligible_by_rule")} AS calculated_kpi_incidents,
               {EVALUATED} AS evaluated_kpi_incidents,
               {count_if("kpi_violated_by_rule")} AS calculated_kpi_violations,
               {count_if("NOT kpi_violated_by_rule")} AS calculated_kpi_compliant,
               {count_if("kpi_eligible_by_rule AND kpi_violated_by_rule IS NULL")} AS not_evaluable_kpi_incidents,
               {count_if("entered_kpi_rule_matches_source IS NOT NULL")} AS eligibility_comparisons,
               {count_if("NOT entered_kpi_rule_matches_source")} AS eligibility_mismatches,
               {count_if("kpi_violated_rule_matches_source IS NOT NULL")} AS violation_comparisons,
               {count_if("NOT kpi_violated_rule_matches_source")} AS violation_mismatches,
               {MEAN} AS avg_duration_seconds, {P95} AS p95_duration_seconds
        FROM v_valid GROUP BY ALL)
"""
VIEWS["v_trends"] = f"""
    SELECT *, {pct("kpi_compliant", "evaluated_kpi_incidents")} AS kpi_compliance_pct FROM (
        SELECT CAST(opened_at AS DATE) AS date, priority_code, priority_name, product, category, assigned_group,
               count(*) AS total_incidents, {count_if("kpi_eligible_by_rule")} AS kpi_incidents,
               {EVALUATED} AS evaluated_kpi_incidents, {count_if("kpi_violated_by_rule")} AS kpi_violations,
               {count_if("NOT kpi_violated_by_rule")} AS kpi_compliant,
               {MEAN} AS avg_duration_seconds, {P95} AS p95_duration_seconds
        FROM v_valid GROUP BY ALL)
"""
VIEWS["v_annual"] = f"""
    SELECT opened_year, priority_code, priority_name, treated_volume, calculated_kpi_incidents,
           evaluated_kpi_incidents, calculated_kpi_violations, calculated_kpi_compliant,
           {pct("calculated_kpi_compliant", "evaluated_kpi_incidents")} AS calculated_compliance_pct,
           CAST(CASE priority_code
                WHEN 2 THEN {points("calculated_kpi_violations", (31, 35, 39, 45, 53))}
                WHEN 3 THEN {points("calculated_kpi_violations", (201, 230, 263, 290, 320))} END AS INTEGER)
                AS violation_target_attainment_pct,
           CAST(CASE priority_code
                WHEN 2 THEN {points("treated_volume", (4585, 5388, 6168, 6252, 6336))}
                WHEN 3 THEN {points("treated_volume", (19489, 22116, 22524, 23892, 24276))} END AS INTEGER)
                AS volume_target_attainment_pct
    FROM (
        SELECT opened_year, priority_code, priority_name, count(*) AS treated_volume,
               {count_if("kpi_eligible_by_rule")} AS calculated_kpi_incidents,
               {EVALUATED} AS evaluated_kpi_incidents,
               {count_if("kpi_violated_by_rule")} AS calculated_kpi_violations,
               {count_if("NOT kpi_violated_by_rule")} AS calculated_kpi_compliant
        FROM v_valid WHERE priority_code IN (2, 3) GROUP BY ALL)
"""


def risk_branch(kind: str, column: str) -> str:
    value = f"nullif(trim({column}), '')"
    return f"""
        SELECT '{kind}' AS dimension_type, {value} AS dimension_value, {value} IS NULL AS is_unknown,
               count(*) AS volume, {EVALUATED} AS evaluated_kpi_incidents,
               {count_if("kpi_violated_by_rule")} AS kpi_violations, {MEAN} AS avg_duration_seconds
        FROM v_valid GROUP BY ALL"""


VIEWS["v_risk_base"] = (
    f"SELECT *, {pct('kpi_violations', 'evaluated_kpi_incidents')} AS kpi_violation_rate_pct FROM ("
    + " UNION ALL ".join(
        risk_branch(kind, column)
        for kind, column in (
            ("priority", "priority_name"), ("product", "product"),
            ("category", "category"), ("assigned_group", "assigned_group"),
        )
    )
    + ")"
)


def normalized(value: str) -> str:
    top = f"max({value}) FILTER (WHERE NOT is_unknown) OVER (PARTITION BY dimension_type)"
    share = f"least(CAST(coalesce({value}, 0) AS DOUBLE) / CAST({top} AS DOUBLE), 1.0)"
    return f"CASE WHEN {top} > 0 THEN {rounded(share, 4)} ELSE 0.0 END"


VIEWS["v_risk_scaled"] = f"""
    SELECT *, {normalized("volume")} AS volume_normalized,
           {normalized("kpi_violation_rate_pct")} AS violation_rate_normalized,
           {normalized("avg_duration_seconds")} AS avg_duration_normalized
    FROM v_risk_base
"""
SCORE = (
    "(CAST(0.45 AS DOUBLE) * volume_normalized + CAST(0.35 AS DOUBLE) * violation_rate_normalized "
    "+ CAST(0.2 AS DOUBLE) * avg_duration_normalized) * 100"
)
VIEWS["v_risk_scored"] = f"SELECT *, {rounded(SCORE)} AS risk_score FROM v_risk_scaled"
VIEWS["v_risk"] = """
    SELECT *, CASE WHEN NOT is_unknown THEN CAST(row_number() OVER (
               PARTITION BY dimension_type
               ORDER BY is_unknown, risk_score DESC, volume DESC, dimension_value) AS INTEGER) END AS rank
    FROM v_risk_scored
"""

VIEWS["v_scope"] = "SELECT CAST(opened_at AS DATE) AS d FROM v_valid WHERE priority_code IN (1, 2, 3)"
VIEWS["v_history"] = """
    SELECT CAST(c.day AS DATE) AS date, b.history_start_date, b.history_end_date,
           (SELECT count(*) FROM v_scope s WHERE s.d = CAST(c.day AS DATE)) AS actual_incidents,
           CAST(dayofweek(c.day) + 1 AS INTEGER) AS day_of_week, CAST(28 AS INTEGER) AS history_days,
           'Incidentes válidos P1, P2 e P3 consolidados' AS scope_description, '1,2,3' AS scope_priority_codes
    FROM (SELECT CAST(max(d) - INTERVAL 27 DAY AS DATE) AS history_start_date, max(d) AS history_end_date
          FROM v_scope) b,
         LATERAL (SELECT unnest(generate_series(
             CAST(b.history_start_date AS TIMESTAMP), CAST(b.history_end_date AS TIMESTAMP), INTERVAL 1 DAY)) AS day) c
"""
VIEWS["v_stats"] = """
    SELECT max(history_start_date) AS history_start_date, max(history_end_date) AS history_end_date,
           CAST(sum(actual_incidents) FILTER (WHERE date > history_end_date - INTERVAL 7 DAY) AS DOUBLE)
             / count(*) FILTER (WHERE date > history_end_date - INTERVAL 7 DAY) AS recent_average,
           stddev_pop(actual_incidents) AS history_stddev
    FROM v_history
"""
VIEWS["v_weekday"] = """
    SELECT day_of_week, CAST(sum(actual_incidents) AS DOUBLE) / count(*) AS same_weekday_average
    FROM v_history GROUP BY day_of_week
"""
PREDICTION = (
    "coalesce(same_weekday_average, recent_average, 0) * CAST(0.6 AS DOUBLE) "
    "+ coalesce(recent_average, 0) * CAST(0.4 AS DOUBLE)"
)
VIEWS["v_forecast"] = f"""
    SELECT forecast_date, horizon_day, predicted_incidents,
           greatest(predicted_incidents - risk_range, 0) AS lower_bound,
           predicted_incidents + risk_range AS upper_bound,
           max(predicted_incidents) FILTER (WHERE horizon_day = 1) OVER () AS forecast_d1,
           CAST(sum(predicted_incidents) OVER () AS BIGINT) AS forecast_d7,
           risk_range, history_start_date, history_end_date,
           'weighted_explainable_baseline' AS method, '1.0' AS method_version,
           CAST(28 AS INTEGER) AS history_days, CAST(7 AS INTEGER) AS recent_days,
           CAST(0.6 AS DOUBLE) AS same_weekday_weight, CAST(0.4 AS DOUBLE) AS recent_average_weight,
           'Incidentes válidos P1, P2 e P3 consolidados' AS scope_description, '1,2,3' AS scope_priority_codes
    FROM (
        SELECT CAST(s.history_end_date + h.n * INTERVAL 1 DAY AS DATE) AS forecast_date,
               CAST(h.n AS INTEGER) AS horizon_day,
               CAST(greatest({rounded(PREDICTION, 0)}, 0) AS BIGINT) AS predicted_incidents,
               CAST(greatest(round(coalesce(history_stddev, 0)), 0) AS BIGINT) AS risk_range,
               s.history_start_date, s.history_end_date
        FROM v_stats s
        JOIN (SELECT unnest(generate_series(1, 7)) AS n) h ON s.history_end_date IS NOT NULL
        LEFT JOIN v_weekday w ON w.day_of_week = dayofweek(s.history_end_date + h.n * INTERVAL 1 DAY) + 1
    )
"""

# One view per recommendation rule with the variable columns, one for the finished rows.
VIEWS["v_rec_score"] = """
    SELECT 'RISK_SCORE_HIGH' AS rule_id, dimension_type, dimension_value AS target,
           CASE WHEN risk_score >= 75 THEN 'CRITICAL' ELSE 'HIGH' END AS severity,
           'Posição ' || rank || ' no ranking de ' || dimension_type || ', com score de risco '
             || format('{:,.2f}', risk_score) || '.' AS evidence, risk_score AS metric_value
    FROM v_risk WHERE NOT is_unknown AND rank <= 3 AND risk_score >= 50
"""
VIEWS["v_rec_rate"] = """
    SELECT 'KPI_VIOLATION_RATE_HIGH' AS rule_id, dimension_type, dimension_value AS target,
           CASE WHEN kpi_violation_rate_pct >= 50 THEN 'CRITICAL' ELSE 'HIGH' END AS severity,
           'Taxa calculada de violação de ' || format('{:,.2f}', kpi_violation_rate_pct) || '% em '
             || evaluated_kpi_incidents || ' incidentes avaliados.' AS evidence,
           kpi_violation_rate_pct AS metric_value
    FROM v_risk
    WHERE NOT is_unknown AND evaluated_kpi_incidents >= 5 AND kpi_violation_rate_pct >= 20
    QUALIFY row_number() OVER (PARTITION BY dimension_type
        ORDER BY kpi_violation_rate_pct DESC, evaluated_kpi_incidents DESC, dimension_value) <= 3
"""
VIEWS["v_rec_volume"] = """
    SELECT 'VOLUME_CONCENTRATION' AS rule_id, dimension_type, dimension_value AS target, 'MEDIUM' AS severity,
           'Maior volume da dimensão, com ' || volume || ' incidentes.' AS evidence,
           CAST(volume AS DOUBLE) AS metric_value
    FROM v_risk
    WHERE NOT is_unknown AND dimension_type IN ('product', 'category', 'assigned_group') AND volume >= 1000
    QUALIFY row_number() OVER (PARTITION BY dimension_type ORDER BY volume DESC, dimension_value) = 1
"""
VIEWS["v_rec_compliance"] = """
    SELECT 'ANNUAL_COMPLIANCE_LOW' AS rule_id, 'annual_priority' AS dimension_type,
           concat_ws(' | ', CAST(opened_year AS VARCHAR), priority_name) AS target,
           CASE WHEN calculated_compliance_pct < 75 THEN 'CRITICAL' ELSE 'HIGH' END AS severity,
           'Compliance calculado de ' || format('{:,.2f}', calculated_compliance_pct) || '% no ano.' AS evidence,
           calculated_compliance_pct AS metric_value
    FROM v_annual WHERE calculated_compliance_pct < 90
"""
GROWTH = rounded("CAST(forecast_d7 - recent AS DOUBLE) / CAST(recent AS DOUBLE) * 100")
VIEWS["v_rec_growth"] = f"""
    SELECT 'FORECAST_D7_GROWTH' AS rule_id, 'forecast' AS dimension_type, 'next_7_days' AS target,
           CASE WHEN growth >= 25 THEN 'HIGH' ELSE 'MEDIUM' END AS severity,
           'Previsão D+7 de ' || forecast_d7 || ' incidentes, ' || format('{{:,.2f}}', growth)
             || '% acima dos sete dias recentes.' AS evidence, growth AS metric_value
    FROM (SELECT forecast_d7, CASE WHEN recent > 0 THEN {GROWTH} END AS growth
          FROM (SELECT max(forecast_d7) AS forecast_d7,
                       (SELECT CAST(sum(actual_incidents) AS BIGINT) FROM v_history
                        WHERE date > history_end_date - INTERVAL 7 DAY) AS recent
                FROM v_forecast WHERE horizon_day = 1))
    WHERE growth >= 10
"""


def finished(view: str) -> str:
    return f"""
    SELECT 'REC-' || upper(substr(sha256(rule_id || '|' || dimension_type || '|' || coalesce(target, 'UNKNOWN')), 1, 12))
             AS recommendation_id, '1.0' AS rules_version, rule_id, {text_of("type")} AS recommendation_type,
           dimension_type, target, severity, {text_of("title")} AS title, {text_of("advice")} AS recommendation,
           evidence, {text_of("metric")} AS metric_name, metric_value, {text_of("unit")} AS metric_unit
    FROM {view}"""


VIEWS["v_rec_all"] = " UNION ALL ".join(
    f"SELECT * FROM {view}"
    for view in ("v_rec_score", "v_rec_rate", "v_rec_volume", "v_rec_compliance", "v_rec_growth")
)
VIEWS["v_recommendations"] = finished("v_rec_all")


def needed_views(sql: str) -> list[str]:
    """Views a statement uses, each after the views it builds on."""
    found: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\bv_\w+\b", text):
            if name in VIEWS and name not in found:
                visit(VIEWS[name])
                if name not in found:
                    found.append(name)

    visit(sql)
    return found


def with_ctes(sql: str) -> str:
    names = needed_views(sql)
    if not names:
        return sql.strip()
    return "WITH " + ",\n".join(f"{name} AS ({VIEWS[name].strip()})" for name in names) + "\n" + sql.strip()
