"""Results published for the real data set, reproduced from their published inputs."""

from __future__ import annotations

import datetime as dt

import pytest

from faultline.operators import forecast, recommend
from tests.test_gold import RISK_TABLE

# Published daily counts up to 2025-12-31 and the forecast made from them.
COUNTS = (
    233, 299, 152, 165, 244, 301, 251, 162, 186, 265, 227, 453, 410, 289, 401, 392, 403, 466, 805, 648, 551, 399, 454,
    555, 437, 572, 497, 387,
)
PREDICTED = (368, 388, 395, 383, 500, 467, 410)
RISK_RANGE, DAY_1, WEEK = 156, 368, 2911


def test_published_forecast(spark):
    start, end = dt.date(2025, 12, 4), dt.date(2025, 12, 31)
    days = [start + dt.timedelta(days=n) for n in range(28)]
    rows = [(day, start, end, count, day.isoweekday() % 7 + 1) for day, count in zip(days, COUNTS)]
    history = spark.createDataFrame(
        rows, "date date, history_start_date date, history_end_date date, actual_incidents bigint, day_of_week int"
    )
    out = forecast.forecast_summary(history).orderBy("horizon_day").collect()
    assert tuple(r.predicted_incidents for r in out) == PREDICTED
    assert {(r.risk_range, r.forecast_d1, r.forecast_d7) for r in out} == {(RISK_RANGE, DAY_1, WEEK)}
    assert (out[0].lower_bound, out[0].upper_bound) == (212, 524)


@pytest.mark.parametrize(
    "kind,target,rate,evaluated,key",
    [
        ("category", "cat41", 95.29, 531, "REC-0A3BF0B011C5"),
        ("product", "lcsi", 55.92, 1064, "REC-404FF971F609"),
        ("category", "cat59", 100.0, 10, "REC-421F945DF2E3"),
    ],
)
def test_published_identifiers(spark, kind, target, rate, evaluated, key):
    risk = spark.createDataFrame([(kind, target, False, 9, evaluated, 9, rate, 1.0, 1.0, 9)], RISK_TABLE)
    row = recommend.from_risk(risk).first()
    assert row.recommendation_id == key and row.severity == "CRITICAL"
    assert row.evidence == f"Taxa calculada de violação de {rate:.2f}% em {evaluated} incidentes avaliados."
