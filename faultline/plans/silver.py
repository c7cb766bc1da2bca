"""Raw rows -> audited, typed Silver records."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.config import SLA, SlaPolicy
from faultline.functions.text import blank_to_null
from faultline.operators.clean import rename_source, strip_blanks, type_columns
from faultline.operators.quality import add_quality, latest_versions
from faultline.operators.sla import audit_sla


def silver_records(raw: DataFrame, policy: SlaPolicy = SLA) -> DataFrame:
    """rename -> clean -> type -> service-level audit -> quality, one row out per row in."""
    return (
        raw.transform(rename_source)
        .transform(strip_blanks)
        .transform(type_columns)
        .transform(audit_sla, policy)
        .transform(add_quality, policy)
    )


def current_records(
    raw: DataFrame,
    tiebreak: Sequence[str] = (),
    policy: SlaPolicy = SLA,
    described: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Newest version of every incident, valid or not.

    The choice comes before the validity split: a newer invalid version replaces an older
    valid one.  It needs the id and the closing time only, so superseded versions are never
    typed and the rows that are sorted and shuffled are the raw ones.  ``described`` makes the raw
    rows out of the chosen ones, one for each, where joins add columns that the choice does not need.
    """
    named = rename_source(raw)
    closed = F.try_to_timestamp(blank_to_null(F.col("closed_at")))
    newest = latest_versions(named, tiebreak, blank_to_null(F.col("incident_id")), closed)
    return silver_records(newest if described is None else described(newest), policy)
