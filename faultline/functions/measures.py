"""Aggregate and ratio helpers shared by all tables."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def share_pct(part: Column, whole: Column) -> Column:
    """part / whole in percent with two decimals; null when whole is zero or null."""
    return F.when(whole > 0, F.round(part / whole * 100, 2))


def nearest_rank_95(size: Column) -> Column:
    """One-based rank of the 95th percentile among ``size`` values, in whole numbers."""
    upper = size * 95 + 99
    return ((upper - upper % 100) / 100).cast("bigint")


def finite_or_null(col: Column) -> Column:
    """JSON-safe number: NaN and infinities become null."""
    return F.when(~F.isnan(col) & (F.abs(col) != float("inf")), col)
