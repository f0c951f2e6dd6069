"""Numeric column helpers."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F


def non_negative(value: Column) -> Column:
    """Negative values become zero; null stays null."""
    return F.when(value < 0, F.lit(0.0)).otherwise(value)


def clip(value: Column, low: Column, high: Column) -> Column:
    """``value`` moved into [low, high]; null stays null."""
    return F.when(value < low, low).when(value > high, high).otherwise(value)


def millions(value: Column) -> Column:
    return value / F.lit(1e6)


def percent(part: Column, whole: Column) -> Column:
    """``part`` as a percentage of ``whole``; null when ``whole`` is zero."""
    return F.try_divide(part, whole) * 100


def normal_quantile(service_level: float) -> float:
    """Standard normal quantile, e.g. 0.95 -> 1.645."""
    return NormalDist().inv_cdf(service_level)
