"""Daily panel to the model's feature table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shelf.operators.features import (
    attach_codes,
    date_features,
    drop_warm_up,
    expanding_mean,
    first_appearance_codes,
    lag_features,
    promo_features,
    rolling_features,
    segment_demand,
)
from shelf.operators.partitioning import by_series
from shelf.staging import stage


def build_features(panel: DataFrame, *, leak_free: bool = False) -> tuple[DataFrame, DataFrame]:
    """All features and the code table; pass a stored panel, it is read twice.

    The windows share one shuffle by series; the code lookups come last and keep
    the rows where they are as long as the code table is small.
    """
    windowed = (
        panel.transform(by_series)
        .transform(date_features)
        .transform(lag_features)
        .transform(rolling_features)
        .transform(expanding_mean, leak_free=leak_free)
        .transform(promo_features)
        .transform(segment_demand)
        .transform(drop_warm_up)
    )
    # Codes follow the whole panel, before warm-up rows are dropped.
    codes = stage(first_appearance_codes(panel), "codes")
    return attach_codes(windowed, codes, ("store", "category", "product")), codes
