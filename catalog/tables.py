"""Tables the queries start from, derived from the star-schema files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelf.operators.features import last_rows
from shelf.operators.forecast import Model, boosted_trees, random_forest, time_split
from shelf.operators.inventory import recommendations
from shelf.plans.features import build_features
from shelf.plans.forecast import BOOSTED, FOREST, fit_models
from shelf.plans.preprocess import daily_panel
from shelf.schema import SERIES
from shelf.sources.retail import SEQ, retail_sales
from shelf.staging import stage

_stored: dict[tuple[str, str, str], DataFrame] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """Write a table on first use in a session, then read it back.

    The star-schema files stand in for a stored sales table, so the sales rows
    are joined together once and not again for every report and every pass.
    """
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _stored:
        _stored[key] = stage(build(), name)
    return _stored[key]


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw sales table: one row per order line."""
    return _once(spark, sf_dir, "raw", lambda: retail_sales(spark, sf_dir))


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The processed table: one row per series and day."""
    return _once(
        spark, sf_dir, "panel", lambda: daily_panel(raw(spark, sf_dir), order_by=SEQ)
    )


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(
        spark, sf_dir, "features", lambda: build_features(panel(spark, sf_dir))[0]
    )


def recent_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forecast that SQL can repeat: each series continues its mean of the last 30 days."""
    recent = last_rows(panel(spark, sf_dir), 30)
    return recent.groupBy(*SERIES).agg(F.avg("actual_sales").alias("forecast_qty"))


def stock_table(spark: SparkSession, sf_dir: str, **settings) -> DataFrame:
    return recommendations(panel(spark, sf_dir), recent_forecast(spark, sf_dir), **settings)


_fitted: dict[tuple[str, str, str], Model] = {}


def model(spark: SparkSession, sf_dir: str, name: str) -> Model:
    """A tree model, fitted at full size on the training rows once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _fitted:
        train, _ = time_split(features(spark, sf_dir))
        _fitted[key] = {FOREST: random_forest, BOOSTED: boosted_trees}[name](train)
    return _fitted[key]


def models(spark: SparkSession, sf_dir: str) -> dict[str, Model]:
    """Both tree models; those not fitted yet are fitted side by side."""
    keys = {name: (spark.sparkContext.applicationId, sf_dir, name) for name in (FOREST, BOOSTED)}
    if not any(key in _fitted for key in keys.values()):
        train, _ = time_split(features(spark, sf_dir))
        _fitted.update({keys[name]: fitted for name, fitted in fit_models(train).items()})
    return {name: model(spark, sf_dir, name) for name in keys}
