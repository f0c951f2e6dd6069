"""Feature table to model comparison, scored test rows and future forecast."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame

from shelf.operators import forecast as ops
from shelf.operators.measures import residual
from shelf.sources.io import save_model, write_table
from shelf.staging import stage

NAIVE, FOREST, BOOSTED = "Naive Baseline", "Random Forest", "Boosted Trees"


@dataclass(frozen=True)
class ForecastResult:
    comparison: DataFrame
    test_predictions: DataFrame
    forecast: DataFrame
    importance: DataFrame
    best_name: str
    models: dict[str, ops.Model]


def scored_test(test: DataFrame, model: ops.Model, *, replicas: int = 50) -> DataFrame:
    """Test rows with prediction, interval and residual, scored in one pass."""
    scored = residual(ops.scored_interval(test, model, replicas=replicas, keep=("category", ops.TARGET)))
    return scored.select(
        "date", "store", "product", "category", ops.TARGET,
        "predicted_sales", "pred_lower", "pred_upper", "residual",
    )


def fit_models(
    train: DataFrame, *, forest: dict | None = None, boosted: dict | None = None
) -> dict[str, ops.Model]:
    """Both tree models, fitted side by side: one waits for the driver while the other computes."""
    with ThreadPoolExecutor(2) as pool:
        fits = {
            FOREST: pool.submit(ops.random_forest, train, **(forest or {})),
            BOOSTED: pool.submit(ops.boosted_trees, train, **(boosted or {})),
        }
        return {name: fit.result() for name, fit in fits.items()}


def run_forecast(
    features: DataFrame,
    *,
    ratio: float = 0.8,
    days: int = 30,
    forest: dict | None = None,
    boosted: dict | None = None,
    replicas: int = 50,
) -> ForecastResult:
    """Split, fit, compare, choose by MAE, then score test and future days.

    Pass a stored feature table: every tree level reads the training rows.
    """
    train, test = ops.time_split(features, ratio)
    models = fit_models(train, forest=forest, boosted=boosted)
    rows = [ops.metrics(ops.naive_forecast(train, test), NAIVE)]
    rows += [ops.metrics(ops.predict(test, m), name) for name, m in models.items()]
    exact = stage(reduce(DataFrame.unionByName, rows), "comparison")
    # The boosted model must beat the forest to be chosen, by the figures before they are rounded.
    candidates = exact.where(exact["model"].isin(list(models)))
    best = candidates.orderBy("mae", exact["model"].desc()).first()["model"]
    model = models[best]
    return ForecastResult(
        comparison=ops.compare(exact),
        test_predictions=scored_test(test, model, replicas=replicas),
        forecast=ops.future_forecast(features, model, days, model_name=best),
        importance=ops.feature_importance(features.sparkSession, model),
        best_name=best,
        models=models,
    )


def write_forecast(result: ForecastResult, folder: str, *, fmt: str = "parquet") -> None:
    """Write every table and model below ``folder``."""
    for name in ("comparison", "test_predictions", "forecast", "importance"):
        write_table(getattr(result, name), f"{folder}/{name}", fmt=fmt)
    for name, model in result.models.items():
        save_model(model, f"{folder}/models/{name.lower().replace(' ', '_')}")
