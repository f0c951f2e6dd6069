"""ARIMA per series: Spark groups the series, a small NumPy fit handles each one.

A group is one daily series, so its size is bounded by the number of days. Weights
have the greatest exact Gaussian likelihood of the differenced series where both
orders are at most one, as for the default (1, 1, 1); higher orders take the
least conditional sum of squares.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelf.operators.forecast import metrics
from shelf.operators.partitioning import by_series
from shelf.operators.quality import fill_date_gaps
from shelf.schema import SERIES

# Ship the fit with the task: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

MIN_DAYS = 60
LIMIT = 0.99


def _errors(y: np.ndarray, ar: np.ndarray, ma: np.ndarray) -> np.ndarray:
    """One-step errors for many parameter sets at once, one column each."""
    n, sets = len(y), ar.shape[1]
    noise = np.repeat(y[:, None], sets, axis=1)
    for i, weights in enumerate(ar, 1):
        noise[i:] -= y[:-i, None] * weights
    q = len(ma)
    if q == 1:
        # e[t] = a[t] - m e[t-1], summed over spans that double in length.
        span, factor = 1, -ma[0]
        while span < n and np.any(np.abs(factor) > 1e-15):
            noise[span:] = noise[span:] + factor * noise[:-span]
            span, factor = 2 * span, factor * factor
        return noise
    for t in range(1, n if q else 0):
        for j in range(1, min(q, t) + 1):
            noise[t] -= ma[j - 1] * noise[t - j]
    return noise


def _start(y: np.ndarray, ar: np.ndarray, ma: np.ndarray, noise: np.ndarray):
    """What the day before the first adds to the errors: its prior variance, best value and powers.

    With AR weight f and MA weight m the errors are those of a start at zero less (-m)^t w, where
    w = f y[-1] + m e[-1] is normal; its variance is known since the series is stationary.
    """
    f = ar[0] if len(ar) else np.zeros(noise.shape[1])
    m = ma[0] if len(ma) else np.zeros(noise.shape[1])
    spread = (1 + 2 * f * m + m * m) / (1 - f * f)
    prior = f * f * spread + 2 * f * m + m * m
    powers = np.power(-m, np.arange(len(y))[:, None])
    squares, met = np.square(powers).sum(axis=0), (powers * noise).sum(axis=0)
    return prior * squares, prior * met / (1 + prior * squares), powers


def loss(y: np.ndarray, ar: np.ndarray, ma: np.ndarray) -> np.ndarray:
    """Minus twice the log likelihood, up to a constant, with the best error variance."""
    noise = _errors(y, ar, ma)
    total = np.square(noise).sum(axis=0)
    if len(ar) > 1 or len(ma) > 1:
        return total
    spread, best, powers = _start(y, ar, ma, noise)
    total = total - best * (powers * noise).sum(axis=0)
    return len(y) * np.log(np.maximum(total, 1e-300)) + np.log1p(spread)


def fit_weights(
    y: np.ndarray, p: int, q: int, *, start: np.ndarray | None = None, first: int = 25, width: int = 7
) -> np.ndarray:
    """AR and MA weights with the least :func:`loss`.

    Neighbouring weights are searched in pairs, first on a grid of ``first`` by ``first`` points over
    all stationary and invertible ones, since there may be several minima, then on grids that
    narrow around the best point found so far; from a good ``start`` these are enough.
    """
    best = np.zeros(p + q) if start is None else start
    if not p + q or not np.any(y):
        return best
    pairs = [[0]] if p + q == 1 else [[k, k + 1] for k in range(p + q - 1)]
    reach, points = (0.95, first) if start is None else (0.06, width)
    while reach > 0.001:
        for pair in pairs:
            ticks = [np.linspace(-reach, reach, points)] * len(pair)
            moves = np.stack([g.ravel() for g in np.meshgrid(*ticks)])
            sets = np.repeat(best[:, None], moves.shape[1], axis=1)
            sets[pair] = np.clip(sets[pair] + moves, -LIMIT, LIMIT)
            best = sets[:, int(np.argmin(loss(y, sets[:p], sets[p:])))]
        reach, points = (0.08, width) if points == first else (reach / 2.5, width)
    return best


def arima_forecast(
    values: np.ndarray,
    steps: int,
    order: tuple[int, int, int] = (1, 1, 1),
    *,
    start: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray]:
    """The ``steps`` values after ``values``, never below zero, and the fitted weights."""
    p, d, q = order
    levels = [np.asarray(values, dtype=float)]
    for _ in range(d):
        levels.append(np.diff(levels[-1]))
    # A model without differencing works on deviations from the mean.
    centre = levels[-1].mean() if d == 0 else 0.0
    y = levels[-1] - centre
    weights = fit_weights(y, p, q, start=start)
    ar, ma = weights[:p], weights[p:]
    noise = _errors(y, ar[:, None], ma[:, None])
    if p <= 1 and q <= 1:
        _, best, powers = _start(y, ar[:, None], ma[:, None], noise)
        noise = noise - powers * best
    noise = noise[:, 0]
    past, shocks = list(y), list(noise)
    for _ in range(steps):
        step = sum(w * past[-i] for i, w in enumerate(ar, 1))
        step += sum(w * shocks[-j] for j, w in enumerate(ma, 1))
        past.append(step)
        shocks.append(0.0)
    out = np.array(past[len(y):]) + centre
    for level in reversed(levels[:-1]):
        out = level[-1] + np.cumsum(out)
    return np.maximum(out, 0.0), weights


_OUTPUT = "store string, product string, date date, kind string, actual double, forecast double"


def arima_by_series(
    df: DataFrame,
    *,
    target: str = "actual_sales",
    order: tuple[int, int, int] = (1, 1, 1),
    steps: int = 30,
    min_days: int = MIN_DAYS,
) -> DataFrame:
    """Back-test and future forecast of every series with at least ``min_days`` days.

    ``kind`` is ``backtest`` for the last ``steps`` known days, forecast without
    them, and ``future`` for the days after the end, forecast from all of them.
    """

    def one_series(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("date")
        values = group["value"].to_numpy()
        if len(values) < max(min_days, steps + 3):
            return pd.DataFrame(columns=[c.split()[0] for c in _OUTPUT.split(", ")])
        last = pd.Timestamp(group["date"].iloc[-1])
        backtest, _ = arima_forecast(values[:-steps], steps, order)
        ahead, _ = arima_forecast(values, steps, order)
        future = pd.date_range(last + pd.Timedelta(days=1), periods=steps, freq="D")
        known = group["date"].iloc[-steps:]
        return pd.DataFrame(
            {
                "store": group["store"].iloc[0],
                "product": group["product"].iloc[0],
                "date": [*known, *future.date],
                "kind": ["backtest"] * steps + ["future"] * steps,
                "actual": [*values[-steps:], *[None] * steps],
                "forecast": [*backtest, *ahead],
            }
        )

    series = fill_date_gaps(
        df.select(*SERIES, "date", F.col(target).cast("double").alias("value")),
        carried=(),
        zeroed=("value",),
    )
    return by_series(series).groupBy(*SERIES).applyInPandas(one_series, _OUTPUT)


def arima_metrics(forecast: DataFrame) -> DataFrame:
    """MAE, RMSE, MAPE and R2 of the back-test of each series, from :func:`arima_by_series`."""
    rows = forecast.where(F.col("kind") == "backtest")
    return metrics(rows, "ARIMA", actual="actual", predicted="forecast", by=SERIES)
