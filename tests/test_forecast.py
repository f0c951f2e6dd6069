import datetime as dt

import numpy as np
import pandas as pd
import pytest
from conftest import day, ordered
from pyspark.sql import functions as F

from shelf.operators import forecast as fc
from shelf.operators.arima import _errors, arima_by_series, arima_forecast, arima_metrics, fit_weights, loss
from shelf.plans.features import build_features
from shelf.plans.forecast import BOOSTED, FOREST, NAIVE, run_forecast, write_forecast
from shelf.sources.io import load_model
from shelf.staging import stage, stage_path


def test_split_keeps_days_whole(spark):
    counts = {"2024-01-01": 3, "2024-01-02": 4, "2024-01-03": 2, "2024-01-04": 1}
    df = spark.createDataFrame([(day(d),) for d, n in counts.items() for _ in range(n)], "date date")
    train, test = fc.time_split(df, 0.8)
    # Position 8 of 10 falls on 3 January.
    assert train.count() == 7 and test.count() == 3
    assert test.agg(F.min("date")).first()[0] == day("2024-01-03")


def test_metrics_mask_zero_actuals(spark):
    df = spark.createDataFrame([(0, 1.0), (10, 9.0), (20, 22.0)], "actual_sales int, predicted_sales double")
    row = fc.metrics(df, "m").first()
    assert row["mape_pct"] == pytest.approx(10.0)
    assert row["mae"] == pytest.approx(4 / 3)
    assert row["rmse"] == pytest.approx(np.sqrt(2.0))
    assert row["r2"] == pytest.approx(1 - 6 / 200)


def test_naive_takes_last_rows(spark):
    rows = [(day("2024-01-01") + dt.timedelta(days=i), s, "p", i) for i in range(10) for s in ("a", "b")]
    df = spark.createDataFrame(rows, "date date, store string, product string, actual_sales int")
    train, test = df.where("actual_sales < 8"), df.where("actual_sales >= 8")
    pooled = fc.naive_forecast(train, test).first()["predicted_sales"]
    assert pooled == pytest.approx((7 + 7 + 6 + 6 + 5 + 5 + 4) / 7)
    each = fc.naive_forecast(train, test, per_series=True).select("predicted_sales").distinct().collect()
    assert [r[0] for r in each] == [pytest.approx(4.0)]


def frozen_figures(group):
    """The frozen figures of one series in plain NumPy."""
    sales = group.sort_values("date")["actual_sales"].to_numpy(float)
    recent = sales[-30:]
    at = lambda n: recent[-n] if len(recent) >= n else 0.0
    tail = lambda n: recent[-n:] if len(recent) >= n else recent
    return {
        "lag_1d": at(1), "lag_7d": at(7), "lag_14d": at(14), "lag_30d": at(30),
        "rolling_mean_7d": tail(7).mean(), "rolling_mean_14d": tail(14).mean(),
        "rolling_mean_30d": recent.mean(), "expanding_mean": recent.mean(),
        "rolling_std_7d": np.std(tail(7)) if len(recent) >= 7 else 0.0,
        "rolling_std_14d": np.std(tail(14)) if len(recent) >= 14 else 0.0,
    }


def test_future_features(panel, random_panel):
    got = fc.future_features(panel, 5).toPandas()
    assert len(got) == 4 * 5
    for (store, product), group in random_panel.groupby(["store", "product"]):
        mine = got[(got["store"] == store) & (got["product"] == product)].sort_values("date")
        last = group["date"].max()
        assert mine["date"].tolist() == [last + dt.timedelta(days=i) for i in range(1, 6)]
        for name, value in frozen_figures(group).items():
            assert mine[name].tolist() == pytest.approx([value] * 5), name
        assert mine["day_of_week"].tolist() == [d.weekday() for d in mine["date"]]
        assert (mine[["is_promotion", "promo_x_weekend", "promo_lag1"]] == 0).all().all()


def test_constant_series(spark):
    rows = [(day("2024-01-01") + dt.timedelta(days=i), "s", "p", "c", 4) for i in range(60)]
    df = spark.createDataFrame(rows, "date date, store string, product string, category string, actual_sales int")
    row = fc.future_features(df, 1).first()
    assert row["rolling_std_7d"] == 0 and row["rolling_mean_30d"] == 4
    forecast = arima_by_series(df).toPandas()
    assert len(forecast) == 60 and forecast["forecast"].tolist() == pytest.approx([4.0] * 60)


def test_short_series_is_skipped(spark):
    rows = [
        (day("2024-01-01") + dt.timedelta(days=i), "s", p, 4) for p, n in (("long", 60), ("short", 59)) for i in range(n)
    ]
    df = spark.createDataFrame(rows, "date date, store string, product string, actual_sales int")
    got = arima_by_series(df).toPandas()
    assert set(got["product"]) == {"long"}
    future = got[got["kind"] == "future"]
    assert min(future["date"]) == day("2024-03-01") and len(future) == 30


def test_arima_recovers_weights():
    rng = np.random.default_rng(5)
    shocks = rng.normal(0, 1, 4000)
    y = np.zeros(4000)
    for t in range(1, 4000):
        y[t] = 0.6 * y[t - 1] + shocks[t] + 0.3 * shocks[t - 1]
    _, weights = arima_forecast(100 + np.cumsum(y), 5)
    assert weights == pytest.approx([0.6, 0.3], abs=0.06)


def test_error_recursion_equals_a_loop():
    rng = np.random.default_rng(2)
    y, ar, ma = rng.normal(size=50), 0.5, -0.8
    want = [y[0]]
    for t in range(1, 50):
        want.append(y[t] - ar * y[t - 1] - ma * want[-1])
    got = _errors(y, np.array([[ar]]), np.array([[ma]]))[:, 0]
    np.testing.assert_allclose(got, want)


def dense_loss(y, ar, ma):
    """Minus twice the log likelihood from the whole covariance matrix, with the best variance."""
    lags = np.arange(len(y))
    first = (1 + 2 * ar * ma + ma * ma) / (1 - ar * ar)
    second = (1 + ar * ma) * (ar + ma) / (1 - ar * ar)
    gamma = np.where(lags == 0, first, second * np.power(ar, np.maximum(lags - 1, 0)))
    cov = gamma[np.abs(lags[:, None] - lags[None, :])]
    return len(y) * np.log(y @ np.linalg.solve(cov, y)) + np.linalg.slogdet(cov)[1]


@pytest.mark.parametrize("ar, ma", [(0.6, 0.3), (-0.5, 0.8), (0.9, -0.4), (0.0, -0.7)])
def test_weights_have_the_greatest_exact_likelihood(ar, ma):
    rng = np.random.default_rng(9)
    e = rng.normal(0, 2, 121)
    y = np.zeros(121)
    for t in range(1, 121):
        y[t] = ar * y[t - 1] + e[t] + ma * e[t - 1]
    y = y[1:]
    for point in ((0.5, -0.2), (-0.9, 0.4), (0.0, 0.99), (0.3, 0.0)):
        mine = loss(y, np.array([[point[0]]]), np.array([[point[1]]]))[0]
        base = loss(y, np.array([[0.0]]), np.array([[0.0]]))[0]
        assert mine - base == pytest.approx(dense_loss(y, *point) - dense_loss(y, 0.0, 0.0), abs=1e-6)
    found = fit_weights(y, 1, 1)
    ticks = np.linspace(-0.98, 0.98, 50)
    grid = [(dense_loss(y, a, m), a, m) for a in ticks for m in ticks if abs(a + m) > 0.03]
    coarse = min(grid)
    fine = min(
        (dense_loss(y, a, m), a, m)
        for a in np.clip(coarse[1] + np.linspace(-0.04, 0.04, 17), -0.99, 0.99)
        for m in np.clip(coarse[2] + np.linspace(-0.04, 0.04, 17), -0.99, 0.99)
    )
    assert dense_loss(y, *found) <= fine[0] + 1e-3
    assert found == pytest.approx(fine[1:], abs=0.01)


def test_arima_metrics_by_series(panel):
    forecast = arima_by_series(panel)
    rows = {(r["store"], r["product"]): r for r in arima_metrics(forecast).collect()}
    table = forecast.where("kind = 'backtest'").toPandas()
    assert len(rows) == 3
    for key, own in table.groupby(["store", "product"]):
        gap = own["actual"].astype(float) - own["forecast"]
        assert rows[key]["mae"] == pytest.approx(gap.abs().mean())
        assert rows[key]["rmse"] == pytest.approx(np.sqrt((gap**2).mean()))


def test_forecast_never_negative():
    out, _ = arima_forecast(np.linspace(50, 0, 80), 30, (1, 1, 0))
    assert (out >= 0).all() and len(out) == 30


@pytest.fixture(scope="module")
def seasonal(spark):
    rows = [
        (
            day("2023-01-01") + dt.timedelta(days=i), s, p, "c",
            int(20 + 10 * k + 15 * ((i % 7) >= 5) + (i * 7 + k) % 4), 0.0, 5.0 + k, 100, i % 11 == 0, 0.0,
        )
        for s in ("a", "b") for k, p in enumerate(("x", "y")) for i in range(160)
    ]
    df = spark.createDataFrame(
        rows,
        "date date, store string, product string, category string, actual_sales int, revenue double, "
        "unit_price double, current_stock int, promo boolean, discount_pct double",
    ).withColumn("is_promotion", F.col("promo").cast("int")).drop("promo")
    return stage(build_features(stage(df))[0])


@pytest.fixture(scope="module")
def result(seasonal):
    return run_forecast(seasonal, days=4, forest={"trees": 10, "depth": 6}, boosted={"rounds": 5, "depth": 4}, replicas=20)


def test_models_beat_the_baseline(result):
    mae = {r["model"]: r["mae"] for r in result.comparison.collect()}
    assert set(mae) == {NAIVE, FOREST, BOOSTED}
    assert mae[FOREST] < mae[NAIVE] and mae[BOOSTED] < mae[NAIVE]
    assert mae[result.best_name] == min(mae[FOREST], mae[BOOSTED])
    best = fc.improvement(result.comparison, NAIVE).first()
    assert best["best_model"] == result.best_name and best["improvement_pct"] > 0


def test_scored_rows(result, seasonal):
    rows = result.test_predictions.toPandas()
    _, test = fc.time_split(seasonal)
    assert len(rows) == test.count()
    assert (rows["pred_lower"] <= rows["pred_upper"]).all() and (rows["pred_lower"] >= 0).all()
    assert (rows["residual"] - (rows["actual_sales"] - rows["predicted_sales"])).abs().max() < 1e-9


def test_interval_is_repeatable(result, seasonal):
    _, test = fc.time_split(seasonal)
    model = result.models[FOREST]
    runs = [ordered(fc.noise_interval(test, model, replicas=10), *fc.KEY) for _ in range(2)]
    pd.testing.assert_frame_equal(*runs)


@pytest.mark.parametrize("name", [FOREST, BOOSTED])
def test_noise_does_not_depend_on_partitions(result, seasonal, name):
    _, test = fc.time_split(seasonal)
    runs = [
        ordered(fc.scored_interval(test.repartition(n), result.models[name], replicas=10), *fc.KEY) for n in (2, 8)
    ]
    pd.testing.assert_frame_equal(*runs)
    plain = ordered(fc.predict(test, result.models[name]).select(*fc.KEY, "predicted_sales"), *fc.KEY)
    assert runs[0]["predicted_sales"].tolist() == plain["predicted_sales"].tolist()


def test_noise_is_standard_normal(seasonal):
    rows = fc.jittered(seasonal.select(*fc.KEY, F.lit(0.0).alias("x"), F.lit(1.0).alias("y")), ["x", "y"], replicas=40, noise=1.0)
    noisy = rows.where("_replica > 0").toPandas()
    for moved in (noisy["x"], noisy["y"] - 1):
        assert abs(moved.mean()) < 0.03 and abs(moved.std() - 1) < 0.03 and abs((moved**3).mean()) < 0.1
    assert abs(np.corrcoef(noisy["x"], noisy["y"])[0, 1]) < 0.03
    assert rows.where("_replica = 0 and (x <> 0 or y <> 1)").count() == 0


def test_interval_shuffles_rows_not_replicas(result, seasonal):
    _, test = fc.time_split(seasonal)
    plan = fc.noise_interval(test, result.models[FOREST])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(store") == 1


def test_forecast_rows(result):
    rows = result.forecast.toPandas()
    assert len(rows) == 4 * 4 and set(rows["model"]) == {result.best_name}
    assert (rows["forecast_qty"] >= 0).all()
    expected = rows["forecast_qty"] * rows["unit_price"]
    assert (rows["forecast_revenue"] - expected).abs().max() < 0.1


def test_importance_sums_to_one(result):
    rows = result.importance.toPandas()
    assert rows["importance"].sum() == pytest.approx(1)
    assert rows["importance"].is_monotonic_decreasing


def test_written_tables_and_models(spark, result, seasonal):
    folder = stage_path(spark, "outputs")
    write_forecast(result, folder)
    assert spark.read.parquet(f"{folder}/forecast").count() == 16
    model = load_model(f"{folder}/models/random_forest")
    again = ordered(fc.predict(seasonal, model), *fc.KEY)
    before = ordered(fc.predict(seasonal, result.models[FOREST]), *fc.KEY)
    assert again["predicted_sales"].tolist() == before["predicted_sales"].tolist()
    model = load_model(f"{folder}/models/boosted_trees")
    again = ordered(fc.predict(seasonal, model), *fc.KEY)
    before = ordered(fc.predict(seasonal, result.models[BOOSTED]), *fc.KEY)
    assert again["predicted_sales"].tolist() == before["predicted_sales"].tolist()
    assert model.importance() == result.models[BOOSTED].importance()


def test_negative_predictions_are_clamped(spark):
    from shelf.functions.numeric import non_negative

    df = spark.createDataFrame([(-1.0,), (None,), (2.0,)], "p double")
    assert [r[0] for r in df.select(non_negative(F.col("p"))).collect()] == [0.0, None, 2.0]


def test_noise_of_two_features_is_made_once(spark):
    rows = spark.createDataFrame([("S", "P", "2024-01-01", 1.0, 2.0)], "store string, product string, date string, a double, b double")
    plan = fc.jittered(rows, ["a", "b"], replicas=2)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("conv(") == 2
