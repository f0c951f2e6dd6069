import datetime as dt

import numpy as np
import pandas as pd
import pytest
from conftest import day, ordered

from shelf.operators import features as feat
from shelf.operators import promotions
from shelf.plans.features import build_features
from shelf.staging import stage

ORDER = ("store", "product", "date")


def pandas_panel(random_panel):
    return random_panel.sort_values(list(ORDER)).reset_index(drop=True)


def test_calendar_edges(spark):
    days = ["2024-12-30", "2025-01-01", "2023-01-01", "2024-02-29", "2024-06-01"]
    got = ordered(feat.date_features(spark.createDataFrame([(day(d),) for d in days], "date date")), "date")
    when = pd.to_datetime(got["date"])
    assert got["day_of_week"].tolist() == when.dt.dayofweek.tolist()
    assert got["week_of_year"].tolist() == when.dt.isocalendar().week.tolist()
    assert got["is_month_end"].tolist() == when.dt.is_month_end.astype(int).tolist()
    assert got["is_month_start"].tolist() == when.dt.is_month_start.astype(int).tolist()
    assert got["day_of_year"].tolist() == when.dt.dayofyear.tolist()
    assert got["quarter"].tolist() == when.dt.quarter.tolist()
    assert got["is_weekend"].tolist() == (when.dt.dayofweek >= 5).astype(int).tolist()


def test_windows_equal_pandas(panel, random_panel):
    want = pandas_panel(random_panel)
    group = want.groupby(["store", "product"])["actual_sales"]
    for n in (1, 7, 14, 30):
        want[f"lag_{n}d"] = group.shift(n)
    for w in (7, 14, 30):
        want[f"rolling_mean_{w}d"] = group.transform(lambda x: x.shift(1).rolling(w, min_periods=1).mean())
        want[f"rolling_std_{w}d"] = group.transform(lambda x: x.shift(1).rolling(w, min_periods=1).std())
    want["expanding_mean"] = group.transform(lambda x: x.expanding().mean())
    made = panel.transform(feat.lag_features).transform(feat.rolling_features).transform(feat.expanding_mean)
    got = ordered(made, *ORDER)
    for c in want.columns[12:]:
        np.testing.assert_allclose(got[c].astype(float), want[c].astype(float), atol=1e-9, err_msg=c)


def test_leak_free_mean_ignores_today(panel):
    got = ordered(feat.expanding_mean(panel, leak_free=True), *ORDER)
    first = got.groupby(["store", "product"]).head(1)
    assert first["expanding_mean"].isna().all()


def test_promo_features(panel, random_panel):
    want = pandas_panel(random_panel)
    lagged = want.groupby(["store", "product"])["is_promotion"].shift(1).fillna(0).astype(int)
    got = ordered(feat.promo_features(panel), *ORDER)
    assert got["promo_lag1"].tolist() == lagged.tolist()
    # Without calendar columns the weekend counts 0 and the month 1.
    assert (got["promo_x_weekend"] == 0).all() and (got["promo_x_month"] == got["is_promotion"]).all()


def test_codes_follow_first_appearance(panel, random_panel):
    _, codes = feat.encode(panel)
    table = codes.toPandas()
    want = pandas_panel(random_panel)
    for column in ("store", "category", "product"):
        mine = table[table["column"] == column].sort_values("code")
        assert mine["value"].tolist() == list(want[column].unique()), column
        assert mine["code"].tolist() == list(range(len(mine)))


def segment_panel(spark):
    series = {
        "zeros": [0] * 5 + [9] * 5,
        "spike": [1] * 9 + [500],
        "high": [10] * 8 + [9, 1],
        "low": [1, 9] + [10] * 8,
        "even": list(range(1, 11)),
    }
    rows = [
        (dt.date(2024, 1, 1) + dt.timedelta(days=i), "s", name, v)
        for name, values in series.items()
        for i, v in enumerate(values)
    ]
    return series, spark.createDataFrame(rows, "date date, store string, product string, actual_sales int")


def test_segments(spark):
    series, df = segment_panel(spark)

    def label(values):
        values = np.array(values)
        if (values == 0).mean() > 0.4:
            return "INTERMITTENT"
        if values.mean() >= np.quantile(values, 0.75):
            return "HIGH"
        return "LOW" if values.mean() <= np.quantile(values, 0.25) else "MEDIUM"

    want = {name: label(v) for name, v in series.items()}
    assert set(want.values()) == {"INTERMITTENT", "HIGH", "LOW", "MEDIUM"}
    got = {r["product"]: r["demand_segment"] for r in feat.demand_segments(df).collect()}
    assert got == want
    rows = feat.segment_demand(df).select("product", "demand_segment").distinct().collect()
    assert {r["product"]: r["demand_segment"] for r in rows} == want


def test_feature_plan(panel, random_panel):
    features, codes = build_features(panel)
    rows = features.toPandas()
    lengths = random_panel.groupby(["store", "product"]).size()
    assert len(rows) == (lengths - 7).clip(lower=0).sum()
    assert set(feat.MODEL_FEATURES) <= set(rows.columns)
    # The three-day series is gone, yet its values keep their codes.
    assert codes.count() == 2 + 2 + 3


def test_all_windows_share_one_shuffle(spark, panel):
    plan = build_features(stage(panel))[0]._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(store") == 1


def test_warm_up_leaves_one_of_eight_days(spark):
    rows = [(dt.date(2024, 1, i), "s", "p", i) for i in range(1, 9)]
    df = spark.createDataFrame(rows, "date date, store string, product string, actual_sales int")
    made = df.transform(feat.lag_features).transform(feat.rolling_features).transform(feat.drop_warm_up)
    assert made.count() == 1


def test_last_rows(panel, random_panel):
    got = feat.last_rows(panel, 10).toPandas()
    want = pandas_panel(random_panel).groupby(["store", "product"]).tail(10)
    assert sorted(map(tuple, got[list(ORDER)].values)) == sorted(map(tuple, want[list(ORDER)].values))


@pytest.mark.parametrize(
    "when,discount",
    [("2024-01-22", 0.0), ("2024-01-23", 0.20), ("2024-01-29", 0.20), ("2024-01-30", 0.0),
     ("2024-11-08", 0.35), ("2024-11-14", 0.35), ("2024-11-15", 0.0)],
)
def test_sale_window_ends(spark, when, discount):
    row = promotions.promo_calendar(spark.createDataFrame([(day(when),)], "date date")).first()
    assert row["sale_discount"] == discount and row["is_sale"] == int(discount > 0)


def test_first_sale_wins_an_overlap(spark):
    df = spark.createDataFrame([(day("2024-01-26"),)], "date date")
    row = promotions.promo_calendar(df, [(1, 26, 0.2), (1, 27, 0.5)]).collect()
    assert [r["sale_discount"] for r in row] == [0.2]


def test_season_factor(spark):
    rows = [(day("2024-11-04"), "Electronics"), (day("2024-11-09"), "Electronics"), (day("2024-07-06"), "Other")]
    got = ordered(promotions.season_factor(spark.createDataFrame(rows, "date date, category string")), "date")
    assert got["season_factor"].tolist() == [1.25, 2.2, 2.75]
