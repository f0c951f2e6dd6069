import numpy as np
import pandas as pd
import pytest
from conftest import ordered
from pyspark.sql import functions as F

from shelf.operators import reports
from shelf.operators.measures import derive_sales_measures


def test_trend_starts_with_a_full_window(panel, random_panel):
    got = ordered(reports.trend(panel, days=7), "date")
    daily = random_panel.groupby("date")["actual_sales"].sum().sort_index()
    want = daily.rolling(7).mean().to_numpy()
    assert got["actual_sales"].tolist() == daily.tolist()
    np.testing.assert_allclose(got["rolling_7d"].astype(float), want)


def test_weekday_mean_lists_absent_days(spark):
    rows = [(pd.Timestamp("2024-01-01").date(), 4), (pd.Timestamp("2024-01-03").date(), 8)]
    got = reports.weekday_mean(spark.createDataFrame(rows, "date date, actual_sales int")).collect()
    assert [r["dow"] for r in got] == list(reports.WEEKDAYS)
    assert [r["actual_sales"] for r in got] == [4.0, None, 8.0, None, None, None, None]


def test_pivot(panel, random_panel):
    got = reports.seasonality_pivot(panel).toPandas().set_index("day_of_week").sort_index()
    assert list(got.columns) == list(reports.MONTHS)
    when = pd.to_datetime(random_panel["date"])
    want = random_panel.assign(d=when.dt.dayofweek, m=when.dt.month).pivot_table(
        values="actual_sales", index="d", columns="m", aggfunc="mean"
    )
    np.testing.assert_allclose(got.iloc[:, 0].astype(float), want[1])
    assert got["Dec"].isna().all()


def test_promotion_reports(panel, random_panel):
    group = random_panel.groupby("is_promotion")["actual_sales"]
    got = reports.promotion_impact(panel).toPandas().set_index("label")
    for flag, label in reports.PROMO_LABELS.items():
        want = group.get_group(flag)
        assert got.loc[label, "mean"] == pytest.approx(want.mean())
        assert got.loc[label, "median"] == pytest.approx(want.median())
        assert got.loc[label, "sum"] == want.sum()
        assert got.loc[label, "std"] == pytest.approx(want.std())
    means = group.mean()
    uplift = reports.promo_uplift(panel).first()[0]
    assert uplift == pytest.approx((means[1] - means[0]) / means[0] * 100)
    box = reports.box_stats(panel).toPandas().set_index("label")
    assert box.loc["Promotion", "q3"] == pytest.approx(group.get_group(1).quantile(0.75))


def test_one_flag_value_only(spark):
    df = spark.createDataFrame([(0, 1), (0, 3)], "is_promotion int, actual_sales int")
    assert reports.promotion_impact(df).first()["median"] == 2.0
    assert reports.promo_uplift(df).first()[0] is None


def test_profile(panel, random_panel):
    got = reports.column_profile(panel).toPandas().set_index("column")
    want = random_panel.describe(include="all").T
    for c in ("actual_sales", "revenue", "unit_price"):
        for mine, theirs in (("mean", "mean"), ("std", "std"), ("q25", "25%"), ("q75", "75%")):
            assert got.loc[c, mine] == pytest.approx(want.loc[c, theirs])
        assert float(got.loc[c, "max"]) == want.loc[c, "max"]
    assert got.loc["store", "unique"] == 2 and got.loc["store", "top"] == "S1"
    assert got.loc["store", "freq"] == (random_panel["store"] == "S1").sum()
    assert got["missing"].sum() == 0 and len(got) == len(random_panel.columns)


def test_correlation(panel, random_panel):
    got = reports.target_correlation(panel, columns=["demand", "revenue", "is_promotion"], n=2).collect()
    want = random_panel[["demand", "revenue", "is_promotion"]].corrwith(random_panel["actual_sales"])
    top = want.abs().sort_values(ascending=False).index[:2]
    assert [r["feature"] for r in got] == list(top)
    assert got[0]["correlation"] == pytest.approx(want[top[0]])


def test_kpis_and_summary(panel, random_panel):
    kpi = reports.kpi_overview(panel).first()
    assert kpi["products"] == 3 and kpi["stores"] == 2
    assert kpi["stockout_rate_pct"] == pytest.approx(random_panel["stockout_flag"].mean() * 100)
    summary = reports.dataset_summary(panel).first()
    assert summary["rows"] == len(random_panel) and summary["categories"] == 2
    assert summary["first_date"] == random_panel["date"].min()


def test_filters(panel, random_panel):
    assert reports.filter_sales(panel).count() == len(random_panel)
    one = reports.filter_sales(panel, store="S1", product="P9")
    assert one.count() == 75
    assert reports.filter_members(panel, store=["S2"], product=["P1", "P2"]).count() == 67
    assert reports.history(panel, "S1", "P2", 10).count() == 10


def test_lists(panel):
    top = reports.top_products(panel, 2).collect()
    assert len(top) == 2 and top[0]["revenue"] >= top[1]["revenue"]
    counts = reports.value_counts(panel, "store").collect()
    assert [r["store"] for r in counts] == ["S1", "S2"]
    values = reports.distinct_values(panel, ["store", "product"]).collect()
    assert len(values) == 5
    assert {r["type"] for r in reports.type_counts(panel).collect()} >= {"string", "double", "bigint"}
    assert reports.preview(panel, 3).count() == 3


def test_shares(panel):
    rows = reports.volume_share(panel).toPandas()
    assert rows["share_pct"].sum() == pytest.approx(100)
    best = reports.performance(panel, "store").collect()
    assert best[0]["total_revenue"] >= best[1]["total_revenue"]
    assert best[0]["revenue_millions"] == pytest.approx(best[0]["total_revenue"] / 1e6)
    months = reports.monthly_totals(panel).agg(F.sum("actual_sales")).first()[0]
    assert months == reports.category_month(panel).agg(F.sum("actual_sales")).first()[0]


def test_actual_against_predicted(spark):
    rows = [("2024-01-01", "a", 3, 2.0), ("2024-01-01", "b", 5, 6.0), ("2024-01-02", "a", 1, 4.0)]
    df = spark.createDataFrame(rows, "date string, store string, actual_sales int, predicted_sales double")
    got = reports.forecast_vs_actual(df).collect()
    assert [(r["actual"], r["predicted"]) for r in got] == [(8, 8.0), (1, 4.0)]
    assert len(reports.forecast_vs_actual(df, store="b").collect()) == 1
    stats = reports.residual_stats(df).first()
    assert (stats["mean"], stats["max"], stats["min"]) == (-1.5, 0.0, -3.0)


def test_sales_measures(spark):
    df = spark.createDataFrame([(10, 4, 100.0, 0.25), (3, 9, 10.0, 0.0)], "demand int, current_stock int, unit_price double, discount_pct double")
    got = derive_sales_measures(df).collect()
    assert [(r["actual_sales"], r["lost_sales"], r["stockout_flag"]) for r in got] == [(4, 6, 1), (3, 0, 0)]
    assert [r["revenue"] for r in got] == [300.0, 30.0]


def test_correlation_of_a_constant_column(spark):
    """A column without variance has no correlation; it must not end the query."""
    rows = [(1.0, 5, 2.0, None), (2.0, 5, 4.5, None), (4.0, 5, 7.0, 1.0), (None, 5, 1.0, 2.0)]
    df = spark.createDataFrame(rows, "x double, same int, actual_sales double, rare double")
    got = {r["feature"]: r["correlation"] for r in reports.target_correlation(df).collect()}
    assert np.isnan(got["same"]) and got["rare"] == pytest.approx(-1.0)
    assert got["x"] == pytest.approx(np.corrcoef([1.0, 2.0, 4.0], [2.0, 4.5, 7.0])[0, 1])
