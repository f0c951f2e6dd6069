import pytest
from conftest import day
from pyspark.sql import functions as F

from shelf.functions import stock
from shelf.functions.numeric import normal_quantile
from shelf.operators import inventory as inv
from shelf.plans.inventory import run_inventory


def sales(spark, revenue):
    rows = [(p, "c", float(r), 1, 2.0) for p, r in revenue.items()]
    schema = "product string, category string, revenue double, actual_sales int, unit_price double"
    return spark.createDataFrame(rows, schema)


def classes(abc):
    return {r["product"]: r["abc_class"] for r in abc.collect()}


@pytest.mark.parametrize("ranges", [None, 3])
def test_abc_thresholds(spark, ranges):
    abc = inv.abc_analysis(sales(spark, {"x": 70, "y": 20, "z": 10}), ranges=ranges)
    assert classes(abc) == {"x": "A", "y": "B", "z": "C"}
    abc = inv.abc_analysis(sales(spark, {"x": 95, "y": 5}), ranges=ranges)
    assert classes(abc) == {"x": "C", "y": "C"}


def test_abc_ranges_equal_window_with_ties(spark):
    revenue = {f"p{i:04d}": 100.0 if i < 400 else float(i % 97) for i in range(1000)}
    df = sales(spark, revenue)
    one = inv.abc_analysis(df).toPandas().sort_values("product")
    many = inv.abc_analysis(df, ranges=20).toPandas().sort_values("product")
    assert one["cumulative_pct"].tolist() == pytest.approx(many["cumulative_pct"].tolist())
    assert one["abc_class"].tolist() == many["abc_class"].tolist()
    assert one["cumulative_pct"].max() == pytest.approx(100)


def test_rounded_shares_can_vanish(spark):
    df = sales(spark, {"big": 1e9, **{f"s{i}": 1.0 for i in range(9)}})
    assert inv.abc_analysis(df, pct_scale=2).agg(F.max("cumulative_pct")).first()[0] == 100.0
    assert inv.abc_summary(inv.abc_analysis(df)).agg(F.sum("num_products")).first()[0] == 10


def test_worked_example(spark):
    df = spark.createDataFrame(
        [(50.0, 10.0, 500.0), (0.0, 0.0, 500.0), (5.0, 1.0, 0.0)],
        "avg_daily_demand double, std_daily_demand double, unit_price double",
    )
    golden, idle, free = inv.stock_thresholds(df).collect()
    assert (golden["safety_stock"], golden["reorder_point"], golden["eoq"]) == (43.65, 393.65, 120.83)
    assert idle["eoq"] == 0 and free["eoq"] == 0


def test_status_levels(spark):
    limits = (100.0, 300.0, 40.0, 10.0, 2.0)
    cases = [(100, "HIGH"), (300, "HIGH"), (360, "MEDIUM"), (361, "OVERSTOCK")]
    schema = (
        "current_stock long, safety_stock double, reorder_point double, eoq double, "
        "avg_daily_demand double, unit_price double"
    )
    rows = [(s, *limits) for s, _ in cases] + [(361, 100.0, 300.0, 400.0, 0.0, 2.0)]
    got = inv.assess_stock(spark.createDataFrame(rows, schema)).collect()
    assert [r["risk_level"] for r in got] == [c for _, c in cases] + ["HEALTHY"]
    assert [r["recommended_order"] for r in got] == [40.0, 40.0, 0.0, 0.0, 0.0]
    assert got[0]["low_stock_flag"] and not got[1]["low_stock_flag"]
    assert got[4]["days_of_stock"] == 999.0 and got[0]["days_of_stock"] == 10.0
    assert got[3]["overstock_flag"] and not got[4]["overstock_flag"]


def test_lookup_default(spark):
    df = spark.createDataFrame([("A",), (None,), ("?",)], "k string")
    got = df.select(stock.lookup(F.col("k"), stock.ABC_SCORES, 1)).collect()
    assert [r[0] for r in got] == [3, 1, 1]


def test_normal_quantile():
    assert normal_quantile(0.95) == pytest.approx(1.6448536)


def test_series_without_forecast_keeps_its_mean(spark, panel):
    forecast = spark.createDataFrame([("S1", "P2", 99.0)], "store string, product string, forecast_qty double")
    rows = inv.attach_forecast(inv.series_stats(panel), forecast).collect()
    for r in rows:
        known = (r["store"], r["product"]) == ("S1", "P2")
        assert r["forecast_avg_daily"] == (99.0 if known else r["avg_daily_demand"])


def test_single_row_series_has_no_deviation(spark):
    rows = [(day("2024-01-01"), "s", "p", "c", 3, 9.0, 3.0, 7, 0)]
    schema = (
        "date date, store string, product string, category string, actual_sales int, "
        "revenue double, unit_price double, current_stock int, stockout_flag int"
    )
    row = inv.series_stats(spark.createDataFrame(rows, schema)).first()
    assert row["std_daily_demand"] == 0 and row["total_days"] == 1


def test_inventory_plan(spark, panel, random_panel):
    forecast = panel.select("store", "product", F.lit(4.0).alias("forecast_qty"))
    result = run_inventory(panel, forecast)
    rows = result.recommendations.toPandas()
    assert len(rows) == 4
    want = random_panel.groupby(["store", "product"])["actual_sales"].mean().round(2)
    got = rows.set_index(["store", "product"])["avg_daily_demand"].sort_index()
    assert got.tolist() == pytest.approx(want.sort_index().tolist())
    assert result.alerts.count() == rows["stockout_risk"].sum()
    kpis = result.kpis.first()
    assert kpis["store_product_pairs"] == 4 and kpis["total_lost_units"] == 0
    assert kpis["total_revenue"] == pytest.approx(random_panel["revenue"].sum(), abs=1)


def test_demand_from_forecast_moves_the_reorder_point(spark, panel):
    forecast = panel.select("store", "product", F.lit(1000.0).alias("forecast_qty"))
    high = inv.recommendations(panel, forecast, demand_source="forecast").toPandas()
    assert (high["reorder_point"] > 7000).all() and (high["risk_level"] == "HIGH").all()


def test_lead_time_may_be_a_column(spark):
    df = spark.createDataFrame(
        [(10.0, 0.0, 1.0, 3.0)],
        "avg_daily_demand double, std_daily_demand double, unit_price double, lead double",
    )
    assert inv.stock_thresholds(df, lead_time=F.col("lead")).first()["reorder_point"] == 30.0
