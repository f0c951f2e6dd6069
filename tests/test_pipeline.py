"""All four plans in a row, from a CSV file to written outputs."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from shelf.plans.features import build_features
from shelf.plans.forecast import run_forecast
from shelf.plans.inventory import run_inventory, write_inventory
from shelf.plans.preprocess import preprocess
from shelf.schema import RAW_SALES
from shelf.sources.io import read_table, read_validated, write_table
from shelf.staging import stage, stage_path

DAYS = 110


@pytest.fixture(scope="module")
def raw_csv(spark):
    rng = np.random.default_rng(11)
    rows = []
    for store in ("S1", "S2"):
        for k, product in enumerate(("P1", "P2")):
            for i in range(DAYS):
                if i in (20, 21):
                    continue
                demand = int(20 + 10 * k + 5 * (i % 7 >= 5) + rng.integers(0, 5))
                rows.append(
                    dict(
                        date=dt.date(2024, 1, 1) + dt.timedelta(days=i), store=store,
                        category=f"C{k}", product=product, unit_price=10.0 * (k + 1),
                        discount_pct=0.1, effective_price=9.0 * (k + 1), demand=demand,
                        actual_sales=demand, lost_sales=0, revenue=demand * 9.0 * (k + 1),
                        current_stock=200, reorder_point=50, reorder_qty=0, lead_time=6,
                        is_promotion=int(i % 9 == 0), stockout_flag=0,
                    )
                )
    frame = pd.DataFrame(rows)
    late = frame.iloc[[5]].assign(actual_sales=999)
    frame = pd.concat([frame, late], ignore_index=True)
    frame.loc[7, "category"] = None
    path = stage_path(spark, "raw_sales")
    df = spark.createDataFrame(frame, RAW_SALES).coalesce(1)
    write_table(df.selectExpr("*", "monotonically_increasing_id() AS row_no"), path)
    return path


def test_from_csv_to_stock_decisions(spark, raw_csv):
    raw = read_validated(spark, raw_csv)
    raw = raw.withColumn("row_no", raw["row_no"].cast("bigint"))
    panel = stage(preprocess(raw, order_by=["row_no"]))
    assert panel.count() == 4 * DAYS
    rows = panel.toPandas()
    assert rows["actual_sales"].max() < 999
    # Two closed days per series, next to days that never sell less than 20.
    assert (rows["actual_sales"] == 0).sum() == 8
    assert (rows["category"] == "Unknown").sum() == 1

    features = stage(build_features(panel)[0])
    assert features.count() == 4 * (DAYS - 7)
    result = run_forecast(
        features, days=3, forest={"trees": 5, "depth": 4}, boosted={"rounds": 3, "depth": 3}, replicas=5
    )
    assert result.forecast.count() == 12

    stock = run_inventory(panel, result.forecast, lead_time=6)
    folder = stage_path(spark, "outputs")
    write_inventory(stock, folder, fmt="csv")
    back = read_table(spark, f"{folder}/recommendations", schema=stock.recommendations.schema)
    assert back.count() == stock.recommendations.count() >= 4
    assert {r["risk_level"] for r in back.collect()} <= {"HIGH", "MEDIUM", "OVERSTOCK", "HEALTHY"}


def test_order_may_name_key_columns(spark, raw_csv):
    from shelf.operators.quality import dedupe_first

    raw = read_validated(spark, raw_csv)
    single = dedupe_first(raw, order_by=["date", "actual_sales"])
    assert single.columns == raw.columns and single.count() == raw.count() - 1
