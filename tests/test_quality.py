import datetime as dt

import numpy as np
import pandas as pd
import pytest
from conftest import day, ordered
from pyspark.sql import functions as F

from shelf.operators import quality
from shelf.operators.rollup import daily_rollup
from shelf.schema import MissingColumns, validate_columns


def test_impute_fills_median_and_label(spark):
    rows = [
        (day("2024-01-01"), "a", 1.0), (day("2024-01-02"), None, 3.0),
        (day("2024-01-03"), "b", None), (None, "c", 100.0),
    ]
    got = quality.impute(spark.createDataFrame(rows, "date date, store string, x double"))
    rows = ordered(got, "date")
    assert rows["store"].tolist() == ["a", "Unknown", "b"]
    # The row without a date counts for nothing, not even for the median.
    assert rows["x"].tolist() == [1.0, 3.0, 2.0]


def test_validation_names_every_missing_column(panel):
    with pytest.raises(MissingColumns) as error:
        validate_columns(panel.drop("demand", "discount_pct"))
    assert error.value.missing == ["demand", "discount_pct"]
    assert validate_columns(panel) is panel


def test_fix_types_truncates(spark):
    df = spark.createDataFrame([("2024-02-29", 2.9, 1.0)], "date string, demand double, is_promotion double")
    row = quality.fix_types(df).first()
    assert row == (dt.date(2024, 2, 29), 2, 1)


def test_dedupe_keeps_first_by_order(spark):
    rows = [(day("2024-01-01"), "s", "p", seq, sales) for seq, sales in [(3, 30), (1, 10), (2, 20)]]
    rows.append((day("2024-01-02"), "s", "p", 9, 90))
    df = spark.createDataFrame(rows, "date date, store string, product string, seq int, sales int")
    got = ordered(quality.dedupe_first(df.repartition(4), order_by=["seq"]), "date")
    assert got["sales"].tolist() == [10, 90]


def test_dedupe_keeps_null_values_of_the_first_row(spark):
    rows = [("s", 1, None), ("s", 2, 5)]
    df = spark.createDataFrame(rows, "store string, seq int, v int")
    got = quality.dedupe_first(df, order_by=["seq"], keys=["store"]).collect()
    assert got == [("s", 1, None)]


def test_cap_outliers_and_counts(spark):
    values = [*range(1, 21), 1000]
    df = spark.createDataFrame([(float(v), None if v == 3 else float(v)) for v in values], "x double, y double")
    q1, q3 = np.quantile(values, [0.25, 0.75])
    upper = q3 + 3 * (q3 - q1)
    capped = quality.cap_outliers(df, ["x", "y"]).toPandas()
    assert capped["x"].max() == upper and capped["x"].min() == 1
    assert capped["y"].isna().sum() == 1
    counts = quality.outlier_counts(df, ["x", "y"]).toPandas().set_index("column")
    assert counts.loc["x", "outliers"] == 1 and counts.loc["x", "upper"] == upper


GAPS = "date date, store string, product string, category string, unit_price double, current_stock int, actual_sales int, note string"


def test_gap_fill(spark):
    rows = [
        (day("2024-01-01"), "s", "p", "c", 5.0, 9, 3, "x"),
        (day("2024-01-02"), "s", "p", "c", None, 8, 4, "y"),
        (day("2024-01-05"), "s", "p", "c", 6.0, None, None, "z"),
        (day("2024-03-01"), "s", "q", "d", 1.0, 1, 1, "w"),
    ]
    got = ordered(quality.fill_date_gaps(spark.createDataFrame(rows, GAPS)), "product", "date")
    p = got[got["product"] == "p"]
    assert len(p) == 5 and len(got) == 6
    assert p["actual_sales"].tolist() == [3, 4, 0, 0, 0]
    assert p["unit_price"].tolist() == [5.0, 5.0, 5.0, 5.0, 6.0]
    assert p["current_stock"].tolist() == [9, 8, 8, 8, 8]
    assert p["note"].tolist()[:2] == ["x", "y"] and p["note"].isna().tolist() == [False, False, True, True, False]
    assert p["category"].tolist() == ["c"] * 5


def test_gap_fill_equals_pandas(spark, random_panel):
    holes = random_panel.sample(frac=0.6, random_state=1)
    got = ordered(quality.fill_date_gaps(spark.createDataFrame(holes)), "store", "product", "date")
    parts = []
    for (store, product), g in holes.groupby(["store", "product"]):
        g = g.assign(date=pd.to_datetime(g["date"])).set_index("date").sort_index().asfreq("D")
        g["store"], g["product"] = store, product
        g[["category", "unit_price", "current_stock"]] = g[["category", "unit_price", "current_stock"]].ffill()
        zero = ["actual_sales", "demand", "revenue", "is_promotion", "stockout_flag", "discount_pct"]
        g[zero] = g[zero].fillna(0)
        parts.append(g.reset_index())
    want = pd.concat(parts).sort_values(["store", "product", "date"]).reset_index(drop=True)
    assert len(got) == len(want)
    for c in got.columns:
        left = pd.to_datetime(got[c]) if c == "date" else got[c]
        assert (left == want[c]).all(), c


def test_gap_fill_keeps_duplicate_days(spark):
    rows = [(day("2024-01-01"), "s", "p", "c", 1.0, 1, v, "n") for v in (1, 2)]
    assert quality.fill_date_gaps(spark.createDataFrame(rows, GAPS)).count() == 2


def test_gap_fill_takes_one_shuffle(panel):
    plan = quality.fill_date_gaps(panel)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_observed_counts_without_a_job(spark):
    df = spark.createDataFrame([(1,), (None,)], "x int")
    watched, seen = quality.observed(df, "seen")
    watched.collect()
    assert seen.get == {"rows": 2, "null_x": 1}


def test_missing_counts(spark):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b int").withColumn("c", F.lit(1))
    assert {tuple(r) for r in quality.missing_counts(df).collect()} == {("a", 1), ("b", 2)}


def test_rollup_first_and_last_skip_nulls(spark):
    rows = [
        (day("2024-01-01"), "s", "c", "p", 1, 1, 2.0, 50, 0, 0, None, 0.1, 1),
        (day("2024-01-01"), "s", "c", "p", 2, 3, 4.0, 40, 1, 0, 7.0, 0.3, 2),
        (day("2024-01-01"), "s", "c", "p", 4, 4, 6.0, None, 0, 1, 8.0, 0.2, 3),
    ]
    schema = (
        "date date, store string, category string, product string, actual_sales int, demand int, "
        "revenue double, current_stock int, is_promotion int, stockout_flag int, unit_price double, "
        "discount_pct double, seq int"
    )
    row = daily_rollup(spark.createDataFrame(rows, schema).repartition(3), order_by=["seq"]).first()
    assert (row["actual_sales"], row["demand"], row["revenue"]) == (7, 8, 12.0)
    assert (row["unit_price"], row["current_stock"]) == (7.0, 40)
    assert (row["is_promotion"], row["stockout_flag"]) == (1, 1)
    assert row["discount_pct"] == pytest.approx(0.2)


def test_nan_counts_as_missing(spark):
    df = spark.createDataFrame(
        [(day("2024-01-01"), v) for v in (1.0, 2.0, float("nan"), None)], "date date, x double"
    )
    values = [r["x"] for r in quality.impute(df, numeric=["x"]).collect()]
    assert sorted(values) == [1.0, 1.5, 1.5, 2.0]
    assert [r["missing"] for r in quality.missing_counts(df).collect()] == [2]
