"""Time the headline queries and print one JSON line.

The ``build_*`` entries time the stored tables that the other queries read: the
raw sales rows, the daily panel and the features. ``retail_view`` computes the
raw rows without storing them.
"""

from __future__ import annotations

import json
import os
import time

from catalog import tables
from catalog.queries import queries
from shelf.session import local_session

HEADLINES = (
    "retail_view daily_rollup fill_date_gaps dedupe_first cap_outliers impute preprocess "
    "dataset_summary column_profile sales_trend category_month store_performance "
    "seasonality_pivot promotion_impact top_products target_correlation lag_features "
    "rolling_features expanding_mean demand_segments category_codes abc_analysis abc_parts "
    "inventory_recommendations reorder_alerts business_kpis time_split naive_metrics "
    "future_features model_comparison test_predictions future_forecast arima_forecast"
).split()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, shuffle_partitions=int(cores))
    registry = queries()

    def run(name: str) -> None:
        registry[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    # The first job starts Python and the code generator.
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {
        "build_raw": timed(lambda: tables.raw(spark, sf_dir)),
        "build_panel": timed(lambda: tables.panel(spark, sf_dir)),
        "build_features": timed(lambda: tables.features(spark, sf_dir)),
        "fit_models": timed(lambda: tables.models(spark, sf_dir)),
    }
    for name in HEADLINES:
        seconds[name] = timed(lambda: run(name))
    report = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
    }
    print(json.dumps(report))


if __name__ == "__main__":
    main()
