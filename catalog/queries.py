"""Registered queries: name -> callable(spark, sf_dir) -> DataFrame."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import tables as t
from catalog.oracle import shift
from shelf.functions.numeric import non_negative
from shelf.operators import features as feat
from shelf.operators import forecast as fc
from shelf.operators import inventory as inv
from shelf.operators import promotions, quality, reports
from shelf.operators.arima import arima_by_series
from shelf.operators.arima import arima_metrics as by_series_metrics
from shelf.operators.measures import residual
from shelf.operators.partitioning import by_series
from shelf.operators.rollup import daily_rollup
from shelf.plans.forecast import BOOSTED, FOREST, NAIVE, scored_test
from shelf.plans.inventory import run_inventory, write_inventory
from shelf.plans.preprocess import preprocess, preprocess_audited
from shelf.schema import present
from shelf.sources.io import export_filtered, read_table, read_with_rejects, write_series_table, write_table
from shelf.sources.retail import SEQ, retail_sales
from shelf.staging import stage, stage_path

Query = Callable[[SparkSession, str], DataFrame]
_registry: dict[str, Query] = {}


def rounded(df: DataFrame, digits: int = 6, **own: int) -> DataFrame:
    """Round double columns so that the order of float sums does not show.

    The shift keeps decimal halves away from the rounding boundary.
    """
    doubles = [f.name for f in df.schema.fields if f.dataType.simpleString() == "double"]

    def near(name: str):
        places = own.get(name, digits)
        return F.round(F.col(name) + shift(places), places)

    return df.withColumns({c: near(c) for c in doubles})


def query(digits: int | None = 6, *, name: str | None = None, **own: int):
    """Register a query; its double columns are rounded to ``digits`` or as named."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            df = build(spark, sf_dir)
            return df if digits is None else rounded(df, digits, **own)

        _registry[name or build.__name__] = run
        return build

    return register


def queries() -> dict[str, Query]:
    return dict(_registry)


KEYS = ("date", "store", "product")


# --- sources and sinks -------------------------------------------------------


@query()
def retail_view(spark, d):
    return retail_sales(spark, d)


@query(revenue=4)
def csv_round_trip(spark, d):
    panel = t.panel(spark, d)
    path = stage_path(spark, "panel_csv")
    write_table(panel, path)
    return read_table(spark, path, schema=panel.schema)


@query()
def filtered_export(spark, d):
    columns = (
        "store", "product", "category", "abc_class", "current_stock", "safety_stock",
        "reorder_point", "eoq", "stockout_rate_pct", "risk_level",
    )
    table = t.stock_table(spark, d)
    path = stage_path(spark, "report")
    export_filtered(table, path, columns, risk_level=("HIGH", "MEDIUM"), abc_class=("A", "B"))
    return read_table(spark, path, schema=table.select(*columns).schema)


# --- cleaning ----------------------------------------------------------------


def nulled(spark, d):
    """Raw rows with values knocked out at fixed places, to give cleaning some work."""

    def without(name: str, every: int):
        return F.when(F.col("l_orderkey") % every != 0, F.col(name))

    return t.raw(spark, d).withColumns(
        {
            "date": without("date", 29),
            "unit_price": without("unit_price", 17),
            "actual_sales": without("actual_sales", 19),
            "category": without("category", 23),
        }
    )


@query()
def impute(spark, d):
    return quality.impute(nulled(spark, d), keys=SEQ)


@query()
def fix_types(spark, d):
    return quality.fix_types(quality.impute(nulled(spark, d), keys=SEQ))


@query()
def dedupe_first(spark, d):
    return quality.dedupe_first(t.raw(spark, d), order_by=SEQ)


@query()
def cap_outliers(spark, d):
    return quality.cap_outliers(t.raw(spark, d), multiplier=0.25)


@query()
def outlier_counts(spark, d):
    return quality.outlier_counts(t.raw(spark, d), multiplier=0.25)


@query(revenue=4)
def fill_date_gaps(spark, d):
    daily = daily_rollup(t.raw(spark, d), order_by=SEQ)
    return quality.fill_date_gaps(daily, zeroed=(*quality.ZEROED, "lost_sales"))


@query()
def missing_columns(spark, d):
    return quality.missing_counts(nulled(spark, d))


@query()
def quality_audit(spark, d):
    rows = nulled(spark, d)
    unique = quality.drop_null_dates(rows).select(*quality.KEY).distinct()
    kept = unique.agg(F.count(F.lit(1))).scalar()
    counts = rows.agg(
        F.count(F.lit(1)).alias("rows_in"), F.count_if(F.col("date").isNull()).alias("null_dates")
    )
    return counts.withColumn("rows_out", kept).withColumn(
        "duplicates", F.col("rows_in") - F.col("null_dates") - F.col("rows_out")
    )


@query(name="preprocess")
def clean_rows(spark, d):
    return preprocess(nulled(spark, d), order_by=SEQ)


@query()
def preprocess_audit(spark, d):
    return preprocess_audited(nulled(spark, d), order_by=SEQ)[1]


def _damaged(spark, d):
    """A CSV export of the raw rows with text in number columns and dates at fixed places."""
    def with_text(name: str, every: int, text: str):
        return F.when(F.col("l_orderkey") % every == 0, F.lit(text)).otherwise(F.col(name).cast("string")).alias(name)

    broken = {"date": with_text("date", 31, "yesterday"), "demand": with_text("demand", 37, "many"),
              "unit_price": with_text("unit_price", 41, "12,50")}
    rows = t.raw(spark, d)
    path = stage_path(spark, "damaged_csv")
    write_table(rows.select(*[broken.get(c, F.col(c)) for c in rows.columns]), path)
    return read_with_rejects(spark, path)


@query()
def accepted_rows(spark, d):
    accepted, _ = _damaged(spark, d)
    return accepted.groupBy("store").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("demand").alias("demand"), F.min("date").alias("first_date"),
        F.max("date").alias("last_date"), F.avg("unit_price").alias("unit_price"),
    )


@query()
def rejected_rows(spark, d):
    _, rejected = _damaged(spark, d)
    return rejected.select(
        "l_orderkey", "l_linenumber", "date", "demand", F.array_join("_problems", " ").alias("problems")
    )


# --- roll-up and reports -----------------------------------------------------


@query(name="daily_rollup", revenue=4)
def rollup(spark, d):
    return daily_rollup(t.raw(spark, d), order_by=SEQ)


@query(total_revenue=2)
def dataset_summary(spark, d):
    return reports.dataset_summary(t.raw(spark, d))


@query()
def sales_trend(spark, d):
    return reports.trend(t.panel(spark, d))


@query(4)
def revenue_trend(spark, d):
    return reports.trend(t.panel(spark, d), "revenue", 7)


@query()
def category_month(spark, d):
    return reports.category_month(t.panel(spark, d))


@query(total_revenue=2)
def category_totals(spark, d):
    return reports.performance(t.panel(spark, d), "category")


@query()
def category_share(spark, d):
    return reports.volume_share(t.panel(spark, d))


@query(total_revenue=2)
def store_performance(spark, d):
    return reports.performance(t.panel(spark, d), "store")


@query()
def monthly_totals(spark, d):
    return reports.monthly_totals(t.panel(spark, d))


@query()
def weekday_mean(spark, d):
    return reports.weekday_mean(t.panel(spark, d))


@query()
def promotion_impact(spark, d):
    return reports.promotion_impact(t.raw(spark, d))


@query()
def promo_uplift(spark, d):
    return reports.promo_uplift(t.panel(spark, d))


@query()
def box_stats(spark, d):
    return reports.box_stats(t.raw(spark, d))


@query()
def column_profile(spark, d):
    profile = reports.column_profile(nulled(spark, d))
    is_date = F.col("column") == "date"
    ends = {f"{c}_date": F.when(is_date, F.col(c)) for c in ("min", "max")}
    ends |= {f"{c}_number": F.when(~is_date, F.col(c)).cast("double") for c in ("min", "max")}
    return profile.withColumns(ends).drop("min", "max")


@query(total_revenue=2)
def kpi_overview(spark, d):
    return reports.kpi_overview(t.panel(spark, d))


@query()
def distinct_values(spark, d):
    return reports.distinct_values(t.panel(spark, d), ("store", "category", "product"))


@query()
def seasonality_pivot(spark, d):
    return reports.seasonality_pivot(t.panel(spark, d))


@query(2)
def top_products(spark, d):
    return reports.top_products(t.panel(spark, d))


@query()
def filtered_sales(spark, d):
    return reports.monthly_totals(
        reports.filter_sales(t.panel(spark, d), store="ASIA", category="CAT_1")
    )


@query()
def series_history(spark, d):
    return reports.history(t.panel(spark, d), "ASIA", "Brand#11")


@query()
def last_rows(spark, d):
    return feat.last_rows(t.panel(spark, d), 60).select(*KEYS, "actual_sales")


@query()
def target_correlation(spark, d):
    return reports.target_correlation(t.features(spark, d))


# --- features ----------------------------------------------------------------


@query()
def date_features(spark, d):
    return feat.date_features(t.panel(spark, d).select(*KEYS))


@query()
def lag_features(spark, d):
    return feat.lag_features(t.panel(spark, d).select(*KEYS, "actual_sales"))


@query()
def bucketed_lags(spark, d):
    """Lags over a panel that is stored by series, without an exchange."""
    name = f"series_panel_{uuid.uuid4().hex}"
    panel = write_series_table(t.panel(spark, d).select(*KEYS, "actual_sales"), name, stage_path(spark, name), buckets=8)
    return feat.lag_features(panel)


@query(8)
def rolling_features(spark, d):
    panel = t.panel(spark, d).select(*KEYS, "actual_sales")
    return feat.rolling_features(by_series(panel)).drop("actual_sales")


@query(9)
def expanding_mean(spark, d):
    panel = t.panel(spark, d).select(*KEYS, "actual_sales")
    return feat.expanding_mean(panel).drop("actual_sales")


@query(9)
def expanding_mean_leak_free(spark, d):
    panel = t.panel(spark, d).select(*KEYS, "actual_sales")
    return feat.expanding_mean(panel, leak_free=True).drop("actual_sales")


@query()
def promo_features(spark, d):
    dated = feat.date_features(t.panel(spark, d))
    return feat.promo_features(dated).select(
        *KEYS, "promo_x_weekend", "promo_x_month", "promo_lag1"
    )


@query()
def category_codes(spark, d):
    return feat.first_appearance_codes(t.panel(spark, d))


@query(8)
def demand_segments(spark, d):
    return feat.demand_segments(t.panel(spark, d))


@query(8, revenue=4)
def features(spark, d):
    return t.features(spark, d)


@query()
def season_factor(spark, d):
    # The driver's categories take over the factors of the known ones, in order.
    seasons = {f"CAT_{i}": months for i, months in enumerate(promotions.SEASONS.values())}
    return promotions.season_factor(t.panel(spark, d), seasons).select(*KEYS, "season_factor")


@query()
def promo_calendar(spark, d):
    return promotions.promo_calendar(t.panel(spark, d)).select(*KEYS, "is_sale", "sale_discount")


# --- stock -------------------------------------------------------------------


@query(total_revenue=2)
def abc_analysis(spark, d):
    return inv.abc_analysis(t.raw(spark, d))


@query(total_revenue=2)
def abc_rounded(spark, d):
    return inv.abc_analysis(t.raw(spark, d), pct_scale=2)


@query(total_revenue=2)
def abc_parts(spark, d):
    return inv.abc_analysis(t.raw(spark, d), keys=("l_partkey", "category"))


@query(total_revenue=2)
def abc_summary(spark, d):
    return inv.abc_summary(inv.abc_analysis(t.raw(spark, d)))


@query(total_revenue=2)
def inventory_recommendations(spark, d):
    return t.stock_table(spark, d)


@query(total_revenue=2)
def inventory_by_forecast(spark, d):
    return t.stock_table(spark, d, ordering_cost=5e6, demand_source="forecast")


@query()
def reorder_alerts(spark, d):
    return inv.reorder_alerts(t.stock_table(spark, d))


@query()
def reorder_labels(spark, d):
    return inv.reorder_labels(t.stock_table(spark, d))


@query()
def risk_distribution(spark, d):
    return reports.value_counts(t.stock_table(spark, d), "risk_level")


@query()
def status_counts(spark, d):
    return inv.status_counts(t.stock_table(spark, d, ordering_cost=5e6))


@query()
def inventory_averages(spark, d):
    return inv.inventory_averages(t.stock_table(spark, d))


@query(total_revenue=2)
def inventory_files(spark, d):
    """The plan from panel and forecast to its files, read back."""
    folder = stage_path(spark, "inventory")
    write_inventory(run_inventory(t.panel(spark, d), t.recent_forecast(spark, d), ordering_cost=5e6), folder, fmt="parquet")
    return read_table(spark, f"{folder}/recommendations", fmt="parquet")


@query()
def stock_levels(spark, d):
    return inv.stock_levels(t.stock_table(spark, d))


@query()
def stockout_by_category(spark, d):
    return inv.stockout_by_category(t.stock_table(spark, d))


@query(None)
def business_kpis(spark, d):
    return inv.business_kpis(t.raw(spark, d), t.stock_table(spark, d))


@query(None)
def business_kpis_by_day(spark, d):
    """The KPIs of the documented flow, over the daily panel."""
    return inv.business_kpis(t.panel(spark, d), t.stock_table(spark, d))


# --- forecasting -------------------------------------------------------------


@query()
def time_split(spark, d):
    train, test = fc.time_split(t.features(spark, d))

    def part(df, name):
        return df.agg(
            F.lit(name).alias("part"), F.count(F.lit(1)).alias("rows"),
            F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        )

    return part(train, "train").unionByName(part(test, "test"))


def _naive(spark, d, per_series: bool):
    train, test = fc.time_split(t.features(spark, d))
    return fc.naive_forecast(train, test, per_series=per_series)


@query()
def naive_metrics(spark, d):
    return fc.metrics(_naive(spark, d, False), NAIVE)


@query()
def naive_series_metrics(spark, d):
    return fc.metrics(_naive(spark, d, True), "Naive Series")


@query()
def naive_residuals(spark, d):
    """What the forecast of each test row misses, and the forecast cut at zero."""
    rows = residual(_naive(spark, d, True)).withColumn("clamped", non_negative(F.col("residual")))
    return rows.select(*KEYS, "actual_sales", "predicted_sales", "residual", "clamped")


@query()
def metrics_by_store(spark, d):
    return fc.metrics(_naive(spark, d, True), "Naive Series", by=["store"])


@query()
def baseline_improvement(spark, d):
    comparison = fc.compare(
        fc.metrics(_naive(spark, d, False), NAIVE),
        fc.metrics(_naive(spark, d, True), "Naive Series"),
    )
    return fc.improvement(comparison, NAIVE)


@query()
def forecast_vs_actual(spark, d):
    return reports.forecast_vs_actual(_naive(spark, d, True))


@query()
def residual_stats(spark, d):
    return reports.residual_stats(_naive(spark, d, True))


@query(8)
def future_features(spark, d):
    future = fc.future_features(t.features(spark, d))
    return future.select("store", "product", "category", "date", *present(future, feat.MODEL_FEATURES))


@query()
def jittered_features(spark, d):
    """The noisy copies of the test rows that intervals are made of."""
    _, test = fc.time_split(t.features(spark, d))
    return fc.jittered(test, fc.feature_names(test), replicas=2)


# The trained models have no SQL twin; these queries are checked by row counts and tests.


@query(None)
def test_predictions(spark, d):
    _, test = fc.time_split(t.features(spark, d))
    return scored_test(test, t.model(spark, d, FOREST))


@query(None)
def feature_importance(spark, d):
    return fc.feature_importance(spark, t.model(spark, d, FOREST), 15)


@query(None)
def model_comparison(spark, d):
    train, test = fc.time_split(t.features(spark, d))
    rows = [fc.metrics(fc.naive_forecast(train, test), NAIVE)]
    rows += [fc.metrics(fc.predict(test, m), n) for n, m in t.models(spark, d).items()]
    return fc.compare(*rows)


@query(None)
def model_improvement(spark, d):
    return fc.improvement(stage(_registry["model_comparison"](spark, d), "comparison"), NAIVE)


@query(None)
def future_forecast(spark, d):
    model = t.model(spark, d, BOOSTED)
    return fc.future_forecast(t.features(spark, d), model, model_name=BOOSTED)


@query(None)
def arima_forecast(spark, d):
    return arima_by_series(t.panel(spark, d))


@query(None)
def arima_metrics(spark, d):
    return by_series_metrics(arima_by_series(t.panel(spark, d)))
