"""Stock decisions per series: class, thresholds, risk and priority."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelf.functions import stock
from shelf.functions.numeric import percent
from shelf.operators.running import ranged_running_total
from shelf.schema import SERIES
from shelf.staging import stage

GRAIN = (*SERIES, "category")
ASSUMED_RATE = 0.6


def product_revenue(df: DataFrame, keys: Sequence[str] = ("product", "category")) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.sum("revenue").alias("total_revenue"),
        F.sum("actual_sales").alias("total_units"),
        F.avg("unit_price").alias("avg_unit_price"),
    )


def abc_analysis(
    df: DataFrame,
    *,
    a: float = 0.70,
    b: float = 0.90,
    pct_scale: int | None = None,
    keys: Sequence[str] = ("product", "category"),
    ranges: int | None = None,
) -> DataFrame:
    """Class products by their place in the revenue ranking.

    A product belongs to A while the revenue share up to and including it stays
    within ``a``, to B within ``b``, else to C; so a product that passes ``a``
    alone is not in A. ``pct_scale`` rounds shares before they are summed: with
    many products small shares then vanish, hence the exact default. ``ranges``
    cuts the ranking, by size if not given.
    """
    revenue = stage(product_revenue(df, keys), "product_revenue")
    whole = revenue.agg(F.sum("total_revenue")).scalar()
    exact = percent(F.col("total_revenue"), whole)
    share = exact if pct_scale is None else F.bround(exact, pct_scale)
    ranked = ranged_running_total(
        revenue.withColumn("revenue_pct", share),
        {"cumulative_pct": F.col("revenue_pct")},
        order_by=[F.desc("total_revenue"), *[F.col(k) for k in keys]],
        ranges=ranges,
    )
    if pct_scale is not None:
        ranked = ranked.withColumn("cumulative_pct", F.bround("cumulative_pct", pct_scale))
    return ranked.withColumn("abc_class", stock.abc_class(F.col("cumulative_pct"), a, b))


def abc_summary(abc: DataFrame) -> DataFrame:
    """Products, revenue and revenue share by class."""
    return abc.groupBy("abc_class").agg(
        F.count(F.lit(1)).alias("num_products"),
        F.sum("total_revenue").alias("total_revenue"),
        F.sum("revenue_pct").alias("revenue_pct"),
    )


def series_stats(df: DataFrame, *, order_by: Sequence[str] = ("date",)) -> DataFrame:
    """Demand, revenue, first price, last stock and stockout figures per series.

    Prices and stocks that are null are passed over when the first and the last
    are picked.
    """
    order = F.col(order_by[0]) if len(order_by) == 1 else F.struct(*order_by)

    def known(value: str) -> Column:
        return F.when(F.col(value).isNotNull(), order)

    stats = df.groupBy(*GRAIN).agg(
        F.avg("actual_sales").alias("avg_daily_demand"),
        F.coalesce(F.stddev_samp("actual_sales"), F.lit(0.0)).alias("std_daily_demand"),
        F.sum("actual_sales").alias("total_units_sold"),
        F.sum("revenue").alias("total_revenue"),
        F.min_by("unit_price", known("unit_price")).alias("unit_price"),
        F.max_by("current_stock", known("current_stock")).alias("current_stock"),
        F.sum("stockout_flag").alias("stockout_count"),
        F.count("date").alias("total_days"),
    )
    rate = percent(F.col("stockout_count"), F.col("total_days"))
    return stats.withColumn("stockout_rate_pct", F.bround(rate, 2))


def forecast_mean(forecast: DataFrame) -> DataFrame:
    return forecast.groupBy(*SERIES).agg(F.avg("forecast_qty").alias("forecast_avg_daily"))


def attach_forecast(stats: DataFrame, forecast: DataFrame) -> DataFrame:
    """Add the mean forecast; a series without one keeps its historical mean."""
    joined = stats.join(forecast_mean(forecast), list(SERIES), "left")
    return joined.withColumn(
        "forecast_avg_daily", F.coalesce("forecast_avg_daily", "avg_daily_demand")
    )


def stock_thresholds(
    df: DataFrame,
    *,
    lead_time: Column | float = 7,
    z: float = 1.65,
    ordering_cost: float = 50.0,
    holding_rate: float = 0.25,
    demand: str = "avg_daily_demand",
) -> DataFrame:
    """Safety stock, reorder point and order quantity; ``lead_time`` may be a column."""
    mean = F.col(demand)
    return (
        df.withColumn("safety_stock", stock.safety_stock(F.col("std_daily_demand"), lead_time, z))
        .withColumn("reorder_point", stock.reorder_point(mean, lead_time, F.col("safety_stock")))
        .withColumn(
            "eoq",
            stock.order_quantity(mean * 365, F.col("unit_price"), ordering_cost, holding_rate),
        )
    )


def assess_stock(
    df: DataFrame, *, holding_rate: float = 0.25, demand: str = "avg_daily_demand"
) -> DataFrame:
    """Flags, risk level, holding cost and the order to place."""
    on_hand, rop, eoq = F.col("current_stock"), F.col("reorder_point"), F.col("eoq")
    buffer = F.col("safety_stock")
    overstock = on_hand > rop + eoq * 1.5
    at_risk = on_hand <= rop
    daily_cost = on_hand * F.col("unit_price") * holding_rate / 365
    return df.withColumns(
        {
            "days_of_stock": F.bround(stock.days_of_stock(on_hand, F.col(demand)), 1),
            "stockout_risk": at_risk,
            "overstock_flag": overstock,
            "low_stock_flag": on_hand <= buffer,
            "risk_level": stock.risk_level(on_hand, buffer, rop, overstock),
            "holding_cost_daily": F.bround(daily_cost, 2),
            "recommended_order": F.when(at_risk, F.bround(eoq, 0)).otherwise(0.0),
        }
    )


def prioritise(df: DataFrame, abc: DataFrame) -> DataFrame:
    """Add the class of the product and the scores; unknown products count as C."""
    classes = abc.select("product", "category", "abc_class")
    return (
        df.join(classes, ["product", "category"], "left")
        .withColumn("abc_class", F.coalesce("abc_class", F.lit("C")))
        .withColumns(
            {
                "abc_score": stock.lookup(F.col("abc_class"), stock.ABC_SCORES, 1),
                "risk_score": stock.lookup(F.col("risk_level"), stock.RISK_SCORES, 0),
            }
        )
        .withColumn("priority_score", F.col("abc_score") + F.col("risk_score"))
    )


# Columns shown with two decimals.
TWO_DECIMALS = ("avg_daily_demand", "std_daily_demand", "current_stock")

DEMAND_SOURCES = {"history": "avg_daily_demand", "forecast": "forecast_avg_daily"}


def recommendations(
    df: DataFrame,
    forecast: DataFrame,
    *,
    abc: DataFrame | None = None,
    lead_time: Column | float = 7,
    z: float = 1.65,
    ordering_cost: float = 50.0,
    holding_rate: float = 0.25,
    demand_source: str = "history",
    order_by: Sequence[str] = ("date",),
) -> DataFrame:
    """One row per series with thresholds, status, class and priority, most urgent first.

    ``demand_source="forecast"`` sets thresholds from the forecast mean.
    """
    demand = DEMAND_SOURCES[demand_source]
    abc = abc_analysis(df) if abc is None else abc
    table = attach_forecast(series_stats(df, order_by=order_by), forecast)
    table = stock_thresholds(
        table, lead_time=lead_time, z=z, ordering_cost=ordering_cost,
        holding_rate=holding_rate, demand=demand,
    )
    table = prioritise(assess_stock(table, holding_rate=holding_rate, demand=demand), abc)
    return (
        table.withColumns({c: F.bround(F.col(c).cast("double"), 2) for c in TWO_DECIMALS})
        .orderBy(F.desc("priority_score"), *GRAIN)
    )


def _urgent(inv: DataFrame) -> DataFrame:
    order = [F.desc("priority_score"), *GRAIN]
    return inv.where(F.col("stockout_risk")).orderBy(*order)


def reorder_alerts(inv: DataFrame, n: int = 20) -> DataFrame:
    """The most urgent series at or below their reorder point."""
    return _urgent(inv).limit(n).select(
        "store", "product", "abc_class", "current_stock", "reorder_point", "eoq", "risk_level"
    )


def reorder_labels(inv: DataFrame, n: int = 15) -> DataFrame:
    """Short label and order quantity of the most urgent series."""
    label = F.concat_ws(" | ", "product", F.substring("store", -3, 3))
    return _urgent(inv).limit(n).select(label.alias("label"), "eoq")


def status_counts(inv: DataFrame) -> DataFrame:
    level = F.col("risk_level")
    return inv.agg(
        F.count_if("stockout_risk").alias("reorder_now"),
        F.count_if(level == "MEDIUM").alias("monitor"),
        F.count_if("overstock_flag").alias("overstock"),
        F.count_if(level == "HEALTHY").alias("healthy"),
    )


def inventory_averages(inv: DataFrame) -> DataFrame:
    return inv.agg(
        F.avg("safety_stock").alias("avg_safety_stock"), F.avg("eoq").alias("avg_eoq")
    )


def stock_levels(inv: DataFrame) -> DataFrame:
    """Mean stock and thresholds by product."""
    return inv.groupBy("product").agg(
        *[F.avg(c).alias(c) for c in ("current_stock", "safety_stock", "reorder_point")]
    )


def stockout_by_category(inv: DataFrame) -> DataFrame:
    return (
        inv.groupBy("category")
        .agg(F.avg("stockout_rate_pct").alias("stockout_rate_pct"))
        .orderBy(F.desc("stockout_rate_pct"), "category")
    )


def business_kpis(
    df: DataFrame,
    inv: DataFrame,
    *,
    stockout_reduction: float = ASSUMED_RATE,
    recovery: float = ASSUMED_RATE,
) -> DataFrame:
    """One row of figures before and after the stock policy.

    The reduction of stockouts and the share of lost revenue won back are
    assumptions. Facts without ``lost_sales`` count as losing nothing.
    """
    lost = F.col("lost_sales") if "lost_sales" in df.columns else F.lit(0)
    facts = df.agg(
        percent(F.sum("stockout_flag"), F.count("stockout_flag")).alias("rate"),
        F.coalesce(F.sum(lost), F.lit(0)).cast("bigint").alias("lost_units"),
        F.coalesce(F.sum(lost * F.col("unit_price")), F.lit(0.0)).alias("lost_revenue"),
        F.sum("revenue").alias("revenue"),
    )
    per_series = inv.agg(
        F.struct(
            F.count(F.lit(1)).alias("pairs"),
            F.count_if("stockout_risk").alias("high"),
            F.count_if("overstock_flag").alias("over"),
            F.avg(F.col("current_stock") * F.col("unit_price")).alias("value"),
        )
    ).scalar()
    value = F.col("_inv.value")
    turnover = F.when(value > 0, F.try_divide("revenue", value)).otherwise(0.0)
    return facts.withColumn("_inv", per_series).select(
        F.col("_inv.pairs").alias("store_product_pairs"),
        F.bround("rate", 2).alias("stockout_rate_before_pct"),
        F.bround(F.col("rate") * (1 - stockout_reduction), 2).alias("stockout_rate_after_pct"),
        F.col("_inv.high").alias("high_risk_items"),
        F.col("_inv.over").alias("overstock_items"),
        F.col("lost_units").alias("total_lost_units"),
        F.bround("lost_revenue", 0).alias("estimated_lost_revenue"),
        F.bround(F.col("lost_revenue") * recovery, 0).alias("projected_recovery"),
        F.bround(turnover, 2).alias("inventory_turnover"),
        F.bround("revenue", 0).alias("total_revenue"),
    )
