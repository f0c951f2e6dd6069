"""Time-series features of the daily panel.

All windows partition by series and order by day, so one shuffle serves them
all. A panel has at most one row per series and day, which bounds a partition by
the number of days.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelf.functions.calendar import calendar_columns
from shelf.operators.running import ranged_running_total
from shelf.schema import SERIES
from shelf.staging import stage

LAGS = (1, 7, 14, 30)
WINDOWS = (7, 14, 30)

# The inputs of the demand models, in order.
MODEL_FEATURES = (
    "year", "month", "day", "day_of_week", "week_of_year",
    "quarter", "is_weekend", "is_month_start", "is_month_end",
    "day_of_year", "lag_1d", "lag_7d", "lag_14d", "lag_30d",
    "rolling_mean_7d", "rolling_mean_14d", "rolling_mean_30d",
    "rolling_std_7d", "rolling_std_14d",
    "expanding_mean",
    "is_promotion", "promo_x_weekend", "promo_lag1",
    "unit_price", "discount_pct",
    "store_enc", "category_enc", "product_enc",
)


def series_window(date: str = "date"):
    return Window.partitionBy(*SERIES).orderBy(date)


def date_features(
    df: DataFrame, *, date: str = "date", names: Sequence[str] | None = None
) -> DataFrame:
    made = calendar_columns(F.to_date(date))
    return df.withColumns({n: made[n] for n in (names or made)})


def lag_features(
    df: DataFrame, *, target: str = "actual_sales", lags: Sequence[int] = LAGS
) -> DataFrame:
    return df.withColumns({f"lag_{n}d": F.lag(target, n).over(series_window()) for n in lags})


def rolling_features(
    df: DataFrame, *, target: str = "actual_sales", windows: Sequence[int] = WINDOWS
) -> DataFrame:
    """Mean and sample deviation of the days before the current one.

    A started window already yields a mean; a deviation needs two days.
    """
    made = {}
    for days in windows:
        before = series_window().rowsBetween(-days, -1)
        made[f"rolling_mean_{days}d"] = F.avg(target).over(before)
        made[f"rolling_std_{days}d"] = F.stddev_samp(target).over(before)
    return df.withColumns(made)


def expanding_mean(
    df: DataFrame, *, target: str = "actual_sales", leak_free: bool = False
) -> DataFrame:
    """Mean of the series so far.

    The default includes the current day, the value a model is to predict;
    ``leak_free`` stops the day before.
    """
    last = -1 if leak_free else Window.currentRow
    so_far = series_window().rowsBetween(Window.unboundedPreceding, last)
    return df.withColumn("expanding_mean", F.avg(target).over(so_far))


def promo_features(df: DataFrame) -> DataFrame:
    """Promotion crossed with weekend and month, and the flag of the day before."""

    def calendar(name: str, default: int) -> Column:
        return F.col(name) if name in df.columns else F.lit(default)

    flag = F.col("is_promotion")
    yesterday = F.lag("is_promotion", 1).over(series_window())
    return df.withColumns(
        {
            "promo_x_weekend": flag * calendar("is_weekend", 0),
            "promo_x_month": flag * calendar("month", 1),
            "promo_lag1": F.coalesce(yesterday, F.lit(0)).cast("int"),
        }
    )


def first_appearance_codes(
    df: DataFrame,
    columns: Sequence[str] = ("store", "category", "product"),
    *,
    order_by: Sequence[str] = (*SERIES, "date"),
) -> DataFrame:
    """Table (column, value, code): values numbered from 0 as they first appear.

    One pass serves all columns. The first rows are found by a minimum
    aggregate; the numbering goes by ranges of the first rows.
    """
    entries = [
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns
    ]
    firsts = (
        df.select(*order_by, F.explode(F.array(*entries)).alias("e"))
        .where(F.col("e.value").isNotNull())
        .groupBy(F.col("e.column").alias("column"), F.col("e.value").alias("value"))
        .agg(F.min(F.struct(*order_by)).alias("_first"))
    )
    numbered = ranged_running_total(
        stage(firsts, "firsts"),
        {"code": F.lit(1)},
        partition_by=["column"],
        order_by=[F.col("_first"), F.col("value")],
    )
    return numbered.select("column", "value", (F.col("code") - 1).cast("int").alias("code"))


def attach_codes(df: DataFrame, codes: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``<column>_enc`` from a stored code table.

    The planner knows the size of a stored table and broadcasts it only when it
    is small.
    """
    for name in columns:
        mine = codes.where(F.col("column") == name).select(
            F.col("value").alias(name), F.col("code").alias(f"{name}_enc")
        )
        df = df.join(mine, name, "left")
    return df


def encode(
    df: DataFrame,
    columns: Sequence[str] = ("store", "category", "product"),
    *,
    order_by: Sequence[str] = (*SERIES, "date"),
) -> tuple[DataFrame, DataFrame]:
    """The rows with their codes, and the code table."""
    codes = stage(first_appearance_codes(df, columns, order_by=order_by), "codes")
    return attach_codes(df, codes, columns), codes


def _segment(zero_share: Column, mean: Column, low: Column, high: Column) -> Column:
    return (
        F.when(zero_share > 0.4, "INTERMITTENT")
        .when(mean >= high, "HIGH")
        .when(mean <= low, "LOW")
        .otherwise("MEDIUM")
    )


def demand_segments(df: DataFrame, *, target: str = "actual_sales") -> DataFrame:
    """One row per series with its demand segment."""
    value = F.col(target)
    stats = df.groupBy(*SERIES).agg(
        F.avg((value == 0).cast("int")).alias("zero_share"),
        F.avg(value).alias("mean"),
        F.percentile(value, 0.25).alias("q25"),
        F.percentile(value, 0.75).alias("q75"),
    )
    segment = _segment(F.col("zero_share"), F.col("mean"), F.col("q25"), F.col("q75"))
    return stats.withColumn("demand_segment", segment)


def segment_demand(df: DataFrame, *, target: str = "actual_sales") -> DataFrame:
    """Label each row with the segment of its series, inside the shared partitioning."""
    whole = Window.partitionBy(*SERIES)
    value = F.col(target)
    segment = _segment(
        F.avg((value == 0).cast("int")).over(whole),
        F.avg(value).over(whole),
        F.percentile(value, 0.25).over(whole),
        F.percentile(value, 0.75).over(whole),
    )
    return df.withColumn("demand_segment", segment)


def drop_warm_up(df: DataFrame) -> DataFrame:
    """Remove the first days of a series, which lack a weekly lag or a rolling mean."""
    return df.dropna(subset=["lag_7d", "rolling_mean_7d"])


def last_rows(df: DataFrame, days: int, *, date: str = "date") -> DataFrame:
    """The last ``days`` rows of each series."""
    latest = Window.partitionBy(*SERIES).orderBy(F.desc(date))
    return (
        df.withColumn("_rank", F.row_number().over(latest))
        .where(F.col("_rank") <= days)
        .drop("_rank")
    )
