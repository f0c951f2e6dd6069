"""Season factors and the sale calendar as lookup joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Demand multiplier by category and month; other months count 1.0.
SEASONS = {
    "Electronics": {10: 1.8, 11: 2.2, 12: 2.0, 1: 1.3},
    "Grocery": {10: 1.4, 11: 1.3, 4: 1.2, 8: 1.2},
    "Clothing": {10: 1.9, 11: 1.8, 2: 1.5, 9: 1.4},
    "Home & Kitchen": {10: 1.6, 11: 1.5, 1: 1.3},
    "Personal Care": {4: 1.3, 5: 1.3, 6: 1.2},
}
WEEKEND_FACTOR = 1.25

# Sale events as (month, day, discount); each lasts SALE_REACH days either side.
SALES = (
    (1, 26, 0.20),
    (3, 10, 0.15),
    (8, 15, 0.18),
    (10, 24, 0.30),
    (11, 11, 0.35),
    (12, 25, 0.25),
)
SALE_REACH = 3


def season_table(spark: SparkSession, seasons: dict[str, dict[int, float]] = SEASONS) -> DataFrame:
    rows = [(c, m, f) for c, months in seasons.items() for m, f in months.items()]
    return spark.createDataFrame(rows, "category string, month int, season double")


def season_factor(
    df: DataFrame, seasons: dict[str, dict[int, float]] = SEASONS, *, date: str = "date"
) -> DataFrame:
    """Add ``season_factor``: the category's month factor, raised on weekends."""
    table = season_table(df.sparkSession, seasons).withColumnRenamed("month", "_month")
    matched = df.withColumn("_month", F.month(date)).join(
        F.broadcast(table), ["category", "_month"], "left"
    )
    weekend = F.when(F.weekday(date) >= 5, WEEKEND_FACTOR).otherwise(1.0)
    factor = F.coalesce(F.col("season"), F.lit(1.0)) * weekend
    return matched.withColumn("season_factor", factor).select(*df.columns, "season_factor")


def sale_days(
    spark: SparkSession, sales: Sequence[tuple] = SALES, reach: int = SALE_REACH
) -> DataFrame:
    """Month, day and discount of every sale day; the first event wins an overlap.

    Events stay within their month, so a range match on the day becomes an equi-join.
    """
    events = spark.createDataFrame(
        [(rank, *event) for rank, event in enumerate(sales)],
        "rank int, sale_month int, sale_date int, discount double",
    )
    around = F.sequence(F.col("sale_date") - reach, F.col("sale_date") + reach)
    return (
        events.withColumn("sale_day", F.explode(around))
        .groupBy("sale_month", "sale_day")
        .agg(F.min_by("discount", "rank").alias("sale_discount"))
    )


def promo_calendar(
    df: DataFrame,
    sales: Sequence[tuple] = SALES,
    *,
    reach: int = SALE_REACH,
    date: str = "date",
) -> DataFrame:
    """Add ``is_sale`` and ``sale_discount`` by the day of the year."""
    days = F.broadcast(sale_days(df.sparkSession, sales, reach))
    on = (F.month(date) == F.col("sale_month")) & (F.dayofmonth(date) == F.col("sale_day"))
    return df.join(days, on, "left").select(
        *[df[c] for c in df.columns],
        F.col("sale_discount").isNotNull().cast("int").alias("is_sale"),
        F.coalesce("sale_discount", F.lit(0.0)).alias("sale_discount"),
    )
