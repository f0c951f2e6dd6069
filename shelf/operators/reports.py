"""Sales reports. Every report is one aggregation with a small result.

Global windows here run over results with one row per day, never over facts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelf.functions.calendar import WEEKDAYS, weekday_name, year_month
from shelf.functions.numeric import millions, percent
from shelf.operators.quantiles import quantile_table
from shelf.schema import columns_of, numeric_columns

# Short month names, January first.
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")


def filter_sales(
    df: DataFrame,
    *,
    store: str | None = None,
    category: str | None = None,
    product: str | None = None,
) -> DataFrame:
    """Equality filters; ``None`` keeps all values."""
    for column, value in (("store", store), ("category", category), ("product", product)):
        if value is not None:
            df = df.where(F.col(column) == value)
    return df


def filter_members(df: DataFrame, **members: Sequence[str]) -> DataFrame:
    """Rows whose columns hold one of the listed values."""
    for column, values in members.items():
        df = df.where(F.col(column).isin(list(values)))
    return df


def daily_totals(df: DataFrame, measure: str = "actual_sales") -> DataFrame:
    return df.groupBy("date").agg(F.sum(measure).alias(measure))


def trend(df: DataFrame, measure: str = "actual_sales", days: int = 30) -> DataFrame:
    """Daily totals with a moving average that starts once ``days`` days are there."""
    frame = Window.orderBy("date").rowsBetween(1 - days, Window.currentRow)
    full = F.count(measure).over(frame) == days
    average = F.when(full, F.avg(measure).over(frame))
    return daily_totals(df, measure).withColumn(f"rolling_{days}d", average)


def category_month(df: DataFrame) -> DataFrame:
    return df.groupBy(year_month(F.col("date")).alias("month"), "category").agg(
        F.sum("actual_sales").alias("actual_sales")
    )


def monthly_totals(df: DataFrame) -> DataFrame:
    return df.groupBy(year_month(F.col("date")).alias("month")).agg(
        F.sum("actual_sales").alias("actual_sales")
    )


def performance(df: DataFrame, by: str) -> DataFrame:
    """Revenue, units and stockouts by store or category, best revenue first."""
    return (
        df.groupBy(by)
        .agg(
            F.sum("revenue").alias("total_revenue"),
            F.sum("actual_sales").alias("total_units"),
            F.sum("stockout_flag").alias("stockout_count"),
        )
        .withColumn("revenue_millions", millions(F.col("total_revenue")))
        .orderBy(F.desc("total_revenue"), by)
    )


def volume_share(df: DataFrame, by: str = "category") -> DataFrame:
    """Units by group and their share of all units."""
    totals = df.groupBy(by).agg(F.sum("actual_sales").alias("actual_sales"))
    whole = totals.agg(F.sum("actual_sales")).scalar()
    return totals.withColumn("share_pct", percent(F.col("actual_sales"), whole))


def weekday_mean(df: DataFrame) -> DataFrame:
    """Mean sales by weekday, Monday to Sunday; absent weekdays hold null."""
    means = df.groupBy(weekday_name(F.col("date")).alias("dow")).agg(
        F.avg("actual_sales").alias("actual_sales")
    )
    week = df.sparkSession.createDataFrame(
        list(enumerate(WEEKDAYS)), "position int, dow string"
    )
    return week.join(means, "dow", "left").orderBy("position").select("dow", "actual_sales")


def seasonality_pivot(df: DataFrame) -> DataFrame:
    """Mean sales, weekdays down and months across."""
    table = (
        df.withColumn("_month", F.month("date"))
        .groupBy(F.weekday("date").alias("day_of_week"))
        .pivot("_month", list(range(1, 13)))
        .agg(F.avg("actual_sales"))
    )
    return table.withColumnsRenamed({str(i): name for i, name in enumerate(MONTHS, 1)})


def _flags(measure: str, flag: str, labels: Mapping[int, str]) -> dict[str, Column]:
    return {name: F.when(F.col(flag) == value, F.col(measure)) for value, name in labels.items()}


# Labels of the promotion flag.
PROMO_LABELS = {0: "No Promotion", 1: "Promotion"}


def promotion_impact(df: DataFrame, *, measure: str = "actual_sales") -> DataFrame:
    """Mean, median, sum and deviation of sales with and without promotion."""
    groups = _flags(measure, "is_promotion", PROMO_LABELS)
    medians = quantile_table(df, groups, [0.5])
    labels = F.create_map(*[F.lit(x) for item in PROMO_LABELS.items() for x in item])
    return (
        df.groupBy("is_promotion")
        .agg(
            F.avg(measure).alias("mean"),
            F.sum(measure).alias("sum"),
            F.stddev_samp(measure).alias("std"),
        )
        .withColumn("label", labels[F.col("is_promotion")])
        .join(medians.select(F.col("name").alias("label"), "quantile"), "label", "left")
        .select("label", "mean", F.col("quantile").alias("median"), "sum", "std")
    )


def box_stats(df: DataFrame, *, measure: str = "actual_sales") -> DataFrame:
    """Five-number summary of sales with and without promotion."""
    quartiles = quantile_table(
        df, _flags(measure, "is_promotion", PROMO_LABELS), [0.0, 0.25, 0.5, 0.75, 1.0]
    )
    names = {0.0: "min", 0.25: "q1", 0.5: "median", 0.75: "q3", 1.0: "max"}
    return quartiles.groupBy(F.col("name").alias("label")).agg(
        *[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(n) for p, n in names.items()]
    )


def promo_uplift(df: DataFrame, *, measure: str = "actual_sales") -> DataFrame:
    """Percentage by which mean sales with promotion exceed those without."""
    flags = _flags(measure, "is_promotion", PROMO_LABELS)
    without, with_promo = F.avg(flags["No Promotion"]), F.avg(flags["Promotion"])
    return df.agg(percent(with_promo - without, without).alias("uplift_pct"))


def _per_series(df: DataFrame) -> DataFrame:
    """Sums by series: distinct counts then run over series instead of facts."""
    return df.groupBy("store", "category", "product").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.sum("revenue").alias("revenue"),
        F.sum("actual_sales").alias("units"),
        F.sum("stockout_flag").alias("stockouts"),
        F.count("stockout_flag").alias("flagged"),
        F.sum("is_promotion").alias("promotions"),
    )


def kpi_overview(df: DataFrame) -> DataFrame:
    return _per_series(df).agg(
        F.sum("revenue").alias("total_revenue"),
        F.sum("units").alias("total_units"),
        percent(F.sum("stockouts"), F.sum("flagged")).alias("stockout_rate_pct"),
        F.countDistinct("product").alias("products"),
        F.countDistinct("store").alias("stores"),
    )


def dataset_summary(df: DataFrame) -> DataFrame:
    return _per_series(df).agg(
        F.sum("rows").alias("rows"),
        F.min("first_date").alias("first_date"),
        F.max("last_date").alias("last_date"),
        F.countDistinct("store").alias("stores"),
        F.countDistinct("category").alias("categories"),
        F.countDistinct("product").alias("products"),
        F.sum("revenue").alias("total_revenue"),
        F.sum("units").alias("total_units"),
        F.sum("stockouts").alias("stockout_events"),
        F.sum("promotions").alias("promotion_days"),
    )


def top_products(df: DataFrame, n: int = 10) -> DataFrame:
    return (
        df.groupBy("product", "category")
        .agg(F.sum("revenue").alias("revenue"))
        .orderBy(F.desc("revenue"), "product", "category")
        .limit(n)
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), column)


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Table (column, value) of the distinct values, one pass for all columns."""
    entries = [
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns
    ]
    return df.select(F.inline(F.array(*entries))).distinct().orderBy("column", "value")


def type_counts(df: DataFrame) -> DataFrame:
    """Columns per data type; needs the schema only."""
    counts: dict[str, int] = {}
    for field in df.schema.fields:
        name = field.dataType.simpleString()
        counts[name] = counts.get(name, 0) + 1
    ordered = sorted(counts.items(), key=lambda item: (-item[1], item[0]))
    return df.sparkSession.createDataFrame(ordered, "type string, count bigint")


def column_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, missing share and, by type, top values or moments and quartiles per column."""
    columns = list(columns or df.columns)
    df = df.select(*columns)
    numbers = numeric_columns(df)
    texts = columns_of(df, T.StringType)
    dates = columns_of(df, T.DateType)
    fractional = columns_of(df, T.DoubleType, T.FloatType)

    entries = []
    for name in columns:
        value = F.col(name)
        if name in fractional:
            value = F.when(~F.isnan(value), value)
        number = value.cast("double") if name in numbers else F.lit(None).cast("double")
        ends = (F.min(value), F.max(value)) if name in (*numbers, *dates) else (None, None)
        entries.append(
            F.struct(
                F.lit(name).alias("column"),
                F.count(value).alias("count"),
                F.count_if(value.isNull()).alias("missing"),
                percent(F.count_if(value.isNull()), F.count(F.lit(1))).alias("missing_pct"),
                F.avg(number).alias("mean"),
                F.stddev_samp(number).alias("std"),
                *[
                    (end if end is not None else F.lit(None)).cast("string").alias(label)
                    for end, label in zip(ends, ("min", "max"))
                ],
            )
        )
    wide = df.agg(F.array(*entries).alias("e")).select(F.inline("e"))

    quartiles = (
        quantile_table(df, {c: F.col(c) for c in numbers}, [0.25, 0.5, 0.75])
        .groupBy(F.col("name").alias("column"))
        .agg(
            *[
                F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(n)
                for n, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))
            ]
        )
    )
    pairs = [F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in texts]
    tops = (
        df.select(F.inline(F.array(*pairs)))
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("column")
        .agg(
            F.count(F.lit(1)).alias("unique"),
            # Most frequent first, then the smallest value.
            F.min(F.struct((-F.col("n")).alias("n"), F.col("value"))).alias("t"),
        )
        .select("column", "unique", F.col("t.value").alias("top"), (-F.col("t.n")).alias("freq"))
        if texts
        else None
    )
    profile = wide.join(quartiles, "column", "left")
    return profile.join(tops, "column", "left") if tops is not None else profile


def target_correlation(
    df: DataFrame, target: str = "actual_sales", *, columns: Sequence[str] | None = None, n: int = 15
) -> DataFrame:
    """Numeric columns with the strongest Pearson correlation to the target."""
    names = [c for c in (columns or numeric_columns(df)) if c != target]
    y = F.col(target).cast("double")

    def correlation(name: str) -> Column:
        """NaN where one of the two is constant: ``corr`` then divides by zero, an error under ANSI rules."""
        x = F.col(name).cast("double")
        both = x.isNotNull() & y.isNotNull()
        own, other = F.when(both, x), F.when(both, y)
        constant = (F.min(own) == F.max(own)) | (F.min(other) == F.max(other))
        value = F.try_divide(F.covar_pop(x, y), F.stddev_pop(own) * F.stddev_pop(other))
        return F.when(constant, F.lit(float("nan"))).otherwise(value)

    entries = [F.struct(F.lit(c).alias("feature"), correlation(c).alias("correlation")) for c in names]
    table = df.agg(F.array(*entries).alias("e")).select(F.inline("e"))
    return table.orderBy(F.desc_nulls_last(F.abs("correlation")), "feature").limit(n)


def history(df: DataFrame, store: str, product: str, days: int = 120) -> DataFrame:
    """The last days of one series, oldest first."""
    daily = daily_totals(filter_sales(df, store=store, product=product))
    return daily.orderBy(F.desc("date")).limit(days).orderBy("date")


def forecast_vs_actual(
    df: DataFrame, *, store: str | None = None, product: str | None = None
) -> DataFrame:
    """Actual, predicted and interval sums by day."""
    return (
        filter_sales(df, store=store, product=product)
        .groupBy("date")
        .agg(
            *[
                F.sum(source).alias(name)
                for source, name in (
                    ("actual_sales", "actual"),
                    ("predicted_sales", "predicted"),
                    ("pred_lower", "lower"),
                    ("pred_upper", "upper"),
                )
                if source in df.columns
            ]
        )
        .orderBy("date")
    )


def residual_stats(df: DataFrame) -> DataFrame:
    """Mean, deviation and extremes of the daily differences of actual and predicted."""
    gap = F.col("actual") - F.col("predicted")
    return forecast_vs_actual(df).agg(
        F.avg(gap).alias("mean"),
        F.stddev_samp(gap).alias("std"),
        F.max(gap).alias("max"),
        F.min(gap).alias("min"),
    )


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    return df.limit(n)
