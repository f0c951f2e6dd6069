"""Roll-up of sales rows to one row per day and series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelf.schema import present


def _picked(pick, value: str, order: Column) -> Column:
    """First or last non-null value in the given order."""
    return pick(value, F.when(F.col(value).isNotNull(), order)).alias(value)


def daily_rollup(df: DataFrame, *, order_by: Sequence[str]) -> DataFrame:
    """Sums, flags, first price, last stock and mean discount per day and series.

    ``order_by`` orders the rows within a day. Rows are combined before the
    shuffle, so neither a busy day nor a busy series concentrates them. Lost
    sales are summed where the rows have them.
    """
    order = F.struct(*order_by)
    lost = present(df, ["lost_sales"])
    # Series and day come first: input sorted that way needs no second sort.
    return (
        df.groupBy("store", "product", "date", "category")
        .agg(
            F.sum("actual_sales").alias("actual_sales"),
            F.sum("demand").alias("demand"),
            F.sum("revenue").alias("revenue"),
            *[F.sum(c).alias(c) for c in lost],
            _picked(F.max_by, "current_stock", order),
            F.max("is_promotion").alias("is_promotion"),
            F.max("stockout_flag").alias("stockout_flag"),
            _picked(F.min_by, "unit_price", order),
            F.avg("discount_pct").alias("discount_pct"),
        )
        .select(
            "date", "store", "category", "product", "actual_sales", "demand", "revenue",
            *lost, "current_stock", "is_promotion", "stockout_flag", "unit_price", "discount_pct",
        )
    )
