"""Row-level sales measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def derive_sales_measures(df: DataFrame, *, stock: Column | str = "current_stock") -> DataFrame:
    """Add price after discount, units sold out of ``stock``, units lost and revenue."""
    available = F.col(stock) if isinstance(stock, str) else stock
    paid = F.col("unit_price") * (1 - F.col("discount_pct"))
    sold = F.least(F.col("demand").cast("long"), available.cast("long"))
    return df.withColumns({"effective_price": paid, "actual_sales": sold}).withColumns(
        {
            "lost_sales": F.col("demand") - F.col("actual_sales"),
            "stockout_flag": (F.col("demand") > F.col("actual_sales")).cast("int"),
            "revenue": F.col("actual_sales") * F.col("effective_price"),
        }
    )


def residual(df: DataFrame, actual: str = "actual_sales", predicted: str = "predicted_sales"):
    return df.withColumn("residual", F.col(actual) - F.col(predicted))
