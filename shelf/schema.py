"""Table schemas and the column checks built on them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

SERIES = ("store", "product")

# The columns of the raw sales table, in file order.
RAW_SALES = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("store", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("product", T.StringType()),
        T.StructField("unit_price", T.DoubleType()),
        T.StructField("discount_pct", T.DoubleType()),
        T.StructField("effective_price", T.DoubleType()),
        T.StructField("demand", T.LongType()),
        T.StructField("actual_sales", T.LongType()),
        T.StructField("lost_sales", T.LongType()),
        T.StructField("revenue", T.DoubleType()),
        T.StructField("current_stock", T.LongType()),
        T.StructField("reorder_point", T.LongType()),
        T.StructField("reorder_qty", T.LongType()),
        T.StructField("lead_time", T.LongType()),
        T.StructField("is_promotion", T.IntegerType()),
        T.StructField("stockout_flag", T.IntegerType()),
    ]
)

# The columns every later step relies on.
REQUIRED = (
    "date",
    "store",
    "category",
    "product",
    "unit_price",
    "discount_pct",
    "demand",
    "actual_sales",
    "revenue",
    "current_stock",
    "is_promotion",
    "stockout_flag",
)


class MissingColumns(ValueError):
    """Raised once, naming every absent column."""

    def __init__(self, missing: Iterable[str]):
        self.missing = sorted(missing)
        super().__init__("missing required columns: " + ", ".join(self.missing))


def validate_columns(df: DataFrame, required: Iterable[str] = REQUIRED) -> DataFrame:
    """Return ``df`` unchanged, or raise :class:`MissingColumns`."""
    missing = set(required) - set(df.columns)
    if missing:
        raise MissingColumns(missing)
    return df


def columns_of(df: DataFrame, *kinds: type[T.DataType]) -> list[str]:
    """Names of the columns whose type is one of ``kinds``."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def numeric_columns(df: DataFrame) -> list[str]:
    return columns_of(df, T.NumericType)


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    """The given names that exist in ``df``, in the given order."""
    have = set(df.columns)
    return [n for n in names if n in have]
