"""Cleaning of sales rows: nulls, types, duplicates, outliers and calendar gaps."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelf.functions.numeric import clip
from shelf.operators.quantiles import exact_quantiles
from shelf.schema import SERIES, columns_of, numeric_columns, present

KEY = ("date", *SERIES)

# Target type of each typed column.
TYPES = {
    "date": "date",
    "actual_sales": "bigint",
    "demand": "bigint",
    "current_stock": "bigint",
    "stockout_flag": "int",
    "is_promotion": "int",
    "unit_price": "double",
    "revenue": "double",
}

# The columns that are capped, carried over gaps and zeroed in gaps.
CAPPED = ("actual_sales", "demand", "revenue")
CARRIED = ("category", "unit_price", "current_stock")
ZEROED = ("actual_sales", "demand", "revenue", "is_promotion", "stockout_flag", "discount_pct")

FENCE = 3.0


def drop_null_dates(df: DataFrame, date: str = "date") -> DataFrame:
    return df.where(F.col(date).isNotNull())


def impute(
    df: DataFrame,
    *,
    numeric: Sequence[str] | None = None,
    keys: Sequence[str] = (),
    label: str = "Unknown",
    date: str = "date",
) -> DataFrame:
    """Drop rows without a date, fill numeric nulls and NaN with the median and text nulls with ``label``.

    All numeric columns are filled if ``numeric`` names none, except ``keys``: numbers that
    identify or order rows have no median.
    Imputed numeric columns come out as double, since a median may lie between
    two integers; :func:`fix_types` restores the declared types.
    """
    dated = drop_null_dates(df, date)
    numeric = [c for c in (numeric_columns(df) if numeric is None else numeric) if c not in keys]
    filled = dated.fillna(label, subset=columns_of(df, T.StringType))
    if not numeric:
        return filled
    nothing = F.lit(None).cast("double")
    medians = exact_quantiles(dated, {c: F.col(c) for c in numeric}, [0.5])
    return filled.withColumns(
        {
            c: F.coalesce(F.nanvl(F.col(c).cast("double"), nothing), F.lit(medians[c, 0.5]))
            for c in numeric
        }
    )


def fix_types(df: DataFrame, types: Mapping[str, str] = TYPES) -> DataFrame:
    """Cast the listed columns that exist; fractions are cut off."""
    return df.withColumns({c: F.col(c).cast(t) for c, t in types.items() if c in df.columns})


def dedupe_first(
    df: DataFrame, *, order_by: Sequence[str], keys: Sequence[str] = KEY
) -> DataFrame:
    """Keep the first row of each key in ``order_by`` order.

    A minimum aggregate, not a ranking: copies are dropped before the shuffle,
    so a key with any number of copies sends one row per map task.
    """
    order = [c for c in order_by if c not in keys]
    rest = [c for c in df.columns if c not in keys and c not in order]
    ranked = F.struct(*order, *rest)
    return (
        df.groupBy(*keys).agg(F.min(ranked).alias("_first")).select(*keys, "_first.*")
    ).select(*df.columns)


def fences(
    df: DataFrame,
    columns: Sequence[str] = CAPPED,
    *,
    multiplier: float = FENCE,
) -> dict[str, tuple[float | None, float | None]]:
    """Per column the lower and the upper outlier fence from its quartiles."""
    found = exact_quantiles(df, {c: F.col(c) for c in columns}, [0.25, 0.75])
    result = {}
    for name in columns:
        q1, q3 = found[name, 0.25], found[name, 0.75]
        known = q1 is not None and q3 is not None
        reach = (q3 - q1) * multiplier if known else None
        result[name] = (q1 - reach, q3 + reach) if known else (None, None)
    return result


def cap_outliers(
    df: DataFrame,
    columns: Sequence[str] = CAPPED,
    *,
    multiplier: float = FENCE,
) -> DataFrame:
    """Move values outside the quartile fences onto them; capped columns become double.

    The quartiles of all columns are found together, before the result is used.
    """
    bounds = fences(df, columns, multiplier=multiplier)
    return df.withColumns(
        {c: clip(F.col(c).cast("double"), *map(F.lit, bounds[c])) for c in columns}
    )


def outlier_counts(
    df: DataFrame,
    columns: Sequence[str] = CAPPED,
    *,
    multiplier: float = FENCE,
) -> DataFrame:
    """Per column the fences and the number of rows outside them."""
    entries = []
    for name, bounds in fences(df, columns, multiplier=multiplier).items():
        lower, upper = (F.lit(b).cast("double") for b in bounds)
        value = F.col(name).cast("double")
        entries.append(
            F.struct(
                F.lit(name).alias("column"),
                F.max(lower).alias("lower"),
                F.max(upper).alias("upper"),
                F.count_if((value < lower) | (value > upper)).alias("outliers"),
            )
        )
    return df.agg(F.array(*entries).alias("e")).select(F.inline("e"))


def fill_date_gaps(
    df: DataFrame,
    *,
    keys: Sequence[str] = SERIES,
    date: str = "date",
    carried: Iterable[str] = CARRIED,
    zeroed: Iterable[str] = ZEROED,
) -> DataFrame:
    """One row per series and day between the first and the last day of the series.

    Every row produces the days up to the next row of its series, so neither a
    calendar table nor a join is needed: one shuffle by series serves this step
    and every later window. Expects one row per series and day.
    """
    carried, zeroed = present(df, carried), present(df, zeroed)
    series = Window.partitionBy(*keys).orderBy(date)
    so_far = series.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    until = F.coalesce(F.date_sub(F.lead(date).over(series), 1), F.col(date))
    spread = df.withColumns(
        {
            "_until": F.greatest(until, F.col(date)),
            **{c: F.last(c, ignorenulls=True).over(so_far) for c in carried},
        }
    ).select("*", F.posexplode(F.sequence(date, "_until")).alias("_gap", "_day"))

    def column(name: str) -> Column:
        value = F.col(name)
        if name == date:
            value = F.col("_day")
        elif name in zeroed:
            value = F.coalesce(F.when(F.col("_gap") == 0, value), F.lit(0).cast(df.schema[name].dataType))
        elif name not in keys and name not in carried:
            value = F.when(F.col("_gap") == 0, value)
        return value.alias(name) if name not in keys else value

    return spread.select(*[column(c) for c in df.columns])


def missing_counts(df: DataFrame, *, only_missing: bool = True) -> DataFrame:
    """Rows per column that hold no value: null, or NaN in a fractional column."""
    entries = [
        F.struct(F.lit(c).alias("column"), F.count_if(missing(df, c)).alias("missing")) for c in df.columns
    ]
    counts = df.agg(F.array(*entries).alias("e")).select(F.inline("e"))
    return counts.where(F.col("missing") > 0) if only_missing else counts


def observed(df: DataFrame, name: str, **counts: Column) -> tuple[DataFrame, Observation]:
    """``df`` with counters that fill while the next action runs; they add no job.

    ``rows`` and the nulls of each column (``null_<column>``) are counted if ``counts`` names none.
    """
    seen = Observation(name)
    if not counts:
        nulls = {f"null_{c}": F.count_if(F.col(c).isNull()) for c in df.columns}
        counts = {"rows": F.count(F.lit(1)), **nulls}
    return df.observe(seen, *[c.alias(n) for n, c in counts.items()]), seen


def missing(df: DataFrame, column: str) -> Column:
    """Whether a row holds no value: null, or NaN in a fractional column."""
    fractional = column in columns_of(df, T.DoubleType, T.FloatType)
    return F.col(column).isNull() | (F.isnan(column) if fractional else F.lit(False))
