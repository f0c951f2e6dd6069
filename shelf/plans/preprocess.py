"""Raw sales rows to the gap-free daily panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from shelf.operators.quality import (
    CAPPED,
    ZEROED,
    cap_outliers,
    dedupe_first,
    fill_date_gaps,
    fix_types,
    impute,
    missing,
    observed,
)
from shelf.operators.rollup import daily_rollup
from shelf.schema import columns_of, numeric_columns, validate_columns
from shelf.staging import stage


def preprocess(
    raw: DataFrame, *, order_by: Sequence[str], numeric: Sequence[str] | None = None
) -> DataFrame:
    """Impute, type, dedupe, cap and fill the gaps.

    ``order_by`` orders the rows of a day and is not imputed. The rows are written as they come and
    again without duplicates: medians and outlier fences read them several times.
    """
    stored = stage(validate_columns(raw), "raw-rows")
    typed = fix_types(impute(stored, numeric=numeric, keys=order_by))
    single = stage(dedupe_first(typed, order_by=order_by), "deduplicated")
    return fill_date_gaps(cap_outliers(single), zeroed=ZEROED)


def preprocess_audited(
    raw: DataFrame, *, order_by: Sequence[str], numeric: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """:func:`preprocess`, stored, and what it changed: (measure, column, rows).

    Measures are ``rows_in``, ``null_dates``, ``duplicates``, ``rows_out`` (before gaps are filled),
    and by column ``filled`` (missing values of dated rows) and ``capped`` (values moved to a fence).
    All of them are counted while the steps run; the input is scanned once.
    """
    dated = F.col("date").isNotNull()
    fill = [c for c in (numeric_columns(raw) if numeric is None else numeric) if c not in order_by]
    fill += [c for c in columns_of(raw, StringType) if c not in fill]
    counts = {"rows": F.count(F.lit(1)), "dated": F.count_if(dated)}
    counts |= {f"filled_{c}": F.count_if(dated & missing(raw, c)) for c in fill}
    counted, read = observed(validate_columns(raw), "preprocess-input", **counts)
    stored = stage(counted, "raw-rows")
    typed = fix_types(impute(stored, numeric=numeric, keys=order_by))
    single, kept = observed(dedupe_first(typed, order_by=order_by), "preprocess-rows", rows=F.count(F.lit(1)))
    single = stage(single, "deduplicated")
    before = {f"_was_{c}": F.col(c).cast("double") for c in CAPPED}
    moves = {f"capped_{c}": F.count_if(F.col(c) != F.col(f"_was_{c}")) for c in CAPPED}
    capped, changed = observed(cap_outliers(single.withColumns(before)), "preprocess-caps", **moves)
    panel = stage(fill_date_gaps(capped.drop(*before), zeroed=ZEROED), "clean-panel")
    first, rest, caps = read.get, kept.get, changed.get
    table = [
        ("rows_in", None, first["rows"]), ("null_dates", None, first["rows"] - first["dated"]),
        ("duplicates", None, first["dated"] - rest["rows"]), ("rows_out", None, rest["rows"]),
        *[("filled", c, first[f"filled_{c}"]) for c in fill], *[("capped", c, caps[f"capped_{c}"]) for c in CAPPED],
    ]
    return panel, raw.sparkSession.createDataFrame(table, "measure string, column string, rows long")


def daily_panel(raw: DataFrame, *, order_by: Sequence[str]) -> DataFrame:
    """Sum the rows of a day instead of dropping all but the first, then fill the gaps."""
    daily = daily_rollup(validate_columns(raw), order_by=order_by)
    return fill_date_gaps(daily, zeroed=(*ZEROED, "lost_sales"))
