"""Exact quantiles by counted buckets.

The built-in exact percentile keeps every distinct value of a group in one
buffer. Here a quantile is selected by radix: rows are counted by the first
digit of their value, then only the rows of the bucket that holds the wanted
rank by the next digit, until a bucket holds a single value. The first digit is
sign and exponent of the double, the others are ``BITS`` bits of its mantissa
each, so five passes decide any value, and buckets of one value end earlier.
In a pass a task sorts the bits of one Arrow batch after the other, counts runs of equal digits and sends
each digit once; a hash aggregate adds these counts up. Values of all rows are never sent.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

# Ship the counting with the task: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BITS = 13

# The mantissa's bits below sign and exponent.
MANTISSA = 52

_SIGN = np.uint64(1 << 63)


class Bracket(NamedTuple):
    """A bucket that holds wanted ranks: its column, values and the rows below it."""

    column: int
    low: float
    high: float
    before: int


def _keys(values: np.ndarray) -> np.ndarray:
    """The bits of the doubles as integers that grow with the value."""
    bits = values.view(np.uint64)
    return np.where(bits & _SIGN, ~bits, bits | _SIGN)


def _entry(bracket: int, shift: int, value: Column, where: Column) -> Column:
    """A value of a bracket, to be counted by its bits without the last ``shift``; null elsewhere."""
    fields = (F.lit(bracket).alias("bracket"), F.lit(shift).alias("digit"), value.alias("value"))
    return F.when(where, F.struct(*fields))


def _tallied(flat: DataFrame, entries: Sequence[Column]) -> DataFrame:
    """Rows, least and largest value by (bracket, digit).

    The digit is what is left of a value's bits, in the order of the values, when the last ones are
    cut off. A task adds up its own batches and sends each digit once.
    """

    def merged(found: list[tuple]) -> tuple:
        digits, rows, low, high = (np.concatenate(part) for part in zip(*found))
        order = np.argsort(digits, kind="stable")
        digits, rows, low, high = digits[order], rows[order], low[order], high[order]
        first = np.flatnonzero(np.append(True, digits[1:] != digits[:-1]))
        return (
            digits[first], np.add.reduceat(rows, first), np.minimum.reduceat(low, first), np.maximum.reduceat(high, first)
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[list[tuple]] = [[] for _ in range(width)]
        waiting = [0] * width
        for batch in batches:
            for k in range(width):
                _, shifts, values = batch.column(k).drop_null().flatten()
                if not len(values):
                    continue
                shift, values = shifts[0].as_py(), values.to_numpy()
                values = np.sort(values)
                digits = _keys(values) >> np.uint64(shift)
                first = np.flatnonzero(np.append(True, digits[1:] != digits[:-1]))
                last = np.append(first[1:], len(values))
                found[k].append((digits[first].astype(np.int64), last - first, values[first], values[last - 1]))
                waiting[k] += len(first)
                # Together no longer than twice the digits seen, or a few batches.
                if waiting[k] > max(1 << 17, 2 * len(found[k][0][0])):
                    found[k] = [merged(found[k])]
                    waiting[k] = len(found[k][0][0])
        for k, parts in enumerate(found):
            if parts:
                digits, rows, low, high = merged(parts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(digits), k, np.int32)), *map(pa.array, (digits, rows, low, high))],
                    names=["bracket", "digit", "rows", "low", "high"],
                )

    width = len(entries)
    picked = flat.select(*[e.alias(f"e{k}") for k, e in enumerate(entries)])
    made = picked.mapInArrow(run, "bracket int, digit long, rows long, low double, high double")
    return made.groupBy("bracket", "digit").agg(
        F.sum("rows").alias("rows"), F.min("low").alias("low"), F.max("high").alias("high")
    )


def _counted(flat: DataFrame, entries: Sequence[Column]) -> dict[int, list[Row]]:
    """Rows, least and largest value by (bracket, digit), in the order of the values."""
    found: dict[int, list[Row]] = {}
    # A bracket has at most 2 ** BITS digits.
    for row in _tallied(flat, entries).collect():
        found.setdefault(row["bracket"], []).append(row)
    return {k: sorted(rows, key=lambda r: r["low"]) for k, rows in found.items()}


def _ranked(flat: DataFrame, probs: Sequence[float]):
    """(column, rank) -> value, and the rows by column, for the ranks that ``probs`` need."""
    values = [F.col(c) for c in flat.columns]
    first = _counted(flat, [_entry(i, MANTISSA, v, v.isNotNull()) for i, v in enumerate(values)])
    sizes = {i: sum(r["rows"] for r in first.get(i, [])) for i in range(len(values))}
    done: dict[tuple[int, int], float] = {}
    waiting: dict[Bracket, list[int]] = {}

    def place(column: int, ranks: Sequence[int], rows: Sequence[Row], before: int) -> None:
        for rank in ranks:
            below = before
            for row in rows:
                if rank < below + row["rows"]:
                    break
                below += row["rows"]
            if row["low"] == row["high"]:
                done[column, rank] = row["low"]
            else:
                waiting.setdefault(Bracket(column, row["low"], row["high"], below), []).append(rank)

    for column, n in sizes.items():
        place(column, sorted({r for p in probs for r in _ranks(n, p)}), first.get(column, []), 0)
    digit = 1
    while waiting:
        opened, waiting = list(waiting.items()), {}
        shift = MANTISSA - BITS * digit
        entries = [
            _entry(k, shift, values[b.column], values[b.column].between(b.low, b.high))
            for k, (b, _) in enumerate(opened)
        ]
        counted = _counted(flat, entries)
        for k, (bracket, ranks) in enumerate(opened):
            place(bracket.column, ranks, counted[k], bracket.before)
        digit += 1
    return done, sizes


def _ranks(n: int, prob: float) -> list[int]:
    """The ranks between which the quantile of ``n`` values is interpolated."""
    if not n:
        return []
    lower = math.floor((n - 1) * prob)
    return [lower, min(lower + 1, n - 1)]


def exact_quantiles(
    df: DataFrame, values: Mapping[str, Column], probs: Sequence[float]
) -> dict[tuple[str, float], float | None]:
    """The linearly interpolated quantile by (name, prob); null and NaN are skipped, no value gives None.

    ``values`` maps a name to an expression, so a group becomes a conditional
    expression: ``{"promo": when(flag == 1, sales)}``. The passes run at once;
    pass a stored table. Infinite values have their place in the order.
    """
    names = list(values)
    if not names:
        return {}
    nothing = F.lit(None).cast("double")
    # Adding zero turns the negative zero into the other.
    flat = df.select(
        *[(F.nanvl(values[n].cast("double"), nothing) + 0.0).alias(f"v{i}") for i, n in enumerate(names)]
    )
    done, sizes = _ranked(flat, probs)
    found: dict[tuple[str, float], float | None] = {}
    for i, name in enumerate(names):
        for prob in probs:
            ranks = _ranks(sizes[i], prob)
            if not ranks:
                found[name, prob] = None
                continue
            low, high = (done[i, r] for r in ranks)
            part = (sizes[i] - 1) * prob - ranks[0]
            found[name, prob] = low if low == high or part == 0 else low + (high - low) * part
    return found


def even_borders(df: DataFrame, columns: Sequence[str], bins: int, *, bits: int = 10) -> list[list[float]]:
    """For each column, values that part it into at most ``bins`` bins of like size.

    One pass counts rows by sign, exponent and the first ``bits`` bits of the mantissa; a border is the
    greatest value of such a bucket, so it does not depend on how the rows are distributed. Null and
    NaN are skipped.
    """
    entries = []
    for k, name in enumerate(columns):
        value = F.col(name).cast("double") + 0.0
        entries.append(_entry(k, MANTISSA - bits, value, value.isNotNull() & ~F.isnan(value)))
    counts = _tallied(df, entries)
    found: list[list[Row]] = [[] for _ in columns]
    # At most 2 ** bits buckets for each power of two that a column spans.
    for row in counts.collect():
        found[row["bracket"]].append(row)
    borders = []
    for rows in found:
        rows.sort(key=lambda r: r["high"])
        total, upto, own = sum(r["rows"] for r in rows), 0, []
        for row in rows[:-1]:
            before, upto = upto * bins // total, upto + row["rows"]
            if upto * bins // total > before or len(rows) <= bins:
                own.append(row["high"])
        borders.append(own)
    return borders


def quantile_table(df: DataFrame, values: Mapping[str, Column], probs: Sequence[float]) -> DataFrame:
    """:func:`exact_quantiles` as a table with one row per (name, prob)."""
    rows = [(n, float(p), q) for (n, p), q in exact_quantiles(df, values, probs).items()]
    return df.sparkSession.createDataFrame(rows, "name string, prob double, quantile double")
