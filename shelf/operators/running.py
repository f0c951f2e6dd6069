"""Running totals that do not need a whole partition in one task.

Totals come from an offset table with a level for each block column: the totals of
the first blocks are summed up over the partition, those of the second within a
first block, and so on; a row adds the offsets of its blocks to the sum inside
its last block. An order without natural blocks is cut into ranges. Tables of
all sizes take this path.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelf.operators.partitioning import parts_for
from shelf.staging import stage

# Rows that a range should hold.
RANGE_ROWS = 1_000_000


def _to_here(partition_by: Sequence[str], order_by: Sequence[Column | str]):
    return (
        Window.partitionBy(*partition_by)
        .orderBy(*order_by)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )


def _offsets(
    totals: DataFrame, names: Sequence[str], partition_by: Sequence[str], blocks: Sequence[str]
) -> DataFrame:
    """For each cell of ``totals`` the sums before it, one level of blocks after the other."""
    found = totals.select(*partition_by, *blocks)
    for level, block in enumerate(blocks):
        upper = [*partition_by, *blocks[:level]]
        sums = totals.groupBy(*upper, block).agg(*[F.sum(f"_sum_{n}").alias(f"_sum_{n}") for n in names])
        before = Window.partitionBy(*upper).orderBy(block).rowsBetween(Window.unboundedPreceding, -1)
        earlier = sums.select(*upper, block, *[F.sum(f"_sum_{n}").over(before).alias(f"_off{level}_{n}") for n in names])
        found = found.join(earlier, [*upper, block], "left")
    return found.select(
        *partition_by, *blocks,
        *[
            sum((F.coalesce(f"_off{k}_{n}", F.lit(0)) for k in range(len(blocks))), F.lit(0)).alias(f"_off_{n}")
            for n in names
        ],
    )


def _by_blocks(
    df: DataFrame,
    values: Mapping[str, Column],
    partition_by: Sequence[str],
    order_by: Sequence[Column | str],
    blocks: Sequence[str],
) -> DataFrame:
    """Running totals within each last block, plus the totals of all earlier blocks.

    ``blocks`` are columns of ``df`` that follow the row order, each within the one
    before. Partition keys and blocks must not be null.
    """
    cell = [*partition_by, *blocks]
    sums = [F.sum(v).alias(f"_sum_{n}") for n, v in values.items()]
    totals = stage(df.groupBy(*cell).agg(*sums, F.count(F.lit(1)).alias("_rows")), "block-totals")
    # Rows meet their offsets in a hash table, so only the window sorts them, in bounded partitions.
    rows = totals.agg(F.sum("_rows")).first()[0] or 0
    parts = parts_for(df.sparkSession, rows)
    offsets = _offsets(totals, list(values), partition_by, blocks).repartition(parts, *cell)
    joined = df.repartition(parts, *cell).join(offsets.hint("shuffle_hash"), cell, "left")
    here = _to_here(cell, order_by)
    return joined.withColumns(
        {n: F.col(f"_off_{n}") + F.sum(v).over(here) for n, v in values.items()}
    ).select(*df.columns, *values)


def running_total(
    df: DataFrame,
    values: Mapping[str, Column],
    *,
    partition_by: Sequence[str] = (),
    order_by: Sequence[Column | str],
    blocks: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Add ``values`` summed from the first row of the partition to the current one.

    Without ``blocks`` this is a plain window. ``blocks`` name expressions that
    never decrease along the order, each within the one before, e.g. the day of a
    timestamp and then its hour: each last block is summed on its own, and only
    the totals of one level meet in a task. With ``blocks`` pass a stored table:
    it is read twice, and the totals are found at once.
    """
    if not blocks:
        here = _to_here(partition_by, order_by)
        return df.withColumns({n: F.sum(v).over(here) for n, v in values.items()})
    keyed = df.withColumns(dict(blocks))
    return _by_blocks(keyed, values, partition_by, order_by, list(blocks)).drop(*blocks)


def ranged_running_total(
    table: DataFrame,
    values: Mapping[str, Column],
    *,
    partition_by: Sequence[str] = (),
    order_by: Sequence[Column],
    ranges: int | None = None,
) -> DataFrame:
    """Running totals for an order that has no natural blocks, e.g. by revenue.

    Pass a stored table, since its rows are counted first. It is range-partitioned
    on the full order, so that ties and hot groups spread over many partitions,
    and each range is a block; there are more ranges for more rows. The ranges are
    written: a lost executor cannot move a row to another block.
    """
    least = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = ranges or max(least, -(-table.count() // RANGE_ROWS))
    blocks = stage(
        table.repartitionByRange(ranges, *map(F.col, partition_by), *order_by).withColumn(
            "_block", F.spark_partition_id()
        ),
        "ranges",
    )
    return _by_blocks(blocks, values, partition_by, order_by, ["_block"]).drop("_block")
