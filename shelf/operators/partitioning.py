"""Distribution of rows ahead of work that is bound by computation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelf.schema import SERIES

# Rows of a sales table that a task should sort or hash: some 100 MB, so that nothing spills.
TASK_ROWS = 400_000


def parts_for(spark: SparkSession, rows: int) -> int:
    """Partitions for a shuffle of ``rows`` rows: those of the session, or more for more rows."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // TASK_ROWS))


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Distribute by ``keys`` over all cores.

    Adaptive execution merges partitions with few bytes, which leaves cores idle
    when a small table takes much computation; a given number is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(2 * cores, *keys)


def by_series(df: DataFrame) -> DataFrame:
    """Whole series per partition: the one shuffle of all windows that follow."""
    return spread(df, *SERIES)
