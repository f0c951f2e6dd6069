"""Small helpers that the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

# Rows that a Python worker holds at once as Python objects.
SLICE = 1000
# Bytes after which a batch ends; a longer row is a batch of its own.
BATCH_BYTES = 1 << 24


def bounded_batches(df: DataFrame) -> None:
    """Let the session send Python batches of a bounded number of rows and bytes; texts may be long."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(SLICE))
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


_held: dict[str, tuple] = {}


def held(owner: str, name, make: Callable):
    """What an operator keeps in a Python worker from task to task, under one name at a time.

    Workers serve all operators in turn: what another one left behind is dropped first.
    """
    if owner not in _held or _held[owner][0] != name:
        _held.clear()
        pa.default_memory_pool().release_unused()
        _held[owner] = (name, make())
    return _held[owner][1]


def add_columns(
    df: DataFrame, read: list[str], fields: list[StructField], compute: Callable[..., list]
) -> DataFrame:
    """``df`` with ``fields`` computed batch by batch in Python from the columns ``read``.

    ``compute`` gets one Python list for each column of ``read`` and returns one list or
    Arrow array for each field. A new column replaces one of the same name.
    """
    bounded_batches(df)
    new = {f.name for f in fields}
    kept = [f for f in df.schema.fields if f.name not in new]
    # Names that no column of ``df`` has.
    mark = "_in"
    while any(f.name.lower().startswith(mark) for f in df.schema.fields):
        mark = "_" + mark
    inputs = {c: f"{mark}{i}" for i, c in enumerate(read)}
    shaped = df.select(
        *[F.col(f"`{f.name}`") for f in kept], *[F.col(f"`{c}`").alias(a) for c, a in inputs.items()]
    )
    names, types = [f.name for f in fields], [arrow_type(f) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(k, SLICE) for b in batches for k in range(0, b.num_rows, SLICE)):
            got = compute(*[batch.column(a).to_pylist() for a in inputs.values()])
            made = [x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(got, types)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(kept)], *made], names=[*batch.schema.names[: len(kept)], *names]
            )

    return shaped.mapInArrow(run, StructType([*kept, *fields]))


def arrow_type(field: StructField) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(field.dataType)


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))
