"""CSV and Parquet scans and sinks."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelf.operators.boosting import BoostedModel
from shelf.schema import RAW_SALES, REQUIRED, SERIES, validate_columns


def _reader(spark: SparkSession, fmt: str):
    reader = spark.read.format(fmt)
    return reader.option("header", True).option("enforceSchema", False) if fmt == "csv" else reader


def read_table(
    spark: SparkSession,
    path: str,
    *,
    fmt: str = "csv",
    schema: T.StructType | None = None,
    infer: bool = False,
) -> DataFrame:
    """Scan a table.

    With ``schema`` nothing is inferred and a CSV header that disagrees with it
    is an error. ``infer`` costs one more pass over a CSV file.
    """
    reader = _reader(spark, fmt)
    if schema is not None:
        return reader.schema(schema).load(path)
    return reader.option("inferSchema", infer).load(path)


def read_validated(
    spark: SparkSession,
    path: str,
    *,
    fmt: str = "csv",
    known: T.StructType = RAW_SALES,
    required: Iterable[str] = REQUIRED,
) -> DataFrame:
    """Scan after checking the header for every required column.

    Only the header line is read for the check. Columns get the type they have
    in ``known``; others stay strings.
    """
    head = validate_columns(read_table(spark, path, fmt=fmt), required)
    if fmt != "csv":
        return head
    types = {f.name: f.dataType for f in known.fields}
    schema = T.StructType(
        [T.StructField(c, types.get(c, T.StringType())) for c in head.columns]
    )
    return read_table(spark, path, fmt=fmt, schema=schema)


PROBLEMS, LINE = "_problems", "_line"


def read_with_rejects(
    spark: SparkSession,
    path: str,
    *,
    known: T.StructType = RAW_SALES,
    required: Iterable[str] = REQUIRED,
) -> tuple[DataFrame, DataFrame]:
    """The typed rows of a CSV table, and the rows with a value that is not of its column's type.

    Rejected rows keep their columns as text, with the names of the offending columns in
    ``_problems``; a line with too few or too many values has the problem ``_line`` and its text in
    the column of that name. Every line is in one of the two tables. An empty value is null, not a
    problem. The lines are read as text once for each table that is used.
    """
    head = validate_columns(read_table(spark, path), required)
    text = T.StructType([T.StructField(c, T.StringType()) for c in [*head.columns, LINE]])
    lines = (
        _reader(spark, "csv").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", LINE)
        .option("enforceSchema", True).schema(text).load(path)
    )
    types = {f.name: f.dataType for f in known.fields if f.name in head.columns}
    wrong = [F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), F.lit(c)) for c, t in types.items()]
    found = F.array_compact(F.array(F.when(F.col(LINE).isNotNull(), F.lit(LINE)), *wrong))
    checked = lines.withColumn(PROBLEMS, found)
    good = checked.where(F.size(PROBLEMS) == 0).drop(PROBLEMS, LINE)
    accepted = good.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in head.columns])
    return accepted, checked.where(F.size(PROBLEMS) > 0)


def write_series_table(
    df: DataFrame, name: str, path: str, *, buckets: int, keys: Sequence[str] = SERIES, date: str = "date"
) -> DataFrame:
    """Store ``df`` below ``path`` as the table ``name``, bucketed by series and sorted by day.

    Windows and aggregates by series over the returned scan need no exchange: rows are shuffled once,
    when they are written. Every bucket is one file.
    """
    spark = df.sparkSession
    ordered = df.repartition(buckets, *keys)
    ordered.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys, date).option(
        "path", path
    ).saveAsTable(name)
    return spark.table(name)


def read_if_exists(spark: SparkSession, path: str, **options) -> DataFrame | None:
    """Scan, or ``None`` when nothing is stored at ``path``."""
    try:
        return read_table(spark, path, **options)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def write_table(
    df: DataFrame, path: str, *, fmt: str = "csv", partition_by: Sequence[str] = ()
) -> None:
    """Replace the table at ``path``; ``partition_by`` enables partition pruning."""
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def export_filtered(df: DataFrame, path: str, columns: Sequence[str], **members) -> None:
    """Write the chosen columns of the rows whose values are members of the given lists."""
    for column, values in members.items():
        df = df.where(F.col(column).isin(list(values)))
    write_table(df.select(*columns), path)


def save_model(model: PipelineModel | BoostedModel, path: str) -> None:
    if isinstance(model, BoostedModel):
        model.save(SparkSession.active(), path)
    else:
        model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel | BoostedModel:
    """The model below ``path``: tables of a boosted model, or a pipeline."""
    spark = SparkSession.active()
    try:
        return BoostedModel.load(spark, path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    return PipelineModel.load(path)
