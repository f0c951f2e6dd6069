"""Written stage tables in the cluster's shared checkpoint folder.

A stage table is computed once and read back, so that several branches of a
plan see the same rows even when executors are lost in between.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CONF = "spark.checkpoint.dir"
_local_roots: dict[str, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by the session.

    Only a local session without a setting gets a temporary folder of its own:
    on a cluster such a folder would exist on one machine only.
    """
    context = spark.sparkContext
    named = spark.conf.get(_CONF, None) or context.getConf().get(_CONF)
    named = named or context.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {_CONF} to a folder that all executors share")
    app = context.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="shelf-stage-")
    return _local_roots[app]


def stage_path(spark: SparkSession, name: str) -> str:
    app = spark.sparkContext.applicationId
    return f"{checkpoint_root(spark)}/shelf-{app}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as a Parquet table and return a scan over it."""
    spark = df.sparkSession
    path = stage_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
