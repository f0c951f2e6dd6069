"""The retail sales view over the star-schema tables.

Brands stand for products and regions for stores. Stock is a closed form: lots
of ``LOT`` units are sold down one after the other within each series.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelf.operators.measures import derive_sales_measures
from shelf.operators.partitioning import parts_for
from shelf.operators.running import running_total
from shelf.schema import SERIES
from shelf.staging import stage

LOT = 500

# Unique together with (store, product, date): the order of rows within a day.
SEQ = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_tax")

# Orders per block of the running stock sum.
ORDERS_PER_BLOCK = 1 << 24


# The columns read from each table; a given schema spares the footer pass of inference.
_COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_regionkey int",
    "customer": "c_custkey bigint, c_nationkey int",
    "orders": "o_orderkey bigint, o_custkey bigint",
    "part": "p_partkey bigint, p_brand string",
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_shipdate timestamp_ntz"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _customer_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    # 25 nations and 5 regions at every scale.
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    stores = nation.join(
        F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey")
    ).select("n_nationkey", F.col("r_name").alias("store"))
    return (
        table(spark, sf_dir, "customer")
        .join(F.broadcast(stores), F.col("c_nationkey") == F.col("n_nationkey"))
        .select("c_custkey", "store")
    )


def sales_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line with store, product, category and price; no stock yet."""
    return _with_measures(_joined_lines(spark, sf_dir))


# What is derived from these columns is added after the last shuffle, not carried through it.
_LINE = ("date", "store", "product", "l_quantity", "l_discount", *SEQ)


def _joined_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines with store and product, in the columns ``_LINE``.

    The lines are never sorted for a join: they stream past hash tables of orders and parts, which
    are cut into more partitions the more lines there are.
    """
    lines = table(spark, sf_dir, "lineitem").withColumn("l_shipdate", F.col("l_shipdate").cast("date"))
    # Parquet footers hold the number of rows.
    parts = parts_for(spark, lines.count())
    orders = (
        table(spark, sf_dir, "orders")
        .join(_customer_stores(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"))
        .select("o_orderkey", "store")
    )
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("product"))
    by_part = part.repartition(parts, "p_partkey").hint("shuffle_hash")
    by_order = orders.repartition(parts, "o_orderkey").hint("shuffle_hash")
    return (
        lines.join(by_part, F.col("l_partkey") == F.col("p_partkey"))
        .join(by_order, F.col("l_orderkey") == F.col("o_orderkey"))
        .withColumnRenamed("l_shipdate", "date")
        .select(*_LINE)
    )


def _with_measures(lines: DataFrame) -> DataFrame:
    category = F.concat(F.lit("CAT_"), (F.expr("int(substr(product, 7))") % 5).cast("string"))
    return lines.select(
        "date",
        "store",
        category.alias("category"),
        "product",
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
        F.col("l_discount").alias("discount_pct"),
        F.col("l_quantity").cast("int").alias("demand"),
        *SEQ,
        *[c for c in lines.columns if c not in (*_LINE, *SEQ)],
    )


def retail_sales(
    spark: SparkSession, sf_dir: str, *, orders_per_block: int = ORDERS_PER_BLOCK
) -> DataFrame:
    """Raw sales rows with stock, sales and promotion columns.

    The running sum goes by days and by order blocks within a day: a series may
    hold a third of all rows, yet no task sorts more than one of its blocks. The
    lines are joined together and stored once.
    """
    summed = running_total(
        stage(_joined_lines(spark, sf_dir), "sales-lines"),
        {"cum": F.col("l_quantity").cast("int").cast("long")},
        partition_by=SERIES,
        order_by=("date", *SEQ),
        blocks={
            "_day": F.col("date"),
            "_orders": F.floor(F.col("l_orderkey") / orders_per_block),
        },
    )
    summed = _with_measures(summed)
    opening = F.lit(LOT) - (F.col("cum") - F.col("demand")) % LOT
    return (
        derive_sales_measures(summed, stock=opening)
        .withColumns(
            {
                "current_stock": F.lit(LOT) - F.col("cum") % LOT,
                "is_promotion": (F.round(F.col("discount_pct") * 100) >= 8).cast("int"),
            }
        )
        .select(
            "date", "store", "category", "product", "unit_price", "discount_pct",
            "effective_price", "demand", "actual_sales", "lost_sales", "revenue",
            "current_stock", "is_promotion", "stockout_flag", *SEQ,
        )
    )
