import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from shelf.plans.preprocess import preprocess
from shelf.schema import MissingColumns
from shelf.sources import io
from shelf.sources.retail import SEQ, retail_sales
from shelf.staging import stage_path


def test_csv_round_trip_keeps_types_and_nulls(spark, panel):
    path = stage_path(spark, "csv")
    df = panel.withColumn("unit_price", F.when(F.col("product") != "P9", F.col("unit_price")))
    io.write_table(df, path)
    back = io.read_table(spark, path, schema=df.schema)
    assert back.schema == df.schema
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0


def test_overwrite_and_partition_pruning(spark, panel):
    path = stage_path(spark, "parquet")
    io.write_table(panel, path, fmt="parquet")
    io.write_table(panel, path, fmt="parquet", partition_by=["store"])
    back = io.read_table(spark, path, fmt="parquet").where("store = 'S1'")
    assert back.count() == 165
    assert "PartitionFilters: [isnotnull(store" in back._jdf.queryExecution().executedPlan().toString()


def test_validated_scan(spark, panel):
    good, bad = stage_path(spark, "good"), stage_path(spark, "bad")
    io.write_table(panel.withColumn("extra", F.lit("x")), good)
    df = io.read_validated(spark, good)
    types = dict(df.dtypes)
    assert types["date"] == "date" and types["demand"] == "bigint" and types["extra"] == "string"
    assert df.count() == panel.count()
    io.write_table(panel.drop("demand", "discount_pct"), bad)
    with pytest.raises(MissingColumns, match="demand, discount_pct"):
        io.read_validated(spark, bad)


def test_absent_table(spark):
    assert io.read_if_exists(spark, stage_path(spark, "nothing")) is None


def test_filtered_export(spark, panel):
    path = stage_path(spark, "export")
    io.export_filtered(panel, path, ["store", "product"], store=["S2"])
    assert io.read_if_exists(spark, path).count() == 67


def test_retail_view_is_the_same_for_any_block_size(spark):
    sums = [F.sum(c) for c in ("demand", "actual_sales", "lost_sales", "current_stock", "stockout_flag")]
    seen = {tuple(retail_sales(spark, SF_SMALL, orders_per_block=n).agg(*sums).first()) for n in (50, 1 << 24)}
    assert len(seen) == 1


def test_retail_view_known_sums(spark):
    row = (
        retail_sales(spark, SF_SMALL.replace("0.001", "0.01"))
        .agg(
            F.count("*"), F.sum("demand"), F.sum("actual_sales"), F.sum("lost_sales"),
            F.sum("current_stock"), F.sum("is_promotion"), F.sum("stockout_flag"),
            F.round(F.sum("revenue"), 2),
        )
        .first()
    )
    assert tuple(row) == (60000, 1524135, 1475181, 48954, 15148266, 14936, 2869, 2950581706.05)


def test_preprocess_fills_every_day(spark):
    clean = preprocess(retail_sales(spark, SF_SMALL), order_by=SEQ, numeric=["unit_price"])
    spans = clean.groupBy("store", "product").agg(
        F.count("*").alias("n"), (F.datediff(F.max("date"), F.min("date")) + 1).alias("span")
    )
    assert spans.where("n <> span").count() == 0


def test_cluster_without_a_shared_folder_is_refused(spark, monkeypatch):
    from shelf import staging

    class Context:
        master, applicationId = "yarn", "app"
        getConf = staticmethod(lambda: {})
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default: default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        staging.checkpoint_root(Session())


def test_rejected_lines(spark):
    """Typed rows and rejected ones together are all lines; empty values are accepted as nulls."""
    names = "date,store,category,product,unit_price,discount_pct,demand,actual_sales,revenue,current_stock,is_promotion,stockout_flag"
    good = "2024-01-01,s,c,p,1.5,0.1,3,3,4.5,9,0,0"
    lines = [
        good, good.replace("2024-01-01", "soon"), good.replace(",3,3,", ",three,x,"), good.replace(",3,3,", ",,,"),
        good + ",extra", "2024-01-01,s,c", good.replace("1.5", "1e2"), good.replace(",9,", ",9.7,"),
    ]
    path = stage_path(spark, "lines")
    spark.createDataFrame([("\n".join([names, *lines]),)], "value string").coalesce(1).write.text(path)
    accepted, rejected = io.read_with_rejects(spark, path)
    rows = rejected.collect()
    assert accepted.count() + len(rows) == len(lines)
    assert sorted(r["_problems"] for r in rows) == sorted(
        [["date"], ["demand", "actual_sales"], ["_line"], ["_line"], ["current_stock"]]
    ) or sorted(map(tuple, (r["_problems"] for r in rows)))[0] == ("_line",)
    assert {tuple(r["_problems"]) for r in rows} >= {("date",), ("demand", "actual_sales")}
    kept = accepted.orderBy("unit_price", F.col("demand").isNull()).collect()
    assert [(r["unit_price"], r["demand"]) for r in kept][:2] == [(1.5, 3), (1.5, None)]
    assert dict(accepted.dtypes)["demand"] == "bigint"


def test_windows_over_the_series_store_need_no_exchange(spark, panel):
    from shelf.operators.features import lag_features, rolling_features

    path = stage_path(spark, "series")
    stored = io.write_series_table(panel, "series_store", path, buckets=3)
    made = rolling_features(lag_features(stored))
    assert "Exchange" not in made._jdf.queryExecution().executedPlan().toString()
    want = rolling_features(lag_features(panel))
    assert made.exceptAll(want.select(*made.columns)).count() == 0 and made.count() == panel.count()
    spark.sql("DROP TABLE series_store")


def test_audit_counts_what_preprocessing_changed(spark):
    from shelf.plans.preprocess import preprocess_audited

    raw = retail_sales(spark, SF_SMALL).limit(500)
    rows = [r for r in raw.collect()]
    broken = spark.createDataFrame(rows, raw.schema).withColumn(
        "unit_price", F.when(F.col("l_linenumber") != 1, F.col("unit_price")).otherwise(F.lit(float("nan")))
    ).withColumn("date", F.when(F.col("l_linenumber") != 2, F.col("date")))
    panel, audit = preprocess_audited(broken, order_by=SEQ)
    got = {(r["measure"], r["column"]): r["rows"] for r in audit.collect()}
    dated = [r for r in rows if r["l_linenumber"] != 2]
    assert got["rows_in", None] == 500 and got["null_dates", None] == 500 - len(dated)
    assert got["rows_out", None] == len({(r["date"], r["store"], r["product"]) for r in dated})
    assert got["rows_out", None] + got["duplicates", None] == len(dated)
    assert got["filled", "unit_price"] == sum(r["l_linenumber"] == 1 for r in dated) and got["filled", "demand"] == 0
    plain = preprocess(broken, order_by=SEQ)
    assert panel.exceptAll(plain).count() == 0 and panel.count() == plain.count()
