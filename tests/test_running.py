import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shelf.operators.running import ranged_running_total, running_total
from shelf.staging import stage


@pytest.fixture(scope="module")
def skewed(spark):
    """One key holds two thirds of the rows, many with equal order values."""
    rng = np.random.default_rng(3)
    n = 3_000
    frame = pd.DataFrame(
        {
            "k": np.where(rng.random(n) < 0.67, "hot", rng.choice(["a", "b", "c"], n)),
            "day": rng.integers(0, 20, n),
            "rank": np.where(rng.random(n) < 0.4, 0, rng.integers(0, 1_000, n)),
            "id": np.arange(n),
            "v": rng.integers(0, 50, n),
        }
    )
    return frame, spark.createDataFrame(frame).repartition(6)


def expected(frame, keys, order):
    frame = frame.sort_values(order)
    frame["run"] = frame.groupby(keys)["v"].cumsum() if keys else frame["v"].cumsum()
    return frame.set_index("id")["run"].sort_index()


def got(df):
    return df.toPandas().set_index("id")["run"].sort_index()


def test_blocks_equal_plain_window(skewed):
    frame, df = skewed
    want = expected(frame, ["k"], ["day", "rank", "id"])
    args = dict(partition_by=["k"], order_by=["day", "rank", "id"])
    plain = running_total(df, {"run": F.col("v")}, **args)
    blocks = {"_day": F.col("day"), "_half": F.floor(F.col("rank") / 500)}
    blocked = running_total(df, {"run": F.col("v")}, blocks=blocks, **args)
    assert (got(plain) == want).all() and (got(blocked) == want).all()
    assert blocked.columns == plain.columns


@pytest.mark.parametrize("keys", [[], ["k"]])
@pytest.mark.parametrize("ranges", [1, 7, None])
def test_ranges_equal_plain_window(skewed, keys, ranges):
    frame, df = skewed
    run = ranged_running_total(
        stage(df), {"run": F.col("v")}, partition_by=keys,
        order_by=[F.col("rank"), F.col("id")], ranges=ranges,
    )
    assert (got(run) == expected(frame, keys, ["rank", "id"])).all()


def test_ranges_split_a_hot_group(skewed):
    """No block may hold most of the rows, although one key and one rank do."""
    _, df = skewed
    sizes = (
        df.repartitionByRange(7, F.col("k"), F.col("rank"), F.col("id"))
        .groupBy(F.spark_partition_id())
        .count()
        .toPandas()["count"]
    )
    assert sizes.max() < 2 * 3_000 / 7


def test_blocks_spread_with_the_rows_and_sort_once(spark, skewed, monkeypatch):
    """More rows make more partitions, and rows are sorted for the window only, not for a join."""
    from shelf.operators import partitioning

    frame, df = skewed
    monkeypatch.setattr(partitioning, "TASK_ROWS", 100)
    blocks = {"_day": F.col("day")}
    run = running_total(df, {"run": F.col("v")}, blocks=blocks, partition_by=["k"], order_by=["day", "rank", "id"])
    plan = run._jdf.queryExecution().executedPlan().toString()
    wide = plan[: plan.index("BuildRight")]
    assert "ShuffledHashJoin" in wide and wide.count("Sort [") == 1
    assert run.rdd.getNumPartitions() >= 30
    assert (got(run) == expected(frame, ["k"], ["day", "rank", "id"])).all()
