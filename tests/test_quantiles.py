import numpy as np
import pytest
from pyspark.sql import functions as F

from shelf.operators.quantiles import exact_quantiles

PROBS = [0.0, 0.025, 0.25, 0.5, 0.75, 1.0]


def test_equals_numpy(spark):
    rng = np.random.default_rng(1)
    data = {
        "normal": rng.normal(100, 20, 5_000),
        "heavy": rng.pareto(1.2, 5_000),
        "ties": rng.integers(0, 4, 5_000).astype(float),
        "one_third_zero": np.where(rng.random(5_000) < 0.34, 0.0, rng.random(5_000)),
    }
    rows = list(zip(*[v.tolist() for v in data.values()]))
    df = spark.createDataFrame(rows, list(data)).repartition(5)
    got = exact_quantiles(df, {c: F.col(c) for c in data}, PROBS)
    assert len(got) == len(data) * len(PROBS)
    for (name, prob), value in got.items():
        assert value == pytest.approx(np.quantile(data[name], prob), rel=1e-12, abs=1e-12)


def test_all_magnitudes_equal_numpy(spark):
    """Both signs, subnormal and huge values, powers of two and their neighbours, and zeros."""
    rng = np.random.default_rng(4)
    powers = np.ldexp(1.0, rng.integers(-1074, 1024, 1_500))
    data = np.concatenate([
        rng.normal(0, 1, 1_000), powers, np.nextafter(powers, 0), -np.nextafter(powers, np.inf)[powers < 1e300],
        [0.0, -0.0, 5e-324, -5e-324, np.finfo(float).max, 1.0, np.nextafter(1.0, 2)],
    ])
    df = spark.createDataFrame([(float(v),) for v in data], "x double").repartition(5)
    got = exact_quantiles(df, {"x": F.col("x")}, [0.0, 0.1, 0.25, 0.33, 0.5, 0.61, 0.8, 0.99, 1.0])
    for (_, prob), value in got.items():
        assert value == pytest.approx(np.quantile(data, prob), rel=1e-12, abs=0)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 7])
def test_small_counts_and_nulls(spark, n):
    values = [float(i * i) for i in range(n)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    for (_, prob), value in exact_quantiles(df, {"x": F.col("x")}, [0.25, 0.75]).items():
        assert value == pytest.approx(np.quantile(values, prob))


def test_column_without_values(spark):
    df = spark.createDataFrame([(None, 1.0)], "x double, y double")
    got = exact_quantiles(df, {"x": F.col("x"), "y": F.col("y")}, [0.5])
    assert got == {("x", 0.5): None, ("y", 0.5): 1.0}


def test_group_as_condition(spark):
    df = spark.createDataFrame([(0, 1.0), (0, 3.0), (1, 10.0)], "flag int, x double")
    groups = {str(v): F.when(F.col("flag") == v, F.col("x")) for v in (0, 1)}
    assert exact_quantiles(df, groups, [0.5]) == {("0", 0.5): 2.0, ("1", 0.5): 10.0}


def test_infinite_and_missing_values(spark):
    rows = [(v,) for v in (float("inf"), 1.0, float("-inf"), None, float("nan"), 2.0, 2.0)]
    df = spark.createDataFrame(rows, "x double")
    got = exact_quantiles(df, {"x": F.col("x")}, [0.0, 0.25, 0.5, 0.75, 1.0])
    assert list(got.values()) == [float("-inf"), 1.0, 2.0, 2.0, float("inf")]


def test_passes_are_hash_aggregates_without_a_single_task(spark, capsys):
    """Counts are dealt by bracket and digit; no sketch, no window, no exchange to one partition."""
    from shelf.operators import quantiles

    df = spark.range(10).select(F.col("id").cast("double").alias("v0"))
    plans = []
    counted = quantiles._counted

    def seen(flat, entries):
        flat.select(F.explode(F.array_compact(F.array(*entries))).alias("e")).groupBy("e.bracket", "e.digit").count().explain()
        plans.append(capsys.readouterr().out)
        return counted(flat, entries)

    quantiles._counted = seen
    try:
        exact_quantiles(df, {"x": F.col("v0")}, [0.5])
    finally:
        quantiles._counted = counted
    assert plans and all("HashAggregate" in p and "SinglePartition" not in p and "Window" not in p for p in plans)


def test_borders_part_columns_evenly(spark):
    from shelf.operators.quantiles import even_borders

    rng = np.random.default_rng(8)
    data = {
        "wide": rng.normal(0, 50, 4_000), "year": rng.integers(2015, 2025, 4_000).astype(float), "one": np.full(4_000, 3.0),
        "skewed": np.where(rng.random(4_000) < 0.5, 0.0, rng.pareto(1.0, 4_000) - 0.2),
    }
    df = spark.createDataFrame(list(zip(*[v.tolist() for v in data.values()])), list(data))
    found = even_borders(df.repartition(5), list(data), 32)
    assert found == even_borders(df.repartition(2), list(data), 32)
    for (name, values), borders in zip(data.items(), found):
        assert borders == sorted(set(borders)) and len(borders) < 32 and set(borders) <= set(values.tolist())
        sizes = np.bincount(np.searchsorted(borders, values, "left"), minlength=len(borders) + 1)
        copies = np.unique(values, return_counts=True)[1].max()
        assert sizes.max() <= max(2.1 * 4_000 / 32, copies + 4_000 / 32) and sizes.min() > 0
    assert found[1] == [float(x) for x in range(2015, 2024)] and found[2] == []


def test_counting_is_reduced_in_the_tasks(spark):
    """Each task sends a digit once, however many batches it reads; a row makes no row of its own."""
    from shelf.operators.quantiles import MANTISSA, _entry, _tallied

    df = spark.range(0, 60_000, numPartitions=2).select((F.col("id") % 1000 + 1).cast("double").alias("v0"))
    made = _tallied(df, [_entry(0, MANTISSA, F.col("v0"), F.lit(True))])
    rows = {r["low"]: (r["rows"], r["high"]) for r in made.collect()}
    assert rows[512.0] == (60 * 489, 1000.0) and rows[1.0] == (60, 1.0)
    assert "Generate" not in made._jdf.queryExecution().executedPlan().toString()
