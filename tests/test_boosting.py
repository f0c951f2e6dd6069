import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from shelf.operators import boosting
from shelf.staging import stage

NAMES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(6)
    x = np.stack([rng.integers(0, 9, 1500), rng.normal(0, 1, 1500), rng.random(1500), np.zeros(1500)], axis=1).astype(float)
    y = 3 * x[:, 0] + 5 * np.sin(2 * x[:, 1]) + 4 * (x[:, 2] > 0.6) * x[:, 0] + rng.normal(0, 0.5, 1500)
    return x, y


@pytest.fixture(scope="module")
def rows(spark, data):
    x, y = data
    table = [(*map(float, r), float(t)) for r, t in zip(x, y)]
    return stage(spark.createDataFrame(table, "a double, b double, c double, d double, y double").repartition(3))


def plain_tree(bins, gradient, depth, penalty, rate):
    """The values a tree gives each row, by trying every split of every node."""
    value = np.zeros(len(gradient))

    def score(g):
        return g.sum() ** 2 / (len(g) + penalty)

    def grow(at, level):
        value[at] = -gradient[at].sum() / (len(at) + penalty) * rate
        best = (1e-9, None)
        if level < depth:
            for k in range(bins.shape[1]):
                for cut in range(bins[:, k].max()):
                    left = bins[at, k] <= cut
                    if left.any() and not left.all():
                        gain = (score(gradient[at[left]]) + score(gradient[at[~left]]) - score(gradient[at])) / 2
                        if gain > best[0] * (1 + 1e-9):
                            best = (gain, at[left], at[~left])
        if best[1] is not None:
            grow(best[1], level + 1)
            grow(best[2], level + 1)

    grow(np.arange(len(gradient)), 0)
    return value


def test_trees_equal_brute_force(rows, data, monkeypatch):
    monkeypatch.setattr(boosting, "KEEP", 2)
    x, y = data
    model = boosting.fit_boosted(rows, NAMES, "y", rounds=5, depth=3, bins=8)
    bins = np.stack([boosting._binned(x[:, k], b) for k, b in enumerate(model.borders)], axis=1).astype(int)
    margin = np.full(len(y), y.mean())
    margin[:] = model.base
    assert model.base == pytest.approx(y.mean(), abs=1e-4)
    for _ in range(5):
        margin += plain_tree(bins, margin - y, 3, 1.0, 0.1)
    # Gradients are rounded to a 2 ** -20 share of the labels' scale.
    assert model.predicted(list(x.T)) == pytest.approx(margin, abs=1e-3)


def test_predictions_reach_spark(rows, data):
    x, _ = data
    model = boosting.fit_boosted(rows, NAMES, "y", rounds=3, depth=4)
    made = rows.select(*NAMES, model.prediction([F.col(c) for c in NAMES]).alias("p")).toPandas()
    assert made["p"].to_numpy() == pytest.approx(model.predicted([made[c].to_numpy() for c in NAMES]))


def test_model_does_not_depend_on_partitions(rows):
    models = [
        boosting.fit_boosted(stage(rows.repartition(n)), NAMES, "y", rounds=4, depth=4, bins=16).predicted
        for n in (1, 6)
    ]
    points = [np.linspace(0, 8, 50), np.linspace(-2, 2, 50), np.linspace(0, 1, 50), np.zeros(50)]
    assert models[0](points).tolist() == models[1](points).tolist()


def test_no_worse_than_first_order_boosting(rows, data):
    x, y = data
    model = boosting.fit_boosted(rows, NAMES, "y", rounds=20, depth=4, rate=0.3)
    mine = np.abs(model.predicted(list(x.T)) - y).mean()
    vectors = VectorAssembler(inputCols=NAMES, outputCol="v").transform(rows)
    other = GBTRegressor(featuresCol="v", labelCol="y", maxIter=20, maxDepth=4, maxBins=64, stepSize=0.3).fit(vectors)
    first = other.transform(vectors).select(F.avg(F.abs(F.col("prediction") - F.col("y")))).first()[0]
    assert mine <= first * 1.02


def test_odd_tables(spark, rows):
    model = boosting.fit_boosted(rows.where("false"), NAMES, "y", rounds=3)
    assert model.predicted([np.zeros(2)] * 4).tolist() == [0.0, 0.0] and model.importance() == [0.0] * 4
    same = stage(spark.createDataFrame([(1.0, 7.0)] * 20, "a double, y double"))
    model = boosting.fit_boosted(same, ["a"], "y", rounds=3)
    assert model.predicted([np.array([1.0, np.nan])]).tolist() == [7.0, 7.0]
    with pytest.raises(ValueError):
        boosting.fit_boosted(same, ["a"], "y", bins=300)


def test_importance_favours_what_matters(rows):
    weights = boosting.fit_boosted(rows, NAMES, "y", rounds=10, depth=3).importance()
    assert sum(weights) == pytest.approx(1) and weights[3] == 0 and min(weights[:3]) > 0


def test_levels_plan_no_queries_and_blocks_are_released(spark, rows, monkeypatch):
    calls, kind = [], type(rows)
    made = kind.mapInArrow
    monkeypatch.setattr(kind, "mapInArrow", lambda self, *a, **b: calls.append(1) or made(self, *a, **b))
    kept = spark.sparkContext._jsc.getPersistentRDDs().size()
    boosting.fit_boosted(rows, NAMES, "y", rounds=3, depth=3)
    assert len(calls) <= 2
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == kept
