"""Boosted regression trees of second order, grown from histograms.

A round fits one tree to the gradients and second derivatives of the squared
loss. Each level of a tree is one pass over the binned rows: tasks add up
gradients and weights by (node, feature, bin), Spark adds these sums up over
the tasks, and the driver, which sees a histogram of fixed size, picks the splits
by the gain of Newton steps with an L2 penalty. Of two sister nodes only the
smaller is counted; the other is the rest of their parent.

Gradients are rounded to a fixed unit, so their sums are exact in any order: the
number of tasks or a repeated task does not change the model.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelf.operators.quantiles import even_borders
from shelf.staging import stage

# Ship the histograms with the task: executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rounds after which the margins are written, so that a lost block is not made from all trees again.
KEEP = 25

# Rows of a block, at least, where a task has that many.
BLOCK = 1 << 15

# Tasks whose histograms the driver adds up itself.
DIRECT = 32

# Bits below the labels' scale to which gradients are rounded.
UNIT_BITS = 20


@dataclass
class Tree:
    """Nodes in heap order: the feature and bin of the split (feature -1: a leaf) and the value."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray
    gain: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        nodes = (1 << (depth + 1)) - 1
        return cls(np.full(nodes, -1), np.zeros(nodes, int), np.zeros(nodes), np.zeros(nodes))

    def leaves(self, bins: np.ndarray) -> np.ndarray:
        """The node at which each row of ``bins`` ends."""
        node, rows = np.zeros(len(bins), np.int64), np.arange(len(bins))
        while True:
            split = self.feature[node]
            inner = split >= 0
            if not inner.any():
                return node
            right = bins[rows, np.maximum(split, 0)] > self.cut[node]
            node = np.where(inner, 2 * node + 1 + right, node)


def _binned(values: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Bin b holds the values above border b - 1 up to border b; NaN comes last."""
    return np.searchsorted(borders, values, "left").astype(np.uint8)


@dataclass
class BoostedModel:
    """Trees over binned features; a prediction is the base plus the trees' values."""

    features: list[str]
    borders: list[np.ndarray]
    base: float
    trees: list[Tree] = field(default_factory=list)

    def predicted(self, values: Sequence[np.ndarray]) -> np.ndarray:
        bins = np.stack([_binned(v, b) for v, b in zip(values, self.borders)], axis=1)
        return self.base + sum((t.value[t.leaves(bins)] for t in self.trees), np.zeros(len(bins)))

    def prediction(self, columns: Sequence[Column]) -> Column:
        """The prediction for columns of doubles, in the order of ``features``."""
        model = self

        @F.pandas_udf("double")
        def run(frame):
            import pandas as pd

            return pd.Series(model.predicted([frame.iloc[:, k].to_numpy(np.float64) for k in range(frame.shape[1])]))

        return run(F.struct(*[c.alias(f"f{k}") for k, c in enumerate(columns)]))

    def importance(self) -> list[float]:
        """The mean gain of a feature's splits, as a share of all features'."""
        total, splits = np.zeros(len(self.features)), np.zeros(len(self.features))
        for tree in self.trees:
            inner = tree.feature >= 0
            np.add.at(total, tree.feature[inner], tree.gain[inner])
            np.add.at(splits, tree.feature[inner], 1)
        mean = total / np.maximum(splits, 1)
        return (mean / mean.sum() if mean.sum() else mean).tolist()

    def save(self, spark: SparkSession, path: str) -> None:
        """A table of borders and a table of nodes below ``path``."""
        borders = [(k, n, [float(x) for x in b]) for k, (n, b) in enumerate(zip(self.features, self.borders))]
        spark.createDataFrame(borders, "feature int, name string, borders array<double>").write.mode(
            "overwrite"
        ).parquet(f"{path}/borders")
        nodes = [
            (k, n, int(t.feature[n]), int(t.cut[n]), float(t.value[n]), float(t.gain[n]), self.base)
            for k, t in enumerate([Tree.empty(0), *self.trees]) for n in range(len(t.feature))
        ]
        spark.createDataFrame(
            nodes, "tree int, node int, feature int, cut int, value double, gain double, base double"
        ).write.mode("overwrite").parquet(f"{path}/nodes")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> BoostedModel:
        """The model that :meth:`save` wrote; its tables have a row for each border and node."""
        borders = spark.read.parquet(f"{path}/borders").orderBy("feature").collect()
        nodes = spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").toPandas()
        model = cls([r["name"] for r in borders], [np.array(r["borders"]) for r in borders], float(nodes["base"][0]))
        for _, own in nodes[nodes["tree"] > 0].groupby("tree"):
            model.trees.append(Tree(*(own[c].to_numpy() for c in ("feature", "cut", "value", "gain"))))
        return model


def _store(rows: DataFrame, features: Sequence[str], label: str, borders: list[np.ndarray], base: float) -> DataFrame:
    """Blocks of rows as bytes: x (a byte for each row and feature, its bin), y and m (the margin)."""

    def block(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        bins, labels = (np.concatenate(p) for p in zip(*parts))
        made = (bins, labels, np.full(len(labels), base))
        return pa.RecordBatch.from_arrays([pa.array([v.tobytes()], pa.binary()) for v in made], names=["x", "y", "m"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            *values, labels = (c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns)
            waiting.append((np.stack([_binned(v, b) for v, b in zip(values, borders)], axis=1), labels))
            if sum(len(y) for _, y in waiting) >= BLOCK:
                yield block(waiting)
                waiting = []
        if waiting:
            yield block(waiting)

    return stage(rows.select(*features, label).mapInArrow(run, "x binary, y binary, m binary"), "binned")


def _blocks(table: DataFrame, width: int) -> RDD:
    """The stored blocks as arrays, kept in the executors: passes over them neither read nor plan."""

    def arrays(row) -> tuple[np.ndarray, ...]:
        return np.frombuffer(row[0], np.uint8).reshape(-1, width), np.frombuffer(row[1]), np.frombuffer(row[2])

    return table.rdd.map(arrays).persist(StorageLevel.MEMORY_AND_DISK)


def _moved(blocks: RDD, tree: Tree) -> RDD:
    """The blocks with the tree added to their margins."""

    def move(block: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
        bins, labels, margin = block
        return bins, labels, margin + tree.value[tree.leaves(bins)]

    return blocks.map(move).persist(StorageLevel.MEMORY_AND_DISK)


def _written(spark: SparkSession, blocks: RDD) -> DataFrame:
    """The blocks as a stage table, which ends their line of maps."""
    rows = blocks.map(lambda block: tuple(bytearray(v.tobytes()) for v in block))
    return stage(spark.createDataFrame(rows, "x binary, y binary, m binary"), "margins")


def _histograms(blocks: RDD, tree: Tree, asked: Sequence[int], width: int, bins: int, unit: float) -> np.ndarray:
    """(node, feature, bin, 2): gradients in units and rows of the ``asked`` nodes, one pass."""
    place = np.full(len(tree.feature), -1)
    place[list(asked)] = np.arange(len(asked))
    cells = len(asked) * width * bins

    def run(own: Iterator[tuple[np.ndarray, ...]]) -> Iterator[np.ndarray]:
        hist = np.zeros((2, cells))
        for x, labels, margin in own:
            gradient = np.rint((margin - labels) / unit)
            node = place[tree.leaves(x)]
            at = np.flatnonzero(node >= 0)
            first = (node[at, None] * width + np.arange(width)) * bins
            cell = (first + x[at]).ravel()
            hist[0] += np.bincount(cell, np.repeat(gradient[at], width), cells)
            hist[1] += np.bincount(cell, None, cells)
        yield hist

    # Many tasks' histograms, of a fixed size each, meet in other tasks before the driver adds up the last.
    depth = 1 if blocks.getNumPartitions() <= DIRECT else 2
    return blocks.mapPartitions(run).treeReduce(np.add, depth).T.reshape(len(asked), width, bins, 2)


def _best(hist: np.ndarray, penalty: float, least: float) -> tuple[float, int, int, np.ndarray] | None:
    """Gain, feature, bin and left sums of the best split of a node's (feature, bin, 2) histogram."""
    left = hist.cumsum(axis=1)[:, :-1]
    whole = hist[0].sum(axis=0)
    right = whole - left

    def score(sums):
        return sums[..., 0] ** 2 / (sums[..., 1] + penalty)

    gain = (score(left) + score(right) - score(whole)) / 2
    gain = np.where((left[..., 1] >= least) & (right[..., 1] >= least), gain, 0.0)
    feature, cut = np.unravel_index(int(gain.argmax()), gain.shape)
    if gain[feature, cut] <= 0:
        return None
    return float(gain[feature, cut]), int(feature), int(cut), left[feature, cut]


def _grow(
    blocks: RDD, depth: int, width: int, bins: int, unit: float, rate: float, penalty: float, least: float
) -> Tree:
    tree = Tree.empty(depth)

    def value(sums: np.ndarray) -> float:
        return float(-sums[0] * unit / (sums[1] + penalty) * rate)

    asked, parents, known = [0], {}, {}
    for level in range(depth):
        made = _histograms(blocks, tree, asked, width, bins, unit)
        known = dict(zip(asked, made))
        # A sister is what is left of the parent.
        for node, (parent, sister) in parents.items():
            known[sister] = parent - known[node]
        if level == 0:
            tree.value[0] = value(known[0][0].sum(axis=0))
        asked, parents = [], {}
        for node in sorted(known):
            found = _best(known[node], penalty, least)
            if found is None:
                continue
            tree.gain[node], tree.feature[node], tree.cut[node], left = found
            right = known[node][0].sum(axis=0) - left
            children = (2 * node + 1, 2 * node + 2)
            tree.value[children[0]], tree.value[children[1]] = value(left), value(right)
            small, large = children if left[1] <= right[1] else children[::-1]
            asked.append(small)
            parents[small] = (known[node], large)
        if not asked:
            break
    return tree


def fit_boosted(
    rows: DataFrame,
    features: Sequence[str],
    label: str,
    *,
    rounds: int = 100,
    rate: float = 0.1,
    depth: int = 6,
    bins: int = 64,
    penalty: float = 1.0,
    least: float = 1.0,
) -> BoostedModel:
    """Fit on ``rows``, whose features and label are doubles without nulls; the fit runs at once.

    ``bins`` (256 at most) bounds the bins of a feature, which hold about as many rows each.
    ``penalty`` is the L2 weight of a leaf's value, ``least`` the rows a leaf must have. No rows give
    a model that predicts zero. Pass a table with as many partitions as tasks should work on it.
    """
    if not 2 <= bins <= 256:
        raise ValueError("bins must be between 2 and 256")
    whole = rows.agg(F.count(label).alias("n"), F.avg(label).alias("mean"), F.max(F.abs(label)).alias("top")).first()
    borders = [np.array(b) for b in even_borders(rows, features, bins)]
    unit = 2.0 ** (math.ceil(math.log2(max(whole["top"] or 0.0, 1e-300))) - UNIT_BITS)
    base = round((whole["mean"] or 0.0) / unit) * unit
    model = BoostedModel(list(features), borders, base)
    if not whole["n"]:
        return model
    width = len(features)
    blocks, before = _blocks(_store(rows, features, label, borders, base), width), None
    for done in range(rounds):
        tree = _grow(blocks, depth, width, bins, unit, rate, penalty, least)
        model.trees.append(tree)
        if before is not None:
            before.unpersist()
        before, blocks = blocks, _moved(blocks, tree)
        if (done + 1) % KEEP == 0 and done + 1 < rounds:
            written = _blocks(_written(rows.sparkSession, blocks), width)
            blocks.unpersist()
            blocks = written
    for kept in (before, blocks):
        if kept is not None:
            kept.unpersist()
    return model
