"""Exact top-k search by inner product: a KD-tree over all vectors, cut into shards.

The upper levels are median splits of a bounded sample; they deal the vectors to shards that are
small in space, and a shard with too many vectors, equal ones included, is parted by hash. Every part
has a tree of its own, which goes on splitting at the median of the widest axis, with tight boxes. A
query's best possible score in a box is the sum over axes of the better of both box sides.
Each query first searches a part of the shard with the best bound; its k-th score there is passed on,
and of all other shards only those are searched whose box can still beat it. In a tree, nodes are
visited best first and skipped once their bound cannot beat the query's k-th best hit.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelf.staging import stage

LEAF = 256
#: Vectors of a part, queries that pass through one copy of a part, and the most shards.
SHARD_ROWS, QUERY_ROWS, MOST_SHARDS = 16384, 1 << 20, 1024
#: Vectors drawn for each shard, and the most numbers in the sample and in the table of boxes.
DRAWN, MOST_NUMBERS = 64, 1 << 22


class Tree:
    """Median splits of integer vectors with tight boxes; leaves are slices of one array."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF):
        self.ids, self.vectors = ids.copy(), vectors.copy()
        self.low, self.high, self.least, self.span, self.child = [], [], [], [], []
        self._grow(0, len(ids), leaf)
        self.low, self.high = np.array(self.low), np.array(self.high)

    def _grow(self, a: int, b: int, leaf: int) -> int:
        node, part = len(self.span), self.vectors[a:b]
        self.low.append(part.min(axis=0))
        self.high.append(part.max(axis=0))
        self.least.append(int(self.ids[a:b].min()))
        self.span.append((a, b))
        self.child.append(None)
        if b - a > leaf:
            axis = int((self.high[node] - self.low[node]).argmax())
            middle = (b - a) // 2
            order = np.argpartition(part[:, axis], middle)
            self.vectors[a:b], self.ids[a:b] = part[order], self.ids[a:b][order]
            left = self._grow(a, a + middle, leaf)
            self.child[node] = (left, self._grow(a + middle, b, leaf))
        return node

    def search(self, own: int, query: np.ndarray, k: int, floor: tuple[int, int] | None) -> list[tuple[int, int]]:
        """The best ``k`` (score, -id) of ids other than ``own`` that are not below ``floor``."""
        bound = np.maximum(self.low * query, self.high * query).sum(axis=1)
        best: list[tuple[int, int]] = []
        todo = [(-int(bound[0]), self.least[0], 0)]
        while todo:
            score, least, node = heapq.heappop(todo)
            reach = (-score, -least)
            if floor is not None and reach < floor or len(best) == k and reach < best[0]:
                continue
            if self.child[node] is not None:
                for c in self.child[node]:
                    heapq.heappush(todo, (-int(bound[c]), self.least[c], c))
                continue
            a, b = self.span[node]
            scores = self.vectors[a:b] @ query
            ids = self.ids[a:b]
            some = np.lexsort((ids, -scores))[: k + 1]
            for s, i in zip(scores[some].tolist(), ids[some].tolist()):
                if i != own:
                    if len(best) < k:
                        heapq.heappush(best, (s, -i))
                    elif (s, -i) > best[0]:
                        heapq.heapreplace(best, (s, -i))
        return best


def whole_vectors(df: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id, dim and the vector floor(scale * x). Null ids, and vectors that are null, empty or
    hold null or non-finite components, are left out."""
    bad = F.exists("embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = df.where("vec_id is not null and embedding is not null and size(embedding) > 0").where(~bad)
    vector = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return kept.select("vec_id", F.size("embedding").alias("dim"), vector.alias("vector"))


def _exact_type(vectors: DataFrame, queries: DataFrame) -> str:
    """The type in which every product and sum is exact: double, which multiplies faster, or long."""
    largest = F.max(F.array_max(F.transform("vector", lambda x: F.greatest(x, -(x + 1)))))
    sizes = [df.agg(largest.alias("top"), F.max("dim").alias("dim")).first() for df in (vectors, queries)]
    # Python's integers have no end; a component of -2 ** 63 counts as its neighbour and one more.
    most = max((sizes[0]["dim"] or 0), 1)
    for size in sizes:
        most *= (size["top"] or 0) + 1
    if most >= 2**63:
        raise ValueError("scores of these vectors do not fit 64-bit integers")
    return "float64" if most < 2**52 else "int64"


class Cuts:
    """Median splits of a sample into at most ``shards`` parts; nodes are (axis, value, left, right) or a shard."""

    def __init__(self, sample: np.ndarray, shards: int):
        self.nodes: list[tuple[int, int, int, int] | int] = []
        self.shards = 0
        self._cut(sample, shards)

    def _cut(self, part: np.ndarray, shards: int) -> int:
        node = len(self.nodes)
        self.nodes.append(0)
        spread = part.max(axis=0) - part.min(axis=0) if len(part) else np.zeros(1)
        if shards > 1 and spread.max() > 0:
            axis = int(spread.argmax())
            # The lower median: values above it are left on the right side unless it is the greatest.
            value = int(np.sort(part[:, axis])[(len(part) - 1) // 2])
            if value == part[:, axis].max():
                value = int(part[part[:, axis] < value, axis].max())
            left = part[:, axis] <= value
            low = self._cut(part[left], shards // 2)
            self.nodes[node] = (axis, value, low, self._cut(part[~left], shards - shards // 2))
        else:
            self.nodes[node] = self.shards
            self.shards += 1
        return node

    def place(self, vectors: np.ndarray) -> np.ndarray:
        """The shard of each vector."""
        shard, todo = np.zeros(len(vectors), np.int64), [(0, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            step = self.nodes[node]
            if isinstance(step, int):
                shard[rows] = step
            elif len(rows):
                left = vectors[rows, step[0]] <= step[1]
                todo += [(step[2], rows[left]), (step[3], rows[~left])]
        return shard


def _matrix(column: pa.Array, dim: int, kind: str) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, dim).astype(kind)


def _by_dim(batch: pa.RecordBatch, dims: str) -> Iterator[tuple[int, pa.RecordBatch]]:
    """The rows of each dimension."""
    column = batch.column(dims).to_numpy()
    for dim in np.unique(column).tolist():
        yield dim, batch.filter(pa.array(column == dim))


def _cuts(vectors: DataFrame, sizes: dict[int, int]) -> dict[int, Cuts]:
    """The upper splits of each dimension, from a sample by hash of the id."""
    found = {}
    for dim, n in sizes.items():
        shards = max(1, min(MOST_SHARDS, -(-n // SHARD_ROWS), MOST_NUMBERS // (2 * dim)))
        rows = min(shards * DRAWN, MOST_NUMBERS // dim)
        share = min(1.0, rows / n)
        thin = F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(1 << 40)) < int(share * (1 << 40))
        some = vectors.where(F.col("dim") == dim).where(thin).select("vector").limit(2 * rows).collect() if shards > 1 else []
        found[dim] = Cuts(np.array([r["vector"] for r in some], np.int64).reshape(len(some), dim), shards)
    return found


def _sharded(vectors: DataFrame, cuts: dict[int, Cuts]) -> DataFrame:
    shared = vectors.sparkSession.sparkContext.broadcast(cuts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, own in _by_dim(batch, "dim"):
                shard = shared.value[dim].place(_matrix(own.column("vector"), dim, "int64"))
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(shard)], names=["vec_id", "dim", "vector", "shard"])

    return vectors.select("vec_id", "dim", "vector").mapInArrow(run, "vec_id long, dim int, vector array<long>, shard long")


class Boxes:
    """For one dimension: shards, their boxes, the cells of their parts, and the bounds of queries."""

    def __init__(self, kind: str):
        self.kind, self.low, self.high, self.cells = kind, [], [], []

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        made = np.empty((len(queries), len(self.cells)), self.kind)
        for k, (low, high) in enumerate(zip(self.low, self.high)):
            made[:, k] = np.maximum(queries * low, queries * high).sum(axis=1)
        return made


def _boxes(sharded: DataFrame, kind: str) -> tuple[dict[int, Boxes], list[tuple[int, int, int, int]]]:
    """The boxes by dimension; and (dim, shard, first cell, parts) of each shard."""
    counts = sharded.groupBy("dim", "shard").agg(F.count("*").alias("n")).orderBy("dim", "shard").collect()
    sides = sharded.select("dim", "shard", F.posexplode("vector").alias("axis", "x")).groupBy("dim", "shard", "axis")
    ends: dict[tuple[int, int], list] = {}
    for r in sides.agg(F.min("x").alias("low"), F.max("x").alias("high")).orderBy("dim", "shard", "axis").collect():
        ends.setdefault((r["dim"], r["shard"]), []).append((r["low"], r["high"]))
    boxes: dict[int, Boxes] = {}
    cells, first = [], 0
    for r in counts:
        own = boxes.setdefault(r["dim"], Boxes(kind))
        parts = -(-r["n"] // SHARD_ROWS)
        low, high = np.array(ends[r["dim"], r["shard"]], np.int64).T.astype(kind)
        own.low.append(low)
        own.high.append(high)
        own.cells.append(list(range(first, first + parts)))
        cells.append((r["dim"], r["shard"], first, parts))
        first += parts
    return boxes, cells


def _asked(queries: DataFrame, boxes: dict[int, Boxes], home: bool) -> DataFrame:
    """Each query once for each cell that it searches: one of the best shard, or all that may beat its floor."""
    shared = queries.sparkSession.sparkContext.broadcast(boxes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, own in _by_dim(batch, "dim"):
                table = shared.value.get(dim)
                if table is None:
                    continue
                bounds = table.bounds(_matrix(own.column("query"), dim, table.kind))
                rows, floors = own.column("q_row").to_pylist(), own.column("floor_score").to_pylist()
                listed = []
                for i in range(own.num_rows):
                    best = table.cells[int(bounds[i].argmax())]
                    first = best[rows[i] % len(best)]
                    if home:
                        listed.append([first])
                    else:
                        may = range(len(table.cells)) if floors[i] is None else np.flatnonzero(bounds[i] >= floors[i]).tolist()
                        listed.append([c for k in may for c in table.cells[k] if c != first])
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(listed, pa.list_(pa.int64()))], names=[*own.schema.names, "cells"])

    given = "query_id long, dim int, query array<long>, q_row long, floor_score long, floor_id long"
    found = queries.select(*[f.split()[0] for f in given.split(", ")]).mapInArrow(run, given + ", cells array<long>")
    return found.withColumn("cell", F.explode("cells")).drop("cells")


_HITS = "query_id long, q_row long, vec_id long, score long"


def _search(cells: DataFrame, asked: DataFrame, k: int, kind: str, copies: int) -> DataFrame:
    """The hits of every query in the cells it asks; a cell's tree is built once, then its queries pass."""
    block = F.pmod(F.xxhash64("query_id", F.lit(1)), F.lit(copies)).cast("int")
    trees = cells.select(
        "cell", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("block"), F.lit(0).alias("asks"),
        F.col("vec_id").alias("id"), F.lit(None).cast("long").alias("q_row"), "vector",
        F.lit(None).cast("long").alias("floor_score"), F.lit(None).cast("long").alias("floor_id"),
    )
    passing = asked.select(
        "cell", block.alias("block"), F.lit(1).alias("asks"), F.col("query_id").alias("id"), "q_row",
        F.col("query").alias("vector"), "floor_score", "floor_id",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, tree = None, [], None
        for batch in batches:
            keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)], axis=1)
            starts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
            hits: list[tuple[int, int, int, int]] = []
            for a, b in zip(starts, starts[1:]):
                if a == b:
                    continue
                part, cell = batch.slice(a, b - a), tuple(keys[a, :2].tolist())
                dim = len(part.column(5)[0])
                if cell != now:
                    now, held, tree = cell, [], None
                if not keys[a, 2]:
                    held.append((part.column(3).to_numpy(), _matrix(part.column(5), dim, kind)))
                    continue
                if tree is None and held:
                    tree = Tree(*[np.concatenate(x) for x in zip(*held)])
                    held = []
                if tree is not None:
                    queries = _matrix(part.column(5), dim, kind)
                    asks = zip(*[part.column(i).to_pylist() for i in (3, 4, 6, 7)])
                    for query, (own, row, score, vec) in zip(queries, asks):
                        floor = None if score is None else (score, -vec)
                        hits += [(own, row, -i, int(s)) for s, i in tree.search(own, query, k, floor)]
            columns = list(zip(*hits)) if hits else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=["query_id", "q_row", "vec_id", "score"]
            )

    rows = trees.unionByName(passing).repartition("cell", "block").sortWithinPartitions("cell", "block", "asks")
    return rows.mapInArrow(run, _HITS)


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best inner products of each query.

    ``vectors`` and ``queries`` are of :func:`whole_vectors`. Ties go to the smaller vec_id; the
    query's own id is no candidate; vectors of another dimension are none either. Fewer candidates
    give fewer rows, an empty table none. Equal vectors under several ids all count. Rows of ``vectors``
    that repeat an id are candidates of their own; queries that share an id but differ have a ranking
    each, equal ones have one. Vectors whose scores could leave 64 bits raise an error.
    Parts of shards have bounded size, and their number grows with the table.
    """
    kind = _exact_type(vectors, queries)
    sizes = {r["dim"]: r["n"] for r in vectors.groupBy("dim").agg(F.count("*").alias("n")).collect()}
    sharded = stage(_sharded(vectors, _cuts(vectors, sizes)), "sharded-vectors")
    boxes, placed = _boxes(sharded, kind)
    # A row for each shard, ``MOST_SHARDS`` at most for each dimension.
    table = F.broadcast(vectors.sparkSession.createDataFrame(placed, "dim int, shard long, first long, parts long"))
    cells = sharded.join(table, ["dim", "shard"]).select(
        "vec_id", "vector", (F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("parts"))).alias("cell")
    )
    nothing = F.lit(None).cast("long")
    asked = stage(queries.select(
        F.col("vec_id").alias("query_id"), "dim", F.col("vector").alias("query"),
        F.abs(F.shiftright(F.xxhash64("vector"), 1)).alias("q_row"),
    ).dropDuplicates(["query_id", "q_row"]), "asked-vectors")
    copies = max(1, -(-asked.count() // QUERY_ROWS))
    first = _asked(asked.withColumns({"floor_score": nothing, "floor_id": nothing}), boxes, True)
    found = stage(_search(cells, first, k, kind, copies), "home-hits")
    worst = F.min(F.struct("score", (-F.col("vec_id")).alias("id")))
    floors = found.groupBy("query_id", "q_row").agg(F.count("*").alias("n"), worst.alias("worst")).where(F.col("n") >= k)
    floors = floors.select(
        "query_id", "q_row", F.col("worst.score").alias("floor_score"), (-F.col("worst.id")).alias("floor_id")
    )
    others = _asked(asked.join(floors, ["query_id", "q_row"], "left"), boxes, False)
    every = found.unionByName(_search(cells, others, k, kind, copies))
    order = Window.partitionBy("query_id", "q_row").orderBy(F.desc("score"), "vec_id")
    return every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )
