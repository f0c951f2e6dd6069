"""The trie of all conversations' prefixes, from sorted shards and a skeleton of splitter paths.

1. Every turn becomes a 16-byte digest of its role and text, and a conversation's path is the
   digests of its turns end to end. Nodes are prefixes of paths; sorted paths hold every subtree in
   one run, a node's own conversations first.
2. A bounded sample of paths gives the splitters. (path, conv_id) decides the shard, so copies of one
   conversation spread over shards as well. A node that reaches over a border is a prefix of the
   splitter there; the trie of the splitters' prefixes, the skeleton, is small and is broadcast.
3. Each shard walks its sorted paths with a stack. Nodes outside the skeleton lie in one shard and are
   finished there. Skeleton nodes leave partial sums, which are reduced over the shards and added up
   along the skeleton.
4. The ids that end at a skeleton node leave as packed pieces in order and are hashed piece by piece.

The turns of one conversation must fit in a row: 16 bytes and a word count for each.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import bounded_batches
from shelf.staging import stage

WIDTH = 16
#: Splitters: turns that a shard should hold, the most shards, and the turns that a splitter keeps.
SHARD_TURNS, MOST_SHARDS, SPLITTER_TURNS = 100_000, 4096, 256
SAMPLE_PER_SHARD = 32
PIECE = 1 << 16


def turns(rows: DataFrame) -> DataFrame:
    """conv_id and its turns in order, each the digest and the words of its text.

    Turns are ordered by ``turn``, null first, then by role and digest, so repeated and tied turns
    have one order. Null roles and texts are empty. Rows without a conv_id belong to no conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    named = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    slim = rows.where("conv_id is not null").select(
        "conv_id", "turn", role.alias("role"), F.unhex(F.substring(F.sha2(named, 256), 1, 2 * WIDTH)).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )
    order = F.struct(F.col("turn").isNotNull().alias("known"), "turn", "role", "digest", "words")
    # Rows meet by their family, which rebuilding needs; a family is at most 39 conversations.
    families = slim.withColumn("family", family()).repartition("family")
    gathered = families.groupBy("family", "conv_id").agg(F.sort_array(F.collect_list(order)).alias("turns"))
    return gathered.withColumn("turns", F.transform("turns", lambda t: F.struct(t["digest"], t["words"])))


def family() -> Column:
    return F.col("conv_id") - F.col("conv_id") % 20


def rebuilt(rows: DataFrame) -> DataFrame:
    """conv_id, path and words: the family head's first h turns, then the conversation's own after h."""
    own = turns(rows)
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int")
    heads = own.where("conv_id = family").select("family", F.slice("turns", 1, 3).alias("head"))
    whole = own.join(heads.hint("merge"), "family", "left").withColumn("h", h)
    none = F.array().cast("array<struct<digest: binary, words: bigint>>")
    head = F.expr("slice(head, 1, h)")
    rest = F.expr("slice(turns, h + 1, greatest(size(turns) - h, 0))")
    made = whole.withColumn("turns", F.concat(F.coalesce(head, none), rest))
    # A binary's concat of an array's members: as hexadecimal text and back.
    path = F.unhex(F.array_join(F.transform("turns", lambda t: F.hex(t["digest"])), ""))
    return made.select("conv_id", path.alias("path"), F.transform("turns", lambda t: t["words"]).alias("words"))


@dataclass
class Skeleton:
    """Splitters in order, and the trie of their prefixes: node 0 is the root."""

    splitters: list[tuple[bytes, int]]
    parent: list[int] = field(default_factory=lambda: [-1])
    depth: list[int] = field(default_factory=lambda: [0])
    child: dict[tuple[int, bytes], int] = field(default_factory=dict)

    def __post_init__(self):
        for path, _ in self.splitters:
            node = 0
            for k in range(0, len(path), WIDTH):
                key = (node, path[k : k + WIDTH])
                if key not in self.child:
                    self.child[key] = len(self.parent)
                    self.parent.append(node)
                    self.depth.append(self.depth[node] + 1)
                node = self.child[key]


def skeleton(paths: DataFrame, shards: int | None = None) -> Skeleton:
    """Splitters from a sample by hash: about ``SAMPLE_PER_SHARD`` rows a shard, at most twice that.

    The sample decides how even the shards are, never the result. A splitter keeps its first
    ``SPLITTER_TURNS`` turns, so the skeleton is at most shards x turns x 16 bytes.
    """
    session = paths.sparkSession
    if shards is None:
        whole = paths.agg(F.count("*").alias("n"), F.sum(F.size("words") + 1).alias("turns")).first()
        wanted = max(int(session.conf.get("spark.sql.shuffle.partitions")), (whole["turns"] or 0) // SHARD_TURNS + 1)
        shards, rows = min(wanted, MOST_SHARDS, max(1, whole["n"] // 4)), whole["n"]
    else:
        rows = paths.count()
    share = min(1.0, shards * SAMPLE_PER_SHARD / max(1, rows))
    drawn = paths.where(F.pmod(F.xxhash64("conv_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    cut = F.substring("path", 1, WIDTH * SPLITTER_TURNS).alias("path")
    some = drawn.select(cut, "conv_id").limit(2 * shards * SAMPLE_PER_SHARD).collect()
    keys = sorted((bytes(r["path"]), r["conv_id"]) for r in some)
    return Skeleton(sorted({keys[len(keys) * i // shards] for i in range(1, shards)}) if keys else [])


_ROWS = (
    "kind int, node long, seq long, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "n_children long, n_leaves long, saved_tokens long, words long, ends string"
)
_NAMES = [f.split()[0] for f in _ROWS.split(", ")]
FINISHED, BELOW_SKELETON, PARTIAL, IDS = range(4)


class _Node:
    __slots__ = ("depth", "least", "n", "words", "children", "leaves", "saved", "waiting", "ends", "bone")

    def __init__(self, depth: int, words: int, bone: int | None):
        self.depth, self.words, self.bone = depth, words, bone
        self.least: int | None = None
        self.n = self.children = self.leaves = self.saved = 0
        self.waiting: list[tuple] = []
        self.ends = hashlib.sha256() if bone is None else []


class _Walk:
    """The nodes of one shard's sorted (path, conv_id, words) rows."""

    def __init__(self, bones: Skeleton, shard: int):
        self.bones, self.out = bones, []
        self.seq = shard << 32
        self.stack: list[_Node] = []
        self.path = b""

    def add(self, path: bytes, conv_id: int, words: list[int]) -> None:
        if not self.stack:
            self.stack = [_Node(0, 0, 0)]
        deep, shared = len(path) // WIDTH, self._shared(path)
        while len(self.stack) - 1 > shared:
            self._close()
        for d in range(shared, deep):
            top = self.stack[-1].bone
            bone = None if top is None else self.bones.child.get((top, path[d * WIDTH : (d + 1) * WIDTH]))
            self.stack.append(_Node(d + 1, words[d], bone))
        self.path = path
        end = self.stack[-1]
        end.n += 1
        end.least = conv_id if end.least is None or conv_id < end.least else end.least
        text = str(conv_id)
        if end.bone is not None:
            end.ends.append(text)
            if len(end.ends) * 20 >= PIECE:
                self._ids(end)
        else:
            end.ends.update((text if end.n == 1 else "," + text).encode())

    def _shared(self, path: bytes) -> int:
        if path == self.path:
            return len(path) // WIDTH
        low, high = 0, min(len(path), len(self.path)) // WIDTH
        while low < high:
            mid = (low + high + 1) // 2
            if path[: mid * WIDTH] == self.path[: mid * WIDTH]:
                low = mid
            else:
                high = mid - 1
        return low

    def _row(self, *values) -> None:
        self.out.append(values)

    def _ids(self, node: _Node) -> None:
        if node.ends:
            self._row(IDS, node.bone, self.seq, *[None] * 8, ",".join(node.ends))
            self.seq += 1
            node.ends = []

    def _close(self) -> None:
        node = self.stack.pop()
        above = self.stack[-1] if self.stack else None
        if node.bone is None:
            node.leaves = node.leaves or 1
            node.saved += (node.n - 1) * node.words
            for child in node.waiting:
                self._row(FINISHED, None, None, *child[:2], node.least, *child[2:])
            mine = (
                node.least, node.depth, node.n, node.children, node.leaves, node.saved, None, node.ends.hexdigest(),
            )
            above.children += 1
            above.leaves += node.leaves
            above.saved += node.saved
            if above.bone is None:
                above.waiting.append(mine)
            else:
                self._row(BELOW_SKELETON, above.bone, None, *mine[:2], None, *mine[2:])
        else:
            self._ids(node)
            self._row(
                PARTIAL, node.bone, None, node.least, node.depth, None, node.n, node.children, node.leaves,
                node.saved, node.words, None,
            )
        if above is not None:
            above.n += node.n
            above.least = node.least if above.least is None or node.least < above.least else above.least

    def close(self) -> None:
        while self.stack:
            self._close()

    def take(self) -> pa.RecordBatch:
        rows, self.out = self.out, []
        types = [pa.int32(), *[pa.int64()] * 10, pa.string()]
        columns = list(zip(*rows)) if rows else [[]] * len(types)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=_NAMES)


def _walked(paths: DataFrame, bones: Skeleton) -> DataFrame:
    """Rows of all shards; a shard's rows are read in order and left as its nodes close."""
    shared = paths.sparkSession.sparkContext.broadcast(bones)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitters = shared.value.splitters
        for batch in batches:
            keys = zip(batch.column(1).to_pylist(), batch.column(0).to_pylist())
            shard = [bisect_right(splitters, key) for key in keys]
            yield pa.RecordBatch.from_arrays([pa.array(shard, pa.int64()), *batch.columns], names=["shard", *batch.schema.names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk, last = None, None
        for batch in batches:
            for shard, conv_id, path, words in zip(*[c.to_pylist() for c in batch.columns]):
                if shard != last:
                    if walk is not None:
                        walk.close()
                        yield walk.take()
                    walk, last = _Walk(shared.value, shard), shard
                walk.add(path, conv_id, words)
            yield walk.take()
        if walk is not None:
            walk.close()
            yield walk.take()

    placed = paths.select("conv_id", "path", "words").mapInArrow(
        place, "shard long, conv_id long, path binary, words array<long>"
    )
    ordered = placed.repartition("shard").sortWithinPartitions("shard", "path", "conv_id")
    return stage(ordered.mapInArrow(run, _ROWS), "trie-rows")


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, ends_sha256) of ordered pieces (node, seq, ends)."""
    done: list[tuple[int, str]] = []
    node, state = None, None
    for batch in batches:
        for own, piece in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if own != node:
                if state is not None:
                    done.append((node, state.hexdigest()))
                node, state = own, hashlib.sha256(piece.encode())
            else:
                state.update(b"," + piece.encode())
    if state is not None:
        done.append((node, state.hexdigest()))
    yield pa.RecordBatch.from_arrays(
        [pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.string())],
        names=["node", "ends_sha256"],
    )


def _added_up(bones: Skeleton, parts: dict[int, dict], ends: dict[int, str]) -> list[tuple]:
    """The finished skeleton: children come after their parents, so sums run from the last node."""
    count = len(bones.parent)
    children = [parts[k]["n_children"] for k in range(count)]
    leaves = [parts[k]["n_leaves"] for k in range(count)]
    saved = [parts[k]["saved_tokens"] + (parts[k]["n_convs"] - 1) * parts[k]["words"] for k in range(count)]
    for k in range(count - 1, 0, -1):
        leaves[k] = leaves[k] or 1
        above = bones.parent[k]
        children[above] += 1
        leaves[above] += leaves[k]
        saved[above] += saved[k]
    leaves[0] = leaves[0] or 1
    empty = hashlib.sha256().hexdigest()
    return [
        (
            k, parts[k]["conv_id"], bones.depth[k], parts[bones.parent[k]]["conv_id"] if k else None,
            parts[k]["n_convs"], children[k], leaves[k], saved[k], ends.get(k, empty),
        )
        for k in range(count)
    ]


def trie(conversations: DataFrame, shards: int | None = None) -> DataFrame:
    """One row for each prefix of the rebuilt ``conversations`` (conv_id, turn, role, text).

    conv_id (smallest member), depth, parent_conv_id (null for the root), n_convs, n_children,
    n_leaves, saved_tokens and ends_sha256, the hash of the ids that end at the node. Turns that tie
    are ordered by role and digest; rows that repeat a turn are turns of their own. Rows without a
    conv_id are left out; other columns are ignored; an empty table gives no rows, not even a root.
    """
    bounded_batches(conversations)
    paths = stage(rebuilt(conversations), "trie-paths")
    bones = skeleton(paths, shards)
    rows = _walked(paths, bones)
    partial = rows.where(F.col("kind") == PARTIAL).groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.max("words").alias("words"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    pieces = rows.where(F.col("kind") == IDS).select("node", "seq", "ends").repartition("node")
    hashed = pieces.sortWithinPartitions("node", "seq").mapInArrow(_hashed, "node long, ends_sha256 string")
    # Both have a row for each node of the skeleton at most.
    parts = {r["node"]: r.asDict() for r in partial.collect()}
    ends = {r["node"]: r["ends_sha256"] for r in hashed.collect()}
    session = conversations.sparkSession
    upper = session.createDataFrame(
        _added_up(bones, parts, ends) if parts else [],
        "node long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, ends_sha256 string",
    )
    wanted = upper.columns[1:]
    finished = rows.withColumnRenamed("ends", "ends_sha256")
    above = F.broadcast(upper.select("node", F.col("conv_id").alias("above")))
    below = finished.where(F.col("kind") == BELOW_SKELETON).drop("parent_conv_id").join(above, "node")
    return (
        finished.where(F.col("kind") == FINISHED).select(*wanted)
        .unionByName(below.withColumnRenamed("above", "parent_conv_id").select(*wanted))
        .unionByName(upper.select(*wanted))
    )
