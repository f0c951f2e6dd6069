"""Near-duplicate join on word n-grams: a chosen-path join with exact verification.

1. Every text becomes the set of its five-word shingles. Documents with equal sets are copies;
   one row for each set goes on.
2. Candidate search by chosen paths. In each of several runs a set picks some of its tokens by
   hash, about ``BRANCHING`` in expectation, and lands in their buckets; similar sets share picks.
   A bucket that fits one block is brute-forced on sketches (64 minhash bytes). A larger one draws
   a leader and links all members whose sketch is near it. If these are at least half, the bucket
   is dense and splitting would not help; then the other members are brute-forced against all, in
   blocks. Else the bucket splits: a sketch position holds (in a byte) the token that the position's
   hash order puts first, a sampled token that similar sets share, and the members go to the buckets
   of ``CHILDREN`` sampled tokens. A bucket whose members are already linked to each other ends at
   once, however large. The number of runs follows from the target recall, splits included.
3. Candidates that hang together form clusters. The shingle sets of each cluster are compared
   exactly, all against all in blocks of bounded size, on bit rows over the shared shingles. This
   gives the number of links of every set and the final groups.

Links never travel as pairs: tasks send counts, and one edge for each member to hold a group together.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField

from llm.common import add_columns, held
from llm.components import components
from shelf.staging import stage

_WORD = re.compile(r"\w+")
SKETCH = 64
BRANCHING = 1.25
SMALL = 64
#: Sketches that agree on fewer positions (34 of 64) are no candidates; see recall_of.
NEAR = 34 / SKETCH
BLOCK_SETS, BLOCK_TOKENS = 2048, 1 << 21
#: Children of a member of a splitting bucket, and the share of a bucket that a child is taken to keep.
CHILDREN, KEPT, MOST_RUNS = 2, 1 / 64, 64
MARK_WORDS = 1 << 18
_rng = np.random.default_rng(20240607)
_ODD = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SALT = _rng.integers(0, 1 << 63, 256, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: str, n: int = 5) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the runs of ``n`` words, lower case.

    A text of one to ``n`` - 1 words has one shingle, all of it; a text without words has none.
    """
    found = _WORD.findall(text.lower())
    if not found:
        return np.zeros(0, np.uint64)
    known = held("jaccard_join", "words", dict)
    if len(known) > 250_000:
        known.clear()
    for w in set(found).difference(known):
        known[w] = xxhash.xxh3_64_intdigest(w)
    words = np.fromiter(map(known.__getitem__, found), np.uint64, len(found))
    n = min(n, len(words))
    made = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        made = _mix(made + words[i : len(words) - n + 1 + i])
    return np.unique(made)


def _loss(threshold: float, runs: int, splits: int) -> float:
    """The probability that a pair at the threshold is never a candidate, at its greatest.

    Sets of a and b tokens, c of them shared, meet in a bucket of a run by a shared token that both
    pick, which the larger set does with probability BRANCHING / max(a, b): c / max(a, b) is least,
    for a given similarity, where one set contains the other, and is then the similarity itself.
    A bucket that splits keeps the pair together if one of ``CHILDREN`` drawn sketch positions agrees.
    The sketch is the same in all runs, so the loss is summed over how many positions agree; with
    fewer than NEAR of them the pair is no candidate in any run.
    """
    needed = math.ceil(NEAR * SKETCH - 1e-9)
    # Values of one byte: positions with different minima agree by chance as well.
    same = threshold + (1 - threshold) / 256
    meet = 1 - math.exp(-BRANCHING * threshold)
    total = 0.0
    for k in range(SKETCH + 1):
        share = math.comb(SKETCH, k) * same**k * (1 - same) ** (SKETCH - k)
        stays = (1 - (1 - k / SKETCH) ** CHILDREN) ** splits
        total += share * ((1 - meet * stays) ** runs if k >= needed else 1.0)
    return total


def splits_for(rows: int) -> int:
    """Splits in a row that bring a bucket of all ``rows`` down to one block."""
    return max(0, math.ceil(math.log(max(1, rows) / BLOCK_SETS) / -math.log(KEPT)))


def runs_for(recall: float, threshold: float, splits: int) -> int:
    """Runs after which a pair at the threshold is a candidate with probability ``recall``.

    Holds for pairs that share only buckets which split ``splits`` times, as those of tokens that very
    many sets have; other pairs are found with a higher probability.
    """
    for runs in range(1, MOST_RUNS + 1):
        if _loss(threshold, runs, splits) <= 1 - recall:
            return runs
    raise ValueError(f"{MOST_RUNS} runs on sketches of {SKETCH} positions do not reach a recall of {recall} at {threshold}")


def recall_of(runs: int, threshold: float, splits: int) -> float:
    """The least probability that a pair at the threshold is found, where its buckets split ``splits`` times."""
    return 1 - _loss(threshold, runs, splits)


def describe(tokens: np.ndarray, runs: int) -> tuple[bytes, int, bytes, list[int]]:
    """Digest, size, sketch and first path buckets of a set."""
    digest = xxhash.xxh3_128_digest(tokens.tobytes())
    if not len(tokens):
        return digest, 0, bytes(SKETCH), []
    least = np.full(SKETCH, np.iinfo(np.uint64).max, np.uint64)
    paths: list[np.ndarray] = []
    share = min(1.0, BRANCHING / len(tokens))
    bound = np.uint64(min(int(share * 2**64), 2**64 - 1))
    for low in range(0, len(tokens), 8192):
        part = tokens[low : low + 8192]
        least = np.minimum(least, (part[:, None] * _ODD[None, :SKETCH]).min(axis=0))
        keyed = _mix(part[:, None] ^ _SALT[None, :runs])
        at, run = np.nonzero(keyed <= bound)
        paths.append(_mix(keyed[at, run] + _SALT[128 + run]))
    sketch = (_mix(least) >> np.uint64(56)).astype(np.uint8).tobytes()
    made = np.unique(np.concatenate(paths)).view(np.int64).tolist()
    return digest, len(tokens), sketch, made


def _row_key() -> Column:
    """A digest of doc_id and text: tells rows apart, also those of one id or of none."""
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), F.lit("|"), F.coalesce("text", F.lit("")))
    return F.unhex(F.md5(named)).alias("row_key")


def sets(docs: DataFrame, n: int, runs: int) -> DataFrame:
    """doc_id, row_key, digest, size, sketch and paths of each row of ``docs``; the text is not kept."""
    fields = [
        StructField("digest", BinaryType()), StructField("size", LongType()),
        StructField("sketch", BinaryType()), StructField("paths", ArrayType(LongType())),
    ]

    def compute(texts):
        return list(zip(*[describe(shingles(t or "", n), runs) for t in texts])) if texts else [[]] * 4

    return add_columns(docs.select("doc_id", "text", _row_key()), ["text"], fields, compute).drop("text")


def _fixed(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, width)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest index that each of ``n`` items reaches over the links ``a``-``b``."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        step = label.copy()
        np.minimum.at(step, label[a], low)
        np.minimum.at(step, label[b], low)
        np.minimum.at(step, a, low)
        np.minimum.at(step, b, low)
        step = step[step]
        if (step == label).all():
            return label
        label = step


def _grouped(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that rows with equal first ``keys`` columns, which are adjacent, stay together."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        while batch.num_rows:
            ends = [c[batch.num_rows - 1].as_py() for c in batch.columns[:keys]]
            same = np.ones(batch.num_rows, bool)
            for c in batch.columns[:keys]:
                # Arrow compares whole byte strings; NumPy would drop zero bytes at their ends.
                same &= pc.equal(c, c[batch.num_rows - 1]).to_numpy(zero_copy_only=False)
            start = batch.num_rows - int(same[::-1].argmin() if not same.all() else batch.num_rows)
            heads = [c[0].as_py() for c in batch.columns[:keys]]
            if held and heads != last and start == 0:
                yield _joined(held)
                held = []
            if start:
                yield _joined([*held, batch.slice(0, start)])
                held = []
            held.append(batch.slice(start))
            last = ends
            batch = batch.slice(batch.num_rows)
    if held:
        yield _joined(held)


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    return parts[0] if len(parts) == 1 else pa.concat_batches(parts)


_EDGE = "a binary, b binary"


def _edges(a: list, b: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])


def _bucket_links(threshold: float):
    """Links within whole buckets of (path, digest, size, sketch), as edges to one member."""

    def alike(size, sketch, i, j):
        fits = np.minimum(size[i], size[j]) >= threshold * np.maximum(size[i], size[j]) - 1e-9
        return fits & ((sketch[i] == sketch[j]).sum(axis=1) >= NEAR * SKETCH)

    def small(path, size, sketch):
        for d in range(1, len(path)):
            i = np.flatnonzero(path[d:] == path[:-d])
            if not len(i):
                break
            i = i[alike(size, sketch, i, i + d)]
            yield i, i + d

    def medium(size, sketch):
        # The first member leads; only those that are not like it are compared with all.
        every = np.arange(len(size))
        near = alike(size, sketch, every, 0)
        yield every[near], np.zeros(near.sum(), np.int64)
        for i in np.flatnonzero(~near).tolist():
            met = np.flatnonzero(alike(size, sketch, every, i))
            yield np.full(len(met), i), met

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _grouped(batches, 1):
            path, size = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            sketch, names = _fixed(batch.column(3), SKETCH), batch.column(1).to_pylist()
            starts = np.flatnonzero(np.append(True, path[1:] != path[:-1]))
            members = np.diff(np.append(starts, len(path)))
            tiny = np.flatnonzero(np.repeat(members <= SMALL, members))
            found = [(tiny[i], tiny[j]) for i, j in small(path[tiny], size[tiny], sketch[tiny])]
            for k in np.flatnonzero(members > SMALL).tolist():
                at = slice(starts[k], starts[k] + members[k])
                found += [(i + starts[k], j + starts[k]) for i, j in medium(size[at], sketch[at])]
            if not found:
                continue
            root = _roots(len(path), *(np.concatenate(x) for x in zip(*found)))
            member = np.flatnonzero(root != np.arange(len(path)))
            yield _edges([names[k] for k in member], [names[k] for k in root[member]])

    return run


def _led(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of large buckets against their leader; and the buckets they may split into."""
    for batch in batches:
        if not batch.num_rows:
            continue
        path = batch.column(0).to_numpy()
        sketch, lead = _fixed(batch.column(2), SKETCH), _fixed(batch.column(5), SKETCH)
        own, leader = batch.column(3).to_pylist(), batch.column(6).to_pylist()
        near = ((sketch == lead).sum(axis=1) >= NEAR * SKETCH).tolist()
        name = batch.column(4).to_pylist()
        linked = [n if x and a != b else None for n, x, a, b in zip(name, near, own, leader)]
        label = [b if x else a for x, a, b in zip(near, own, leader)]
        unsigned = path.view(np.uint64)
        children = []
        for salt in range(1, CHILDREN + 1):
            at = (_mix(unsigned + _SALT[200 + salt]) % np.uint64(SKETCH)).astype(np.int64)
            value = sketch[np.arange(len(path)), at].astype(np.uint64)
            children.append(_mix(_mix(unsigned + _SALT[210 + salt]) + value * np.uint64(1 << 20) + at.astype(np.uint64)))
        paths = np.stack(children, axis=1).view(np.int64).tolist()
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns[:3], pa.array(label, pa.binary()), pa.array(linked, pa.binary()),
                pa.array([b if x else None for x, b in zip(near, leader)], pa.binary()),
                pa.array(paths, pa.list_(pa.int64())),
            ], names=["path", "digest", "sketch", "label", "linked", "led", "paths"],
        )


def _dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The members that are not near the leader against a block of all members."""
    for batch in _grouped(batches, 3):
        keys = [batch.column(i).to_numpy() for i in range(3)]
        change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
        for a, b in zip([0, *change.tolist()], [*change.tolist(), batch.num_rows]):
            part = batch.slice(a, b - a)
            asks = part.column(3).to_numpy(zero_copy_only=False).astype(bool)
            sketch, names = _fixed(part.column(5), SKETCH), part.column(4).to_pylist()
            rest = np.flatnonzero(~asks)
            found_a, found_b = [], []
            for i in np.flatnonzero(asks).tolist():
                alike = rest[(sketch[rest] == sketch[i]).sum(axis=1) >= NEAR * SKETCH]
                found_a.append(np.full(len(alike), i))
                found_b.append(alike)
            if not found_a:
                continue
            root = _roots(len(names), np.concatenate(found_a), np.concatenate(found_b))
            member = np.flatnonzero(root != np.arange(len(names)))
            yield _edges([names[k] for k in member], [names[k] for k in root[member]])


def _blocks_of_dense(led: DataFrame, dense: DataFrame) -> DataFrame:
    """Rows (path, i, j, asks, digest, sketch): block i of the far members meets block j of all."""
    rows = led.join(dense, "path")
    hashed = F.xxhash64(F.col("digest"), F.lit(5))
    far = F.ceil((F.col("members") - F.col("near")) / BLOCK_SETS)
    every = F.ceil(F.col("members") / BLOCK_SETS)
    own_i, own_j = F.pmod(hashed, far), F.pmod(hashed, every)

    def meets(i, j, asks: bool):
        return F.struct(i.alias("i"), j.alias("j"), F.lit(asks).alias("asks"))

    asked = F.transform(F.sequence(F.lit(0).cast("long"), far - 1), lambda i: meets(i, own_j, False))
    asking = F.transform(F.sequence(F.lit(0).cast("long"), every - 1), lambda j: meets(own_i, j, True))
    both = F.when(F.col("led").isNull(), F.concat(asked, asking)).otherwise(asked)
    return rows.select("path", "digest", "sketch", F.explode(both).alias("meets")).select(
        "path", "meets.i", "meets.j", "meets.asks", "digest", "sketch"
    )


def candidates(reps: DataFrame, threshold: float) -> DataFrame:
    """Edges (a, b) whose components hold every pair found alike in a bucket."""
    level = reps.select(F.explode("paths").alias("path"), "digest", F.col("digest").alias("label"))
    # These tables grow with the input and are joined by merging, never broadcast.
    seen = reps.select("digest", "size", "sketch").hint("merge")
    block = max(SMALL, BLOCK_SETS)
    edges = []
    while True:
        # A set that is alone in a bucket has nothing to meet there: such rows are left out first,
        # and only the others get their sketches.
        counted = level.groupBy("path").agg(F.count("*").alias("members")).where("members > 1")
        shared = stage(counted, "shared-buckets")
        whole = shared.where(F.col("members") <= block).select("path").hint("merge")
        inside = level.select("path", "digest").join(whole, "path", "left_semi").join(seen, "digest")
        ordered = inside.select("path", "digest", "size", "sketch").repartition("path")
        edges.append(ordered.sortWithinPartitions("path", "digest").mapInArrow(_bucket_links(threshold), _EDGE))
        over = shared.where(F.col("members") > block).select("path")
        if over.isEmpty():
            break
        rows = stage(level.join(over, "path", "left_semi").join(seen.drop("size"), "digest"), "large-buckets")
        drawn = F.struct(F.xxhash64("path", "digest").alias("draw"), "digest", "sketch", "label")
        large = rows.groupBy("path").agg(
            F.min("label").alias("low"), F.max("label").alias("high"), F.min(drawn).alias("lead")
        ).where("low <> high")
        led = stage(
            rows.join(large, "path").select(
                "path", "digest", "sketch", "label", F.col("lead.digest").alias("lead_digest"),
                F.col("lead.sketch").alias("lead_sketch"), F.col("lead.label").alias("lead_label"),
            ).mapInArrow(
                _led, "path long, digest binary, sketch binary, label binary, linked binary, led binary, paths array<long>"
            ), "led",
        )
        edges.append(led.where("linked is not null").select(F.col("digest").alias("a"), F.col("linked").alias("b")))
        shares = stage(led.groupBy("path").agg(F.count("*").alias("members"), F.count("led").alias("near")), "shares")
        closing = 2 * F.col("near") >= F.col("members")
        dense = shares.where(closing & (F.col("near") < F.col("members")))
        blocks = _blocks_of_dense(led, dense).repartition("path", "i", "j")
        edges.append(blocks.sortWithinPartitions("path", "i", "j").mapInArrow(_dense, _EDGE))
        sparse = led.join(shares.where(~closing).select("path"), "path", "left_semi")
        level = sparse.select(F.explode("paths").alias("path"), "digest", "label")
    found = edges[0]
    for more in edges[1:]:
        found = found.unionByName(more)
    return found


def _compare(threshold: float):
    """Exact links within a group of sets, or between the two blocks of a pair."""
    share = Fraction(str(threshold))
    top, bottom = share.numerator, share.numerator + share.denominator

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _grouped(batches, 3):
            keys = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2)], axis=1)
            label = batch.column(0).to_pylist()
            new = [k for k in range(1, len(label)) if label[k] != label[k - 1] or (keys[k] != keys[k - 1]).any()]
            for a, b in zip([0, *new], [*new, len(label)]):
                yield _links(batch.slice(a, b - a), top, bottom)

    return run


def _links(group: pa.RecordBatch, top: int, bottom: int) -> pa.RecordBatch:
    names, place = np.unique(np.array(group.column(4).to_pylist(), object), return_index=True)
    raw = [np.frombuffer(group.column(6)[int(i)].as_py(), np.uint64) for i in place]
    size = np.array([len(r) for r in raw])
    order = np.argsort(size, kind="stable")
    names, size, place = names[order], size[order], place[order]
    block = group.column(3).to_numpy()[place]
    copies = group.column(5).to_numpy()[place]
    n = len(names)
    flat = np.concatenate([raw[i] for i in order])
    owner = np.repeat(np.arange(n), size)
    _, token, often = np.unique(flat, return_inverse=True, return_counts=True)
    dense = np.cumsum(often > 1) - 1
    shared = often[token] > 1
    bits = np.zeros((n, -(-max(1, int(dense[-1]) + 1) // 64) * 64 // 8), np.uint8) if n else np.zeros((0, 8), np.uint8)
    column = dense[token[shared]]
    np.bitwise_or.at(bits, (owner[shared], column // 8), (1 << (column % 8)).astype(np.uint8))
    words = bits.view(np.uint64)
    links, label = np.zeros(n, np.int64), np.arange(n)
    mixed = block.min() != block.max() if n else False
    for i in range(n - 1):
        stop = int(np.searchsorted(size, size[i] * (bottom - top) / top + 1e-6, "right"))
        if stop <= i + 1:
            continue
        both = np.bitwise_count(words[i + 1 : stop] & words[i]).sum(axis=1, dtype=np.int64)
        hit = both * bottom >= top * (size[i + 1 : stop] + size[i])
        if mixed:
            hit &= block[i + 1 : stop] != block[i]
        j = np.flatnonzero(hit) + i + 1
        if not len(j):
            continue
        links[i] += copies[j].sum()
        links[j] += copies[i]
        met = np.unique(np.append(label[j], label[i]))
        if len(met) > 1:
            label[np.isin(label, met)] = met[0]
    root = [names[r] if r != k else None for k, r in enumerate(label.tolist())]
    return pa.RecordBatch.from_arrays(
        [pa.array(names.tolist(), pa.binary()), pa.array(links, pa.int64()), pa.array(root, pa.binary())],
        names=["digest", "links", "root"],
    )


def _perhaps_in(docs: DataFrame, member: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose doc_id shares a hash mark with one of ``member``.

    No row of a member is lost; most texts of others stay where they are instead of being shuffled.
    The marks are ``MARK_WORDS`` words of 64 bits at most, however many members there are, so they
    are safe to broadcast; when all are set, every row passes.
    """
    at = F.pmod(F.xxhash64("doc_id"), F.lit(64 * MARK_WORDS))
    word, bit = "shiftright(at, 6) AS word", "CAST(at & 63 AS INT) AS bit"
    marks = member.select(at.alias("at")).selectExpr(word, bit).groupBy("word").agg(
        F.expr("bit_or(shiftleft(1L, bit))").alias("marks")
    )
    rows = docs.select("*", at.alias("at")).selectExpr(*docs.columns, word, bit)
    met = F.expr("d.word = m.word AND getbit(m.marks, d.bit) = 1")
    return rows.alias("d").join(F.broadcast(marks).alias("m"), met, "left_semi").select(*docs.columns)


def _classified(docs: DataFrame, threshold: float, n: int, recall: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows' sets (doc_id, row_key, digest, size), the label of each digest, and its links."""
    runs = runs_for(recall, threshold, splits_for(docs.count()))
    own = stage(sets(docs, n, runs), "shingle-sets")
    reps = stage(
        own.where("size > 0").groupBy("digest").agg(
            F.count("*").alias("copies"), F.min("doc_id").alias("doc_id"), F.first("size").alias("size"),
            F.first("sketch").alias("sketch"), F.first("paths").alias("paths"),
        ), "distinct-sets",
    )
    clusters = components(candidates(reps, threshold))
    member = reps.join(clusters.withColumnRenamed("node", "digest"), "digest").select(
        "digest", "label", "copies", "doc_id", "size"
    )
    totals = member.groupBy("label").agg(F.count("*").alias("members"), F.sum("size").alias("tokens"))
    blocks = F.ceil(F.greatest(F.col("members") / BLOCK_SETS, F.col("tokens") / BLOCK_TOKENS)).cast("int")
    member = stage(member.join(totals.withColumn("blocks", blocks).drop("members", "tokens"), "label"), "members")

    def tokens(ids, texts, digests):
        found = [shingles(t or "", n) for t in texts]
        right = [xxhash.xxh3_128_digest(f.tobytes()) == d for f, d in zip(found, digests)]
        return [[f.tobytes() if r else None for f, r in zip(found, right)]]

    texts = _perhaps_in(docs.select("doc_id", "text"), member).join(
        member.withColumnRenamed("doc_id", "rep_id"), F.col("doc_id").eqNullSafe(F.col("rep_id"))
    )
    filled = add_columns(texts, ["doc_id", "text", "digest"], [StructField("tokens", BinaryType())], tokens)
    block = F.pmod(F.xxhash64("digest"), F.col("blocks")).cast("int")
    filled = filled.where("tokens is not null").withColumn("block", block)
    pairs = filled.select(
        "label", "block", "digest", "copies", "tokens",
        F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"),
    )
    keyed = pairs.select(
        "label", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "block", "digest", "copies", "tokens",
    )
    ordered = keyed.repartition("label", "low", "high").sortWithinPartitions("label", "low", "high")
    linked = stage(ordered.mapInArrow(_compare(threshold), "digest binary, links long, root binary"), "exact-links")
    final = components(linked.where("root is not null").select(F.col("digest").alias("a"), F.col("root").alias("b")))
    counts = linked.groupBy("digest").agg(F.sum("links").alias("links"))
    grouped = reps.select("digest", "copies", "doc_id").join(
        final.withColumnRenamed("node", "digest"), "digest", "left"
    ).withColumn("label", F.coalesce("label", "digest"))
    return own, grouped, counts


def near_duplicates(
    docs: DataFrame, threshold: float = 0.8, n: int = 5, recall: float = 0.99999
) -> DataFrame:
    """doc_id, class_id, n_links for every row of ``docs`` (doc_id, text).

    Two documents are linked when the Jaccard similarity of their ``n``-word shingle sets is at
    least ``threshold``; a class is a group connected by links, named by its smallest doc_id.
    ``n_links`` counts the linked documents, copies included. A null text counts as empty; a text
    without words links to nothing and is a class of its own. Rows that repeat a text are copies of
    each other; a null doc_id takes part but names no class unless all ids of the class are null.
    An empty table gives no rows. Other columns are ignored.
    """
    own, grouped, counts = _classified(docs, threshold, n, recall)
    named = grouped.groupBy("label").agg(F.min("doc_id").alias("class_id"))
    classes = grouped.join(named, "label").join(counts, "digest", "left").select(
        "digest", "class_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    return own.select("doc_id", "digest", "size").join(classes, "digest", "left").select(
        "doc_id", F.when(F.col("size") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
    )


def keep_one(docs: DataFrame, threshold: float = 0.8, n: int = 5, recall: float = 0.99999) -> DataFrame:
    """One row of ``docs`` for each class of near duplicates: that with the smallest doc_id, null last.

    Rows are told apart by doc_id and text, so different texts under one id, and rows without an id,
    are judged each for itself; of rows equal in both one stays. Texts without words are no near
    duplicates of others. The columns are those of ``docs``.
    """
    own, grouped, _ = _classified(docs, threshold, n, recall)
    named = own.where("size > 0").select("digest", F.struct(
        F.col("doc_id").isNull().alias("nameless"), "doc_id", "row_key"
    ).alias("who"))
    # One name for each digest first, so that a text with very many copies is combined before the join.
    least = named.groupBy("digest").agg(F.min("who").alias("who")).join(grouped.select("digest", "label"), "digest")
    chosen = least.groupBy("label").agg(F.min("who").alias("who")).select(F.col("who.row_key").alias("row_key"))
    wordless = own.where("size = 0").select("row_key").distinct()
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    # The key is the join's and the aggregate's, so rows move once.
    kept = docs.select(whole, _row_key()).join(chosen.unionByName(wordless).hint("merge"), "row_key", "left_semi")
    return kept.dropDuplicates(["row_key"]).select("row.*")
