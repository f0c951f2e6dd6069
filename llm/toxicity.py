"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A word's vector is the sum of hashed rows for the word itself and for its first four and six
letters, so unseen forms of a known stem still carry its weight. Filters one, two and three words
wide run over the whole text; the maximum of each filter feeds a logistic output. Training and
scoring read every text whole. All labelled rows train: five of six fit the weights, the sixth
calibrates the scores and a threshold for each language.

Training rows are hashed once and kept as blocks, which follow from the rows alone. In each epoch
the tasks fit every block from the same weights; each weight moves by the mean of its blocks' moves,
by rows, over the blocks that moved it. Moves are added up as whole numbers, so that the model does
not depend on the number of tasks. The driver holds the weights, which do not grow with the rows.
"""

from __future__ import annotations

import re
import sys
import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from llm.byte_bpe import codes_of, groups
from llm.common import add_columns, bounded_batches, held
from llm.jaccard_join import _perhaps_in
from shelf.staging import stage

_WORD = re.compile(r"\w+")
_SPACE = re.compile(r"\s")
BUCKETS, DIM, FILTERS, WIDTHS = 1 << 18, 16, 8, (1, 2, 3)
_AHEAD = max(WIDTHS) - 1
_TEXT_PART = 1 << 20
#: Code points whose words are told apart at once.
_GROUP = 1 << 21
_EVERY = FILTERS * len(WIDTHS)
#: A block of training rows ends at this many rows, words or distinct words.
BLOCK_ROWS, BLOCK_WORDS, BLOCK_VOCABULARY = 2048, 1 << 21, 1 << 18
#: Shards that rows of one id are dealt over.
_SPREAD = 4
#: Words that a fit holds vectors of at once; steps of the unit that moves are counted in; bins of a logit.
_RUN, _UNIT, _BINS = 1 << 15, 1 << 24, 256


def buckets(words: list[str] | pa.StringArray) -> np.ndarray:
    """The three hashed rows of each word: crc32 of the word, of "4" and four letters, of "6" and six, these with a space."""
    words = pa.array(words, pa.string()) if isinstance(words, list) else words
    whole = _crc32(words, pc.binary_length(words))
    starts = [_crc32(words, pc.binary_length(pc.utf8_slice_codeunits(words, 0, k)), b"%d" % k, b" ") for k in (4, 6)]
    return (np.stack([whole, *starts], axis=1) % BUCKETS).astype(np.int32)


# The state after one byte from state 0: crc32 starts and ends by turning all bits.
_CRC = np.array([zlib.crc32(bytes([b]), 0xFFFFFFFF) ^ 0xFFFFFFFF for b in range(256)], np.uint32)
#: Bytes of a word that are hashed in step with those of others; longer words are hashed alone.
_STEP_BYTES = 64


def _crc32(words: pa.StringArray, sizes: pa.Array, before: bytes = b"", after: bytes = b"") -> np.ndarray:
    """crc32 of ``before``, the first bytes of each word and ``after``, byte by byte for all words at once."""
    _, offsets, data = words.buffers()
    first = np.frombuffer(offsets, np.int32)[words.offset : words.offset + len(words)]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    sizes = sizes.to_numpy(zero_copy_only=False)
    order = np.argsort(-sizes.clip(max=_STEP_BYTES + 1), kind="stable")
    sizes, first = sizes[order], first[order]
    state = np.full(len(order), zlib.crc32(before) ^ 0xFFFFFFFF, np.uint32)
    long = int((sizes > _STEP_BYTES).sum())
    for i in range(long):
        raw = data[first[i] : first[i] + sizes[i]].tobytes()
        state[i] = zlib.crc32(raw, zlib.crc32(before)) ^ 0xFFFFFFFF
    for k in range(_STEP_BYTES):
        end = int(np.searchsorted(-sizes, -k, "left"))  # words with more than k bytes come first
        if end <= long:
            break
        now = state[long:end]
        state[long:end] = _CRC[(now ^ data[first[long:end] + k]) & 255] ^ (now >> np.uint32(8))
    for byte in after:
        state = _CRC[(state ^ np.uint32(byte)) & 255] ^ (state >> np.uint32(8))
    out = np.empty(len(order), np.int64)
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    return out


@dataclass
class Model:
    rows: np.ndarray
    filters: list[np.ndarray]
    biases: list[np.ndarray]
    out: np.ndarray
    bias: float
    scale: float = 1.0
    shift: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)
    name: str = field(default_factory=lambda: uuid.uuid4().hex)

    def convolve(self, vectors: np.ndarray, w: int) -> np.ndarray:
        """Every filter of one width at every word; ``vectors`` goes ``_AHEAD`` rows further."""
        n = len(vectors) - _AHEAD
        weights, k = self.filters[w], WIDTHS[w]
        return sum(vectors[i : i + n] @ weights[i] for i in range(k)) + self.biases[w]

    def probability(self, pooled: np.ndarray) -> np.ndarray:
        z = (pooled @ self.out + self.bias) * self.scale + self.shift
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def parts(text: str) -> Iterator[tuple[list[str], int]]:
    """Runs of words of a text, and how many of them windows start at.

    Long texts come in bounded parts, cut at white space; windows at the seam are computed in the
    next part, which begins with the last words of this one.
    """
    text, start, carried = text.lower(), 0, []
    while True:
        end = len(text)
        if end - start > _TEXT_PART:
            seam = _SPACE.search(text, start + _TEXT_PART)
            end = seam.start() if seam else end
        words = carried + _WORD.findall(text, start, end)
        if end >= len(text):
            yield words, len(words)
            return
        count = max(0, len(words) - _AHEAD)
        yield words, count
        carried, start = words[count:], end


_word_codes: np.ndarray | None = None


def word_codes() -> np.ndarray:
    """Which code points a word is made of: those that the pattern's ``\\w`` matches."""
    global _word_codes
    if _word_codes is None:
        _word_codes = np.array([c == "_" or c.isalnum() for c in map(chr, range(sys.maxunicode + 1))])
    return _word_codes


def distinct_words(texts: list[str]) -> tuple[pa.StringArray, list[np.ndarray]]:
    """The different words of some lower-case texts; for each text which ones it has, in order."""
    whole = "\0".join(texts)
    codes = codes_of(whole)
    inside = word_codes()[codes]
    edges = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    raw = np.frombuffer(whole.encode(), np.uint8)
    if len(raw) == len(codes):
        size, mask = edges[1::2] - edges[::2], inside
    else:
        width = np.ones(len(codes) + 1, np.uint8)
        for least in (0x80, 0x800, 0x10000):
            width[:-1] += codes >= least
        size = np.add.reduceat(width, edges, dtype=np.int64)[::2] if len(edges) else edges
        mask = np.repeat(inside, width[:-1])
    offsets = np.append(0, np.cumsum(size)).astype(np.int32)
    words = pa.Array.from_buffers(pa.string(), len(size), [None, pa.py_buffer(offsets), pa.py_buffer(raw[mask])])
    found = words.dictionary_encode()
    begin = np.cumsum([0, *[len(t) + 1 for t in texts[:-1]]])
    return found.dictionary, np.split(found.indices.to_numpy(), np.searchsorted(edges[::2], begin[1:]))


def _pieces(texts: list[str]) -> Iterator[tuple[int, str, bool]]:
    """Which text, its lower-case words, and whether it ends there. Long texts are cut at white space."""
    for d, text in enumerate(texts):
        text, start = text.lower(), 0
        while len(text) - start > _TEXT_PART and (seam := _SPACE.search(text, start + _TEXT_PART)):
            yield d, text[start : seam.start()], False
            start = seam.start()
        yield d, text[start:] if start else text, True


class Scorer:
    """Scores of texts: Arrow tells their different words, whose vectors each occurrence takes."""

    def __init__(self, model: Model):
        self.model = model

    def _pool(self, runs: list[tuple[int, int, np.ndarray, int]], tables: list[np.ndarray], pooled: np.ndarray) -> None:
        base = np.cumsum([1, *map(len, tables)])
        table = np.concatenate([np.zeros((1, DIM), np.float32), *tables])
        pad = np.zeros(_AHEAD, np.int64)
        vectors = table[np.concatenate([x for _, t, words, _ in runs for x in (words + base[t], pad)])]
        ends = np.cumsum([len(words) + _AHEAD for _, _, words, _ in runs])
        starts = ends - [len(words) + _AHEAD for _, _, words, _ in runs]
        docs = np.array([d for d, _, _, _ in runs])
        counts = np.array([n for _, _, _, n in runs])
        full = counts > 0
        if not full.any():
            return
        edges = np.stack([starts[full], starts[full] + counts[full]], axis=1).ravel()
        for w in range(len(WIDTHS)):
            made = self.model.convolve(vectors, w)
            made = np.concatenate([made, np.full((_AHEAD + 1, FILTERS), -np.inf, made.dtype)])
            top = np.maximum.reduceat(made, edges, axis=0)[::2]
            np.maximum.at(pooled[:, w * FILTERS : (w + 1) * FILTERS], docs[full], top)

    def score(self, texts: list[str]) -> np.ndarray:
        """The probability of each text. Windows at a seam of a long text are computed behind it."""
        pooled = np.zeros((len(texts), FILTERS * len(WIDTHS)), np.float32)
        runs, tables, size, carried = [], [], 0, []
        for group in groups(list(_pieces(texts)), _GROUP, lambda piece: len(piece[1])):
            vocabulary, found = distinct_words([text for _, text, _ in group])
            tables.append(self.model.rows[buckets(vocabulary)].sum(axis=1))
            for (d, _, last), words in zip(group, found):
                if carried:
                    # The words before the seam come with their vectors.
                    known = len(tables[-1])
                    tables[-1] = np.concatenate([tables[-1], carried.pop()])
                    words = np.append(np.arange(known, len(tables[-1])), words)
                count = len(words) if last else max(0, len(words) - _AHEAD)
                runs.append((d, len(tables) - 1, words, count))
                if not last:
                    carried.append(tables[-1][words[count:]])
                size += len(words)
                if size > 150_000:
                    self._pool(runs, tables, pooled)
                    runs, tables, size = [], [tables[-1]], 0
        if runs:
            self._pool(runs, tables, pooled)
        return self.model.probability(pooled.astype(np.float64))


def held_out(doc_id: str = "doc_id"):
    """Rows that no label is learnt from: crc32 of the id as text is a multiple of five."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """doc_id, text and lang of rows among which all labelled ones are, and doc_id and toxic of each label.

    Held-out rows, null labels, labels other than 0 and 1, and null ids take no part; of several
    labels of one document the larger counts. A null text counts as empty.
    """
    doc_id = F.col("doc_id").cast(docs.schema["doc_id"].dataType).alias("doc_id")
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out())
    known = known.select(doc_id, "toxic").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = known.where("toxic in (0, 1)")
    text = F.coalesce(F.col("text"), F.lit("")).alias("text")
    return _perhaps_in(docs.select("doc_id", text, "lang"), known.select("doc_id")), known


_BLOCK = "checks boolean, shard int, part int, n int, positives int, vocabulary binary, words binary, ends binary, y binary, langs array<string>"


def _all_words(text: str) -> Iterator[list[str]]:
    """The words of a text in bounded parts, each word once."""
    return (words[:count] for words, count in parts(text))


class _Block:
    """Rows of one shard under way: words as places in the block's own vocabulary."""

    def __init__(self) -> None:
        self.place: dict[str, int] = {}
        self.words: list[np.ndarray] = []
        self.ends, self.y, self.langs, self.size = [], [], [], 0

    def add(self, text: str, toxic: int, lang: str | None) -> None:
        for words in _all_words(text):
            for w in set(words).difference(self.place):
                self.place[w] = len(self.place)
            self.words.append(np.fromiter(map(self.place.__getitem__, words), np.int32, len(words)))
            self.size += len(words)
        self.ends.append(self.size)
        self.y.append(toxic)
        self.langs.append(lang)

    def full(self) -> bool:
        return len(self.y) >= BLOCK_ROWS or self.size >= BLOCK_WORDS or len(self.place) >= BLOCK_VOCABULARY

    def row(self, checks: bool, shard: int, part: int) -> pa.RecordBatch:
        made = [
            checks, shard, part, len(self.y), sum(self.y), buckets(list(self.place)).tobytes(),
            b"".join(w.tobytes() for w in self.words), np.array(self.ends, np.int64).tobytes(),
            np.array(self.y, np.int8).tobytes(), self.langs,
        ]
        types = [pa.bool_(), *[pa.int32()] * 4, *[pa.binary()] * 4, pa.list_(pa.string())]
        names = [f.split()[0] for f in _BLOCK.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(made, types)], names=names)


def _block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of texts that come in order of their shard, each after its label; every sixth of a shard checks."""
    own: dict[bool, _Block] = {}
    shard, label, count, part = None, (None, None), 0, 0
    names = ("shard", "doc_id", "text", "toxic", "lang")
    for batch in batches:
        for s, doc_id, text, toxic, lang in zip(*[batch.column(c).to_pylist() for c in names]):
            if s != shard:
                yield from (b.row(c, shard, part) for c, b in own.items())
                own, shard, label, count, part = {}, s, (None, None), 0, 0
            if toxic is not None:
                label = doc_id, toxic
            if toxic is not None or label[0] != doc_id:
                continue
            checks = count % 6 == 5
            count += 1
            block = own.setdefault(checks, _Block())
            block.add(text, label[1], lang)
            if block.full():
                yield own.pop(checks).row(checks, shard, part)
                part += 1
    yield from (b.row(c, shard, part) for c, b in own.items())


def blocks_of(texts: DataFrame, known: DataFrame) -> DataFrame:
    """Stored blocks of the texts with a label; which rows share one does not depend on the cluster.

    Labels travel to the texts' shards, so that texts move once. Texts of one id go to several shards.
    """
    shards = max(1, -(-known.count() // BLOCK_ROWS))
    spread = F.pmod(F.xxhash64("text"), F.lit(_SPREAD)).cast("int").alias("spread")
    rows = texts.select("doc_id", "text", "lang", F.lit(None).cast("int").alias("toxic"), spread)
    every = F.explode(F.sequence(F.lit(0), F.lit(_SPREAD - 1))).alias("spread")
    nothing = [F.lit(None).cast("string").alias(c) for c in ("text", "lang")]
    rows = rows.unionByName(known.select("doc_id", *nothing, "toxic", every))
    shard = F.pmod(F.xxhash64("doc_id", "spread"), F.lit(shards)).cast("int").alias("shard")
    order = F.crc32(F.col("doc_id").cast("string")).alias("order")
    keyed = rows.select(shard, order, "doc_id", "text", "lang", "toxic").repartition("shard")
    ordered = keyed.sortWithinPartitions("shard", "order", "doc_id", F.col("toxic").isNull(), "text", "lang")
    bounded_batches(texts)
    return stage(ordered.mapInArrow(_block_rows, _BLOCK), "toxicity-blocks")


def _docs_of(row: dict) -> list[np.ndarray]:
    """The hashed rows of each word of each document of a block, when asked for."""
    vocabulary = np.frombuffer(row["vocabulary"], np.int32).reshape(-1, 3)
    words, ends = np.frombuffer(row["words"], np.int32), np.frombuffer(row["ends"], np.int64).tolist()
    return [vocabulary[words[a:b]] for a, b in zip([0, *ends], ends)]


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield {name: batch.column(i)[k].as_py() for i, name in enumerate(batch.schema.names)}


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many rows of each class hold each bucket."""
    for row in _rows_of(batches):
        seen = np.zeros((2, BUCKETS), np.int64)
        vocabulary = np.frombuffer(row["vocabulary"], np.int32).reshape(-1, 3)
        words, ends = np.frombuffer(row["words"], np.int32), np.frombuffer(row["ends"], np.int64).tolist()
        for a, b, c in zip([0, *ends], ends, np.frombuffer(row["y"], np.int8).tolist()):
            seen[c][np.unique(vocabulary[np.unique(words[a:b])])] += 1
        at = np.flatnonzero(seen.any(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(seen[0, at]), pa.array(seen[1, at])], names=["bucket", "clean", "toxic"]
        )


@dataclass
class _Fit:
    """A model under way, with the sums of squared gradients that Adagrad keeps."""

    model: Model
    past_rows: np.ndarray
    past: list[np.ndarray]

    def copy(self) -> _Fit:
        m = self.model
        own = replace(m, rows=m.rows.copy(), filters=[f.copy() for f in m.filters], biases=[b.copy() for b in m.biases], out=m.out.copy())
        return _Fit(own, self.past_rows.copy(), [np.array(p) for p in self.past])

    def small(self) -> list[np.ndarray]:
        """All weights but the hashed rows, then their sums."""
        m = self.model
        return [*m.filters, *m.biases, m.out, np.array([m.bias]), *self.past]

    def tail(self) -> np.ndarray:
        """``small`` as rows as wide as the hashed ones."""
        flat = np.concatenate([np.asarray(x, np.float64).ravel() for x in self.small()])
        return np.append(flat, np.zeros(-len(flat) % DIM)).reshape(-1, DIM)

    def move_tail(self, by: np.ndarray) -> None:
        flat, at = by.ravel(), 0
        for k, x in enumerate(self.small()):
            step = flat[at : at + x.size].reshape(x.shape)
            at += x.size
            if k == 2 * len(WIDTHS) + 1:
                self.model.bias += float(step[0])
            else:
                x += step.astype(x.dtype)


def _begin(seed: int, odds: np.ndarray | float = 0.0) -> _Fit:
    """Starting weights. The first dimension of the hashed rows starts at ``odds``."""
    rng = np.random.default_rng(seed)
    rows = rng.normal(0, 0.03, (BUCKETS, DIM)).astype(np.float32)
    rows[:, 0] = odds
    filters = [rng.normal(0, 0.2, (k, DIM, FILTERS)).astype(np.float32) for k in WIDTHS]
    for weights in filters:
        weights[0, 0] = np.abs(weights[0, 0]) + 0.5
    biases = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
    model = Model(rows, filters, biases, np.full(_EVERY, 0.15), -2.0)
    past = [np.full(f.shape, 1e-3) for f in (*filters, *biases, model.out, np.zeros(1))]
    return _Fit(model, np.full(BUCKETS, 1e-3, np.float32), past)


def _peaks(model: Model, docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Each filter's maximum over each document, zero at least, and the hashed words it lies at (else -1)."""
    pooled = np.zeros((len(docs), _EVERY), np.float32)
    found = np.full((len(docs), _EVERY, _AHEAD + 1, 3), -1, np.int32)
    weights = np.concatenate([f[i].T for f in model.filters for i in range(len(f))])
    bias = np.concatenate(model.biases)[:, None]
    pad, ahead = np.full((_AHEAD, 3), -1, np.int32), np.arange(_AHEAD + 1)

    def flush(run: list[tuple[int, np.ndarray, int]]) -> None:
        ids = np.concatenate([x for _, words, _ in run for x in (words, pad)])
        vectors = model.rows[ids[:, 0]]
        vectors += model.rows[ids[:, 1]]
        vectors += model.rows[ids[:, 2]]
        vectors[ids[:, 0] < 0] = 0
        products = weights @ vectors.T
        n, made, top = len(ids) - _AHEAD, [], 0
        for k in WIDTHS:
            steps = [products[top + i * FILTERS : top + (i + 1) * FILTERS, i : i + n] for i in range(k)]
            made.append(sum(steps[1:], steps[0]))
            top += k * FILTERS
        made = np.concatenate(made) + bias
        at = 0
        for d, words, count in run:
            part = made[:, at : at + count]
            peak = part.argmax(axis=1)
            value = part[np.arange(_EVERY), peak]
            new = np.flatnonzero(value > pooled[d])
            pooled[d, new] = value[new]
            found[d, new] = ids[at + peak[new][:, None] + ahead]
            at += len(words) + _AHEAD

    run, size = [], 0
    for d, ids in enumerate(docs):
        for low in range(0, len(ids), _RUN):
            # A piece goes on into the next one by the words that its last windows need.
            run.append((d, ids[low : low + _RUN + _AHEAD], min(_RUN, len(ids) - low)))
            size += len(run[-1][1])
            if size >= _RUN:
                flush(run)
                run, size = [], 0
    if run:
        flush(run)
    return pooled, found


def _fit(
    words: list[np.ndarray], y: np.ndarray, epochs: int, seed, fit: _Fit | None = None, weight: tuple[float, float] = (1.0, 1.0)
) -> Model:
    """Adagrad on the log loss over rows in memory, from ``fit``, which it moves."""
    rng = np.random.default_rng(seed)
    fit = fit or _begin(seed)
    model, rows, rate = fit.model, fit.model.rows, 0.05
    past, past_b = fit.past[: len(WIDTHS)], fit.past[len(WIDTHS) : 2 * len(WIDTHS)]
    past_out, past_bias = fit.past[2 * len(WIDTHS) :]
    share = np.where(y == 1, weight[1], weight[0])
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for low in range(0, len(order), 32):
            batch = order[low : low + 32]
            pooled, found = _peaks(model, [words[i] for i in batch])
            p = 1 / (1 + np.exp(-np.clip(pooled @ model.out + model.bias, -30, 30)))
            slope = share[batch] * (p - y[batch]) / len(batch)
            back = (slope[:, None] * model.out[None, :] * (pooled > 0)).astype(np.float32)
            step = pooled.T @ slope + 1e-4 * model.out
            past_out += step**2
            model.out -= rate * step / np.sqrt(past_out)
            past_bias += slope.sum() ** 2
            model.bias -= float(rate * slope.sum() / np.sqrt(past_bias[0]))
            places, pushes = [], []
            for w, k in enumerate(WIDTHS):
                g = back[:, w * FILTERS : (w + 1) * FILTERS]
                change = np.zeros_like(model.filters[w])
                for i in range(k):
                    ids = found[:, w * FILTERS : (w + 1) * FILTERS, i]
                    live = ids[..., 0] >= 0
                    vectors = rows[ids].sum(axis=2) * live[..., None]
                    change[i] = np.einsum("df,dfe->ef", g, vectors)
                    live &= np.abs(g) > 1e-9
                    places.append(ids[live])
                    pushes.append((g[..., None] * model.filters[w][i].T[None])[live])
                past[w] += change**2
                model.filters[w] -= (rate * change / np.sqrt(past[w])).astype(np.float32)
                past_b[w] += g.sum(axis=0) ** 2
                model.biases[w] -= (rate * g.sum(axis=0) / np.sqrt(past_b[w])).astype(np.float32)
            flat, pushes = np.concatenate(places).ravel(), np.repeat(np.concatenate(pushes), 3, axis=0)
            if len(flat):
                by = np.argsort(flat, kind="stable")
                first = np.flatnonzero(np.diff(flat[by], prepend=-1))
                hit, sums = flat[by][first], np.add.reduceat(pushes[by], first, axis=0)
                fit.past_rows[hit] += (sums**2).mean(axis=1)
                rows[hit] -= rate * sums / np.sqrt(fit.past_rows[hit])[:, None]
    return model


_MOVES = [f"d{i}" for i in range(DIM)]


def _moved(shared, epoch: int, seed: int, weight: tuple[float, float]):
    """One epoch over each block, from the shared weights: by how much its rows moved what, in units."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows_of(batches):
            start, y = shared.value, np.frombuffer(row["y"], np.int8)
            own = start.copy()
            _fit(_docs_of(row), y.astype(np.float64), 1, [seed, epoch, row["shard"], row["part"]], own, weight)
            at = np.flatnonzero(own.past_rows != start.past_rows)
            tail = own.tail() - start.tail()
            move = np.concatenate([(own.model.rows[at] - start.model.rows[at]).astype(np.float64), tail])
            past = np.append((own.past_rows[at] - start.past_rows[at]).astype(np.float64), np.zeros(len(tail)))
            names = np.append(at, BUCKETS + np.arange(len(tail))).astype(np.int32)
            units = [np.rint(x * (_UNIT * len(y))).astype(np.int64) for x in (past, *move.T)]
            # Only the rows that this block moved travel.
            yield pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (names, np.full(len(names), len(y), np.int64), *units)],
                names=["bucket", "n", "past", *_MOVES],
            )

    return run


def train(docs: DataFrame, labels: DataFrame, epochs: int = 10, seed: int = 0) -> Model:
    """Fit on all labelled rows that are not held out. Without both classes the score is constant."""
    with _dropped_shuffles(docs.sparkSession):
        return _trained(blocks_of(*training_rows(docs, labels)), epochs, seed)


@contextmanager
def _dropped_shuffles(spark: SparkSession) -> Iterator[None]:
    """Each query in here drops its shuffle files when it ends; the epochs' would add up."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _trained(blocks: DataFrame, epochs: int, seed: int) -> Model:
    sizes = {r["checks"]: (r["n"], r["p"]) for r in blocks.groupBy("checks").agg(F.sum("n").alias("n"), F.sum("positives").alias("p")).collect()}
    fits = blocks.where("not checks")
    n, p = sizes.get(False, (0, 0))
    if p in (0, n):
        model = _begin(seed).model
        model.out[:] = 0
        model.bias = 6.0 if p else -6.0
    else:
        model = _fit_blocks(fits, n, p, epochs, seed)
    every, positives = (sum(x) for x in zip((0, 0), *sizes.values()))
    if positives not in (0, every) and True in sizes:
        _calibrate(model, blocks.where("checks"))
    return model


def _fit_blocks(blocks: DataFrame, n: int, positives: int, epochs: int, seed: int) -> Model:
    """Weights from all ``blocks``. The first dimension starts at the rows' class log odds; classes weigh the same."""
    context = blocks.sparkSession.sparkContext
    counted = blocks.mapInArrow(_counted, "bucket int, clean long, toxic long").groupBy("bucket").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")
    ).toArrow()
    seen = np.zeros((2, BUCKETS))
    seen[:, counted["bucket"].to_numpy()] = counted["clean"].to_numpy(), counted["toxic"].to_numpy()
    odds = np.log((seen[1] + 0.5) / (positives + 1)) - np.log((seen[0] + 0.5) / (n - positives + 1))
    total = seen.sum(axis=0)
    fit = _begin(seed, odds * total / (total + 4) / 4)
    weight = (n / (2 * (n - positives)), n / (2 * positives))
    schema = ", ".join(["bucket int", *[f"{c} long" for c in ("n", "past", *_MOVES)]])
    for epoch in range(epochs):
        shared = context.broadcast(fit)
        moves = blocks.mapInArrow(_moved(shared, epoch, seed, weight), schema).groupBy("bucket").agg(
            *[(F.sum(c) / F.sum("n") / F.lit(float(_UNIT))).cast("float").alias(c) for c in ("past", *_MOVES)]
        ).toArrow()
        shared.destroy()
        # The tasks had their own copy: the weights move in place, a column at a time.
        at = moves["bucket"].to_numpy()
        row, tail = at < BUCKETS, np.zeros_like(fit.tail())
        fit.past_rows[at[row]] += moves["past"].to_numpy()[row]
        for i, c in enumerate(_MOVES):
            move = moves[c].to_numpy()
            fit.model.rows[at[row], i] += move[row]
            tail[at[~row] - BUCKETS, i] = move[~row]
        fit.move_tail(tail)
        del moves
        pa.default_memory_pool().release_unused()
    return fit.model


def _calibrate(model: Model, blocks: DataFrame) -> None:
    """Platt scaling on the rows of ``blocks``, then a threshold by language.

    Tasks count the rows of each class by language and logit, in bins of 1 / ``_BINS``.
    """
    shared = blocks.sparkSession.sparkContext.broadcast(model)

    def logits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows_of(batches):
            docs, own = _docs_of(row), shared.value
            z = [_peaks(own, docs[k : k + 32])[0].astype(np.float64) @ own.out + own.bias for k in range(0, len(docs), 32)]
            bins = np.rint(np.clip(np.concatenate(z), -40, 40) * _BINS).astype(np.int32)
            y = np.frombuffer(row["y"], np.int8).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(row["langs"], pa.string()), pa.array(y), pa.array(bins)], names=["lang", "y", "bin"])

    made = blocks.mapInArrow(logits, "lang string, y int, bin int").groupBy("lang", "y", "bin").agg(F.count("*").alias("n"))
    counts = stage(made, "toxicity-logits")
    shared.destroy()
    z, y, n = _columns(counts.groupBy("y", "bin").agg(F.sum("n").alias("n")))
    a, b, weight = 1.0, 0.0, n / n.sum()
    if len(set(y.tolist())) == 2:
        for _ in range(400):
            p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
            slope = weight * (p - y)
            a -= 0.02 * ((slope * z).sum() + 0.02 * (a - 1))
            b -= 0.05 * (slope.sum() + 0.002 * b)
    model.scale, model.shift = max(a, 0.1), b
    classes = counts.where("lang is not null").groupBy("lang").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("y")).alias("p")
    )
    for lang in sorted(r["lang"] for r in classes.where("n >= 20 and p >= 3 and n - p >= 3").select("lang").collect()):
        z, y, n = _columns(counts.where(F.col("lang") == lang))
        score = 1 / (1 + np.exp(-np.clip(z * model.scale + model.shift, -40, 40)))
        model.thresholds[lang] = _best_threshold(score, y, n)


def _columns(counts: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Logit, class and number of rows of counted bins, in order."""
    found = counts.toArrow().sort_by([("bin", "ascending"), ("y", "ascending")])
    return found["bin"].to_numpy() / _BINS, found["y"].to_numpy(), found["n"].to_numpy().astype(np.float64)


def _best_threshold(score: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The cut with the best F1; of equally good ones that nearest to one half."""
    ranked = np.unique(np.append(score, [0.0, 1.0]))
    marks = np.append((ranked[1:] + ranked[:-1]) / 2, 0.5)
    order = np.argsort(score)
    below = np.searchsorted(score[order], marks, "left")
    hits, falls = (np.append(0, np.cumsum((weight * (y == c))[order])) for c in (1, 0))
    hit, false = hits[-1] - hits[below], falls[-1] - falls[below]
    wrong = false + hits[below]
    gain = 2 * hit / np.maximum(2 * hit + wrong, 1e-9)
    return float(min(zip(-gain, np.abs(marks - 0.5), marks))[2])


def score(docs: DataFrame, model: Model, text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` with ``score`` (0 to 1), ``predicted`` (score at least one half), ``threshold`` and ``flagged``.

    Only the text enters the score; a null text counts as empty, whose score is that of a text
    without words. ``threshold`` is the one of the row's language, one half for unknown or null
    languages; ``flagged`` means score >= threshold. Repeated rows stay.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(texts):
        scorer = held("toxicity", shared.value.name, lambda: Scorer(shared.value))
        return [scorer.score([t or "" for t in texts])]

    done = add_columns(docs, [text], [StructField("score", DoubleType())], compute)
    cut = F.lit(0.5)
    for name, value in model.thresholds.items():
        cut = F.when(F.col(lang) == name, value).otherwise(cut)
    return (
        done.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
        .withColumn("threshold", cut)
        .withColumn("flagged", F.col("score") >= F.col("threshold"))
    )


def keep_clean(docs: DataFrame, model: Model, text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` that the classifier does not flag, with all columns of ``docs`` as they are."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    slim = docs.select(whole, F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang"))
    return score(slim, model).where(~F.col("flagged")).select("row.*")
