"""What each filter of a chain removes, in every order of the filters.

A byte transducer reads every text once: ``CLASS`` gives the class of a byte, ``NEXT`` the state
after it (inside a word or not) and ``EMIT`` what a byte says in a state: a word starts, a word has
ended, a code point, a capital, a symbol. The state after a byte depends on that byte only, so all
positions of a batch are looked up at once. Word spans go into an open-addressing hash table;
whether a slot holds the same word is decided by comparing the bytes, never by the hash.

Filters are predicates over these counts, so a document is a set of failed filters, and everything
the audit reports follows from the number of documents for each such set: counts travel, not texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.common import bounded_batches, text_or_empty

_SPACES = np.array([0x20, *range(0x09, 0x0E)])
SYMBOLS = b"#$%&*|"
# Classes of bytes: white space, continuation of a code point, capital, symbol, any other lead byte.
SPACE, REST, CAPITAL, SYMBOL, OTHER = range(5)
CLASS = np.full(256, OTHER, np.uint8)
CLASS[0x80:0xC0] = REST
CLASS[ord("A") : ord("Z") + 1] = CAPITAL
CLASS[list(SYMBOLS)] = SYMBOL
CLASS[_SPACES] = SPACE
# The state after a class, and what a class emits in state 0 (outside of words) and 1 (in a word).
NEXT = np.array([0, 1, 1, 1, 1], np.uint8)
STARTS, ENDED, POINT, BIG, SIGN = 1, 2, 4, 8, 16
_ALWAYS = np.array([POINT, 0, POINT | BIG, POINT | SIGN, POINT], np.uint8)
EMIT = np.stack([_ALWAYS | np.where(NEXT == 1, STARTS, 0), _ALWAYS | np.where(NEXT == 0, ENDED, 0)]).astype(np.uint8)
_NEXT, _EMIT = NEXT[CLASS], EMIT[:, CLASS].ravel()

#: Bytes that are looked up at once; longer texts are read in parts that end between words.
PART = 1 << 21
#: Words longer than this are hashed and compared one by one.
LONG = 256
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _ODD
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


class _Spans:
    """Words of a buffer by start, length and document; hashed and compared eight bytes at a time."""

    def __init__(self, data: np.ndarray, start: np.ndarray, size: np.ndarray, doc: np.ndarray):
        self.data, self.start, self.size, self.doc = data, start, size, doc
        padded = np.concatenate([data, np.zeros(16, np.uint8)])
        self._eight = np.ndarray(len(data) + 8, "<u8", padded, 0, (1,))
        self._first = self._chunk(np.arange(len(start)), 0)
        self.hash = _mix(self._first ^ (doc.astype(np.uint64) * _ODD) + size.astype(np.uint64))
        longer = np.flatnonzero((size > 8) & (size <= LONG))
        for j in range(1, LONG // 8):
            if not len(longer):
                break
            self.hash[longer] = _mix(self.hash[longer] + self._chunk(longer, j))
            longer = longer[size[longer] > 8 * (j + 1)]
        for i in np.flatnonzero(size > LONG).tolist():
            self.hash[i] ^= np.uint64(xxhash.xxh3_64_intdigest(self.bytes(i)))

    def bytes(self, i: int) -> bytes:
        return self.data[self.start[i] : self.start[i] + self.size[i]].tobytes()

    def _chunk(self, i: np.ndarray, j: int) -> np.ndarray:
        """Bytes 8j to 8j + 8 of the words ``i``, zeros after their ends."""
        left = np.minimum(self.size[i] - 8 * j, 8).astype(np.uint64)
        return self._eight[self.start[i] + 8 * j] & (~np.uint64(0) >> (np.uint64(64) - left * np.uint64(8)))

    def same(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the words ``a`` and ``b`` are of one document and equal in every byte."""
        found = (self.doc[a] == self.doc[b]) & (self.size[a] == self.size[b]) & (self._first[a] == self._first[b])
        at = np.flatnonzero(found & (self.size[a] > 8) & (a != b))
        for j in range(1, LONG // 8):
            if not len(at):
                break
            equal = self._chunk(a[at], j) == self._chunk(b[at], j)
            found[at[~equal]] = False
            at = at[equal & (self.size[a[at]] > 8 * (j + 1))]
        for k in at.tolist():
            found[k] = self.bytes(int(a[k])) == self.bytes(int(b[k]))
        return found


def distinct(words: _Spans) -> np.ndarray:
    """The words that the hash table keeps: one for each different word of each document."""
    n = len(words.start)
    places = 1 << max(4, (2 * n - 1).bit_length())
    table = np.full(places, -1, np.int64)
    slot = (words.hash >> np.uint64(64 - places.bit_length() + 1)).astype(np.int64)
    waiting = np.arange(n)
    while len(waiting):
        free = waiting[table[slot[waiting]] < 0]
        table[slot[free]] = free
        kept = table[slot[waiting]]
        waiting = waiting[~words.same(waiting, kept)]
        slot[waiting] = (slot[waiting] + 1) & (places - 1)
    return table[table >= 0]


def transduce(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, _Spans]:
    """Words, capitals, code points and symbols of the documents that end at ``ends`` in ``data``."""
    n, docs = len(data), len(ends)
    begins = np.concatenate([[0], ends[:-1]])
    state = _NEXT[data]
    before = np.zeros(n, np.uint8)
    before[1:] = state[:-1]
    before[begins[begins < n]] = 0
    said = _EMIT[data.astype(np.int64) + 256 * before.astype(np.int64)]
    start = np.flatnonzero(said & STARTS)
    # A word ends before the byte that says so, or with its document.
    open_ends = ends[(ends > begins) & (state[ends - 1] == 1)] if n else ends[:0]
    stop = np.sort(np.concatenate([np.flatnonzero(said & ENDED), open_ends]))
    counts = np.zeros((docs, 4), np.int64)
    doc = np.searchsorted(ends, start, "right")
    counts[:, 0] = np.bincount(doc, minlength=docs)
    for k, mark in ((1, BIG), (2, POINT), (3, SIGN)):
        hits = np.flatnonzero(said & mark)
        counts[:, k] = np.searchsorted(hits, ends) - np.searchsorted(hits, begins)
    return counts, _Spans(data, start, stop - start, doc)


def _long_text(data: np.ndarray) -> list[int]:
    """The five counts of one text, read in parts; a part that has no end of a word is widened."""
    total, seen, at = np.zeros(4, np.int64), set(), 0
    while at < len(data):
        stop, reach = len(data), PART
        while at + reach < len(data):
            gaps = np.flatnonzero(CLASS[data[at : at + reach]] == SPACE)
            if len(gaps):
                stop = at + int(gaps[-1]) + 1
                break
            reach *= 2
        counts, words = transduce(data[at:stop], np.array([stop - at]))
        total += counts[0]
        seen.update(words.bytes(i) for i in distinct(words).tolist())
        at = stop
    return [*total.tolist(), len(seen)]


def measure(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Words, capitals, code points, symbols and different words of each text of an Arrow column."""
    made = np.zeros((len(offsets) - 1, 5), np.int64)
    low = 0
    while low < len(offsets) - 1:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + PART, "right")) - 1)
        part = data[offsets[low] : offsets[high]]
        if high == low + 1 and len(part) > PART:
            made[low] = _long_text(part)
        else:
            counts, words = transduce(part, offsets[low + 1 : high + 1] - offsets[low])
            made[low:high, :4] = counts
            made[low:high, 4] = np.bincount(words.doc[distinct(words)], minlength=high - low)
        low = high
    return made


_COUNTS = "n_words long, n_capitals long, n_chars long, n_symbols long, n_distinct long, digest binary"


def measured(docs: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """The columns ``keep`` of ``docs``, the transducer's counts, and the SHA-256 of the text.

    Words are runs without U+0020 and U+0009 to U+000D, told apart by case. A null text counts as
    empty. ``keep`` columns must not bear the names of the counts.
    """
    bounded_batches(docs)
    shaped = docs.select(*[F.col(f"`{c}`") for c in keep], text_or_empty(text).alias("_text"))
    kept = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(kept)
            if not pa.types.is_string(column.type):
                column = column.cast(pa.string())
            _, places, raw = column.buffers()
            offsets = np.frombuffer(places, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
            data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
            made = measure(data, offsets)
            view = memoryview(data)
            digests = [hashlib.sha256(view[a:b]).digest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:kept], *[pa.array(made[:, k]) for k in range(5)], pa.array(digests, pa.binary())],
                names=[*batch.schema.names[:kept], *[f.split()[0] for f in _COUNTS.split(", ")]],
            )

    fields = shaped.schema.simpleString()
    kept_fields = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in shaped.schema.fields[:kept])
    assert fields.startswith("struct<")
    return shaped.mapInArrow(run, kept_fields + _COUNTS)


def production_filters() -> dict[str, Column | None]:
    """Failure conditions by letter; None is the filter of texts that an earlier id has."""
    return {
        "A": F.col("n_words") < 50,
        "B": 100 * F.col("n_distinct") < 65 * F.col("n_words"),
        "C": 100 * F.col("n_capitals") > 5 * F.col("n_chars"),
        "D": F.col("n_symbols") > 0,
        "E": None,
    }


def failures(docs: DataFrame, labels: DataFrame, filters: dict[str, Column | None]) -> DataFrame:
    """(part, mask, n, good, toxic): documents by source and set of failed filters.

    Bit i of ``mask`` is the i-th filter. Rows are counted by text, part and label before anything
    is compared over a text's copies, so copies meet as counts.
    """
    own = measured(docs.select("doc_id", "source", "text"), "doc_id", "source")
    mask, late = F.lit(0), 0
    for i, failed in enumerate(filters.values()):
        if failed is None:
            late |= 1 << i
        else:
            mask = mask.bitwiseOR(F.when(failed, 1 << i).otherwise(0))
    rows = own.select("doc_id", "digest", F.coalesce("source", F.lit("")).alias("part"), mask.alias("mask"))
    rows = rows.groupBy("doc_id", "digest", "part", "mask").agg(F.count("*").alias("n"))

    def one(column: str) -> Column:
        return F.max(F.coalesce(F.col(column) == 1, F.lit(False)))

    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(one("quality").alias("good"), one("toxic").alias("toxic"))
    marked = rows.join(marks.hint("merge"), "doc_id", "left").fillna(False, ["good", "toxic"])
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n")))
    grouped = marked.groupBy("digest", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), first.alias("first"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("nameless"),
    )
    if late:
        least = grouped.groupBy("digest").agg(F.min("first.doc_id").alias("least"))
        spared = F.col("nameless") + F.when(F.col("first.doc_id") == F.col("least"), F.col("first.n")).otherwise(0)
        both = F.array(
            F.struct(F.col("mask"), spared.alias("n")),
            F.struct(F.col("mask").bitwiseOR(late).alias("mask"), (F.col("n") - spared).alias("n")),
        )
        grouped = grouped.join(least.hint("merge"), "digest").select("part", "good", "toxic", F.inline(both))
    return grouped.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"),
        F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
    )


def audit(docs: DataFrame, labels: DataFrame, filters: dict[str, Column | None] | None = None) -> DataFrame:
    """One row for each part, order of the filters and step: what the step's filter removes.

    ``docs`` has doc_id, source and text, ``labels`` doc_id, quality and toxic; other columns are
    ignored. A part is a source; null and the empty string are one part. ``kept`` documents are left
    after the step, ``removed`` go here, ``redundant`` ones fail this filter but went earlier,
    ``unique_fails`` fail no other filter, ``good_lost`` and ``toxic_lost`` are the removed ones with
    a label row of quality 1 or toxic 1, and ``shapley`` sums the filter's removed documents over all
    orders. Every row of ``docs`` is a document. A row fails the filter of repeated texts if a
    smaller doc_id has the same text anywhere in the table; a null doc_id has no smaller one and is
    smaller than none, and rows that share id and text do not fail by each other. Null texts are
    empty. No documents give no rows. There are at most six filters, as all orders are reported.
    """
    filters = production_filters() if filters is None else filters
    letters = "".join(filters)
    if not 1 <= len(letters) <= 6 or len(letters) != len(filters):
        raise ValueError("one to six filters, each named by one letter")
    whole = range(1 << len(letters))
    counts = failures(docs, labels, filters).groupBy("part").agg(
        F.map_from_entries(F.collect_list(F.struct("mask", F.struct("n", "good", "toxic")))).alias("by_mask")
    )
    orders = list(permutations(letters))
    steps = ", ".join(
        f"named_struct('filter_order', '{''.join(o)}', 'step', {k + 1}, 'own', {1 << letters.index(o[k])}, "
        f"'before', {sum(1 << letters.index(c) for c in o[:k])})"
        for o in orders for k in range(len(o))
    )

    def total(where: str, value: str = "n", weight: str = "1") -> str:
        return (
            f"aggregate(sequence(0, {whole[-1]}), 0L, (s, m) -> s + "
            f"if({where}, coalesce(by_mask[m].{value}, 0L) * {weight}, 0L))"
        )

    here = "(m & own) <> 0 and (m & before) = 0"
    return counts.selectExpr("part", "by_mask", f"inline(array({steps}))").selectExpr(
        "part", "filter_order", "step",
        total("(m & (own | before)) = 0") + " AS kept",
        total(here) + " AS removed",
        total("(m & own) <> 0 and (m & before) <> 0") + " AS redundant",
        total("m = own") + " AS unique_fails",
        total(here, "good") + " AS good_lost",
        total(here, "toxic") + " AS toxic_lost",
        total("(m & own) <> 0", weight=f"({len(orders)}L div bit_count(m))") + " AS shapley",
    )
