"""Byte-level BPE: vectorised pre-tokenisation, cached pair merging, decoding.

Pre-tokenisation uses no regular expression. Every code point becomes a symbol of a small
alphabet (letter, digit, other, apostrophe of a contraction, kinds of white space), found with
array lookups that see at most two code points ahead. The public split pattern is then a
finite-state machine over these symbols. Each symbol is a function from states to states; the
functions form a small monoid whose products are tabulated, so the states before all code points
come from an associative scan over arrays: products within blocks, then over the blocks.
"""

from __future__ import annotations

import base64
import heapq
import sys
import unicodedata
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, LongType, StructField

from llm.common import add_columns, held

# Symbols.
LETTER, DIGIT, OTHER, SHORT, LONG, SPACE, LEAD, LAST, EDGE = range(9)
# States: what the token that holds the previous code point may still take up.
NEW, IN_LETTERS, IN_DIGITS, IN_OTHERS, IN_SPACE, AFTER_LEAD, ONE_MORE, TWO_MORE = range(8)

# The code points that the pattern's \s matches.
WHITE_SPACE = [
    9, 10, 11, 12, 13, 32, 133, 160, 5760, 8192, 8193, 8194, 8195, 8196, 8197, 8198, 8199, 8200,
    8201, 8202, 8232, 8233, 8239, 8287, 12288,
]
_END = sys.maxunicode + 1
_WINDOW = 1 << 21
# Pre-tokens whose ids are gathered at once; code points up to which a text is split without arrays.
_RUN, _SHORT_TEXT = 1 << 18, 512


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """The next state, and whether a token starts at this code point."""
    if symbol == LETTER:
        if state in (ONE_MORE, TWO_MORE):
            return NEW if state == ONE_MORE else ONE_MORE, False
        return IN_LETTERS, state not in (IN_LETTERS, AFTER_LEAD)
    if symbol == DIGIT:
        return IN_DIGITS, state not in (IN_DIGITS, AFTER_LEAD)
    if symbol in (OTHER, SHORT, LONG):
        if state in (IN_OTHERS, AFTER_LEAD):
            return IN_OTHERS, False
        return {OTHER: IN_OTHERS, SHORT: ONE_MORE, LONG: TWO_MORE}[symbol], True
    if symbol == SPACE:
        return IN_SPACE, state != IN_SPACE
    return (AFTER_LEAD if symbol == LEAD else NEW), True


_STEPS = [[_step(q, s) for s in range(8)] for q in range(8)]
_AFTER_SHORT, _AFTER_LONG = frozenset("stmd"), frozenset(["re", "ve", "ll"])


def _monoid() -> tuple[list[list[int]], list[tuple[int, ...]], list[int]]:
    """Products and values of the elements, and the element of each symbol."""
    elements = [tuple(range(8))]
    of_symbol = []
    for s in range(9):
        f = tuple(_step(q, s)[0] for q in range(8))
        if f not in elements:
            elements.append(f)
        of_symbol.append(elements.index(f))
    todo = list(elements)
    while todo:
        f = todo.pop()
        for s in of_symbol:
            g = tuple(elements[s][q] for q in f)
            if g not in elements:
                elements.append(g)
                todo.append(g)
    index = {f: i for i, f in enumerate(elements)}
    product = [[index[tuple(b[q] for q in a)] for b in elements] for a in elements]
    return product, elements, of_symbol


def _table(rows: list[list[int]], shift: int) -> bytes:
    """A lookup table for bytes.translate, at index ``row << shift | column``."""
    table = bytearray(256)
    for i, row in enumerate(rows):
        for j, value in enumerate(row):
            table[i << shift | j] = value
    return bytes(table)


_product, _value, _of_symbol = _monoid()
_SIZE = len(_value)
assert _SIZE <= 16
_PRODUCT = _table(_product, 4)
_VALUE = _table([list(f) for f in _value], 3)
_ELEMENT = _table([_of_symbol], 4)
_STARTS = _table([[_step(q, s)[1] for s in range(9)] for q in range(8)], 4)


def _look(table: bytes, index: np.ndarray) -> np.ndarray:
    return np.frombuffer(index.tobytes().translate(table), np.uint8)


_classes: np.ndarray | None = None


def classes() -> np.ndarray:
    """The class of each code point: LETTER, DIGIT, OTHER or SPACE; EDGE after the last one."""
    global _classes
    if _classes is None:
        table = np.full(_END + 1, OTHER, np.uint8)
        for i in range(_END):
            kind = unicodedata.category(chr(i))[0]
            if kind == "L":
                table[i] = LETTER
            elif kind == "N":
                table[i] = DIGIT
        table[WHITE_SPACE] = SPACE
        table[_END] = EDGE
        _classes = table
    return _classes


def symbols(codes: np.ndarray) -> np.ndarray:
    """Symbols of all but the last two ``codes``, which only serve as the view ahead."""
    kind = classes()[codes]
    now, then = kind[:-2], kind[1:-1]
    out = now.copy()
    ends = (now == SPACE) & (then != SPACE) & (then != EDGE)
    out[ends] = np.where(codes[:-2][ends] == 32, LEAD, LAST)
    at = np.flatnonzero(codes[:-2] == 39)
    if len(at):
        a, b = codes[at + 1], codes[at + 2]
        short = np.isin(a, [ord(c) for c in "stmd"])
        long = (a == ord("r")) & (b == ord("e")) | (a == ord("v")) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
        out[at[short]] = SHORT
        out[at[long]] = LONG
    return out


def states_before(symbol: np.ndarray, state: int) -> tuple[np.ndarray, int]:
    """The state before each symbol and after the last, by a blocked associative scan."""
    n = len(symbol)
    step = min(64, max(8, n >> 6))
    blocks = -(-n // step)
    padded = np.zeros(blocks * step, np.uint8)
    padded[:n] = _look(_ELEMENT, symbol)
    by_step = np.ascontiguousarray(padded.reshape(blocks, step).T)
    for k in range(1, step):
        by_step[k] = _look(_PRODUCT, by_step[k - 1] << 4 | by_step[k])
    first = np.empty(blocks, np.uint8)
    for b, element in enumerate(by_step[-1].tolist()):
        first[b] = state
        state = _VALUE[element << 3 | state]
    after = _look(_VALUE, by_step << 3 | first[None, :]).reshape(by_step.shape)
    before = np.empty((blocks, step), np.uint8)
    before[:, 0] = first
    before[:, 1:] = after[:-1].T
    return before.ravel()[:n], state


def cuts(codes: np.ndarray) -> np.ndarray:
    """Positions in ``codes`` at which a token starts. ``_END`` marks the edge of a text."""
    found, state = [], NEW
    for low in range(0, len(codes), _WINDOW):
        window = codes[low : low + _WINDOW + 2]
        missing = min(_WINDOW, len(codes) - low) + 2 - len(window)
        if missing:
            window = np.concatenate([window, np.full(missing, _END, codes.dtype)])
        symbol = symbols(window)
        before, state = states_before(symbol, state)
        found.append(np.flatnonzero(_look(_STARTS, before << 4 | symbol)) + low)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32)


def _starts(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray, np.ndarray]:
    """The texts end to end, a mark before each; its code points, where tokens start, and where the marks are among these."""
    whole = "\0" + "\0".join(texts)
    codes = codes_of(whole).copy()
    edges = np.cumsum([0, *[len(t) + 1 for t in texts[:-1]]])
    codes[edges] = _END
    starts = cuts(codes)
    codes[edges] = 0
    return whole, codes, starts, np.append(np.searchsorted(starts, edges), len(starts))


def _pieces_short(text: str) -> list[str]:
    """The pre-tokens of a short text, code point by code point; arrays pay only for many."""
    kinds, out, state, begin = [*map(_kind, text), EDGE], [], NEW, 0
    for i, (char, symbol, then) in enumerate(zip(text, kinds, kinds[1:])):
        if symbol == SPACE and then != SPACE and then != EDGE:
            symbol = LEAD if char == " " else LAST
        elif char == "'":
            ahead = text[i + 1 : i + 3]
            symbol = SHORT if ahead[:1] in _AFTER_SHORT else LONG if ahead in _AFTER_LONG else symbol
        state, starts = _STEPS[state][symbol]
        if starts and i:
            out.append(text[begin:i])
            begin = i
    if text:
        out.append(text[begin:])
    return out


@lru_cache(maxsize=1 << 12)
def _kind(char: str) -> int:
    return int(classes()[ord(char)])


def pieces(texts: list[str]) -> list[list[str]]:
    """The pre-tokens of each text."""
    if not texts:
        return []
    if len(texts) == 1 and len(texts[0]) <= _SHORT_TEXT:
        return [_pieces_short(texts[0])]
    whole, _, starts, first = _starts(texts)
    marks = starts.tolist()
    flat = list(map(whole.__getitem__, map(slice, marks, [*marks[1:], len(whole)])))
    return [flat[a + 1 : b] for a, b in zip(first.tolist(), first[1:].tolist())]


def distinct(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """The different pre-tokens of some texts; for all in order, after a mark that is to be skipped in each text,
    which one it is and its code points; where each text's begin."""
    whole, codes, starts, first = _starts(texts)
    width = np.ones(len(codes), np.uint8)
    for least in (0x80, 0x800, 0x10000):
        width += codes >= least
    raw = whole.encode()
    ends = np.cumsum(np.add.reduceat(width, starts, dtype=np.int32), dtype=np.int32)
    buffers = [None, pa.py_buffer(np.append(np.int32(0), ends)), pa.py_buffer(raw)]
    found = pa.Array.from_buffers(pa.string(), len(starts), buffers).dictionary_encode()
    words = found.dictionary.to_numpy(zero_copy_only=False).tolist()
    return words, found.indices.to_numpy(), np.diff(starts, append=len(whole)), first


def gathered(flat: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Runs of ``flat``, given by their first places and sizes, end to end."""
    ends = np.cumsum(size)
    return flat[np.repeat(first - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Decoder:
    """The bytes of ids, by one gather from the bytes of all tokens."""

    def __init__(self, path: str):
        self.ranks = read_ranks(path)
        token = {i: b for b, i in self.ranks.items()}
        top = max(token) + 1
        self.length = np.array([len(token.get(i, b"")) for i in range(top)], np.int64)
        self.place = np.cumsum(self.length) - self.length
        self.flat = np.frombuffer(b"".join(token.get(i, b"") for i in range(top)), np.uint8)

    def decode(self, ids: bytes) -> bytes:
        return self.decode_many([ids])[0]

    def decode_many(self, rows: list[bytes]) -> list[bytes]:
        """The bytes of each row of ids."""
        out: list[bytes] = []
        for group in groups(rows):
            ids = np.frombuffer(b"".join(group), "<u4")
            sizes = self.length[ids]
            ends = np.cumsum(sizes)
            total = int(ends[-1]) if len(ends) else 0
            shift = np.repeat((self.place[ids] - ends + sizes).astype(np.int32), sizes)
            made = self.flat[shift + np.arange(total, dtype=np.int32)].tobytes()
            marks = np.cumsum([0, *[len(r) // 4 for r in group]])
            at = np.append(0, ends)[marks].tolist()
            out += [made[a:b] for a, b in zip(at, at[1:])]
        return out

    def offsets(self, ids: bytes, every: int) -> bytes:
        """Byte offsets of every ``every``-th token in the encoded text, as unsigned 64-bit integers."""
        ends = np.cumsum(self.length[np.frombuffer(ids, "<u4")])
        return np.concatenate([[0], ends])[:-1][::every].astype("<u8").tobytes() if len(ends) else b""

    def decode_span(self, ids: bytes, offsets: bytes, every: int, start: int, stop: int) -> bytes:
        """Bytes ``start`` to ``stop`` of the text, decoding only the tokens around them."""
        marks = np.frombuffer(offsets, "<u8")
        if not len(marks) or stop <= start:
            return b""
        a = max(0, int(np.searchsorted(marks, start, "right")) - 1)
        b = int(np.searchsorted(marks, stop, "left"))
        part = self.decode(ids[4 * a * every : 4 * b * every])
        return part[start - int(marks[a]) : stop - int(marks[a])]


class Encoder(Decoder):
    """Pair merging over a rank file, with a bounded cache from pre-token to ids."""

    _MISS = np.iinfo(np.int32).max

    def __init__(self, path: str, cache_size: int = 250_000):
        super().__init__(path)
        self.cache: dict[str, bytes] = {}
        self.cache_size = cache_size
        keys, ids = [], []
        for token, rank in self.ranks.items():
            for k in range(1, len(token)):
                left, right = self.ranks.get(token[:k]), self.ranks.get(token[k:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    ids.append(rank)
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.append(np.array(keys, np.int64)[order], np.iinfo(np.int64).max)
        self.merged = np.append(np.array(ids, np.int32)[order], np.int32(self._MISS))
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        # Ranks of pairs of bytes; a column behind them for the end of a word.
        pair = [[self.ranks.get(bytes([a, b]), self._MISS) for b in range(256)] + [self._MISS] for a in range(256)]
        self.pairs = np.array(pair + [[self._MISS] * 257], np.int32).ravel()

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where((self.keys[at] == key) & (right >= 0), self.merged[at], self._MISS)

    def _merge_many(self, words: list[bytes]) -> list[bytes]:
        """Ids of words of similar length: in each round every word merges its best pair."""
        sizes = np.array(list(map(len, words)))
        width = int(sizes.max()) + 1
        text = np.full((len(words), width), 256, np.int32)
        text[np.arange(width)[None, :] < sizes[:, None]] = np.frombuffer(b"".join(words), np.uint8)
        ids = np.append(self.single, np.int32(-1))[text]
        rank = np.full(ids.shape, self._MISS, np.int32)
        rank[:, :-1] = self.pairs[text[:, :-1] * 257 + text[:, 1:]]
        done: list[bytes] = [b""] * len(words)
        row = np.arange(len(words))
        while len(row):
            best = rank.argmin(axis=1)
            every = np.arange(len(row))
            value = rank[every, best]
            live = value != self._MISS
            ended = ids[~live]
            flat = ended[ended >= 0].astype("<u4").tobytes()
            end = 0
            for at, count in zip(row[~live].tolist(), (ended >= 0).sum(axis=1).tolist()):
                done[at] = flat[end : (end := end + 4 * count)]
            ids[every, best] = value
            keep = np.ones(ids.shape, bool)
            keep[every, np.minimum(best + 1, ids.shape[1] - 1)] = False
            keep[~live] = False
            row, best, value = row[live], best[live], value[live]
            width = ids.shape[1] - 1
            ids, rank = ids[keep].reshape(-1, width), rank[keep].reshape(-1, width)
            if not len(row):
                break
            every = np.arange(len(row))
            follows = ids[every, np.minimum(best + 1, width - 1)]
            rank[every, best] = np.where(best + 1 < width, self._rank(value, follows), self._MISS)
            inner = np.flatnonzero(best > 0)
            prior = best[inner] - 1
            rank[inner, prior] = self._rank(ids[inner, prior], value[inner])
        return done

    def _merge_short(self, word: bytes) -> bytes:
        """Ids of one short word: the best pair is looked for among all."""
        text, rank_of, miss = [word[i : i + 1] for i in range(len(word))], self.ranks.get, self._MISS
        rank = [rank_of(a + b, miss) for a, b in zip(text, text[1:])]
        while rank and (best := min(rank)) != miss:
            i = rank.index(best)
            text[i : i + 2] = [text[i] + text[i + 1]]
            del rank[i]
            if i < len(rank):
                rank[i] = rank_of(text[i] + text[i + 1], miss)
            if i:
                rank[i - 1] = rank_of(text[i - 1] + text[i], miss)
        return array("I", [self.ranks[t] for t in text]).tobytes()

    def _merge_long(self, word: bytes) -> bytes:
        """Ids of one long word: a heap of pairs over a linked list, n log n."""
        ids = [self.ranks[bytes([b])] for b in word]
        text = [bytes([b]) for b in word]
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        heap: list[tuple[int, int, bytes, bytes]] = []

        def push(i: int) -> None:
            j = after[i]
            if i >= 0 and j < len(ids) and (r := self.ranks.get(text[i] + text[j])) is not None:
                heapq.heappush(heap, (r, i, text[i], text[j]))

        for i in range(len(ids) - 1):
            push(i)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= len(ids) or text[i] != a or text[j] != b:
                continue
            ids[i], text[i] = r, a + b
            ids[j], after[i] = -1, after[j]
            if after[j] < len(ids):
                before[after[j]] = i
            push(i)
            if before[i] >= 0:
                push(before[i])
        return np.array([i for i in ids if i >= 0], "<u4").tobytes()

    def learn(self, words: set[str]) -> None:
        """Add the ids of ``words`` to the cache."""
        missing = list(words.difference(self.cache))
        if len(self.cache) + len(missing) > self.cache_size:
            for old in list(islice(self.cache, max(0, len(self.cache) - self.cache_size // 2))):
                if old not in words:
                    del self.cache[old]
        raw = list(map(str.encode, missing))
        if len(missing) < 16:  # arrays pay only for many words at once
            self.cache.update((w, self._merge_short(r) if len(r) <= 64 else self._merge_long(r)) for w, r in zip(missing, raw))
            return
        sizes = np.fromiter(map(len, raw), np.int64, len(raw))
        order = np.argsort(sizes, kind="stable")
        many = int((sizes <= 64).sum())
        for k in range(0, many, 8192):
            part = order[k : min(many, k + 8192)].tolist()
            self.cache.update(zip(map(missing.__getitem__, part), self._merge_many(list(map(raw.__getitem__, part)))))
        for i in order[many:].tolist():
            self.cache[missing[i]] = self._merge_long(raw[i])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        out: list[bytes] = []
        for group in groups(texts):
            words, code, _, first = distinct(group)
            self.learn(set(words))
            ids = list(map(self.cache.__getitem__, words))
            flat, size = np.frombuffer(b"".join(ids), "<u4"), np.fromiter(map(len, ids), np.int64, len(ids)) // 4
            code, first = np.delete(code, first[:-1]), first - np.arange(len(first))  # without the marks
            begin = np.cumsum(size) - size
            made = [gathered(flat, begin[c], size[c]).tobytes() for c in np.split(code, range(_RUN, len(code), _RUN))]
            whole, marks = b"".join(made), 4 * np.append(0, np.cumsum(size[code]))[first]
            out += [whole[a:b] for a, b in zip(marks.tolist(), marks[1:].tolist())]
        return out


def groups(texts: list, chars: int = 1 << 21, length: Callable = len) -> Iterator[list]:
    """Runs of texts of bounded total length; a longer text is a run of its own."""
    group, size = [], 0
    for text in texts:
        if group and size + length(text) > chars:
            yield group
            group, size = [], 0
        group.append(text)
        size += length(text)
    if group:
        yield group


def encoder(path: str) -> Encoder:
    """One encoder for each rank file and Python process."""
    kept = held("byte_bpe", "coders", dict)
    if ("encoder", path) not in kept:
        kept["encoder", path] = Encoder(path)
    return kept["encoder", path]


def decoder(path: str) -> Decoder:
    kept = held("byte_bpe", "coders", dict)
    if ("decoder", path) not in kept:
        kept["decoder", path] = Decoder(path)
    return kept["decoder", path]


EVERY = 256


def encode(docs: DataFrame, ranks_path: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (binary, little-endian u32), ``n_tokens`` and ``offsets``.

    ``offsets`` holds the byte offset of every 256th token, so a span can be decoded on its own.
    A null text counts as empty: no ids, 0 tokens. Rows are neither merged nor reordered, so
    repeated rows stay; an existing column with one of the new names is replaced.
    ``ranks_path`` must be readable at that path on every executor.
    """

    def compute(texts: list[str | None]) -> list[list]:
        enc = encoder(ranks_path)
        ids = enc.encode([t or "" for t in texts])
        return [ids, [len(x) // 4 for x in ids], [enc.offsets(x, EVERY) for x in ids]]

    fields = [
        StructField("ids", BinaryType()), StructField("n_tokens", LongType()),
        StructField("offsets", BinaryType()),
    ]
    return add_columns(docs, [text], fields, compute)


def decode(encoded: DataFrame, ranks_path: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded``, the bytes of the text; null ids give empty bytes."""

    def compute(rows: list[bytes | None]) -> list[list]:
        return [decoder(ranks_path).decode_many([x or b"" for x in rows])]

    return add_columns(encoded, [ids], [StructField("decoded", BinaryType())], compute)
