"""Edit-aware token counts: a segment tree of pre-tokens for each document, kept as a table.

Leaves hold runs of pre-tokens; inner nodes hold the code points and tokens below them. The table of
trees has a row for each document: its text, and the code points and tokens of the leaves in order;
a leaf's text is a slice. Edits are joined to this table. An edit descends by code points, re-encodes
the leaves it touches with a few code points of context on either side, and updates the sums on the
paths above. Other leaves keep their counts and are never encoded again; a leaf that grew splits
where it stands. Edited documents come back as rows of the same kind of table.
"""

from __future__ import annotations

from itertools import accumulate, chain
from operator import add

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField

from llm import byte_bpe
from llm.common import add_columns, text_or_empty

LEAF = 16
#: The split pattern looks at most this many code points ahead.
CONTEXT = 3


class TokenTree:
    """Token counts of a text under edits, from the text and the sums of its leaves.

    ``chars`` and ``tokens`` are those of the leaves in order; leaves end where pre-tokens do.
    """

    def __init__(self, text: str, chars: list[int], tokens: list[int], encoder: byte_bpe.Encoder, leaf: int = LEAF):
        self.encoder, self.leaf, self.encoded = encoder, leaf, 0
        ends = list(accumulate(chars))
        self._plant([text[b - n : b] for b, n in zip(ends, chars)], chars, tokens)

    def _plant(self, texts: list[str], chars: list[int], tokens: list[int]) -> None:
        self.leaves, self.width = len(texts), 1
        while self.width < max(1, len(texts)):
            self.width *= 2
        empty = self.width - len(texts)
        self.texts = texts + [""] * empty
        self.chars = self._above([*chars, *[0] * empty])
        self.tokens = self._above([*tokens, *[0] * empty])

    def _above(self, level: list[int]) -> list[int]:
        """The sums of all nodes, from those of the leaves."""
        levels = [level]
        while len(levels[-1]) > 1:
            levels.append(list(map(add, levels[-1][::2], levels[-1][1::2])))
        return [0, *chain.from_iterable(reversed(levels))]

    def _counts(self, pieces: list[str]) -> list[int]:
        self.encoder.learn(set(pieces))
        self.encoded += len(pieces)
        return [len(self.encoder.cache[p]) // 4 for p in pieces]

    def sums(self) -> tuple[str, list[int], list[int]]:
        """The text and its leaves' code points and tokens; empty leaves are left out."""
        kept = [i for i in range(self.width) if self.texts[i]]
        return (
            "".join(self.texts), [self.chars[self.width + i] for i in kept], [self.tokens[self.width + i] for i in kept]
        )

    def _sum(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    def _find(self, at: int) -> tuple[int, int]:
        """The leaf that holds code point ``at`` and the code points before it."""
        node, before = 1, 0
        while node < self.width:
            node *= 2
            if at - before >= self.chars[node] and self.chars[node + 1]:
                before += self.chars[node]
                node += 1
        return node - self.width, before

    def edit(self, start: int, length: int, replacement: str) -> None:
        """Replace ``length`` code points from ``start`` on; both are cut to the text."""
        start = min(max(start, 0), self.n_chars)
        length = min(max(length, 0), self.n_chars - start)
        first, before = self._find(max(0, start - CONTEXT))
        last, _ = self._find(min(start + length, max(0, self.n_chars - 1)))
        last = max(first, last)
        old = "".join(self.texts[first : last + 1])
        new = old[: start - before] + replacement + old[start - before + length :]
        while True:
            ahead, k = "", last + 1
            while k < self.width and len(ahead) <= CONTEXT:
                ahead += self.texts[k][: CONTEXT + 1]
                k += 1
            found, size, whole = [], 0, not ahead
            for piece in byte_bpe.pieces([new + ahead])[0]:
                if size == len(new):
                    whole = True
                    break
                found.append(piece)
                size += len(piece)
            if whole or size == len(new):
                break
            # A pre-token reaches into the next leaf: take it in as well.
            last += 1
            new += self.texts[last]
        counts = self._counts(found)
        span = last - first + 1
        if len(found) > 4 * self.leaf * span:
            # The touched leaves have grown: they split, all others are taken over as they are.
            runs = range(0, len(found), self.leaf)
            texts = ["".join(found[a : a + self.leaf]) for a in runs]
            sums = [sum(counts[a : a + self.leaf]) for a in runs]
            low, high = self.width + first, self.width + last + 1
            self._plant(
                self.texts[:first] + texts + self.texts[last + 1 :],
                self.chars[self.width : low] + [len(t) for t in texts] + self.chars[high:],
                self.tokens[self.width : low] + sums + self.tokens[high:],
            )
            return
        share = -(-len(found) // span) or 1
        for n, i in enumerate(range(first, last + 1)):
            part = slice(n * share, (n + 1) * share)
            self.texts[i] = "".join(found[part])
            self.chars[self.width + i], self.tokens[self.width + i] = len(self.texts[i]), sum(counts[part])
        low, high = (self.width + first) // 2, (self.width + last) // 2
        while low:
            for i in range(low, high + 1):
                self._sum(i)
            low, high = low // 2, high // 2


def trees(docs: DataFrame, ranks_path: str, doc_id: str = "doc_id", text: str = "text", leaf: int = LEAF) -> DataFrame:
    """The trees of ``docs``: doc_id, text, chars and tokens of the leaves in order, and pieces (pre-tokens).

    A null text counts as empty; every row has a tree of its own, also rows that repeat an id.
    """

    def compute(texts):
        encoder = byte_bpe.encoder(ranks_path)
        chars, tokens, pieces = [], [], []
        # The words of many texts are merged together; each tree then sums up its own.
        for group in byte_bpe.groups(texts):
            words, code, size, first = byte_bpe.distinct(group)
            encoder.learn(set(words))
            ids = np.fromiter(map(len, map(encoder.cache.__getitem__, words)), np.int64, len(words))[code] // 4
            for a, b in zip(first.tolist(), first[1:].tolist()):
                runs = np.arange(a + 1, b, leaf)
                chars.append(np.add.reduceat(size[:b], runs) if len(runs) else size[:0])
                tokens.append(np.add.reduceat(ids[:b], runs) if len(runs) else ids[:0])
                pieces.append(b - a - 1)
        return [chars, tokens, pieces]

    slim = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), text_or_empty(text).alias("text"))
    longs = ArrayType(LongType())
    fields = [StructField("chars", longs), StructField("tokens", longs), StructField("pieces", LongType())]
    return add_columns(slim, ["text"], fields, compute)


def with_edits(kept: DataFrame, edits: DataFrame) -> DataFrame:
    """The trees with the edits of their documents, from a table of edits in order.

    ``edits`` has doc_id, place (its order), start, length and replacement; the edits of a document are
    gathered in one row. Documents without edits have none; edits of unknown documents are left out.
    """
    one = F.struct("place", "start", "length", "replacement")
    listed = edits.groupBy("doc_id").agg(F.sort_array(F.collect_list(one)).alias("edits"))
    return kept.join(listed.hint("merge"), "doc_id", "left")


def apply_edits(kept: DataFrame, ranks_path: str) -> DataFrame:
    """doc_id, the edited text, its tree (chars, tokens), and counts, for every row of ``kept``.

    ``kept`` are trees with a column ``edits``: an array of structs (start, length, replacement) in
    code points, applied in order, each to the text that the one before left; null entries and null
    edits change nothing, a null replacement deletes. Positions are cut to the text. ``n_tokens`` is
    the number before, ``n_tokens_edited`` and ``n_chars_edited`` those after, ``pieces`` the pre-tokens
    when the tree was built, and ``reencoded`` those that the edits encoded. Rows stay as they are; a
    tree that does not fit its text raises an error.
    """

    def compute(texts, listed, chars, tokens):
        encoder = byte_bpe.encoder(ranks_path)
        made = []
        for own, changes, size, ids in zip(texts, listed, chars, tokens):
            if sum(size) != len(own):
                raise ValueError("a document has no tree for its text")
            tree = TokenTree(own, size, ids, encoder)
            before = tree.n_tokens
            for e in changes or []:
                if e is not None:
                    tree.edit(e["start"] or 0, e["length"] or 0, e["replacement"] or "")
            made.append((*tree.sums(), before, tree.n_tokens, tree.n_chars, tree.encoded))
        return [list(c) for c in zip(*made)] if made else [[]] * 7

    longs = ["n_tokens", "n_tokens_edited", "n_chars_edited", "reencoded"]
    slim = kept.select(
        "doc_id", "pieces", F.col("text").alias("before"), "edits", F.col("chars").alias("own_chars"), F.col("tokens").alias("own_tokens")
    )
    fields = [
        StructField("text", StringType()), StructField("chars", ArrayType(LongType())),
        StructField("tokens", ArrayType(LongType())), *[StructField(n, LongType()) for n in longs],
    ]
    done = add_columns(slim, ["before", "edits", "own_chars", "own_tokens"], fields, compute)
    return done.select("doc_id", "text", "chars", "tokens", *longs[:3], "pieces", longs[3])


def self_edits(kept: DataFrame) -> DataFrame:
    """``kept`` (doc_id, text, ...) with three edits made of the text itself: a replacement by its first
    20 code points at one third, an insertion of its last 12 at two thirds, and the loss of the first 5."""
    n = F.length("text")

    def one(start, length, words):
        return F.struct(
            start.cast("long").alias("start"), F.lit(length).cast("long").alias("length"), words.alias("replacement")
        )

    return kept.withColumn("edits", F.array(
        one(F.floor(n / 3), 20, F.expr("left(text, 20)")), one(F.floor(n * 2 / 3), 0, F.expr("right(text, 12)")),
        one(F.lit(0), 5, F.lit("")),
    ))
