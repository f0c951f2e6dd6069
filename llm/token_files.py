"""Token-id files: every document is a zstandard frame of its own, compressed with a shared dictionary.

A set of files is a folder with three Parquet tables, written by Spark, so a lost executor costs
only its tasks:

* ``dictionary``: ``dict_hash`` (SHA-256), ``dictionary`` bytes, ``width`` of an id in bytes.
* ``blocks``: rows in ascending document order inside each file. A block holds the frames of some
  documents end to end in ``data`` and their offset index: ``doc_ids``, ``ends`` (byte offset of
  each frame's end) and ``counts`` (ids of each document). ``shard`` numbers the files in document
  order, ``block`` the blocks in a file, ``first`` the ids before a block in its file. ``dict_hash``
  names the dictionary.
* ``shards``: the ids before each file, ``start``.

Single documents are read through the index columns of ``blocks``; only the blocks that hold them
are opened, and only their frames decompressed.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator
from itertools import chain, islice, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField

from llm.byte_bpe import gathered, groups
from llm.common import add_columns, text_or_empty
from shelf.staging import stage

# Words of Latin letters that are their own normal form, and marks after them.
_MARKS = ".,;:!?|*%&$#)"
_LETTERS = "".join(map(chr, [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0xD7), *range(0xD8, 0xF7), *range(0xF8, 0x100)]))
_OTHER = f"[^{_LETTERS}]"
# Byte-level vocabularies spell each byte as a printable character: Latin-1 where it is one, else from 256 on.
_PRINTED = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_SPELT = {b: chr(b) if b in _PRINTED else chr(256 + sum(x not in _PRINTED for x in range(b))) for b in range(256)}
BLOCK_BYTES = 1 << 20
# Code points that are encoded at once, and chunks whose ids are gathered at once.
_GROUP, _RUN = 1 << 22, 1 << 18


class WordEncoder:
    """The tokenizers library behind a bounded cache of parts of space-separated chunks.

    The vocabulary's normaliser turns white space into one space, which its splitter drops, so no
    token and no normalisation reaches across a space or a line feed: the ids of a text are those
    of its chunks in order. Latin words and the marks after them are cached apart. Special tokens
    spelt out in a text are found by the library, as it does by default. Arrow tells the different
    chunks of many texts, and each text gathers its ids from theirs.
    """

    def __init__(self, path: str, end_id: int, cache_size: int = 1_000_000):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        self.lib = Tokenizer.from_file(path)
        # The model alone, for words that need neither normalisation nor splitting.
        self.words = Tokenizer(self.lib.model)
        self.words.pre_tokenizer = CharDelimiterSplit(" ")
        vocabulary = self.lib.get_vocab(True)
        self.type = np.dtype("<u2" if max(len(vocabulary), end_id + 1) <= 1 << 16 else "<u4")
        self.end = np.array([end_id], self.type)
        # Ids that end a word, if the vocabulary marks them.
        mark = getattr(self.lib.model, "end_of_word_suffix", None) or ""
        self.last = np.zeros(1 + max(vocabulary.values(), default=0), bool)
        self.last[[i for token, i in vocabulary.items() if mark and token.endswith(mark)]] = True
        self.cache_size = cache_size
        # Parts by name, chunks that are not split by a space and their name: where their ids lie in ``flat``.
        self.place: dict[str, int] = {"": 0, " ": 1}
        self.flat, self.ends = np.zeros(0, self.type), np.zeros(3, np.int64)

    def _listed(self, rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        return np.array(list(chain.from_iterable(rows)), self.type), np.array(list(map(len, rows)), np.int64)

    def _parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of lower-case Latin words or runs of marks, which need no normalisation: one call for many."""
        spelt = [p if p.isascii() else p.encode().decode("latin-1").translate(_SPELT) for p in parts]
        ids = np.array(self.words.encode_batch_fast([" ".join(spelt)], add_special_tokens=False)[0].ids, self.type)
        ends = np.flatnonzero(self.last[ids]) + 1
        if len(ends) != len(parts):  # the ids do not tell where words end: ask for each part
            return self._listed([[t.id for t in self.lib.model.tokenize(p)] for p in spelt])
        return ids, np.diff(ends, prepend=0)

    def _odd(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """One call for many chunks; the tokens' places tell which chunk they are of."""
        found = self.lib.encode(" ".join(chunks), add_special_tokens=False)
        starts = np.cumsum([0, *[len(c) + 1 for c in chunks]])
        places = np.array([a for a, _ in found.offsets], np.int64)
        if (np.diff(places) < 0).any():  # places are out of order: ask for each chunk
            return self._listed([self.lib.encode(c, add_special_tokens=False).ids for c in chunks])
        return np.array(found.ids, self.type), np.diff(np.searchsorted(places, starts))

    def _places(self, names: list[str], mark: str, ids_of: Callable) -> np.ndarray:
        """Where the ids of each name lie; new ones are learnt."""
        keys = [mark + n for n in names] if mark else names
        found = np.fromiter(map(self.place.get, keys, repeat(-1)), np.int64, len(keys))
        missing = np.flatnonzero(found < 0).tolist()
        if missing:
            new = list(dict.fromkeys(map(names.__getitem__, missing)))
            made = [ids_of(new[k : k + 4096]) for k in range(0, len(new), 4096)]
            self.place.update(zip((mark + n for n in new) if mark else new, range(len(self.place), len(self.place) + len(new))))
            self.flat = np.concatenate([self.flat, *[ids for ids, _ in made]])
            self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(np.concatenate([n for _, n in made]))])
            found[missing] = [self.place[keys[i]] for i in missing]
        return found

    def _trim(self) -> None:
        """Forget the oldest half when the cache is full."""
        if len(self.place) > self.cache_size:
            cut = len(self.place) - self.cache_size // 2
            kept = ["", " ", *islice(self.place, cut, None)]
            self.flat = self.flat[self.ends[cut] :]
            self.ends = np.concatenate([[0, 0], self.ends[cut:] - self.ends[cut]])
            self.place = dict(zip(kept, range(len(kept))))

    def _pairs(self, chunks: pa.StringArray) -> np.ndarray:
        """For each of different chunks the places of its word, or of itself as a whole, and of the marks behind."""
        word = pc.utf8_rtrim(chunks, _MARKS)
        plain = pc.and_(pc.invert(pc.match_substring_regex(word, _OTHER)), pc.greater(pc.binary_length(word), 0))
        marks = pc.utf8_ltrim(chunks.filter(plain), _LETTERS).dictionary_encode()
        words = pc.utf8_lower(word.filter(plain)).to_numpy(zero_copy_only=False).tolist()
        odd = chunks.filter(pc.invert(plain)).to_numpy(zero_copy_only=False).tolist()
        is_plain, pairs = plain.to_numpy(zero_copy_only=False), np.zeros((len(chunks), 2), np.int64)
        pairs[is_plain, 0] = self._places(words, "", self._parts)
        pairs[is_plain, 1] = self._places(marks.dictionary.to_pylist(), "", self._parts)[marks.indices.to_numpy()]
        pairs[~is_plain, 0] = self._places(odd, " ", self._odd)
        return pairs

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text with the end id."""
        end = self.end.tobytes()
        for group in groups(texts, _GROUP):
            self._trim()
            rows = pc.split_pattern(pc.replace_substring(pa.array(group, pa.string()), "\n", " "), " ")
            chunks = rows.flatten().dictionary_encode()
            pairs, code = self._pairs(chunks.dictionary), chunks.indices.to_numpy()
            first = self.ends[pairs]
            size = self.ends[pairs + 1] - first
            made = [gathered(self.flat, first[c].ravel(), size[c].ravel()).tobytes() for c in np.split(code, range(_RUN, len(code), _RUN))]
            ids, before = b"".join(made), np.append(0, np.cumsum(size.sum(axis=1)[code])) * self.type.itemsize
            marks = before[rows.offsets.to_numpy()].tolist()
            for a, b in zip(marks, marks[1:]):
                yield ids[a:b] + end


_encoders: dict[tuple[str, int], WordEncoder] = {}


def word_encoder(path: str, end_id: int) -> WordEncoder:
    key = (path, end_id)
    if key not in _encoders:
        _encoders[key] = WordEncoder(path, end_id)
    return _encoders[key]


def train_dictionary(
    docs: DataFrame, vocabulary: str, end_id: int = 1, sample_docs: int = 500,
    sample_chars: int = 100_000, dict_bytes: int = 1 << 16,
) -> bytes:
    """A zstandard dictionary trained on the serialised ids of at most ``sample_docs`` documents.

    The sample takes the documents with the smallest hash of their id, without those of more than
    ``sample_chars`` code points; it bounds only the training. Ids are drawn first, thinned out in
    every task, so texts of the sample alone are moved. Too few samples to train on become the
    dictionary's plain content; no sample gives no dictionary (empty bytes).
    """
    order = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40))
    ids = docs.select("doc_id").where("doc_id is not null")
    share = min(1.0, 4 * sample_docs / max(1, ids.count()))
    drawn = ids.where(order < int(share * (1 << 40))).distinct().orderBy(order, "doc_id").limit(sample_docs)
    chosen = docs.where(F.col("doc_id").isin([r["doc_id"] for r in drawn.collect()])).where(F.length("text") <= sample_chars)
    sample = chosen.select("text").orderBy(F.xxhash64("text"), "text").limit(sample_docs)

    def compute(texts):
        return [list(word_encoder(vocabulary, end_id).encode([t or "" for t in texts]))]

    rows = add_columns(sample, ["text"], [StructField("ids", BinaryType())], compute).select("ids").collect()
    samples = [bytes(r["ids"]) for r in rows]
    try:
        return zstandard.train_dictionary(dict_bytes, samples).as_bytes() if samples else b""
    except zstandard.ZstdError:
        return b"".join(samples)[:dict_bytes]


def _dictionary(raw: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(raw) if raw else None


def write_token_files(
    docs: DataFrame, folder: str, vocabulary: str, end_id: int = 1, level: int = 3,
    block_bytes: int = BLOCK_BYTES, sample_docs: int = 500,
) -> None:
    """Encode ``docs`` (doc_id, text), append ``end_id`` to each, and write the files to ``folder``.

    A null or empty text has the end id only. Documents go in ascending doc_id order, null ids
    first; repeated ids stay, ordered by their frames. Other columns are ignored. No rows give
    files without blocks.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    raw = train_dictionary(docs, vocabulary, end_id, sample_docs)
    name = hashlib.sha256(raw).hexdigest()

    def compress(texts):
        enc = word_encoder(vocabulary, end_id)
        packer = zstandard.ZstdCompressor(level=level, dict_data=_dictionary(raw))
        frames, counts = [], []
        for ids in enc.encode(texts):
            frames.append(packer.compress(ids))
            counts.append(len(ids) // enc.type.itemsize)
        return [frames, counts]

    fields = [StructField("frame", BinaryType()), StructField("count", LongType())]
    frames = stage(add_columns(docs, ["text"], fields, compress).drop("text"), "token-frames")
    ordered = frames.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "frame")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, first, held = 0, 0, ([], [], [])
        shard, size = 0, 0

        def row() -> pa.RecordBatch:
            ids, parts, counts = held
            return pa.RecordBatch.from_pylist(
                [{
                    "shard": shard, "block": block, "first": first, "doc_ids": list(ids),
                    "ends": np.cumsum([len(p) for p in parts]).tolist(), "counts": list(counts),
                    "data": b"".join(parts), "dict_hash": name,
                }], schema=_BLOCKS,
            )

        for batch in batches:
            for doc, frame, count, shard in zip(*[c.to_pylist() for c in batch.columns]):
                if held[0] and size + len(frame) > block_bytes:
                    yield row()
                    block, first, size = block + 1, first + sum(held[2]), 0
                    held = ([], [], [])
                for x, y in zip(held, (doc, frame, count)):
                    x.append(y)
                size += len(frame)
        if held[0]:
            yield row()

    ordered = ordered.select("doc_id", "frame", "count", F.spark_partition_id().alias("shard"))
    ordered.mapInArrow(pack, _BLOCKS_SQL).write.parquet(f"{folder}/blocks")
    sizes = spark.read.parquet(f"{folder}/blocks").groupBy("shard").agg(
        F.sum(F.aggregate("counts", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n")
    )
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    sizes.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")).write.parquet(
        f"{folder}/shards"
    )
    width = word_encoder(vocabulary, end_id).type.itemsize
    spark.range(1).select(
        F.lit(name).alias("dict_hash"), F.lit(bytearray(raw)).alias("dictionary"), F.lit(width).alias("width")
    ).write.parquet(f"{folder}/dictionary")


_BLOCKS = pa.schema([
    ("shard", pa.int32()), ("block", pa.int32()), ("first", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
    ("ends", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64())), ("data", pa.binary()),
    ("dict_hash", pa.string()),
])
_BLOCKS_SQL = (
    "shard int, block int, first long, doc_ids array<long>, ends array<long>, counts array<long>,"
    " data binary, dict_hash string"
)


def read_token_files(spark: SparkSession, folder: str, wanted: DataFrame | None = None) -> DataFrame:
    """doc_id, start, n_tokens and ids (binary, little-endian u32) of the files in ``folder``.

    ``wanted`` (doc_id) restricts the read to some documents: blocks are found by their index,
    and of a block only the wanted frames are decompressed.
    """
    kept = spark.read.parquet(f"{folder}/dictionary").collect()[0]
    raw, name, width = bytes(kept["dictionary"]), kept["dict_hash"], kept["width"]
    if hashlib.sha256(raw).hexdigest() != name:
        raise ValueError("the dictionary does not match its hash")
    blocks = spark.read.parquet(f"{folder}/blocks")
    if wanted is not None:
        index = blocks.select("shard", "block", F.explode("doc_ids").alias("doc_id"))
        hits = index.join(wanted.select("doc_id").distinct(), "doc_id").groupBy("shard", "block")
        blocks = blocks.join(hits.agg(F.collect_set("doc_id").alias("pick")), ["shard", "block"])
    else:
        blocks = blocks.withColumn("pick", F.lit(None).cast("array<long>"))
    rows = blocks.join(spark.read.parquet(f"{folder}/shards"), "shard").select(
        (F.col("start") + F.col("first")).alias("start"), "doc_ids", "ends", "counts", "data", "dict_hash", "pick"
    )

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opener = zstandard.ZstdDecompressor(dict_data=_dictionary(raw))
        for batch in batches:
            for i in range(batch.num_rows):
                start, docs, ends, counts, data, found, pick = [c[i].as_py() for c in batch.columns]
                if found != name:
                    raise ValueError(f"block needs dictionary {found}")
                starts = (np.cumsum([0, *counts[:-1]]) + start).tolist()
                chosen = [k for k, d in enumerate(docs) if pick is None or d in pick]
                ids = [
                    np.frombuffer(opener.decompress(data[ends[k - 1] if k else 0 : ends[k]]), f"<u{width}")
                    .astype("<u4").tobytes() for k in chosen
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([docs[k] for k in chosen], pa.int64()),
                        pa.array([starts[k] for k in chosen], pa.int64()),
                        pa.array([counts[k] for k in chosen], pa.int64()), pa.array(ids, pa.binary()),
                    ], names=["doc_id", "start", "n_tokens", "ids"],
                )

    return rows.mapInArrow(unpack, "doc_id long, start long, n_tokens long, ids binary")
