"""Operators for training data against brute force, exact round trips and odd input."""

import base64
import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from llm import byte_bpe, jaccard_join, kd_topk, license_scan, source_mix, spot_signatures, token_counts
from llm import common, token_files, toxicity, warc_chunks
from llm.queries import RANKS, WORDS
from shelf.session import local_session
from shelf.staging import stage_path

ODD = ["", None, "a", "don't  we'll\n\t x's", "été 漢字 1234 ½", "x" * 3000, " " * 400, "the of and", "a", "\0\x1c'"]
DOCS = "doc_id long, text string, lang string, source string, n_chars long, ids string, score string"


@pytest.fixture(scope="module")
def spark():
    return local_session(4, memory="4g", shuffle_partitions=4)


def frame(spark, texts):
    rows = [(i, t, "en" if i % 2 else None, f"s{i % 3}" if i % 5 else None, None, "x", None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    return frame(spark, ODD)


@pytest.fixture(scope="module")
def empty(spark):
    return frame(spark, [])


@pytest.fixture(scope="module")
def rank_encoding():
    lines = open(RANKS, "rb")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bytes_are_encoded_and_decoded(spark, odd, empty, rank_encoding):
    rows = byte_bpe.decode(byte_bpe.encode(odd, RANKS), RANKS).orderBy("doc_id").collect()
    for row, text in zip(rows, ODD):
        assert np.frombuffer(row["ids"], "<u4").tolist() == rank_encoding.encode_ordinary(text or "")
        assert bytes(row["decoded"]).decode() == (text or "")
    assert byte_bpe.encode(empty, RANKS).count() == 0


def test_random_texts_split_like_the_pattern(rank_encoding):
    rng, encoder = random.Random(4), byte_bpe.encoder(RANKS)
    texts = ["".join(rng.choice("ab'stremvld \n\t.1é漢\x85") for _ in range(rng.randint(0, 90))) for _ in range(1500)]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == rank_encoding.encode_ordinary(text)
    raw = ("".join(texts))[:5000].encode()
    ids = encoder.encode([raw.decode()])[0]
    marks = encoder.offsets(ids, 16)
    assert encoder.decode_span(ids, marks, 16, 100, 999) == raw[100:999]


def test_token_trees_follow_edits():
    rng, encoder = random.Random(5), byte_bpe.encoder(RANKS)

    def count(text):
        return len(encoder.encode([text])[0]) // 4

    for _ in range(120):
        text = "".join(rng.choice("ab'st  \n.1é lld") for _ in range(rng.randint(0, 200)))
        leaf, own = rng.choice([1, 4]), byte_bpe.pieces([text])[0]
        encoder.learn(set(own))
        runs = [own[k : k + leaf] for k in range(0, len(own), leaf)]
        tokens = [sum(len(encoder.cache[p]) // 4 for p in run) for run in runs]
        tree = token_counts.TokenTree(text, [len("".join(run)) for run in runs], tokens, encoder, leaf)
        for _ in range(5):
            a, n, new = rng.randint(0, len(text) + 2), rng.choice([0, 2, 30]), "st 'l" * rng.choice([0, 1, 5, 12, 90])
            tree.edit(a, n, new)
            text = text[:a] + new + text[a + n :]
            assert tree.n_tokens == count(text) and tree.n_chars == len(text)
            whole, chars, tokens = tree.sums()
            assert whole == text and sum(chars) == len(text) and sum(tokens) == count(text)


def test_large_edits_encode_no_other_leaf():
    encoder = byte_bpe.encoder(RANKS)
    text = "one two three four five six " * 400
    own = byte_bpe.pieces([text])[0]
    parts = ["".join(own[k : k + 16]) for k in range(0, len(own), 16)]
    tree = token_counts.TokenTree(text, [len(p) for p in parts], [16] * len(parts), encoder)
    tree.edit(5000, 3, "seven eight " * 500)
    assert 1000 <= tree.encoded <= 1000 + 2 * 16 + 8 < len(own)


def test_kept_trees_take_edits_again_and_again(spark, odd, empty, rank_encoding):
    """Trees are written, edited, and the edited ones edited again; counts are those of whole texts."""
    rng = random.Random(6)

    def count(text):
        return len(rank_encoding.encode_ordinary(text))

    def change(text, edits):
        for e in edits or []:
            if e is not None:
                a = min(max(e[0] or 0, 0), len(text))
                text = text[:a] + (e[2] or "") + text[a + min(max(e[1] or 0, 0), len(text) - a) :]
        return text

    texts = [*ODD, "A text of some words, repeated. " * 300, "1234567" * 400]
    lists = [None, [], [None], [(None, None, None)], [(2, 3, None), (-5, 2, "x"), (10**9, 5, " end")], [(1, 10**9, "")]]
    rows = []
    for i, t in enumerate(texts):
        edits = lists[i % 6] if i % 2 else [(rng.randrange(40), rng.randrange(9), rng.choice(["", " a'll", "99"])) for _ in range(3)]
        rows.append((i if i not in (3, 4) else None, t, edits, "x", 5))
    rows += [rows[0], rows[0]]
    schema = "doc_id long, text string, edits array<struct<start: long, length: long, replacement: string>>, chars string, pieces int"
    docs = spark.createDataFrame(rows, schema)
    kept = token_counts.trees(docs, RANKS).withColumn("n", F.monotonically_increasing_id())
    numbered = docs.select("edits").withColumn("n", F.monotonically_increasing_id())
    done = token_counts.apply_edits(kept.join(numbered, "n"), RANKS)
    want = collections.Counter()
    for i, t, edits, *_ in rows:
        new = change(t or "", edits)
        want[i, new, count(t or ""), count(new), len(new)] += 1
    made = done.collect()
    assert collections.Counter((r["doc_id"], r["text"], r["n_tokens"], r["n_tokens_edited"], r["n_chars_edited"]) for r in made) == want
    assert all(sum(r["tokens"]) == r["n_tokens_edited"] and sum(r["chars"]) == r["n_chars_edited"] for r in made)
    # The edited trees take the next edits, from a table, without any text being split again.
    table = [(i, p, 3 * p, 1, " and") for i in range(len(texts)) for p in (2, 1)] + [(999, 1, 0, 0, "x"), (0, 3, None, None, None)]
    more = spark.createDataFrame(table, "doc_id long, place int, start long, length long, replacement string")
    again = token_counts.apply_edits(token_counts.with_edits(done, more), RANKS).collect()
    assert sorted((r["n_tokens"], r["n_tokens_edited"]) for r in again) == sorted(
        (n, count(t if i is None else change(t, [(3, 1, " and"), (6, 1, " and")]))) for (i, t, _, n, _), k in want.items() for _ in range(k)
    )
    assert token_counts.apply_edits(token_counts.self_edits(token_counts.trees(empty, RANKS)), RANKS).count() == 0
    wrong = token_counts.trees(docs, RANKS).withColumn("text", F.lit("other")).withColumn("edits", F.lit(None).cast(docs.schema["edits"].dataType))
    with pytest.raises(Exception, match="no tree"):
        token_counts.apply_edits(wrong, RANKS).collect()


def test_word_ids_are_those_of_the_library():
    """Special tokens spelt out, odd spaces and marks: the plain library with its defaults decides."""
    rng = random.Random(31)
    pool = [
        "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "it's", "Don't", "...", "\t", "\n", " ", "  ", "12a", "é", "e\u0301",
        "漢字", "<|", "|>", "\u00a0", "\x1c", "a", "B", "İ", "ǅ", "\0", "Été.", "größe,", "ÀÖØß", "×", "÷", "ÿ", "µ", "ªº", "\u0301",
    ]
    texts = ["".join(rng.choice(pool) + rng.choice(["", " "]) for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    lib = Tokenizer.from_file(WORDS)
    made = token_files.WordEncoder(WORDS, 1, cache_size=50).encode(texts)
    for text, ids in zip(texts, made):
        assert np.frombuffer(ids, "<u2").tolist() == [*lib.encode(text, add_special_tokens=False).ids, 1], text


def test_token_files(spark, odd, empty):
    lib = Tokenizer.from_file(WORDS)
    folder = stage_path(spark, "files")
    token_files.write_token_files(odd, folder, WORDS, block_bytes=40)
    rows = token_files.read_token_files(spark, folder).orderBy("doc_id").collect()
    start = 0
    for row, text in zip(rows, ODD):
        ids = [*lib.encode(text or "", add_special_tokens=False).ids, 1]
        assert np.frombuffer(row["ids"], "<u4").tolist() == ids
        assert (row["start"], row["n_tokens"]) == (start, len(ids))
        start += len(ids)
    some = token_files.read_token_files(spark, folder, odd.where("doc_id in (3, 7)").select("doc_id"))
    assert {r["doc_id"]: r["start"] for r in some.collect()} == {r["doc_id"]: r["start"] for r in rows if r["doc_id"] in (3, 7)}
    folder = stage_path(spark, "files")
    token_files.write_token_files(empty, folder, WORDS)
    assert token_files.read_token_files(spark, folder).count() == 0


def labelled(spark, n=400):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(n):
        bad = i % 5 == 0
        words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(40)]
        if bad:
            words[rng.randint(0, 39)] = f"vexo{rng.choice('abcdefgh')}{rng.choice('xyz')}"
        rows.append((i, " ".join(words), "en", "s", None, None, None))
        labels.append((i, int(bad)))
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity(spark, odd, empty):
    docs, labels = labelled(spark)
    model = toxicity.train(docs, labels)
    rows = toxicity.score(docs, model).withColumn("held", toxicity.held_out()).collect()
    held = [r for r in rows if r["held"]]
    assert np.mean([(r["predicted"] == 1) == (r["doc_id"] % 5 == 0) for r in held]) > 0.9
    assert all(r["held"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 for r in toxicity.score(odd, model).collect())
    assert toxicity.keep_clean(odd, model).columns == odd.columns
    constant = toxicity.train(empty, labels.where("false"))
    assert toxicity.score(empty, constant).count() == 0 and toxicity.score(odd, constant).count() == len(ODD)


def test_toxicity_learns_from_every_labelled_row(spark):
    """Long texts, and more rows of a class than one block holds, all train; null texts count as empty."""
    fill = " ".join(f"plain{k % 50}" for k in range(3000))
    rows = [(i, f"{fill} vexor {i}" if i % 4 == 0 else None if i == 1 else f"plain{i % 50} word{i % 7}") for i in range(80)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(80)], "doc_id long, toxic int")
    assert len(fill) > 20_000
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, toxicity.train(docs, labels)).collect()}
    assert min(s for i, s in scores.items() if i % 4 == 0) > max(s for i, s in scores.items() if i % 4)
    many = spark.range(5200).selectExpr("id AS doc_id", "concat('w', id % 90, ' v', id % 2) AS text", "'en' AS lang")
    marks = many.selectExpr("doc_id", "cast(doc_id % 2 AS int) AS toxic").unionByName(labels.selectExpr("doc_id", "0 AS toxic"))
    blocks = toxicity.blocks_of(*toxicity.training_rows(many, marks)).collect()
    learnt = [i for i in range(5200) if zlib.crc32(str(i).encode()) % 5]
    assert len(blocks) > 2 and max(b["n"] for b in blocks) <= toxicity.BLOCK_ROWS
    assert sum(b["n"] for b in blocks) == len(learnt) and sum(b["positives"] for b in blocks) == sum(i % 2 for i in learnt)


def test_toxicity_model_does_not_depend_on_the_tasks(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "BLOCK_ROWS", 60)
    docs, labels = labelled(spark)
    one = toxicity.train(docs.coalesce(1), labels, epochs=2)
    other = toxicity.train(docs.repartition(7), labels.repartition(3), epochs=2)
    assert (one.rows == other.rows).all() and (one.out == other.out).all()
    assert (one.scale, one.shift, one.thresholds) == (other.scale, other.shift, other.thresholds)


def test_toxicity_fit_moves_what_it_is_given(monkeypatch):
    """Peaks over pieces of a long text are those of the whole text; a block's moves change the weights by as much."""
    rng = np.random.default_rng(1)
    fit = toxicity._begin(0)
    docs = [rng.integers(0, toxicity.BUCKETS, (n, 3)).astype(np.int32) for n in (900, 0, 1, 40)]
    pooled, found = toxicity._peaks(fit.model, docs)
    monkeypatch.setattr(toxicity, "_RUN", 64)
    again, places = toxicity._peaks(fit.model, docs)
    assert np.allclose(pooled, again, atol=1e-5) and (found == places).all()
    own = fit.copy()
    toxicity._fit(docs, np.array([1.0, 0, 0, 1]), 2, 3, own)
    moved = fit.copy()
    moved.move_tail(own.tail() - fit.tail())
    assert np.allclose(moved.tail(), own.tail()) and not np.allclose(fit.tail(), own.tail())
    assert (own.model.rows != fit.model.rows).any(axis=1).sum() > 0


def test_workers_hold_the_state_of_one_operator():
    """Workers serve all operators in turn; what one kept goes when another begins."""
    first = common.held("one", "a", dict)
    assert common.held("one", "a", dict) is first
    assert common.held("one", "b", dict) is not first
    other = common.held("two", "a", list)
    assert list(common._held) == ["two"] and common.held("two", "a", list) is other


def test_long_texts_are_scored_whole(monkeypatch):
    rng = np.random.default_rng(0)
    model = toxicity._fit([], np.zeros(0), 1, 0)
    model.out = rng.normal(size=model.out.shape)
    text = " ".join(f"w{i % 97}" for i in range(4000))
    whole = toxicity.Scorer(model).score([text, ""])
    monkeypatch.setattr(toxicity, "_TEXT_PART", 500)
    assert np.allclose(toxicity.Scorer(model).score([text, ""]), whole)


def copies(seed=7):
    rng = random.Random(seed)
    texts = list(ODD)
    for _ in range(30):
        words = [f"w{rng.randint(0, 4000)}" for _ in range(rng.choice([4, 30, 120]))]
        for _ in range(rng.choice([1, 3, 6])):
            own = list(words)
            for _ in range(rng.choice([0, 0, 1, 2, 3])):
                own[rng.randrange(len(own))] = f"x{rng.randint(0, 9999)}"
            texts.append(" ".join(own))
    line = " ".join(f"common{i}" for i in range(60))
    return [*texts, *[f"{line} tail{i}" for i in range(150)], *[f"{line} {line} {i} {i * 7} {i * 9} {i}" for i in range(90)]]


def brute_classes(texts):
    sets, holders = [], collections.defaultdict(list)
    for k, text in enumerate(texts):
        words = re.findall(r"\w+", (text or "").lower())
        n = min(5, len(words))
        sets.append({tuple(words[j : j + n]) for j in range(len(words) - n + 1)} if words else set())
        for x in sets[-1]:
            holders[x].append(k)
    root, links = list(range(len(texts))), [0] * len(texts)
    for k, own in enumerate(sets):
        for j, met in collections.Counter(j for x in own for j in holders[x] if j > k).items():
            if 5 * met >= 4 * (len(own) + len(sets[j]) - met):
                links[k] += 1
                links[j] += 1
                a, b = sorted((root[k], root[j]))
                root = [a if r == b else r for r in root]
    return {k: (root[k], links[k]) for k in range(len(texts))}


@pytest.mark.parametrize("block", [2048, 16])
def test_near_duplicates(spark, empty, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", block)
    if block == 16:
        monkeypatch.setattr(jaccard_join, "MARK_WORDS", 1)
    texts = copies()
    rows = jaccard_join.near_duplicates(frame(spark, texts)).collect()
    assert {r["doc_id"]: (r["class_id"], r["n_links"]) for r in rows} == brute_classes(texts)
    if block == 16:
        assert jaccard_join.near_duplicates(empty).count() == 0
        kept = jaccard_join.keep_one(frame(spark, texts))
        assert kept.columns == empty.columns
        assert {r["doc_id"] for r in kept.collect()} == {c for c, _ in brute_classes(texts).values()}


def test_group_keys_that_end_in_zero_bytes():
    """A label is a digest; two of its last bytes may be zero, and its rows may come in several batches."""
    def batch(labels):
        return pa.RecordBatch.from_arrays([pa.array(labels, pa.binary()), pa.array(range(len(labels)))], names=["label", "n"])

    a, b, c = b"x" * 14 + b"\0\0", b"x" * 14 + b"\0\1", b"x" * 14
    batches = [batch([c, a, a]), batch([a]), batch([]), batch([a, a, b]), batch([b]), batch([b])]
    groups = [g.column(0).to_pylist() for g in jaccard_join._grouped(iter(batches), 1)]
    assert [x for g in groups for x in g] == [c, *[a] * 5, *[b] * 3]
    for key in (a, b, c):
        assert sum(key in g for g in groups) == 1


def test_links_of_a_cluster_in_several_batches(spark, monkeypatch):
    """Every label ends in a zero byte, and batches hold two rows: links are those of brute force."""
    digest = jaccard_join.xxhash.xxh3_128_digest
    monkeypatch.setattr(jaccard_join.xxhash, "xxh3_128_digest", lambda x: digest(x)[:15] + b"\0")
    words = [f"w{i}" for i in range(40)]
    sets = [jaccard_join.shingles(" ".join([*words, *[f"x{k}"] * (k % 2)])) for k in range(7)]
    names = [jaccard_join.xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
    rows = sorted({(min(names), 0, 0, 0, n, 1, s.tobytes()) for n, s in zip(names, sets)})
    types = [pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.binary()]
    table = [pa.array([r[k] for r in rows], t) for k, t in enumerate(types)]
    whole = pa.RecordBatch.from_arrays(table, names=["label", "low", "high", "block", "digest", "copies", "tokens"])
    parts = [whole.slice(k, 2) for k in range(0, len(rows), 2)]
    made = list(jaccard_join._compare(0.8)(iter(parts)))
    links = {d: n for b in made for d, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist())}
    assert links == {r[4]: len(rows) - 1 for r in rows} and len(rows) > 3


def test_links_are_found_under_a_hot_token(spark, monkeypatch):
    """Pairs of 0.8 that meet in buckets which all texts share, and which split several times."""
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 64)
    rng = random.Random(23)
    head, texts = [f"head{i}" for i in range(12)], []
    for k in range(500):
        own = [f"w{rng.randrange(10**6)}" for _ in range(70)]
        other = list(own)
        other[60 + k % 10] = f"y{k}"
        texts += [" ".join([*head, *own]), " ".join([*head, *other])]
    rows = jaccard_join.near_duplicates(frame(spark, texts)).collect()
    assert {r["doc_id"]: (r["class_id"], r["n_links"]) for r in rows} == brute_classes(texts)


@pytest.mark.parametrize("rows", [1_000, 10**6, 10**10])
def test_candidates_reach_the_recall(rows):
    """A shared token of sets of 800 and 1,000 (one contains the other: 0.8) is picked in time, and sketches let the pair pass."""
    splits = jaccard_join.splits_for(rows)
    runs = jaccard_join.runs_for(0.99999, 0.8, splits)
    needed = next(k for k in range(65) if k >= jaccard_join.NEAR * jaccard_join.SKETCH)
    same = 0.8 + 0.2 / 256
    unlike = sum(math.comb(64, k) * same**k * (1 - same) ** (64 - k) for k in range(needed))
    assert unlike < 1e-6
    assert unlike + (1 - jaccard_join.BRANCHING / 1000) ** (800 * runs) <= 1e-5
    assert runs <= jaccard_join.MOST_RUNS < len(jaccard_join._SALT) - 128
    assert jaccard_join.recall_of(runs, 0.8, splits) >= 0.99999
    assert splits == 0 or jaccard_join.recall_of(runs - 1, 0.8, splits) < 0.99999
    with pytest.raises(ValueError):
        jaccard_join.runs_for(0.99999, 0.5, splits)


def test_marks_keep_members(spark):
    ids = [None, *range(-50, 950), 7]
    docs = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string")
    member = docs.where("doc_id is null or doc_id % 10 = 0 or doc_id = 7")
    kept = collections.Counter(r["doc_id"] for r in jaccard_join._perhaps_in(docs, member).collect())
    own = collections.Counter(r["doc_id"] for r in member.collect())
    assert {i: kept[i] for i in own} == own and kept[7] == 2
    assert sum(kept.values()) < sum(own.values()) + 50
    assert jaccard_join._perhaps_in(docs, member.limit(0)).count() == 0


def test_signatures(spark, odd, empty):
    rows = {r["doc_id"]: r for r in spot_signatures.compare_edits(odd).collect()}
    texts = [t or "" for t in ODD]
    for i, text in enumerate(texts):
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + texts[(i + 1) % len(texts)][:quarter]
        assert rows[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest() and rows[i]["n_chars"] == len(text)
    assert rows[2]["fingerprint"] == rows[8]["fingerprint"] and rows[0]["fingerprint"] == rows[1]["fingerprint"]
    assert rows[7]["near_next"] == 0 and rows[0]["near_next"] == 1
    assert spot_signatures.compare_edits(empty).count() == 0


def plain_signatures(text, anchors):
    """The definition of a signature, word by word."""
    def longs(*xs):  # Spark's hash of several longs: each is the seed of the next
        seed = 42
        for x in xs:
            seed = xxhash.xxh64_intdigest(int(x).to_bytes(8, "little", signed=True), seed)
        return int(np.uint64(seed).astype(np.int64))

    han = r"\p{Script=Han}\p{Script=Hiragana}\p{Script=Katakana}"
    lowered = "".join("¶" if c in spot_signatures._ENDS else c for c in text.lower())
    tokens = regex.findall(rf"[[\p{{L}}\p{{N}}]--[{han}]]+|¶|[{han}]", lowered, regex.V1)
    hashes = [spot_signatures.word_hash(w) for w in tokens]
    skip = {spot_signatures.word_hash(w) for w in [*anchors, "¶"]}
    first, drawn = spot_signatures.word_hash("^"), spot_signatures.word_hash("~")
    content = [(w, p) for w, p in zip(hashes, [first, *hashes]) if w not in skip]
    found = set()
    for k, (w, p) in enumerate(content):
        start = p if p in skip or p == first else drawn if w % 4 == 0 else None
        if start is not None:
            h = longs(start, w)
            found.add(longs(h, content[k + 1][0]) if k + 1 < len(content) else longs(h))
    if not found and text:
        found = {int(np.uint64(xxhash.xxh64_intdigest(text.encode(), 42)).astype(np.int64))}
    return found


def test_fingerprints_equal_the_definition(spark, monkeypatch):
    """Sparse, repeated and null ids over many ranges; clashing columns; a very long text."""
    monkeypatch.setattr(spot_signatures, "RANGE_ROWS", 16)
    rng = random.Random(41)
    pool = [*"the of and der die cat dog Été haus 漢字 かな x1 ½ a.b ... \n the\tcat".split(" "), "word", "Wort"]
    rows = [(rng.choice([rng.randrange(-(10**15), 10**15), 7, None]), " ".join(rng.choices(pool, k=rng.randrange(40)))) for _ in range(300)]
    rows += [(5, None), (6, ""), (6, ""), (8, "long " + " ".join(f"w{i % 9000} the" for i in range(20_000)))]
    docs = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], "doc_id long, text string, range int, sentinel string, hash int, own int")
    anchors = ["the", "of", "and", "der", "die"]
    made = spot_signatures.compare_edits(docs, anchors).collect()
    assert len(made) == len(rows)

    def name(signs):
        return f"{len(signs)}:{hashlib.sha256(','.join(map(str, sorted(signs))).encode()).hexdigest()}"

    def alike(a, b):
        return 1.0 if not a | b else len(a & b) / len(a | b)

    least = (1 << 63) - 1

    def place(r):
        text = r[1] or ""
        return (r[0] is not None, r[0] or 0, int(np.uint64(xxhash.xxh64_intdigest(text.encode(), 42)).astype(np.int64)))

    line = [(r[0], r[1] or "") for r in sorted(rows, key=place)]
    want = []
    for (doc, text), (_, after) in zip(line, line[1:] + line[:1]):
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + after[:quarter]
        own, changed, following = (plain_signatures(t, anchors) for t in (text, edited, after))
        want.append((
            doc if doc is not None else least, len(text), hashlib.sha256(edited.encode()).hexdigest(), name(own), name(changed),
            round(alike(own, changed), 9), round(alike(own, following), 9),
        ))
    got = [
        (r["doc_id"] if r["doc_id"] is not None else least, r["n_chars"], r["edited_sha256"], r["fingerprint"],
         r["edited_fingerprint"], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in made
    ]
    assert sorted(got) == sorted(want)


def test_texts_with_few_anchors_have_signatures(spark):
    rng = random.Random(11)
    russian = ["Старый капитан долго смотрел на тёмное море и молчал.", "Старый капитан продал лодку соседу за мешок муки."]
    many = [f"Слово{rng.randint(0, 999)} и дом{rng.randint(0, 999)} на горе{rng.randint(0, 999)} не стоит" for _ in range(60)]
    words = [f"item{rng.randint(0, 9999)}" for _ in range(60)]
    table = "\n".join(f"{w}\t{rng.randint(0, 9999)}" for w in words)
    listed, other = " ".join(words), " ".join(["new", "begin", *words[2:]])
    texts = [*russian, table, listed, other, *many]
    docs = spark.createDataFrame([(i, t, "ru" if i < 2 or i > 4 else "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    anchors = spot_signatures.corpus_anchors(docs)
    assert {"и", "на", "не"} <= set(anchors) and "капитан" not in anchors
    rows = {r["doc_id"]: r for r in spot_signatures.compare_edits(docs).collect()}
    sizes = {i: int(rows[i]["fingerprint"].split(":")[0]) for i in rows}
    assert rows[0]["near_next"] < 1 and rows[0]["near_edited"] < 1
    assert sizes[2] > 40 and sizes[3] > 8 and rows[3]["near_edited"] < 1
    assert 0.5 < rows[3]["near_next"] < 1


def test_similar_fingerprints(spark):
    texts = copies(8)[len(ODD) : len(ODD) + 60]
    texts = [" the ".join(t.split()) for t in texts]
    pairs, members = spot_signatures.near_pairs(frame(spark, texts))
    found = {(r["a"], r["b"]) for r in pairs.collect()}
    signed = frame(spark, texts).selectExpr("doc_id", "text").orderBy("doc_id")
    signed = signed.select(spot_signatures.signatures(F.col("text")).alias("s"))
    names = {r["doc_id"]: r["fingerprint"] for r in members.collect()}
    sets = {names[i]: set(r["s"]) for i, r in enumerate(signed.collect())}
    want = {
        frozenset((a, b)) for a in sets for b in sets
        if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    }
    assert {frozenset(p) for p in found} == want


def test_licences(spark, odd, empty):
    lines = ["Licensed under the Apache License, Version 2.0.", "Some words of prose.", "He lost his driving licence."]
    docs = frame(spark, ["\n".join(lines), "Released under the MIT License.", *ODD])
    scanner = license_scan.train(docs)
    rows = {(r["doc_id"], r["paragraph"]): r for r in scanner.scan(docs).collect()}
    assert rows[0, 0]["family"] == "Apache-2.0" and rows[0, 0]["confirmed"]
    assert rows[1, 0]["family"] == "MIT" and rows[1, 0]["confirmed"]
    assert not rows[0, 2]["confirmed"] and (0, 1) not in rows
    assert scanner.scan(empty).count() == 0


NOTICES = {
    "SPDX-Identifier: Apache-2.0": "Apache-2.0", "This tool is GPLv3 or later": "GPL-3.0",
    "All texts of this page are available under CC BY-SA 4.0": "CC-BY-SA",
    "Creative Commons Attribution 4.0 International": "CC-BY", "We have released it under MIT": "MIT",
    "Acme GmbH. Alle Rechte vorbehalten.": "Proprietary", "2021 Dupont. Tous droits réservés.": "Proprietary",
    "The sources are covered by an MIT licence": "MIT",
    "Dieses Programm steht unter der Apache-Lizenz,\nVersion 2.0, und darf benutzt werden": "Apache-2.0",
    "# This program is free software: you can redistribute\n# it and/or modify it under the terms of the GNU\n"
    "# General Public License as published by the Free Software\n# Foundation, either version 3 of the License, or\n"
    "# (at your option) any later version.": "GPL-3.0",
    "Licensed under the\nApache License, Version 2.0 (the \"License\"); you may not\nuse this file except in compliance with\nthe License.": "Apache-2.0",
}


def test_notices_that_are_not_templates(spark):
    prose = " ".join(f"the river{i} was wide and a boat{i} of the town came on time" for i in range(8))
    plain = [prose, "She had a permission to park there.", "The licence plate of the old car was lost.", "An apache helicopter of 1984."]
    middle = "\n\n".join([prose, "\n\n".join(f"{n}\n\n{prose}" for n in NOTICES)])
    inside = f"{prose}\n{prose} and it is licensed under the MIT License since then {prose}"
    docs = frame(spark, [*NOTICES, *plain, middle, inside])
    rows = license_scan.train(docs).scan(docs).collect()
    assert [f for _, f in NOTICES.items()] == [
        next((r["family"] for r in rows if r["doc_id"] == i and r["confirmed"]), None) for i in range(len(NOTICES))
    ]
    first = len(NOTICES)
    assert not [r for r in rows if first <= r["doc_id"] < first + len(plain) and r["confirmed"]]
    lines, starts = middle.split("\n"), {}
    for n, family in NOTICES.items():
        starts[lines.index(n.split("\n")[0])] = family
    assert {r["paragraph"]: r["family"] for r in rows if r["doc_id"] == first + len(plain) and r["confirmed"]} == starts
    assert [(r["paragraph"], r["family"]) for r in rows if r["doc_id"] == first + len(plain) + 1 and r["confirmed"]] == [(0, "MIT")]


@pytest.mark.parametrize("size", [1 << 20, 7])
def test_archives(spark, size):
    pages = [(1, "u", "abc" * 9), (2, None, "abc" * 9), (3, "u v", None), (4, "", ""), (5, "u", "é\r\n\r\n" * 5), (6, "u", "x")]
    path = stage_path(spark, "warc")
    warc_chunks.write_archives(spark.createDataFrame(pages, "page_id long, url string, html string"), path, chunk_bytes=size)
    rows = {r["page_id"]: r for r in warc_chunks.read_archives(spark, path).collect()}
    for page, _, html in pages:
        raw = (html or "").encode()
        last = max(p for p, _, h in pages if (h or "") == (html or ""))
        want = (len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "response" if last == page else "revisit")
        row = rows[page]
        assert (row["payload_bytes"], row["payload_digest"], row["record_type"]) == want
        assert row["refers_to"] == (None if last == page else last)


def test_top_k(spark, monkeypatch):
    monkeypatch.setattr(kd_topk, "SHARD_ROWS", 60)
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(0, 1, 6).round(1).tolist()) for i in range(300)]
    rows += [(300 + i, [0.5] * 6) for i in range(200)]
    rows += [(900, None), (950, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (1000, [float("nan")] * 6), (None, [1.0] * 6), (1050, [1.0, 2.0])]
    vectors = kd_topk.whole_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    got = collections.defaultdict(list)
    for r in kd_topk.top_k(vectors, vectors.where("vec_id % 50 = 0")).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    good = {i: np.floor(256 * np.array(v, np.float32).astype(float)).astype(int) for i, v in rows[:500]}
    for q in range(0, 500, 50):
        scores = sorted((-int(good[q] @ v), i) for i, v in good.items() if i != q)[:5]
        assert got[q] == [(i, -s) for s, i in scores]
    assert 1050 not in got


def test_top_k_is_exact_for_large_components(spark):
    """Products beyond 53 bits, repeated ids of queries, and scores that no long can hold."""
    rng = np.random.default_rng(19)
    rows = [(i, rng.integers(-(2**29), 2**29, 4).tolist()) for i in range(120)]
    rows += [(0, [1, 2, 3, 4]), (50, rows[50][1]), (121, rows[50][1])]
    vectors = spark.createDataFrame([(i, 4, v) for i, v in rows], "vec_id long, dim int, vector array<long>")
    got = collections.defaultdict(list)
    for r in kd_topk.top_k(vectors, vectors.where("vec_id % 50 = 0")).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    want = collections.defaultdict(list)
    for q, own in {(i, tuple(v)) for i, v in rows if i % 50 == 0}:
        scores = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in rows if i != q)[:5]
        want[q] += [(n + 1, i, -s) for n, (s, i) in enumerate(scores)]
    assert {q: sorted(x) for q, x in got.items()} == {q: sorted(x) for q, x in want.items()}
    assert len(got[0]) == 10 and len(got[50]) == 5
    huge = spark.createDataFrame([(0, 1, [2**40]), (1, 1, [2**40])], "vec_id long, dim int, vector array<long>")
    with pytest.raises(ValueError):
        kd_topk.top_k(huge, huge)


def test_shards_that_cannot_beat_the_floor_are_not_asked(spark, monkeypatch):
    """Clusters far apart, a third of all vectors equal, one vector of another dimension."""
    monkeypatch.setattr(kd_topk, "SHARD_ROWS", 50)
    rng = np.random.default_rng(29)
    rows = [(i, (rng.normal(0, 3, 5) + 400 * np.eye(5)[i % 5]).round().astype(int).tolist()) for i in range(600)]
    rows += [(600 + i, [7] * 5) for i in range(300)] + [(5000, [1, 2])]
    vectors = spark.createDataFrame([(i, len(v), v) for i, v in rows], "vec_id long, dim int, vector array<long>")
    pairs = []
    asked = kd_topk._asked
    monkeypatch.setattr(kd_topk, "_asked", lambda *a: pairs.append(asked(*a)) or pairs[-1])
    got = collections.defaultdict(list)
    for r in kd_topk.top_k(vectors, vectors.where("vec_id % 20 = 0")).orderBy("rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    for q, own in rows:
        if q % 20 == 0 and len(own) == 5:
            scores = sorted((-sum(a * b for a, b in zip(own, v)), i) for i, v in rows if i != q and len(v) == 5)[:5]
            assert got[q] == [(i, -s) for s, i in scores]
    assert 5000 not in got
    queries, cells = len([1 for i, v in rows if i % 20 == 0 and len(v) == 5]), pairs[0].count()
    assert cells == queries + 1
    # A query of a cluster asks some parts of about twenty; the equal vectors lie between all clusters.
    assert pairs[1].where("query_id < 600").count() < 30 * 10


MENTIONS = [
    "The cc0 bit of the status register was set.", "The project does not accept code under the LGPL.",
    "This file is *not* licensed under the MIT License.", "Yesterday the unlicense plate was lost.",
    "The BSD License debate of 1999 went on for months.", "GPLv3", "A MIT professor spoke.",
]


def test_mentions_and_denials_are_not_confirmed(spark):
    given = "Nothing else. This library is distributed under the BSD license, as many others are."
    docs = frame(spark, [*MENTIONS, "\n\n".join(MENTIONS), given, ("word " * 30_000) + "\n\nReleased under the MIT License.\n", given])
    rows = license_scan.train(docs).scan(docs).collect()
    assert {(r["doc_id"], r["family"]) for r in rows if r["confirmed"]} == {
        (len(MENTIONS) + 1, "BSD"), (len(MENTIONS) + 2, "MIT"), (len(MENTIONS) + 3, "BSD")
    }


def test_mix(spark, odd, empty):
    rng = random.Random(10)
    texts = [" ".join(["w"] * rng.randint(0, 900)) for _ in range(400)]
    docs = frame(spark, [*texts, *ODD])
    rows = source_mix.mix(source_mix.sized(docs), block_words=16).collect()
    again = source_mix.mix(source_mix.sized(docs.repartition(7)), block_words=16).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    assert all(r["taken"] <= 2 * r["size"] for r in rows)
    taken, goal = collections.Counter(), {}
    for r in rows:
        taken[r["source_size"]] += r["taken"]
        goal[r["source_size"]] = r["target"]
    assert all(abs(taken[s] - t) <= 32 for s, t in goal.items())
    assert abs(sum(goal.values()) - 1.5 * sum(goal)) < 1e-6 * sum(goal)
    mixed = source_mix.mixed_documents(docs, block_words=16)
    words = sum(len(re.findall(source_mix.WORD, r["text"])) for r in mixed.collect())
    assert mixed.columns == docs.columns and words == sum(r["taken"] for r in rows)
    assert source_mix.mix(source_mix.sized(empty)).count() == 0 and source_mix.mixed_documents(empty).count() == 0


def test_shards_hold_multinomial_counts_and_whole_blocks(spark, monkeypatch):
    """Every slot is in one shard, counts by source lie near their share, and blocks hold their words."""
    monkeypatch.setattr(source_mix, "SHARD_SLOTS", 400)
    rng = random.Random(12)
    docs = [(i if i % 50 else None, f"s{i % 3}" if i % 4 else None, rng.randint(0, 400)) for i in range(600)]
    docs += [(7, "s1", 100), (7, "s1", 100)]
    rows = spark.createDataFrame(docs, "doc_id long, source string, size long")
    goals = source_mix.targets(rows)
    slots = source_mix.shard_blocks(rows, goals, 16).toPandas()
    wanted = {r["key"]: r for r in source_mix._slots(goals, 16).collect()}
    assert slots.groupby("key").size().to_dict() == {k: r["slots"] for k, r in wanted.items()}
    assert not slots.duplicated(["key", "slot"]).any()
    shards = -(-len(slots) // 400)
    assert slots["shard"].nunique() == shards > 3
    for (_, key), n in slots.groupby(["shard", "key"]).size().items():
        mean = wanted[key]["slots"] / shards
        assert abs(n - mean) < 5 * math.sqrt(mean)
    assert (slots.groupby(["key", "block"])["pass"].nunique() == slots.groupby(["key", "block"]).size()).all()
    for key, own in slots.groupby("key"):
        last = own["block"].max()
        for block, parts in zip(own["block"], own["parts"]):
            held = sum(p["words"] for p in parts)
            assert held == 16 or block == last and held == (wanted[key]["source_size"] - 1) % 16 + 1
    taken = collections.Counter()
    for key, parts in zip(slots["key"], slots["parts"]):
        for p in parts:
            taken[p["doc_id"], key, p["size"]] += p["words"]
    made = source_mix.mix(rows, 16).collect()
    assert len(made) == len(docs)
    by_row = collections.Counter()
    key_of = {r["source_size"]: k for k, r in wanted.items()}
    for r in made:
        by_row[r["doc_id"], key_of[r["source_size"]], r["size"]] += r["taken"]
    assert +by_row == +taken


def test_targets_refill(spark):
    rows = [("a", 10), ("b", 1000), ("c", 100), (None, 50)]
    got = {r["key"]: r["target"] for r in source_mix.targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    size, weight = dict(rows), {"a": 3, "b": 1, "c": 2, None: 3}
    goal, total = dict.fromkeys(size, 0.0), 1.5 * sum(size.values())
    open_ = set(size)
    while open_:
        left = total - sum(goal[s] for s in size if s not in open_)
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * size[s]}
        goal |= {s: 2.0 * size[s] if s in over else share[s] for s in open_}
        if not over:
            break
        open_ -= over
    assert got == pytest.approx({"null" if s is None else f"={s}": t for s, t in goal.items()})


CLASH = (
    "doc_id long, text string, lang string, source string, score string, predicted string, flagged long, row string, "
    "_in0 int, _doc string, _size string, _parts string, _taken int, row_key string, digest int, label string"
)


def test_stages_keep_clashing_columns_and_rows_of_one_id(spark):
    """Different texts under one id, no id, repeated rows, and columns that bear the operators' names."""
    rng = random.Random(51)
    texts = [" ".join(rng.choices([f"w{i}" for i in range(400)], k=60)) for _ in range(6)]
    near = texts[0].replace(texts[0].split()[30], "other", 1)
    ids = [(7, texts[0]), (7, texts[1]), (None, texts[2]), (None, texts[3]), (None, texts[2]), (3, near), (5, ""), (5, None), (6, ""), (9, texts[4]), (9, texts[4])]
    rows = [(i, t, "en", f"s{k % 2}", "mine", "p", 4, "r", 1, "d", "z", "q", 2, "k", 3, "l") for k, (i, t) in enumerate(ids)]
    docs = spark.createDataFrame(rows, CLASH).repartition(3)
    kept = jaccard_join.keep_one(docs)
    assert kept.schema == docs.schema
    found = kept.collect()
    assert collections.Counter((r["doc_id"], r["text"] or "") for r in found) == collections.Counter(
        [(7, texts[1]), (None, texts[2]), (None, texts[3]), (3, near), (5, ""), (6, ""), (9, texts[4])]
    )
    assert {(r["score"], r["_in0"], r["row_key"], r["_taken"]) for r in found} == {("mine", 1, "k", 2)}
    labels = spark.createDataFrame([(i, 0, int(i % 2)) for i in range(8)], "doc_id long, quality int, toxic int")
    clean = toxicity.keep_clean(docs, toxicity.train(docs, labels))
    assert clean.schema == docs.schema and {r["score"] for r in clean.collect()} <= {"mine"}
    mixed = source_mix.mixed_documents(docs, block_words=8)
    assert mixed.columns == docs.columns
    made = mixed.collect()
    assert {(r["score"], r["_doc"], r["_size"], r["_parts"], r["_taken"]) for r in made} == {("mine", "d", "z", "q", 2)}
    assert {r["doc_id"] for r in made} >= {None, 7, 9}
    scored = toxicity.score(docs.drop("score", "predicted", "flagged"), toxicity.train(docs, labels))
    assert {r["_in0"] for r in scored.collect()} == {1}


def test_pipeline(spark):
    import corpus_pipeline

    docs = "/root/testdata/sf0.001"
    rows = corpus_pipeline.run(spark, docs).collect()
    assert len(corpus_pipeline.STAGES) == 4 and rows and all(len(r["ids"]) == 4 * r["n_tokens"] for r in rows)


def test_pipeline_stages_against_brute_force(spark, rank_encoding):
    """What each stage keeps follows from what the one before it wrote."""
    import corpus_pipeline

    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    clean, distinct, mixed, encoded = (f for _, f in corpus_pipeline.STAGES)
    first = clean(spark, docs, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    scored = toxicity.score(docs.select("doc_id", "text", "lang"), toxicity.train(docs, labels))
    assert {r["doc_id"] for r in first.collect()} == {r["doc_id"] for r in scored.collect() if not r["flagged"]}
    rows = first.orderBy("doc_id").collect()
    classes = brute_classes([r["text"] for r in rows])
    wordless = {k for k, r in enumerate(rows) if not re.search(r"\w", r["text"] or "")}
    want = {rows[c]["doc_id"] for c, _ in classes.values()} | {rows[k]["doc_id"] for k in wordless}
    second = distinct(spark, first, folder)
    assert {r["doc_id"] for r in second.collect()} == want
    third = mixed(spark, second, folder)
    taken = collections.Counter()
    texts = {r["doc_id"]: r["text"] or "" for r in second.collect()}
    parts = third.collect()
    for r in parts:
        own, whole = re.findall(source_mix.WORD, r["text"]), collections.Counter(re.findall(source_mix.WORD, texts[r["doc_id"]]))
        assert not collections.Counter(own) - whole and r["n_chars"] == len(r["text"])
        taken[r["source"]] += len(own)
    sized = source_mix.sized(second)
    size_of = {r["source"]: r["n"] for r in sized.groupBy("source").agg(F.sum("size").alias("n")).collect()}
    goal = {r["key"]: r["target"] for r in source_mix.targets(sized).collect()}
    for source, n in size_of.items():
        assert abs(taken[source] - goal["null" if source is None else f"={source}"]) <= 2 * source_mix.BLOCK_WORDS
        assert taken[source] <= 2 * n
    last = encoded(spark, third, folder).collect()
    assert collections.Counter((r["doc_id"], bytes(r["ids"])) for r in last) == collections.Counter(
        (r["doc_id"], np.array(rank_encoding.encode_ordinary(r["text"]), "<u4").tobytes()) for r in parts
    )


def test_german_mit_is_no_licence(spark):
    """Unknown windows that reach the threshold teach what probability a family needs by itself."""
    rng = random.Random(5)
    words = ["".join(rng.choice("aeioulmnrst") for _ in range(7)) for _ in range(300)]
    prose = [" ".join(rng.choices(words, k=12) + ["mit"] * (i % 25 == 0) + rng.choices(words, k=12)) for i in range(500)]
    given = ["It is released under the MIT License.", "The sources are covered by an MIT licence"]
    docs = frame(spark, prose + given)
    scanner = license_scan.train(docs)
    rows = scanner.scan(docs).collect()
    assert {(r["doc_id"], r["family"], r["confirmed"]) for r in rows} == {(500, "MIT", True), (501, "MIT", True)}
    assert set(scanner.alone) == {"MIT"}
    scanner.alone = {}
    assert len(scanner.scan(docs).collect()) > 15
