"""Operators look up, tokenise and hash the different words of many texts at once."""

import random
import types
import zlib

import numpy as np
import public_tokenizers
import pytest

from llm import byte_bpe, token_files, toxicity

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def test_words_are_looked_up_once_in_all_texts():
    class Counting(dict):
        seen = 0

        def __getitem__(self, key):
            Counting.seen += 1
            return dict.__getitem__(self, key)

    encoder = byte_bpe.Encoder(RANKS)
    encoder.cache = Counting()
    texts = ["the word the word \0 the\0", "", "the word" * 50]
    ids = encoder.encode(texts)
    assert [encoder.decode(x) for x in ids] == [t.encode() for t in texts]
    assert Counting.seen <= 12


def test_short_texts_and_words_are_split_and_merged_like_long_ones():
    rng, encoder = random.Random(1), byte_bpe.encoder(RANKS)
    for _ in range(500):
        text = "".join(rng.choice("aZé1٣ 's't'm're've'll'd \n\t.,$_\0ß漢😀́") for _ in range(rng.randrange(40)))
        whole = byte_bpe.pieces([text, ""])[0]
        assert byte_bpe.pieces([text])[0] == whole
        assert all(encoder._merge_short(p.encode()) == encoder._merge_long(p.encode()) for p in whole)


def test_plain_words_are_tokenised_in_one_call():
    encoder = token_files.WordEncoder(WORDS, 1)
    lib = encoder.lib
    texts = ["Über the Word, word. " * 3, "", "le élève!!", "\n", "the  *** 12 it's <|endoftext|>"]
    expected = [[*lib.encode(t, add_special_tokens=False).ids, 1] for t in texts]

    def refuse(word):
        raise AssertionError(f"a call for {word}")

    encoder.lib = types.SimpleNamespace(encode=lib.encode, model=types.SimpleNamespace(tokenize=refuse))
    got = [np.frombuffer(x, encoder.type).tolist() for x in encoder.encode(texts)]
    assert got == expected


def test_words_are_hashed_in_step(monkeypatch):
    calls = []
    count = types.SimpleNamespace(crc32=lambda *a: calls.append(a) or zlib.crc32(*a))
    words = ["a", "abcd", "éléphant", "漢字漢字漢字漢字", "", "x" * 64, *(f"w{i}" for i in range(300))]
    monkeypatch.setattr(toxicity, "zlib", count)
    made = toxicity.buckets(words)
    expected = [[zlib.crc32(x.encode()) % toxicity.BUCKETS for x in (w, f"4{w[:4]} ", f"6{w[:6]} ")] for w in words]
    assert made.tolist() == expected and len(calls) < 10
    assert toxicity.buckets(["y" * 5000, "a"]).tolist()[0][0] == zlib.crc32(b"y" * 5000) % toxicity.BUCKETS


@pytest.mark.parametrize("part", [20, 1 << 20])
def test_words_are_those_of_the_pattern(monkeypatch, part):
    monkeypatch.setattr(toxicity, "_TEXT_PART", part)
    rng = random.Random(2)
    texts = ["".join(rng.choice("aZé1٣ \n\t.$_\0ß漢😀́²½ªΣİ") for _ in range(60)) for _ in range(50)] + ["", "a"]
    found = list(toxicity._pieces(texts))
    vocabulary, words = toxicity.distinct_words([text for _, text, _ in found])
    names, made = vocabulary.to_pylist(), [[] for _ in texts]
    for (d, _, _), own in zip(found, words):
        made[d] += [names[i] for i in own]
    assert made == [toxicity._WORD.findall(t.lower()) for t in texts]


def test_driver_keeps_one_model_while_it_trains(spark, monkeypatch):
    rows = [(i, ("bad awful " if i % 2 else "good kind ") * 5, "en") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    copies = []
    copy = toxicity._Fit.copy
    monkeypatch.setattr(toxicity._Fit, "copy", lambda own: copies.append(own) or copy(own))
    model = toxicity.train(docs, labels, epochs=2)
    low, high = toxicity.Scorer(model).score(["good kind", "bad awful"])
    assert not copies and low < high
