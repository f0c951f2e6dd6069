"""Filter audit, conversation trie and URL filter against brute force and odd input."""

import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from llm import conversation_trie, filter_audit, url_filter
from llm.queries import URL_RULES
from shelf.session import local_session


@pytest.fixture(scope="module")
def spark():
    return local_session(4, memory="4g", shuffle_partitions=4)


# --- filter audit ------------------------------------------------------------


def plain_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return [
        len(words), len(re.findall("[A-Z]", text)), len(text), len(re.findall(r"[#$%&*|]", text)), len(set(words))
    ]


@pytest.mark.parametrize("part", [1 << 21, 64, 7])
def test_transducer_counts_whole_texts(monkeypatch, part):
    monkeypatch.setattr(filter_audit, "PART", part)
    rng = random.Random(1)
    letters = "aAbZ é漢# \t\n\x0b\x1c 😀$x"
    texts = ["".join(rng.choice(letters) for _ in range(rng.choice([0, 1, 5, 60, 400]))) for _ in range(200)]
    texts += ["x" * 1000 + " " + "x" * 1000 + "y " + "x" * 1000, "", "a" * 300 + " " + "a" * 300, "ab " * 500, "", "Z"]
    coded = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(coded), np.uint8)
    made = filter_audit.measure(data, np.cumsum([0, *map(len, coded)]))
    assert made.tolist() == [plain_counts(t) for t in texts]


def test_words_with_equal_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(filter_audit, "_mix", lambda x: x * np.uint64(0))
    texts = ["ab cd ab " + "long-word-of-many-bytes " * 3, "ab", "x y z x"]
    coded = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(coded), np.uint8)
    assert filter_audit.measure(data, np.cumsum([0, *map(len, coded)]))[:, 4].tolist() == [3, 1, 3]


def plain_audit(docs, labels):
    good, toxic = ({d for d, *marks in labels if d is not None and marks[k] == 1} for k in (0, 1))
    least = {}
    for d, text, _ in docs:
        if d is not None:
            least[text or ""] = min(least.get(text or "", d), d)
    parts = defaultdict(list)
    for d, text, source in docs:
        words, capitals, chars, symbols, different = plain_counts(text or "")
        fails = {
            "A": words < 50, "B": 100 * different < 65 * words, "C": 100 * capitals > 5 * chars, "D": symbols > 0,
            "E": d is not None and least[text or ""] < d,
        }
        parts[source or ""].append((d, {x for x in fails if fails[x]}))
    rows = []
    for part, own in parts.items():
        total = defaultdict(int)
        for order in itertools.permutations("ABCDE"):
            left = list(own)
            for k, f in enumerate(order):
                gone = [x for x in left if f in x[1]]
                redundant = sum(f in x[1] for x in own) - len(gone)
                left = [x for x in left if f not in x[1]]
                total[f] += len(gone)
                rows.append(
                    [part, "".join(order), k + 1, len(left), len(gone), redundant, sum(x[1] == {f} for x in own),
                     sum(x[0] in good for x in gone), sum(x[0] in toxic for x in gone)]
                )
        for row in rows:
            if row[0] == part:
                row.append(total[row[1][row[2] - 1]])
    return sorted(map(tuple, rows))


def test_audit_equals_filtering_in_every_order(spark):
    rng = random.Random(2)
    pool = ["", None, "A B #", "word " * 60, " ".join(f"w{i}" for i in range(70)), "LOUD " + "x y z " * 30, "same text"]
    docs = [(i, rng.choice(pool), rng.choice(["s", None, "", "t"])) for i in range(80)]
    docs += [(3, "same text", "s"), (3, "same text", "s"), (None, "same text", "t"), (None, None, None), (-5, "same text", "t")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 80, 2)] + [(4, 1, 1), (None, 1, 1)]
    given = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, source string, part int, mask string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    made = sorted(map(tuple, filter_audit.audit(given, marks).collect()))
    assert made == plain_audit(docs, labels)
    assert filter_audit.audit(given.where("false"), marks).count() == 0
    assert filter_audit.audit(given, marks.where("false")).where("good_lost > 0").count() == 0


# --- conversation trie -------------------------------------------------------


def plain_trie(rows):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            turns[conv].append(((turn is not None, turn or 0), role, digest, text))
    own = {c: [(r, x) for _, r, _, x in sorted(t)] for c, t in turns.items()}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = own.get(c - int(np.fmod(c, 20)), [])[:h] + own[c][h:]
    nodes = defaultdict(list)
    for c, path in whole.items():
        for d in range(len(path) + 1):
            nodes[tuple(path[:d])].append(c)
    children = defaultdict(list)
    for node in nodes:
        if node:
            children[node[:-1]].append(node)

    def below(node):
        return [node] + [x for c in children[node] for x in below(c)]

    found = []
    for node, members in nodes.items():
        ends = ",".join(map(str, sorted(c for c in members if len(whole[c]) == len(node))))
        tree = below(node)
        words = [len(re.findall(r"[^\x20\x09-\x0D]+", x[-1][1])) if x else 0 for x in tree]
        found.append((
            min(members), len(node), min(nodes[node[:-1]]) if node else None, len(members), len(children[node]),
            sum(not children[x] for x in tree), sum((len(nodes[x]) - 1) * w for x, w in zip(tree, words)),
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(found, key=str)


CONV = "conv_id long, turn long, role string, text string, depth string, node int"


@pytest.mark.parametrize("shards", [None, 1, 40])
def test_trie_equals_brute_force(spark, shards, monkeypatch):
    monkeypatch.setattr(conversation_trie, "PIECE", 100)
    rng = random.Random(3)
    rows = []
    for c in [*range(-45, 120), 10**12 + 7]:
        if c % 20 == 0 and c % 40:
            continue
        if c % 3 == 0:  # a third of all conversations are one conversation
            rows += [(c, k, "user", f"the same {k}") for k in range(5)]
        else:
            rows += [(c, rng.choice([k, None, 1]), rng.choice(["user", None]), rng.choice(["a b", None, "", "ü\tb c"])) for k in range(rng.randint(1, 6))]
    rows += [rows[5], rows[5], (None, 1, "user", "lost")] + [(7, k, "user", "long " * k) for k in range(200)]
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], CONV).repartition(3)
    made = sorted(map(tuple, conversation_trie.trie(frame, shards).collect()), key=str)
    assert made == plain_trie(rows)


def test_trie_of_nothing_and_of_conversations_without_turns(spark):
    empty = spark.createDataFrame([], CONV)
    assert conversation_trie.trie(empty).count() == 0
    # 17's crc32 takes its first three turns from conversation 0, which is absent.
    alone = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4)
    one = spark.createDataFrame([(alone, 0, "user", "hi", "", 0)], CONV)
    assert [tuple(r) for r in conversation_trie.trie(one).collect()] == plain_trie([(alone, 0, "user", "hi")])


# --- URL filter --------------------------------------------------------------

URLS = [
    "http://Example.NET/en/1?x#y", "https://a.b.example.net/de/", "x://example.net", "http://net/", "http://anet/",
    "http://example.com/de/x", "http://notexample.com/de/", "http://www.example.org/fr/", "http://org/fr", None, "", "no host",
    "ftp://u@h:80/p://q", "http://É.NET/Ü?/", "http://" + "a." * 5000 + "net/" + "x" * 3000, "http://example.net/en/", "://", "a\nb://c\nd/e\nf?g",
]


def plain_rule(host, path):
    fits = [
        r for r in URL_RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    return max(fits, key=lambda r: len(r.host + r.path)) if fits else None


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    rest = re.split("[?#]", rest, maxsplit=1)[0]
    host, slash, path = rest.partition("/")
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), slash + path


def test_rules_and_verdicts(spark):
    rows = [(i, u, "h", 1.5, "v") for i, u in enumerate(URLS)] + [(None, URLS[0], "h", 2.5, "w"), (3, URLS[3], "h", 1.5, "v")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, score double, verdict string")
    model = url_filter.train(url_filter.ruled(pages.select("url"), URL_RULES))
    made = url_filter.judge(pages, URL_RULES, model)
    assert made.columns == ["page_id", "host", "path", "rule", "verdict", "score"]
    made = made.collect()
    assert len(made) == len(rows)
    at = {r[0]: r[1] for r in rows}
    for r in made:
        host, path = plain_parts(at[r["page_id"]])
        best = plain_rule(host, path)
        assert (r["host"], r["path"]) == (host, path)
        assert r["rule"] == (best.host + best.path if best else None)
        assert r["verdict"] == (best.verdict if best else "block" if r["score"] > 0.5 else "allow")
    assert url_filter.judge(pages.where("false"), URL_RULES, model).count() == 0


def test_longest_rule_wins_and_block_wins_ties():
    rules = url_filter.Rules([url_filter.Rule("allow", "b.c", "/"), url_filter.Rule("block", "c", "/xx"), url_filter.Rule("allow", "c", "/xx")])
    assert rules.of("a.b.c", "/x") == ("allow", "b.c", "/")
    assert rules.of("b.c", "/xx") == ("allow", "b.c", "/") if len("b.c/") >= len("c/xx") else ("block", "c", "/xx")
    assert rules.of("z.c", "/xxy") == ("block", "c", "/xx")
    assert rules.of("z", "/") is None


def test_ngrams_stay_within_host_and_path():
    row, bucket = url_filter.ngrams(["ab", "", "ab"], ["/c", "", "/d"])
    own = [sorted(bucket[row == k].tolist()) for k in range(3)]
    host = len([1 for n in url_filter.SIZES for _ in range(4 - n + 1)])  # mark, a, b, end
    assert len(own[0]) == 2 * host and len(own[1]) == 2
    assert len(set(own[0]) & set(own[2])) >= host


def test_classifier_learns_held_out_urls(spark):
    rng = random.Random(4)

    def url(bad):
        host = rng.choice(["casino", "bet-win", "pills"] if bad else ["library", "museum", "school"])
        return f"http://{host}{rng.randrange(99)}.test/{rng.choice(['play', 'go'] if bad else ['read', 'go'])}/{rng.randrange(999)}"

    known = [(url(k % 3 == 0), "block" if k % 3 == 0 else "allow") for k in range(600)]
    table = spark.createDataFrame([*known, (None, "block"), ("http://x.test", "maybe")], "url string, verdict string")
    model = url_filter.train(table, per_class=100)
    fresh = [k % 2 == 0 for k in range(400)]
    hosts, paths = zip(*[url_filter.split_url(url(b)) for b in fresh])
    said = model.score(list(hosts), list(paths)) > 0.5
    assert (said == fresh).mean() > 0.98
    assert url_filter.train(table.where("false")).score([""], [""])[0] == 0.5
    assert url_filter.train(table.where("verdict = 'allow'")).score(["a"], ["/"])[0] < 0.01
    assert np.array_equal(model.weights, url_filter.train(table.repartition(7), per_class=100).weights)
