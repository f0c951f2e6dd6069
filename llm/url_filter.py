"""URL filters: rules by host and path, and a classifier for the URLs that no rule covers.

The classifier is a logistic regression on hashed character n-grams of host and path, fitted in numpy
on a small table of labelled URLs. Host and path have n-grams of their own, with marks at their ends.
N-grams of a whole batch are hashed at once from one array of code points.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField

from llm.common import add_columns

ALLOW, BLOCK = "allow", "block"
SIZES = (2, 3, 4, 5)
BUCKETS = 1 << 18
#: Code points that are hashed at once.
PART = 1 << 20
_HOST, _PATH, _END = 0x110000, 0x110001, 0x110002
_PARTS = re.compile(r"://([^/?#]*)([^?#]*)", re.DOTALL)
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    found = _PARTS.search(url or "")
    return (found[1].translate(_LOWER), found[2]) if found else ("", "")


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


class Rules:
    """Rules by host. One fits its host and all subdomains, if the path starts with its own.

    The longest (host and path together) wins; of equally long ones the longer host, and of two
    verdicts for the same host and path ``block``.
    """

    def __init__(self, rules: Iterable[Rule]):
        self.by_host: dict[str, dict[str, str]] = {}
        for verdict, host, path in rules:
            own = self.by_host.setdefault(host, {})
            own[path] = BLOCK if BLOCK in (verdict, own.get(path)) else verdict
        self.depth = max((h.count(".") for h in self.by_host), default=0)

    def of(self, host: str, path: str) -> Rule | None:
        names = host.rsplit(".", self.depth + 1)
        best: tuple[tuple[int, int], Rule] | None = None
        for k in range(len(names)):
            # With more dots than any rule has, the first part is not a single name.
            suffix = ".".join(names[k:])
            for prefix, verdict in self.by_host.get(suffix, {}).items():
                if path.startswith(prefix):
                    rank = (len(suffix) + len(prefix), len(suffix))
                    if best is None or rank > best[0]:
                        best = rank, Rule(verdict, suffix, prefix)
        return best[1] if best else None


def _rows_of(hosts: list[str], paths: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all URLs end to end, and the place after each URL; both parts carry marks."""
    points, ends, at = [], [], 0
    for host, path in zip(hosts, paths):
        own = [[_HOST], _points(host), [_END, _PATH], _points(path), [_END]]
        at += sum(map(len, own))
        points += own
        ends.append(at)
    return np.concatenate([np.asarray(p, np.uint32) for p in points]) if points else np.zeros(0, np.uint32), np.array(ends, np.int64)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def ngrams(hosts: list[str], paths: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every n-gram of the URLs, none across the end of host or path."""
    points, ends = _rows_of(hosts, paths)
    row = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
    # The part that a place belongs to: both start with their mark.
    part = np.cumsum((points == _HOST) | (points == _PATH))
    in_path = np.zeros(len(part) + 1, bool)
    in_path[part[points == _PATH]] = True
    rows, buckets = [], []
    mixed = (points.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    for n in SIZES:
        count = len(points) - n + 1
        if count <= 0:
            break
        made = np.full(count, n, np.uint64)
        for i in range(n):
            made = (made ^ mixed[i : i + count]) * np.uint64(0xFF51AFD7ED558CCD)
            made ^= made >> np.uint64(32)
        made = made + in_path[part[:count]] * np.uint64(0xC4CEB9FE1A85EC53)
        inside = part[:count] == part[n - 1 :]
        rows.append(row[:count][inside])
        buckets.append(((made ^ (made >> np.uint64(29))) % np.uint64(BUCKETS)).astype(np.int64)[inside])
    if not rows:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(rows), np.concatenate(buckets)


@dataclass
class Model:
    """Weights by bucket; the score is the probability of ``block``."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS, np.float32))
    bias: float = 0.0

    def score(self, hosts: list[str], paths: list[str]) -> np.ndarray:
        """Scores of URLs, in parts of bounded size; a URL's sum is over its n-grams, by their mean."""
        made, low, size = [], 0, 0
        for k in range(len(hosts) + 1):
            if k == len(hosts) or size > PART:
                made.append(self._part(hosts[low:k], paths[low:k]))
                low, size = k, 0
            if k < len(hosts):
                size += len(hosts[k]) + len(paths[k]) + 4
        return np.concatenate(made)

    def _part(self, hosts: list[str], paths: list[str]) -> np.ndarray:
        row, bucket = ngrams(hosts, paths)
        total = np.bincount(row, self.weights[bucket], len(hosts))
        return _logistic(total / _scale(np.bincount(row, minlength=len(hosts))) + self.bias)


def _scale(counts: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(counts, 1))


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(urls: list[str | None], blocked: list[bool], rounds: int = 200, rate: float = 0.5, penalty: float = 1e-4) -> Model:
    """Adagrad on the mean log loss over all rows, which are few; both classes weigh the same.

    Without rows, or with one class, the n-grams have no weight and the bias says the class.
    """
    model, y = Model(), np.array(blocked, np.float64)
    if len(set(blocked)) < 2:
        model.bias = 0.0 if not blocked else (6.0 if blocked[0] else -6.0)
        return model
    hosts, paths = zip(*map(split_url, urls))
    row, bucket = ngrams(list(hosts), list(paths))
    used, column = np.unique(bucket, return_inverse=True)
    scale = _scale(np.bincount(row, minlength=len(y)))
    value = 1 / scale[row]
    weights, past = np.zeros(len(used)), np.full(len(used), 1e-8)
    bias, past_bias = 0.0, 1e-8
    share = np.where(y == 1, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))
    for _ in range(rounds):
        p = _logistic(np.bincount(row, weights[column] * value, len(y)) + bias)
        slope = share * (p - y)
        step = np.bincount(column, slope[row] * value, len(used)) + penalty * weights
        past += step**2
        weights -= rate * step / np.sqrt(past)
        past_bias += slope.sum() ** 2
        bias -= rate * slope.sum() / np.sqrt(past_bias)
    model.weights[used] = weights
    model.bias = float(bias)
    return model


def train(labelled: DataFrame, per_class: int = 2000) -> Model:
    """Fit on a bounded sample of ``labelled`` (url, verdict): at most ``per_class`` URLs of each verdict.

    Different URLs are drawn by hash: a bound on the hash thins them out in every task, so that some
    ``per_class`` rows are left, before they are ordered. Null URLs and other verdicts take no part; a
    URL with both verdicts takes part with both. No rows give a model that scores 0.5.
    """
    rows = labelled.where("url is not null").where(F.col("verdict").isin(ALLOW, BLOCK)).select("url", "verdict")
    sizes = {r["verdict"]: r["n"] for r in rows.groupBy("verdict").agg(F.approx_count_distinct("url").alias("n")).collect()}
    drawn = F.pmod(F.xxhash64("url"), F.lit(1 << 40))
    found = []
    for verdict, size in sorted(sizes.items()):
        thin = drawn < int(min(1.0, 1.5 * per_class / max(1, size)) * (1 << 40))
        some = rows.where(F.col("verdict") == verdict).where(thin).distinct()
        found += some.orderBy(drawn, "url").limit(per_class).collect()
    found.sort(key=lambda r: (r["url"], r["verdict"]))
    return fit([r["url"] for r in found], [r["verdict"] == BLOCK for r in found])


def ruled(pages: DataFrame, rules: list[Rule], url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule (host and path of the rule that decides) and its verdict."""
    texts = ("host", "path", "rule", "verdict")
    table: list[Rules] = []

    def compute(urls):
        if not table:
            table.append(Rules(rules))
        parts = [split_url(u) for u in urls]
        best = [table[0].of(*p) for p in parts]
        return [
            [p[0] for p in parts], [p[1] for p in parts],
            [b.host + b.path if b else None for b in best], [b.verdict if b else None for b in best],
        ]

    return add_columns(pages, [url], [StructField(t, StringType()) for t in texts], compute)


def judge(pages: DataFrame, rules: list[Rule], model: Model, key: str = "page_id", url: str = "url") -> DataFrame:
    """``key``, host, path, rule, verdict and score for every row of ``pages``.

    The verdict is that of the rule that decides, else ``block`` where the model's score is above
    one half. The score is given for all rows. A null URL, or one without ``://``, has an empty host
    and path, which the model judges like any other. Only ``key`` and ``url`` are read; repeated rows
    stay; an empty table gives no rows.
    """
    shared = pages.sparkSession.sparkContext.broadcast(model)
    slim = pages.select(F.col(f"`{key}`").alias(key), F.col(f"`{url}`").alias("_url"))
    known = ruled(slim, rules, "_url").drop("_url")

    def compute(hosts, paths):
        return [shared.value.score(hosts, paths)]

    scored = add_columns(known, ["host", "path"], [StructField("score", DoubleType())], compute)
    by_model = F.when(F.col("score") > 0.5, BLOCK).otherwise(ALLOW)
    return scored.withColumn("verdict", F.coalesce("verdict", by_model))
