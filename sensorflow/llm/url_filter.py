"""URL filter: host and path rules, then logistic regression on hashed character n-grams."""

from __future__ import annotations

import zlib
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_texts

#: Rules (host, path, verdict).  A rule fits its host and all subdomains where
#: the url's path starts with the rule's path.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
#: The labelled table is made of these parts: hosts of one or two words, then a path.
UNWANTED_WORDS = ["casino", "poker", "pills", "viagra", "cheap", "win", "spam", "loans", "jackpot",
                  "adult", "xxx", "betting", "replica", "ads", "track", "farm"]
WANTED_WORDS = ["school", "library", "news", "garden", "river", "museum", "science", "other",
                "travel", "music", "health", "kitchen", "then", "ration", "thing", "ster"]
UNWANTED_PATHS = ["/bonus/win-now", "/buy/cheap-pills.html", "/free-spins"]
WANTED_PATHS = ["/articles/2021/water.html", "/about", "/docs/index.html"]
SHARED_PATHS = ["/en/12", "/de/345.html", "/fr/67/", "/es/890", "/", ""]
PREFIXES = ["", "www.", "blog.", "m."]
DOMAINS = ["example.com", "example.org", "example.net"]

FEATURES = 1 << 16
GRAMS = (3, 4, 5)


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without ://."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end; empty without ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Struct (rule, verdict) of the longest fitting rule, NULL if none fits."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        out = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"),
                                    F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def labelled_urls() -> list[tuple[str, str, int]]:
    """The small training table: (host, path, 1 if unwanted), made of the word lists above."""
    out = []
    for words, paths, label in ((UNWANTED_WORDS, UNWANTED_PATHS, 1), (WANTED_WORDS, WANTED_PATHS, 0)):
        paths = SHARED_PATHS + paths
        for i, (a, b) in enumerate(product(words, words)):
            name = a if a == b else f"{a}-{b}" if i % 2 else a + b
            out.append((f"{PREFIXES[i % 4]}{name}.{DOMAINS[i % 3]}", paths[i // 4 % len(paths)], label))
    return out


def grams(host: str, path: str) -> np.ndarray:
    """Distinct hashed n-grams of host and path, each kind apart."""
    found = set()
    for kind, text in (("h", f"^{host}$"), ("p", f"^{path}$")):
        for n in GRAMS:
            for i in range(len(text) - n + 1):
                found.add(zlib.crc32(f"{kind}{text[i:i + n]}".encode()) % FEATURES)
    return np.fromiter(found, np.int64, len(found))


@dataclass
class UrlModel:
    weights: np.ndarray
    bias: float

    def score(self, host: str, path: str) -> float:
        """Probability that the url is unwanted."""
        g = grams(host, path)
        z = self.bias + self.weights[g].sum() / max(1, len(g)) ** 0.5
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def train(table: list[tuple[str, str, int]], rounds: int = 300, rate: float = 8.0,
          decay: float = 1e-4) -> UrlModel:
    """Gradient descent on the mean logistic loss; n-grams of a url share unit length."""
    model = UrlModel(np.zeros(FEATURES), 0.0)
    if not table:
        return model
    rows = [grams(h, p) for h, p, _ in table]
    at = np.concatenate(rows)
    row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    value = np.repeat([max(1, len(r)) ** -0.5 for r in rows], [len(r) for r in rows])
    y = np.array([label for _, _, label in table], float)
    for _ in range(rounds):
        z = np.bincount(row, model.weights[at] * value, len(rows)) + model.bias
        error = 1 / (1 + np.exp(-z)) - y
        gradient = np.bincount(at, error[row] * value, FEATURES) / len(rows)
        model.weights -= rate * (gradient + decay * model.weights)
        model.bias -= rate * error.mean()
    return model


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
               rules: list[tuple[str, str, str]] = RULES,
               labelled: list[tuple[str, str, int]] | None = None,
               threshold: float = 0.7) -> DataFrame:
    """One row per input row: id, host, path, rule, verdict, score.

    The longest fitting rule decides; without one, a score of at least ``threshold`` blocks.
    The model learns from ``labelled`` (the small built-in table by default) on the driver and
    its weights are broadcast: 65,536 numbers.  A NULL url or one without :// has empty host
    and path, fits no rule and is scored as such.
    """
    model = train(labelled_urls() if labelled is None else labelled)
    shared = pages.sparkSession.sparkContext.broadcast(model)
    parts = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"),
                         path_of(F.col(url_col)).alias("path"))
    parts = parts.withColumn("both", F.concat("host", F.lit("/"), "path"))  # no host has a /

    def work(texts: list[str]) -> list:
        return [pa.array([shared.value.score(*t.split("/", 1)) for t in texts], pa.float64())]

    scored = map_texts(parts, "id", "both", "score double", work, 1_000_000, ("host", "path"))
    rule = longest_rule(F.col("host"), F.col("path"), rules)
    verdict = F.when(F.col("score") >= threshold, F.lit("block")).otherwise(F.lit("allow"))
    return (scored.withColumn("_r", rule)
            .select(F.col("id").alias(id_col), "host", "path", F.col("_r.rule").alias("rule"),
                    F.coalesce(F.col("_r.verdict"), verdict).alias("verdict"), "score"))
