"""Toxicity: a weighted lexicon matched by Aho-Corasick in folded text, normalised by length."""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_texts, written

#: Labelled documents that lexicon and calibration are learnt from (a bounded sample).
TRAIN_DOCS = 20_000
#: Lexicon entries: word beginnings of these lengths, and whole words.
STEMS = range(4, 10)
MOST_ENTRIES = 20_000
#: An entry is in this many toxic documents of the sample at least, and this much likelier there
#: (natural logarithm).
LEAST_SUPPORT = 4
LEAST_WEIGHT = 2.0
#: Shorter texts count as this many words.
LEAST_WORDS = 20
BLOCK_CHARS = 2_000_000

#: Letters that look like a Latin one, invisible characters, digits and signs
#: written for letters, and phrases whose words are harmless together.
HOMOGLYPHS = dict(zip("аеорсхуіјѕԁһ"
                      "кмтαορνικτı",
                      "aeopcxyijsdhkmtaopvikti"))
INVISIBLE = "­​‌‍⁠﻿"
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "9": "g", "@": "a", "$": "s"}
EXCEPTIONS = ["clown fish", "trash can", "trash bin", "trash collection", "pond scum", "scum line",
              "rodeo clown", "trash talk show"]
#: Insults that count with this weight where the sample says nothing of them.
SEEDS = """arsehole bastard bitch bullshit clown coward cretin creep degenerate dimwit disgusting
    dumb dumbass fool freak garbage hateful hideous idiot idiotic imbecile jerk loser lunatic maggot
    moron moronic nasty pathetic pig repulsive scum scumbag shameful shut slut stupid swine trash
    ugly useless vermin vile worthless wretch""".split()
SEED_WEIGHT = 4.0
AS_LETTERS = re.compile(r"[0134579@$]+(?=[^\W\d_])|(?<=[^\W\d_])[013457]+(?![\w$@])")


class _Fold(dict):
    """Character table that fills itself: letters folded, anything else a space."""

    def __missing__(self, point: int) -> str | None:
        c = chr(point)
        if c in INVISIBLE:
            out = None
        else:
            wide = unicodedata.normalize("NFKC", c).lower()
            out = "".join(HOMOGLYPHS.get(x, x) for x in wide) if wide.isalpha() else " "
        self[point] = out
        return out


_FOLD = _Fold()


def fold(text: str) -> list[str]:
    """Words in folded letters."""
    text = AS_LETTERS.sub(lambda m: "".join(DIGITS[c] for c in m[0]), text.lower())
    return text.translate(_FOLD).split()


def entries(word: str) -> list[str]:
    """The lexicon entries that a word could match: beginnings after a space, and itself."""
    return [f" {word[:n]}" for n in STEMS if n <= len(word)] + [f" {word} "]


def outside(words: list[str], phrases: list[str] = EXCEPTIONS) -> list[str]:
    """The words that are not in an exception phrase."""
    joined = " " + " ".join(words) + " "
    for phrase in phrases:
        joined = joined.replace(" " + " ".join(fold(phrase)) + " ", " ")
    return joined.split()


@dataclass
class ToxicityModel:
    weights: dict[str, float]
    slope: float = 1.0
    offset: float = 0.0
    exceptions: tuple[str, ...] = tuple(EXCEPTIONS)

    def automaton(self) -> ahocorasick.Automaton:
        a = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            a.add_word(entry, (len(entry), weight))
        for phrase in self.exceptions:
            spaced = " " + " ".join(fold(phrase)) + " "
            a.add_word(spaced, (len(spaced), None))
        a.make_automaton()
        return a

    def density(self, text: str, automaton: ahocorasick.Automaton) -> float:
        """Weight of the words per word: each word counts with its heaviest entry, and words
        inside an exception phrase do not count."""
        words = fold(text)
        best: dict[int, float] = {}
        spared = []
        for end, (size, weight) in automaton.iter(" " + " ".join(words) + " "):
            start = end - size + 1
            if weight is None:
                spared.append((start, end))
            elif weight > best.get(start, 0.0):
                best[start] = weight
        if spared:
            starts, ends = [], []  # phrases that overlap, joined
            for a, b in sorted(spared):
                if ends and a <= ends[-1]:
                    ends[-1] = max(ends[-1], b)
                else:
                    starts.append(a)
                    ends.append(b)
            best = {at: w for at, w in best.items()
                    if (i := bisect_right(starts, at)) == 0 or at >= ends[i - 1]}
        return sum(best.values()) / max(LEAST_WORDS, len(words))


def calibrate(density: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve over the logarithm of the density."""
    x = np.column_stack([np.log(density + 0.005), np.ones(len(density))])
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        w += np.linalg.solve(h, x.T @ (label - p) - 1e-3 * w)
    return float(w[0]), float(w[1])


def _sample(docs: DataFrame, labels: DataFrame, train_rows: Column, id_col: str, text_col: str,
            label_col: str, train_docs: int) -> DataFrame:
    known = (labels.filter(train_rows & F.col(label_col).isNotNull())
             .groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("label")))
    share = min(1.0, train_docs / max(1, known.count()))
    drawn = known.filter(F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1_000_000)) < int(share * 1_000_000))
    # about train_docs narrow rows, whatever the table's size
    return written(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
                   .join(F.broadcast(drawn), "id"), "sample")


def learn(docs: DataFrame, labels: DataFrame, train_rows: Column, id_col: str = "doc_id",
          text_col: str = "text", label_col: str = "toxic",
          train_docs: int = TRAIN_DOCS) -> ToxicityModel:
    """Lexicon and calibration from about ``train_docs`` labelled documents."""
    sample = _sample(docs, labels, train_rows, id_col, text_col, label_col, train_docs)
    size = {r[0]: r[1] for r in sample.groupBy("label").count().collect()}
    toxic, clean = size.get(1, 0), size.get(0, 0)
    if not toxic or not clean:
        return ToxicityModel({}, 0.0, -30.0 if not toxic else 30.0)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist()):
                hits[label].update({e for w in set(outside(fold(text or ""))) for e in entries(w)})
            names = list(hits[0] | hits[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([hits[1][e] for e in names], pa.int64()),
                 pa.array([hits[0][e] for e in names], pa.int64())], ["entry", "toxic", "clean"])

    weight = F.log((F.col("toxic") + 0.5) / (toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (clean + 1.0))
    counts = (sample.select("text", F.col("label").cast("long").alias("label")).filter("label IN (0, 1)")
               .mapInArrow(count, "entry string, toxic long, clean long")
              .groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
              .filter(F.col("toxic") + F.col("clean") >= LEAST_SUPPORT))
    counts = written(counts, "counts")
    lexicon = (counts.select("entry", "toxic", weight.alias("weight"))
               .filter((F.col("toxic") >= LEAST_SUPPORT) & (F.col("weight") >= LEAST_WEIGHT))
               .orderBy(F.desc("toxic"), "entry").limit(MOST_ENTRIES))
    learnt = {r["entry"]: r["weight"] for r in lexicon.collect()}
    seeds = [f" {w} " for w in SEEDS]
    judged = {r["entry"] for r in counts.filter(F.col("entry").isin(seeds)).select("entry").collect()}
    model = ToxicityModel({w: SEED_WEIGHT for w in seeds if w not in judged} | learnt)
    pairs = densities(sample.withColumnRenamed("id", "_i"), model, "_i", "text", ("label",)).filter("label IN (0, 1)")
    rows = pairs.select("density", "label").collect()
    model.slope, model.offset = calibrate(np.array([r["density"] for r in rows]),
                                          np.array([r["label"] for r in rows], float))
    return model


_AUTOMATA: dict[int, ahocorasick.Automaton] = {}


def densities(docs: DataFrame, model: ToxicityModel, id_col: str, text_col: str,
              carry: tuple[str, ...] = ()) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(model)
    number = hash((tuple(sorted(model.weights.items())), model.exceptions))

    def work(texts: list[str]) -> list:
        if number not in _AUTOMATA:
            _AUTOMATA.clear()
            _AUTOMATA[number] = shared.value.automaton()
        return [pa.array([shared.value.density(t, _AUTOMATA[number]) for t in texts], pa.float64())]

    return map_texts(docs, id_col, text_col, "density double", work, BLOCK_CHARS, carry)


def score_toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id",
                   text_col: str = "text", threshold: float = 0.3) -> DataFrame:
    """One row per input row: id, score (0 to 1), predicted (1 from ``threshold``).

    The whole text counts.  NULL and empty texts hold no entry and get the least score.
    """
    z = F.lit(model.slope) * F.log(F.col("density") + 0.005) + F.lit(model.offset)
    score = 1 / (1 + F.exp(-F.greatest(F.least(z, F.lit(30.0)), F.lit(-30.0))))
    return (densities(docs, model, id_col, text_col)
            .select(id_col, score.alias("score"), (score >= threshold).cast("int").alias("predicted")))
