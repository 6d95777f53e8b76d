"""Token counts: overlapping chunks of long documents, encoded with offsets and spliced at common
boundaries that are proven stable."""

from __future__ import annotations

import json
import os
import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_texts

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 512
#: Units whose counts a worker remembers (about 120 bytes each).
CACHED_UNITS = 400_000
#: Longer units are not remembered.
UNIT_CHARS = 40
STEP_BYTES = 2_000_000
#: Characters after its end that a piece of the byte-level pattern can depend on ('re).
LOOKAHEAD = 3

#: Letters of every version of Unicode.
LETTER = "A-Za-zÀ-ÖØ-öø-ſ"
#: Places where a piece of the byte-level pattern starts whatever stands further away: one space
#: between printable ASCII or a letter and a letter; the letter after a single line break; a
#: stop after a letter.
SURE = re.compile(rf"(?<=[!-~{LETTER}])(?= [{LETTER}])|(?<=[!-~{LETTER}]\n)(?=[{LETTER}])|(?<=[{LETTER}])(?=[.,;:!?])")
ONE_PIECE = re.compile(f" ?[{LETTER}]+")


class Encoded:
    """Units of one chunk in order: their places in the document and the tokens before each."""

    def __init__(self, start: int, units: list[str], counts: list[int]):
        self.units, self.places, self.before = units, [start], [0]
        for u, n in zip(units, counts):
            self.places.append(self.places[-1] + len(u))
            self.before.append(self.before[-1] + n)
        self.start, self.end = start, self.places[-1]


class Counter:
    """Token counts of texts by one tokenizer of the tokenizers library (its JSON).

    A byte-level tokenizer without normaliser and post-processor reads pieces from left to right,
    and what follows a piece's start depends on nothing before it.  Two things follow.  A chunk's
    reading that once starts a piece where the whole text's reading does agrees with it from there
    on, up to what the chunk's end hides: a piece ending ``margin`` characters before the end is
    the whole text's.  And units between SURE places can be counted apart and remembered.  Other
    tokenizers encode every text whole.
    """

    def __init__(self, data: str, chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS,
                 cached_units: int = CACHED_UNITS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(data)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        config = json.loads(data)
        pre = config.get("pre_tokenizer") or {}
        special = [t["content"] for t in config.get("added_tokens", [])]
        self.local = (config.get("normalizer") is None and config.get("post_processor") is None
                      and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                      and not pre.get("add_prefix_space") and not any(SURE.search(s) for s in special)
                      and not any(t.get(k) for t in config.get("added_tokens", [])
                                  for k in ("lstrip", "rstrip", "single_word"))
                      and config["model"].get("type") == "BPE")
        self.plain = self.local and not any(ONE_PIECE.fullmatch(s) for s in special)
        self.margin = max([LOOKAHEAD, *map(len, special)]) + LOOKAHEAD
        self.chunk, self.overlap = max(chunk_chars, 2), max(overlap_chars, 1)
        self.cached, self.known = cached_units, {}
        signs = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in signs]
        self.shown = {b: chr(b) for b in signs} | {b: chr(256 + i) for i, b in enumerate(rest)}

    def library(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def unit_counts(self, units: list[str]) -> list[int]:
        """Tokens of each unit; new units are given to the library, letters alone to its model."""
        known = self.known
        new = [u for u in set(units) if u not in known]
        if len(known) + len(new) > self.cached:
            known.clear()
            new = list(set(units))
        mixed, tokenize = [], self.tokenizer.model.tokenize
        found = {}
        for u in new:
            if self.plain and ONE_PIECE.fullmatch(u):
                found[u] = len(tokenize(u.encode().decode("latin-1").translate(self.shown)))
            else:
                mixed.append(u)
        found.update(zip(mixed, self.library(mixed)))
        known.update((u, n) for u, n in found.items() if len(u) <= UNIT_CHARS)
        return [known[u] if u in known else found[u] for u in units]

    def encode(self, text: str, start: int, end: int) -> Encoded:
        units = SURE.split(text[start:end])
        return Encoded(start, units, self.unit_counts(units))

    def boundaries(self, e: Encoded, low: int, high: int) -> dict[int, int]:
        """Places in [low, high] where a piece of this chunk's reading starts, and the tokens
        before them, by the library's offsets of the units there."""
        found = {}
        first = max(bisect_left(e.places, low) - 1, 0)
        for i in range(first, len(e.units)):
            at = e.places[i]
            if at > high:
                break
            enc = self.tokenizer.encode(e.units[i], add_special_tokens=False)
            words, offsets = enc.word_ids, enc.offsets
            for k, w in enumerate(words):
                if k == 0 or w != words[k - 1]:
                    found[at + offsets[k][0]] = e.before[i] + k
        if e.end <= high:
            found[e.end] = e.before[-1]
        return {p: n for p, n in found.items() if low <= p <= high}

    def count(self, text: str) -> int:
        """Tokens of one text.

        Chunks overlap; two neighbours are spliced at the last place in their overlap where both
        start a piece and the left one is proven.  Without one the overlap is widened; once it
        reaches back to the left chunk's proven start, the right chunk starts there, is twice as
        long and replaces the left one.
        """
        if not self.local:
            return self.library([text])[0]
        n, total, proven, before = len(text), 0, 0, 0
        left = self.encode(text, 0, min(self.chunk, n))
        while left.end < n:
            overlap = self.overlap
            while True:
                start = max(left.end - overlap, proven)
                right = self.encode(text, start, min(start + max(self.chunk, 2 * overlap), n))
                if start == proven:
                    left, before = right, 0
                    break
                ours = self.boundaries(left, start, left.end - self.margin)
                theirs = self.boundaries(right, start, left.end - self.margin)
                common = ours.keys() & theirs.keys()
                if common:
                    place = max(common)
                    total += ours[place] - before
                    left, proven, before = right, place, theirs[place]
                    break
                overlap *= 4
        return total + left.before[-1] - before

    def counts(self, texts: list[str]) -> list[int]:
        return [self.count(t) for t in texts] if self.local else self.library(texts)


_COUNTERS: dict[tuple, Counter] = {}


def count_tokens(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 1024, chunk_chars: int = CHUNK_CHARS, overlap_chars: int = OVERLAP_CHARS,
                 cached_units: int = CACHED_UNITS, step_bytes: int = STEP_BYTES) -> DataFrame:
    """One row per input row: id, n_bytes (UTF-8), n_tokens, over_limit (more than ``limit``).

    ``tokenizer`` is the path of a tokenizers JSON, read on the driver and broadcast (its size is
    that of one vocabulary).  Texts are counted whole, without begin or end tokens, truncation or
    padding; strings of special tokens inside texts count as those tokens, the library's default.
    A text longer than ``chunk_chars`` is read in chunks, so a worker holds the encoding of one.
    ``cached_units`` and ``step_bytes`` bound a worker's memory and change no result.

    NULL text counts as empty: no bytes, no tokens.  Repeated rows and NULL ids stay as they are.
    """
    with open(tokenizer, encoding="utf-8") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def work(texts: list[str]) -> list:
        key = (hash(shared.value), chunk_chars, overlap_chars, cached_units)
        if key not in _COUNTERS:
            _COUNTERS.clear()
            _COUNTERS[key] = Counter(shared.value, chunk_chars, overlap_chars, cached_units)
        return [pa.array(_COUNTERS[key].counts(texts), pa.int64())]

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).alias("i"), text.alias("t"), F.octet_length(text).cast("bigint").alias("b"))
    out = map_texts(rows, "i", "t", "n long", work, step_bytes, carry=("b",))
    return out.select(F.col("i").alias(id_col), F.col("b").alias("n_bytes"), F.col("n").alias("n_tokens"),
                      (F.col("n") > limit).alias("over_limit"))
