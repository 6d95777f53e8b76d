"""MinHash near-duplicates: bands propose, packed b-bit signatures estimate, full sets decide."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_texts, written
from .components import connected_components

LANES = 16  # minima in one packed long
BITS = 4  # low bits kept of each
#: Shingles hashed at once, so that a very long text needs no more memory than another.
SHINGLES_AT_ONCE = 4_096
WORD_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                     0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB,
                     0x8EBC6AF09C88C6E3, 0x589965CC75374CC3], np.uint64)


@dataclass(frozen=True)
class NearParams:
    """At Jaccard 0.8, 32 bands of 6 rows miss a pair with probability 6e-5; the estimate from
    192 minima has a standard error of 0.03, and ``slack`` standard errors are allowed."""

    words: int = 5
    percent: int = 80
    bands: int = 32
    rows: int = 6
    slack: float = 4.0
    seed: int = 20_240_101

    @property
    def minima(self) -> int:
        return self.bands * self.rows

    @property
    def longs(self) -> int:
        return -(-self.minima // LANES)

    def most_mismatches(self) -> int:
        """Lanes that may differ in signatures worth an exact comparison.  Equal low bits of
        unequal minima (probability 2^-BITS) are part of the expected agreement."""
        chance = 2.0 ** -BITS
        agree = chance + (1 - chance) * self.percent / 100
        error = (agree * (1 - agree) / self.minima) ** 0.5
        return int(self.minima * (1 - agree + self.slack * error))


def shingles(text: str, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles: A-Z lower-cased, ASCII white space
    between words; fewer words than a shingle has form one, none form no shingle."""
    w = text.encode().lower().split()
    if not w:
        return np.zeros(0, np.uint64)
    if len(w) < words:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(w))], np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, w), np.uint64, len(w))
    n = len(w) - words + 1
    u = reduce(np.add, (h[i:i + n] * WORD_MIX[i] for i in range(words)))
    u ^= u >> np.uint64(31)
    u *= np.uint64(0x9FB21C651E98DF25)
    u ^= u >> np.uint64(29)
    return np.unique(u)


class Signer:
    """Minima of ``minima`` random linear hashes; bands of them, and their packed low bits."""

    def __init__(self, p: NearParams):
        rng = np.random.default_rng(p.seed)
        self.p = p
        self.a = rng.integers(0, 2**63, p.minima, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 2**64, p.minima, dtype=np.uint64)
        self.mix = rng.integers(0, 2**63, p.rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.band = rng.integers(0, 2**64, p.bands, dtype=np.uint64)
        self.shift = (np.arange(LANES, dtype=np.uint64) * np.uint64(BITS))

    def sign(self, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low = np.full(self.p.minima, ~np.uint64(0))
        for i in range(0, len(s), SHINGLES_AT_ONCE):
            h = s[i:i + SHINGLES_AT_ONCE, None] * self.a
            h += self.b
            np.minimum(low, h.min(axis=0), out=low)
        low >>= np.uint64(32)
        keys = (low.reshape(self.p.bands, self.p.rows) * self.mix).sum(axis=1) + self.band
        keys ^= keys >> np.uint64(32)
        keys *= np.uint64(0x9FB21C651E98DF25)
        lanes = np.zeros(self.p.longs * LANES, np.uint64)
        lanes[:self.p.minima] = low & np.uint64(2**BITS - 1)
        packed = (lanes.reshape(-1, LANES) << self.shift).sum(axis=1)
        return keys.view(np.int64), packed.view(np.int64)


def signatures(docs: DataFrame, p: NearParams, id_col: str, text_col: str) -> DataFrame:
    """id, number of shingles, 128-bit key of the set, band keys and packed minima per row."""
    signer = Signer(p)

    def work(texts: list[str]) -> list:
        size, key, bands, packed = [], [], [], []
        for t in texts:
            s = shingles(t, p.words)
            size.append(len(s))
            key.append(xxhash.xxh3_128_digest(s.tobytes()))
            k, m = signer.sign(s) if len(s) else (None, None)
            bands.append(k)
            packed.append(m)
        return [pa.array(size, pa.int64()), pa.array(key, pa.binary()),
                pa.array(bands, pa.list_(pa.int64())), pa.array(packed, pa.list_(pa.int64()))]

    return map_texts(docs, id_col, text_col,
                     "n_shingles long, set_key binary, bands array<bigint>, packed array<bigint>",
                     work, 2_000_000)


def _mismatches(a: str, b: str, longs: int) -> Column:
    """Lanes that differ between two packed signatures."""
    def lanes(i: int) -> Column:
        x = F.col(f"{a}.m{i}").bitwiseXOR(F.col(f"{b}.m{i}"))
        any_bit = reduce(lambda y, n: y.bitwiseOR(F.shiftrightunsigned(x, n)), range(1, BITS), x)
        return F.bit_count(any_bit.bitwiseAND(F.lit(0x1111111111111111)))
    return reduce(lambda x, y: x + y, map(lanes, range(longs)))


def _sets(docs: DataFrame, ids: DataFrame, p: NearParams) -> DataFrame:
    """(_id, hashes): the packed shingle sets of the documents that ``ids`` names."""
    return map_texts(docs.join(ids, docs["_id"] == ids["id"], "left_semi"), "_id", "_text",
                     "hashes array<bigint>",
                     lambda texts: [pa.array([shingles(t, p.words).view(np.int64) for t in texts],
                                             pa.list_(pa.int64()))], 2_000_000)


def _rare_first(docs: DataFrame, ids: DataFrame, p: NearParams) -> DataFrame:
    """(id, n, pos, h): the rarest shingles of each document that ``ids`` names, rarest first.

    Documents with ``percent`` similarity share a shingle among as many of each one's rarest
    as could miss from the other; the order is the same for all (frequency, then hash).
    """
    ids = written(ids.distinct(), "ids")
    sets = _sets(docs, ids, p).select(F.col("_id").alias("id"), F.xxhash64("hashes").alias("s"),
                                      F.size("hashes").alias("n"), "hashes")
    held = written(sets.dropDuplicates(["id", "s"]).select("id", "s", "n", F.explode("hashes").alias("h")), "held")
    often = held.groupBy("h").agg(F.count(F.lit(1)).alias("often")).select(F.struct("h").alias("_k"), "often")
    ranked = (held.withColumn("_k", F.struct("h")).join(often, "_k").groupBy("id", "s", "n")
              .agg(F.array_sort(F.collect_list(F.struct("often", "h"))).alias("all")))
    missing = F.col("n") - F.ceil(F.col("n") * p.percent / 100)
    return ranked.select("id", "n", F.posexplode(F.slice("all", F.lit(1), (missing + 1).cast("int"))).alias("pos", "x")
                         ).select("id", "n", "pos", "x.h")


def _linked(pairs: DataFrame, docs: DataFrame, p: NearParams) -> DataFrame:
    """The pairs (u, v) whose full shingle sets are at least ``percent`` similar."""
    pairs = written(pairs.select("u", "v").distinct(), "pairs")
    ids = written(pairs.select(F.col("u").alias("id")).union(pairs.select("v")).distinct(), "ids")
    sets = written(_sets(docs, ids, p), "sets")
    left = sets.select(F.col("_id").alias("u"), F.col("hashes").alias("hu"))
    right = sets.select(F.col("_id").alias("v"), F.col("hashes").alias("hv"))

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for hu, hv in zip(b.column("hu"), b.column("hv")):
                known, other = (h.values.to_numpy().view(np.uint64) for h in (hu, hv))
                small, large = sorted((known, other), key=len)
                at = np.searchsorted(large, small)
                common = int((large[np.minimum(at, len(large) - 1)] == small).sum())
                keep.append(100 * common >= p.percent * (len(known) + len(other) - common))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([b.column("u").filter(mask),
                                              b.column("v").filter(mask)], ["u", "v"])

    kind = dict(pairs.dtypes)["u"]
    return pairs.join(right, "v").join(left, "u").mapInArrow(decide, f"u {kind}, v {kind}")


def near_duplicates(docs: DataFrame, p: NearParams = NearParams(), id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_shingles, component_id, kept.

    Rows with equal sets collapse first.  Then the members of each band bucket meet one of
    them: the one with the smallest id, and after that one drawn per bucket; of those, each
    member takes the one that its packed signature agrees with best.  Pairs whose signatures
    agree enough are compared on full sets, and links join components.  A
    bucket whose members form one component is done; in the others, every member outside the
    bucket's commonest component meets the members of other components that share one of its rarest
    shingles, as every link needs.  So no pair of a bucket that could still join two
    components goes untested, and none within a component is formed again.

    The id is the document: rows that repeat it with other texts share a component.  Texts
    without words have no shingles and stay alone.  Rows with a NULL id are alone, too, with
    NULL as component_id, and kept.
    """
    docs = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    rows = written(signatures(docs, p, "_id", "_text").withColumnRenamed("_id", "id"), "signatures")
    least = (rows.filter("id IS NOT NULL AND n_shingles > 0")
             .groupBy("set_key").agg(F.min("id").alias("id")))
    longs = [F.element_at("packed", i + 1).alias(f"m{i}") for i in range(p.longs)]
    nodes = written(rows.join(least, ["set_key", "id"], "left_semi")
                    .select("id", "n_shingles", "bands", *longs).distinct(), "nodes")

    def buckets(components: DataFrame | None) -> DataFrame:
        """(key, id, component) of every member."""
        member = nodes.select("id", F.explode("bands").alias("key"))
        if components is None:
            return member.withColumn("component", F.col("id"))
        own = nodes.select("id", "bands").join(components, "id", "left")
        return own.select("id", F.coalesce("component", "id").alias("component"),
                          F.explode("bands").alias("key"))

    signed = nodes.drop("bands")
    mismatches = _mismatches("a", "b", p.longs)
    similar = ((mismatches <= p.most_mismatches())
               & (F.least("a.n_shingles", "b.n_shingles") * 100
                  >= F.greatest("a.n_shingles", "b.n_shingles") * p.percent))

    def mixed(members: DataFrame, *aggs: Column) -> DataFrame:
        """Buckets of more than one component, with a key that lets AQE split hot buckets."""
        found = members.groupBy("key").agg(F.min("component").alias("lo"),
                                           F.max("component").alias("hi"), *aggs)
        return found.filter("lo <> hi").select(F.struct("key").alias("_k"), *found.columns[3:])

    def agreeing(pairs: DataFrame) -> DataFrame:
        """The pairs (u, v) whose sizes and signatures allow a link, with their mismatches."""
        return (pairs.join(signed.alias("a"), F.col("u") == F.col("a.id"))
                .select("u", "v", F.struct("a.*").alias("a"))
                .join(signed.alias("b"), F.col("v") == F.col("b.id")).filter(similar)
                .select("u", "v", mismatches.alias("mismatches")))

    def star(components: DataFrame | None, centre: Column) -> DataFrame:
        members = buckets(components)
        centres = mixed(members, centre.alias("c"))
        pairs = (members.withColumn("_k", F.struct("key")).join(centres, "_k")
                 .filter(F.col("component") != F.col("c.component"))
                 .select(F.col("c.id").alias("u"), F.col("id").alias("v")).distinct())
        return agreeing(pairs).groupBy("v").agg(F.min_by("u", "mismatches").alias("u"))

    def strays(components: DataFrame) -> DataFrame:
        members = buckets(components)
        open_keys = mixed(members, F.lit(True).alias("open"))
        members = written(members.withColumn("_k", F.struct("key")).join(open_keys, "_k")
                          .select("key", "id", "component"), "members")
        commonest = (members.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
                     .groupBy("key").agg(F.max(F.struct("n", "component")).alias("top"))
                     .select(F.struct("key").alias("_k"), F.col("top.component").alias("main")))
        ids = (members.withColumn("_k", F.struct("key")).join(commonest, "_k")
               .groupBy("id", "component").agg(F.max(F.col("component") != F.col("main")).alias("stray")))
        rare = written(_rare_first(docs, members.select("id"), p).join(ids, "id"), "rare")
        a, b = rare.filter("stray").alias("a"), rare.alias("b")
        both = F.col("a.n") + F.col("b.n")
        common = F.ceil(both * p.percent / (100 + p.percent))  # that a link needs at least
        # of two strays the smaller id leads; others always come second
        once = ~F.col("b.stray") | (F.col("a.id") < F.col("b.id"))
        pairs = (a.join(b, (F.col("a.h") == F.col("b.h"))
                        & (F.col("a.component") != F.col("b.component")) & once
                        & (F.col("a.pos") <= F.col("a.n") - common) & (F.col("b.pos") <= F.col("b.n") - common))
                 .select(F.col("a.id").alias("u"), F.col("b.id").alias("v")).distinct())
        return agreeing(pairs)

    drawn = F.min(F.struct(F.xxhash64("id", "key").alias("draw"), "id", "component"))
    links = _linked(star(None, F.min(F.struct("id", "component"))), docs, p)
    components = connected_components(links)
    for pairs in (lambda c: star(c, drawn), strays):
        links = _linked(pairs(components), docs, p)
        known = components.select(F.col("id").alias("u"), F.col("component").alias("v"))
        components = connected_components(links.unionByName(known))

    of_set = (least.join(components, "id", "left")
              .select(F.struct("set_key").alias("_k"),
                      F.coalesce("component", "id").alias("component")))
    out = rows.withColumn("_k", F.struct("set_key")).join(of_set, "_k", "left")
    component = F.when(F.col("n_shingles") == 0, F.col("id")).when(F.col("id").isNotNull(),
                                                                   F.col("component"))
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"),
                      (F.col("id").isNull() | (F.col("id") == component)).alias("kept"))
