"""Byte-level BPE encoding and decoding with DuckDB queries inside each Spark partition."""

from __future__ import annotations

import base64
import heapq
from array import array
from itertools import islice
from operator import itemgetter

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import map_texts, ranges

#: Pieces known to a worker; beyond it the older half is forgotten and encoded again if met.
CACHED_PIECES = 500_000
#: Intermediate rows of one query at most, and bytes of text in one step of a worker.
QUERY_ROWS = 3_000_000
STEP_BYTES = 4_000_000
#: A recursive query keeps every intermediate row, about half the square of a piece's bytes;
#: longer pieces than this are contracted with a heap instead, to the same ids.
LONG_PIECE = 96

#: Each round joins the words' adjacent tokens with the merge table, contracts every word's
#: leftmost pair of least rank, and drops the token that went into it.  Rows know the position
#: and token that follow them, so that no round has to sort.
ENCODE = """
WITH RECURSIVE step(round, word, pos, token, next_pos, next_token) AS (
  SELECT 0, word, pos, token, next_pos, next_token FROM start_rows
  UNION ALL
  (WITH pairs AS (
     SELECT s.word, s.pos, s.next_pos, m.rank * 4294967296 + s.pos AS rank_pos
     FROM step s JOIN merges m ON m.pair = s.token::BIGINT * 4294967296 + s.next_token),
   best AS (
     SELECT word, min(rank_pos) AS rank_pos, arg_min(next_pos, rank_pos) AS gone
     FROM pairs GROUP BY word),
   merge AS (
     SELECT b.word, (b.rank_pos & 4294967295)::INTEGER AS hit, (b.rank_pos >> 32)::INTEGER AS merged,
            b.gone, s.next_pos AS after_pos, s.next_token AS after_token
     FROM best b JOIN step s ON s.word = b.word AND s.pos = b.gone)
   SELECT s.round + 1, s.word, s.pos,
          CASE WHEN s.pos = hit THEN merged ELSE s.token END,
          CASE WHEN s.pos = hit THEN after_pos ELSE s.next_pos END,
          CASE WHEN s.pos = hit THEN after_token WHEN s.next_pos = hit THEN merged ELSE s.next_token END
   FROM step s JOIN merge USING (word) WHERE s.pos <> gone))
SELECT word, list(token ORDER BY pos) AS ids
FROM step JOIN (SELECT word, max(round) AS round FROM step GROUP BY word) USING (word, round)
GROUP BY word ORDER BY word
"""

DECODE = """
SELECT word, string_agg(hex, '' ORDER BY pos) AS hex
FROM ids JOIN vocabulary USING (token) GROUP BY word ORDER BY word
"""


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes and ranks of a vocabulary file: base64 token and rank on each line."""
    return {base64.b64decode(t): int(r) for t, r in map(bytes.split, data.splitlines()) if t}


class Codec:
    """Encodes pieces and decodes ids of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, cached_pieces: int = CACHED_PIECES,
                 query_rows: int = QUERY_ROWS):
        self.ranks, self.cached_pieces, self.query_rows = ranks, cached_pieces, query_rows
        self.split = regex.compile(pattern).findall
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        pair, rank = array("q"), array("q")
        for t, r in ranks.items():
            for i in range(1, len(t)):
                a, b = ranks.get(t[:i]), ranks.get(t[i:])
                if a is not None and b is not None:
                    pair.append(a << 32 | b)
                    rank.append(r)
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": "600MB"})
        # the queries below read the Arrow tables of these names
        pairs = pa.table({"pair": np.array(pair), "rank": np.array(rank)})  # noqa: F841
        tokens = pa.table({"token": np.fromiter(ranks.values(), np.int32),  # noqa: F841
                           "hex": [t.hex() for t in ranks]})
        self.con.execute("CREATE TABLE merges AS SELECT * FROM pairs")
        self.con.execute("CREATE TABLE vocabulary AS SELECT * FROM tokens")
        self.known: dict[str, tuple[bytes, bytes]] = {}

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Packed ids (little-endian unsigned 32-bit) of each piece; a piece that is a token
        keeps its rank, the others contract."""
        out = [b""] * len(pieces)
        todo = []
        for i, p in enumerate(pieces):
            if p in self.ranks:
                out[i] = pack([self.ranks[p]])
            elif len(p) > LONG_PIECE:
                out[i] = pack(contract(p, self.ranks))
            elif p:
                todo.append(i)
        todo.sort(key=lambda i: len(pieces[i]))
        for a, b in ranges([len(pieces[i]) ** 2 // 2 for i in todo], self.query_rows):
            block = todo[a:b]
            for i, ids in zip(block, self._contract_all([pieces[i] for i in block])):
                out[i] = ids
        return out

    def _contract_all(self, pieces: list[bytes]) -> list[bytes]:
        token = self.byte_ids[np.frombuffer(b"".join(pieces), np.uint8)]
        size = np.array([len(p) for p in pieces])
        word = np.repeat(np.arange(len(pieces), dtype=np.int32), size)
        pos = (np.arange(len(token)) - np.repeat(np.cumsum(size) - size, size)).astype(np.int32)
        last = np.append(word[1:] != word[:-1], True)
        start_rows = pa.table({"word": word, "pos": pos, "token": token,  # noqa: F841
                               "next_pos": pa.array(pos + 1, mask=last),
                               "next_token": pa.array(np.roll(token, -1), mask=last)})
        ids = self.con.sql(ENCODE).to_arrow_table()["ids"].combine_chunks()
        packed = ids.values.to_numpy().astype("<u4").tobytes()
        at = (ids.offsets.to_numpy() * 4).tolist()
        return [packed[a:b] for a, b in zip(at, at[1:])]

    def decode(self, sequences: list[bytes]) -> list[bytes]:
        """Bytes of each sequence of packed ids."""
        out = [b""] * len(sequences)
        for a, b in ranges([len(x) // 4 for x in sequences], self.query_rows):
            size = [len(x) // 4 for x in sequences[a:b]]
            flat = np.frombuffer(b"".join(sequences[a:b]), "<u4").astype(np.int32)
            ids = pa.table({"word": np.repeat(np.arange(a, b), size),  # noqa: F841
                            "pos": np.arange(len(flat)), "token": flat})
            found = self.con.sql(DECODE).to_arrow_table()
            for word, hexed in zip(found["word"].to_pylist(), found["hex"].to_pylist()):
                out[word] = bytes.fromhex(hexed)
        return out

    def both(self, texts: list[str]) -> list[tuple[bytes, bytes]]:
        """Packed ids and their decoded bytes, per text."""
        split = [self.split(t) for t in texts]
        met = set().union(*split)
        new = list(met - self.known.keys())
        if len(self.known) + len(new) > self.cached_pieces:
            keep = max(0, self.cached_pieces // 2 - len(new))
            self.known = dict(islice(self.known.items(), max(0, len(self.known) - keep), None))
            new = list(met - self.known.keys())
        ids = self.encode_pieces([p.encode() for p in new])
        self.known.update(zip(new, zip(ids, self.decode(ids))))
        out = []
        for pieces in split:
            found = list(map(self.known.__getitem__, pieces))
            out.append((b"".join(map(itemgetter(0), found)), b"".join(map(itemgetter(1), found))))
        return out


def pack(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()


def contract(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one piece: a heap of adjacent pairs by rank and position."""
    part: list[bytes | None] = [bytes([b]) for b in piece]
    after, before = list(range(1, len(part) + 1)), list(range(-1, len(part) - 1))

    def pair(i: int) -> tuple[int, int, bytes] | None:
        if i < 0 or after[i] >= len(part):
            return None
        joined = part[i] + part[after[i]]
        return (ranks[joined], i, joined) if joined in ranks else None

    heap = [x for x in map(pair, range(len(part))) if x]
    heapq.heapify(heap)
    while heap:
        _, i, joined = heapq.heappop(heap)
        j = after[i]
        if part[i] is None or j >= len(part) or part[i] + part[j] != joined:
            continue
        part[i], part[j] = joined, None
        after[i] = after[j]
        if after[i] < len(part):
            before[after[i]] = i
        for x in (pair(before[i]), pair(i)):
            if x:
                heapq.heappush(heap, x)
    return [ranks[p] for p in part if p is not None]


_CODECS: dict[int, Codec] = {}


def bpe_round_trip(docs: DataFrame, vocabulary: str, pattern: str, id_col: str = "doc_id",
                   text_col: str = "text", carry: tuple[str, ...] = (),
                   cached_pieces: int = CACHED_PIECES, query_rows: int = QUERY_ROWS,
                   step_bytes: int = STEP_BYTES) -> DataFrame:
    """One row per input row: id, the ``carry`` columns, n_tokens, ids (packed little-endian
    unsigned 32-bit) and decoded bytes.

    ``vocabulary`` is the path of a rank file, read on the driver and broadcast (its size is
    that of one vocabulary); ``pattern`` splits a text into pieces that are encoded alone.
    Each worker keeps the pieces that it has met, encodes new ones with one recursive DuckDB
    query and decodes their ids with an ordered aggregation.  ``cached_pieces``,
    ``query_rows`` and ``step_bytes`` bound a worker's memory: smaller ones cost time and change
    no result.  NULL text counts as empty, and
    an empty text has no tokens.
    """
    with open(vocabulary, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast((f.read(), pattern))

    def work(texts: list[str]) -> list:
        data, split = shared.value
        key = hash((data, split, cached_pieces, query_rows))
        if key not in _CODECS:
            _CODECS.clear()
            _CODECS[key] = Codec(read_ranks(data), split, cached_pieces, query_rows)
        found = _CODECS[key].both(texts)
        return [pa.array([len(ids) // 4 for ids, _ in found], pa.int64()),
                pa.array([ids for ids, _ in found], pa.binary()),
                pa.array([decoded for _, decoded in found], pa.binary())]

    return map_texts(docs, id_col, text_col, "n_tokens long, ids binary, decoded binary", work,
                     step_bytes, carry)
