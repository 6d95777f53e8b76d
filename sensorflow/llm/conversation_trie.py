"""Prefix trie of conversations as balanced parentheses, one sequence of them per shard of the
sorted paths."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

#: Bytes of a turn in a path: the MD5 digest of its role and text.
DIGEST = 16
WORD = r"[^\x20\x09-\x0D]+"
#: Conversations of one family share the first turns of the member whose id FAMILY divides.
FAMILY = 20
#: Parentheses opened in a shard, and bytes of listed ids in one row of copies.
SHARD_NODES = 200_000
LIST_BYTES = 65_536
#: Parentheses of a block of the range min-max tree.
BLOCK = 64
NOTHING = hashlib.sha256(b"").hexdigest()
#: Kinds of rows that a shard leaves: whole nodes, nodes that were open at its start, and nodes
#: opened in it that are open at its end.
WHOLE, ENTERED, LEFT_OPEN = 0, 1, 2
SHARD_FIELDS = ("shard long, kind int, depth long, conv long, n_convs long, n_children long, n_leaves long, "
                "saved long, words long, closed boolean, up int, parent long, ends string")


def shared_turns(conv: Column) -> Column:
    """How many turns a conversation takes from its family: unsigned crc32 of the decimal id, modulo 4."""
    return (F.crc32(conv.cast("string").cast("binary")) % 4).cast("int")


def rebuilt(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """(conv, path, words): each conversation's rebuilt turns as one binary of DIGEST bytes a turn,
    and the words of each turn.

    A rebuilt conversation is the first h turns of the one whose id is its own minus the
    remainder by FAMILY (fewer where it has fewer, none where there is none), then its own turns
    after the first h.  Only digests and word counts are gathered by conversation, 20 bytes a turn.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in (role_col, text_col))
    content = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")
    turns = conversations.filter(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("bigint").alias("conv"),
        F.struct(F.col(turn_col).alias("t"), F.unhex(F.md5(content)).alias("d"),
                 F.regexp_count(text, F.lit(WORD)).alias("w")).alias("turn"))
    own = turns.groupBy("conv").agg(F.transform(
        F.sort_array(F.collect_list("turn")), lambda x: F.struct(x["d"].alias("d"), x["w"].alias("w"))).alias("turns"))
    own = written(own, "own")
    heads = own.filter(F.col("conv") % FAMILY == 0).select(
        F.col("conv").alias("family"), F.slice("turns", 1, 3).alias("head"))
    h = shared_turns(F.col("conv"))
    whole = F.concat(F.slice(F.coalesce("head", F.array().cast("array<struct<d:binary,w:int>>")), F.lit(1), h),
                     F.slice("turns", h + 1, F.size("turns")))
    return (own.join(heads, F.col("conv") - F.col("conv") % FAMILY == F.col("family"), "left")
            .select("conv", whole.alias("turns"))
            .select("conv", F.unhex(F.array_join(F.transform("turns", lambda x: F.hex(x["d"])), "")).alias("path"),
                    F.transform("turns", lambda x: x["w"]).alias("words")))


def copies(found: DataFrame, list_bytes: int) -> DataFrame:
    """(part, rank, path, words, conv, n, ids): equal paths side by side in one range of the sorted
    rows become one row with their ids in order, or several where the list is long.

    Rows are dealt by path and id, so a group of copies spreads over ranges.  ``part`` numbers the
    ranges in order, ``rank`` the distinct paths of a range.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rank, path, words, ids, size, rows = TaskContext.get().partitionId(), -1, None, None, [], 0, []

        def close() -> None:
            rows.append((part, rank, path, words, int(ids[0]), len(ids), ",".join(ids)))

        def flush() -> pa.RecordBatch:
            cols = list(zip(*rows))
            rows.clear()
            kinds = [pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int32()), pa.int64(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                              ["part", "rank", "path", "words", "conv", "n", "ids"])

        for batch in batches:
            for p, c, w in zip(batch.column("path"), batch.column("conv").to_pylist(), batch.column("words")):
                p = p.as_py()
                if p != path or size >= list_bytes:
                    if ids:
                        close()
                    if p != path:
                        rank, path, words = rank + 1, p, w.as_py()
                    ids, size = [], 0
                ids.append(str(c))
                size += len(ids[-1]) + 1
            if rows:
                yield flush()
        if ids:
            close()
        if rows:
            yield flush()

    dealt = found.repartitionByRange("path", "conv").sortWithinPartitions("path", "conv")
    return dealt.select("path", "conv", "words").mapInArrow(
        run, "part long, rank long, path binary, words array<int>, conv long, n long, ids string")


def joined(rows: DataFrame) -> DataFrame:
    """The rows of ``copies`` with every path in one part, that of its first row, and beside them each
    part's neighbours: the last path before it (kind 0) and the first one after it (kind 2).

    What is compared across parts is a row of three paths for each part.
    """
    at = F.col("rank")
    ends = written(rows.groupBy("part").agg(F.min(F.when(at == 0, F.col("path"))).alias("first"),
                                            F.min(F.when(at == 1, F.col("path"))).alias("second"),
                                            F.max("path").alias("last")), "ends")
    owner = (ends.select("part", F.explode(F.array("first", "last")).alias("first"))
             .groupBy("first").agg(F.min("part").alias("owner")))
    ends = written(ends.join(owner, "first"), "owners")
    order = Window.orderBy("part")
    start = F.when(F.col("owner") < F.col("part"), F.col("second")).otherwise(F.col("first"))
    alive = ends.select("part", start.alias("start"), "last").filter("start IS NOT NULL").select(
        "part", F.lag("last").over(order).alias("before"), F.lead("start").over(order).alias("after"))
    marks = alive.select("part", F.explode(F.array(
        F.struct(F.lit(0).alias("kind"), F.col("before").alias("path")),
        F.struct(F.lit(2).alias("kind"), F.col("after").alias("path")))).alias("m"))
    marks = marks.select("part", "m.kind", "m.path").filter("path IS NOT NULL")
    moved = rows.join(ends.select("part", "first", "owner"), "part").select(
        F.when(F.col("path") == F.col("first"), F.col("owner")).otherwise(F.col("part")).alias("part"),
        F.lit(1).alias("kind"), "path", "words", "conv", "n", "ids")
    return moved.unionByName(marks, allowMissingColumns=True)


class Parentheses:
    """Balanced parentheses of one shard: an opening one for each node where the sorted paths first
    reach it, a closing one where they leave it.

    ``excess`` counts the open nodes after each place; a node of depth d leaves an excess of d + 1
    at its opening and d at its closing.  Blocks keep their least excess, and pairs of blocks the
    lesser of two, level by level, so a search passes over what it can't end in.
    """

    def __init__(self, opening: np.ndarray, before: int):
        self.size = len(opening)
        self.opening = opening
        self.excess = before + np.cumsum(np.where(opening, 1, -1), dtype=np.int64)
        padded = np.full(-(-max(self.size, 1) // BLOCK) * BLOCK, np.iinfo(np.int64).max)
        padded[:self.size] = self.excess
        self.blocks = padded.reshape(-1, BLOCK)
        self.least = [self.blocks.min(axis=1)]
        while len(self.least[-1]) > 1:
            low = self.least[-1]
            low = np.append(low, np.iinfo(np.int64).max) if len(low) % 2 else low
            self.least.append(low.reshape(-1, 2).min(axis=1))
        self.opened = np.concatenate([[0], np.cumsum(opening)])  # rank of opening ones before a place
        pairs = opening.copy()
        pairs[:-1] &= ~opening[1:]
        pairs[-1:] = False
        self.leaves = np.concatenate([[0], np.cumsum(pairs)])  # rank of pairs () before a place

    def first_at_most(self, start: np.ndarray, target: np.ndarray) -> np.ndarray:
        """First place from ``start`` on with an excess of ``target`` or less; the size if there is none."""
        out = np.empty(len(start), np.int64)
        for a in range(0, len(start), 8_192):
            out[a:a + 8_192] = self._search(start[a:a + 8_192], target[a:a + 8_192])
        return out

    def _search(self, start: np.ndarray, target: np.ndarray) -> np.ndarray:
        out = np.full(len(start), self.size, np.int64)
        inside = np.flatnonzero(start < self.size)
        block = start[inside] // BLOCK
        fits = (self.blocks[block] <= target[inside, None]) & (np.arange(BLOCK) >= (start[inside] % BLOCK)[:, None])
        hit = fits.any(axis=1)
        out[inside[hit]] = block[hit] * BLOCK + fits[hit].argmax(axis=1)
        # up: the next block to the right, or pair of blocks, that goes low enough; then down to its first
        left, node, goal = inside[~hit], block[~hit], target[inside[~hit]]
        found = np.full(len(left), -1)
        level = np.zeros(len(left), np.int64)
        for k, low in enumerate(self.least[:-1]):
            right = node + 1
            fits = (found < 0) & (node % 2 == 0) & (right < len(low))
            fits[fits] = low[right[fits]] <= goal[fits]
            found[fits], level[fits] = right[fits], k
            node = node // 2
        for k in range(len(self.least) - 1, 0, -1):
            go = (found >= 0) & (level == k)
            child = found[go] * 2
            child += self.least[k - 1][child] > goal[go]
            found[go], level[go] = child, k - 1
        ends = np.flatnonzero(found >= 0)
        fits = self.blocks[found[ends]] <= goal[ends, None]
        out[left[ends]] = found[ends] * BLOCK + fits.argmax(axis=1)
        return out

    def closing(self, places: np.ndarray) -> np.ndarray:
        """The closing parenthesis of each opening one; the size where it is not in this shard."""
        return self.first_at_most(places + 1, self.excess[places] - 1)


def range_minima(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Least value of each nonempty range [start, end)."""
    tables = [values]
    while 2 << (len(tables) - 1) <= len(values):
        half, low = 1 << (len(tables) - 1), tables[-1]
        tables.append(np.minimum(low[:-half], low[half:]))
    power = np.frexp((end - start).astype(float))[1] - 1  # exponent of the largest power of two within
    out = np.empty(len(start), values.dtype)
    for k, low in enumerate(tables):
        at = np.flatnonzero(power == k)
        out[at] = np.minimum(low[start[at]], low[end[at] - (1 << k)])
    return out


def shard_rows(shard: int, paths: list[tuple], after: int) -> pa.RecordBatch:
    """What a shard knows of its nodes.

    ``paths``: per distinct path in order the turns shared with the path before (-1: none before), all its
    turns, the words of the turns not shared, its copies, their least id and their list's digest.
    ``after``: turns that the last one shares with the next shard's first, -1 without one.
    """
    shared, length = (np.array([p[k] for p in paths], np.int64) for k in (0, 1))
    opens = length - shared
    closes = np.append(np.concatenate([[shared[0]], length[:-1]]) - shared, length[-1] - after)
    runs = np.empty(2 * len(paths) + 1, np.int64)
    runs[0::2], runs[1::2] = closes, opens
    before = int(shared[0]) + 1
    tree = Parentheses(np.repeat(np.arange(len(runs)) % 2 == 1, runs), before)

    places = np.flatnonzero(tree.opening)
    m, depth = len(places), tree.excess[places] - 1
    close = tree.closing(places)
    closed = close < tree.size
    index, until = np.arange(m), tree.opened[close]
    last = np.cumsum(opens) - 1  # the node at which each path ends
    count, least = np.zeros(m, np.int64), np.full(m, np.iinfo(np.int64).max)
    count[last], least[last] = [p[3] for p in paths], [p[4] for p in paths]
    ends: list[str | None] = [None] * m
    for j, p in zip(last.tolist(), paths):
        ends[j] = p[5]
    words = np.concatenate([np.array(([0] if p[0] < 0 else []) + list(p[2]), np.int64) for p in paths])

    def upto(v: np.ndarray) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(v)])

    convs = upto(count)
    n_convs = convs[until] - convs[index]
    conv = range_minima(least, index, until)
    saved = upto(np.where(closed, (n_convs - 1) * words, 0))
    parent = np.empty(m, np.int64)  # a node here, or -2 - depth of one open before; -1: the root's
    parent[1:] = index[:-1]
    stack = [-2 - d for d in range(before)]
    for j, s, n in zip((last + 1 - opens).tolist(), shared.tolist(), opens.tolist()):
        del stack[s + 1:]
        parent[j] = stack[s] if s >= 0 else -1
        stack.extend(range(j, j + n))
    children = np.bincount(parent[parent >= 0], minlength=m)
    outer = np.bincount(-2 - parent[parent < -1], minlength=before)

    entered = np.arange(before)
    leave = tree.first_at_most(np.zeros(before, np.int64), entered)
    until_in = tree.opened[leave]
    known = (parent >= 0) & closed[np.maximum(parent, 0)]
    up = np.where(known | (parent == -1), WHOLE, np.where(parent >= 0, LEFT_OPEN, ENTERED))
    conv_in = np.minimum.accumulate(np.append(np.iinfo(np.int64).max, least))[until_in]

    def column(own, inner, kind=pa.int64(), mask=None):
        return pa.array(np.concatenate([own, inner]), kind, mask=mask)

    none = np.zeros(before, np.int64)
    return pa.RecordBatch.from_arrays([
        pa.array(np.full(m + before, shard), pa.int64()),
        column(np.where(closed, WHOLE, LEFT_OPEN), none + ENTERED, pa.int32()), column(depth, entered),
        column(conv, conv_in), column(n_convs, convs[until_in]), column(children, outer),
        column(tree.leaves[close] - tree.leaves[places], tree.leaves[leave]),
        column(saved[until] - saved[index], saved[until_in]), column(words, none),
        column(closed, leave < tree.size, pa.bool_()), column(up, none, pa.int32()),
        column(conv[np.maximum(parent, 0)], none, mask=np.concatenate([~known, none == 0])),
        pa.array(ends + [None] * before, pa.string())],
        [f.split()[0] for f in SHARD_FIELDS.split(", ")])


def shared_prefix(a: bytes | None, b: bytes) -> int:
    """Turns that two paths share; -1 without a first one."""
    if a is None:
        return -1
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return (n - (differ.bit_length() + 7) // 8) // DIGEST


def shards(rows: DataFrame, shard_nodes: int) -> DataFrame:
    """``shard_rows`` of each part; parts of more than ``shard_nodes`` nodes are several shards."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, path, paths, nodes, listed = None, 0, None, [], 0, None

        def finish() -> None:
            if paths and len(paths[-1]) < 6:
                paths[-1] = (*paths[-1], listed.hexdigest())

        def whole(after: int) -> pa.RecordBatch:
            out = shard_rows((part << 32) + number, paths, after)
            paths.clear()
            return out

        for batch in batches:
            for r in batch.to_pylist():
                if r["part"] != part:
                    finish()
                    if paths:
                        yield whole(-1)
                    part, number, path, nodes = r["part"], 0, None, 0
                if r["kind"] == 0:
                    path = r["path"]
                elif r["kind"] == 2:
                    finish()
                    yield whole(shared_prefix(path, r["path"]))
                elif paths and r["path"] == path:
                    listed.update(b"," + r["ids"].encode())
                    shared, length, words, n, conv = paths[-1]
                    paths[-1] = (shared, length, words, n + r["n"], min(conv, r["conv"]))
                else:
                    finish()
                    shared, length = shared_prefix(path, r["path"]), len(r["path"]) // DIGEST
                    if nodes >= shard_nodes:
                        yield whole(shared)
                        number, nodes = number + 1, 0
                    path = r["path"]
                    paths.append((shared, length, r["words"][max(shared, 0):], r["n"], r["conv"]))
                    listed = hashlib.sha256(r["ids"].encode())
                    nodes += length - shared
        finish()
        if paths:
            yield whole(-1)

    dealt = rows.repartition("part").sortWithinPartitions("part", "kind", "path", "conv")
    return dealt.mapInArrow(run, SHARD_FIELDS)


def spines(open_rows: DataFrame) -> DataFrame:
    """Nodes that reach over shard borders, summed: each shard's row of such a node with the whole node's
    figures.

    At most one node of a depth is open at a border, so by depth and in order of the shards a row
    that a shard has left open starts a node, and the rows after it, of shards that it entered, belong to
    it until the next such row.  A depth has at most two rows a shard.  What the nodes of a spine
    save themselves is known only now; it is added to the nodes above: for the node's own shard by
    a sum from the deepest on, for shards that a node passes through whole.
    """
    opened = F.col("kind") == LEFT_OPEN
    rows = open_rows.withColumn("g", F.sum(F.when(opened, 1).otherwise(0)).over(
        Window.partitionBy("depth").orderBy("shard", "kind").rowsBetween(Window.unboundedPreceding, 0)))
    node = Window.partitionBy("depth", "g")
    rows = rows.withColumns({c: F.sum(c).over(node) for c in ("n_convs", "n_children", "n_leaves")}
                            | {"conv": F.min("conv").over(node)})
    rows = rows.withColumn("own", F.when(opened, (F.col("n_convs") - 1) * F.col("words")).otherwise(F.lit(0)))
    below = Window.partitionBy("shard").orderBy(F.desc("depth"))
    extra = F.when(opened, F.sum("own").over(below)).when(F.col("closed"), 0).otherwise(
        F.sum("own").over(Window.partitionBy("shard")))
    return rows.withColumn("extra", extra).withColumn("saved", F.sum(F.col("saved") + F.col("extra")).over(node))


def conversation_trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                      role_col: str = "role", text_col: str = "text", shard_nodes: int = SHARD_NODES,
                      list_bytes: int = LIST_BYTES) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: conv_id (least member), depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Paths of turn digests are sorted by ranges; copies become one path with a list of ids.  Each
    shard writes its part of the trie as parentheses: the closing one delimits a subtree, ranks of
    opening ones and of leaf pairs count its nodes, members and leaves, and a cumulative array
    gives its savings.  Nodes on the border of two shards, its shared spine, are summed afterwards.

    NULL roles and texts count as empty; NULL turns come first; rows of equal turn are in order of
    their digests.  Rows without conversation id belong to none.  An empty table has no nodes, not
    even a root.  A conversation is one record of 20 bytes a turn.
    """
    paths = written(rebuilt(conversations, conv_col, turn_col, role_col, text_col), "paths")
    rows = written(copies(paths, list_bytes), "copies")
    parts = written(shards(joined(rows), shard_nodes), "shards")
    border = written(spines(parts.filter(F.col("kind") != WHOLE)), "spines")
    columns = ["shard", "depth", "conv", "n_convs", "n_children", "n_leaves", "saved", "up", "parent", "ends"]
    nodes = parts.filter(F.col("kind") == WHOLE).select(columns).unionByName(
        border.filter(F.col("kind") == LEFT_OPEN).select(columns))
    above = border.select("shard", F.col("kind").alias("up"), (F.col("depth") + 1).alias("depth"),
                          F.col("conv").alias("found"))
    nodes = nodes.filter(F.col("up") == WHOLE).unionByName(
        nodes.filter(F.col("up") != WHOLE).join(above, ["shard", "up", "depth"])
        .withColumn("parent", F.col("found")).select(columns))
    return nodes.select(F.col("conv").alias(conv_col), "depth", F.col("parent").alias(f"parent_{conv_col}"), "n_convs",
                        "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
                        F.coalesce("ends", F.lit(NOTHING)).alias("ends_sha256"))
