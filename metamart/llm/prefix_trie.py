"""Trie of conversation prefixes in balanced parentheses, a shard at a time (op11).

1. ``turns``: every turn becomes a 16-byte code of (role, text) and a length in code
   points; texts go no further.  A conversation is the array of its codes.
2. ``rebuilt``: the first turns of a conversation come from the first one of its
   hundred.
3. Conversations are sorted by (codes, conv_id) over range partitions and cut into
   shard rows of at most ``SHARD_CODES`` codes.  Neighbours in this order share
   paths, so a shard's subtrie is its own but for the spines: the path of its first
   conversation, and the part of its last one's path that the next shard goes on
   with.  A shard row knows the first conversation of the next one.
4. Inside a shard (``Shard``) the trie is a sequence of parentheses in preorder.
   Minima of the excess over blocks of parentheses and a binary tree above them
   (range min-max) lead ``findclose`` to the end of every subtree; the rank of leaf
   pairs ``()`` before both ends gives its leaves, and cumulative arrays over the
   nodes its saving.  Nodes off the spines are final.
5. Spine nodes leave one partial row per shard, keyed by a digest of their path,
   and are merged by sums and minima.  A node counts as a child, as a leaf and with
   its own length in the shard in which it closes; the paths still open at a
   shard's end do not close there.
6. Members that end at a node are consecutive in the order, so a node off the
   spines has them in one shard.  The lists of a spine node are hashed one after
   the other in a stream, a shard's list at a time.

Hot prefixes and large groups of equal conversations are cut like anything else:
the order goes on with conv_id, and a group that spans shards is a spine.  A
conversation is held as one row of codes, 20 bytes a turn.

Defined results.  Null conv_ids are dropped; null role or text is empty.  Turns
are ordered by turn (null first); equal turn numbers are ordered by the code of
role and text, and every row is a turn, repeated rows included.  An empty table
has no nodes.  Extra columns are ignored.  Paths are told apart by the first 16
bytes of SHA-256 digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metamart.llm.common import materialize

GROUP = 100                  # conversations that share the first one's turns
SHARED = 6                   # fewer than so many turns are shared
CODE = 16
SHARD_CODES = 100_000        # codes a shard row, a longer conversation alone
PART_CODES = 2_000_000       # codes a range partition, about
BLOCK = 64                   # parentheses a block
EMPTY = hashlib.sha256(b"").hexdigest()

NODES = (
    "conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved_tokens bigint, ends_sha256 string"
)
LOCAL = (
    "shard bigint, node int, parent int, key binary, parent_key binary, conv_id bigint, depth bigint, parent_conv_id bigint, "
    "n_convs bigint, n_children bigint, n_leaves bigint, weight bigint, length bigint, ends_sha256 string, ends string"
)


# ------------------------------------------------------------ conversations
def turn_code() -> Column:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    named = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.substring(F.unhex(F.sha2(named.cast("binary"), 256)), 1, CODE)


def conversations(turns: DataFrame) -> DataFrame:
    """conv_id, its turns as an array of (code, len) in their order."""
    rows = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.struct(
            F.col("turn").alias("turn"), turn_code().alias("code"),
            F.length(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("len")).alias("t"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t")).select(
        "conv_id", F.transform("t", lambda t: F.struct(t["code"].alias("code"), t["len"].alias("len"))).alias("t"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """conv_id, codes binary (CODE bytes a turn), lens array<int> of every rebuilt conversation."""
    own = materialize(conversations(turns), "conversations")
    first = own.where(F.col("conv_id") % GROUP == 0).select(
        F.col("conv_id").alias("base"), F.slice("t", 1, SHARED - 1).alias("shared"))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(SHARED)).cast("int")
    both = own.withColumn("base", F.col("conv_id") - F.col("conv_id") % GROUP).join(first, "base", "left").withColumn("h", h)
    none = F.slice("t", 1, 0)
    whole = F.concat(F.slice(F.coalesce("shared", none), F.lit(1), F.col("h")), F.slice("t", F.col("h") + 1, F.size("t")))
    return both.select("conv_id", whole.alias("t")).select(
        "conv_id", F.unhex(F.array_join(F.transform("t", lambda t: F.hex(t["code"])), "")).alias("codes"),
        F.transform("t", lambda t: t["len"]).alias("lens"))


# ------------------------------------------------------------------- shards
def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cut a sorted partition into shard rows; each but the last knows the codes that follow."""
    waiting: dict | None = None
    rows: list[tuple] = []
    codes = at = 0

    def done() -> dict:
        return {"part": part, "at": at, "conv_ids": [r[1] for r in rows], "codes": [r[2] for r in rows], "lens": [r[3] for r in rows]}

    def out(shard: dict, following: bytes | None) -> pa.RecordBatch:
        shard |= {"first": shard["codes"][0], "following": following}
        return pa.RecordBatch.from_pylist([shard], _SHARD_SCHEMA)

    for b in batches:
        for row in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
            part = row[0]
            if rows and codes + len(row[3]) + 1 > SHARD_CODES:
                if waiting:
                    yield out(waiting, rows[0][2])
                waiting, rows, codes = done(), [], 0
                at += 1
            rows.append(row)
            codes += len(row[3]) + 1
    if rows:
        if waiting:
            yield out(waiting, rows[0][2])
        yield out(done(), None)


_SHARD_SCHEMA = pa.schema([
    ("part", pa.int32()), ("at", pa.int32()), ("conv_ids", pa.list_(pa.int64())), ("codes", pa.list_(pa.binary())),
    ("lens", pa.list_(pa.list_(pa.int32()))), ("first", pa.binary()), ("following", pa.binary())])
_SHARD = ("part int, at int, conv_ids array<bigint>, codes array<binary>, lens array<array<int>>, first binary, following binary")


def shards(convs: DataFrame) -> DataFrame:
    """Shard rows in the order (part, at), each with the codes of the conversation behind it."""
    size = convs.agg(F.sum(F.size("lens") + 1).alias("n")).first()["n"] or 0
    parts = max(1, -(-size // PART_CODES))
    dealt = convs.repartitionByRange(parts, "codes", "conv_id").sortWithinPartitions("codes", "conv_id")
    cut = materialize(dealt.select(F.spark_partition_id(), "conv_id", "codes", "lens").mapInArrow(_shards, _SHARD), "shards")
    # a row a range partition: the codes with which the next one that has rows begins
    heads = cut.where("at = 0").select("part", F.lead("first").over(Window.orderBy("part")).alias("head"))
    return cut.join(heads, "part").withColumn("following", F.coalesce("following", "head")).drop("head", "first")


# ---------------------------------------------------------- balanced parentheses
def find_close(excess: np.ndarray, opens: np.ndarray) -> np.ndarray:
    """The position of the closing parenthesis of every opening one: the next position
    of smaller excess.  Inside the own block by looking on, beyond it by climbing the
    tree of block minima to the first subtree with such an excess and going down."""
    n = len(excess)
    blocks = -(-n // BLOCK)
    leaves = 1 << max(blocks - 1, 0).bit_length()
    padded = np.full(leaves * BLOCK, np.iinfo(np.int64).max)
    padded[:n] = excess
    tree = np.empty(2 * leaves, np.int64)
    tree[leaves:] = padded.reshape(leaves, BLOCK).min(axis=1)
    level = leaves
    while level > 1:
        level //= 2
        tree[level:2 * level] = tree[2 * level:4 * level].reshape(level, 2).min(axis=1)

    close = np.empty(len(opens), np.int64)
    target = excess[opens]

    def scan(which: np.ndarray, start: np.ndarray) -> np.ndarray:
        """Look on from start to the end of its block; those not found are returned."""
        pos = start.copy()
        while len(which):
            inside = (pos % BLOCK != 0) | (pos == start)
            hit = inside & (padded[np.minimum(pos, len(padded) - 1)] < target[which])
            close[which[hit]] = pos[hit]
            go = inside & ~hit
            lost.append(which[~inside])
            which, pos, start = which[go], pos[go] + 1, start[go]
        return np.concatenate(lost) if lost else which

    lost: list[np.ndarray] = []
    which = np.arange(len(opens))
    at_end = (opens + 1) % BLOCK == 0
    lost.append(which[at_end])
    far = scan(which[~at_end], opens[~at_end] + 1)
    if len(far):
        node = leaves + opens[far] // BLOCK
        goal = target[far]
        up = np.ones(len(far), bool)
        while up.any():                               # to a right sibling whose minimum is smaller
            sibling = np.where(node % 2 == 0, node + 1, node)
            found = up & (node % 2 == 0) & (tree[sibling] < goal)
            node = np.where(found, sibling, np.where(up, node // 2, node))
            up &= ~found
        while (node < leaves).any():                  # down to the first block
            left = 2 * node
            inner = node < leaves
            node = np.where(inner, np.where(tree[np.minimum(left, 2 * leaves - 1)] < goal, left, left + 1), node)
        lost = []
        scan(far, (node - leaves) * BLOCK)
    return close


def _common(a: bytes, b: bytes) -> int:
    """Codes that two paths share from the start."""
    n = min(len(a), len(b)) // CODE
    if a[:n * CODE] == b[:n * CODE]:
        return n
    x, y = np.frombuffer(a, np.uint8, n * CODE), np.frombuffer(b, np.uint8, n * CODE)
    return int(np.flatnonzero(x != y)[0]) // CODE


class Shard:
    """The subtrie of consecutive conversations; arrays are over its nodes in preorder."""

    def __init__(self, conv_ids, codes: list[bytes], lens, following: bytes | None):
        m = len(codes)
        self.codes, self.ids = codes, np.asarray(conv_ids, np.int64)
        size = np.array([len(c) // CODE for c in codes])
        common = np.array([-1, *(_common(a, b) for a, b in zip(codes, codes[1:], strict=False))])
        # step i closes down to the common path and opens the rest; step m closes all
        closing = np.concatenate(([0], size[:-1] - common[1:], [size[-1] + 1]))
        opening = np.concatenate((size - common, [0]))
        kinds = np.repeat(np.tile([-1, 1], m + 1), np.stack([closing, opening], 1).ravel())
        step = np.repeat(np.repeat(np.arange(m + 1), 2), np.stack([closing, opening], 1).ravel())
        excess = np.cumsum(kinds)
        opens = np.flatnonzero(kinds > 0)
        close = find_close(excess, opens)
        rank = np.cumsum(kinds > 0)                                   # nodes opened up to here
        pairs = np.cumsum((kinds > 0) & (np.append(kinds[1:], 0) < 0))   # leaf pairs up to here

        self.depth = excess[opens] - 1
        self.first, self.last = step[opens], step[close]              # members: conversations first .. last - 1
        self.n = self.last - self.first
        nodes = len(opens)
        index = np.arange(nodes)
        order = self.depth * nodes + index
        by_depth = np.sort(order)
        self.parent = np.where(self.depth > 0, by_depth[np.searchsorted(by_depth, order - nodes) - 1] % nodes, -1)
        self.parent[0] = -1
        own = np.concatenate([[0], *(np.asarray(ls[k + 1 if k < 0 else k:], np.int64) for ls, k in zip(lens, common, strict=True))])
        end = index + rank[close] - rank[opens] + 1                   # behind the subtree

        # the path on which the following shard goes on stays open
        going_on = -1 if following is None else _common(codes[-1], following)
        on_last = self.last == m
        self.open = on_last & (self.depth <= going_on)
        closed = ~self.open
        self.weight = self._between(self.n * own, index, end)
        self.length = self._between(own * closed, index, end)
        self.leaves = pairs[close] - pairs[opens] + (kinds[opens + 1] < 0)
        if going_on == size[-1]:
            self.leaves = self.leaves - on_last                       # the last leaf is the next shard's
        has_parent = self.parent >= 0
        self.children = np.bincount(self.parent[has_parent & closed], minlength=nodes)
        self.spine = self.open | (index <= size[0])
        self.smallest = self._minimum()
        # a run of equal conversations ends at the node that its first one opened last, or stays on
        new = np.concatenate(([True], np.array([a != b for a, b in zip(codes, codes[1:], strict=False)], bool)))
        self.runs = np.flatnonzero(new)
        self.run_node = rank[np.searchsorted(step, self.runs, side="right") - 1] - 1
        self.keys = self._keys(size)

    @staticmethod
    def _between(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(values)))
        return total[end] - total[start]

    def _minimum(self) -> np.ndarray:
        """Least conv_id of every node's members, from minima over powers of two."""
        table = [self.ids]
        while 2 ** len(table) <= len(self.ids):
            half = 2 ** (len(table) - 1)
            table.append(np.minimum(table[-1][:-half], table[-1][half:]))
        level = np.frexp(self.n.astype(float))[1] - 1
        out = np.empty(len(self.n), np.int64)
        for k, least in enumerate(table):
            at = level == k
            out[at] = np.minimum(least[self.first[at]], least[self.last[at] - 2**k])
        return out

    def _keys(self, size: np.ndarray) -> dict[int, bytes]:
        """Digest of the path of every spine node."""
        keys = {}
        for path, nodes in ((self.codes[0], range(int(size[0]) + 1)), (self.codes[-1], np.flatnonzero(self.open))):
            h = hashlib.sha256()
            for d, node in enumerate(nodes):
                if d:
                    h.update(path[(d - 1) * CODE:d * CODE])
                keys[int(node)] = h.digest()[:CODE] + d.to_bytes(8, "big")
        return keys

    def table(self, shard: int) -> pa.RecordBatch:
        ends: dict[int, str] = {}
        for node, lo, hi in zip(self.run_node.tolist(), self.runs.tolist(), [*self.runs[1:].tolist(), len(self.ids)], strict=True):
            ends[node] = ",".join(map(str, self.ids[lo:hi].tolist()))
        nodes = range(len(self.n))
        spine, parent = self.spine.tolist(), self.parent.tolist()
        known = self.parent >= 0
        inner = known & ~self.spine[self.parent]
        sha = [None if spine[i] else hashlib.sha256(ends[i].encode()).hexdigest() if i in ends else EMPTY for i in nodes]
        return pa.RecordBatch.from_arrays([
            pa.array(np.full(len(self.n), shard)), pa.array(np.arange(len(self.n)), pa.int32()), pa.array(self.parent, pa.int32()),
            pa.array([self.keys.get(i) for i in nodes], pa.binary()),
            pa.array([self.keys.get(parent[i]) if spine[i] else None for i in nodes], pa.binary()),
            pa.array(self.smallest), pa.array(self.depth.astype(np.int64)),
            pa.array(self.smallest[self.parent], mask=~inner), pa.array(self.n.astype(np.int64)), pa.array(self.children.astype(np.int64)),
            pa.array(self.leaves.astype(np.int64)), pa.array(self.weight), pa.array(self.length),
            pa.array(sha, pa.string()), pa.array([ends.get(i) if spine[i] else None for i in nodes], pa.string()),
        ], [f.split()[0] for f in LOCAL.split(", ")])


def _tries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for part, at, ids, codes, lens, following in zip(*(b.column(i) for i in range(6)), strict=True):
            shard = Shard(ids.values.to_numpy(), codes.as_py(), lens.as_py(), following.as_py())
            yield shard.table(part.as_py() << 32 | at.as_py())


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of the lists of every key, which come one after the other."""
    key, h = None, None

    def out():
        return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([h.hexdigest()])], ["key", "ends_sha256"])

    for b in batches:
        for k, text in zip(b.column(0), b.column(1), strict=True):
            if k.as_py() != key:
                if h:
                    yield out()
                key, h = k.as_py(), hashlib.sha256()
            else:
                h.update(b",")
            h.update(text.as_py().encode())
    if h:
        yield out()


def nodes(turns: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations."""
    local = materialize(shards(materialize(rebuilt(turns), "rebuilt")).select("part", "at", "conv_ids", "codes", "lens", "following").mapInArrow(
        _tries, LOCAL), "tries")
    spine = local.where("key IS NOT NULL")
    lists = spine.where("ends IS NOT NULL").select("key", "ends", "shard")
    ends = lists.repartition("key").sortWithinPartitions("key", "shard").select("key", "ends").mapInArrow(
        _hashed, "key binary, ends_sha256 string")
    merged = spine.groupBy("key").agg(
        F.first("parent_key").alias("parent_key"), F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves")), (F.sum("weight") - F.sum("length")).alias("saved_tokens"))
    merged = materialize(merged.join(ends, "key", "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(EMPTY))), "spine-nodes")
    columns = [c.split()[0] for c in NODES.split(", ")]

    least = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    of_spine = merged.join(least, "parent_key", "left").select(columns)
    # inner nodes below a spine take the parent's smallest member from the merged spine
    inner = local.where("key IS NULL").withColumn("saved_tokens", F.col("weight") - F.col("length"))
    tops = spine.select("shard", F.col("node").alias("parent"), F.col("key").alias("parent_key")).join(
        least, "parent_key").select("shard", "parent", F.col("parent_conv_id").alias("top"))
    below = inner.where("parent_conv_id IS NULL").join(tops, ["shard", "parent"]).withColumn("parent_conv_id", F.col("top"))
    return of_spine.unionByName(inner.where("parent_conv_id IS NOT NULL").select(columns)).unionByName(below.select(columns))
