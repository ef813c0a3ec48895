"""Prefix trie of conversations by vertical bitmaps.

A conversation is its sequence of turns (role, text). A node of depth d is a
distinct sequence of d first turns; its members are the conversations that begin
with it.

1. Turns become thin rows: a 128-bit key of role, text and place. No text is
   shuffled. Turns are placed by one global sort and its row numbers, so a
   conversation of any length is dealt over many tasks.
2. Conversations are numbered in the order of their ids and cut into shards of
   ``SPAN`` conversations and ``DEPTHS`` places; where a conversation goes on in
   another shard of places, its node is known by the key of its prefix.
3. In a shard each (place, turn) has a bitmap of the conversations that hold it.
   Depth first, a node's bitmap is intersected with the postings of the next
   place: each result that is not empty is a child, its popcount the members, and
   the conversations that end there its end list. A node of one member is a chain
   and needs no bitmaps.
4. Nodes of all shards are merged by key: a very common first turn is one row of
   each shard. End lists, in ascending order in each shard, are hashed as they
   stream by in the order of the shards, so a list of any length needs no memory.
5. Sums over subtrees take as many rounds as the logarithm of the depth: a node's
   sum reaches an ancestor 1, 2, 4, .. levels above. Only nodes of several members
   take part, since a chain of one member saves nothing and has one leaf.

Defined cases: a null role or text is empty; turns with a null place come first,
rows that repeat a place follow each other by role, then by the SHA-256 of the
text; rows with a null conversation are left out; an empty table has no nodes, not
even a root; conversations that lose all turns are members, and ends, of the root;
other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siglake.llm.common import discard, numbered, small, staged

SPAN = 2048              # conversations of a shard
DEPTHS = 64              # places of a shard
NO_ENDS = hashlib.sha256(b"").hexdigest()


# ------------------------------------------------------------------- turns

def placed(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """Staged (conv_id, pos, a, b, chars): the turns of each conversation in order, from 1, with a 128-bit key."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = conversations.select(
        F.col(conv_col).cast("bigint").alias("conv_id"), F.col(turn_col).cast("bigint").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), F.sha2(text, 256).alias("sha"),
        F.length(text).cast("bigint").alias("chars")).where("conv_id is not null")
    rows = rows.orderBy("conv_id", F.col("turn").asc_nulls_first(), "role", "sha").select(
        "conv_id", F.xxhash64("role", "sha").alias("a"), F.xxhash64("sha", "role", F.lit(1)).alias("b"), "chars")
    rows = numbered(rows, "at", "turns")
    first = staged(rows.groupBy("conv_id").agg(F.min("at").alias("first")), "firsts")
    out = staged(rows.join(small(first), "conv_id").select(
        "conv_id", (F.col("at") - F.col("first") + 1).alias("pos"), "a", "b", "chars"), "placed")
    discard(rows, first)
    return out


def rebuilt(turns: DataFrame, every: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Turns where each conversation c begins with the first h turns of conversation c - c % every, and its own after h.

    h = crc32(decimal c) % most. Also (conv_id, size): the rebuilt length of every conversation, staged.
    """
    sizes = staged(turns.groupBy("conv_id").agg(F.max("pos").alias("own")), "sizes")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    convs = sizes.select("conv_id", "own", (F.col("conv_id") - F.col("conv_id") % every).alias("base"), h.alias("h"))
    bases = sizes.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.col("own").alias("held"))
    convs = staged(convs.join(small(_sized(sizes, bases)), "base", "left").withColumn(
        "taken", F.least("h", F.coalesce("held", F.lit(0)))), "convs")
    begins = turns.where((F.col("conv_id") % every == 0) & (F.col("pos") < most)).withColumnRenamed("conv_id", "base")
    begins = convs.select("conv_id", "base", "taken").join(begins, "base").where("pos <= taken").select(
        "conv_id", "pos", "a", "b", "chars")
    rest = turns.join(small(convs.select("conv_id", "h", "taken")), "conv_id").where("pos > h").select(
        "conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "a", "b", "chars")
    lengths = convs.select("conv_id", (F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("size"))
    out, lengths = staged(begins.union(rest), "rebuilt"), staged(lengths, "lengths")
    discard(sizes, convs)
    return out, lengths


def _sized(stored: DataFrame, df: DataFrame) -> DataFrame:
    """``df``, thinner than the staged table ``stored``, which tells its size."""
    df.staged_path = stored.staged_path
    return df


# ------------------------------------------------------------------ shards

class Shard:
    """Vertical bitmaps of up to SPAN conversations: rows of (conversation, place from 0, key of the turn there)."""

    def __init__(self, conv: np.ndarray, depth: np.ndarray, a: np.ndarray, b: np.ndarray):
        self.ids, self.member = np.unique(conv, return_inverse=True)
        self.bits = -(-len(self.ids) // 64)
        turn = np.stack([depth, a, b], 1)
        # a posting for each distinct (place, turn); its bitmap holds the conversations
        _, self.row, self.posting = np.unique(turn, axis=0, return_index=True, return_inverse=True)
        self.posting = self.posting.ravel()
        size = int(depth.max()) + 1
        self.turns = np.full((len(self.ids), size), -1, np.int64)
        self.turns[self.member, depth] = self.posting
        self.rows = np.full((len(self.ids), size), -1, np.int64)
        self.rows[self.member, depth] = np.arange(len(depth))
        # bitmaps of postings that two conversations hold at least; the others are chains
        n = np.bincount(self.posting)
        self.common = np.flatnonzero(n > 1)
        self.slot = np.full(len(n), -1, np.int64)
        self.slot[self.common] = np.arange(len(self.common))
        self.maps = np.zeros((len(self.common), self.bits), np.uint64)
        held = self.slot[self.posting] >= 0
        np.bitwise_or.at(self.maps, (self.slot[self.posting[held]], self.member[held] >> 6),
                         np.uint64(1) << (self.member[held] & 63).astype(np.uint64))

    def bitmap(self, members: np.ndarray) -> np.ndarray:
        out = np.zeros(self.bits, np.uint64)
        np.bitwise_or.at(out, members >> 6, np.uint64(1) << (members & 63).astype(np.uint64))
        return out

    def members(self, bitmap: np.ndarray) -> np.ndarray:
        return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little")[:len(self.ids)])

    def walk(self, start: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(place, members) of all nodes below the node of the members ``start``."""
        todo = [(self.bitmap(start), 0)]
        while todo:
            above, depth = todo.pop()
            if depth == self.turns.shape[1]:
                continue
            held = self.members(above)
            postings = np.unique(self.turns[held, depth])
            postings = postings[postings >= 0]
            slots = self.slot[postings]
            kids = self.maps[slots[slots >= 0]] & above
            counts = np.bitwise_count(kids).sum(1)
            for kid, n in zip(kids, counts.tolist()):
                own = self.members(kid)
                yield depth, own
                if n > 1:
                    todo.append((kid, depth + 1))
                else:
                    yield from self.chain(own, depth + 1)
            # turns that one conversation alone holds
            alone = held[(self.turns[held, depth] >= 0) & (self.slot[self.turns[held, depth]] < 0)]
            for m in alone.reshape(-1, 1):
                yield depth, m
                yield from self.chain(m, depth + 1)

    def chain(self, member: np.ndarray, depth: int) -> Iterator[tuple[int, np.ndarray]]:
        row = self.turns[member[0], depth:]
        for k in range(int(np.argmin(np.append(row, -1)))):
            yield depth + k, member


_NODES = ("key_a bigint, key_b bigint, up_a bigint, up_b bigint, depth bigint, chars bigint, n bigint, conv_id bigint, "
          "shard bigint, ends binary")


def _shards(depths: int):
    """Shards (shard, part, turns) to their nodes; ``ends`` joins the decimal ids that end at a node by commas."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split(" ")[0] for f in _NODES.split(", ")]
        kinds = [pa.int64()] * 9 + [pa.binary()]
        for batch in batches:
            for shard, part, rows in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                conv, pos, a, b, chars, up_a, up_b, last = (
                    rows.values.field(k).to_numpy(zero_copy_only=False) for k in range(8))
                s = Shard(conv, pos - part * depths - 1, a, b)
                # keys of the prefixes: the keys of the turns, which hold their places, added by exclusive or
                keys = []
                for x, up in ((a, up_a), (b, up_b)):
                    own = np.zeros(s.rows.shape, np.int64)
                    own[s.rows >= 0] = x[s.rows[s.rows >= 0]]
                    begin = np.zeros(len(s.ids), np.int64)
                    begin[s.member] = up
                    keys.append(np.bitwise_xor.accumulate(np.concatenate([begin[:, None], own], 1), 1))
                start = np.stack([keys[0][:, 0], keys[1][:, 0]], 1)
                _, group = np.unique(start, axis=0, return_inverse=True)
                group = group.ravel()
                out = []
                for g in range(int(group.max()) + 1):
                    for depth, members in s.walk(np.flatnonzero(group == g)):
                        m, row = members[0], s.rows[members, depth]
                        ends = s.ids[members[last[row]]]
                        out.append((keys[0][m, depth + 1], keys[1][m, depth + 1], keys[0][m, depth], keys[1][m, depth],
                                    part * depths + depth + 1, chars[row[0]], len(members), s.ids[m], shard,
                                    ",".join(map(str, ends.tolist())).encode() if len(ends) else None))
                for at in range(0, len(out), 10_000):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list(c), k) for c, k in zip(zip(*out[at:at + 10_000]), kinds)], names=names)

    return apply


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """End lists in the order of node and shard to the SHA-256 of each node's whole list."""
    node, digest = None, None
    for batch in batches:
        out = []
        for a, b, ends in zip(*(batch.column(k).to_pylist() for k in (0, 1, 3))):
            if (a, b) != node:
                if node is not None:
                    out.append((*node, digest.hexdigest()))
                node, digest = (a, b), hashlib.sha256(ends)
            else:
                digest.update(b"," + ends)
        cols = list(zip(*out)) if out else [()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(), pa.int64(), pa.string()))],
                                         names=["key_a", "key_b", "ends_sha256"])
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([node[0]]), pa.array([node[1]]), pa.array([digest.hexdigest()])],
                                         names=["key_a", "key_b", "ends_sha256"])


def shard_nodes(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """Staged nodes of all shards, several of one key where shards share it. ``lengths``: (conv_id, size), staged."""
    no = numbered(lengths.orderBy("conv_id"), "no", "numbers")
    part = F.floor((F.col("pos") - 1) / DEPTHS)
    # a turn's key with its place, so that equal turns at different places differ
    rows = turns.select("conv_id", "pos", "chars", F.xxhash64("a", "b", "pos").alias("a"),
                        F.xxhash64("b", "pos", "a").alias("b"), part.alias("part"))
    rows = rows.join(small(no), "conv_id").withColumn("last", F.col("pos") == F.col("size")).withColumn(
        "shard", F.floor(F.col("no") / SPAN)).drop("no", "size")
    # what stands before a part: only conversations of more than DEPTHS turns have one
    long = staged(lengths.where(F.col("size") > DEPTHS).select("conv_id"), "long")
    begun = rows.join(small(long), "conv_id", "left_semi").groupBy("conv_id", "part").agg(
        F.bit_xor("a").alias("x"), F.bit_xor("b").alias("y"))
    later = begun.select("conv_id", (F.col("part") + 1).alias("part"), "x", "y")
    before = staged(_running(later), "before")
    rows = rows.join(small(before), ["conv_id", "part"], "left").select(
        "shard", "part", F.struct("conv_id", "pos", "a", "b", "chars", F.coalesce("x", F.lit(0)).alias("x"),
                                  F.coalesce("y", F.lit(0)).alias("y"), "last").alias("turn"))
    gathered = rows.groupBy("shard", "part").agg(F.collect_list("turn").alias("turns"))
    out = staged(gathered.mapInArrow(_shards(DEPTHS), _NODES), "nodes")
    discard(no, long, before)
    return out


def _running(parts: DataFrame) -> DataFrame:
    """(conv_id, part, x, y) with x and y added, by exclusive or, over the parts up to each."""
    from pyspark.sql import Window
    w = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, 0)
    return parts.select("conv_id", "part", F.bit_xor("x").over(w).alias("x"), F.bit_xor("y").over(w).alias("y"))


# -------------------------------------------------------------------- trie

def _subtree_sums(nodes: DataFrame, max_rounds: int = 40) -> DataFrame:
    """(key_a, key_b, leaves, saved) summed over the subtrees of nodes (key_a, key_b, up_a, up_b, depth, leaves, saved)."""
    at = staged(nodes.select("key_a", "key_b", "leaves", "saved", F.when(F.col("depth") > 1, F.col("up_a")).alias("up_a"),
                             F.when(F.col("depth") > 1, F.col("up_b")).alias("up_b")), "sums")
    for _ in range(max_rounds):
        add = at.where("up_a is not null").groupBy(F.col("up_a").alias("key_a"), F.col("up_b").alias("key_b")).agg(
            F.sum("leaves").alias("more"), F.sum("saved").alias("more_saved"))
        above = at.select(F.col("key_a").alias("up_a"), F.col("key_b").alias("up_b"), F.col("up_a").alias("next_a"),
                          F.col("up_b").alias("next_b"))
        step = staged(at.join(add, ["key_a", "key_b"], "left").join(above, ["up_a", "up_b"], "left").select(
            "key_a", "key_b", (F.col("leaves") + F.coalesce("more", F.lit(0))).alias("leaves"),
            (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved"),
            F.col("next_a").alias("up_a"), F.col("next_b").alias("up_b")), "sums")
        discard(at)
        at = step
        if at.where("up_a is not null").limit(1).count() == 0:
            return at.select("key_a", "key_b", "leaves", "saved")
    raise RuntimeError(f"conversations longer than 2^{max_rounds} turns")


def trie(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node.

    ``turns``: (conv_id, pos from 1, a, b, chars); ``lengths``: (conv_id, size) of every conversation; both staged.
    """
    key = ["key_a", "key_b"]
    parts = shard_nodes(turns, lengths)
    ended = parts.where("ends is not null").select(*key, "shard", "ends").repartition(*key).sortWithinPartitions(*key, "shard")
    ends = staged(ended.mapInArrow(_digests, "key_a bigint, key_b bigint, ends_sha256 string"), "ends")
    nodes = staged(parts.groupBy(*key).agg(
        F.sum("n").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.first("up_a").alias("up_a"),
        F.first("up_b").alias("up_b"), F.first("depth").alias("depth"), F.first("chars").alias("chars")), "merged")
    # children of each node, and those of one member, which are chains of one leaf
    kids = staged(nodes.groupBy(F.col("up_a").alias("key_a"), F.col("up_b").alias("key_b")).agg(
        F.count("*").alias("n_children"), F.sum((F.col("n_convs") == 1).cast("bigint")).alias("chains")), "kids")
    shared = nodes.where("n_convs > 1").join(kids, key, "left").select(
        *key, "up_a", "up_b", "depth", F.when(F.col("n_children").isNull(), 1).otherwise(F.col("chains")).alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
    sums = _subtree_sums(shared)
    up = nodes.select(F.col("key_a").alias("up_a"), F.col("key_b").alias("up_b"), F.col("conv_id").alias("parent"))
    root = _root(nodes, lengths)
    below = nodes.join(kids, key, "left").join(sums, key, "left").join(ends, key, "left").join(
        up, ["up_a", "up_b"], "left").join(F.broadcast(root.select(F.col("conv_id").alias("root_id"))))
    below = below.select(
        "conv_id", "depth", F.when(F.col("depth") == 1, F.col("root_id")).otherwise(F.col("parent")).alias("parent_conv_id"),
        "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), F.coalesce("leaves", F.lit(1)).alias("n_leaves"),
        F.coalesce("saved", F.lit(0)).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"))
    return below.union(root.where("n_convs > 0").select(*below.columns))


def _root(nodes: DataFrame, lengths: DataFrame) -> DataFrame:
    """The one row of the root, staged."""
    every = lengths.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"))
    below = nodes.agg(F.coalesce(F.sum((F.col("depth") == 1).cast("bigint")), F.lit(0)).alias("n_children"),
                      F.coalesce(F.sum((F.col("n_convs") - 1) * F.col("chars")), F.lit(0)).alias("saved_tokens"))
    ups = nodes.where("depth > 1").select(F.col("up_a").alias("key_a"), F.col("up_b").alias("key_b")).distinct()
    leaves = nodes.join(ups, ["key_a", "key_b"], "left_anti").agg(F.count("*").alias("leaves"))
    # conversations without a turn, in order, in one stream
    none = lengths.where("size = 0").repartition(1).sortWithinPartitions("conv_id").select(
        F.lit(0).cast("bigint").alias("key_a"), F.lit(0).cast("bigint").alias("key_b"), F.lit(0).cast("bigint").alias("shard"),
        F.col("conv_id").cast("string").cast("binary").alias("ends"))
    ends = none.mapInArrow(_digests, "key_a bigint, key_b bigint, ends_sha256 string").agg(
        F.coalesce(F.max("ends_sha256"), F.lit(NO_ENDS)).alias("ends_sha256"))
    return staged(every.join(below).join(leaves).join(ends).select(
        "conv_id", F.lit(0).cast("bigint").alias("depth"), F.lit(None).cast("bigint").alias("parent_conv_id"), "n_convs",
        "n_children", F.greatest("leaves", F.lit(1)).cast("bigint").alias("n_leaves"), "saved_tokens", "ends_sha256"), "root")


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of rebuilt conversations."""
    return trie(*rebuilt(placed(conversations)))
