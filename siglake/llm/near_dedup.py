"""Near-duplicate detection by a chosen-path set similarity join.

A document is its set of distinct five-word shingles (ASCII letters in lower
case). Two documents are linked when their sets have a Jaccard similarity of at
least 0.75, and the links are closed to components.

1. One pass makes a thin table: set size, a 128-bit print of the whole set, and
   ``COORDS`` minwise tokens. Documents of equal sets form a class; one
   representative of each goes on, and its tokens are all that is shuffled.
2. Each of ``TREES`` independent trees branches the representatives by one
   minwise token. Nodes of one document end.
3. Dense nodes of more than ``FIT`` members are settled by pivots. A node's pivot
   is the member that shares most tokens with the commonest ones of a sample;
   members near it are verified against it on full sets and linked. A node has
   further rounds, with pivots from those left, while each settles a quarter.
4. Only pairs of different components are still of interest. A node that lies in
   one component ends. A small node is a leaf. In a large one with few members
   outside of its main component these are compared with all, block by block.
   Any other node branches again by one or two fresh tokens, 1 / sqrt(s) of them on
   average (3/2 at most) where its members have a mean similarity s: little more
   than what keeps the sum of the children as large as the node, since the
   commonest token of a group that shares a template is held by sqrt(s) of it. A dense node also
   branches, once, by all fresh tokens that a few of its members hold: pairs that
   share more than the template meet there. No estimate ends a node. A node of up
   to ``FIT`` members is gathered once and branches inside its task; only larger
   ones are shuffled a level at a time.
5. A leaf is compared exhaustively, first by tokens with a generous margin; what
   hangs together goes on as one record. Equal records of different trees meet.
6. Records are verified on the full sets, all pairs at once, and give a spanning
   forest of their true links. Components are found over all links.

A pair of similarity s misses all trees at the root with probability
(1 - s)^TREES, a millionth at 0.75. In a group of thousands that are 0.742 alike and
not linked, work stays in proportion to the group at the price of recall: pairs
that share nothing but the template, 0.75 by a hair, can be missed in groups of
many times ``LEAF``; the tests measure recall against brute force.

Defined cases: a null or empty text has an empty set and is linked with nothing;
fewer than five words are one shingle; every row is a document of its own, also
one that repeats an id; a null id is returned with a null component, is kept and
linked with nothing; an empty table gives an empty result; other columns are not
read. ``drop_near_copies`` decides by id and text and keeps one of rows that
repeat both.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siglake.llm.common import (U, chunked, components, discard, mix, shingle_rows, small, staged, string_buffers,
                                text_hash, without, words_of)

SHARE = 75               # percent: 100 * intersection >= SHARE * union
TREES = 10
COORDS = 64              # minwise tokens: the first TREES choose roots, the others branch
LEAF = 512               # documents that a leaf compares exhaustively
LEAF_SHINGLES = 4_000_000
FIT = 8192               # members of a node that are gathered and branch in one task
STRAYS = 64              # members outside of a node's main component that are compared with all others
SAMPLE = 64              # members of a node that its commonest tokens and mean similarity come from
LEVELS = (COORDS - TREES) // 2   # branchings for which there are fresh tokens
DENSE = 0.5              # mean similarity from which a node also branches by all rare tokens
GROWTH = 1.05            # growth of a dense group's members from level to level
RARE = 64                # members that hold a rare token, at most
TOKEN_SHARE = 0.5        # share of equal tokens from which a pair is verified
PIVOT_SHARE = 0.6        # the same for a member and a pivot
PIVOT_TREES = 4          # trees whose large nodes choose pivots
SETTLED = 0.25           # share of a node's strays that a round of pivots settles, or it is the node's last

_A = (mix(np.arange(1, COORDS + 1).astype(U)) >> U(32)).astype(np.uint32) | np.uint32(1)
_B = (mix(np.arange(1001, COORDS + 1001).astype(U)) >> U(32)).astype(np.uint32)
#: For each tree, the order in which its branchings use the tokens that chose no root.
PLACES = np.stack([np.random.default_rng(t).permutation(COORDS - TREES) + TREES for t in range(TREES)])


def minwise(shingles: np.ndarray) -> np.ndarray:
    """The least value of each of the COORDS hash functions over a set."""
    x = (shingles >> U(32)).astype(np.uint32)
    best = None
    for at in range(0, len(x), 1 << 14):
        low = (x[None, at:at + (1 << 14)] * _A[:, None] + _B[:, None]).min(1)
        best = low if best is None else np.minimum(best, low)
    return best


def _prints(s: np.ndarray) -> tuple[np.uint64, np.uint64]:
    """Two 64-bit prints of a set."""
    if not len(s):
        return U(0), U(0)
    return mix(s).sum() + U(len(s)), np.bitwise_xor.reduce(mix(s ^ U(0x5851F42D4C957F2D)))


_SETS = "doc_id bigint, h bigint, n_shingles bigint, print_a bigint, print_b bigint, tokens array<int>"
_PRINTS = ["print_a", "print_b"]


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in chunked(batches, 1 << 20):
        words, _, _, per_row = words_of(*string_buffers(b.column(2)), lower=True)
        sets = [np.unique(s) for s in shingle_rows(words, per_row)]
        prints = np.array([_prints(s) for s in sets], U).reshape(-1, 2).view(np.int64)
        tokens = [minwise(s).view(np.int32) if len(s) else None for s in sets]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array(prints[:, 0].copy()),
             pa.array(prints[:, 1].copy()), pa.array(tokens, pa.list_(pa.int32()))],
            names=["doc_id", "h", "n_shingles", *_PRINTS, "tokens"])


# --------------------------------------------------------------------- pivots

def _modes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The commonest value of each token over each sample (a list of token lists)."""
    for b in batches:
        out = []
        for sample in b.column(1):
            t = sample.values.flatten().to_numpy(zero_copy_only=False).reshape(-1, COORDS)
            out.append([int(v[np.argmax(n)]) for v, n in (np.unique(c, return_counts=True) for c in t.T)])
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.int32()))], names=["node", "modes"])


def _equal_tokens(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)


def _strays(nodes: DataFrame, comp: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """(``nodes`` with the ``component`` of each member, (node, main, strays) of nodes of several components), staged."""
    if comp is not None:
        nodes = nodes.join(small(comp), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    else:
        nodes = nodes.withColumn("component", F.col("rep"))
    nodes = staged(nodes, "named")
    sizes = nodes.groupBy("node", "component").agg(F.count("*").alias("c"))
    main = sizes.groupBy("node").agg(F.max(F.struct("c", "component")).alias("m"), F.sum("c").alias("n_all")).select(
        "node", F.col("m.component").alias("main"), (F.col("n_all") - F.col("m.c")).alias("strays"))
    return nodes, staged(main.where("strays > 0"), "main")


def pivot_links(docs: DataFrame, classes: DataFrame, large: DataFrame) -> DataFrame | None:
    """(a, b): verified links of members of large nodes (node, rep) with the nodes' pivots."""
    links = before = None
    while True:
        comp = staged(_named(components(links)), "settled") if links is not None else None
        nodes, main = _strays(large, comp)
        asked = main.where(F.col("strays") > STRAYS)
        if before is not None:
            asked = asked.join(before, "node").where(F.col("strays") <= (1 - SETTLED) * F.col("before"))
        asked = staged(asked.select("node", "main", "strays"), "asked")
        if asked.limit(1).count() == 0:
            discard(nodes, main, asked, *([comp] if comp is not None else []))
            return links
        before = asked.select("node", F.col("strays").alias("before"))
        todo = nodes.join(small(asked), "node").where("component <> main")
        held = staged(todo.select("node", "rep", "strays").join(classes.select("rep", "tokens", "n_shingles"), "rep"), "held")
        sample = held.where(F.pmod(F.xxhash64("rep", "node"), F.ceil(F.col("strays") / SAMPLE)) == 0)
        modes = staged(sample.groupBy("node").agg(F.collect_list("tokens")).mapInArrow(
            _modes, "node bigint, modes array<int>"), "modes")
        scored = held.join(small(modes), "node").select("node", "rep", "tokens", _equal_tokens("tokens", "modes").alias("near"))
        pivots = staged(scored.groupBy("node").agg(F.max(F.struct("near", "rep", "tokens")).alias("p")).select(
            "node", F.col("p.rep").alias("pivot"), F.col("p.tokens").alias("pivot_tokens")), "pivots")
        near = held.join(small(pivots), "node").where(
            (F.col("rep") != F.col("pivot")) & (_equal_tokens("tokens", "pivot_tokens") >= PIVOT_SHARE * COORDS))
        near = staged(near.select("pivot", "rep", "n_shingles").distinct(), "near")
        blocks = near.groupBy("pivot").agg(F.ceil(F.greatest(
            F.count("*") / LEAF, F.sum("n_shingles") / LEAF_SHINGLES)).alias("blocks"))
        dealt = near.join(small(staged(blocks, "blocks")), "pivot").groupBy(
            "pivot", F.pmod(F.xxhash64("rep"), "blocks").alias("block"))
        records = dealt.agg(F.array_sort(F.array_union(F.collect_set("rep"), F.array(F.col("pivot")))).alias("members"))
        found = staged(_verified(docs, classes, records.select("members")), "pivot_links")
        links = found if links is None else links.union(found)
        discard(held, modes, pivots, near, nodes, main, *([comp] if comp is not None else []))


def _named(comp: DataFrame) -> DataFrame:
    return comp.withColumnsRenamed({"id": "rep"})


# ---------------------------------------------------------------------- trees

def _mean_share(tokens: np.ndarray) -> float:
    """Mean share of equal tokens over all pairs of a sample."""
    m = len(tokens)
    same = sum(int((n * (n - 1)).sum()) for n in (np.unique(c, return_counts=True)[1] for c in tokens.T))
    return same / (tokens.shape[1] * m * (m - 1)) if m > 1 else 0.0


def _second(s: float) -> float:
    """Share of nodes of mean similarity ``s`` that branch by a second token."""
    return min(1.5, GROWTH / max(s, 4 / 9) ** 0.5) - 1


def _rare(tokens: np.ndarray) -> Iterator[np.ndarray]:
    """Places of the members that hold the same rare value of a token, for each such value."""
    for column in tokens.T:
        order = np.argsort(column, kind="stable")
        yield from (g for g in np.split(order, np.flatnonzero(np.diff(column[order])) + 1) if 2 <= len(g) <= RARE)


def _around_pivots(idx: np.ndarray, tokens: np.ndarray, weight: np.ndarray, leaf: int) -> Iterator[np.ndarray]:
    """Blocks of the members near a pivot, each with the pivot; further pivots while each has a quarter of those left."""
    left = idx
    while len(left) > 1:
        sample = tokens[left[::max(1, len(left) // SAMPLE)]]
        modes = np.array([v[np.argmax(n)] for v, n in (np.unique(c, return_counts=True) for c in sample.T)])
        pivot = left[np.argmax((tokens[left] == modes).sum(1))]
        near = (tokens[left] == tokens[pivot]).sum(1) >= PIVOT_SHARE * COORDS
        held = left[near & (left != pivot)]
        size = max(1, min(leaf, int(LEAF_SHINGLES / max(1.0, weight[idx].mean()))) - 1)
        for at in range(0, len(held), size):
            yield np.sort(np.append(held[at:at + size], pivot))
        if near.sum() < SETTLED * len(left):
            return
        left = left[~near]


def branch_in_task(tree: int, level: int, seed: int, tokens: np.ndarray, component: np.ndarray, weight: np.ndarray,
                   leaf: int = LEAF, strays: int = STRAYS) -> Iterator[np.ndarray]:
    """Leaves (places of members) of one gathered node; each holds two components at least."""
    todo = [(np.arange(len(tokens)), level, np.random.default_rng(seed), level > 0)]
    while todo:
        idx, level, rng, spread = todo.pop()
        values, place, counts = np.unique(component[idx], return_inverse=True, return_counts=True)
        if len(values) < 2:
            continue
        if len(idx) <= 8 or len(idx) <= leaf and weight[idx].sum() <= LEAF_SHINGLES:
            yield idx
            continue
        apart = place != np.argmax(counts)
        few = int(apart.sum()) <= strays
        if few or level >= LEVELS:
            # each stray with every member, in blocks that hold few enough shingles
            size = max(2, min(leaf, int(LEAF_SHINGLES / max(1.0, weight[idx].mean()))) // 2)
            outer, rest = idx[apart], (idx[~apart] if few else idx)
            for one in np.array_split(outer, -(-len(outer) // size)):
                if few and len(outer) > 1:
                    yield outer
                for other in np.array_split(rest, -(-len(rest) // size)):
                    yield np.union1d(one, other)
            continue
        s = _mean_share(tokens[idx[::max(1, len(idx) // SAMPLE)], TREES:])
        if s >= DENSE and not spread:
            spread = True
            if tree < PIVOT_TREES:
                yield from _around_pivots(idx, tokens, weight, leaf)
            todo += [(np.sort(idx[g]), level, rng, True) for g in _rare(tokens[idx, TREES:])]
        for k in range(1 + (rng.random() < _second(s))):
            column = tokens[idx, PLACES[tree, 2 * level + k]]
            order = np.argsort(column, kind="stable")
            kids = [g for g in np.split(idx[order], np.flatnonzero(np.diff(column[order])) + 1) if len(g) > 1]
            todo += [(np.sort(g), level + 1, own, spread) for g, own in zip(kids, rng.spawn(len(kids)))]


def _groups(linked: np.ndarray) -> list[np.ndarray]:
    """Groups of at least two of a symmetric boolean matrix."""
    left, out = np.ones(len(linked), bool), []
    for i in range(len(linked)):
        if left[i]:
            left[i] = False
            group, front = [i], np.array([i])
            while len(front):
                front = np.flatnonzero(linked[front].any(0) & left)
                left[front] = False
                group += front.tolist()
            if len(group) > 1:
                out.append(np.array(sorted(group)))
    return out


def candidates(tokens: np.ndarray, component: np.ndarray) -> list[np.ndarray]:
    """Groups of a leaf's members that hang together by equal tokens across components."""
    equal = np.zeros((len(tokens), len(tokens)), np.uint16)
    for t in tokens.T:
        equal += t[:, None] == t[None, :]
    return _groups((equal >= TOKEN_SHARE * COORDS) & (component[:, None] != component[None, :]))


def _records(leaf_size: int, strays: int):
    """Nodes (tree, level, seed, members) to records that hang together by tokens."""
    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            col = b.column(3)
            off = col.offsets.to_numpy()
            inner = col.flatten()
            reps, comp, weight = (inner.field(k).to_numpy(zero_copy_only=False) for k in range(3))
            tokens = inner.field(3).flatten().to_numpy(zero_copy_only=False).reshape(-1, COORDS)
            out = []
            off = off - int(off[0])
            n = np.diff(off)
            two = np.flatnonzero(n == 2)
            if len(two):
                at = off[two]
                near = ((tokens[at] == tokens[at + 1]).sum(1) >= TOKEN_SHARE * COORDS) & (comp[at] != comp[at + 1])
                out += np.sort(np.stack([reps[at], reps[at + 1]], 1)[near], 1).tolist()
            tree, level, seed = (b.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            for i in np.flatnonzero(n > 2):
                own = slice(off[i], off[i + 1])
                order = np.argsort(reps[own])
                r, c, t, w = reps[own][order], comp[own][order], tokens[own][order], weight[own][order]
                for leaf in branch_in_task(int(tree[i]), int(level[i]), int(seed[i]) & (2**63 - 1), t, c, w,
                                           leaf_size, strays):
                    out += [r[leaf[g]].tolist() for g in candidates(t[leaf], c[leaf])]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.int64()))], names=["members"])

    return apply


def _shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How each sample's node (a list of token lists) branches."""
    for b in batches:
        s = [_mean_share(x.values.flatten().to_numpy(zero_copy_only=False).reshape(-1, COORDS)[:, TREES:])
             for x in b.column(1)]
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([_second(x) for x in s], pa.float64()), pa.array([x >= DENSE for x in s], pa.bool_())],
            names=["node", "second", "dense"])


def _sized(members: DataFrame, most: int | None = None) -> DataFrame:
    """Members (tree, node, rep) of nodes of two at least (and ``most`` at most), with their number ``n``, staged."""
    sizes = members.groupBy("node").agg(F.count("*").alias("n")).where("n > 1" + (f" and n <= {most}" if most else ""))
    sizes = staged(sizes, "sizes")
    # stored, so that the join's two sides are dealt as they are and AQE can split a hot node
    out = staged(members.join(small(sizes), "node"), "members")
    discard(sizes)
    return out


def fitting_nodes(members: DataFrame, comp: DataFrame | None, classes: DataFrame) -> DataFrame:
    """(tree, node, level, rep) of nodes of at most about FIT members that hold what is left to compare."""
    out, level = [], 0
    places = F.array(*(F.array(*(F.lit(int(p)) for p in row)) for row in PLACES))
    while True:
        out.append(members.where(F.col("n") <= FIT).select("tree", "node", F.lit(level).alias("level"), "rep"))
        big = members.where(F.col("n") > FIT)
        if big.limit(1).count() == 0:
            return reduce(DataFrame.union, out)
        nodes, main = _strays(big.select("tree", "node", "rep", "n"), comp)
        nodes = nodes.join(small(main), "node")                       # nodes of one component are gone
        few = (F.col("strays") <= STRAYS) | F.lit(level >= LEVELS)
        # blocks of all members, each with each block of those outside of the main component
        apart = nodes.where(few & (F.col("component") != F.col("main")))
        blocks, parts = F.ceil(2 * F.col("n") / FIT), F.ceil(2 * F.col("strays") / FIT)
        own, part = F.pmod(F.xxhash64("rep", "node"), blocks), F.pmod(F.xxhash64("rep", F.lit(1)), parts)
        every = nodes.where(few).select("tree", "node", "rep", own.alias("block"), F.explode(
            F.sequence(F.lit(0), parts - 1)).alias("part"))
        each = apart.select("tree", "node", "rep", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"),
                            part.alias("part"))
        held = every.union(each).distinct()
        out.append(held.select("tree", F.xxhash64("node", "block", "part").alias("node"), F.lit(level).alias("level"), "rep"))
        if level >= LEVELS:
            return reduce(DataFrame.union, out)
        kids = staged(nodes.where(~few).join(classes.select("rep", "tokens"), "rep").select(
            "tree", "node", "rep", "n", "tokens"), "branching")
        sample = kids.where(F.pmod(F.xxhash64("rep", "node"), F.ceil(F.col("n") / SAMPLE)) == 0)
        alike = staged(sample.groupBy("node").agg(F.collect_list("tokens")).mapInArrow(
            _shares, "node bigint, second double, dense boolean"), "alike")
        kids = kids.join(small(alike), "node", "left")
        if level == 0:
            rare = kids.where("dense").select("tree", "node", "rep", F.posexplode("tokens").alias("k", "value")).where(
                F.col("k") >= TREES).select("tree", F.xxhash64("node", F.lit("rare"), "k", "value").alias("node"), "rep")
            out.append(_sized(rare, RARE).select("tree", "node", F.lit(level).alias("level"), "rep"))
        chosen = [F.struct(F.lit(k).alias("k"), F.element_at("tokens", F.element_at(
            F.element_at(places, F.col("tree") + 1), 2 * level + k + 1) + 1).alias("value")) for k in (0, 1)]
        second = F.pmod(F.xxhash64("node", F.lit(level)), F.lit(1000)) < 1000 * F.coalesce("second", F.lit(_second(0.0)))
        kids = kids.select("tree", "node", "rep", F.explode(
            F.when(second, F.array(*chosen)).otherwise(F.array(chosen[0]))).alias("c"))
        members = _sized(kids.select("tree", F.xxhash64("node", "c.k", "c.value").alias("node"), "rep"))
        level += 1


# --------------------------------------------------------------- verification

def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in chunked(batches, 1 << 20):
        words, _, _, per_row = words_of(*string_buffers(b.column(1)), lower=True)
        sets = [np.unique(s) for s in shingle_rows(words, per_row)]
        prints = np.array([_prints(s) for s in sets], U).reshape(-1, 2).view(np.int64)
        yield pa.RecordBatch.from_arrays(
            [b.column(0), pa.array(prints[:, 0].copy()), pa.array(prints[:, 1].copy()),
             pa.array([s.tobytes() for s in sets], pa.binary())], names=["doc_id", *_PRINTS, "shingles"])

def _intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections."""
    n = len(sets)
    values = np.concatenate(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]
    fresh = np.concatenate([[True], values[1:] != values[:-1]])
    group = np.cumsum(fresh) - 1
    shared = np.bincount(group)[group] > 1               # shingles of one document alone add nothing
    group, owner = np.unique(group[shared], return_inverse=True)[1], owner[shared]
    total = np.zeros((n, n), np.float32)
    step = max(256, (8 << 20) // (4 * n))                 # columns held at once
    bounds = np.searchsorted(group, np.arange(0, (int(group[-1]) + 1 if len(group) else 0) + step, step))
    for k, (a, z) in enumerate(zip(bounds, bounds[1:])):
        held = np.zeros((n, step), np.float32)
        held[owner[a:z], group[a:z] - k * step] = 1
        total += held @ held.T
    return total.astype(np.int64)


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records with full sets to a spanning forest of their true links."""
    for b in batches:
        left, right = [], []
        for record in b.column(0):
            reps = [r.as_py() for r in record.values.field(0)]
            sets = [np.frombuffer(r.as_buffer(), U) for r in record.values.field(1)]
            size = np.array([len(s) for s in sets])
            if len(sets) == 2:
                both = len(np.intersect1d(*sets, assume_unique=True))
                inter = np.array([[size[0], both], [both, size[1]]])
            else:
                inter = _intersections(sets)
                np.fill_diagonal(inter, size)
            linked = 100 * inter >= SHARE * (size[:, None] + size[None, :] - inter)
            for g in _groups(linked):
                low = min(reps[i] for i in g)
                for i in g:
                    if reps[i] != low:
                        left.append(low)
                        right.append(reps[i])
        yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])


def _verified(docs: DataFrame, classes: DataFrame, records: DataFrame) -> DataFrame:
    """(a, b): true links that span what each record (members) holds."""
    records = staged(records.distinct().withColumn("record", F.xxhash64("members")), "records")
    members = records.select("record", F.size("members").alias("n"), F.explode("members").alias("rep"))
    active = staged(members.select("rep").distinct().join(classes.select("rep", "doc_id", *_PRINTS), "rep"), "active")
    ids = staged(active.select("doc_id").distinct(), "active_ids")
    texts = docs.join(small(ids), "doc_id", "left_semi").select("doc_id", "text")
    sets = texts.mapInArrow(_full_sets, "doc_id bigint, print_a bigint, print_b bigint, shingles binary")
    # rows that repeat an id are told apart by what they hold
    sets = sets.join(small(active), ["doc_id", *_PRINTS]).select("rep", "shingles").dropDuplicates(["rep"])
    full = members.join(sets, "rep").groupBy("record", "n").agg(
        F.collect_list(F.struct("rep", "shingles")).alias("members")).select("members")
    out = staged(full.mapInArrow(_verify, "a bigint, b bigint").distinct(), "links")
    discard(records, active, ids)
    return out


def near_links(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b): verified links that span the components of the classes.

    ``docs``: doc_id, text. ``classes``, staged: rep (its number), doc_id, prints, tokens, n_shingles.
    """
    roots = classes.select("rep", F.posexplode(F.slice("tokens", 1, TREES)).alias("tree", "value"))
    members = _sized(roots.select("tree", F.xxhash64("tree", "value").alias("node"), "rep"))
    large = members.where((F.col("n") > FIT) & (F.col("tree") < PIVOT_TREES)).select("node", "rep")
    links = pivot_links(docs, classes, large) if large.limit(1).count() else None
    comp = staged(_named(components(links)), "linked") if links is not None else None
    nodes = fitting_nodes(members, comp, classes)
    if comp is not None:
        nodes = nodes.join(small(comp), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    else:
        nodes = nodes.withColumn("component", F.col("rep"))
    held = nodes.join(classes.select("rep", "n_shingles", "tokens"), "rep")
    lists = held.groupBy("tree", "level", "node").agg(
        F.collect_list(F.struct("rep", "component", "n_shingles", "tokens")).alias("members"))
    found = _verified(docs, classes, lists.select("tree", "level", "node", "members").mapInArrow(
        _records(LEAF, STRAYS), "members array<bigint>"))
    discard(members, *([comp] if comp is not None else []))
    return found if links is None else links.union(found)


def _decided(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, h (of the text), n_shingles, component_id of every row."""
    two = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    thin = staged(two.select("doc_id", text_hash("text").alias("h"), "text").mapInArrow(_describe, _SETS), "sets")
    known = thin.where("n_shingles > 0 and doc_id is not null")
    classes = known.groupBy(*_PRINTS).agg(
        F.min("doc_id").alias("doc_id"), F.first("tokens").alias("tokens"), F.first("n_shingles").alias("n_shingles"))
    # numbered once and stored: ids can repeat, numbers cannot
    classes = staged(classes.select(F.monotonically_increasing_id().alias("rep"), "*"), "classes")
    comp = staged(_named(components(near_links(two, classes))), "components")
    named = classes.select(*_PRINTS, "rep", "doc_id").join(small(comp), "rep", "left").withColumn(
        "component", F.coalesce("component", "rep"))
    named = staged(named.select(*_PRINTS, "component", "doc_id"), "named")
    # the smallest id of a component, which only groups of several classes need a shuffle for
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    least = staged(named.join(least, "component").select(*_PRINTS, "component_id"), "least")
    linked = known.join(least, _PRINTS).select("doc_id", "h", "n_shingles", "component_id")
    alone = thin.where("n_shingles = 0 or doc_id is null").select(
        "doc_id", "h", "n_shingles", F.col("doc_id").alias("component_id"))
    discard(classes, comp, named)
    return linked.union(alone)


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row of ``docs``."""
    return _decided(docs, id_col, text_col).select(
        "doc_id", "n_shingles", "component_id", F.col("component_id").eqNullSafe(F.col("doc_id")).alias("kept"))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents of a component but its first; all columns stay."""
    rows = staged(_decided(docs.select("doc_id", "text"), "doc_id", "text"), "decided")
    # of rows that repeat the component's id with different texts, one stays; an empty set is linked with nothing
    first = rows.where("doc_id = component_id and n_shingles > 0").groupBy("component_id").agg(F.min("h").alias("first"))
    gone = rows.where("doc_id is not null and n_shingles > 0").join(first, "component_id").where(
        "doc_id <> component_id or h <> first").select("doc_id", "h").distinct()
    return without(docs, staged(gone, "dropped"), rows)
