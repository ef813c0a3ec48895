"""Exact and near de-duplication against brute force; recall; heavy groups."""

import collections
import hashlib
import re

import numpy as np
import pytest
from llm_data import edge_docs, edge_rows, no_docs, prose, some_docs

from siglake.llm import exact_dedup as X
from siglake.llm import near_dedup as N
from siglake.llm.common import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_exact(rows):
    groups = collections.defaultdict(list)
    for r in rows:
        t = r[1] or ""
        groups[hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", t).encode()).hexdigest()].append((r[0], len(t)))
    out = []
    for sha, members in groups.items():
        members.sort(key=lambda m: (-m[1], m[0] is None, m[0] or 0))
        best = members[0][0]
        # one row stays, also of rows that repeat the id and the text
        out += [(i, best, len(members), k == 0, sha) for k, (i, _) in enumerate(members)]
    return sorted(out, key=str)


@pytest.mark.parametrize("k", [2, 1024])
def test_exact_matches_brute_force(spark, k):
    df, rows = some_docs(spark, n=80)
    assert sorted(map(tuple, X.exact_dedup(df, k=k).collect()), key=str) == brute_exact(rows)


def test_exact_edge_cases(spark):
    got = X.exact_dedup(edge_docs(spark))
    assert sorted(map(tuple, got.collect()), key=str) == brute_exact(edge_rows())
    assert X.exact_dedup(no_docs(spark)).count() == 0
    kept = X.drop_copies(edge_docs(spark))
    assert kept.columns == edge_docs(spark).columns
    # 8 wins its group and stays once although the row repeats; null ids stay only where nothing beats them
    assert sorted(str(r[0]) for r in kept.select("doc_id").collect()) == sorted(
        str(b[0]) for b in brute_exact(edge_rows()) if b[3])


def test_rows_that_repeat_an_id_are_told_apart(spark):
    unique = "unique words here that no other row of the table holds at all"
    copy = "the very same words are held by two rows of the table here"
    rows = [(1, copy), (2, copy), (2, unique), (3, unique + " too"), (3, unique + " too"), (None, copy), (4, None), (4, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted(map(tuple, X.drop_copies(df).collect()), key=str) == sorted(
        [(1, copy), (2, unique), (3, unique + " too"), (4, None)], key=str)
    df = spark.createDataFrame(rows[:5], "doc_id bigint, text string")
    assert sorted(map(tuple, N.drop_near_copies(df).collect())) == [(1, copy), (2, unique)]
    got = sorted((r.doc_id, r.component_id, r.kept) for r in N.near_dedup(df).collect())
    assert got == [(1, 1, True), (2, 1, False), (2, 2, True), (3, 2, False), (3, 2, False)]


def test_longest_original_stays(spark):
    df = spark.createDataFrame([(1, "a b"), (2, "a  b"), (3, "a  b"), (4, "ab")], "doc_id bigint, text string")
    assert {r.keep_id for r in X.exact_dedup(df).collect()} == {2}


def test_heavy_hitters_are_found(spark):
    ids = [b"hot"] * 400 + [b"warm"] * 150 + [str(i).encode() for i in range(500)]
    df = spark.createDataFrame([(bytearray(i),) for i in ids], "d binary").repartition(7)
    got = {bytes(r[0]) for r in X.frequent(df, "d", k=8).collect()}
    assert {b"hot", b"warm"} <= got and len(got) <= 8
    merged = X._summarise({b"a": 9, b"b": 5, b"c": 4, b"d": 1}, 2)
    assert merged == {b"a": 5, b"b": 1}


# --------------------------------------------------------------------- near

def shingles(text):
    w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_near(rows):
    """id -> (set size, component) by comparing all pairs."""
    sets = collections.OrderedDict()
    for r in rows:
        sets.setdefault(r[0], shingles(r[1])) if r[0] is not None else None
    ids = list(sets)
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a in range(len(ids)):
        for b in range(a):
            x, y = sets[ids[a]], sets[ids[b]]
            both = len(x & y)
            if x and y and 100 * both >= 75 * (len(x) + len(y) - both):
                lo, hi = sorted((find(ids[a]), find(ids[b])))
                root[hi] = lo
    return {i: (len(sets[i]), find(i)) for i in ids}


def check_near(df, rows):
    expected = brute_near(rows)
    got = N.near_dedup(df).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == expected[r.doc_id]
            assert r.kept == (r.doc_id == r.component_id)


def test_near_matches_brute_force(spark):
    check_near(*some_docs(spark, seed=9, n=90))


def test_near_edge_cases(spark):
    check_near(edge_docs(spark), edge_rows())
    assert N.near_dedup(no_docs(spark)).count() == 0
    kept = N.drop_near_copies(edge_docs(spark))
    assert kept.columns == edge_docs(spark).columns
    ids = [r[0] for r in kept.select("doc_id").collect()]
    assert ids.count(8) == 1 and 9 not in ids and ids.count(None) == 2 and {1, 2, 3} <= set(ids)


def test_threshold_is_inclusive(spark):
    # 3 of 4 shingles in the union: exactly 75 percent
    base = "a b c d e f g".split()
    df = spark.createDataFrame([(1, " ".join(base)), (2, " ".join(base + ["h"])), (3, " ".join(base + ["h", "i"]))],
                               "doc_id bigint, text string")
    assert {r.doc_id: r.component_id for r in N.near_dedup(df).collect()} == {1: 1, 2: 1, 3: 1}


def test_large_nodes_branch_and_find_all_links(spark, monkeypatch):
    """A large group of near copies and a passage that many documents share: the tree goes below the roots."""
    monkeypatch.setattr(N, "LEAF", 12)
    base, passage = prose(120, 1).split(), prose(40, 2)
    rng = np.random.default_rng(3)
    rows = []
    for i in range(70):
        w = list(base)
        for at in rng.integers(0, len(w), rng.integers(0, 4)):
            w[at] = f"w{rng.integers(1_000_000)}"
        rows.append((i, " ".join(w)))
    rows += [(100 + i, prose(60, 1000 + i) + " " + passage) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    check_near(df, rows)


def test_intersections_equal_set_intersections():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 300, n).astype(np.uint64)) for n in (1, 5, 80, 200, 200, 40)]
    got = N._intersections(sets)
    for i in range(6):
        for j in range(i):
            assert got[i, j] == len(np.intersect1d(sets[i], sets[j]))


def test_token_share_estimates_similarity():
    rng = np.random.default_rng(4)
    errors = []
    for _ in range(200):
        both = rng.integers(0, 2**63, 150).astype(np.uint64)
        x = np.concatenate([both, rng.integers(0, 2**63, 25).astype(np.uint64)])
        y = np.concatenate([both, rng.integers(0, 2**63, 25).astype(np.uint64)])
        errors.append((N.minwise(x) == N.minwise(y)).mean() - 0.75)
    assert abs(np.mean(errors)) < 0.02 and min(errors) > -0.25


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 4), (10, 11), (12, 11), (7, 7), *((50 + i, 51 + i) for i in range(40)),
             *((0, 200 + i) for i in range(30))]
    got = {r[0]: r[1] for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 1 for i in (1, 2, 3, 4)}, **{i: 10 for i in (10, 11, 12)},
                   **{50 + i: 50 for i in range(41)}, **{0: 0}, **{200 + i: 0 for i in range(30)}}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def variants(n, shared, own, pairs, both, seed):
    """``n`` documents of one template of ``shared`` words and ``own`` words each; of the last ones, pairs share ``both``."""
    rng = np.random.default_rng(seed)
    head, rows = [f"t{k}" for k in range(shared)], []
    for i in range(n):
        words = [f"w{x}" for x in rng.integers(1 << 40, size=own)]
        if i >= n - 2 * pairs and (n - i) % 2:
            words[:both] = rows[-1][1].split()[shared:shared + both]
        rows.append((i, " ".join(head + words)))
    return rows


def test_pairs_in_a_group_below_the_threshold_are_found(spark, monkeypatch):
    """Variants of a template, 0.68 alike, with pairs of 0.8: no member but its pair is linked with any."""
    monkeypatch.setattr(N, "LEAF", 24)
    rows = variants(1500, 104, 24, 60, 12, 5)
    sets = [shingles(t) for _, t in rows]
    assert 0.66 < len(sets[0] & sets[1]) / len(sets[0] | sets[1]) < 0.7
    got = {r.doc_id: r.component_id for r in N.near_dedup(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    expected = {i: i - (1 if i >= 1380 and i % 2 else 0) for i, _ in rows}
    a, b = sets[1380], sets[1381]
    assert 100 * len(a & b) >= 78 * len(a | b)
    assert got == expected


def compared(tokens, seed, **limits):
    """(members of all leaves, pairs compared) of one node of ``tokens`` that no component is known of."""
    leaves = [len(leaf) for leaf in N.branch_in_task(3, 0, seed, tokens, np.arange(len(tokens)), np.ones(len(tokens)))]
    return sum(leaves), sum(n * (n - 1) // 2 for n in leaves)


def alike(n, share, seed):
    """Tokens of ``n`` sets that are ``share`` alike, each token held by the template with that chance's root."""
    rng = np.random.default_rng(seed)
    own = rng.integers(1 << 31, size=(n, N.COORDS))
    return np.where(rng.random((n, N.COORDS)) < np.sqrt(share), np.arange(N.COORDS), own)


def test_a_group_just_below_the_threshold_costs_in_proportion():
    """No link exists in a group that is 0.742 alike, and no estimate ends its branching."""
    small, large = (np.sum([compared(alike(n, 0.742, 1), s) for s in range(10)], 0) for n in (3000, 12_000))
    # four times the documents: the members of all leaves and the pairs compared grow little more than that
    assert large[0] < 5.5 * small[0] and large[1] < 5.5 * small[1]


def test_strays_are_held_against_a_whole_component():
    n = 5000
    component = np.zeros(n, np.int64)
    component[[5, 600, 4999]] = [1, 2, 3]
    pairs = set()
    for leaf in N.branch_in_task(0, 0, 1, alike(n, 0.9, 2), component, np.ones(n)):
        assert len(leaf) <= N.LEAF
        for stray in {5, 600, 4999} & set(leaf.tolist()):
            pairs |= {(stray, m) for m in leaf.tolist()}
    assert len(pairs) == 3 * n
    assert list(N.branch_in_task(0, 0, 1, alike(n, 0.9, 2), np.zeros(n, np.int64), np.ones(n))) == []


def test_nodes_without_fresh_tokens_are_compared_whole():
    n = 1500
    pairs = set()
    for leaf in N.branch_in_task(0, N.LEVELS, 1, alike(n, 0.9, 2), np.arange(n) // 2, np.ones(n)):
        pairs |= {(a, b) for a in leaf.tolist() for b in leaf.tolist() if a < b}
    # all pairs of different components, the main one's only members 0 and 1 with each other aside
    assert len(pairs) >= n * (n - 1) // 2 - n


def test_nodes_beyond_a_task_branch_by_shuffles(spark, monkeypatch):
    """The same results where nodes are too large to be gathered, pivots settle most, and few strays are left."""
    monkeypatch.setattr(N, "LEAF", 16)
    monkeypatch.setattr(N, "FIT", 60)
    monkeypatch.setattr(N, "STRAYS", 5)
    rows = variants(300, 104, 24, 20, 12, 6) + [(1000 + i, t + " " + prose(12, i)) for i, t in variants(200, 160, 8, 0, 0, 7)]
    check_near(spark.createDataFrame(rows, "doc_id bigint, text string"), rows)


def test_what_touches_a_large_alike_group_once_is_found(spark, monkeypatch):
    monkeypatch.setattr(N, "LEAF", 16)
    rng = np.random.default_rng(8)
    base, rows = [f"t{k}" for k in range(160)], []
    for i in range(600):
        w = list(base)
        w[rng.integers(160)] = f"x{i}"
        rows.append((i, " ".join(w)))
    for i in range(12):
        # at its end a member's own words; a further document keeps them and changes the beginning
        near = base[:144] + [f"y{i}_{k}" for k in range(16)]
        rows += [(1000 + i, " ".join(near)), (2000 + i, " ".join([f"z{i}_{k}" for k in range(18)] + near[18:]))]
    check_near(spark.createDataFrame(rows, "doc_id bigint, text string"), rows)
