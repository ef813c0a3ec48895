"""Tokenisers against their libraries, token files against round trips, packing against its rules."""

import base64
import collections
import random
import zlib

import hypothesis.strategies as st
import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import tiktoken
from hypothesis import given, settings
from llm_data import edge_docs, edge_rows, no_docs, prose, some_docs
from tokenizers import Tokenizer

from siglake.llm import bpe, packing, token_files, tokens
from siglake.llm.common import string_buffers

JSON, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(JSON)
    t.encode_special_tokens = True
    return lambda x: t.encode(x, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def tree():
    return bpe.tree_encoder(RANKS, P.PATTERN)


@pytest.fixture(scope="module")
def reference(tree):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=tree.ranks, special_tokens={}).encode_ordinary


ODD = ["", " ", "\n\n  a", "x's 'll !'s", "a b  c", "\x1c\x1d a\x85b", "²½ ٣ x²", "é́ ñ", "日本語 テキスト", " " * 300 + "x" + "\t" * 5,
       "'s's'S", "😀😀", "<|endoftext|> hi", "_foo__bar 12ab3", "'", "''s", "'re", "'r", "x'llo", "\n's\n'tt 's", "'d 'd1"]
TEXT = st.text(st.sampled_from(list("ab 's'tre ld\n\t1²é　\xa0,.'v\x1c")) | st.characters(codec="utf-8"), max_size=80)


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=4))
def test_array_split_equals_the_pattern(texts):
    enc = tokens.library_encoder(JSON, P.PATTERN)
    data, off = string_buffers(pa.array(texts))
    starts = enc._pieces(data, off).tolist()
    raw = data.tobytes()
    got = [raw[a:b].decode() for a, b in zip(starts, [*starts[1:], len(raw)])]
    find = tokens.splitter(P.PATTERN)
    assert got == [p for t in texts for p in find(t)]


@settings(max_examples=150, deadline=None)
@given(TEXT)
def test_encoders_equal_their_libraries(tree, library, reference, text):
    data, off = string_buffers(pa.array([text]))
    assert tokens.library_encoder(JSON, P.PATTERN)(data, off)[0].tolist() == library(text)
    ids = tree.encode(text)
    assert ids.tolist() == reference(text)
    assert tree.decode(ids) == text.encode()


def test_long_pieces_and_boundaries(tree, library, reference):
    r = random.Random(1)
    texts = ODD + ["ab" * 4000, "a" * 5000 + "b", "z" * 9001, "".join(r.choice("ab") for _ in range(6000)),
                   "".join(r.choice("abcdeé日 '1") for _ in range(20000)), prose(3000, 4)]
    data, off = string_buffers(pa.array(texts))
    ids, row = tree.batch(data, off)
    lib, lib_row = tokens.library_encoder(JSON, P.PATTERN)(data, off)
    for i, t in enumerate(texts):
        assert ids[row[i]:row[i + 1]].tolist() == reference(t)
        assert lib[lib_row[i]:lib_row[i + 1]].tolist() == library(t)


def test_every_token_encodes_to_itself(tree):
    """What the join's proof rests on."""
    assert all(bpe_merge(tree, t) == [i] for t, i in list(tree.ranks.items())[::7])


def bpe_merge(tree, text):
    ranks = tree.ranks
    parts = [text[i:i + 1] for i in range(len(text))]
    while len(parts) > 1:
        best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], 1 << 30))
        if parts[best] + parts[best + 1] not in ranks:
            break
        parts[best:best + 2] = [parts[best] + parts[best + 1]]
    return [ranks[p] for p in parts]


@settings(max_examples=150, deadline=None)
@given(st.binary(max_size=60), st.binary(max_size=60))
def test_join_is_the_encoding_of_the_concatenation(tree, a, b):
    assert tree.join(tree.encode_bytes(a), tree.encode_bytes(b)) == (bpe_merge(tree, a + b) if a + b else [])


def test_other_patterns_and_full_tables(tree, reference, monkeypatch):
    own = tokens.BatchEncoder(r"\s+|\S+", tree.encode_bytes)
    data, off = string_buffers(pa.array(["a b\tc", "", "dd  e"]))
    assert own(data, off)[1].tolist()[0] == 0
    monkeypatch.setattr(tokens, "POOL_IDS", 5)
    small = tokens.BatchEncoder(P.PATTERN, tree.encode_bytes)
    for t in ("one two three four", "five six", "one two"):
        d, o = string_buffers(pa.array([t]))
        assert small(d, o)[0].tolist() == reference(t)


def test_round_trip_query(spark, reference):
    rows = {r.doc_id: r for r in bpe.round_trip(edge_docs(spark), RANKS, P.PATTERN, keep_ids=True).collect()}
    for i, text, *_ in edge_rows():
        if i is not None:
            assert np.frombuffer(rows[i].ids, "<u4").tolist() == reference(text or "")
            assert rows[i].n_tokens == len(rows[i].ids) // 4
    assert bpe.round_trip(no_docs(spark), RANKS, P.PATTERN).count() == 0


# --------------------------------------------------------------- token files

@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(0, 60000) | st.integers(0, 2**32 - 1), max_size=700), max_size=4), st.data())
def test_segment_round_trip(docs, data):
    raw = token_files.encode_segment(list(range(len(docs))), [np.array(d, "<u4").tobytes() for d in docs])
    seg = token_files.Segment(raw)
    every = [i for d in docs for i in d]
    assert seg.all_ids().tolist() == every
    assert seg.ends.tolist() == np.cumsum([len(d) for d in docs]).tolist()
    lo = data.draw(st.integers(0, len(every)))
    hi = data.draw(st.integers(lo, len(every)))
    assert seg.ids(lo, hi).tolist() == every[lo:hi]


def test_exceptions_are_used():
    ids = np.full(2560, 5, "<u4")
    ids[::100] = 50000
    seg = token_files.Segment(token_files.encode_segment([1], [ids.tobytes()]))
    assert len(seg.values) > 0 and seg.width.max() < 16 and (seg.all_ids() == ids).all()


def test_files_hold_all_documents_in_order(spark, library, monkeypatch):
    monkeypatch.setattr(token_files, "SEGMENT_IDS", 200)
    df, rows = some_docs(spark, n=40)
    path = token_files.new_path(spark)
    token_files.write_tokens(df.repartition(5), path, JSON, P.PATTERN)
    got = token_files.read_tokens(spark, path, keep_ids=True).orderBy("start").collect()
    at = 0
    for g, r in zip(got, sorted(rows)):
        ids = library(r[1]) + [0]
        assert (g.doc_id, g.start, g.n_tokens) == (r[0], at, len(ids))
        assert np.frombuffer(g.ids, "<u4").tolist() == ids
        assert g.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    assert len(got) == len(rows) and spark.read.parquet(path).count() > 1


def test_files_edge_cases(spark):
    path = token_files.new_path(spark)
    token_files.write_tokens(edge_docs(spark), path, JSON, P.PATTERN)
    got = token_files.read_tokens(spark, path).orderBy("start").collect()
    assert [g.doc_id for g in got] == sorted((r[0] for r in edge_rows()), key=lambda i: (i is not None, i))
    assert {g.n_tokens for g in got if g.doc_id in (1, 2)} == {1}
    empty = token_files.new_path(spark)
    token_files.write_tokens(no_docs(spark), empty, JSON, P.PATTERN)
    assert token_files.read_tokens(spark, empty).count() == 0


# ------------------------------------------------------------------- packing

def check_plan(counts, capacity):
    used, cells = collections.Counter(), collections.defaultdict(list)
    for r in packing.plan(counts, capacity):
        assert r.rank == used[r.length]
        used[r.length] += r.n
        for i in range(r.n):
            cells[r.sequence + i].append((r.offset, r.length))
    assert used == collections.Counter(counts)
    for cell in cells.values():
        at = 0
        for offset, length in sorted(cell):
            assert offset == at
            at += length
        assert at <= capacity
    return len(cells)


def fewest(sizes, capacity):
    """Fewest bins by search (small instances)."""
    sizes, best = sorted(sizes, reverse=True), [len(sizes)]

    def put(i, rests):
        if len(rests) >= best[0]:
            return
        if i == len(sizes):
            best[0] = len(rests)
            return
        for r in sorted({x for x in rests if x >= sizes[i]}):
            nxt = list(rests)
            nxt[nxt.index(r)] -= sizes[i]
            put(i + 1, nxt)
        put(i + 1, [*rests, capacity - sizes[i]])
    put(0, [])
    return best[0]


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 20), st.integers(1, 3), min_size=1, max_size=5))
def test_plan_is_valid_and_close_to_the_fewest(counts):
    sizes = [s for s, n in counts.items() for _ in range(n)]
    got = check_plan(counts, 20)
    assert fewest(sizes[:9], 20) <= got <= -(-11 * fewest(sizes, 20) // 9) + 1 if len(sizes) <= 9 else True


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(6, 20), st.integers(1, 2), min_size=1, max_size=4))
def test_reduction_never_costs_a_sequence(counts):
    """Sets that the reduction fixes belong to some best packing."""
    p = packing._Plan(dict(counts), 20)
    p.reduce()
    rest = [s for s, n in p.left.items() for _ in range(n)]
    sizes = [s for s, n in counts.items() for _ in range(n)]
    assert p.sequences + (fewest(rest, 20) if rest else 0) == fewest(sizes, 20)


def test_large_counts_stay_small_plans():
    counts = {s: 10 ** 9 // s for s in range(1, 2049)}
    runs = packing.plan(counts, 2048)
    total = sum(s * n for s, n in counts.items())
    assert len(runs) < 60_000
    assert max(r.sequence + r.n for r in runs) <= 1.001 * total / 2048 + 1
    with pytest.raises(ValueError):
        packing.plan({2049: 1})


@pytest.mark.parametrize("bucket", [packing.BUCKET_ROWS, 3])
def test_documents_are_packed_whole(spark, library, monkeypatch, bucket):
    monkeypatch.setattr(packing, "BUCKET_ROWS", bucket)
    df, rows = some_docs(spark, n=50)
    got = packing.pack_documents(df, JSON, P.PATTERN, capacity=128).collect()
    by_doc, by_seq = collections.defaultdict(list), collections.defaultdict(list)
    for g in got:
        by_doc[g.doc_id].append(g)
        by_seq[g.sequence_id].append(g)
    for i, text, *_ in rows:
        ids = np.array(library(text) + [0], "<u4")
        pieces = sorted(by_doc[i], key=lambda g: g.piece)
        assert [p.piece for p in pieces] == list(range(len(pieces)))
        assert all(p.length == 128 for p in pieces[1:]) and sum(p.length for p in pieces) == len(ids)
        for p in pieces:
            assert zlib.crc32(ids[p.start:p.start + p.length].tobytes()) == p.ids_crc32
    for cell in by_seq.values():
        at = 0
        for g in sorted(cell, key=lambda g: g.offset):
            assert g.offset == at
            at += g.length
        assert at <= 128


def test_packing_edge_cases(spark):
    got = packing.pack_documents(edge_docs(spark), JSON, P.PATTERN).collect()
    ids = collections.Counter(g.doc_id for g in got if g.piece == 0)
    assert ids == collections.Counter(r[0] for r in edge_rows())
    assert len({(g.sequence_id, g.offset) for g in got}) == len(got)
    assert packing.pack_documents(no_docs(spark), JSON, P.PATTERN).count() == 0


def test_rank_file_is_read(tree):
    first = open(RANKS, "rb").readline().split()
    assert tree.ranks[base64.b64decode(first[0])] == int(first[1])


def test_pieces_are_built_by_joins_and_decoding_by_pairs(monkeypatch):
    """No piece of two tokens or more comes from one direct merge of it."""
    tree, joined = bpe.TreeBpe.load(P.path("byte_bpe_50k.tiktoken"), P.PATTERN), []
    join = bpe.TreeBpe.join
    monkeypatch.setattr(bpe.TreeBpe, "join", lambda self, a, b: joined.append((len(a), len(b))) or join(self, a, b))
    for piece in (b" thtionoues", b"xq", b"zzqk", " ünïcödé".encode(), b"x" * 300, b" 1234567890123"):
        joined.clear()
        tree.known.clear()
        ids = tree.encode_bytes(piece)
        assert len(ids) >= 2 and len(joined) >= 1
        assert (1, 1) in joined                       # up from single bytes
        assert tree.decode(np.array(ids)) == piece
    assert tree.decode(np.zeros(0, np.int64)) == b""
