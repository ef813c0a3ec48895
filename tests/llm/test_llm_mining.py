"""Phrase collocations, the conversation trie and the license scan against brute force."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from llm_data import edge_docs, edge_rows, no_docs, prose

from siglake.llm import license_scan as L
from siglake.llm import phrases as P
from siglake.llm import prefix_trie as T

LOWER = {c: c + 32 for c in range(65, 91)}


# ------------------------------------------------------------------ phrases

def brute_phrases(rows, least=10, top=2000):
    """rows: (text, lang)"""
    f, n = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                f.update((lang, tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    found = {key: a for key, a in f.items() if a >= least and len(key[1]) > 1}
    out = collections.defaultdict(list)
    for (lang, gram), a in found.items():
        longer = [b for (o, g), b in found.items() if o == lang and len(g) == 3 > len(gram) and gram in (g[:2], g[1:])]
        if any(100 * b >= 50 * a for b in longer):
            continue
        cuts = [(1_000_000 * a * a // (f[lang, gram[:k]] * f[lang, gram[k:]]), k) for k in range(1, len(gram))]
        score, k = min(cuts)
        out[lang].append((-score, -a, " ".join(gram).encode(), f[lang, gram[:k]], f[lang, gram[k:]]))
    return {(lang, i + 1, p.decode(), -a, l, r, n[lang], -s)
            for lang, best in out.items() for i, (s, a, p, l, r) in enumerate(sorted(best)[:top])}


def phrase_rows(seed=1, n=700):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(9)] + ["Über", "naïve", "日本", "A\x00b", "#1"]
    rows = []
    for i in range(n):
        words = [r.choice(vocabulary) + r.choice(["", "", "", ",", ".", "\n", "! ", "\x0b"]) for _ in range(r.randint(0, 60))]
        rows.append((i, r.choice([" ", "\t", "  "]).join(words), r.choice(["en", "de", None]), "s", 0))
    return rows + [(100, None, "en", "s", 0), (101, "..!\n", "fr", "s", 0), (102, "rare words", "it", "s", 0),
                   (103, "w1 w2 w3 " * 2000, "en", "s", 0), (103, "w1 w2 w3 " * 2000, "en", "s", 0)]


def phrases_of(df, **kw):
    return {(r["lang"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"])
            for r in P.collocations(df, **kw).collect()}


def test_collocations_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(P, "SHARD_KEYS", 300)        # several filters of a task
    monkeypatch.setattr(P, "BLOCK_KEYS", 200)        # several blocks
    rows = phrase_rows()
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(5)
    expected = brute_phrases([(r[1], r[2]) for r in rows])
    assert len(expected) > 100 and phrases_of(df) == expected
    assert phrases_of(df, top=7) == brute_phrases([(r[1], r[2]) for r in rows], top=7)


def test_collocation_edge_cases(spark):
    rows = [(r[1], r[2]) for r in edge_rows() if r[0] != 6 and r[0] != 7]
    assert phrases_of(edge_docs(spark).where("doc_id is null or doc_id not in (6, 7)")) == brute_phrases(rows)
    assert phrases_of(no_docs(spark)) == set()


@pytest.mark.parametrize("width", [1, 2, 7, 21, 22, 32, 33, 42])
def test_filters_lose_nothing(width):
    rng = np.random.default_rng(width)
    keys = P.Keys(width)
    ids = rng.integers(0, 1 << width, (3000, 3))
    packed = keys.permute(*keys.pack(ids))
    count = rng.integers(1, 3, 3000)
    count[::50] = [255, 256, 1 << 40, 1 << 33, 300, 7] * 10
    f = P.QuotientFilter.of(keys.half, *packed, count)
    expected = collections.Counter()
    for i, c in zip(map(tuple, ids.tolist()), count.tolist()):
        expected[i] += c
    for bits in {0, min(3, keys.half - 1)}:
        got = {}
        for block, part in f.blocks(bits):
            back = P.QuotientFilter.load(memoryview(part.dump(bits)), keys.half, bits, block)
            got |= dict(zip(map(tuple, keys.unpack(*keys.restore(back.left, back.right)).tolist()), back.count.tolist()))
        assert got == expected
    twice = f.merge([f])
    assert np.array_equal(twice.count, 2 * f.count) and np.array_equal(twice.left, f.left)


def test_filters_are_compact():
    keys, rng = P.Keys(16), np.random.default_rng(0)
    f = P.QuotientFilter.of(keys.half, *keys.permute(*keys.pack(rng.integers(0, 1 << 16, (200_000, 3)))))
    assert len(f.dump(0)) < 8 * len(f)               # an id of 48 bits and a count of 64 in under 8 bytes


def test_words_of_equal_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(P, "span_hashes", lambda data, s, e: np.zeros(len(s), np.uint64))
    data = np.frombuffer(b"ab cd ab", np.uint8)
    at, place = P._distinct(data, np.array([0, 3, 6]), np.array([2, 5, 8]))
    assert place.tolist() == [0, 1, 0] and at.tolist() == [0, 1]


# --------------------------------------------------------------------- trie

def brute_trie(rows, every=100, most=6):
    convs = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            text = text or ""
            convs[c].append((turn is not None, turn or 0, role or "", hashlib.sha256(text.encode()).hexdigest(), text))
    own = {c: [(t[2], t[4]) for t in sorted(v)] for c, v in convs.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % most
        built[c] = own.get(c - c % every, [])[:h] + turns[h:]
    members = collections.defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = collections.Counter(k[:-1] for k in members if k)
    leaves, saved = collections.Counter(), collections.Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += k not in kids
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1]) if k else 0
    return sorted((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), kids[k], leaves[k], saved[k],
                   hashlib.sha256(",".join(map(str, sorted(c for c in m if len(built[c]) == len(k)))).encode()).hexdigest())
                  for k, m in members.items())


def check_trie(spark, rows):
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(3)
    got = T.conversation_trie(df)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[:2]) == brute_trie(rows)


def conversations(seed=0, n=120):
    r = random.Random(seed)
    rows = []
    for c in r.sample(range(100, 420), n):
        for turn in range(r.choice([1, 2, 3, 4, 9])):
            rows.append((c, turn, r.choice(["user", "user", None]), r.choice(["hi", "hello 日本", "", None, f"own {c} {turn}"])))
    return rows


def test_trie_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(T, "SPAN", 16)               # many shards of conversations
    monkeypatch.setattr(T, "DEPTHS", 3)              # and of places
    rows = conversations()
    # two equal long conversations, repeated and null places, null conversations
    rows += [(c, k, "user", f"long {k // 2}") for c in (1001, 1002, 1055) for k in range(40)]
    rows += [(1101, None, "user", "b"), (1101, None, "user", "a"), (1101, 3, "user", "x"), (1101, 3, "user", "x"),
             (None, 1, "user", "nowhere"), (-7, 0, "user", "hi"), (1201, 0, None, None)]
    check_trie(spark, rows)


def test_trie_of_nothing(spark):
    df = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert T.conversation_trie(df).count() == 0
    # all turns fall to an absent base: members and ends of the root alone
    lost = [c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 >= 1][:5]
    check_trie(spark, [(c, 0, "user", "gone") for c in lost])


def test_bitmaps_find_the_nodes_of_a_shard():
    conv = np.array([5, 5, 7, 7, 9])
    s = T.Shard(conv, np.array([0, 1, 0, 1, 0]), np.array([1, 2, 1, 3, 1]), np.array([1, 2, 1, 3, 1]))
    got = sorted((d, s.ids[m].tolist()) for d, m in s.walk(np.arange(3)))
    assert got == [(0, [5, 7, 9]), (1, [5]), (1, [7])]


# ------------------------------------------------------------------ licenses

def brute_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    found, labels = [], set()
    for phrase, label in (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")):
        p = phrase.split()
        at = [i for i in range(len(words)) if words[i:i + len(p)] == p]
        found += at
        labels |= {label} if at else set()
    return len(words), len(found), min(found, default=None), max(found, default=None), ",".join(sorted(labels))


TEXTS = [
    None, "", " ...", "Released under the MIT License.", "under the mit\n-- LICENSE under the Mit license",
    "Licensed under the Apache License, Version 2.0.", "CC BY-NC 4.0 and cc by by nc cc_by_nc", "cc by", "apache license version 3",
    "This work is licensed under the GNU General Public License, version 3.", "under the mit license" * 3,
    "x " * 50_000 + "under the mit license", "ünder the mit license, cc by ncé", "under the MIT licenses; version 2 of apache license",
    prose(300, 3) + " Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "its documentation files (the Software), to deal with the Software without any restriction " + prose(50, 4),
    "permission is hereby granted to enter", "we redistribute software under a public license, version 3 of which is gnu",
    "licensed under the GNU Lesser General Public License", "the general public is free of charge, licensed and in compliance",
    "This is free and unencumbered software, released into the public domain."]


def test_license_scan(spark):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(TEXTS)], "doc_id bigint, text string, labels string")
    # rarer in a corpus than in this list of notices
    got = {r.doc_id: r for r in L.scan_licenses(df.union(spark.range(300).selectExpr(
        "id + 1000", "'the of and to a in with this is by or not that any from use work'", "'x'"))).collect()}
    for i, t in enumerate(TEXTS):
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute_base(t), i
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) | {""} and 0 <= r.score <= 1
        assert (r.score > 0) == (r.labels != "")
    labels = {i: got[i].labels for i in range(len(TEXTS)) if got[i].labels != got[i].base_labels}
    assert labels == {9: "gpl-3", 14: "mit", 17: "lgpl", 19: "unlicense"}
    assert 0.75 <= got[14].score < 1 and got[9].score == 1
    assert not any(r.labels for i, r in got.items() if i >= 1000)


def test_license_scan_edge_cases(spark):
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.labels, r.score) for r in L.scan_licenses(edge_docs(spark)).collect()), key=str)
    assert got == sorted(((i, brute_base(t)[0], 0, "", 0.0) for i, t, *_ in edge_rows()), key=str)
    assert L.scan_licenses(no_docs(spark)).count() == 0


def test_every_place_of_a_base_phrase_is_found_whatever_the_anchor():
    r = random.Random(5)
    words = "under the mit license apache version 2 cc by nc other".split()
    for seed in range(60):
        text = " ".join(r.choice(words) for _ in range(80))
        index = L.Index({w: r.random() for w in words})
        held = index.vocabulary.at
        known = np.array([held.get(w, -1) for w in text.split()])
        at = np.flatnonzero(known >= 0)
        n, first, last, base, _, _ = index.scan(known[at], at)
        assert (n, first, last, ",".join(sorted(base))) == brute_base(text)[1:]
