"""Language ID, quality regression, quality rules and quotation linking."""

import collections
import re
import zlib

import numpy as np
import pyarrow as pa
from llm_data import edge_docs, edge_rows, no_docs, prose
from pyspark.sql import functions as F

from siglake.llm import langid as L
from siglake.llm import quality as Q
from siglake.llm import quotes, rules
from siglake.llm.common import string_buffers

SF = "/root/testdata/sf0.01"


# --------------------------------------------------------------- language ID

def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = L.label_languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    test = [r for r in got if r.held_out and r.lang and r.lang_pred != "und"]
    assert len(test) > 200 and sum(r.lang == r.lang_pred for r in test) / len(test) > 0.95


def test_language_does_not_read_label_source_or_id(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(200)
    net = L.train(docs)
    a = L.predict(docs, net)
    b = L.predict(docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None))
                  .withColumn("doc_id", F.col("doc_id") + 7), net)
    assert sorted((r[0] + 7, r[1], r[2]) for r in a.collect()) == sorted(map(tuple, b.collect()))


def test_language_edge_cases(spark):
    docs = edge_docs(spark)
    got = L.label_languages(docs).collect()
    assert collections.Counter(r.doc_id for r in got) == collections.Counter(r[0] for r in edge_rows())
    assert all(r.lang_pred == "und" and r.score == 0 for r in got if r.doc_id in (1, 2, 3, 10))
    assert all(r.lang_pred != "und" for r in got if r.doc_id in (4, 6, 11, 12))
    same = {r.doc_id: (r.lang_pred, r.score) for r in got}
    assert same[6] == same[7] and same[4] == same[5]
    assert L.label_languages(no_docs(spark)).count() == 0
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in L.label_languages(unlabelled).collect()} == {"und"}
    kept = L.drop_unknown(docs)
    assert kept.columns == docs.columns and not {1, 2, 3, 10} & {r.doc_id for r in kept.collect()}


def test_sample_is_bounded_and_covers_labels(spark):
    rows = [(i, prose(30, i), "en" if i % 10 else "fr") for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    got = L.training_windows(df, per_label=20)
    n = collections.Counter(label for label, _ in got)
    assert set(n) == {"en", "fr"} and max(n.values()) <= 20 * L.WINDOWS_PER_TEXT
    assert all(len(w) == L.WINDOW for _, w in got)
    assert got == L.training_windows(df.repartition(5), per_label=20)


def test_table_responses_equal_the_convolution():
    rng = np.random.default_rng(1)
    net = L.ByteConvNet(["a", "b"], {w: rng.normal(0, 1, (w, 256, L.FILTERS)).astype(np.float32) for w in L.WIDTHS},
                        rng.normal(0, 1, (L.FILTERS * len(L.WIDTHS), 2)), np.zeros(2))
    x = rng.integers(0, 256, (3, L.WINDOW)).astype(np.uint8)
    f = np.concatenate([net._responses(x, w).max(1) for w in L.WIDTHS], 1)
    logits = np.maximum(f, 0) @ net.dense
    p = np.exp(logits - logits.max(1, keepdims=True))
    assert np.allclose(net.probabilities(x, net.pair_tables()), p / p.sum(1, keepdims=True), atol=1e-4)


def test_windows_cover_every_byte():
    for n in (0, 1, 3, 512, 515, 516, 2000):
        row, start, end = L._tile(np.array([0, n, n + 700]))
        s = start[row == 0]
        assert s[0] == 0 and (np.diff(s) == L.POSITIONS).all()
        assert s[-1] + L.WINDOW >= n and (len(s) == 1 or s[-2] + L.WINDOW < n)


# ------------------------------------------------------------------- quality

def test_quality_held_out_selection(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rated = Q.rated(docs, labels, Q.label_grade())
    test = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = Q.train(rated.where(~test), Q.GRADES)
    assert (np.diff(model.thresholds) > 0).all()
    got = Q.score(docs, model, 2, 0.3).join(rated.where(test).select("doc_id", "grade"), "doc_id").collect()
    mean = {g: np.mean([r.expected_grade for r in got if r.grade == g]) for g in range(3)}
    assert mean[0] < mean[2] and mean[1] < mean[2]
    assert np.mean([r.kept for r in got if r.grade == 2]) > 0.9


def test_quality_fit_recovers_an_order():
    rng = np.random.default_rng(0)
    rows, grades = [], []
    for _ in range(900):
        x = rng.random(20) < 0.3
        s = 3.0 * x[0] - 3.0 * x[1] + rng.logistic()
        rows.append((np.flatnonzero(x), np.ones(x.sum())))
        grades.append(int(s > -1) + int(s > 1))
    m = Q.CumulativeLink(np.zeros(1 << Q.BITS), np.array([-0.5, 0.5])).fit(rows, np.array(grades))
    assert m.weights[0] > 1 and m.weights[1] < -1 and np.abs(m.weights[2:20]).max() < 1
    tails = m.tails(np.array([-2.0, 0.0, 2.0]))
    assert (tails[:, 0] >= tails[:, 1]).all() and (np.diff(tails[:, 0]) > 0).all()


def test_quality_edge_cases(spark):
    docs = edge_docs(spark)
    labels = spark.createDataFrame([(6, 1, 0), (8, 0, 0), (8, 1, 0), (None, 1, 0), (9, None, None), (999, 1, 1)],
                                   "doc_id bigint, quality int, toxic int")
    rated = Q.rated(docs, labels, Q.label_grade())
    assert sorted((r.doc_id, r.grade) for r in rated.collect()) == [(6, 2), (8, 1), (8, 1)]
    got = Q.score(docs, Q.train(rated, Q.GRADES), 2, 0.3).collect()
    assert collections.Counter(r.doc_id for r in got) == collections.Counter(r[0] for r in edge_rows())
    assert len({r.tail_prob for r in got if r.doc_id in (1, 2, 3)}) == 1
    none = Q.train(rated.where("false"), Q.GRADES)
    assert not none.weights.any() and Q.score(no_docs(spark), none, 2, 0.3).count() == 0


def test_quality_features_are_whole_text():
    d, o = string_buffers(pa.array([prose(5000, 1), "A a a", None]))
    ends, f, v = Q.features(d, o)
    assert len(ends) == 4 and ends[3] == ends[2]
    words = set(prose(5000, 1).split())
    assert ends[1] >= len(words)


# --------------------------------------------------------------------- rules

def brute(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, again, n_lines = set(), 0, 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            n_lines += 1
            again += line in seen
            seen.add(line)
    grams = collections.Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    hit = {k for i in range(len(w) - 2) if grams[tuple(w[i:i + 3])] > 1 for k in (i, i + 1, i + 2)}
    n, chars, symbols = len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text))
    failed = n < 50 or 100 * len(hit) > 50 * n
    upper, lower = len(re.findall("[A-Z]", text)), len(re.findall("[a-z]", text))
    lettered = sum(bool(re.search(r"[A-Za-z]|[^\x00-\x7F]", x)) for x in w)
    bad = (10 * max(collections.Counter(w).values(), default=0) > 3 * n or 2 * again > n_lines or chars < 2 * n
           or chars > 20 * n or 10 * lettered < 7 * n or 10 * symbols > 3 * n or 4 * upper > 6 * lower
           or 2 * len(re.findall("[!?]", text)) > n)
    return n, chars, symbols, again, len(hit), failed, not failed and not bad


def rule_texts():
    body = prose(120, 1)
    return [r[1] for r in edge_rows()] + [
        body, body.upper(), body.replace(" ", "! "), body.replace(" ", "# "), "\n".join([body] * 3),
        "\n".join(f"{prose(8, i % 4)}" for i in range(40)), " ".join("1234" for _ in range(10)) + " 9 8 7 " * 60,
        " ".join(f"a{i}" for i in range(70)), " ".join(chr(0x4E00 + i) for i in range(70)), "é " * 30 + body,
        body + "\n\n \n\r\n" + body, " ".join("x" * 30 + str(i) for i in range(60))]


def test_rules_match_brute_force(spark):
    texts = rule_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    for r in rules.cascade(df).collect():
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed, r.kept) == \
            brute(texts[r.doc_id]), texts[r.doc_id][:60]


def test_cascade_short_circuits_and_order_does_not_matter(spark):
    texts = rule_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    every = rules.cascade(df).collect()
    turned = {r.doc_id: r.kept for r in rules.cascade(df, dict(reversed(rules.RULES.items()))).collect()}
    assert turned == {r.doc_id: r.kept for r in every}
    for r in every:
        if r.base_failed:
            assert r.n_rules == 0
        elif r.kept:
            assert r.n_rules == len(rules.RULES)
        else:
            assert 1 <= r.n_rules <= len(rules.RULES)


def test_rules_are_ordered_by_rejections_per_cost():
    import time
    texts = [prose(60, i) for i in range(50)]

    def often(t):
        return np.arange(len(t.n_words)) % 2 == 0

    def rarely(t):
        return np.arange(len(t.n_words)) % 25 == 0

    def dear(t):
        time.sleep(0.05)
        return often(t)
    order = [n for n, _, _ in rules.measure(texts, {"rarely": rarely, "dear": dear, "often": often})]
    assert order == ["often", "rarely", "dear"] and len(rules.measure([])) == len(rules.RULES)


def test_rules_edge_cases(spark):
    got = rules.cascade(edge_docs(spark)).collect()
    assert collections.Counter(r.doc_id for r in got) == collections.Counter(r[0] for r in edge_rows())
    assert rules.cascade(no_docs(spark)).count() == 0


# -------------------------------------------------------------------- quotes

CHAT = [
    (1, 0, "user", "How do I cook rice for ten people?\n\nI only have one small pot."),
    (1, 1, "assistant", "Use two batches and keep the first one warm."),
    (1, 2, "user", "> Use two batches and keep\n> the first one warm.\nHow long does each batch take?"),
    (1, 3, "assistant", "Ann wrote:\n> > Use two batches and keep the first one warm.\n> How long does each batch take?\n"
                        "About twenty minutes."),
    (1, 4, "user", "> I only have one SMALL pot!\nA large one came today."),
    (1, 5, "user", "> nobody ever said these words here\nNew question about beans."),
    (2, 0, "user", "> Use two batches and keep the first one warm.\nA quote from elsewhere."),
    (2, 1, "user", "Something said only later in time"), (2, 2, None, None),
]


def chat(spark, rows=CHAT):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


def test_quotes_link_to_their_originals(spark):
    got = {(r.conv_id, r.turn): r for r in quotes.link_quotations(chat(spark)).collect()}
    assert len(got) == len(CHAT)
    reply = {k: r.reply_to for k, r in got.items()}
    assert reply == {(1, 0): None, (1, 1): None, (1, 2): 1, (1, 3): 2, (1, 4): 0, (1, 5): None, (2, 0): None, (2, 1): None,
                     (2, 2): None}
    assert got[1, 3].text == "About twenty minutes." and got[1, 3].max_level == 2 and got[1, 3].n_quotes == 2
    assert (got[1, 3].thread, got[1, 3].depth) == (1, 2) and (got[1, 4].thread, got[1, 4].depth) == (0, 1)
    assert not any(">" in r.text for r in got.values())
    rows = quotes.chat_rows(quotes.link_quotations(chat(spark))).where("conv_id = 2 and turn = 2").collect()
    assert rows[0].message == "<|unknown|>\n"


def test_quote_levels():
    assert [(lv, lines) for lv, lines in quotes.passages("a\n> b\n>> c\n> > d\ne > f")] == [
        (0, ["a"]), (1, ["b"]), (2, ["c", "d"]), (0, ["e > f"])]


def test_long_reply_chains_settle(spark):
    rows = [(1, 0, "u", prose(12, 0))]
    rows += [(1, i, "u", "> " + prose(12, i - 1) + "\n" + prose(12, i)) for i in range(1, 70)]
    got = {r.turn: r for r in quotes.link_quotations(chat(spark, rows)).collect()}
    assert all(got[i].reply_to == i - 1 and got[i].thread == 0 and got[i].depth == i for i in range(1, 70))


def test_quotes_edge_cases(spark):
    rows = [(None, 1, "u", "> alpha beta gamma"), (1, None, "u", "alpha beta gamma"), (1, 1, "u", "alpha beta gamma"),
            (1, 1, "u", "alpha beta gamma"), (1, 2, "u", "> alpha beta gamma"), (1, 2, "u", "> alpha beta gamma"),
            (1, 3, "u", "> " * 40 + "deep words go here"), (1, 4, "u", "x" * 100_000), (1, 5, "u", "> \n>\n>>")]
    df = chat(spark, rows).withColumn("key", F.lit(1)).withColumn("origin", F.lit(2))
    got = quotes.link_quotations(df).collect()
    assert len(got) == len(rows)
    assert [r.reply_to for r in got if r.turn == 2] == [1, 1]
    assert all(r.reply_to is None for r in got if r.turn != 2)
    assert max(r.max_level for r in got) == 40
    assert quotes.link_quotations(chat(spark, [])).count() == 0


def test_hash_thresholds_at_any_size():
    from siglake.llm.common import hash_threshold
    for n in (1000, 10**6, 10**11, 10**15):
        share = (hash_threshold(700, n) + 2**63) / 2**64
        assert abs(share - min(1, 1.3 * 700 / n)) <= 1e-15 + 1e-6 * share
    assert hash_threshold(700, 0) == hash_threshold(700, 700) == 2**63 - 1


def test_timing_sample_is_bounded_whatever_repeats(spark):
    rows = [(i, "hot text of many rows" if i % 3 == 0 else f"text {i}") for i in range(6000)] + [(7, "row seven again")] * 900
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = rules.sample_texts(df, rows=500)
    assert len(got) <= 500 and got.count("hot text of many rows") < 250
    assert len(set(got)) > 200


def test_language_filter_drops_foreign_and_junk_texts(spark):
    import random
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    r = random.Random(1)
    planted = [" ".join("".join(chr(r.randint(0x430, 0x44F)) for _ in range(r.randint(2, 9))) for _ in range(60)) for _ in range(10)]
    planted += ["".join(chr(r.randint(33, 126)) for _ in range(600)) for _ in range(10)]
    planted += ["".join(chr(r.randint(0x4E00, 0x9FA5)) for _ in range(200)) for _ in range(10)] + ["12 34 -- 56"] * 3
    more = spark.createDataFrame([(10**6 + i, t, None, "x", len(t)) for i, t in enumerate(planted)], docs.schema)
    both = docs.union(more)
    kept = [x[0] for x in L.drop_unknown(both).select("doc_id").collect()]
    assert sum(i >= 10**6 for i in kept) <= 2                      # of 33
    assert sum(i < 10**6 for i in kept) >= 0.995 * docs.count()
    english = L.drop_unknown(both, languages=["en"]).groupBy("lang").count().collect()
    assert sum(x["count"] for x in english if x["lang"] == "en") >= 0.98 * sum(x["count"] for x in english)


def test_language_filter_threshold_comes_from_all_held_out_texts(spark, monkeypatch):
    rows = [(i, f"{(0.3 + 0.6 * zlib.crc32(b'%d' % i) / 2**32):.9f}", "en" if i % 5 else None) for i in range(24_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(4)
    net = L.ByteConvNet(["en"], {}, np.zeros((0, 1)), np.zeros(1))
    for name in ("train", "train_whole"):
        monkeypatch.setattr(L, name, lambda *a, **k: net, raising=False)
    monkeypatch.setattr(L, "predict", lambda d, net: d.select("doc_id", F.lit("en").alias("lang_pred"),
                                                              F.col("text").cast("double").alias("score")))
    held = [float(t) for i, t, lang in rows if lang and zlib.crc32(str(i).encode()) % 3 == 1]
    least = np.quantile(held, L.LOST)
    kept = {x[0] for x in L.drop_unknown(docs).select("doc_id").collect()}
    assert len(held) > 6000 and kept == {i for i, t, _ in rows if float(t) >= least}


def test_language_filter_learns_from_texts_outside_the_starting_sample(spark):
    import random
    from siglake.llm.common import hash_threshold
    r = random.Random(3)

    def greek():
        return " ".join("".join(chr(r.randint(0x3B1, 0x3C9)) for _ in range(r.randint(2, 9))) for _ in range(60))

    ids = spark.range(3000).select("id", (~L.held_out("id")).alias("train"),
                                   (F.xxhash64("id") > hash_threshold(L.PER_LANGUAGE, 1900)).alias("outside")).collect()
    late = {i for i, train, outside in ids if train and outside}
    late = set(sorted(late)[:120])                                 # Greek is met in none of the sampled texts
    rows = [(i, greek() if i in late else prose(60, i), "xx", "a", 1) for i, *_ in ids]
    rows += [(10**6 + i, greek(), None, "a", 1) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert not any(b"\xce" in w or b"\xcf" in w for _, w in L.training_windows(docs.where(~L.held_out() & (F.col("lang") == "xx"))))
    kept = {x[0] for x in L.drop_unknown(docs, least=L.LEAST_SCORE).select("doc_id").collect()}
    assert len(late) == 120 and len(late & kept) >= 114 and sum(i >= 10**6 for i in kept) >= 19


def test_whole_training_is_the_same_however_rows_are_dealt(spark, monkeypatch):
    monkeypatch.setattr(L, "SHARD_BYTES", 1 << 14)
    rows = [(i, prose(r, i) if r else ("" if i % 2 else None), ["en", "fr", None][i % 3]) for i, r in
            enumerate([40, 0, 200, 700, 90, 0] * 30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    a, b = L.train_whole(docs), L.train_whole(docs.repartition(5))
    start = L._fitted(L.training_windows(docs), a.labels, 7)
    assert a.labels == b.labels == ["en", "fr", "und"]
    assert all((p == q).all() for p, q in zip(a.params(), b.params()))
    assert not any((p == q).all() for p, q in zip(a.params(), start.params()))
    assert L.train_whole(docs.where("lang is null")).labels == []


def test_value_at_any_place(spark):
    from siglake.llm.common import value_at
    for values in ([0.5], [1.0] * 900 + [5e-324] * 100, [x / 7 for x in range(-5000, 5000)], [0.25, 1.0, 1.0, 1.0, None]):
        df = spark.createDataFrame([(x,) for x in values], "x double").repartition(3)
        known = sorted(x for x in values if x is not None)
        for place in {0, len(known) // 3, len(known) - 1}:
            assert value_at(df, "x", place) == known[place]


def brute_replies(rows):
    """(conv, turn) -> message answered; a message quotes the one before it, and every third the two before."""
    def words(t):
        return tuple(re.findall(r"\w+", t.lower()))
    out = {}
    convs = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        convs[conv].append((turn, text or ""))
    for conv, messages in convs.items():
        messages.sort()
        held = [(t, words(x), {words(p) for p in [x, *re.split(r"\n\s*\n", x), *x.split("\n")]}) for t, x in messages]
        for k in range(1, len(held)):
            turn, quoted = held[k][0], held[k - 1][1]
            if len(quoted) >= 3:
                out[conv, turn] = next(t for t, _, parts in held[:k] if quoted in parts)
            elif quoted:
                out[conv, turn] = max(t for t, whole, _ in held[:k] if whole == quoted)
            elif k > 1 and (k + 1) % 3 == 0 and held[k - 2][1]:
                deeper = held[k - 2][1]
                out[conv, turn] = (next(t for t, _, parts in held[:k] if deeper in parts) if len(deeper) >= 3
                                   else max(t for t, whole, _ in held[:k] if whole == deeper))
    return out


def check_quoting(df):
    rows = [tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()]
    expected = brute_replies(rows)
    got = {(r.conv_id, r.turn): r for r in quotes.link_quotations(quotes.quoting(df)).collect()}
    assert {k: r.reply_to for k, r in got.items() if r.reply_to is not None} == expected
    for (conv, turn), r in got.items():
        at, depth = turn, 0
        while (conv, at) in expected:
            at, depth = expected[conv, at], depth + 1
        assert (r.thread, r.depth) == (at, depth)
    assert {k: r.text for k, r in got.items()} == {(c, t): (x or "").strip() for c, t, _, x in rows}
    return len(expected)


def test_quoting_messages_of_the_conversations_are_linked(spark):
    assert check_quoting(spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")) > 300


def test_short_answers_are_linked_to_the_nearest_equal_message(spark):
    rows = [(1, 0, "user", "Yes, please"), (1, 1, "a", "OK"), (1, 2, "user", "What is the price of it?"), (1, 3, "a", "OK"),
            (1, 4, "user", "ok"), (1, 5, "a", "Yes, please"), (1, 6, "user", "..."), (1, 7, "a", "It is ten"), (2, 0, "user", "OK"),
            (2, 1, "a", None), (2, 2, "user", "A longer message of words"), (2, 3, "a", "A longer message of words")]
    assert check_quoting(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")) >= 8
