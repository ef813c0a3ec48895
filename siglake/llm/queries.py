"""One query per operator, over its whole table, with production parameters.

``ORACLES`` holds DuckDB SQL for those that SQL can express; the others are held
against brute force, exact round trips or held-out accuracy in ``tests/llm``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siglake.llm import (bpe, exact_dedup, langid, license_scan, near_dedup, packing, phrases, prefix_trie, quality, quotes,
                         rules, substring, token_files)
from siglake.llm.common import documents
from siglake.session import shared_path

TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
KEEP_TAIL = 0.3          # least probability of a good text for the quality selection


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.label_languages(documents(spark, sf_dir))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    rated = quality.rated(docs, documents(spark, sf_dir, "labels"), quality.label_grade(), bound=quality.SAMPLE_ROWS)
    model = quality.train(rated, quality.GRADES)
    return quality.score(docs, model, tail=quality.GRADES - 1, keep_at=KEEP_TAIL)


def op4_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the given messages hold no quotes: each is sent with those before it quoted
    return quotes.link_quotations(quotes.quoting(documents(spark, sf_dir, "conversations")))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.repeated_passages(documents(spark, sf_dir))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    # n_rules depends on measured costs; the verdict does not
    return rules.cascade(documents(spark, sf_dir)).drop("n_rules")


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(documents(spark, sf_dir))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), public_tokenizers.path(TOKENIZER),
                                  public_tokenizers.PATTERN)


def op9_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = token_files.new_path(spark)
    token_files.write_tokens(documents(spark, sf_dir), out, public_tokenizers.path(TOKENIZER),
                             public_tokenizers.PATTERN)
    return token_files.read_tokens(spark, out)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(documents(spark, sf_dir), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(documents(spark, sf_dir, "conversations"))


def op13_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(documents(spark, sf_dir))


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_exact_dedup, op3_quality_classifier, op4_quotation_linking, op5_substring_dedup,
    op6_quality_rules, op7_minhash_near_dedup, op8_best_fit_packing, op9_token_files, op10_byte_bpe,
    op11_phrase_collocations, op12_conversation_trie, op13_license_scan)}

_SPACE = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]+"

ORACLES = {
    "op2_exact_dedup": rf"""
        WITH d AS (
          SELECT doc_id, length(coalesce(text, '')) AS n_points,
                 sha256(regexp_replace(coalesce(text, ''), '{_SPACE}', '', 'g')) AS text_sha256
          FROM documents),
        k AS (
          SELECT doc_id, text_sha256, count(*) OVER (PARTITION BY text_sha256) AS group_size,
                 first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n_points DESC, doc_id) AS keep_id
          FROM d)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM k""",
    "op6_quality_rules": rf"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
        s AS (
          SELECT doc_id, text, regexp_extract_all(text, '{_WORD}') AS words,
                 list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines,
                 length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
                 length(regexp_replace(text, '[^A-Z]', '', 'g')) AS upper_n,
                 length(regexp_replace(text, '[^a-z]', '', 'g')) AS lower_n,
                 length(regexp_replace(text, '[^!?]', '', 'g')) AS shout_n
          FROM d),
        w AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS pos FROM s),
        t AS (
          SELECT doc_id, pos, word, length(word) AS chars,
                 regexp_matches(word, '[A-Za-z]|[^\x00-\x7F]') AS lettered,
                 CASE WHEN lead(word, 2) OVER o IS NOT NULL
                      THEN word || ' ' || lead(word) OVER o || ' ' || lead(word, 2) OVER o END AS gram
          FROM w WINDOW o AS (PARTITION BY doc_id ORDER BY pos)),
        c AS (
          SELECT doc_id, pos, word, chars, lettered,
                 CASE WHEN gram IS NOT NULL THEN count(*) OVER (PARTITION BY doc_id, gram) ELSE 0 END AS seen,
                 count(*) OVER (PARTITION BY doc_id, word) AS same
          FROM t),
        r AS (SELECT *, max(seen) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS covered
              FROM c),
        a AS (
          SELECT doc_id, sum(chars) AS word_chars, count(*) FILTER (WHERE covered > 1) AS n_repeat_words,
                 count(*) FILTER (WHERE lettered) AS lettered, max(same) AS most
          FROM r GROUP BY doc_id),
        f AS (
          SELECT s.doc_id, len(words) AS n_words, coalesce(word_chars, 0) AS word_chars, n_symbols,
                 len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines,
                 coalesce(n_repeat_words, 0) AS n_repeat_words, upper_n, lower_n, shout_n, lettered, most
          FROM s LEFT JOIN a USING (doc_id))
        SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
               n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
               (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
               NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words
                    OR 10 * most > 3 * n_words OR 2 * n_dup_lines > n_lines
                    OR word_chars < 2 * n_words OR word_chars > 20 * n_words
                    OR 10 * lettered < 7 * n_words OR 10 * n_symbols > 3 * n_words
                    OR 4 * upper_n > 6 * lower_n OR 2 * shout_n > n_words) AS kept
        FROM f""",
    "op7_minhash_near_dedup": rf"""
        WITH RECURSIVE w AS (
          SELECT doc_id, regexp_extract_all(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '{_WORD}') AS words
          FROM documents),
        g AS (
          SELECT DISTINCT doc_id, CASE WHEN len(words) < 5 THEN array_to_string(words, ' ')
                                       ELSE array_to_string(words[i:i + 4], ' ') END AS shingle
          FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS i FROM w WHERE len(words) > 0)),
        n AS (SELECT doc_id, count(*) AS n_shingles FROM g GROUP BY doc_id),
        p AS (
          SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
          FROM g a JOIN g b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
        l AS (
          SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b
          WHERE 100 * common >= 75 * (x.n_shingles + y.n_shingles - common)),
        reach AS (
          SELECT doc_id AS a, doc_id AS b FROM documents
          UNION SELECT reach.a, l.b FROM reach JOIN l ON l.a = reach.b),
        c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
        SELECT c.doc_id, coalesce(n_shingles, 0) AS n_shingles, component_id, c.doc_id = component_id AS kept
        FROM c LEFT JOIN n ON n.doc_id = c.doc_id""",
    "op11_phrase_collocations": r"""
        WITH t AS (
          SELECT row_number() OVER () AS row, coalesce(lang, 'und') AS lang,
                 translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
          FROM documents),
        p AS (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM t),
        w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p),
        g AS (
          SELECT lang, words[i:i + k - 1] AS gram
          FROM (SELECT lang, words, k, unnest(range(1, len(words) - k + 2)) AS i
                FROM w, (SELECT unnest([1, 2, 3]) AS k))),
        f AS (SELECT lang, gram, count(*) AS a FROM g GROUP BY ALL),
        s AS (SELECT lang, sum(a) AS n FROM f WHERE len(gram) = 1 GROUP BY lang),
        c AS (SELECT lang, gram, a FROM f WHERE a >= 10 AND len(gram) > 1),
        cut AS (
          SELECT c.lang, c.gram, c.a, k, x.a AS l, y.a AS r,
                 1000000::HUGEINT * c.a * c.a // (x.a::HUGEINT * y.a) AS score
          FROM (SELECT *, unnest(range(1, len(gram))) AS k FROM c) c
          JOIN f x ON x.lang = c.lang AND x.gram = c.gram[1:k]
          JOIN f y ON y.lang = c.lang AND y.gram = c.gram[k + 1:]),
        best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, gram ORDER BY score, k) = 1),
        inside AS (
          SELECT lang, part, max(a) AS longest
          FROM (SELECT lang, unnest([gram[1:2], gram[2:3]]) AS part, a FROM c WHERE len(gram) = 3) GROUP BY ALL),
        kept AS (
          SELECT best.lang, array_to_string(gram, ' ') AS phrase, a, l, r, score
          FROM best LEFT JOIN inside ON inside.lang = best.lang AND inside.part = best.gram
          WHERE longest IS NULL OR 100 * longest < 50 * a),
        ranked AS (
          SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
        SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score
        FROM ranked JOIN s USING (lang) WHERE rank <= 2000""",
    "op12_conversation_trie": r"""
        WITH t AS (
          SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                 row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                                    sha256(coalesce(text, ''))) AS pos
          FROM conversations WHERE conv_id IS NOT NULL),
        crc AS (  -- the usual table-less form: 8 shifts for each byte
          SELECT c AS conv_id, c - c % 100 AS base, own,
                 xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
                   lambda v, x: list_reduce(list_prepend(xor(v, x), [1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[]),
                     lambda u, i: CASE WHEN u & 1 = 1 THEN xor(u >> 1, 3988292384) ELSE u >> 1 END)), 4294967295) % 6 AS h
          FROM (SELECT conv_id AS c, max(pos) AS own FROM t GROUP BY conv_id)),
        m AS (SELECT a.conv_id, a.base, a.own, a.h, least(a.h, coalesce(b.own, 0)) AS taken
              FROM crc a LEFT JOIN crc b ON b.conv_id = a.base),
        r AS (
          SELECT m.conv_id, t.pos, role, text FROM m JOIN t ON t.conv_id = m.base AND t.pos <= m.taken
          UNION ALL
          SELECT m.conv_id, t.pos - m.h + m.taken, role, text FROM m JOIN t ON t.conv_id = m.conv_id AND t.pos > m.h),
        size AS (SELECT conv_id, taken + greatest(own - h, 0) AS size FROM m),
        k AS (
          SELECT conv_id, pos, length(text) AS chars,
                 list(sha256(role || chr(31) || sha256(text))) OVER (PARTITION BY conv_id ORDER BY pos) AS path
          FROM r UNION ALL SELECT conv_id, 0, 0, []::VARCHAR[] FROM size),
        n AS (
          SELECT sha256(array_to_string(path, '')) AS node, sha256(array_to_string(path[:len(path) - 1], '')) AS up,
                 k.conv_id, pos, chars, size = pos AS last
          FROM k JOIN size USING (conv_id)),
        v AS (
          SELECT node, pos, any_value(up) AS up, any_value(chars) AS chars, min(conv_id) AS conv_id, count(*) AS n_convs,
                 sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE last), '')) AS ends_sha256
          FROM n GROUP BY node, pos),
        kids AS (SELECT up AS node, pos - 1 AS pos, count(*) AS n_children FROM v WHERE pos > 0 GROUP BY ALL),
        above AS (  -- each node with itself and the nodes above it, by its smallest member's path
          SELECT n.node AS top, n.pos AS top_pos, v.chars * (v.n_convs - 1) AS saved, kids.node IS NULL AS leaf
          FROM v JOIN n ON n.conv_id = v.conv_id AND n.pos <= v.pos
          LEFT JOIN kids ON kids.node = v.node AND kids.pos = v.pos),
        sums AS (SELECT top AS node, top_pos AS pos, sum(saved) AS saved_tokens, count(*) FILTER (WHERE leaf) AS n_leaves
                 FROM above GROUP BY ALL)
        SELECT v.conv_id, v.pos::BIGINT AS depth, CASE WHEN v.pos > 0 THEN u.conv_id END AS parent_conv_id, v.n_convs,
               coalesce(n_children, 0)::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves,
               saved_tokens::BIGINT AS saved_tokens, v.ends_sha256
        FROM v JOIN sums ON sums.node = v.node AND sums.pos = v.pos
        LEFT JOIN kids ON kids.node = v.node AND kids.pos = v.pos
        LEFT JOIN v u ON u.node = v.up AND u.pos = v.pos - 1""",
}
