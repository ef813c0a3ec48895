"""Quality rules as a short-circuit cascade.

Each rule reads statistics of a whole text and rejects it or not. The cost and
the share of rejected texts of each rule are measured on a bounded sample, and
the rules run in the order of rejections per cost; a text that one rule has
rejected is not shown to the next. The order changes the work, never the
verdict, since a text is kept only if no rule rejects it.

Words are runs of bytes outside ``[\\x20\\x09-\\x0D]``.

Defined cases: a null or empty text has no words, fails the base rules and is
not kept; lines end at ``\\n``, lines without a word never count as repeated;
very long texts are read whole; an empty table gives an empty result (and the
rules keep their written order); other columns are not read.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siglake.llm.common import bounded, chunked, hash_sample, ngram_hashes, span_hashes, string_buffers, words_of

MIN_WORDS = 50
SAMPLE_ROWS = 500        # bound on the texts that rules are measured on
TIMED_CHARS = 20_000     # bound on the characters of each of them

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_ALPHA = np.zeros(256, bool)
_ALPHA[65:91] = _ALPHA[97:123] = _ALPHA[128:] = True
_SHOUT = np.zeros(256, bool)
_SHOUT[list(b"!?")] = True


def _per_row(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return np.diff(total[off])


class Texts:
    """A batch of texts as bytes, with their words."""

    def __init__(self, data: np.ndarray, off: np.ndarray):
        self.data, self.off = data, off
        self.words, self.starts, self.ends, self.n_words = words_of(data, off)
        self.word_off = np.concatenate([[0], np.cumsum(self.n_words)])
        self.known: dict[str, tuple[np.ndarray, ...]] = {}

    def once(self, name: str, count: Callable[[], tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
        """Statistics of each row, counted at the first use."""
        if name not in self.known:
            self.known[name] = count()
        return self.known[name]

    def part(self, rows: np.ndarray) -> "Texts":
        """The given rows alone, without hashing their words again."""
        out = object.__new__(Texts)
        size, n = np.diff(self.off)[rows], self.n_words[rows]
        byte = _ranges(self.off[:-1][rows], size)
        word = _ranges(self.word_off[:-1][rows], n)
        out.data, out.off = self.data[byte], np.concatenate([[0], np.cumsum(size)])
        shift = np.repeat(out.off[:-1] - self.off[:-1][rows], n)
        out.words, out.starts, out.ends = self.words[word], self.starts[word] + shift, self.ends[word] + shift
        out.n_words, out.word_off = n, np.concatenate([[0], np.cumsum(n)])
        out.known = {name: tuple(x[rows] for x in arrays) for name, arrays in self.known.items()}
        return out


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    total = int(size.sum())
    return np.repeat(first - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(total) if total else \
        np.zeros(0, np.int64)


# ---------------------------------------------------------- base statistics

def word_chars(t: Texts) -> np.ndarray:
    return t.once("word_chars", lambda: (_word_chars(t),))[0]


def _word_chars(t: Texts) -> np.ndarray:
    heads = np.zeros(len(t.data) + 1, np.int64)
    np.cumsum((t.data & 0xC0) != 0x80, out=heads[1:])
    total = np.concatenate([[0], np.cumsum(heads[t.ends] - heads[t.starts])])
    return np.diff(total[t.word_off])


def symbols(t: Texts) -> np.ndarray:
    return t.once("symbols", lambda: (_per_row(_SYMBOL[t.data], t.off),))[0]


def lines(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(lines with a word, such lines equal to an earlier one) of each row."""
    return t.once("lines", lambda: _lines(t))


def _lines(t: Texts) -> tuple[np.ndarray, np.ndarray]:
    breaks = np.flatnonzero(t.data == 10)
    n = len(t.off) - 1
    # ends: every line feed and every end of row; a line starts after the end before it or at the row start
    ends = np.concatenate([breaks, t.off[1:]])
    row = np.concatenate([np.searchsorted(t.off, breaks, "right") - 1, np.arange(n)])
    order = np.lexsort((ends, row))
    ends, row = ends[order], row[order]
    starts = np.concatenate([[0], ends[:-1] + 1])[:len(ends)]
    new_row = np.concatenate([[True], row[1:] != row[:-1]])[:len(ends)]
    starts = np.where(new_row, t.off[:-1][row], starts)
    used = np.searchsorted(t.starts, ends) > np.searchsorted(t.starts, starts)
    starts, ends, row = starts[used], ends[used], row[used]
    h = span_hashes(t.data, starts, ends)
    order = np.lexsort((h, row))
    again = np.zeros(len(h), bool)
    again[1:] = (h[order][1:] == h[order][:-1]) & (row[order][1:] == row[order][:-1])
    return np.bincount(row, minlength=n), np.bincount(row[order][again], minlength=n)


def repeated_words(t: Texts, size: int = 3) -> np.ndarray:
    """Words inside windows of three words that the text holds at least twice."""
    grams = ngram_hashes(t.words, size)
    out = np.zeros(len(t.n_words), np.int64)
    for i, (a, b) in enumerate(zip(t.word_off[:-1].tolist(), t.word_off[1:].tolist())):
        if b - a <= size:
            continue
        g = grams[a:b - size + 1]
        order = np.argsort(g, kind="stable")
        s = g[order]
        same = s[1:] == s[:-1]
        if same.any():
            hit = np.zeros(b - a, bool)
            twice = np.unique(np.concatenate([order[1:][same], order[:-1][same]]))
            for k in range(size):
                hit[twice + k] = True
            out[i] = hit.sum()
    return out


def base_statistics(t: Texts) -> list[np.ndarray]:
    return [t.n_words, word_chars(t), symbols(t), lines(t)[1], repeated_words(t)]


# -------------------------------------------------------------------- rules

Rule = Callable[[Texts], np.ndarray]


def too_symbolic(t: Texts) -> np.ndarray:
    """More than 3 symbols on 10 words."""
    return 10 * symbols(t) > 3 * t.n_words


def odd_word_length(t: Texts) -> np.ndarray:
    """Words of under 2 or over 20 characters on average."""
    chars = word_chars(t)
    return (chars < 2 * t.n_words) | (chars > 20 * t.n_words)


def repeated_lines(t: Texts) -> np.ndarray:
    """More than half of the lines repeat an earlier one."""
    n, again = lines(t)
    return 2 * again > n


def shouting(t: Texts) -> np.ndarray:
    """More than 6 of 10 ASCII letters are capitals, or more than one ! or ? on 2 words."""
    upper = _per_row(_UPPER[t.data], t.off)
    lower = _per_row(_ALPHA[t.data] & (t.data < 128), t.off) - upper
    return (4 * upper > 6 * lower) | (2 * _per_row(_SHOUT[t.data], t.off) > t.n_words)


def one_word(t: Texts) -> np.ndarray:
    """One word makes up more than 3 of 10 words."""
    out = np.zeros(len(t.n_words), bool)
    for i, (a, b) in enumerate(zip(t.word_off[:-1].tolist(), t.word_off[1:].tolist())):
        if a < b:
            w = np.sort(t.words[a:b])
            edge = np.flatnonzero(np.concatenate([[True], w[1:] != w[:-1], [True]]))
            out[i] = 10 * np.diff(edge).max() > 3 * (b - a)
    return out


def few_letters(t: Texts) -> np.ndarray:
    """Fewer than 7 of 10 words begin with or hold a letter."""
    held = np.zeros(len(t.data) + 1, np.int64)
    np.cumsum(_ALPHA[t.data], out=held[1:])
    total = np.concatenate([[0], np.cumsum(held[t.ends] > held[t.starts])])
    return 10 * np.diff(total[t.word_off]) < 7 * t.n_words


RULES: dict[str, Rule] = {f.__name__: f for f in (
    one_word, repeated_lines, odd_word_length, few_letters, too_symbolic, shouting)}


def measure(texts: list[str], rules: dict[str, Rule] = RULES) -> list[tuple[str, float, float]]:
    """(rule, seconds for each text, share rejected), most rejections per second first."""
    arr = pa.array(texts, pa.string())
    t = Texts(*string_buffers(arr))
    base_statistics(t)                       # rules find them, as in the cascade
    out = []
    for name, rule in rules.items():
        began = time.perf_counter()
        hit = rule(t)
        out.append((name, (time.perf_counter() - began) / max(1, len(texts)), float(hit.mean()) if len(texts) else 0.0))
    return sorted(out, key=lambda r: -r[2] / max(r[1], 1e-12)) if texts else out


def sample_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rows: int = SAMPLE_ROWS) -> list[str]:
    """At most ``rows`` texts, chosen by a hash of id and text over the whole table; the first TIMED_CHARS of each are timed.

    Each task keeps at most ``rows`` of them, so that of a text which very many rows hold no more travel.
    """
    known = docs.where(F.col(text_col).isNotNull()).select(F.col(id_col).alias("i"), F.col(text_col).alias("t"))
    picked = hash_sample(known, F.struct("i", "t"), rows).select("h", F.substring("t", 1, TIMED_CHARS).alias("t"))
    return [r["t"] for r in bounded(picked, rows).collect()]


def cascade(docs: DataFrame, rules: dict[str, Rule] = RULES, id_col: str = "doc_id", text_col: str = "text"
            ) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_rules.

    ``n_rules`` is the number of rules that a text was shown.
    """
    order = [name for name, _, _ in measure(sample_texts(docs, id_col, text_col), rules)]
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in chunked(batches, 1 << 20):
            t = Texts(*string_buffers(b.column(1)))
            base = base_statistics(t)
            failed = (t.n_words < MIN_WORDS) | (100 * base[4] > 50 * t.n_words)
            left, shown = np.flatnonzero(~failed), np.zeros(b.num_rows, np.int32)
            for name in order:
                if not len(left):
                    break
                shown[left] += 1
                left = left[~rules[name](t if len(left) == b.num_rows else t.part(left))]
            kept = np.zeros(b.num_rows, bool)
            kept[left] = True
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c.astype(np.int64)) for c in base), pa.array(failed), pa.array(kept),
                 pa.array(shown)], names=["doc_id", *counts, "base_failed", "kept", "n_rules"])

    return rows.mapInArrow(apply, f"doc_id {id_type}, " + ", ".join(f"{c} bigint" for c in counts)
                           + ", base_failed boolean, kept boolean, n_rules int")
